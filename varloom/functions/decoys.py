"""The shuffling decoy: Python's generator fixes its results."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .peptides import CUT

CUT_PATTERN = re.compile(CUT)


def mixed(piece: str, draw: random.Random, tries: int) -> str:
    """A tryptic fragment shuffled but for its last residue and its prolines:
    either could make or undo a cut.  A result equal to the fragment is tried
    again; fragments with fewer than two movable residues stay."""
    places = [i for i, c in enumerate(piece[:-1]) if c != "P"]
    if len(places) > 1:
        for _ in range(tries):
            origins = places.copy()
            draw.shuffle(origins)
            moved = dict(zip(places, origins, strict=True))
            made = "".join(piece[moved.get(i, i)] for i in range(len(piece)))
            if made != piece:
                return made
    return piece


def shuffle_one(seq: str, tries: int = 10, seed: int = 0) -> str:
    """All fragments shuffled in turn; the generator starts anew for each
    protein, so a result doesn't depend on its place."""
    draw = random.Random(seed)
    return "".join(mixed(piece, draw, tries) for piece in CUT_PATTERN.split(seq) if piece)


def shuffled(df: DataFrame, column: str) -> DataFrame:
    """The rows with a ``decoy`` column."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", decoy string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decoys = [None if s is None else shuffle_one(s) for s in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoys, pa.string())], [*batch.schema.names, "decoy"])

    return df.mapInArrow(run, schema)
