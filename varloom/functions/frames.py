"""Open reading frames of many sequences, in Arrow batches.

The same frames as ``sequence.open_frames`` gives for one expression; here a
sequence is translated once for each frame and its stops are looked for once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .sequence import BASES, STANDARD_CODE

CODONS = dict(zip((a + b + c for a in BASES for b in BASES for c in BASES), STANDARD_CODE, strict=True))
FIELDS = [("length_key", pa.int32()), ("frame", pa.int32()), ("nt_start", pa.int32()), ("nt_end", pa.int32()), ("protein", pa.string()), ("started_at_atg", pa.bool_()), ("stop_found", pa.bool_())]
KIND = "array<struct<length_key:int,frame:int,nt_start:int,nt_end:int,protein:string,started_at_atg:boolean,stop_found:boolean>>"


def frames_of(nt: str, min_aa: int, require_atg: bool) -> list[dict]:
    """The frames between stops, longest first, then by frame and start."""
    seq, found = nt.upper().replace("U", "T"), []
    for frame in range(3):
        aas = "".join([CODONS.get(seq[i : i + 3], "X") for i in range(frame, len(seq) - 2, 3)])
        at = 0
        for chunk in aas.split("*"):
            skip = chunk.find("M") if require_atg else 0
            protein = chunk[skip:] if skip >= 0 else ""
            if len(protein) >= min_aa:
                begin = frame + 3 * (at + skip)
                found.append((-len(protein), frame, begin, begin + 3 * len(protein), protein, protein.startswith("M"), at + len(chunk) < len(aas)))
            at += len(chunk) + 1
    names = [n for n, _ in FIELDS]
    return [dict(zip(names, x, strict=True)) for x in sorted(found)]


def with_frames(df: DataFrame, nt: str, name: str, min_aa: int = 30, require_atg: bool = True) -> DataFrame:
    """The rows with their sequence's open frames; none for a null sequence."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{name}` {KIND}"
    listed = pa.list_(pa.struct(FIELDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [frames_of(x.as_py() or "", min_aa, require_atg) for x in batch.column(nt)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, listed)], [*batch.schema.names, name])

    return df.mapInArrow(run, schema)
