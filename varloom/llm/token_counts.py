"""Token counts of whole texts, without their ids leaving the workers.

Texts go to the tokenizer in Arrow batches that are cut by bytes, and only
lengths come back.  A text of more than ``chunk`` characters is cut at safe
boundaries first: between two characters that no piece of the vocabulary holds
side by side, so that no merge can reach across.  The parts of a text of more
than ``spread`` characters are dealt to all tasks and their counts are summed.

Cases: a null or empty text has no bytes and no tokens; a null id is kept; equal
rows each have a row of the result; an empty table gives an empty one; a stretch
without a safe boundary (a run of one letter, say) is one part whatever its
length; other columns are not read, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_text, slices

#: Characters of a part of a text, more or less: the tokenizer takes more time a byte for longer ones.
CHUNK_CHARS = 4_096
#: Characters from which a text's parts are dealt to all tasks.
SPREAD_CHARS = 1 << 20
#: Text bytes that the tokenizer is given at a time.
BATCH_BYTES = 1 << 20

#: Fixed values of the model format: the sign for a space, and the kinds of pieces that stand for themselves in a text.
SPACE_SIGN = "▁"
BYTE_PAIRS, NORMAL, USER_DEFINED = 2, 1, 4


class Counter:
    """A piece model in two forms: one for texts and the beginnings of texts,
    which puts a space first as the model says, and one for what follows."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            raw = file.read()
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(raw)
        self.first = sentencepiece.SentencePieceProcessor(model_proto=raw)
        form = model.normalizer_spec
        self.divisible = model.trainer_spec.model_type == BYTE_PAIRS and model.trainer_spec.byte_fallback and form.escape_whitespaces and not (form.precompiled_charsmap or form.remove_extra_whitespaces or model.trainer_spec.treat_whitespace_as_suffix)
        form.add_dummy_prefix = False
        self.later = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        inside = {p.piece[i : i + 2] for p in model.pieces if p.type in (NORMAL, USER_DEFINED) for i in range(len(p.piece) - 1)}
        # a space and its sign are one to the model
        self.inside = inside | {x.replace(SPACE_SIGN, " ") for x in inside} | {x[0].replace(SPACE_SIGN, " ") + x[1] for x in inside} | {x[0] + x[1].replace(SPACE_SIGN, " ") for x in inside}

    @staticmethod
    @functools.cache
    def of(path: str) -> Counter:
        return Counter(path)

    def parts(self, text: str, chunk: int = CHUNK_CHARS) -> list[str]:
        """The text in parts of ``chunk`` characters and what lies before the
        next safe boundary.  A model that normalises takes texts whole."""
        if len(text) <= chunk or not self.divisible:
            return [text]
        found, at = [], 0
        while at < len(text):
            to = at + chunk
            while to < len(text) and text[to - 1 : to + 1] in self.inside:
                to += 1
            found.append(text[at:to])
            at = to
        return found

    def lengths(self, texts: list[str], later: bool) -> list[int]:
        return [len(x) for x in (self.later if later else self.first).encode(texts, num_threads=1)]

    def count(self, parts: list[str], begins: np.ndarray) -> np.ndarray:
        """Tokens of each part; ``begins`` marks those that begin a text."""
        n = np.zeros(len(parts), np.int64)
        for later in (False, True):
            here = np.flatnonzero(begins != later)
            if len(here):
                n[here] = self.lengths([parts[i] for i in here], later)
        return n


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK_CHARS, spread: int = SPREAD_CHARS) -> DataFrame:
    """(id_col, n_bytes, n_tokens) of every whole text.  ``path``: a piece
    model that every executor can read."""
    from pyspark import TaskContext

    kind = df.schema[id_col].dataType.simpleString()
    names = ["_id", "_part", "_row", "_at", "n_bytes", "n_tokens", "_text"]
    schema = f"_id {kind}, _part int, _row bigint, _at int, n_bytes bigint, n_tokens bigint, _text string"

    def sized(texts: pa.Array) -> np.ndarray:
        return pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of texts; of long ones their parts, not yet counted."""
        counter, part, row = Counter.of(path), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "_text", BATCH_BYTES):
            col = flat_text(batch.column("_text"))
            texts, size = col.to_pylist(), sized(col)
            long = np.array([len(x) > spread and counter.divisible for x in texts], bool)
            parts = [counter.parts(x, chunk) if not far else [] for x, far in zip(texts, long, strict=True)]
            each = np.array([len(x) for x in parts], np.int64)
            ends = np.cumsum(each)
            begins = np.zeros(int(each.sum()), bool)
            begins[(ends - each)[~long]] = True
            total = np.concatenate([[0], np.cumsum(counter.count([x for some in parts for x in some], begins))])
            n = total[ends] - total[ends - each]
            keep = np.flatnonzero(~long)
            rows = row + np.arange(len(texts))
            yield pa.RecordBatch.from_arrays([
                batch.column("_id").take(pa.array(keep)), pa.array(np.full(len(keep), part), pa.int32()), pa.array(rows[keep]), pa.array(np.zeros(len(keep)), pa.int32()),
                pa.array(size[keep]), pa.array(n[keep]), pa.nulls(len(keep), pa.string())], names)
            for i in np.flatnonzero(long).tolist():
                # parts of a text go in groups, each of the size of a batch
                some, at = counter.parts(texts[i], max(chunk, BATCH_BYTES // 16)), 0
                for at, x in enumerate(some):
                    one = pa.array([i])
                    yield pa.RecordBatch.from_arrays([batch.column("_id").take(one), pa.array([part], pa.int32()), pa.array([int(rows[i])]), pa.array([at], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([x], pa.string())], names)
            row += len(texts)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(path)
        for batch in slices(batches, "_text", BATCH_BYTES):
            open_ = np.flatnonzero(batch.column("n_tokens").is_null().to_numpy(zero_copy_only=False))
            done = batch.column("n_tokens").fill_null(0).to_numpy().copy()
            size = batch.column("n_bytes").fill_null(0).to_numpy().copy()
            if len(open_):
                col = flat_text(batch.column("_text").take(pa.array(open_)))
                size[open_] = sized(col)
                first = batch.column("_at").to_numpy()[open_] == 0
                parts = [counter.parts(x, chunk) for x in col.to_pylist()]
                each = np.array([len(x) for x in parts], np.int64)
                ends = np.cumsum(each)
                begins = np.zeros(int(each.sum()), bool)
                begins[(ends - each)[first]] = True
                total = np.concatenate([[0], np.cumsum(counter.count([x for some in parts for x in some], begins))])
                done[open_] = total[ends] - total[ends - each]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "_part", "_row")), pa.array(size), pa.array(done)], ["_id", "_part", "_row", "n_bytes", "n_tokens"])

    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    counted = rows.mapInArrow(here, schema).repartition("_part", "_row", "_at").mapInArrow(dealt, f"_id {kind}, _part int, _row bigint, n_bytes bigint, n_tokens bigint")
    out = counted.groupBy("_part", "_row").agg(F.first("_id").alias("_id"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens")
