"""Byte-level BPE encoding and decoding (overlapping chunk encoding).

Every text is cut into chunks that overlap, and each chunk is pre-tokenised on
its own.  A chunk that starts inside a pre-token has wrong boundaries at first,
but the pattern has no look-behind: as soon as two neighbouring chunks name one
boundary in common, all later ones agree.  The stitch takes the first boundary
on which both agree and whose left pre-token ends safely before the left chunk
does.  If an overlap holds none (a run of thousands of letters), the open end is
pre-tokenised again with the next chunk, then with the next two, four and so on,
so that the work stays in proportion to the text.  Then the pieces are encoded
by rank; decoding looks the ids' bytes up and joins them.

The chunks of a text of up to SPREAD_CHARS stay in one task.  Those of a longer
text are rows that are dealt to all tasks: they are pre-tokenised there, stitched
together, dealt again as segments of whole pieces, encoded, and joined.

Cases: a null or empty text gives no ids and no bytes; texts of any length are
whole; repeated rows and ids are encoded each; other columns of the input,
whatever their names, are not looked at; an empty table gives an empty one.  A
pattern that looks back or has groups, or that leaves characters out, is an
error.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, from_buffers, give_back, slices

#: Characters of a chunk, by how many it reaches into the next one, and of a text whose chunks are dealt to all tasks.
CHUNK_CHARS, OVERLAP_CHARS, SPREAD_CHARS = 8_192, 512, 1 << 20
#: Text bytes that are encoded at once.
ENCODE_BYTES = 2 << 20
#: Distinct pieces whose ids a worker keeps, and characters of a piece that is kept at most; others are encoded anew.
KEPT_PIECES, KEPT_CHARS = 100_000, 64
#: What a pattern must not have: the boundaries behind a common one would depend on what is before it.
_LOOKS_BACK = re.compile(r"\(\?<[=!]|\\[bBAGK]|(?<![\[\\])\^|\(\?P?<\w")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Decoder:
    """The bytes of each id; made once in each Python worker."""

    _made: dict[str, Decoder] = {}

    def __init__(self, path: str):
        ranks = load_ranks(path)
        table: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            table[rank] = piece
        self.table = pa.array(table, pa.large_binary())
        self.lengths = np.array([len(x or b"") for x in table], np.int64)

    @classmethod
    def of(cls, path: str) -> Decoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The raw bytes of the ids, joined."""
        return buffers(self.table.take(pa.array(ids)))[0] if len(ids) else np.zeros(0, np.uint8)


class Pieces(dict):
    """The ids of pieces, as bytes: merged by rank when they are first met."""

    def __init__(self, merge: Callable[[bytes], list[int]]):
        super().__init__()
        self.merge = merge

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self.merge(piece.encode())).tobytes()
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """One vocabulary file and pattern; made once in each Python worker."""

    _made: dict[tuple[str, str], Encoder] = {}

    def __init__(self, path: str, pattern: str):
        import tiktoken

        check_pattern(pattern)
        self.split = regex.compile(pattern).findall
        engine = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
        self.pieces = Pieces(engine._core_bpe.encode_single_piece)

    @classmethod
    def of(cls, path: str, pattern: str) -> Encoder:
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def boundaries(self, text: str) -> np.ndarray:
        """Ends of the text's pre-tokens, in characters."""
        ends = np.cumsum(np.fromiter(map(len, self.split(text)), np.int64))
        if (int(ends[-1]) if len(ends) else 0) != len(text):
            raise ValueError("the pattern leaves characters out")
        return ends

    def pre_tokens(self, text: str, chunk: int, overlap: int) -> list[str]:
        """The text's pieces, by way of its chunks."""
        if len(text) <= chunk:
            pieces = self.split(text)
            if sum(map(len, pieces)) != len(text):
                raise ValueError("the pattern leaves characters out")
            return pieces
        cuts = [0, *stitch(self, text, [(at, self.boundaries(text[at : at + chunk + overlap])) for at in range(0, len(text), chunk)], chunk + overlap).tolist()]
        return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, pieces))


def check_pattern(pattern: str) -> None:
    if _LOOKS_BACK.search(pattern) or regex.compile(pattern).groups:
        raise ValueError("the pattern looks back or has groups: its boundaries can't be stitched")


def stitch(encoder: Encoder, text: str, chunks: list[tuple[int, np.ndarray]], size: int) -> np.ndarray:
    """The ends of the whole text's pre-tokens, from its chunks (start, ends
    within the chunk) in order, each of up to ``size`` characters."""
    done: list[np.ndarray] = []
    base, ends = 0, chunks[0][1]
    reach = min(len(text), size)
    j, step = 1, 1
    while j < len(chunks):
        start, right = chunks[j][0], chunks[j][1]
        # a pre-token of the left part is safe if a character of the part follows its next one
        safe = ends[: np.searchsorted(ends, reach - 1)]
        tail = safe[np.searchsorted(safe, start, "right") :]
        head = right + start
        both = np.intersect1d(tail, head[: np.searchsorted(head, reach - 1)], assume_unique=True)
        if len(both):
            p = int(both[0])
            done.append(ends[: np.searchsorted(ends, p, "right")])
            base, ends, reach = p, head[np.searchsorted(head, p, "right") :], min(len(text), start + size)
            j, step = j + 1, 1
        else:
            # safe ends stand; what is open is pre-tokenised as one with the next chunks
            base = int(safe[-1]) if len(safe) else base
            done.append(safe)
            j = min(len(chunks), j + step)
            reach = min(len(text), chunks[j - 1][0] + size)
            ends = base + encoder.boundaries(text[base:reach])
            step *= 2
    return np.concatenate([*done, ends])


def little_endian(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return from_buffers(ids.astype("<u4").view(np.uint8), offsets * 4, pa.large_binary()).cast(pa.binary())


def ids_of(coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, where each text's begin) of ids as bytes."""
    return np.frombuffer(b"".join(coded), "<u4"), np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded], dtype=np.int64)])


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, spread: int = SPREAD_CHARS, form: Callable[[np.ndarray, np.ndarray], pa.Array] | None = None, form_type: str = "binary") -> DataFrame:
    """(id_col, ids): ids of every whole text as little-endian unsigned 32-bit
    integers, or as ``form`` makes them of (ids, offsets of the texts).
    ``path``: a rank file that every executor can read."""
    check_pattern(pattern)
    form = form or little_endian
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = f"_id {kind}, ids {form_type}"

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, pattern)
        for batch in slices(batches, "_text", ENCODE_BYTES):
            coded = [encoder.encode(encoder.pre_tokens(x.as_py(), chunk, overlap)) for x in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), form(*ids_of(coded))], ["_id", "ids"])

    def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sliced here, as a substring in the JVM walks there from the text's start
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("_text")[i].as_py()
                for some in np.array_split(np.arange(0, len(text), chunk), max(1, len(text) // spread)):
                    at = some.tolist()
                    one = pa.array(np.full(len(at), i))
                    yield pa.RecordBatch.from_arrays([batch.column("_id").take(one), batch.column("_row").take(one), pa.array(at, pa.int64()), pa.array([text[a : a + chunk + overlap] for a in at], pa.string())], ["_id", "_row", "_at", "_text"])

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, pattern)
        for batch in slices(batches, "_text", ENCODE_BYTES):
            ends = [encoder.boundaries(x.as_py()).astype("<i4").tobytes() for x in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "_row", "_at", "_text")), pa.array(ends, pa.binary())], ["_id", "_row", "_at", "_text", "_ends"])

    def segments(table: pa.Table) -> pa.Table:
        encoder = Encoder.of(path, pattern)
        table = table.sort_by("_at")
        texts = [x.as_py() for x in table["_text"]]
        text = "".join([x[:chunk] for x in texts[:-1]] + texts[-1:])
        chunks = [(at, np.frombuffer(ends, "<i4").astype(np.int64)) for at, ends in zip(table["_at"].to_pylist(), table["_ends"].to_pylist(), strict=True)]
        ends = stitch(encoder, text, chunks, chunk + overlap)
        # each segment ends with the piece that reaches the next multiple of a chunk
        last = np.unique(np.append(np.searchsorted(ends, np.arange(chunk, len(text), chunk)), len(ends) - 1))
        cuts = np.concatenate([[0], ends[last]])
        parts = np.split(ends, last[:-1] + 1)
        made = pa.table({
            "_id": table["_id"].slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(parts), np.int64))), "_row": pa.array([table["_row"][0].as_py()] * len(parts), pa.string()), "_at": pa.array(cuts[:-1], pa.int64()),
            "_text": pa.array([text[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], pa.string()), "_ends": pa.array([(p - a).astype("<i4").tobytes() for p, a in zip(parts, cuts, strict=False)], pa.binary()),
        })
        del texts, text, chunks, ends
        give_back()
        return made

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, pattern)
        for batch in slices(batches, "_text", ENCODE_BYTES):
            found = []
            for text, ends in zip(batch.column("_text"), batch.column("_ends"), strict=True):
                cuts, text = [0, *np.frombuffer(ends.as_py(), "<i4").tolist()], text.as_py()
                found.append(encoder.encode([text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "_row", "_at")), pa.array(found, pa.binary())], ["_id", "_row", "_at", "_ids"])

    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("_at")
        ids = np.frombuffer(b"".join(x.as_py() for x in table["_ids"]), "<u4")
        return pa.table({"_id": table["_id"].slice(0, 1), "ids": form(ids, np.array([0, len(ids)]))})

    size = F.length("_text")
    short = rows.where(size <= spread).mapInArrow(here, schema)
    # equal rows with equal ids stay apart: a chunk knows its row by a key drawn from the row's own content and a number within it
    big = rows.where(size > spread).withColumn("_row", F.concat_ws(":", F.xxhash64("_id", "_text").cast("string"), F.monotonically_increasing_id().cast("string")))
    own = f"_id {kind}, _row string, _at bigint, "
    parts = big.mapInArrow(chunks_of, own + "_text string")
    cut = parts.repartition("_row", "_at").mapInArrow(bounds, own + "_text string, _ends binary").groupBy("_row").applyInArrow(segments, own + "_text string, _ends binary")
    long = cut.repartition("_row", "_at").mapInArrow(coded, own + "_ids binary").groupBy("_row").applyInArrow(joined, schema)
    return short.unionByName(long).withColumnRenamed("_id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, ids, decoded): the bytes that the ids stand for."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder.of(path)
        for batch in slices(batches, "ids", 1 << 20):
            raw, offsets = buffers(batch.column("ids").cast(pa.large_binary()))
            ids = np.frombuffer(raw.tobytes(), "<u4").astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(decoder.lengths[ids])])[offsets // 4]
            decoded = from_buffers(decoder.decode(ids), ends, pa.large_binary()).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("ids"), decoded], ["_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"_id {kind}, ids binary, decoded binary").withColumnRenamed("_id", id_col)
