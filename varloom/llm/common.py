"""Shared pieces of the training-data operators.

Texts travel between the JVM and Python as Arrow batches and are worked on as
flat byte buffers: splitting, lower-casing and dictionary encoding run in
Arrow's C++ kernels or numpy, and Python only ever loops over the *distinct*
words of a slice.  Every helper takes a null text as an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import use_checkpoints

__all__ = ["use_checkpoints"]

#: Text bytes that one step of a vectorised operator holds at a time.
SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: Column, mod: int) -> Column:
    """crc32 of the value as text, modulo ``mod``; null for a null value."""
    return F.crc32(F.encode(col.cast("string"), "UTF-8")) % F.lit(mod)


def carry(df: DataFrame, id_col: str, text_col: str, keep: list[str] | None) -> tuple[DataFrame, list[str], list[str], str, str]:
    """What an operator sends to Python: the id and the kept columns under
    names that can't clash, and the text once.  Returns (rows, their names in
    Python, their own names, the text's name in Python, the schema's start)."""
    own = [id_col, *(c for c in keep or [] if c != id_col)]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    names = [f"_k{i}" for i in range(len(own))]
    text = names[own.index(text_col)] if text_col in own else "_text"
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(own, names, strict=True)]
    rows = df.select(*columns) if text_col in own else df.select(*columns, F.col(f"`{text_col}`").alias("_text"))
    return rows, names, own, text, "".join(f"{n} {kinds[c]}, " for c, n in zip(own, names, strict=True))


def flat_text(col: pa.Array) -> pa.Array:
    """The column as large_string with nulls made empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.large_string()), "")


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large_string or large_binary array, any offset."""
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def from_buffers(raw: np.ndarray | bytes, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    off = pa.py_buffer(np.ascontiguousarray(offsets, np.int64))
    return pa.Array.from_buffers(kind or pa.large_string(), len(offsets) - 1, [None, off, pa.py_buffer(raw)])


def give_back() -> None:
    """Returns freed memory to the system: a worker waits for its next task
    with what its allocators hold, and that counts against its executor."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def let_go(spark: SparkSession) -> None:
    """Collects what earlier steps left in the driver, so that Spark's cleaner
    drops their shuffles and broadcasts now: it learns of them by collection
    alone, and a driver with room to spare collects late."""
    spark._jvm.System.gc()


def _libc() -> ctypes.CDLL | None:
    try:
        libc = ctypes.CDLL("libc.so.6")
        return libc if hasattr(libc, "malloc_trim") else None
    except OSError:  # another system's allocator does without
        return None


_LIBC = _libc()


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most`` text bytes; a longer row
    stays whole and alone."""
    for batch in batches:
        col = batch.column(text)
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < len(sizes):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(at, to - at)
            at = to
        del batch, col
        give_back()


def byte_table(lower: bool, blank: Iterable[int]) -> bytes:
    """A translation table: ASCII capitals to small letters, ``blank`` bytes to
    a space; bytes of other characters stay."""
    table = bytearray(range(256))
    if lower:
        for b in range(0x41, 0x5B):
            table[b] = b + 32
    for b in blank:
        table[b] = 0x20
    return bytes(table)


#: Words are what stands between white space.
SPACED = byte_table(True, [0x20, *range(0x09, 0x0E)])
#: Words are ASCII letters, digits and all characters beyond ASCII.
WORDLIKE = byte_table(True, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


class Words:
    """The words of a slice of texts: ``codes`` index ``vocabulary``; text i
    has the words ``offsets[i]`` to ``offsets[i + 1]``."""

    def __init__(self, texts: pa.Array, table: bytes = SPACED):
        raw, offsets = buffers(flat_text(texts))
        clean = np.frombuffer(raw.tobytes().translate(table), np.uint8)
        n = len(texts)
        solid = clean != 0x20
        start = solid.copy()
        start[1:] &= ~solid[:-1]
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        start[firsts] = solid[firsts]
        begin = np.flatnonzero(start)
        stop = solid.copy()
        stop[:-1] &= ~solid[1:]
        stop[firsts[1:] - 1] = solid[firsts[1:] - 1]
        end = np.flatnonzero(stop) + 1
        # words and the gaps between them alternate in one array; the words are the odd ones
        cuts = np.empty(2 * len(begin) + 1, np.int64)
        cuts[0] = 0
        cuts[1::2] = begin
        cuts[2::2] = end
        both = from_buffers(clean, cuts)
        words = both.take(pa.array(np.arange(1, 2 * len(begin), 2)))
        coded = words.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
        self.vocabulary = coded.dictionary
        self.offsets = np.searchsorted(begin, offsets).astype(np.int64) if n else np.zeros(1, np.int64)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the vocabulary."""
        import xxhash

        hash64 = xxhash.xxh3_64_intdigest
        words = self.vocabulary.cast(pa.large_binary()).to_pylist()
        return np.fromiter(map(hash64, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, in place on a copy."""
    x = np.array(x, np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... start+count-1 of each run, one after another."""
    counts = np.asarray(counts, np.int64)
    ends = np.cumsum(counts)
    total, far = int(counts.sum()), int((np.asarray(starts, np.int64) + counts).max(initial=0))
    kind = np.int32 if max(total, far) < 2**31 else np.int64
    out = np.repeat((np.asarray(starts, np.int64) - (ends - counts)).astype(kind), counts)
    out += np.arange(total, dtype=kind)
    return out


_ZSTD = pa.Codec("zstd", 3)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob: byte planes compress well for small or
    sorted numbers."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.size else b""
        parts.append(np.array([a.size, ord(a.dtype.char)], np.int64).tobytes() + planes)
    raw = np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)
    head = np.array([len(parts), len(raw)], np.int64).tobytes()
    return head + _ZSTD.compress(raw, asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    n, size = np.frombuffer(blob[:16], np.int64)
    raw = pa.decompress(blob[16:], decompressed_size=int(size), codec="zstd", asbytes=True)
    lengths = np.frombuffer(raw[: 8 * n], np.int64)
    out, at = [], 8 * int(n)
    for length in lengths:
        count, char = np.frombuffer(raw[at : at + 16], np.int64)
        kind = np.dtype(chr(char))
        planes = np.frombuffer(raw[at + 16 : at + int(length)], np.uint8).reshape(kind.itemsize, -1) if count else np.zeros((kind.itemsize, 0), np.uint8)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if count else np.zeros(0, kind))
        at += int(length)
    return out


def pack_sorted(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted 64-bit keys: their high bytes vanish in ``pack``."""
    out = keys.copy()
    out[1:] -= keys[:-1]
    return out


def unpack_sorted(deltas: np.ndarray) -> np.ndarray:
    return np.cumsum(deltas, dtype=np.uint64)
