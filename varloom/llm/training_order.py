"""Training-order materialisation: a keyed permutation, fixed-stride shards.

Token ids of every document, closed by an end id, are cut into sequences of one
fixed length, the last one padded with the end id.  Sequences are numbered 0 to
N - 1 in input order: each partition counts its own, and only one number per
partition is added up.  That order is written with the ids and stays, whatever
later runs do.  A keyed Feistel network over the least even number of
bits that holds N, walked in cycles until it lands below N, gives each sequence
a global slot: a bijection, known from the key alone, with no sort and no random
numbers to store.  Slots go to range partitions by exact arithmetic; each writes
one shard: rows of STRIPE sequences, each of which takes the same number of
bytes, in slot order.  A reader finds slot s in row s div STRIPE at byte
(s mod STRIPE) * stride, and resumes anywhere by a filter that reaches the scan.

A folder holds ``ids`` (while it is made), ``order`` (N, the key and the sizes),
``shards`` by waves of at most WAVE shards, and a mark in ``done`` for each wave
that is complete.  A run that finds a folder begun goes on with it: what has
Spark's mark of a finished write is taken as it is, and what lacks it is made
anew, so ids and order stay and complete waves are left out; another key or size
than the folder's is an error.

Cases: a null or empty text is one sequence of end ids; texts of any length are
whole, those beyond what the library's matcher can hold by overlapping chunks; repeated rows have sequences of their own; a null id is kept as it is; an
empty table writes no row and reads as an empty table; other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import CHUNK_CHARS, OVERLAP_CHARS, Encoder, load_ranks
from .common import mix, ragged, slices, use_checkpoints

#: Ids of a sequence, sequences of a row of a shard, and of a shard.
LENGTH, STRIPE, SHARD = 512, 256, 65_536
#: Shards that are shuffled at once; a larger order is written in several waves, each a job of its own.
WAVE = 65_536
ROUNDS = 6
#: Characters up to which the library takes a text at once: its matcher ends with an error on white space of about a million.
LIBRARY_CHARS = 400_000


_CODEC = pa.Codec("zstd", 1)


def squeezed(data: bytes) -> bytes:
    return _CODEC.compress(data, asbytes=True)


def restored(data: bytes, size: int) -> bytes:
    return _CODEC.decompress(data, size, asbytes=True)


def round_keys(key: str) -> np.ndarray:
    raw = hashlib.sha512(key.encode()).digest()
    return np.frombuffer(raw, "<u8")[:ROUNDS].copy()


class Permutation:
    """A bijection of 0 to n - 1 that depends on the key."""

    def __init__(self, n: int, key: str):
        self.n = n
        self.half = max(1, math.ceil(math.log2(max(2, n)) / 2))
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = round_keys(key)

    def _pass(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in keys:
            if back:
                left, right = right ^ (mix(left + k) & self.mask), left
            else:
                left, right = right, left ^ (mix(right + k) & self.mask)
        return left << np.uint64(self.half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        keys = self.keys[::-1] if back else self.keys
        out = self._pass(np.asarray(x, np.uint64), keys, back)
        while (far := np.flatnonzero(out >= np.uint64(self.n))).size:
            out[far] = self._pass(out[far], keys, back)
        return out.astype(np.int64)

    def slots(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, False) if len(index) else np.zeros(0, np.int64)

    def index_of(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True) if len(slots) else np.zeros(0, np.int64)


def id_width(end_id: int) -> int:
    return 2 if end_id < 1 << 16 else 4


def id_form(end_id: int) -> Callable[[np.ndarray, np.ndarray], pa.Array]:
    """How an encoder hands ids over: 16-bit where they fit, squeezed."""
    width = id_width(end_id)

    def form(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        narrow = ids.astype(f"<u{width}")
        at = offsets.tolist()
        bodies = pa.array([squeezed(narrow[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)], pa.binary())
        return pa.StructArray.from_arrays([pa.array(np.diff(offsets), pa.int64()), bodies], ["n", "body"])

    return form


NUMBERED = "n bigint, body binary, part int, before bigint"


class Numbering:
    """The sequences of a partition, counted as its documents come."""

    def __init__(self, length: int):
        from pyspark import TaskContext

        self.part, self.length, self.held = TaskContext.get().partitionId(), length, 0

    def columns(self, n: np.ndarray) -> list[pa.Array]:
        """(part, sequences of this partition before each document's own)."""
        each = n // self.length + 1
        ends = self.held + np.cumsum(each)
        self.held = int(ends[-1]) if len(ends) else self.held
        return [pa.array(np.full(len(n), self.part), pa.int32()), pa.array(ends - each, pa.int64())]


def token_ids(df: DataFrame, path: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(_id, n, body, part, before): the token ids of every whole text, by the
    tokenizer library itself, long ones by their pieces, squeezed, and their
    place in the order of the documents.  ``path``: a rank file that every
    executor can read."""
    kind = df.schema[id_col].dataType.simpleString()
    width = id_width(end_id)
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine, numbering = library(path, pattern), Numbering(length)

        def coded_(text: str) -> np.ndarray:
            if len(text) <= LIBRARY_CHARS:
                return engine.encode_to_numpy(text, disallowed_special=())
            pieces = Encoder.of(path, pattern)
            return np.frombuffer(pieces.encode(pieces.pre_tokens(text, CHUNK_CHARS, OVERLAP_CHARS)), "<u4")

        for batch in slices(batches, "_text", 1 << 20):
            coded = [coded_(x.as_py()).astype(f"<u{width}") for x in batch.column("_text")]
            n = np.array([len(x) for x in coded], np.int64)
            bodies = pa.array([squeezed(x.tobytes()) for x in coded], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(n), bodies, *numbering.columns(n)], ["_id", "n", "body", "part", "before"])

    return rows.mapInArrow(run, f"_id {kind}, {NUMBERED}")


@functools.cache
def library(path: str, pattern: str):
    """The library's encoder, made once in each Python worker."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder among the checkpoints, which all executors share."""
    use_checkpoints(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def written(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at the path, or None where its write has not ended."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.parquet(path) if there else None


def removed(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def numbered_ids(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", length: int = LENGTH) -> DataFrame:
    """The same of ids that another encoder has made: (id_col, ids: struct of
    their number and their squeezed little-endian bytes, see ``id_form``)."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering = Numbering(length)
        for batch in batches:
            n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "n", "body")), *numbering.columns(n)], ["_id", "n", "body", "part", "before"])

    packed = F.col(ids_col)
    return encoded.select(F.col(id_col).alias("_id"), packed["n"].alias("n"), packed["body"].alias("body")).mapInArrow(run, f"_id {kind}, {NUMBERED}")


def materialise(numbered: DataFrame, path: str, end_id: int, key: str, length: int = LENGTH, stripe: int = STRIPE, shard: int = SHARD, wave: int = WAVE) -> int:
    """Writes the shards of numbered ids (see ``token_ids``) to the folder
    ``path``, or goes on with what is there; returns the number of sequences.
    ``shard`` is a multiple of ``stripe``."""
    spark = numbered.sparkSession
    kind = numbered.schema["_id"].dataType.simpleString()
    width = id_width(end_id)
    asked = (key, length, stripe, shard, end_id, wave)
    order_row = written(spark, f"{path}/order")
    if order_row is None:
        # what a run that was ended left of the ids is not whole
        numbered.write.mode("overwrite").option("compression", "none").parquet(f"{path}/ids")
        counted = spark.read.parquet(f"{path}/ids").groupBy("part").agg(F.max(F.col("before") + F.floor(F.col("n") / length) + 1).alias("sequences"))
        firsts, at = [], 0
        for row in sorted(counted.collect(), key=lambda x: x["part"]):  # one number per partition
            firsts.append((row["part"], at))
            at += row["sequences"]
        spark.createDataFrame(firsts, "part int, first bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/starts")
        spark.createDataFrame([(at, *asked)], "n bigint, key string, length int, stripe int, shard int, end_id int, wave int").coalesce(1).write.mode("overwrite").parquet(f"{path}/order")
        order_row = written(spark, f"{path}/order")
    total, *known = order_row.first()
    if tuple(known) != asked:
        raise ValueError(f"{path} holds another order: {tuple(known)} and not {asked}")
    waves = -(-max(1, -(-total // shard)) // wave)
    missing = [k for k in range(waves) if written(spark, f"{path}/done/{k}") is None]
    if not missing:
        removed(spark, f"{path}/ids")
        return total
    starts = F.broadcast(spark.read.parquet(f"{path}/starts"))  # a number for each partition that wrote ids
    placed_ids = spark.read.parquet(f"{path}/ids").join(starts, "part").select("_id", "n", "body", (F.col("first") + F.col("before")).alias("number"))
    order = Permutation(max(1, total), key)
    stride, end_bytes = length * width, end_id.to_bytes(width, "little")

    def cut(batches: Iterator[pa.RecordBatch], low: int, high: int) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", 1 << 20):
            sizes = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
            counts = sizes // length + 1
            slots = order.slots(ragged(batch.column("number").to_numpy(zero_copy_only=False), counts))
            docs, serials = np.repeat(np.arange(len(sizes)), counts), ragged(np.zeros(len(sizes), np.int64), counts)
            inside = np.flatnonzero((slots >= low) & (slots < high))
            slots, docs, serials = slots[inside], docs[inside], serials[inside]
            lengths = np.minimum(length, sizes[docs] + 1 - serials * length)
            bodies, at, data = [], -1, b""
            packed = batch.column("body")
            for doc, serial in zip(docs.tolist(), serials.tolist(), strict=True):
                if doc != at:
                    at, n, count = doc, int(sizes[doc]), int(counts[doc])
                    data = (restored(packed[doc].as_py(), n * width) if n else b"") + end_bytes * (count * length - n)
                bodies.append(squeezed(data[serial * stride : (serial + 1) * stride]))
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), batch.column("_id").take(pa.array(docs, pa.int64())), pa.array(serials, pa.int32()), pa.array(lengths, pa.int32()), pa.array(bodies, pa.binary())], ["slot", "_id", "serial", "n", "body"])

    def stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = 0

        def made(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            slots = table["slot"].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(slots[1:] // stripe != slots[:-1] // stripe) + 1, [len(slots)]])
            blobs = [restored(x.as_py(), stride) for x in table["body"]]
            off = pa.array(cuts, pa.int32())
            lists = [pa.ListArray.from_arrays(off, table[c].combine_chunks()) for c in ("_id", "serial", "n")]
            first = slots[cuts[:-1]]
            return pa.RecordBatch.from_arrays([pa.array(first // shard, pa.int64()), pa.array(first // stripe, pa.int64()), pa.array(first, pa.int64()), *lists, pa.array([b"".join(blobs[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], ["shard", "stripe", "first_slot", "ids", "serials", "lengths", "tokens"])

        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= 8 * stripe:
                table = pa.Table.from_batches(held).combine_chunks()
                slots = table["slot"].to_numpy()
                # the last stripe may go on in the next batch
                keep = int(np.searchsorted(slots, slots[-1] // stripe * stripe))
                if keep:
                    yield made(table.slice(0, keep))
                held = table.slice(keep).to_batches()
                waiting = table.num_rows - keep
        if waiting:
            yield made(pa.Table.from_batches(held))

    for k in missing:
        low, high = k * wave * shard, min(total, (k + 1) * wave * shard)
        placed = placed_ids.mapInArrow(functools.partial(cut, low=low, high=high), f"slot bigint, _id {kind}, serial int, n int, body binary")
        dealt = placed.repartitionById(max(1, -(-(high - low) // shard)), F.expr(f"cast((slot - {low}) div {shard} as int)")).sortWithinPartitions("slot")
        striped = dealt.mapInArrow(stripes, f"shard bigint, stripe bigint, first_slot bigint, ids array<{kind}>, serials array<int>, lengths array<int>, tokens binary")
        # a wave that was ended is written anew
        striped.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/shards/wave={k}")
        spark.createDataFrame([(k,)], "wave int").coalesce(1).write.mode("overwrite").parquet(f"{path}/done/{k}")
    removed(spark, f"{path}/ids")
    return total


def read_from(spark: SparkSession, path: str, id_col: str = "doc_id", first_slot: int = 0, stripe: int = STRIPE) -> DataFrame:
    """(slot, shard, id_col, serial, n_tokens, tokens) of every sequence from
    ``first_slot`` on; earlier rows of the shards are skipped by the scan."""
    rows = spark.read.parquet(f"{path}/shards").where(F.col("stripe") >= first_slot // stripe)
    stride = F.floor(F.octet_length("tokens") / F.size("ids")).cast("int")
    parts = F.arrays_zip("ids", "serials", "lengths")

    def one(x: Column, i: Column) -> Column:
        return F.struct((F.col("first_slot") + i).alias("slot"), x["ids"].alias(id_col), x["serials"].alias("serial"), x["lengths"].alias("n_tokens"), F.substring(F.col("tokens"), i * F.col("stride") + 1, F.col("stride")).alias("tokens"))

    # a sequence takes its own bytes along, not its row's
    each = rows.withColumn("stride", stride).select("shard", F.inline(F.transform(parts, one)))
    return each.where(F.col("slot") >= first_slot).select("slot", "shard", id_col, "serial", "n_tokens", "tokens")
