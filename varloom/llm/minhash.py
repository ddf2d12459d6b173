"""MinHash near-duplicates: b-bit signatures, banded candidates, exact links.

A document's set holds its distinct shingles of k consecutive words (one shingle
of all words if it has fewer).  Documents are linked if the Jaccard similarity
of their sets reaches the threshold, and a document's class is the component it
is in.

1. Each document gets 128 minima.  Bands of four make 32 band keys (two sets at
   the threshold of 0.8 share none with a chance of 5e-8); the low four bits of
   all minima are packed into eight longs.
2. Documents with equal sets are one representative from here on, found by a
   128-bit fingerprint of the set.
3. In each band bucket, members are compared with one pivot only, so a bucket of
   m members makes m pairs and not m * m; pairs are filtered by size and by the
   collision-corrected similarity of their packed bits, then confirmed on the
   full sets.  Confirmed links are joined to components.
4. Buckets whose members are still in different components get a second pivot.
   What is open after that gets a finer signature, 2048 minima of one bit, and
   is compared within its bucket, members of different components only, by both
   estimates before a pair is a row and each pair in its lowest common open
   bucket only; every pair that passes is confirmed.  A bucket of many open
   members is cut into groups there, and each two of them meet in a cell, so no
   task has a whole bucket and a member is sent once for each group.  One-bit
   draws of tiny sets depend
   on each other, so a pair with a set of fewer than FINE_LEAST shingles is
   confirmed without the finer estimate.  No linked pair that shares a bucket is
   left out but for the estimates' error, and there is no cap on buckets, members
   or candidates.

Nothing is collected: sets, pairs, links and components stay in DataFrames that
are cut by checkpoints.  A bucket is never gathered in one task: its pivot is a
minimum with partial aggregation, and what is found of a bucket is written
before rows are joined to it, so that adaptive execution can split the join.

Cases: a null or empty text, or one without words, has an empty set and is
linked with nothing; texts of any length are whole; rows with the same text are
linked; rows that share an id are one document, which is linked with whatever one
of its texts is, and each row tells the size of its own set; a null id is its own class
and never the name of one; an empty table gives an empty one; other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACED, Words, give_back, let_go, mix, pack, pack_sorted, slices, unpack, unpack_sorted, use_checkpoints

HASHES, BAND_ROWS, LOW_BITS = 128, 4, 4
#: How far the estimate may fall short of the threshold before a pair is dropped: five standard deviations of 128 draws.
MARGIN = 0.18
#: Minima of the finer signature, one bit each, and its margin: four and a half standard deviations.
FINE_HASHES, FINE_MARGIN = 2048, 0.06
#: Shingles that both sets have at least where the finer estimate decides.
FINE_LEAST = 20
#: Members whose sets meet one pivot's set in a task, and how many of a bucket's open members a task compares with all others, at most.
MEMBERS, SHARE = 64, 256
#: Rows of a cell that a task holds as bits of numbers, on either side.
TILE = 1024

_draw = np.random.Generator(np.random.PCG64(20260101))
_A = _draw.integers(0, 2**31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
_B = _draw.integers(0, 2**32, HASHES, np.uint32)
_FINE_A = _draw.integers(0, 2**31, FINE_HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
_FINE_B = _draw.integers(0, 2**32, FINE_HASHES, np.uint32)
_PLACES = _draw.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def merged(df: DataFrame) -> DataFrame:
    """As a join's side, sorted and never sent through the driver: what is small
    in a small run grows with the documents."""
    return df.hint("merge")


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted, as 64-bit hashes."""
    words = Words(texts, SPACED)
    hashes = words.hashes()[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    n = max(0, len(hashes) - k + 1)
    rolling = np.zeros(n, np.uint64)
    for j in range(k):
        rolling += hashes[j : j + n] * _PLACES[j % 64]
    rolling = mix(rolling)
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(rolling[a : b - k + 1]))
        elif b > a:
            out.append(mix((hashes[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(shingles: np.ndarray, a: np.ndarray = _A, b: np.ndarray = _B) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(a), 0xFFFFFFFF, np.uint32)
    step = max(16, (1 << 18) // len(a))
    for at in range(0, len(low), step):
        part = low[at : at + step, None] * a
        part += b
        np.minimum(best, part.min(axis=0), out=best)
    return best


def signatures(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(_id, n, f1, f2, bands, bits) of each document."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            sets = shingle_sets(batch.column("_text"), k)
            lowest = np.stack([minima(s) for s in sets])
            n = np.array([len(s) for s in sets], np.int64)
            f1 = np.array([np.bitwise_xor.reduce(s) if len(s) else 0 for s in sets], np.uint64)
            f2 = np.array([mix(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
            grouped = lowest.reshape(len(sets), -1, BAND_ROWS).astype(np.uint64)
            bands = np.arange(grouped.shape[1], dtype=np.uint64)[None, :] * np.ones((len(sets), 1), np.uint64)
            for r in range(BAND_ROWS):
                bands = mix(bands * _PLACES[r] + grouped[:, :, r])
            nibbles = (lowest & np.uint32((1 << LOW_BITS) - 1)).astype(np.uint64).reshape(len(sets), -1, 16)
            bits = (nibbles << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64)
            rows_of = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1]), pa.int32()), pa.array(m.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), rows_of(bands), rows_of(np.ascontiguousarray(bits))], ["_id", "n", "f1", "f2", "bands", "bits"])

    return rows.mapInArrow(run, f"_id {kind}, n bigint, f1 bigint, f2 bigint, bands array<bigint>, bits array<bigint>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity by the share of equal low bits, less what chance makes equal."""
    mask = F.lit(0x1111111111111111)
    differ = []
    for i in range(HASHES * LOW_BITS // 64):
        x = a[i].bitwiseXOR(b[i])
        folded = reduce(lambda p, q: p.bitwiseOR(q), [F.shiftrightunsigned(x, s) for s in (1, 2, 3)], x)
        differ.append(F.bit_count(folded.bitwiseAND(mask)))
    equal = (F.lit(HASHES) - reduce(lambda p, q: p + q, differ)) / F.lit(float(HASHES))
    chance = 2.0**-LOW_BITS
    return (equal - F.lit(chance)) / F.lit(1 - chance)


def may_link(a: str, b: str, percent: int) -> Column:
    """What a linked pair passes: sizes within the threshold, bits near it."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (estimate(F.col(f"{a}.bits"), F.col(f"{b}.bits")) >= percent / 100 - MARGIN)


def fine_estimate(a: Column, b: Column) -> Column:
    differ = [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(FINE_HASHES // 64)]
    return 1 - 2 * reduce(lambda p, q: p + q, differ) / F.lit(float(FINE_HASHES))


def may_link_finely(a: str, b: str, percent: int) -> Column:
    """What a linked pair passes in the last turn, besides may_link."""
    tiny = F.least(F.col(f"{a}.n"), F.col(f"{b}.n")) < FINE_LEAST
    return tiny | (fine_estimate(F.col(f"{a}.fine"), F.col(f"{b}.fine")) >= percent / 100 - FINE_MARGIN)


def full_sets(docs: DataFrame, wanted: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(_id, shingles) of the wanted documents, packed."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(merged(wanted), "_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            sets = shingle_sets(batch.column("_text"), k)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array([pack(pack_sorted(s)) for s in sets], pa.binary())], ["_id", "shingles"])

    return rows.mapInArrow(run, f"_id {kind}, shingles binary")


def unpack_set(blob: pa.Scalar) -> np.ndarray:
    return unpack_sorted(unpack(blob.as_py())[0])


def fine_signatures(sets: DataFrame) -> DataFrame:
    """(_id, fine): one bit of each of many minima, packed in longs."""
    kind = sets.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(minima(unpack_set(x), _FINE_A, _FINE_B) >> np.uint32(7) & np.uint32(1)).view(np.int64) for x in batch.column("shingles")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array([b.tolist() for b in bits], pa.list_(pa.int64()))], ["_id", "fine"])
            give_back()

    return sets.mapInArrow(run, f"_id {kind}, fine array<bigint>")


def confirm(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are linked, by their full sets.  A pivot's
    set is sent once for each MEMBERS of its members."""
    kind = sets.schema["_id"].dataType.simpleString()

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        pivots = [unpack_set(x) for x in left["own"]]
        keep = []
        for x in right["shingles"]:
            own = unpack_set(x)
            ok = False
            for p in pivots:
                both = len(np.intersect1d(p, own, assume_unique=True))
                ok |= both * 100 >= (len(p) + len(own) - both) * percent
            keep.append(ok)
        return right.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # hubs are written first: joined to rows within the plan of their count, their rows would stay in one task
    hubs = pairs.groupBy("a").agg((F.floor(F.count("*") / MEMBERS) + 1).alias("chunks")).where("chunks > 1").checkpoint()
    dealt = pairs.join(merged(hubs), "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("chunks", F.lit(1))).alias("chunk"))
    members = dealt.join(merged(sets), dealt["b"] == sets["_id"]).select("a", "b", "chunk", "shingles")
    pivots = dealt.select(F.col("a").alias("pivot"), F.col("chunk").alias("part")).distinct().join(merged(sets.select(F.col("_id").alias("pivot"), F.col("shingles").alias("own"))), "pivot")
    return pivots.groupBy("pivot", "part").cogroup(members.groupBy("a", "chunk")).applyInArrow(compare, f"a {kind}, b {kind}")


def in_cells(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """The rows with their ``own`` group and, a row for each, the ``cell`` of
    every two groups that theirs is one of; ``alone`` has one group.  A bucket
    of s shares has about sqrt(2 s) groups: as many cells as there were shares,
    of as many pairs, and a row is sent that often and not s times."""
    shares = F.ceil(F.col("members") / SHARE)
    groups = buckets.select("band", F.when(shares > 1, F.ceil(F.sqrt(2 * shares))).otherwise(1).cast("int").alias("groups"))
    own, n = F.col("own"), F.col("groups")
    cells = F.transform(F.sequence(F.lit(0), n - 1), lambda q: F.struct((F.least(own, q) * n + F.greatest(own, q)).alias("cell"), (own == q).alias("alone")))
    return rows.join(merged(groups), "band").withColumn("own", F.pmod(F.xxhash64("_id"), n).cast("int")).withColumn("cells", cells).drop("groups")


def met(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of one cell whose labels differ and that pass both
    estimates, as may_link and may_link_finely have them; a pair that has a
    lower open bucket in common is left to that.  Tiles bound what is held."""
    column = lambda name: table[name].combine_chunks()
    numbers = lambda name: column(name).to_numpy(zero_copy_only=False)
    label = column("label").dictionary_encode().indices.to_numpy()
    n, own = numbers("n"), numbers("own")
    bits, fine = (column(name).flatten().to_numpy().view(np.uint64).reshape(len(n), -1) for name in ("bits", "fine"))
    lower = column("lower")
    signs = lambda a: np.unpackbits(fine[a : a + TILE].view(np.uint8), axis=1).astype(np.float32) * 2 - 1
    found = []
    alone = table["alone"][0].as_py()
    for i in range(0, len(n), TILE):
        left = None
        for j in range(i, len(n), TILE):
            x, y = slice(i, i + TILE), slice(j, j + TILE)
            ok = label[x, None] != label[None, y]
            if i == j:
                ok = np.triu(ok, 1)
            if not alone:
                ok &= own[x, None] != own[None, y]
            least, most = np.minimum(n[x, None], n[None, y]), np.maximum(n[x, None], n[None, y])
            ok &= least * 100 >= most * percent
            if ok.any():
                # each bit that is equal adds one to the product and each other takes one from it
                left = signs(i) if left is None else left
                alike = left @ (left if i == j else signs(j)).T / np.float32(FINE_HASHES)
                a, b = np.nonzero(ok & ((least < FINE_LEAST) | (alike >= np.float32(percent / 100 - FINE_MARGIN))))
                found.append((a + i, b + j))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(c) for c in zip(*found, strict=True))
    differ = np.zeros(len(a), np.int64)
    for k in range(bits.shape[1]):
        x = bits[a, k] ^ bits[b, k]
        differ += np.bitwise_count((x | x >> np.uint64(1) | x >> np.uint64(2) | x >> np.uint64(3)) & np.uint64(0x1111111111111111))
    chance = 2.0**-LOW_BITS
    near = ((HASHES - differ) / HASHES - chance) / (1 - chance) >= percent / 100 - MARGIN
    a, b = a[near], b[near]
    sets = {k: frozenset(lower[k].as_py()) for k in np.unique(np.concatenate([a, b])).tolist()}
    first = np.array([sets[p].isdisjoint(sets[q]) for p, q in zip(a.tolist(), b.tolist(), strict=True)], bool)
    return a[first], b[first]


def likely_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the rows of in_cells.  Each row is sent to its cells once; a
    cell's rows come one after another, and small cells many to a batch."""
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            band, cell = table["band"].to_numpy(), table["cell"].to_numpy()
            cuts = np.flatnonzero((band[1:] != band[:-1]) | (cell[1:] != cell[:-1])) + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), len(band)], strict=True):
                if to - at > 1:
                    part = table.slice(at, to - at)
                    a, b = met(part, percent)
                    if len(a):
                        ids = part["_id"].combine_chunks()
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], ["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            band, cell = batch.column("band").to_numpy(), batch.column("cell").to_numpy()
            # the last cell may go on in the next batch
            other = np.flatnonzero((band != band[-1]) | (cell != cell[-1]))
            at = int(other[-1]) + 1 if len(other) else 0
            if at:
                yield from pairs([*held, batch.slice(0, at)])
                held = []
            elif held and (held[-1].column("band")[-1], held[-1].column("cell")[-1]) != (batch.column("band")[0], batch.column("cell")[0]):
                yield from pairs(held)
                held = []
            held.append(batch.slice(at))
        if held:
            yield from pairs(held)
        give_back()

    sent = rows.select("_id", "band", "label", "n", "bits", "fine", "lower", "own", F.inline("cells")).repartition("band", "cell").sortWithinPartitions("band", "cell")
    return sent.mapInArrow(run, f"a {kind}, b {kind}").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each component of the links (a, b).
    Each turn takes the least label around every node, then that label's own
    label, until nothing changes."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct().checkpoint()
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")).checkpoint()
    while True:
        around = both.join(merged(labels), both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        nearer = labels.join(merged(around), labels["node"] == around["a"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = nearer.select(F.col("node").alias("via"), F.col("label").alias("far"))
        after = nearer.join(merged(jump), nearer["label"] == jump["via"]).select("node", "old", F.least("label", "far").alias("label")).checkpoint()
        changed = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels


def rooted(stars: DataFrame) -> DataFrame:
    """(node, label) of links (a, b), a < b, with one a for each b: every node
    takes its parent's parent until nothing changes, one join a turn."""
    parents = stars.select(F.col("b").alias("node"), F.col("a").alias("label"))
    while True:
        up = parents.select(F.col("node").alias("via"), F.col("label").alias("far"))
        after = parents.join(merged(up), parents["label"] == up["via"], "left").select("node", F.coalesce("far", "label").alias("label"), F.col("far").isNotNull().alias("moved")).checkpoint()
        parents = after.select("node", "label")
        if after.where("moved").isEmpty():
            return parents.union(parents.select(F.col("label").alias("node"), "label").distinct())


def joined_on(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels once further links (a, b) are known: only components that a
    link joins are looked at, and of each its label alone."""
    x, y = labels.toDF("a", "p"), labels.toDF("b", "q")
    p, q = F.coalesce("p", "a"), F.coalesce("q", "b")
    between = links.join(merged(x), "a", "left").join(merged(y), "b", "left").select(F.least(p, q).alias("a"), F.greatest(p, q).alias("b")).where("a <> b").distinct().checkpoint()
    if between.isEmpty():
        return labels
    near = components(between).toDF("label", "least")
    fresh = near.join(merged(labels.select(F.col("node").alias("label"))), "label", "left_anti").select(F.col("label").alias("node"), F.col("least").alias("label"))
    return labels.join(merged(near), "label", "left").select("node", F.coalesce("least", "label").alias("label")).union(fresh).checkpoint()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every document."""
    use_checkpoints(docs.sparkSession)
    signed = signatures(docs, k, id_col, text_col).checkpoint()
    filled = signed.where("n > 0 AND _id IS NOT NULL")
    firsts = filled.groupBy("n", "f1", "f2").agg(F.min("_id").alias("rep"))
    reps = filled.join(merged(firsts.withColumnRenamed("rep", "_id").select("_id", "n", "f1", "f2")), ["_id", "n", "f1", "f2"], "left_semi").dropDuplicates(["_id", "n", "f1", "f2"])
    banded = reps.select("_id", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("_id").alias("pivot"), F.max("_id").alias("other")).where("pivot <> other").select("band", "pivot").checkpoint()
    # members of buckets with two or more: all that follows is about these
    open_rows = banded.join(merged(shared), "band").checkpoint()
    members = open_rows.select("_id").distinct()
    facts = reps.select("_id", "n", "bits").join(merged(members), "_id", "left_semi").checkpoint()
    sets = full_sets(docs, members, k, id_col, text_col).checkpoint()
    let_go(docs.sparkSession)

    def screened(pairs: DataFrame) -> DataFrame:
        a, b = (facts.select("_id", "n", "bits").alias(name) for name in "xy")
        return pairs.join(merged(a), F.col("a") == F.col("x._id")).join(merged(b), F.col("b") == F.col("y._id")).where(may_link("x", "y", percent)).select("a", "b")

    # a member's least pivot that passes the screen is enough for the first turn
    first = screened(open_rows.where("pivot <> _id").select(F.col("pivot").alias("a"), F.col("_id").alias("b")).distinct()).groupBy("b").agg(F.min("a").alias("a")).select("a", "b").checkpoint()
    let_go(docs.sparkSession)
    links = confirm(sets, first, percent).checkpoint()
    labels = rooted(links).checkpoint()
    let_go(docs.sparkSession)

    def labelled(found: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of buckets that still hold several components, and those
        buckets with how many."""
        named = open_rows.join(merged(found), open_rows["_id"] == found["node"], "left").select("band", "_id", F.coalesce("label", "_id").alias("label"))
        torn = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members")).where("low <> high").select("band", "members").checkpoint()
        return named.join(merged(torn.select("band")), "band", "left_semi").checkpoint(), torn

    open_members, torn = labelled(labels)
    if torn.limit(1).count():
        # second turn: in each open bucket the member with the largest id of the largest label meets the members of other labels
        top = open_members.groupBy("band").agg(F.max(F.struct("label", "_id")).alias("top")).select("band", F.col("top._id").alias("pivot"), F.col("top.label").alias("pivot_label")).checkpoint()
        second = screened(open_members.join(merged(top), "band").where("label <> pivot_label").select(F.least("pivot", "_id").alias("a"), F.greatest("pivot", "_id").alias("b")).distinct())
        second = second.groupBy("b").agg(F.min("a").alias("a")).select("a", "b").join(merged(first), ["a", "b"], "left_anti").checkpoint()
        more = confirm(sets, second, percent).checkpoint()
        links, labels = links.union(more), joined_on(labels, more)
        let_go(docs.sparkSession)
        open_members, torn = labelled(labels)
    if torn.limit(1).count():
        # what is left: members of one bucket in different components, screened within the join
        fine = fine_signatures(sets.join(merged(open_members.select("_id").distinct()), "_id", "left_semi"))
        open_bands = open_members.groupBy("_id").agg(F.collect_set("band").alias("bands"))
        known = facts.join(merged(fine), "_id").join(merged(open_bands), "_id")
        lower = F.filter("bands", lambda x: x < F.col("band"))
        rows = in_cells(open_members, torn).join(merged(known), "_id").withColumn("lower", lower)
        third = likely_pairs(rows, percent)
        third = third.join(merged(links), ["a", "b"], "left_anti").join(merged(first), ["a", "b"], "left_anti").checkpoint()
        let_go(docs.sparkSession)
        last = confirm(sets, third, percent).checkpoint()
        let_go(docs.sparkSession)
        labels = joined_on(labels, last)
        let_go(docs.sparkSession)

    classes = firsts.join(merged(labels), firsts["rep"] == labels["node"], "left").select("n", "f1", "f2", F.coalesce("label", "rep").alias("class"))
    out = signed.join(merged(classes), ["n", "f1", "f2"], "left")
    component = F.when((F.col("n") > 0) & F.col("_id").isNotNull(), F.col("class")).otherwise(F.col("_id"))
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"))
