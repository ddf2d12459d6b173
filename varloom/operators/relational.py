"""Interval joins, first-wins picks, tiered lookups, division and numbering."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import use_checkpoints

#: Bases of an interval bin.
BIN = 1 << 17
#: Tasks for each core among which rows are dealt.
TASKS_A_CORE = 4
#: The same where few bytes make many rows.
PAIR_TASKS_A_CORE = 8


def merged(df: DataFrame) -> DataFrame:
    """As a join's side, sorted and never sent through the driver: a relation
    made of a small file's rows is many times what the file's size tells."""
    return df.hint("merge")


def dealt(df: DataFrame, *keys: str, tasks: int = TASKS_A_CORE) -> DataFrame:
    """The rows dealt to all tasks before they are worked on: a small file, or
    one of a single row group, is read by one task."""
    return df.repartition(tasks * df.sparkSession.sparkContext.defaultParallelism, *keys)


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, keys: list[tuple[str, str]], width: int = BIN) -> DataFrame:
    """Points within [start, end] of an interval with equal keys.  Intervals
    are listed under every bin they touch and a point has one bin, so the range
    condition becomes an equi-join with a residual, and no pair comes twice."""
    placed = points.withColumn("_point_bin", F.floor(F.col(point) / width))
    return _over(placed, _binned(intervals, start, end, width), point, start, end, keys)


def _binned(intervals: DataFrame, start: str, end: str, width: int) -> DataFrame:
    return intervals.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))


def _over(placed: DataFrame, binned: DataFrame, point: str, start: str, end: str, keys: list[tuple[str, str]]) -> DataFrame:
    match = reduce(lambda a, b: a & b, [placed[a] == binned[b] for a, b in keys], placed["_point_bin"] == binned["_bin"])
    return placed.join(merged(binned), match & (placed[point] >= binned[start]) & (placed[point] <= binned[end])).drop("_bin", "_point_bin")


def interval_pairs(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, keys: list[tuple[str, str]], width: int = BIN, block: int = 256) -> DataFrame:
    """The rows of ``interval_join``, for results that are the pairs themselves.
    Points of one place are joined as blocks of at most ``block`` and listed
    under each interval, so an interval's columns stay the same for a block's
    length and a block's points come again under the next interval: written by
    columns, pairs take a fraction of the space.  Both sides are dealt by bin,
    as few bytes here make many rows."""
    own, other = [a for a, _ in keys], [b for _, b in keys]
    rest = {c: f"_{i}" for i, c in enumerate(c for c in points.columns if c not in (*own, point))}
    placed = dealt(points.dropna(subset=[*own, point]).withColumn("_point_bin", F.floor(F.col(point) / width)), *own, "_point_bin", tasks=PAIR_TASKS_A_CORE)
    nth = F.row_number().over(Window.partitionBy(*own, "_point_bin", point).orderBy(point))
    row = F.struct(F.lit(0).alias("_at"), *(F.col(c).alias(n) for c, n in rest.items()))
    blocks = placed.withColumn("_block", F.floor((nth - 1) / block)).groupBy(*own, "_point_bin", point, "_block").agg(F.collect_list(row).alias("_points")).drop("_block")
    pairs = _over(blocks, dealt(_binned(intervals, start, end, width), *other, "_bin", tasks=PAIR_TASKS_A_CORE), point, start, end, keys)
    return pairs.select(*own, point, *intervals.columns, F.inline("_points")).select(*(F.col(rest.get(c, c)).alias(c) for c in points.columns), *intervals.columns)


def overlap_join(a: DataFrame, b: DataFrame, a_ends: tuple[str, str], b_ends: tuple[str, str], keys: list[tuple[str, str]], width: int = BIN) -> DataFrame:
    """Pairs of overlapping intervals with equal keys, each once: it counts in
    the first bin that both touch."""
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width)))
    x, y = a.withColumn("_xb", bins(*a_ends)), b.withColumn("_yb", bins(*b_ends))
    match = reduce(lambda p, q: p & q, [x[k] == y[m] for k, m in keys], x["_xb"] == y["_yb"])
    meets = (x[a_ends[0]] <= y[b_ends[1]]) & (y[b_ends[0]] <= x[a_ends[1]])
    first = x["_xb"] == F.floor(F.greatest(x[a_ends[0]], y[b_ends[0]]) / width)
    return x.join(merged(y), match & meets & first).drop("_xb", "_yb")


def first_wins(df: DataFrame, keys: list[str], order: list[Column], aggregate: bool = True) -> DataFrame:
    """The first row of each key.  A minimum of (order, row) has a map-side part,
    so a hot key sends one row per task and not all its rows."""
    if not aggregate:
        return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))).alias("_row"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_over(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, keys: list[tuple[str, str]], group: str, order: list[Column], row: list[str], levels: int = 10) -> DataFrame:
    """The points, each once, with the first of the intervals over them in each
    group, and that interval's ``row``.  No pair of point and interval is formed:
    an interval is a few blocks of 1, 2, 4 ... 2^levels bases, of equal blocks a
    group keeps the first interval, and a point looks at the one block of each
    size that it is in.  So rows grow with points, groups and intervals, however
    many intervals lie over each other."""
    width = 1 << levels
    own, other = [a for a, _ in keys], [b for _, b in keys]
    base = F.col("_bin") * width
    low, stop = F.greatest(F.col(start), base) - base, F.least(F.col(end) + 1, base + width) - base
    nodes = []
    for level in range(levels + 1):
        size = 1 << level
        first, last = F.floor((low + size - 1) / size), F.floor(stop / size)
        block = lambda at, odd: F.when((first < last) & (odd % 2 == 1), F.struct(F.lit(level).alias("level"), (F.col("_bin") * (width // size) + at).alias("node")))  # noqa: B023, E731
        nodes += [block(first, first), block(last - 1, last)]
    binned = intervals.where(F.col(start) <= F.col(end)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    ranked = binned.select(*other, group, F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order))).alias("_o"), F.struct(*row).alias("_row"), F.explode(F.filter(F.array(*nodes), lambda x: x.isNotNull())).alias("_x"))
    best = ranked.groupBy(*other, group, "_x.level", "_x.node").agg(F.min(F.struct("_o", "_row")).alias("_b")).withColumnsRenamed(dict(zip(other, own, strict=True)))
    places = points.select(*own, point).distinct()
    seen = places.select("*", F.explode(F.array(*(F.struct(F.lit(n).alias("level"), F.floor(F.col(point) / (1 << n)).alias("node")) for n in range(levels + 1)))).alias("_x")).select(*own, point, "_x.*")
    won = seen.join(merged(best), [*own, "level", "node"]).groupBy(*own, point, group).agg(F.min("_b").alias("_b"))
    # a place's groups are one row until its points are found, so that only slim rows are moved
    picks = won.groupBy(*own, point).agg(F.collect_list(F.struct(F.col(group), F.col("_b._row").alias("_row"))).alias("_picks"))
    found = points.distinct().join(merged(picks), [*own, point])
    return found.select(*points.columns, F.explode("_picks").alias("_p")).select(*points.columns, f"_p.{group}", "_p._row.*")


def top_rows(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def tiered_lookup(probe: DataFrame, key: str, index: DataFrame, index_key: str, tier: str) -> DataFrame:
    """Matches of each probe key in its best tier only.  The best tier is a
    property of the index, so it is found there and probes are joined once."""
    best = index.groupBy(F.col(index_key).alias("_k")).agg(F.min(tier).alias("_best"))
    top = index.join(merged(best), (index[index_key] == best["_k"]) & (index[tier] == best["_best"])).drop("_k", "_best")
    return probe.join(merged(top), probe[key] == top[index_key])


def divide(required: DataFrame, owner: str, item: str, observed: DataFrame, observed_item: str) -> DataFrame:
    """Owners all of whose required items are observed (relational division)."""
    need = required.select(owner, item).distinct()
    have = observed.select(F.col(observed_item).alias(item)).distinct().withColumn("_seen", F.lit(1))
    counts = need.join(have, item, "left").groupBy(owner).agg(F.count("*").alias("_need"), F.count("_seen").alias("_have"))
    return counts.where("_need = _have").select(owner, F.col("_need").alias("n_required"))


def upper_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """sorted[n div 2] of each key, from counts of distinct values: the rows of
    a hot key are summed before they meet."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*keys)
    run = counts.withColumn("_run", F.sum("_c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum("_c").over(w))
    out = run.where(F.col("_run") > F.floor(F.col("_all") / 2))
    return out.groupBy(*keys).agg(F.min(value).alias("upper_median"))


def _local_numbers(placed: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with their place in their partition (_row) and their number
    within their key there (_local), of partitions sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, last, run_start = 0, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            first = tuple(batch.column(k)[0] for k in keys)
            new[0] = last is None or any(a.as_py() != b.as_py() for a, b in zip(first, last, strict=True))
            for k in keys:
                a, b = batch.column(k).slice(1), batch.column(k).slice(0, n - 1)
                same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
                new[1:] |= ~same.to_numpy(zero_copy_only=False)
            at = np.arange(row, row + n)
            starts = np.maximum.accumulate(np.where(new, at, run_start if not new[0] else row))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), pa.array(at - starts + 1)], [*batch.schema.names, "_row", "_local"])
            row, last, run_start = row + n, tuple(batch.column(k)[n - 1] for k in keys), int(starts[-1])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    return placed.mapInArrow(run, f"{schema}, _row bigint, _local bigint")


def dense_numbers(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Numbers 1, 2, ... within each key by ``order``, without one task per
    key: rows are range-partitioned by key and order, numbered within each
    partition in one pass, and moved by what earlier partitions hold of the key.
    Writes a checkpoint, so both passes see the same partitions.  Only a key at
    a partition's start can go on from an earlier one, so the moves are one row
    for each partition at most."""
    use_checkpoints(df.sparkSession)
    by = [*keys, *order]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id()).checkpoint()
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))
    numbered = _local_numbers(placed, keys)
    # what a partition begins and ends with: a row for each partition
    ends = numbered.groupBy("_part").agg(F.max_by(F.struct(key.alias("key"), F.col("_local").alias("n")), F.col("_row")).alias("last"), F.min_by(key, F.col("_row")).alias("first"))
    so_far = F.sum("last.n").over(Window.partitionBy("last.key").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    in_order = Window.partitionBy(F.lit(0)).orderBy("_part")
    # a partition's first key goes on from the one before it, if that ends with the same key
    behind = ends.withColumn("upto", so_far).select(F.col("_part").alias("_at"), F.col("first").alias("_key"), F.lag("last.key").over(in_order).alias("earlier"), F.lag("upto").over(in_order).alias("_before"))
    moves = F.broadcast(behind.where(F.col("_key").eqNullSafe(F.col("earlier"))).drop("earlier"))  # a row for each partition at most
    joined = numbered.join(moves, (F.col("_part") == F.col("_at")) & key.eqNullSafe(F.col("_key")), "left")
    return joined.withColumn(name, (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("bigint")).drop("_part", "_row", "_local", "_at", "_key", "_before")


def partition_faults(whole: DataFrame, parts: DataFrame, key: str, part: str) -> DataFrame:
    """One row of counts: keys in no part, keys of no whole, keys in several."""
    w, p = whole.select(key).distinct(), parts.select(key, part).distinct()
    missing = w.join(p, key, "left_anti").agg(F.count("*").alias("n_missing"))
    extra = p.join(w, key, "left_anti").agg(F.count_distinct(key).alias("n_extra"))
    several = p.groupBy(key).count().where("count > 1").agg(F.count("*").alias("n_several"))
    return missing.crossJoin(extra).crossJoin(several)  # one row each


def jaccard_pairs(items: DataFrame, owner: str, item: str) -> DataFrame:
    """(a, b, n_a, n_b, n_both, jaccard) of owners that share items: exact set
    sizes.  Owners are few (tools, classes): items are grouped once, to the set
    of their owners, and all counts are sums over those sets."""
    held = items.groupBy(item).agg(F.array_sort(F.collect_set(owner)).alias("o")).groupBy("o").agg(F.count("*").alias("n"))
    pairs = held.select("n", "o", F.explode("o").alias("a")).select("n", "a", F.explode("o").alias("b")).where("a <= b").groupBy("a", "b").agg(F.sum("n").alias("n"))
    # a row for each pair of owners: their own sizes are on the diagonal
    sizes = F.map_from_entries(F.collect_list(F.when(F.col("a") == F.col("b"), F.struct("a", "n"))))
    every = pairs.agg(sizes.alias("sizes"), F.collect_list(F.when(F.col("a") < F.col("b"), F.struct("a", "b", "n"))).alias("pairs"))
    out = every.select("sizes", F.explode("pairs").alias("p")).select("p.a", "p.b", F.col("sizes")[F.col("p.a")].alias("n_a"), F.col("sizes")[F.col("p.b")].alias("n_b"), F.col("p.n").alias("n_both"))
    return out.withColumn("jaccard", F.col("n_both") / (F.col("n_a") + F.col("n_b") - F.col("n_both")))
