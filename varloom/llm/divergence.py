"""How sources of a language differ in their words: exact shares by integers.

A pass over the texts gives counts of terms by language and source, summed in
each task before anything is shuffled.  Terms of enough documents are dealt to
partitions of the dictionary; such a partition is a sorted array of kept terms,
whose positions are the ids of its terms (``searchsorted``), so that ids keep
the order of UTF-8 bytes.  Counts become one dense vector a group (``bincount``
over group and id), and distances, the best terms and their ties are read off
the vectors.

The share of a term is p = 1 + floor(10^9 * (count + 5) / (N + 5 V)), found by
long division in steps of a thousand, exact while a language has fewer than
9 * 10^15 terms.

Cases: null text, language and source are empty ones; every row counts as a
document, so repeated rows count each; a source without terms is a group; a
language without kept terms has distances of 0 and no terms; equal values are
ranked by the item's UTF-8 bytes; an empty table gives an empty result; further
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, byte_table, flat_text, give_back, slices, use_checkpoints

#: Terms are ASCII letters and all characters beyond ASCII.
LETTERS = byte_table(True, [*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
SCALE, PRIOR = 10**9, 5
#: Documents that a term of a language needs, and ranks of terms that are told.
LEAST_DOCS, TOP = 30, 50
#: Numbers in the vectors of one partition of the dictionary, and rows of counts that a task holds.
CELLS, HELD_ROWS = 1 << 17, 1 << 18


def shares(counts: np.ndarray, total: int | np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 5) / (total + 5 * kept)), in 64 bits."""
    whole = np.asarray(total, np.int64) + PRIOR * kept
    quotient, rest = np.divmod(counts + PRIOR, whole)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + more
    return quotient + 1


def counted(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of the batch's texts; a row of a null
    term for each group."""
    texts = flat_text(batch.column("text"))
    words = Words(texts, LETTERS)
    groups = pa.table({"lang": batch.column("lang"), "source": batch.column("source"), "i": pa.array(np.arange(len(texts)))}).group_by(["lang", "source"]).aggregate([("i", "list")])
    of_doc = np.empty(len(texts), np.int64)
    of_doc[groups["i_list"].combine_chunks().flatten().to_numpy()] = np.repeat(np.arange(len(groups)), pc.list_value_length(groups["i_list"]).to_numpy())
    size = max(len(words.vocabulary), 1)
    doc = np.repeat(np.arange(len(texts)), words.counts)
    held = np.unique(doc * size + words.codes)
    keys, n = np.unique(of_doc[doc] * size + words.codes, return_counts=True)
    docs = np.unique(of_doc[held // size] * size + held % size, return_counts=True)[1]
    lang, source = groups["lang"].combine_chunks(), groups["source"].combine_chunks()
    at = pa.array(np.concatenate([keys // size, np.arange(len(groups))]))
    none = np.zeros(len(groups), np.int64)
    terms = pa.concat_arrays([words.vocabulary.take(pa.array(keys % size)).cast(pa.string()), pa.nulls(len(groups), pa.string())])
    return pa.table({"lang": lang.take(at), "source": source.take(at), "term": terms, "n": pa.array(np.concatenate([n, none])), "docs": pa.array(np.concatenate([docs, none]))})


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts, summed; a task that meets very many terms
    gives what it holds in between."""
    held: list[pa.Table] = []

    def summed() -> pa.Table:
        both = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return both.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])

    for batch in slices(batches, "text", 1 << 20):
        held.append(counted(batch))
        if sum(map(len, held)) > HELD_ROWS:
            held = [summed()]
            if len(held[0]) > HELD_ROWS // 2:
                yield from held.pop().to_batches(1 << 14)
                give_back()
    if held:
        yield from summed().to_batches(1 << 14)


def vectors(terms: np.ndarray, kept: np.ndarray, group: np.ndarray, n: np.ndarray, groups: int) -> np.ndarray:
    """Counts by group and id; an id is the term's position among the kept
    ones.  Sums of floats are exact below 2^53."""
    ids = np.searchsorted(kept, terms)
    return np.bincount(group * len(kept) + ids, weights=n, minlength=groups * len(kept)).astype(np.int64).reshape(groups, len(kept))


def compared(left: pa.Table, right: pa.Table) -> pa.Table:
    """Distances and best terms of one partition of a language's dictionary:
    ``left`` has the counts (term, source, n), ``right`` the language's groups
    (_source, total, all_total, _kept)."""
    right = right.sort_by("_source")
    names = right["_source"].combine_chunks().cast(pa.string())
    total, all_total, v = right["total"].to_numpy(), int(right["all_total"][0].as_py()), int(right["_kept"][0].as_py())
    lang = right["_lang"][0].as_py()
    parts: list[tuple[np.ndarray, str, pa.Array, np.ndarray]] = []
    if len(left):
        # bytes compare as UTF-8 does, and numpy's own strings don't
        coded = left["term"].combine_chunks().dictionary_encode()
        distinct = np.array([x.encode() for x in coded.dictionary.to_pylist()], object)
        kept = np.sort(distinct)
        group = pc.index_in(left["source"].combine_chunks().cast(pa.string()), names).to_numpy(zero_copy_only=False).astype(np.int64)
        counts = vectors(distinct[coded.indices.to_numpy()], kept, group, left["n"].to_numpy(), len(names))
        p = shares(counts, total[:, None], v)
        q = shares(counts.sum(axis=0), all_total, v)
        text = pa.array([x.decode() for x in kept], pa.string())
    else:
        p = np.zeros((len(names), 0), np.int64)
    others = np.arange(len(names))
    for g in range(len(names)):
        far = np.abs(p - p[g]).sum(axis=1)
        mine = others[others != g]
        parts.append((np.full(len(mine), g), "pair", names.take(pa.array(mine)), far[mine]))
        if p.shape[1]:
            more = np.flatnonzero((counts[g] > 0) & (p[g] > q))
            value = p[g][more] - q[more]
            best = np.lexsort((more, -value))[:TOP]
            parts.append((np.full(len(best), g), "term", text.take(pa.array(more[best])), value[best]))
    size = [len(x[0]) for x in parts]
    return pa.table({
        "lang": pa.array([lang] * sum(size), pa.string()), "source": names.take(pa.array(np.concatenate([x[0] for x in parts]))),
        "part": pa.array([x[1] for x, n in zip(parts, size, strict=True) for _ in range(n)], pa.string()),
        "item": pa.concat_arrays([x[2] for x in parts]), "value": pa.array(np.concatenate([x[3] for x in parts]), pa.int64()),
    })


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank): of every source of a language
    its distance from each other source, and the terms it has more of than the
    language has, the first ``top`` of them (at most 50)."""
    if not 0 < top <= TOP:
        raise ValueError(f"top: 1 to {TOP}")
    use_checkpoints(df.sparkSession)
    empty = F.lit("")
    rows = df.select(*(F.coalesce(F.col(f"`{c}`"), empty).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counts = rows.mapInArrow(term_counts, "lang string, source string, term string, n bigint, docs bigint")
    # one shuffle: rows of a term and language meet, so both sums stay where they are
    by_source = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("counts"), F.sum("docs").alias("docs"))
    kept = by_term.where((F.col("docs") >= least_docs) | F.col("term").isNull()).select("lang", "term", "counts").checkpoint()

    flat = kept.select("lang", "term", F.inline("counts"))
    groups = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = Window.partitionBy("lang")
    sizes = kept.groupBy("lang").agg(F.count("term").alias("kept"))
    # so many partitions of the dictionary that the vectors of one are of bounded size
    groups = groups.join(sizes, "lang").withColumn("all_total", F.sum("total").over(of_lang)).withColumn("sources", F.count("*").over(of_lang))
    groups = groups.withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("sources") / F.lit(cells))).cast("long")).checkpoint()
    chunks = groups.groupBy("lang").agg(F.first("chunks").alias("chunks"))
    left = flat.where(F.col("term").isNotNull()).join(chunks, "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("chunks")).alias("chunk"), "term", "source", "n")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("_chunk")
    right = groups.select(F.col("lang").alias("_lang"), every, F.col("source").alias("_source"), "total", "all_total", F.col("kept").alias("_kept"))
    found = left.groupBy("lang", "chunk").cogroup(right.groupBy("_lang", "_chunk")).applyInArrow(compared, "lang string, source string, part string, item string, value bigint")

    # parts of a distance are summed; a term stands in one partition of the dictionary only
    values = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return values.withColumn("rank", order).where((F.col("part") == "pair") | (F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
