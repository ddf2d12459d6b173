"""Benchmark decontamination: a prefix-filtered set join, verified exactly.

Each benchmark item becomes windows of ``width`` consecutive words (one shorter
window if it has fewer).  A document holds a window only if it holds all its
words, so it is enough to join on the necessary prefix of a window's words
ordered by rarity, which for containment is the rarest one.  Rarity is counted
over all documents.  Where a prefix word occurs in a document, the positional
bound puts a window's start at the occurrence minus the word's place in it, once
for each place and length that windows of this prefix have and not for each
window; the length bound drops starts from which nothing of that length fits in
the document; the words from there are looked up by their hash among the group's
windows, and what is found is verified word by word.

The benchmark's windows go to the tasks in groups of items of at most
``most_words`` words each, so what the driver holds and ships at once has a bound
that does not depend on the benchmark's size (one group for benchmarks of up to a
million words, and the only one).  Documents are read once for each group; with
several, the rows are numbered and written, each group's hits are written before
the next group is made, and only hits are shuffled and joined to their rows.

Cases: null or empty texts have no words; an item without words has no window;
a document without words is clean; equal items all count; very long texts are
whole; an empty benchmark leaves every document clean; an empty table gives an
empty one; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORDLIKE, Words, carry, mix, slices, use_checkpoints

#: Words of a window, and words of the items that one pass over the documents takes along.
WIDTH, MOST_WORDS = 10, 1_000_000


def item_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORDLIKE).split()


def grouped_items(bench: DataFrame, item_col: str, text_col: str, most_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items with their words, in groups of bounded size; the driver holds one
    group and one partition of the benchmark at a time."""
    group: list[tuple[str, list[bytes]]] = []
    held = 0
    for row in bench.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        words = item_words(row["t"])
        if not words:
            continue
        if held and held + len(words) > most_words:
            yield group
            group, held = [], 0
        group.append((row["i"], words))
        held += len(words)
    if group:
        yield group


class WindowIndex:
    """Windows of a group of items under the rarest word of each."""

    def __init__(self, items: list[tuple[str, list[bytes]]], frequency: dict[bytes, int], width: int):
        self.word_ids: dict[bytes, int] = {}
        number = self.word_ids
        windows: dict[tuple[int, ...], list[int]] = {}
        self.names = [name for name, _ in items]
        for i, (_, words) in enumerate(items):
            ids = [number.setdefault(w, len(number)) for w in words]
            for at in range(max(1, len(ids) - width + 1)):
                windows.setdefault(tuple(ids[at : at + width]), []).append(i)
        counts = np.array([frequency.get(w, 0) for w in number], np.int64)
        rows = list(windows)
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.words = np.full((len(rows), width), -1, np.int64)
        for k, r in enumerate(rows):
            self.words[k, : len(r)] = r
        # order by rarity, ties by word number: the first of that order is the prefix
        rarity = np.where(self.words >= 0, counts[self.words] * (len(number) + 1) + self.words, np.iinfo(np.int64).max)
        place = rarity.argmin(axis=1)
        prefix = self.words[np.arange(len(rows)), place]
        # where a window may start around its prefix word: (place, length), each once for a word
        shapes = np.unique(np.column_stack([prefix, place, self.lengths]), axis=0) if len(rows) else np.zeros((0, 3), np.int64)
        self.places, self.sizes = shapes[:, 1], shapes[:, 2]
        self.starts = np.searchsorted(shapes[:, 0], np.arange(len(number) + 1))
        self.by_hash, seed = np.zeros(0, np.int64), 0
        while len(self.by_hash) < len(rows) or not seed:
            # windows are distinct, so equal hashes are chance: another draw ends it
            draw = np.random.Generator(np.random.PCG64(seed))
            self.word_codes = draw.integers(0, 2**63, len(number) + 1, np.uint64)
            self.place_codes = draw.integers(0, 2**63, width, np.uint64) * np.uint64(2) + np.uint64(1)
            hashes = self.hashes(self.words.T)
            self.window_hashes, self.by_hash = np.unique(hashes, return_index=True)
            seed += 1
        self.owners = [np.array(sorted(set(windows[r])), np.int64) for r in rows]

    def hashes(self, columns: Iterable[np.ndarray]) -> np.ndarray:
        """Hashes of runs of words, given as word numbers by place; -1 is no word."""
        total = None
        for word, code in zip(columns, self.place_codes, strict=False):
            part = np.where(word < 0, np.uint64(0), mix(self.word_codes[word] * code))
            total = part if total is None else total + part
        return total

    def find(self, texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
        """(words of the texts, window starts among those words, windows)."""
        words = Words(texts, WORDLIKE)
        if not len(words.codes):
            return words, np.zeros(0, np.int64), np.zeros(0, np.int64)
        number = self.word_ids
        known = np.fromiter((number.get(w, -1) for w in words.vocabulary.cast(pa.large_binary()).to_pylist()), np.int64, len(words.vocabulary))
        flat = known[words.codes]
        n_at = np.diff(self.starts)
        at = np.flatnonzero(flat >= 0)
        at = at[n_at[flat[at]] > 0]
        text_of = np.searchsorted(words.offsets, at, "right") - 1
        first, last = words.offsets[text_of], words.offsets[text_of + 1]
        found_at, found_window = [], []
        for k in range(int(n_at.max(initial=0))):
            # at most one turn for each place and length
            some = n_at[flat[at]] > k
            at, first, last = at[some], first[some], last[some]
            shape = self.starts[flat[at]] + k
            begin, size = at - self.places[shape], self.sizes[shape]
            fits = (begin >= first) & (begin + size <= last)
            begin, size = begin[fits], size[fits]
            if not len(begin):
                continue
            runs = [np.where(j < size, flat[np.minimum(begin + j, len(flat) - 1)], -1) for j in range(self.words.shape[1])]
            hashes = self.hashes(runs)
            there = np.minimum(np.searchsorted(self.window_hashes, hashes), len(self.window_hashes) - 1)
            window = self.by_hash[there]
            same = self.window_hashes[there] == hashes
            for j, run in enumerate(runs):
                same &= self.words[window, j] == run
            found_at.append(begin[same])
            found_window.append(window[same])
        if not found_at:
            return words, np.zeros(0, np.int64), np.zeros(0, np.int64)
        return words, np.concatenate(found_at), np.concatenate(found_window)


def word_frequency(docs: DataFrame, text_col: str, wanted: set[bytes]) -> dict[bytes, int]:
    """In how many slices' worth of documents the wanted words occur: counts
    over all documents, of the words of one group of items only."""
    numbered = {w: i for i, w in enumerate(sorted(wanted))}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(numbered), np.int64)
        for batch in slices(batches, "_text"):
            words = Words(batch.column("_text"), WORDLIKE)
            ids = np.fromiter((numbered.get(w, -1) for w in words.vocabulary.cast(pa.large_binary()).to_pylist()), np.int64, len(words.vocabulary))
            n = np.bincount(words.codes, minlength=len(ids))
            np.add.at(total, ids[ids >= 0], n[ids >= 0])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["w", "n"])

    rows = docs.select(F.col(text_col).alias("_text")).mapInArrow(count, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")).collect()
    names = sorted(wanted)
    return {names[r["w"]]: r["n"] for r in rows}


HITS = "n_words bigint, hits array<struct<first:bigint,last:bigint>>, items array<string>"


def find_windows(spark: SparkSession, docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", bench_text: str = "text", width: int = WIDTH, most_words: int = MOST_WORDS, keep: list[str] | None = None) -> DataFrame:
    """(id_col, [keep], n_words, hits, items) for each document: the word
    ranges that windows cover, merged, and the items they come from."""
    rows, names, own, text, schema = carry(docs, id_col, text_col, keep)
    listed = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def marked(rows: DataFrame, items: list[tuple[str, list[bytes]]], names: list[str], schema: str) -> DataFrame:
        """The rows with the hits of a group's windows."""
        frequency = word_frequency(rows, text, {w for _, ws in items for w in ws}) if items else {}
        shared = spark.sparkContext.broadcast(WindowIndex(items, frequency, width))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in slices(batches, text):
                words, begin, window = index.find(batch.column(text))
                n = batch.num_rows
                hits: list[list[dict]] = [[] for _ in range(n)]
                owners: list[list[str]] = [[] for _ in range(n)]
                order = np.argsort(begin, kind="stable")
                begin, window = begin[order], window[order]
                text_of = np.searchsorted(words.offsets, begin, "right") - 1
                for lo, hi in zip(*_runs(text_of), strict=True):
                    i = int(text_of[lo])
                    base = int(words.offsets[i])
                    for a, b in _merged(begin[lo:hi] - base, begin[lo:hi] - base + index.lengths[window[lo:hi]]):
                        hits[i].append({"first": a, "last": b})
                    found = np.unique(np.concatenate([index.owners[k] for k in np.unique(window[lo:hi])]))
                    owners[i] = [index.names[k] for k in found]
                kept = [batch.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(words.counts, pa.int64()), pa.array(hits, listed), pa.array(owners, pa.list_(pa.string()))], [*names, "n_words", "hits", "items"])

        return rows.mapInArrow(run, schema + HITS)

    groups = grouped_items(bench, item_col, bench_text, most_words)
    group, following = next(groups, []), next(groups, None)
    if following is None:
        out = marked(rows, group, names, schema)
    else:
        use_checkpoints(spark)
        numbered = rows.withColumn("_n", F.monotonically_increasing_id()).checkpoint()
        found: DataFrame | None = None
        counted: DataFrame | None = None
        while group:
            part = marked(numbered.select("_n", text), group, ["_n"], "_n bigint, ")
            # the words are counted once; of each group only hits are kept
            written = (part if counted is None else part.where("size(hits) > 0")).checkpoint()
            counted = written.select("_n", "n_words") if counted is None else counted
            hit = written.where("size(hits) > 0").select("_n", "hits", "items")
            found = hit if found is None else found.unionByName(hit)
            group, following = following, next(groups, None)
        united = found.groupBy("_n").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        none = lambda name, kind: F.coalesce(name, F.array().cast(kind)).alias(name)
        out = numbered.join(counted, "_n").join(united, "_n", "left").select(*names, "n_words", none("hits", "array<struct<first:bigint,last:bigint>>"), none("items", "array<string>"))
    return out.select(*(F.col(n).alias(c) for c, n in zip(own, names, strict=True)), "n_words", "hits", "items")


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(values)]])


def _merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Ranges ordered by their start, united where they touch."""
    out: list[tuple[int, int]] = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def covered(hits: str = "hits") -> Column:
    """How many words the ranges cover: overlapping ranges count once."""
    order = F.array_sort(F.col(hits))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    step = lambda s, r: F.struct((s.n + F.greatest(F.lit(0).cast("long"), r["last"] - F.greatest(r["first"], s.to))).alias("n"), F.greatest(s.to, r["last"]).alias("to"))
    return F.aggregate(order, start, step, lambda s: s.n)
