"""Digestion of many sequences at once, in Arrow batches.

A batch's sequences are one byte buffer; cuts, peptides, their distinct forms and
what they cover are found by array operations, so that no row and no residue is
looked at alone.  Sequences are letters of one byte; stops are left out before
the digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Sequence bytes that are digested at once.
BATCH_BYTES = 1 << 20
#: Letters of a k-mer that one number can hold, five bits each.
MOST_K = 12

_K, _R, _P, _STOP = (ord(c) for c in "KRP*")
# An odd base of rolling hashes and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def cut_batches(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Batches of about BATCH_BYTES; a longer row stays whole and alone."""
    for batch in batches:
        ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to


class Sequences:
    """A batch's sequences without stops: ``raw`` bytes and ``offsets``."""

    def __init__(self, column: pa.Array):
        flat = pc.fill_null(column.cast(pa.large_string()), "")
        _, off, data = flat.buffers()
        offsets = np.frombuffer(off, np.int64)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        kept = raw != _STOP
        if not kept.all():
            raw, offsets = raw[kept], np.concatenate([[0], np.cumsum(kept)])[offsets]
        self.raw, self.offsets, self.n = raw, offsets, len(flat)

    def fragments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, start, end) of the stretches between cuts, which are after K
        or R unless P follows."""
        cut = (self.raw == _K) | (self.raw == _R)
        cut[:-1] &= self.raw[1:] != _P
        some = np.flatnonzero(self.offsets[1:] > self.offsets[:-1])
        cut[self.offsets[1:][some] - 1] = True
        stop = np.flatnonzero(cut) + 1
        start = np.concatenate([[0], stop[:-1]]) if len(stop) else stop
        first = np.zeros(len(self.raw), bool)
        first[self.offsets[some]] = True
        return some[np.cumsum(first[start]) - 1], start, stop

    def texts(self, start: np.ndarray, length: np.ndarray) -> pa.Array:
        body = self.raw[ragged(start, length)]
        ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(body))])

    def peptides(self, missed: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """(owner, start, length, text) of each owner's distinct peptides."""
        owner, start, stop = self.fragments()
        found = []
        for k in range(missed + 1):
            n = max(0, len(owner) - k)
            i = np.flatnonzero(owner[:n] == owner[k:])
            length = stop[i + k] - start[i]
            i = i[(length >= least) & (length <= most)]
            found.append(np.column_stack([owner[i], start[i], stop[i + k] - start[i]]))
        rows = np.concatenate(found)
        texts = self.texts(rows[:, 1], rows[:, 2])
        coded = texts.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        _, first = np.unique(rows[:, 0] << 32 | codes, return_index=True)
        rows = rows[first]
        return rows[:, 0], rows[:, 1], rows[:, 2], coded.dictionary.take(pa.array(codes[first]))

    def covering(self, owner: np.ndarray, start: np.ndarray, length: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether some occurrence of each peptide in its owner's sequence, a
        tryptic one or not, covers the owner's 0-based position.  Occurrences
        are found by rolling hashes and compared letter by letter."""
        n = len(self.raw)
        up = np.cumprod(np.full(n, BASE, np.uint64)) if n else np.zeros(0, np.uint64)
        down = np.cumprod(np.full(n, INVERSE, np.uint64)) if n else np.zeros(0, np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * up)])
        hashes = lambda at, size: (sums[at + size] - sums[at]) * down[at]
        own = hashes(start, length)
        begin, end = self.offsets[owner], self.offsets[owner + 1]
        target = begin + position[owner]
        covered = np.zeros(len(owner), bool)
        for back in range(int(length.max(initial=0))):
            at = target - back
            open_ = np.flatnonzero(~covered & (back < length) & (at >= begin) & (at + length <= end))
            some = open_[hashes(at[open_], length[open_]) == own[open_]]
            if len(some):
                differ = self.raw[ragged(at[some], length[some])] != self.raw[ragged(start[some], length[some])]
                ends = np.cumsum(length[some])
                total = np.concatenate([[0], np.cumsum(differ)])
                covered[some[total[ends] == total[ends - length[some]]]] = True
        return covered


def schema_of(df: DataFrame, keep: list[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return "".join(f"`{c}` {kinds[c]}, " for c in keep)


def digested(df: DataFrame, seq: str, keep: list[str], missed: int = 2, least: int = 6, most: int = 50, position: str | None = None) -> DataFrame:
    """(keep..., peptide, spanning): a row for each distinct peptide of each
    row's sequence.  ``spanning``: whether an occurrence covers the 1-based
    ``position``; all do where there is none."""
    sent = [*keep, *(c for c in (seq, position) if c and c not in keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_batches(batches, seq):
            s = Sequences(batch.column(seq))
            owner, start, length, texts = s.peptides(missed, least, most)
            spanning = np.ones(len(owner), bool)
            if position:
                at = batch.column(position)
                given = pc.is_valid(at).to_numpy(zero_copy_only=False)
                places = pc.fill_null(at.cast(pa.int64()), 1).to_numpy(zero_copy_only=False) - 1
                some = np.flatnonzero(given[owner])
                spanning[some] = s.covering(owner[some], start[some], length[some], places)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in keep), texts.cast(pa.string()), pa.array(spanning)], [*keep, "peptide", "spanning"])

    return df.select(*sent).mapInArrow(run, schema_of(df, keep) + "peptide string, spanning boolean")


def digest_sizes(df: DataFrame, seq: str, keep: list[str], missed: int = 2, least: int = 6, most: int = 50) -> DataFrame:
    """(keep..., n_peptides, mean_length, longest) of the rows with a peptide."""
    sent = [*keep, *(c for c in [seq] if c not in keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_batches(batches, seq):
            s = Sequences(batch.column(seq))
            owner, _, length, _ = s.peptides(missed, least, most)
            n, total, top = np.bincount(owner, minlength=s.n), np.bincount(owner, length, s.n), np.zeros(s.n, np.int64)
            np.maximum.at(top, owner, length)
            some = np.flatnonzero(n)
            rows = pa.array(some)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in keep), pa.array(n[some], pa.int64()), pa.array(total[some] / n[some]), pa.array(top[some])], [*keep, "n_peptides", "mean_length", "longest"])

    return df.select(*sent).mapInArrow(run, schema_of(df, keep) + "n_peptides bigint, mean_length double, longest bigint")


def kmer_items(df: DataFrame, seq: str, owner: str, k: int) -> DataFrame:
    """(owner, item): k-mers of letters A to Z as numbers of five bits a letter,
    each once for an owner and batch."""
    if k > MOST_K:
        raise ValueError(f"k-mers of more than {MOST_K} letters don't fit a number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_batches(batches, seq):
            # an owner's texts stand side by side, so that its k-mers are one stretch; rows of no owner are left out
            batch = batch.filter(pc.is_valid(batch.column(owner)))
            codes = batch.column(owner).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            batch = batch.take(pa.array(np.argsort(codes, kind="stable")))
            s, codes = Sequences(batch.column(seq)), np.sort(codes)
            n = max(0, len(s.raw) - k + 1)
            items = np.zeros(n, np.int64)
            for j in range(k):
                items <<= 5
                items |= s.raw[j : j + n] - 64 & 31
            inside = np.ones(n, bool)
            over = (s.offsets[1:, None] - np.arange(1, k)).reshape(-1)  # these reach over a text's end
            inside[over[(over >= 0) & (over < n)]] = False
            bounds = np.flatnonzero(np.diff(codes, prepend=-1)).tolist()
            for row, to in zip(bounds, [*bounds[1:], len(codes)], strict=True):
                a, b = s.offsets[row], s.offsets[to]
                own = np.unique(items[a:b][inside[a:b]])
                yield pa.RecordBatch.from_arrays([batch.column(owner).take(pa.array(np.full(len(own), row))), pa.array(own)], [owner, "item"])
            del s, items, inside, over, batch
            pa.default_memory_pool().release_unused()

    return df.select(owner, seq).mapInArrow(run, schema_of(df, [owner]) + "item bigint")
