"""Peptides of many entries, met by their key in packed blocks.

Peptides that begin at one fragment are prefixes of one another, so an entry
sends the longest of them only: a run.  All peptides of equal key (I read as L)
have the same first letters, and go to the same bucket by those.  A task packs
its runs by bucket, sorted and compressed, with who has them; a bucket's blocks
are unpacked and its keys counted by array operations.  So no row is moved for a
peptide, and what is moved is a fraction of the peptides' letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .digestion import INVERSE, Sequences, cut_batches, ragged

#: Letters of runs that a task packs at once: more are written smaller, and take more memory.
PACK_BYTES = 24 << 20
#: Letters by which runs are dealt; letters of five bits that order a block, under as many bits of a bucket.
DEALT, ORDERED, MOST_BUCKETS = 8, 10, 1 << 13
_I, _L, _K, _R = (ord(c) for c in "ILKR")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[_I] = _L
_RESIDUE = np.zeros(256, np.uint8)
for _c in b"ACDEFGHIKLMNPQRSTVWY":
    _RESIDUE[_c] = _RESIDUE[_c + 32] = _c


@dataclass(frozen=True)
class Cut:
    """How proteins are cut, and among how many buckets their peptides are
    dealt; of ``passes`` over the entries one makes each bucket."""

    missed: int = 2
    least: int = 6
    most: int = 50
    buckets: int = 64
    passes: int = 1


def residues(text: pa.Array) -> pa.Array:
    """The residues among a text's letters, in upper case: ``protein_like`` by bytes."""
    flat = pc.fill_null(text.cast(pa.large_string()), "")
    _, off, data = flat.buffers()
    offsets = np.frombuffer(off, np.int64)[flat.offset : flat.offset + len(flat) + 1]
    raw = _RESIDUE[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data is not None and data.size else np.zeros(0, np.uint8)
    kept = np.flatnonzero(raw)
    return texts_of(raw[kept], np.searchsorted(kept, offsets - offsets[0]))


def texts_of(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])


def letters_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    s = Sequences(texts)
    return s.raw, s.offsets


def runs(s: Sequences, cut: Cut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, length) of the longest peptide that begins at each fragment."""
    owner, start, stop = s.fragments()
    length = np.zeros(len(owner), np.int64)
    for k in range(min(cut.missed + 1, len(owner))):
        i = np.flatnonzero(owner[: len(owner) - k] == owner[k:])
        reach = stop[i + k] - start[i]
        length[i] = np.where(reach <= cut.most, reach, length[i])
    some = np.flatnonzero(length >= max(1, cut.least))
    return owner[some], start[some], length[some]


def prefix_codes(raw: np.ndarray, start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """The first n letters as numbers of five bits a letter."""
    codes = np.zeros(len(start), np.uint64)
    for j in range(n):
        at = np.minimum(start + j, len(raw) - 1)
        codes = codes << np.uint64(5) | np.where(j < length, raw[at] & 31, 0).astype(np.uint64)
    return codes


def bucket_of(raw: np.ndarray, start: np.ndarray, length: np.ndarray, cut: Cut) -> np.ndarray:
    n = min(max(1, cut.least), DEALT)
    codes = prefix_codes(_FOLD[raw], start, length, n) + np.uint64(1)
    mixed = codes * np.uint64(INVERSE)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(INVERSE)
    return ((mixed >> np.uint64(32)) % np.uint64(cut.buckets)).astype(np.int64)


def _slim(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes as the largest needs, by place of
    the byte: the number of bytes, then those."""
    top = int(values.max(initial=0))
    width = max(1, (top.bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _wide(data: memoryview, n: int) -> np.ndarray:
    width = data[0]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, width * n, 1).reshape(width, n).T
    return out.view("<u8").reshape(-1).astype(np.int64)


def _stored(values: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("x", values.type)])) as out:
        out.write_batch(pa.record_batch([values], ["x"]))
    return sink.getvalue().to_pybytes()


def _read(data: memoryview) -> pa.Array:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all().column(0).combine_chunks()


def packed(parts: list[bytes]) -> bytes:
    """Parts, compressed each for itself, with their sizes before and after."""
    made = [pa.compress(p, "zstd", asbytes=True) for p in parts]
    return np.array([len(parts), *map(len, parts), *map(len, made)], "<u4").tobytes() + b"".join(made)


def unpacked(data: bytes) -> list[memoryview]:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    sizes = np.frombuffer(data, "<u4", 2 * n, 4).astype(np.int64)
    ends = 4 + 8 * n + np.concatenate([[0], np.cumsum(sizes[n:])])
    return [memoryview(pa.decompress(memoryview(data)[ends[i] : ends[i + 1]], int(sizes[i]), "zstd")) for i in range(n)]


def _blocks(held: list[tuple], cut: Cut) -> Iterator[tuple[int, bytes]]:
    """(bucket, block) of what a task holds: each text of a run once, with its owners."""
    raw, lengths, buckets, rows = (np.concatenate([h[i] for h in held]) for i in range(4))
    ids, groups = (pa.concat_arrays([h[i] for h in held]) for i in (4, 5))
    first = np.cumsum([0, *(len(h[4]) for h in held[:-1])])
    rows = rows + np.repeat(first, [len(h[3]) for h in held])
    coded = texts_of(raw, np.concatenate([[0], np.cumsum(lengths)])).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    own = np.zeros(len(coded.dictionary), np.int64)
    own[codes] = buckets
    raw, offsets = letters_of(coded.dictionary)
    order = np.argsort(own.astype(np.uint64) << np.uint64(5 * ORDERED) | prefix_codes(raw, offsets[:-1], np.diff(offsets), ORDERED), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    pairs = np.sort(rank[codes] << 32 | rows)
    pairs = pairs[np.flatnonzero(np.diff(pairs, prepend=-1))]
    run, row = pairs >> 32, pairs & 0xFFFFFFFF
    own, start, length = own[order], offsets[:-1][order], np.diff(offsets)[order]
    owners = np.bincount(run, minlength=len(order))
    upto = np.concatenate([[0], np.cumsum(owners)])
    names = groups.dictionary_encode()
    name = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    whole = pa.types.is_integer(ids.type) and not ids.null_count
    number = ids.cast(pa.int64()).to_numpy(zero_copy_only=False) if whole else None
    bounds = np.flatnonzero(np.diff(own, prepend=-1)).tolist()
    for a, b in zip(bounds, [*bounds[1:], len(own)], strict=True):
        who = row[upto[a] : upto[b]]
        if number is not None and int(number[who].max()) - (low := int(number[who].min())) < 1 << 62:
            told = b"n" + np.int64(low).tobytes() + _slim(number[who] - low)
        else:
            told = b"a" + _stored(ids.take(pa.array(who)))
        seen, at = np.unique(name[who], return_inverse=True)
        yield int(own[a]), packed([raw[ragged(start[a:b], length[a:b])].tobytes(), _slim(length[a:b]), _slim(owners[a:b]), told, _stored(names.dictionary.take(pa.array(seen))) if len(seen) else b"", _slim(at), np.array([b - a, len(who)], "<i8").tobytes()])


def packed_runs(df: DataFrame, text: str, cut: Cut, turn: int, owner: str | None = None, group: str | None = None) -> DataFrame:
    """(bucket, known, block): the runs of texts, by bucket, of the buckets of
    this ``turn``.  Texts without an owner are known proteins."""
    sent = [F.col(text).cast("string").alias("_text"), *([F.col(owner).alias("_id"), F.col(group).alias("_group")] if owner and group else [])]
    known = owner is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def told() -> Iterator[pa.RecordBatch]:
            for bucket, block in _blocks(held, cut):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([known]), pa.array([block], pa.binary())], ["bucket", "known", "block"])

        for batch in cut_batches(batches, "_text"):
            s = Sequences(residues(batch.column("_text")))
            row, start, length = runs(s, cut)
            bucket = bucket_of(s.raw, start, length, cut) if len(row) else row
            mine = np.flatnonzero(bucket % cut.passes == turn)
            if not len(mine):
                continue
            none = pa.nulls(batch.num_rows, pa.int64()), pa.nulls(batch.num_rows, pa.string()).fill_null("")
            ids, groups = none if known else (batch.column("_id"), batch.column("_group"))
            held.append((s.raw[ragged(start[mine], length[mine])], length[mine], bucket[mine], np.zeros(len(mine), np.int64) if known else row[mine], ids, groups.cast(pa.string())))
            size += int(length[mine].sum())
            if size >= PACK_BYTES:
                yield from told()
                held, size = [], 0
        if held:
            yield from told()

    return df.select(*sent).mapInArrow(run, "bucket int, known boolean, block binary")


@dataclass
class Unpacked:
    """The runs of blocks, and the owners and groups of each; a run's are those
    from ``upto`` of it to that of the next."""

    raw: np.ndarray
    offsets: np.ndarray
    upto: np.ndarray
    ids: pa.Array
    groups: pa.Array


def unpack(blocks: list[bytes], kind: pa.DataType) -> Unpacked:
    raws, lengths, many, ids, groups = [], [], [], [], []
    for block in blocks:
        raw, length, owners, told, names, at, sizes = unpacked(block)
        n, m = (int(x) for x in np.frombuffer(sizes, "<i8"))
        raws.append(np.frombuffer(raw, np.uint8))
        lengths.append(_wide(length, n))
        many.append(_wide(owners, n))
        ids.append(pa.array(_wide(told[9:], m) + int(np.frombuffer(told[1:9], np.int64)[0])).cast(kind) if told[:1] == b"n" else _read(told[1:]).cast(kind))
        groups.append(_read(names).take(pa.array(_wide(at, m))))
    ends = lambda sizes: np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    return Unpacked(np.concatenate(raws), ends(lengths), ends(many), pa.concat_arrays(ids), pa.concat_arrays(groups))


def peptides_of(raw: np.ndarray, offsets: np.ndarray, cut: Cut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, start, length) of the peptides that runs begin with."""
    run, _, stop = Sequences(texts_of(raw, offsets)).fragments()
    length = stop - offsets[run]
    some = np.flatnonzero((length >= max(1, cut.least)) & (length <= cut.most))
    return run[some], offsets[run[some]], length[some]


def decoys(texts: pa.Array) -> pa.Array:
    """Each tryptic fragment reversed, a last K or R in its place."""
    s = Sequences(texts)
    _, start, stop = s.fragments()
    last = s.raw[stop - 1] if len(stop) else s.raw
    stays = (last == _K) | (last == _R)
    turned = np.repeat(start + stop - 1 - stays, stop - start) - np.arange(len(s.raw))
    turned[stop[stays] - 1] = stop[stays] - 1
    return texts_of(s.raw[turned], s.offsets)


def first_entries(own: list[bytes], known: list[bytes], kind: pa.DataType, cut: Cut) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array, np.ndarray]:
    """(group, k, peptide, entry_id, n_entries) of the keys that no known
    protein has, by group and key: the least (entry, peptide, group) of each."""
    x = unpack(own, kind)
    run, start, length = peptides_of(x.raw, x.offsets, cut)
    size = np.concatenate([[0], np.cumsum(length)])
    raw = x.raw[ragged(start, length)]
    keys = texts_of(_FOLD[raw], size).dictionary_encode()
    code = keys.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    fresh = np.ones(len(keys.dictionary), bool)
    if known:
        r = unpack(known, pa.int64())
        _, at, n = peptides_of(r.raw, r.offsets, cut)
        fresh = ~pc.is_in(keys.dictionary, texts_of(_FOLD[r.raw[ragged(at, n)]], np.concatenate([[0], np.cumsum(n)]))).to_numpy(zero_copy_only=False)
    # ids by their order, null before all
    distinct = x.ids.dictionary_encode()
    order = pc.sort_indices(distinct.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    place = pc.fill_null(distinct.indices, -1).to_numpy(zero_copy_only=False)
    who = np.where(place < 0, 0, rank[place]) if len(rank) else np.zeros(len(place), np.int64)
    # a row for each peptide and owner
    kept = np.flatnonzero(fresh[code])
    many = x.upto[run[kept] + 1] - x.upto[run[kept]]
    pair, peptide = ragged(x.upto[run[kept]], many), np.repeat(kept, many)
    key = code[peptide] << 32 | who[pair]
    by = np.argsort(key)
    key = key[by]
    new = np.flatnonzero(np.diff(key, prepend=-1))  # of each key and entry
    heads = new[np.flatnonzero(np.diff(key[new] >> 32, prepend=-1))]  # of each key: its least entry
    counts = np.diff(np.searchsorted(new, [*heads, len(key)]))
    ends = np.concatenate([new, [len(key)]])[np.searchsorted(new, heads) + 1]
    win = by[heads]
    tied = np.flatnonzero(ends - heads > 1)
    if len(tied):
        texts, rows = texts_of(raw, size), by[ragged(heads[tied], (ends - heads)[tied])]
        table = pa.table({"k": np.repeat(tied, (ends - heads)[tied]), "p": texts.take(pa.array(peptide[rows])), "g": x.groups.take(pa.array(pair[rows])), "row": rows}).sort_by([("k", "ascending"), ("p", "ascending"), ("g", "ascending")])
        k = table.column("k").to_numpy()
        win[tied] = table.column("row").to_numpy()[np.flatnonzero(np.diff(k, prepend=-1))]
    group, entry, at = x.groups.take(pa.array(pair[win])), x.ids.take(pa.array(pair[win])), peptide[win]
    k = keys.dictionary.take(pa.array(key[heads] >> 32))
    order = pc.sort_indices(pa.table({"g": group, "k": k}), [("g", "ascending"), ("k", "ascending")])
    at = at[order.to_numpy()]
    texts = texts_of(raw[ragged(size[at], length[at])], np.concatenate([[0], np.cumsum(length[at])]))
    return group.take(order), k.take(order), texts, entry.take(order), counts[order.to_numpy()]


def met(runs: DataFrame, kind: str, id_type: pa.DataType, cut: Cut) -> DataFrame:
    """(k, peptide, entry_id, n_entries, proteotypic, decoy, group): a row for
    each key of entries that no known protein has."""

    def one(table: pa.Table) -> pa.Table:
        known = table.column("known").to_numpy()
        blocks = table.column("block").to_pylist()
        own, others = [b for b, k in zip(blocks, known, strict=True) if not k], [b for b, k in zip(blocks, known, strict=True) if k]
        group, k, peptide, entry, n = first_entries(own, others, id_type, cut) if own else (pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], id_type), np.zeros(0, np.int64))
        out = pa.table({"k": k.cast(pa.string()), "peptide": peptide.cast(pa.string()), "entry_id": entry, "n_entries": pa.array(n, pa.int64()), "proteotypic": pa.array(n == 1), "decoy": decoys(peptide).cast(pa.string()), "group": group})
        pa.default_memory_pool().release_unused()
        return out

    return runs.groupBy("bucket").applyInArrow(one, f"k string, peptide string, entry_id {kind}, n_entries bigint, proteotypic boolean, decoy string, `group` string")
