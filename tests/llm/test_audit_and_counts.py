"""The divergence audit and the token counts against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from varloom.llm import divergence, queries, token_counts

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def audited(rows, least=30, top=50):
    """The contract, by dictionaries and Python's integers."""
    docs = [(lang or "", source or "", TERM.findall(lower(text or ""))) for lang, source, text in rows]
    found = defaultdict(set)
    for lang in {d[0] for d in docs}:
        df = Counter(t for x in docs if x[0] == lang for t in set(x[2]))
        kept = [t for t, n in df.items() if n >= least]
        counts = defaultdict(Counter)
        for x in docs:
            if x[0] == lang:
                counts[x[1]].update(t for t in x[2] if df[t] >= least)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        for s in counts:
            parts = {"pair": [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s], "term": [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                found[lang, s, part] = [(item, value) for value, item in items[: None if part == "pair" else top]]
    return {k: v for k, v in found.items() if v}


def as_lists(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out[r["lang"], r["source"], r["part"]].append((r["item"], r["value"]))
        assert r["rank"] == len(out[r["lang"], r["source"], r["part"]])
    return dict(out)


SCHEMA = "lang string, source string, text string"


def test_audit_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [*"abcdefghij", "é", "É", "ﬀ", "𝒳", "zz", "Word", "Aé", "日本", ""]
    rows = []
    for i in range(700):
        n = int(rng.integers(0, 25))
        text = " ".join(rng.choice(words, n)) if i % 11 else ("0 - _ 9" if i % 2 else None)
        # one source holds a third of all rows
        rows.append((["xx", "yy", None][i % 3 % 2 if i % 50 else 2], "hot" if i % 3 == 0 else [f"s{i % 7}", None, "ﬀ", "𝒳"][i % 4], text))
    rows += rows[:40]
    rows += [("few", "a", "only three words"), ("few", "b", "only three words"), ("one", "", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = audited(rows)
    assert as_lists(divergence.audit(df)) == want
    assert want["few", "a", "pair"] == [("b", 0)] and ("few", "a", "term") not in want
    # many partitions of the dictionary give the same
    assert as_lists(divergence.audit(df, cells=16)) == want
    assert as_lists(divergence.audit(df, least_docs=1, top=3)) == audited(rows, 1, 3)


def test_audit_of_odd_tables(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [("x", s, "long " * 60_000 + "w" * 100_000) for s in "ab" for _ in range(20)]
    odd = spark.createDataFrame([(*r, "t", 1, 2, 3) for r in rows], SCHEMA + ", term string, n int, docs int, chunk int")
    assert as_lists(divergence.audit(odd)) == audited(rows)
    with pytest.raises(ValueError):
        divergence.audit(odd, top=51)


def test_task_counts_are_given_in_between(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_ROWS", 20)
    rows = [("l", f"s{i % 3}", " ".join(f"t{chr(97 + (i * k) % 23)}" for k in range(9))) for i in range(200)]
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "source": [r[1] for r in rows], "text": [r[2] for r in rows]})
    given = list(divergence.term_counts(batch.slice(i, 10) for i in range(0, 200, 10)))
    n, docs = Counter(), Counter()
    for r in pa.Table.from_batches(given).to_pylist():
        n[r["source"], r["term"]] += r["n"]
        docs[r["source"], r["term"]] += r["docs"]
    assert len(given) > 1
    assert {k: v for k, v in n.items() if k[1]} == Counter((r[1], t) for r in rows for t in r[2].split())
    assert {k: v for k, v in docs.items() if k[1]} == Counter((r[1], t) for r in rows for t in set(r[2].split()))


def test_shares_are_exact():
    counts = np.array([0, 1, 10**12, 8 * 10**15 - 7], np.int64)
    for total, kept in ((8 * 10**15, 4), (9 * 10**15 - 10**6, 10**5)):
        assert divergence.shares(counts, total, kept).tolist() == [1 + 10**9 * (int(c) + 5) // (total + 5 * kept) for c in counts]


LONG = ["the quick brown fox, 12 of them. " * 3_000, "日本語のテキスト" * 9_000, " " * 30_000, "x" * 30_000 + " y", "a\n\n\n  b\tc" * 8_000, ("ab▁cd ▁ ▁▁x" * 4_000), "🙂👍🏽 z‍é" * 5_000, "".join(map(chr, range(32, 2_000))) * 9]
ODD = [None, "", " ", "  a", "<s>x</s><unk>", "a\x00b", "▁", "é", "　x", "\r\n"]


def test_token_counts_equal_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(None if i == 3 else i, t, "x", 7, i) for i, t in enumerate([*ODD, *LONG])] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _text string, n_tokens int, _row int")
    want = Counter((r[0], len((r[1] or "").encode()), len(sp.encode(r[1] or ""))) for r in rows)
    for sizes in ({}, {"chunk": 7}, {"chunk": 100, "spread": 500}, {"spread": 2}):
        assert Counter(tuple(r) for r in token_counts.count_tokens(df, MODEL, **sizes).collect()) == want
    assert token_counts.count_tokens(df.limit(0), MODEL).collect() == []


def test_safe_boundaries():
    c = token_counts.Counter.of(MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = np.random.default_rng(2)
    signs = list("aetnos  \n.,1é▁日_-") + ["the", " of", "ing", "  "]
    for _ in range(2_000):
        text = "".join(rng.choice(signs, int(rng.integers(1, 60))))
        parts = c.parts(text, int(rng.integers(1, 9)))
        assert "".join(parts) == text
        assert int(c.count(parts, np.arange(len(parts)) == 0).sum()) == len(sp.encode(text))


def test_query_of_token_counts(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    n = {r["doc_id"]: len(sp.encode(r["text"] or "")) for r in docs}
    got = queries.op12_token_counts(spark, SF).collect()
    assert len(got) == len(docs)
    assert all((r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n[r["doc_id"]], len(next(d["text"] or "" for d in docs if d["doc_id"] == r["doc_id"]).encode()), n[r["doc_id"]] > 4096) for r in got)
