"""Toxicity: gradient-boosted trees over dense features, calibrated.

The lexicon has a fixed part (insults of four languages) and a learned part:
words and word beginnings whose share among toxic labelled documents is far
above that among others, counted in a distributed pass over the sample.  The
features are densities and counts of both parts, how many hits stand near a
second-person word, and rates of capitals, punctuation and obfuscation.  Trees
are fitted on one part of the sample, an isotonic map from raw scores to
probabilities on another, and the lexicon on a third, so none sees the others'
labels.  The sample has at most MOST_LABELLED rows (those of least id hash);
what reaches the driver are the terms that mark toxic documents of the sample, all
of them, and feature rows, never texts.

Cases: a null or empty text has no hits and gets a score; texts of any length
are whole; repeated rows are scored each, and learned once; an id with several labels has
the greatest; without labelled rows every score is
one half; an empty table gives an empty one; other columns, whatever their
names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees, Isotonic, fit_boosted_trees, fit_isotonic
from .common import carry, slices
from .features import FEATURE_BYTES, DIGIT, LETTER, PUNCTUATION, UPPER, Texts, byte_set, labelled_sample

#: Labelled rows that the model is fitted on.
MOST_LABELLED = 20_000
#: Text bytes whose terms are counted at once: a term is a Python string.
TERM_BYTES = 1 << 20
#: Lengths of word beginnings that count as terms, and the least word length for them.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: How many toxic documents of the sample hold a term at least, and its least log odds.
LEAST_TOXIC, LEAST_ODDS = 5, 2.5

# Insults, and words of the second person, of four languages.
INSULTS = frozenset(
    "idiot moron stupid loser pathetic worthless trash scum disgusting clown dumb fool jerk ugly filthy "
    "dumm dummkopf trottel arschloch abschaum versager widerlich ekelhaft "
    "imbécile crétin connard salaud stupide abruti ordure "
    "idiota estúpido imbécil tonto basura asqueroso inútil payaso".split()
)
SECOND_PERSON = frozenset("you your yours yourself du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros os".split())
LEET = str.maketrans("013457@$!", "oieastasi")
EDGES = ".,;:!?\"'()[]{}<>*#%&$|-_~^=+/\\"

NAMES = [
    "known_rate", "known_count", "learned_rate", "learned_count", "learned_sum", "learned_top", "near_you", "you_rate",
    "capitals", "punctuation", "bangs", "obfuscated", "hidden_count", "log_words",
]


def plain(word: str) -> tuple[str, bool]:
    """The word without marks around it, and with marks and digits within it
    undone; whether there were any within."""
    bare = word.strip(EDGES)
    if bare.isalpha() or not bare:
        return bare, False
    undone = "".join(c for c in bare.translate(LEET) if c.isalpha())
    return undone, undone != bare and any(c.isalpha() for c in bare)


def terms_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def learn_terms(sample: DataFrame) -> dict[str, float]:
    """Log odds of the terms that mark toxic documents of the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", TERM_BYTES):
            t = Texts(batch.column("_text"))
            toxic = batch.column("y").to_numpy(zero_copy_only=False) == 1
            terms: dict[str, int] = {}
            owners, at = [], []
            for w in t.word_list:
                own = [terms.setdefault(x, len(terms)) for x in terms_of(plain(w)[0])]
                owners.append(len(own))
                at += own
            starts = np.cumsum([0, *owners[:-1]]) if owners else np.zeros(0, np.int64)
            pairs = np.unique(t.text_of_word.astype(np.int64) << 32 | t.words.codes)
            text, code = pairs >> 32, pairs & 0xFFFFFFFF
            n = np.array(owners, np.int64)[code] if owners else np.zeros(0, np.int64)
            ends = np.cumsum(n)
            flat = np.arange(int(n.sum())) + np.repeat(starts[code] - (ends - n), n) if owners else np.zeros(0, np.int64)
            held = np.unique(np.repeat(text, n) << 32 | np.array(at, np.int64)[flat]) if owners else np.zeros(0, np.int64)
            text, term = held >> 32, held & 0xFFFFFFFF
            pos = np.bincount(term[toxic[text]], minlength=len(terms))
            neg = np.bincount(term[~toxic[text]], minlength=len(terms))
            yield pa.RecordBatch.from_arrays([pa.array(list(terms), pa.string()), pa.array(pos, pa.int64()), pa.array(neg, pa.int64())], ["term", "pos", "neg"])

    totals = sample.agg(F.sum("y").alias("p"), F.count("*").alias("n")).first()
    p, n = totals["p"] or 0, totals["n"]
    odds = F.log((F.col("pos") + 0.5) / (p + 1)) - F.log((F.col("neg") + 0.5) / (n - p + 1))
    found = sample.select("_text", "y").mapInArrow(count, "term string, pos bigint, neg bigint").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    kept = found.where(F.col("pos") >= LEAST_TOXIC).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    terms = {r["term"]: r for r in sorted(kept.collect(), key=lambda r: (-r["odds"], -r["pos"], r["term"]))}
    # a beginning stays if it marks documents beyond those of its commonest longer term
    longer: dict[str, int] = {}
    for term, r in terms.items():
        stem = term.rstrip("*")
        for n in BEGINNINGS:
            if n < len(stem):
                longer[f"{stem[:n]}*"] = max(longer.get(f"{stem[:n]}*", 0), r["pos"])
    return {t: float(r["odds"]) for t, r in terms.items() if not t.endswith("*") or r["pos"] - longer.get(t, 0) >= LEAST_TOXIC}


def toxicity_features(column: pa.Array, lexicon: dict[str, float]) -> np.ndarray:
    """One row per text, columns as in NAMES."""
    t = Texts(column)
    n = len(t.word_list)
    known, learned, you, hidden = (np.zeros(n) for _ in range(4))
    for i, w in enumerate(t.word_list):
        bare, marked = plain(w)
        if bare in INSULTS:
            known[i] = 1
        if bare in SECOND_PERSON:
            you[i] = 1
        odds = max([lexicon.get(x, 0.0) for x in terms_of(bare)]) if len(bare) > 2 else 0.0
        learned[i] = odds
        hidden[i] = marked and (odds > 0 or known[i] > 0)
    hit = t.per_word(((learned > 0) | (known > 0)).astype(float))
    you_at = np.concatenate([[0], np.cumsum(t.per_word(you))])
    at = np.arange(len(hit))
    begin, end = t.words.offsets[:-1][t.text_of_word], t.words.offsets[1:][t.text_of_word]
    near = (you_at[np.minimum(at + 6, end)] - you_at[np.maximum(at - 5, begin)] > 0).astype(float)
    odds = t.per_word(learned)
    top = np.zeros(t.n)
    np.maximum.at(top, t.text_of_word, odds)
    count = lambda of_words: t.sum_words(of_words)
    letter, mark = LETTER[t.raw], (DIGIT | byte_set("*@$!#_-."))[t.raw]
    broken = np.zeros(len(t.raw) + 1, np.int64)
    if len(t.raw) > 2:
        broken[2:-1] = np.cumsum(letter[:-2] & mark[1:-1] & letter[2:])
        broken[-1] = broken[-2]
    letters = np.maximum(t.count_bytes(LETTER), 1)
    known_n, learned_n = count(t.per_word(known)), count((odds > 0).astype(float))
    return np.column_stack([
        known_n / t.n_words, known_n, learned_n / t.n_words, learned_n, count(odds), top, count(hit * near), count(t.per_word(you)) / t.n_words,
        t.count_bytes(UPPER) / letters, t.count_bytes(PUNCTUATION) / t.size, t.count_bytes(byte_set("!")) / t.size, np.diff(broken[t.offsets]) / t.n_words, count(t.per_word(hidden)), np.log1p(t.words.counts),
    ])


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: BoostedTrees
    calibration: Isotonic

    def __call__(self, texts: pa.Array) -> np.ndarray:
        return np.clip(self.calibration(self.trees.raw(toxicity_features(texts, self.lexicon))), 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, target: str = "toxic", most: int = MOST_LABELLED) -> ToxicityModel:
    """A model from labelled rows where ``learn``, a condition on ``_id``, holds."""
    sample = labelled_sample(docs, labels, target, learn, most)
    part = F.pmod(F.xxhash64(F.lit("part"), "_id"), F.lit(20))
    lexicon = learn_terms(sample.where(part < 9))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", FEATURE_BYTES):
            x = toxicity_features(batch.column("_text"), lexicon)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(x.tolist(), pa.list_(pa.float64())), batch.column("y"), batch.column("part")], ["i", "x", "y", "part"])

    rows = sample.where(part >= 9).select(F.col("_id").cast("string").alias("_id"), "_text", "y", part.cast("int").alias("part")).mapInArrow(run, "i string, x array<double>, y int, part int").toArrow().sort_by("i")
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, len(NAMES))
    y, parts = rows["y"].to_numpy().astype(float), rows["part"].to_numpy()
    tree_rows = parts < 16
    trees = fit_boosted_trees(x[tree_rows], y[tree_rows])
    return ToxicityModel(lexicon, trees, fit_isotonic(trees.raw(x[~tree_rows]), y[~tree_rows]))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id_col, [keep], score) of every text."""
    rows, names, own, text, schema = carry(docs, id_col, text_col, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, FEATURE_BYTES):
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(model(batch.column(text)), pa.float64())], [*names, "score"])

    out = rows.mapInArrow(run, schema + "score double")
    return out.select(*(F.col(n).alias(c) for c, n in zip(own, names, strict=True)), "score")
