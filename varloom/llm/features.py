"""Dense text features, computed for a slice of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACED, Words, buffers, flat_text, from_buffers, mix, use_checkpoints

#: Text bytes whose features are computed at once: some thirty arrays of a number per word.
FEATURE_BYTES = 2 << 20

# Very frequent words of four languages.
STOP_WORDS = frozenset(
    "the of and to in a is that it was for on are as with be at by this have from or an not "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un du une que est pour qui dans par sur au plus pas "
    "que el en y a los del se las por un para con no una su al lo como".split()
)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, learn: Column, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _text, y) of at most ``most`` labelled rows that may be learned
    from: the ones of least id hash, so that the sample is the same each time.
    An id with several labels has the greatest, and one with several texts the
    least.  The sample is written once: the fit reads it several times."""
    use_checkpoints(docs.sparkSession)
    kept = labels.select(F.col(id_col).alias("_id"), F.col(target).cast("int").alias("y")).where("y IS NOT NULL AND _id IS NOT NULL").groupBy("_id").agg(F.max("y").alias("y"))
    drawn = kept.where(learn).orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # at most ``most`` ids: a bound that does not depend on the table
    joined = rows.join(F.broadcast(drawn), "_id")
    return joined.groupBy("_id").agg(F.min("_text").alias("_text"), F.max("y").alias("y")).checkpoint()


class Texts:
    """A slice of texts as bytes, words and per-text sums."""

    def __init__(self, column: pa.Array):
        self.flat = flat_text(column)
        self.raw, self.offsets = buffers(self.flat)
        self.n = len(column)
        self.size = np.maximum(np.diff(self.offsets), 1).astype(float)
        self.words = Words(self.flat, SPACED)
        self.text_of_word = np.repeat(np.arange(self.n), self.words.counts)
        self.n_words = np.maximum(self.words.counts, 1).astype(float)
        self.word_list: list[str] = self.words.vocabulary.to_pylist()

    def per_word(self, of_distinct: np.ndarray) -> np.ndarray:
        return of_distinct[self.words.codes]

    def sum_words(self, of_words: np.ndarray) -> np.ndarray:
        return np.bincount(self.text_of_word, of_words, self.n)

    def count_bytes(self, wanted: np.ndarray) -> np.ndarray:
        """How many bytes with a true ``wanted`` entry each text has."""
        ends = np.concatenate([[0], np.cumsum(wanted[self.raw], dtype=np.int64)])
        return np.diff(ends[self.offsets]).astype(float)


def byte_set(chars: str | bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode() if isinstance(chars, str) else chars)] = True
    return table


UPPER = byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = UPPER | byte_set("abcdefghijklmnopqrstuvwxyz") | byte_set(bytes(range(0x80, 0x100)))
DIGIT = byte_set("0123456789")
PUNCTUATION = byte_set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
SYMBOL = byte_set("#$%&*+<=>@\\^_`{|}~")


QUALITY_NAMES = [
    "log_words", "word_length", "long_words", "distinct_words", "top_word", "repeated_neighbour", "repeated_triples", "stop_words",
    "capitals", "symbols", "bangs", "pipes", "digits", "punctuation", "sentence_ends", "symbol_words", "capital_words",
    "line_words", "repeated_lines", "line_ends", "log_lines", "short_word_share",
]


def duplicate_share(group: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per group: share of keys that are repeats, and of the commonest key."""
    total = np.bincount(group, minlength=n)
    mixed = mix(key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + group.astype(np.uint64))
    order = np.argsort(mixed, kind="stable")
    if not len(order):
        return np.zeros(n), np.zeros(n)
    s = mixed[order]
    starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(s)]]))
    of = group[order][starts]
    distinct = np.bincount(of, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, of, counts)
    safe = np.maximum(total, 1)
    return 1 - distinct / safe, top / safe


def quality_features(column: pa.Array) -> np.ndarray:
    """One row per text, columns as in QUALITY_NAMES."""
    t = Texts(column)
    words = t.word_list
    length = np.array([len(w) for w in words], float)
    bare = [w.strip(".,;:!?\"'()") for w in words]
    symbols = np.array([any(c in "#$%&*|<>{}=~^" for c in w) for w in words], float)
    stop = np.array([w in STOP_WORDS for w in bare], float)
    ends = np.array([w[-1:] in ".!?" for w in words], float)
    codes, group = t.words.codes, t.text_of_word
    each = lambda of_distinct: t.sum_words(t.per_word(of_distinct)) / t.n_words
    repeat = np.zeros(len(codes))
    repeat[1:] = (codes[1:] == codes[:-1]) & (group[1:] == group[:-1])
    dup, top = duplicate_share(group, codes, t.n)
    third = codes[:-2].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + codes[1:-1].astype(np.uint64) * np.uint64(0x165667B19E3779F9) + codes[2:].astype(np.uint64) if len(codes) > 2 else np.zeros(0, np.uint64)
    inside = group[:-2] == group[2:] if len(codes) > 2 else np.zeros(0, bool)
    triples, _ = duplicate_share(group[: len(third)][inside], third[inside], t.n)
    letters = np.maximum(t.count_bytes(LETTER), 1)
    breaks = np.union1d(np.flatnonzero(t.raw == 0x0A) + 1, t.offsets)
    lines = from_buffers(t.raw, breaks).dictionary_encode()
    line_of = np.searchsorted(t.offsets, breaks[:-1], "right") - 1
    n_lines = np.maximum(np.bincount(line_of, minlength=t.n), 1)
    same_lines, _ = duplicate_share(line_of, lines.indices.to_numpy(zero_copy_only=False), t.n)
    upper_starts = np.zeros(len(t.raw) + 1, np.int64)
    both = np.zeros(len(t.raw), bool)
    both[1:] = UPPER[t.raw[1:]] & UPPER[t.raw[:-1]]
    upper_starts[1:] = np.cumsum(both)
    capital_pairs = np.diff(upper_starts[t.offsets])
    columns = [
        np.log1p(t.words.counts), each(length), each((length > 15).astype(float)), 1 - dup, top, t.sum_words(repeat) / t.n_words, triples, each(stop),
        t.count_bytes(UPPER) / letters, t.count_bytes(SYMBOL) / t.size, t.count_bytes(byte_set("!")) / t.size, t.count_bytes(byte_set("|")) / t.size,
        t.count_bytes(DIGIT) / t.size, t.count_bytes(PUNCTUATION) / t.size, each(ends), each(symbols), capital_pairs / letters,
        t.n_words / n_lines, same_lines, n_lines / t.size, np.log1p(n_lines), each((length < 4).astype(float)),
    ]
    return np.column_stack(columns)
