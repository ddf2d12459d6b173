"""Peptides and decoys as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequence import as_column, letters

#: Cuts after K or R unless P follows.
CUT = "(?<=[KR])(?!P)"


def fragments(seq: Column | str) -> Column:
    return F.filter(F.split(F.replace(as_column(seq), F.lit("*"), F.lit("")), CUT), lambda x: x != "")


def digest(seq: Column | str, missed: int = 2, least: int = 6, most: int = 50) -> Column:
    """The set of tryptic peptides with up to ``missed`` missed cleavages."""
    parts = fragments(seq)
    n = F.size(parts)
    # a single pass per number of missed cleavages: neighbours are zipped, not sliced and joined
    runs = [parts]
    for k in range(1, missed + 1):
        longer = F.zip_with(runs[-1], F.slice(parts, F.lit(k + 1), n), lambda a, b: F.concat(a, b))
        runs.append(F.filter(longer, lambda x: x.isNotNull()))
    kept = F.filter(F.concat(*runs), lambda p: F.length(p).between(least, most))
    return F.array_distinct(kept)


def peptide_spans(seq: Column | str, missed: int = 2, least: int = 6, most: int = 50) -> Column:
    """Where the tryptic peptides are: structs (start, end) of 0-based residues,
    the end exclusive, by missed cleavages and then place; repeats count each."""
    lengths = F.transform(fragments(seq), F.length)
    ends = F.aggregate(lengths, F.array().cast("array<int>"), lambda acc, n: F.concat(acc, F.array(F.coalesce(F.element_at(F.concat(F.array(F.lit(0)), acc), -1), F.lit(0)) + n)))
    starts = F.zip_with(ends, lengths, lambda e, n: e - n)
    runs = [F.zip_with(starts, F.slice(ends, F.lit(k + 1), F.greatest(F.lit(0), F.size(ends))), lambda s, e: F.struct(s.alias("start"), e.alias("end"))) for k in range(missed + 1)]
    return F.filter(F.concat(*runs), lambda x: (x["end"] - x["start"]).between(least, most))


def peptide_bounds(seq: Column | str, at: Column, missed: int = 2, least: int = 6, most: int = 50) -> Column:
    """The longest tryptic peptide that holds a 0-based residue, the first of
    equal ones; null for none."""
    held = F.filter(peptide_spans(seq, missed, least, most), lambda x: (x["start"] <= at) & (at < x["end"]))
    ranked = F.transform(held, lambda x: F.struct((x["start"] - x["end"]).alias("o"), x["start"].alias("start"), x["end"].alias("end")))
    best = F.array_min(ranked)
    return F.when(F.size(held) > 0, F.struct(best["start"].alias("start"), best["end"].alias("end")))


def fold(peptide: Column | str) -> Column:
    """I and L weigh the same and count as one."""
    return F.translate(as_column(peptide), "I", "L")


def around(seq: Column, pos: Column, most: int = 50) -> Column:
    """struct(window, at): what peptides of up to ``most`` residues over the
    1-based position can reach, and the position within it.  Taken once per
    protein, before its peptides are rows."""
    first = F.greatest(F.lit(1), pos - most + 1)
    return F.struct(F.substring(seq, first, F.lit(2 * most - 1)).alias("window"), (pos - first + 1).alias("at"))


def spans(seq: Column, peptide: Column, pos: Column) -> Column:
    """Some occurrence of the peptide covers the 1-based position; all do if
    there is no position.  Give it a window from ``around``, not a long text."""
    first = F.greatest(F.lit(1), pos - F.length(peptide) + 1)
    hit = F.exists(F.sequence(first, F.greatest(first, pos)), lambda i: (i <= pos) & (F.substring(seq, i, F.length(peptide)) == peptide))
    return F.when(pos.isNull(), True).otherwise(hit)


def kmers(seq: Column | str, k: int) -> Column:
    """The distinct k-mers; k shifted copies of the letters are zipped, so the
    work is linear."""
    x = letters(F.replace(as_column(seq), F.lit("*"), F.lit("")))
    runs = x
    for shift in range(1, k):
        runs = F.zip_with(runs, F.slice(x, F.lit(shift + 1), F.greatest(F.lit(0), F.size(x))), lambda a, b: F.concat(a, b))
    return F.array_distinct(F.filter(runs, lambda m: m.isNotNull()))


def reverse_decoy(seq: Column | str) -> Column:
    return F.reverse(as_column(seq))


def pseudo_reverse_decoy(seq: Column | str) -> Column:
    """Each tryptic fragment reversed, a last K or R in its place."""

    def one(x: Column) -> Column:
        head = F.substring(x, F.lit(1), F.length(x) - 1)
        return F.when(F.right(x, F.lit(1)).isin("K", "R"), F.concat(F.reverse(head), F.right(x, F.lit(1)))).otherwise(F.reverse(x))

    return F.array_join(F.transform(F.filter(F.split(as_column(seq), CUT), lambda x: x != ""), one), "")


def protein_like(text: Column | str) -> Column:
    """A text's letters as a protein: the generic form of the queries."""
    letters = F.upper(F.regexp_replace(as_column(text), "[^A-Za-z]", ""))
    return F.regexp_replace(letters, "[^ACDEFGHIKLMNPQRSTVWY]", "")


def nucleotides(key: Column, parts: int = 1) -> Column:
    """A key's digest as bases: the generic form of the queries."""
    each = [F.translate(F.md5(F.concat(key.cast("string"), F.lit(f":{i}"))), "0123456789abcdef", "ACGTACGTACGTACGT") for i in range(parts)]
    return F.concat(*each)
