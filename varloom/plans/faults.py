"""Rows that no builder can read, found before any builder sees them.

Builders are plans over whole tables, in which one impossible value could end a
job for all rows.  So every row is judged here by what it holds: a row with a
fault becomes one outcome, ``error``, with the fault as its detail, and only
sound rows are built.  What fails after that is no matter of a row, and ends the
run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.evidence import PAYLOADS
from ..sources.reference import bare_contig

#: No contig is longer; positions beyond would not fit the arithmetic of offsets.
LAST_POSITION = (1 << 31) - 1
EVENT_TYPES = ("SE", "RI", "A3", "A5", "MX", "AF", "AL")


def _place(*positions: str) -> Column:
    """Whether positions are missing or on no contig."""
    bad = F.lit(False)
    for p in positions:
        bad = bad | F.coalesce(~F.col(p).between(1, LAST_POSITION), F.lit(True))
    return bad


def _named(*names: str) -> Column:
    bad = F.lit(False)
    for n in names:
        bad = bad | (F.coalesce(F.trim(n), F.lit("")) == "")
    return bad


def _bases(*alleles: str) -> Column:
    bad = F.lit(False)
    for a in alleles:
        bad = bad | F.coalesce(~F.col(a).rlike("^[ACGTN]+$"), F.lit(True))
    return bad


def conditions() -> dict[str, list[tuple[Column, str]]]:
    """What can be wrong with each kind of payload, and what is said of it, the
    first that holds."""
    place, contig = "a position is missing or on no contig", "no contig is named"
    small = lambda k: [(_named(f"{k}.chrom"), contig), (_place(f"{k}.pos"), place), (_bases(f"{k}.ref", f"{k}.alt"), "alleles are not bases"), (F.col(f"{k}.pos") + F.length(f"{k}.ref") - 1 > LAST_POSITION, place)]
    groups = F.col("splice.groups")
    wrong = F.exists(groups, lambda g: g.isNull() | ~F.size(g).isin(1, 2) | F.exists(g, lambda x: F.coalesce(~x.between(1, LAST_POSITION), F.lit(True))))
    return {
        "small": small("small"), "edit": small("edit"),
        "fusion": [(_named("fusion.chrom1", "fusion.chrom2"), contig), (_place("fusion.pos1", "fusion.pos2"), place), (_named("fusion.gene1", "fusion.gene2"), "a partner has no name")],
        "splice": [(_named("splice.chrom"), contig), (F.coalesce(~F.col("splice.event_type").isin(*EVENT_TYPES), F.lit(True)), "no event type is named"), (F.coalesce(F.size(groups) == 0, F.lit(True)) | F.coalesce(wrong, F.lit(True)), "coordinates of the event are missing or on no contig")],
        "circle": [(_named("circle.chrom"), contig), (_place("circle.start", "circle.end"), place), (F.col("circle.start") > F.col("circle.end"), "a circle ends before it begins")],
    }


def fault(kinds: tuple[str, ...] = tuple(PAYLOADS)) -> Column:
    """The first fault of a manifest's row; null for a sound one."""
    out = F.when(F.coalesce(*(F.when(F.col(k).isNotNull(), F.lit(k)) for k in kinds)).isNull(), "no payload")
    every = conditions()
    for kind in kinds:
        for bad, said in every[kind]:
            out = out.when(F.col(kind).isNotNull() & bad, said)
    return out


def chromosomes(kinds: tuple[str, ...] = tuple(PAYLOADS)) -> Column:
    """The contigs that a row names."""
    names = {"small": ("chrom",), "edit": ("chrom",), "fusion": ("chrom1", "chrom2"), "splice": ("chrom",), "circle": ("chrom",)}
    every = [F.col(f"{k}.{n}") for k in kinds for n in names[k]]
    return F.array_distinct(F.filter(F.array(*every), lambda x: x.isNotNull()))


def without_genome(transcripts: DataFrame, chunks: DataFrame) -> DataFrame:
    """(contig): contigs of the annotation that the genome lacks."""
    have = chunks.select(bare_contig(F.col("contig")).alias("contig")).distinct()
    return transcripts.select(bare_contig(F.col("chrom")).alias("contig")).distinct().join(have, "contig", "left_anti")


def screened(manifest: DataFrame, unread: DataFrame | None = None, kinds: tuple[str, ...] = tuple(PAYLOADS)) -> tuple[DataFrame, DataFrame]:
    """(sound rows, faults (variant_id, detail)).  ``unread`` (contig) are
    contigs with transcripts but without bases: a row that names one can't be
    built."""
    judged = manifest.withColumn("_fault", fault(kinds))
    if unread is not None:
        named = manifest.select("variant_id", F.explode(chromosomes(kinds)).alias("c")).select("variant_id", bare_contig(F.col("c")).alias("contig"))
        hit = named.join(unread, "contig").groupBy("variant_id").agg(F.lit(True).alias("_unread"))
        judged = judged.join(hit, "variant_id", "left").withColumn("_fault", F.coalesce("_fault", F.when(F.col("_unread"), "the genome lacks the contig")))
    return judged.where("_fault IS NULL").select(*manifest.columns), judged.where("_fault IS NOT NULL").select("variant_id", F.col("_fault").alias("detail"))
