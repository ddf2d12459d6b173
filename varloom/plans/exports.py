"""Tables that other runs and tools read: lists, events, truth sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.union import share_text, vcf_lines


def peptide_list(peptides: DataFrame) -> DataFrame:
    """(value): the distinct folded peptides (p), sorted."""
    return peptides.select(F.col("p").alias("value")).distinct().orderBy("value")


def normal_event_table(events: DataFrame, of_tissues: int | None) -> DataFrame:
    """(AS, confidence, tissues) of events seen in normal tissue: the share of
    tissues where support is graded, else nothing is stated."""
    share = share_text(F.col("tissues"), F.lit(of_tissues)) if of_tissues else F.lit("")
    return events.select(F.col("event_id").alias("AS"), share.alias("confidence"), "tissues").orderBy("AS")


def event_table(events: DataFrame) -> DataFrame:
    """(gene, type, form) of splicing events, once each, in order."""
    return events.select("gene", "type", "form").distinct().orderBy("gene", "type", "form")


def truth_vcf(truth: DataFrame) -> DataFrame:
    """Lines of a VCF of the small variants among truth rows (locus, ...)."""
    pattern = "^(\\w+):(\\d+)([ACGTN]+)>([ACGTN]+)$"
    part = lambda i: F.regexp_extract("locus", pattern, i)
    rows = truth.where(F.col("locus").rlike(pattern)).select(part(1).alias("chrom"), part(2).cast("bigint").alias("pos"), part(3).alias("ref"), part(4).alias("alt"), F.lit(".").alias("info"), F.lit("kept").alias("fate"))
    return vcf_lines(rows.distinct())


def truth_edits(truth: DataFrame) -> DataFrame:
    """The edits among truth rows (locus, gene, change) as an annotated table."""
    pattern = "^(\\w+):(\\d+)([AT])>([GC])$"
    part = lambda i: F.regexp_extract("locus", pattern, i)
    sound = F.col("locus").rlike(pattern) & F.concat(part(3), part(4)).isin("AG", "TC")
    place = part(2).cast("bigint")
    return truth.where(sound).select(part(1).alias("Chr"), place.alias("Start"), place.alias("End"), part(3).alias("Ref"), part(4).alias("Alt"), F.lit("exonic").alias("Func.refGene"), F.col("gene").alias("Gene.refGene"), F.concat_ws(":", "gene", F.lit("."), F.lit("."), F.lit("."), "change").alias("AAChange.refGene"))


def truth_lines(truth: DataFrame, remarks: list[str]) -> DataFrame:
    """(value): remarks behind #, the header, and the rows, tab separated."""
    head = [*(f"# {x}" for x in remarks), "\t".join(truth.columns)]
    first = truth.sparkSession.createDataFrame([(i, x) for i, x in enumerate(head)], "k int, value string")
    rows = truth.select(F.lit(len(head)).alias("k"), F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in truth.columns)).alias("value"))
    return first.unionByName(rows).orderBy("k", "value").select("value")
