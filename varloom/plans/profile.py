"""Profiles and audits of input and reference files, as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import upper_median
from ..sources.reference import FEATURES, attribute, fasta


def vcf_profile(spark: SparkSession, path: str) -> DataFrame:
    """(what, key, n): records by chromosome, filter, kind and INFO key."""
    f = F.split("value", "\t")
    part = lambda i: F.get(f, F.lit(i))
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(f) >= 5)
    kind = F.when(part(4).startswith("<"), "symbolic").when(F.length(part(3)) == F.length(part(4)), "substitution").otherwise("indel")
    keys = F.transform(F.split(F.coalesce(part(7), F.lit("")), ";"), lambda x: F.struct(F.lit("info").alias("what"), F.substring_index(x, "=", 1).alias("key")))
    one = lambda what, key: F.struct(F.lit(what).alias("what"), key.alias("key"))
    each = rows.select(F.explode(F.concat(F.array(one("chrom", part(0)), one("filter", F.coalesce(part(6), F.lit("."))), one("kind", kind)), keys)).alias("x")).select("x.*")
    return each.groupBy("what", "key").agg(F.count("*").alias("n"))


def region_profile(spark: SparkSession, path: str) -> DataFrame:
    """One row: regions, bases, least, upper median and greatest length; the
    intervals are half-open."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").rlike("^(#|track|browser)")).select((F.get(f, F.lit(2)).try_cast("bigint") - F.get(f, F.lit(1)).try_cast("bigint")).alias("n")).where("n IS NOT NULL")
    ends = rows.agg(F.count("*").alias("regions"), F.sum("n").alias("bases"), F.min("n").alias("least"), F.max("n").alias("greatest"))
    return ends.crossJoin(upper_median(rows.withColumn("k", F.lit(1)), ["k"], "n").drop("k"))  # one row each


def fasta_profile(spark: SparkSession, path: str) -> DataFrame:
    """One row: entries, residues, lengths, letters outside the protein and the
    nucleotide alphabets, and line widths."""
    rows = fasta(spark, path)
    n = F.length("sequence")
    odd = lambda letters: F.length(F.regexp_replace("sequence", f"[{letters}]", ""))
    return rows.agg(F.count("*").alias("entries"), F.sum(n).alias("residues"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.sum(odd("ACDEFGHIKLMNPQRSTVWYUX*")).alias("not_protein"), F.sum(odd("ACGTUN")).alias("not_nucleotide"), F.max(F.array_max("line_lengths")).alias("width"))


def table_profile(df: DataFrame, chrom: str | None = None) -> DataFrame:
    style = F.when(F.count_if(F.col(chrom).startswith("chr")) == F.count("*"), "chr").when(F.count_if(F.col(chrom).startswith("chr")) == 0, "bare").otherwise("mixed") if chrom else F.lit(None).cast("string")
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"), style.alias("contig_style"))


def gtf_audit(spark: SparkSession, path: str) -> DataFrame:
    """One row of counts that tell whether an annotation is complete."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.get(f, F.lit(0)).alias("chrom"), F.get(f, F.lit(2)).alias("feature"), F.get(f, F.lit(7)).alias("frame"), F.get(f, F.lit(8)).alias("a"))
    t = attribute(F.col("a"), "transcript_id")
    return rows.agg(
        *(F.count_if(F.col("feature") == x).alias(f"n_{x.lower()}") for x in FEATURES), F.count_distinct(t).alias("transcripts"), F.count_distinct(F.when(F.col("feature") == "CDS", t)).alias("coding"),
        F.count_if((F.col("feature") == "CDS") & F.col("frame").isin("1", "2")).alias("shifted_cds"), F.count_distinct(F.when(F.col("a").contains("_start_NF"), t)).alias("start_not_found"), F.count_if(t.contains("PAR_Y")).alias("par_y"), F.count_if(F.col("chrom").isin("chrM", "MT", "chrMT", "M")).alias("mito"),
    )


def genome_audit(spark: SparkSession, path: str) -> DataFrame:
    """(contig, length, n_unknown) of each contig."""
    return fasta(spark, path).select(F.substring_index("header", " ", 1).alias("contig"), F.length("sequence").alias("length"), (F.length("sequence") - F.length(F.replace("sequence", F.lit("N"), F.lit("")))).alias("n_unknown"))


def translation_audit(spark: SparkSession, path: str) -> DataFrame:
    """(fields, entries, trailing_stops): published translations by the number
    of fields in their headers."""
    rows = fasta(spark, path)
    return rows.groupBy(F.size(F.split("header", "\\|")).alias("fields")).agg(F.count("*").alias("entries"), F.count_if(F.col("sequence").endswith("*")).alias("trailing_stops"))


def proteome_audit(proteome: DataFrame) -> DataFrame:
    own = proteome.select("db", "accession", F.explode_outer(F.split("gn", " +")).alias("gene"))
    per_gene = own.groupBy("gene").agg(F.count_distinct("accession").alias("n")).agg(F.count_if((F.col("n") > 1) & F.col("gene").isNotNull()).alias("genes_with_several"), F.count_if(F.col("gene").isNull()).alias("without_gene"))
    return proteome.agg(F.count("*").alias("entries"), F.count_if(F.col("db") == "sp").alias("reviewed"), F.count_if(~F.col("sequence").rlike("^[ACDEFGHIKLMNPQRSTVWYUX]*$")).alias("odd_letters")).crossJoin(per_gene)  # one row each


def selenoprotein_genes(proteome: DataFrame) -> DataFrame:
    return proteome.where(F.col("sequence").contains("U")).select(F.explode(F.split("gn", " +")).alias("gene")).distinct()
