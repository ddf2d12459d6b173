"""Incremental forms.

The engine's inputs are finished files and nothing in it needs windows, late
data or state.  Evidence can still arrive as a growing folder: ``follow_vcf``
reads new files of it as a stream with the same scan as the batch form, and
``digest_stream`` keeps peptides up to date.  Both are stateless projections,
so the stream keeps only file offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import peptides as P


def follow_text(spark: SparkSession, folder: str, files_at_once: int = 100) -> DataFrame:
    """Lines of files as they come into a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_at_once).text(folder)


def follow_vcf(spark: SparkSession, folder: str) -> DataFrame:
    """(chrom, pos, ref, alt) of usable alleles of new files."""
    f = F.split("value", "\t")
    rows = follow_text(spark, folder).where(~F.col("value").startswith("#")).where(F.size(f) >= 5)
    named = rows.select(F.get(f, F.lit(0)).alias("chrom"), F.get(f, F.lit(1)).try_cast("bigint").alias("pos"), F.upper(F.get(f, F.lit(3))).alias("ref"), F.explode(F.split(F.upper(F.get(f, F.lit(4))), ",")).alias("alt"))
    return named.where("pos IS NOT NULL").where(F.col("alt").rlike("^[ACGTN]+$"))


def digest_stream(proteins: DataFrame, keep: list[str]) -> DataFrame:
    """Peptides of a stream of (keep..., sequence)."""
    return proteins.select(*keep, F.explode(P.digest("sequence")).alias("peptide"))
