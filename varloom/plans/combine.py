"""Which co-occurring variants can share a molecule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def phase_groups(placed: DataFrame, tx: str, block: str, haplotype: str) -> DataFrame:
    """(tx, phase, phased, members).  A haplotype of a phase block is one group;
    all variants of a transcript are one more, unphased, if any has no phase or
    they span several blocks.  One block that holds all settles the question,
    so none is added there.  Groups of one are left out."""
    known = placed.where(F.col(block) != "")
    phased = known.groupBy(tx, F.concat_ws("|", block, F.col(haplotype).cast("string")).alias("phase")).agg(F.count("*").alias("members")).where("members > 1")
    blocks = placed.groupBy(tx).agg(F.count("*").alias("members"), F.count_if(F.col(block) == "").alias("loose"), F.count_distinct(F.nullif(F.col(block), F.lit(""))).alias("blocks"))
    open_ = blocks.where("members > 1 AND (loose > 0 OR blocks > 1 OR blocks = 0)")
    return phased.select(tx, "phase", F.lit(True).alias("phased"), "members").union(open_.select(tx, F.lit("unphased"), F.lit(False), "members"))
