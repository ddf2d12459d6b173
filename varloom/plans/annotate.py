"""Variants meet transcripts: by name in tiers, by position in bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import relational as R
from ..sources.reference import bare_contig


def aliases(transcripts: DataFrame) -> DataFrame:
    """(alias, tier, tx_id): gene id, id without version, gene name."""
    kinds = F.array(
        F.struct(F.col("gene_id").alias("alias"), F.lit(1).alias("tier")), F.struct(F.substring_index("gene_id", ".", 1).alias("alias"), F.lit(2).alias("tier")), F.struct(F.col("gene_name").alias("alias"), F.lit(3).alias("tier")),
    )
    return transcripts.select("tx_id", F.explode(kinds).alias("k")).select("tx_id", "k.*").where("alias IS NOT NULL").groupBy("alias", "tx_id").agg(F.min("tier").alias("tier"))


def ranking() -> list[Column]:
    """A gene's best transcript first: MANE, canonical, basic, long, by id."""
    tagged = lambda name: ~F.exists("tags", lambda t: t.startswith(name))
    return [tagged("MANE_Select"), tagged("Ensembl_canonical"), tagged("basic"), -F.col("cds_len"), -F.col("tx_len"), F.col("tx_id")]


def genes_of(variants: DataFrame) -> DataFrame:
    """(variant_id, gene): named genes, split at ; and , without empty marks."""
    names = F.transform(F.split(F.regexp_replace("genes", ",", ";"), ";"), lambda x: F.trim(x))
    return variants.select("variant_id", F.explode(F.filter(names, lambda g: ~g.isin("", ".", "NONE", "NA"))).alias("gene")).distinct()


def candidates(variants: DataFrame, transcripts: DataFrame, mode: str = "all") -> DataFrame:
    """(variant_id, tx_id) for variants (variant_id, chrom, pos, ref, genes).

    A named gene's transcripts at the locus, else its transcripts anywhere;
    variants without a named hit go by position, else by the reference allele's
    end.  ``mode`` representative keeps the best transcript of each gene."""
    coding = transcripts.where("is_coding")
    slim = coding.select("tx_id", "gene_id", "start", "end", "tags", "cds_len", "tx_len", bare_contig(F.col("chrom")).alias("tx_contig"))
    placed = variants.select("variant_id", "pos", (F.col("pos") + F.greatest(F.length("ref"), F.lit(1)) - 1).alias("last"), bare_contig(F.col("chrom")).alias("contig"))

    named = R.tiered_lookup(genes_of(variants), "gene", aliases(coding), "alias", "tier").select("variant_id", "gene", "tx_id").join(R.merged(slim), "tx_id").join(R.merged(placed), "variant_id")
    here = (F.col("contig") == F.col("tx_contig")) & F.col("pos").between(F.col("start"), F.col("end"))
    by_name = named.withColumn("tier", F.when(here, 1).otherwise(2))
    best = by_name.groupBy("variant_id", "gene").agg(F.min("tier").alias("tier"))
    by_name = by_name.join(R.merged(best), ["variant_id", "gene", "tier"])

    open_ = placed.join(R.merged(by_name.select("variant_id").distinct()), "variant_id", "left_anti")
    at = lambda point: R.interval_join(open_, slim, point, "start", "end", [("contig", "tx_contig")])
    first = at("pos")
    second = at("last").join(R.merged(first.select("variant_id").distinct()), "variant_id", "left_anti")
    by_place = first.unionByName(second).withColumn("gene", F.col("gene_id"))
    cols = ["variant_id", "gene", "tx_id", "tags", "cds_len", "tx_len"]
    every = by_name.select(cols).unionByName(by_place.select(cols))
    if mode == "representative":
        every = R.first_wins(every, ["variant_id", "gene"], ranking())
    return every.select("variant_id", "tx_id").distinct()


def placement() -> Column:
    """struct(start, len, allele, trimmed) of a small variant on its transcript:
    columns pos, ref, alt, exons, strand.  An indel whose anchor base is not
    exonic is tried without it."""
    e, strand = F.col("exons"), F.col("strand")
    whole = S.tx_interval(e, strand, F.col("pos"), F.length("ref"))
    ref1, alt1 = F.substring("ref", F.lit(2), F.length("ref")), F.substring("alt", F.lit(2), F.length("alt"))
    rest = F.when(S.left_anchored("ref", "alt") & (F.length("ref") > 1), S.tx_interval(e, strand, F.col("pos") + 1, F.length("ref") - 1))
    turned = lambda x: F.when(strand == "+", x).otherwise(S.revcomp(x))
    made = lambda at, ref, alt, trimmed: F.struct(at.cast("bigint").alias("start"), F.length(ref).cast("bigint").alias("len"), turned(alt).alias("allele"), turned(ref).alias("expected"), F.lit(trimmed).alias("trimmed"))
    without = S.once(rest, lambda at: F.when(at.isNotNull(), made(at, ref1, alt1, True)))
    return S.once(whole, lambda at: F.when(at.isNotNull(), made(at, F.col("ref"), F.col("alt"), False)).otherwise(without))


def representative(transcripts: DataFrame) -> DataFrame:
    """The best coding transcript of each gene alias in its best tier."""
    a = aliases(transcripts.where("is_coding"))
    tier = a.groupBy("alias").agg(F.min("tier").alias("tier"))
    rows = a.join(R.merged(tier), ["alias", "tier"]).join(R.merged(transcripts.select("tx_id", "tags", "cds_len", "tx_len")), "tx_id")
    return R.first_wins(rows.select("alias", "tx_id", "tags", "cds_len", "tx_len"), ["alias"], ranking()).select("alias", "tx_id")
