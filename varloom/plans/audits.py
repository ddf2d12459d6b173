"""Audits of reference files: what they hold that decides how they are read.

Each audit is one pass that counts named facts, (what, key, n), so that counts
of any file are summed in every task before they meet; a contig's figures are
summed over its pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import MITO_CONTIGS
from ..sources.genome import placed_pieces, sequence_pieces
from ..sources.reference import attribute, fasta, read_gtf

#: Residues that a table of twenty has no name for.
UNUSUAL = "UOXBZJ*"
HEADER_FIELDS = ("OS", "OX", "GN", "PE", "SV")


def _facts(*pairs: tuple[str, Column, Column | None]) -> Column:
    """struct(what, key) of each fact that holds; a key of its own or none."""
    each = [F.when(holds, F.struct(F.lit(what).alias("what"), (F.lit("") if key is None else key).alias("key"))) for what, holds, key in pairs]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def _counted(rows: DataFrame, facts: Column) -> DataFrame:
    return rows.select(F.explode(facts).alias("f")).groupBy("f.what", "f.key").agg(F.count("*").alias("n"))


def annotation_audit(spark: SparkSession, path: str) -> DataFrame:
    """(what, key, n) of an annotation: lines by feature and by contig, frames
    of coding blocks, mitochondrial ones; transcripts by type and by tag, those
    whose ends were not found, copies on the second sex chromosome; transcripts
    whose first coding block has a frame, and gene names of several genes."""
    f = F.split("value", "\t")
    part = lambda i: F.get(f, F.lit(i))
    lines = spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(f) >= 9).select(part(0).alias("chrom"), part(2).alias("feature"), part(7).alias("frame"), part(8).alias("a"))
    a, cds, tx = F.col("a"), F.col("feature") == "CDS", F.col("feature") == "transcript"
    tags = F.regexp_extract_all(a, F.lit('tag "([^"]*)"'), F.lit(1))
    own = _facts(
        ("feature", F.lit(True), F.col("feature")), ("contig", F.lit(True), F.col("chrom")), ("frame", cds, F.col("frame")), ("mito_cds", cds & F.col("chrom").isin(*MITO_CONTIGS), None), ("transcript_type", tx, F.coalesce(attribute(a, "transcript_type"), F.lit("?"))),
        ("par_y", tx & F.coalesce(attribute(a, "gene_id"), F.lit("")).contains("PAR_Y"), None), ("start_not_found", tx & F.array_contains(tags, "cds_start_NF"), None), ("end_not_found", tx & F.array_contains(tags, "cds_end_NF"), None),
    )
    tagged = F.when(tx, F.transform(tags, lambda t: F.struct(F.lit("tag").alias("what"), t.alias("key")))).otherwise(F.array().cast("array<struct<what:string,key:string>>"))
    read = read_gtf(spark, path, coding_only=False).where("is_coding")
    framed = _counted(read, _facts(("first_frame", F.col("phase") > 0, F.col("phase").cast("string"))))
    shared = read.groupBy("gene_name").agg(F.count_distinct("gene_id").alias("k")).where("k > 1").agg(F.count("*").alias("n")).where("n > 0").select(F.lit("ambiguous_gene_names").alias("what"), F.lit("").alias("key"), "n")
    return _counted(lines, F.concat(own, tagged)).unionByName(framed).unionByName(shared)


def genome_audit(spark: SparkSession, path: str) -> DataFrame:
    """(contig, length, n_masked, n_unknown, kind) of a genome, by pieces: bases
    in small letters are masked; alternative, unlocalised and unplaced contigs
    are told from the others by their names."""
    pieces = placed_pieces(sequence_pieces(spark, path, upper=False)).select(F.substring_index("header", " ", 1).alias("contig"), "seq")
    left = lambda letters: F.length("seq") - F.length(F.regexp_replace("seq", f"[{letters}]", ""))
    sums = pieces.groupBy("contig").agg(F.sum(F.length("seq")).alias("length"), F.sum(left("a-z")).alias("n_masked"), F.sum(left("nN")).alias("n_unknown"))
    c = F.col("contig")
    kind = F.when(c.contains("_alt"), "alternative").when(c.contains("_random"), "unlocalised").when(c.contains("chrUn"), "unplaced").when(c.isin(*MITO_CONTIGS), "mitochondrial").otherwise("primary")
    return sums.select("contig", "length", "n_masked", "n_unknown", kind.alias("kind"))


def proteome_audit(spark: SparkSession, path: str) -> DataFrame:
    """(what, key, n) of a proteome: entries by database and header field,
    isoform accessions, wrapped entries, those without a first methionine,
    unusual residues by letter, and genes of several entries."""
    rows = fasta(spark, path)
    h = F.col("header")
    gene = F.nullif(F.regexp_extract(h, "\\bGN=(\\S+)", 1), F.lit(""))
    own = _facts(
        ("database", F.lit(True), F.substring(h, F.lit(1), F.lit(2))), *(("field", h.contains(f"{k}="), F.lit(k)) for k in HEADER_FIELDS), ("isoform", h.rlike("^\\w+\\|[A-Z0-9]+-\\d+\\|"), None),
        ("wrapped", F.size("line_lengths") > 1, None), ("no_methionine", (F.col("sequence") != "") & ~F.col("sequence").startswith("M"), None),
    )
    letters = [F.struct(F.lit(x).alias("key"), (F.length("sequence") - F.length(F.replace("sequence", F.lit(x), F.lit("")))).cast("bigint").alias("n")) for x in UNUSUAL]
    odd = rows.select(F.explode(F.array(*letters)).alias("x")).groupBy("x.key").agg(F.sum("x.n").alias("n")).where("n > 0").select(F.lit("residue").alias("what"), "key", "n")
    several = rows.where(gene.isNotNull()).groupBy(gene.alias("g")).agg(F.count("*").alias("k")).where("k > 1").agg(F.count("*").alias("n")).where("n > 0").select(F.lit("genes_of_several_entries").alias("what"), F.lit("").alias("key"), "n")
    return _counted(rows, own).unionByName(odd).unionByName(several)
