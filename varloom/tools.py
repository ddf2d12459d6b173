"""Work beside a run: converting union tables, generating events, comparing
tools, scoring a release against a truth set.

Each function takes a session and plain paths, writes with Spark's writers into
one folder, and returns what it counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import headers as H
from .plans import events as E
from .plans import exports, report, truth
from .runlog import write_lines
from .sources import genome, reference, union
from .sources.evidence import pick, table


def tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def convert(spark: SparkSession, kind: str, source: str, out: str, genome_path: str, least: int = 1, of: int = 0) -> dict[str, int]:
    """A union table of many callers as the input of a run: ``out/kept``, and
    ``out/fates`` with how many rows were left out and why.  ``least`` is the
    least support; ``of`` the number of files that a share is of, 0 if unknown."""
    known = [r["contig"] for r in genome.contig_lengths(reference.genome(spark, genome_path)).select("contig").orderBy("contig").collect()]  # a reference's contigs
    if kind == "small_variants":
        rows = union.small_variants(spark, source, known, least)
        union.vcf_lines(rows).write.mode("overwrite").text(f"{out}/kept")
    elif kind == "rna_editing":
        rows = union.editing(spark, source, known, least)
        tsv(rows.where("fate = 'kept'").drop("fate"), f"{out}/kept")
    elif kind == "fusion":
        rows = union.fusions(spark, source, known, least, of).withColumn("fate", F.lit("kept"))
        csv(rows.drop("fate"), f"{out}/kept")
    elif kind == "splicing":
        rows = union.splicing(spark, source, least, of).withColumn("fate", F.lit("kept"))
        csv(rows.drop("fate"), f"{out}/kept")
    else:
        raise ValueError(f"no kind {kind}: small_variants, rna_editing, fusion or splicing")
    tsv(union.fates(rows), f"{out}/fates")
    return {r["fate"]: r["n"] for r in union.fates(rows).collect()}  # a row for each fate


def annotated_events(spark: SparkSession, annotation: str, out: str, coding_only: bool = False) -> dict[str, int]:
    """The alternative events of an annotation, ordered by id."""
    found = E.event_ids(reference.read_gtf(spark, annotation, coding_only=False), coding_only)
    tsv(found.orderBy("event_id"), out)
    return {r["type"]: r["n"] for r in spark.read.option("sep", "\t").option("header", True).csv(out).groupBy("type").agg(F.count("*").alias("n")).collect()}  # seven types


def seen_in_normal(spark: SparkSession, event_table: str, junctions: str, out: str, of_tissues: int | None = None) -> dict[str, int]:
    """Events all of whose junctions are in a catalogue of normal tissues (a
    file for each), with the least number of tissues."""
    events = spark.read.option("sep", "\t").option("header", True).csv(event_table).select("event_id")
    need = E.required_junctions(events)
    observed = reference.junction_catalogue(spark, junctions, need.select("junction"))
    found = exports.normal_event_table(truth.normal_events(need, observed), of_tissues)
    csv(found, out)
    return {"events": events.count(), "in_normal": spark.read.option("header", True).csv(out).count()}


def tool_entries(spark: SparkSession, tools: dict[str, str]) -> DataFrame:
    """(tool, gene, sequence) of the FASTA files of several tools."""
    every = None
    for tool, path in tools.items():
        one = reference.fasta(spark, path).where(F.length("sequence") > 0).select(F.lit(tool).alias("tool"), H.gene_guess("header").alias("gene"), "sequence")
        every = one if every is None else every.unionByName(one)
    if every is None:
        raise ValueError("no tool is named")
    return every


def compare(spark: SparkSession, tools: dict[str, str], out: str, k: int = 7) -> list[str]:
    """The report on what tools share, and the genes that two of them translate
    without a sequence in common."""
    entries = tool_entries(spark, tools)
    lines = report.comparison(entries, k)
    write_lines(spark, lines, f"{out}/report")
    if len(tools) > 1:
        tsv(truth.disagreeing_genes(entries, list(tools)).orderBy("a", "b", "gene"), f"{out}/disagreeing_genes")
    return lines


def score(spark: SparkSession, release: str, truth_path: str, out: str) -> dict[str, tuple]:
    """Recall and precision of a release against a truth table (locus, change,
    and category or nothing), by what its provenance and its headers show."""
    t = reference.truth_table(spark, truth_path)
    asked = t.select(pick(t, ["locus"]).alias("locus"), pick(t, ["change", "expected_hgvs_p", "protein_change"]).alias("change"), F.coalesce(pick(t, ["category", "class"]), F.lit("all")).alias("category"))
    scored = truth.score(asked, reference.observed_changes(spark, f"{release}/provenance", f"{release}/target"))
    tsv(scored, f"{out}/scored")
    rates = truth.accuracy(scored)
    tsv(rates, f"{out}/accuracy")
    return {r["category"]: (r["n"], r["n_found"], r["recall"], r["precision"]) for r in rates.collect()}  # a row for each category


def truth_inputs(spark: SparkSession, truth_path: str, out: str) -> dict[str, int]:
    """A truth table (locus, gene, change) as inputs of a run: a VCF of its
    small variants and an annotated table of its edits."""
    t = reference.truth_table(spark, truth_path)
    asked = t.select(pick(t, ["locus"]).alias("locus"), F.coalesce(pick(t, ["gene"]), F.lit("")).alias("gene"), F.coalesce(pick(t, ["change", "expected_hgvs_p", "protein_change"]), F.lit("")).alias("change"))
    exports.truth_vcf(asked).write.mode("overwrite").text(f"{out}/small_variants")
    tsv(exports.truth_edits(asked), f"{out}/rna_editing")
    lines = spark.read.text(f"{out}/small_variants").where(~F.col("value").startswith("#"))
    return {"small_variants": lines.count(), "rna_editing": spark.read.option("sep", "\t").option("header", True).csv(f"{out}/rna_editing").count()}


def crosscheck(spark: SparkSession, release: str, other: str, out: str) -> dict[str, int]:
    """The release's consequences against another annotator's table
    (variant_id, transcript, terms joined by &): shared transcripts first, then
    the most severe term."""
    ours = spark.read.option("sep", "\t").option("header", True).csv(f"{release}/records").where("variant_id IS NOT NULL").select("variant_id", "transcript", "consequence")
    t = table(spark, other, "\t")
    theirs = t.select(pick(t, ["variant_id"]).alias("variant_id"), pick(t, ["transcript", "feature"]).alias("transcript"), F.split(pick(t, ["terms", "consequence"]), "[&,]").alias("terms")).where("variant_id IS NOT NULL AND terms IS NOT NULL")
    found = truth.consequence_crosscheck(ours, theirs)
    tsv(found.withColumn("ours", F.array_join("ours", ";")), out)
    n = found.agg(F.count("*").alias("compared"), F.count_if("agrees").alias("agree")).first()
    return {"compared": n["compared"], "agree": n["agree"]}
