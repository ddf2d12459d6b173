"""Union tables of many callers, rewritten as the evidence files of a run.

A row has a support: how many tools, batches or files found it.  Rows with too
little support, unknown contigs or unreadable places are left out, and each
table's rows are counted by what became of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as S
from .evidence import pick, table

# Contigs in the order of a sorted VCF, spellings of the mitochondrion, and callers.
CONTIGS = tuple(f"chr{x}" for x in (*range(1, 23), "X", "Y", "M"))
MITO = ("chrM", "MT", "M", "chrMT")
CALLERS = ("Mutect2", "Strelka2", "DeepSomatic")
SCAFFOLD = "^chr(?:\\w+)_([A-Z]{2}\\d+)v(\\d+)(?:_random|_alt|_fix)?$"


def contig_aliases(name: Column | str) -> Column:
    """The spellings a contig may have in a reference, the likeliest first."""
    c = F.trim(S.as_column(name))
    scaffold = F.when(c.rlike(SCAFFOLD), F.concat_ws(".", F.regexp_extract(c, SCAFFOLD, 1), F.regexp_extract(c, SCAFFOLD, 2)))
    other = F.when(c.startswith("chr"), F.substring(c, F.lit(4), F.length(c))).otherwise(F.concat(F.lit("chr"), c))
    mito = F.when(c.isin(*MITO), F.array(*(F.lit(m) for m in MITO))).otherwise(F.array().cast("array<string>"))
    return F.filter(F.concat(F.array(c, scaffold, other), mito), lambda x: x.isNotNull())


def in_reference(name: Column | str, known: list[str]) -> Column:
    """A contig's name in the reference, null if it has none.  A reference's
    contigs are hundreds at most, so they stand in the plan."""
    names = F.array(*(F.lit(k) for k in known))
    return F.get(F.filter(contig_aliases(name), lambda x: F.array_contains(names, x)), F.lit(0))


def whole(df: DataFrame, name: str) -> Column:
    """A count that may be written as 3, 3.0 or not at all."""
    return F.coalesce(pick(df, [name]).try_cast("double").cast("bigint"), F.lit(0).cast("bigint"))


def share_text(part: Column, of: Column) -> Column:
    """A share with four decimals; empty where the whole is not known."""
    return F.when(of > 0, F.format_string("%.4f", part.cast("double") / of)).otherwise("")


def callers(df: DataFrame) -> Column:
    """The callers that support a row, joined by bars; a dot for none."""
    named = [F.when(whole(df, f"{c}_file_count") > 0, c) for c in CALLERS]
    return F.coalesce(F.nullif(F.concat_ws("|", *named), F.lit("")), F.lit("."))


def judged(df: DataFrame, known: list[str], support: dict[str, int], extra: Column | None = None) -> DataFrame:
    """The rows with chrom, pos and ``fate``: kept, or why not."""
    made = df.withColumn("chrom_", in_reference(pick(df, ["CHROM"]), known)).withColumn("pos_", pick(df, ["POS"]).try_cast("bigint"))
    weak = F.lit(False)
    for name, least in support.items():
        weak = weak | (whole(df, name) < least)
    fate = F.when(~extra, "other_change") if extra is not None else F.when(F.lit(False), "")
    return made.withColumn("fate", fate.when(F.col("chrom_").isNull(), "contig").when(weak, "support").when(F.col("pos_").isNull(), "position").otherwise("kept"))


def fates(rows: DataFrame) -> DataFrame:
    return rows.groupBy("fate").agg(F.count("*").alias("n"))


def small_variants(spark: SparkSession, path: str, known: list[str], min_tools: int = 1, min_batches: int = 1) -> DataFrame:
    """Judged rows of a union table of small variants, with ref, alt and info."""
    t = table(spark, path, ",")
    rows = judged(t, known, {"detected_tool_count": min_tools, "detected_batch_count": min_batches})
    ref, alt = F.upper(F.coalesce(pick(t, ["REF"]), F.lit(""))), F.upper(F.coalesce(pick(t, ["ALT"]), F.lit("")))
    info = F.concat_ws(";", F.concat(F.lit("TOOLS="), whole(t, "detected_tool_count").cast("string")), F.concat(F.lit("BATCHES="), whole(t, "detected_batch_count").cast("string")), F.concat(F.lit("CALLERS="), callers(t)))
    made = rows.select(F.col("chrom_").alias("chrom"), F.col("pos_").alias("pos"), ref.alias("ref"), alt.alias("alt"), info.alias("info"), "fate")
    return made.withColumn("fate", F.when((F.col("fate") == "kept") & ((F.col("ref") == "") | (F.col("alt") == "")), "allele").otherwise(F.col("fate")))


def vcf_order() -> list[Column]:
    """Known contigs in their order, then others; by place and alleles."""
    at = F.array_position(F.array(*(F.lit(c) for c in CONTIGS)), F.col("chrom"))
    return [F.when(at > 0, at).otherwise(999), F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")]


def vcf_lines(rows: DataFrame) -> DataFrame:
    """Lines of a VCF, its header first, sorted by contig and place."""
    fields = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), "info")
    ordered = rows.where("fate = 'kept'").select(F.struct(*(c.alias(f"o{i}") for i, c in enumerate(vcf_order()))).alias("o"), fields.alias("value"))
    head = rows.sparkSession.createDataFrame([("##fileformat=VCFv4.2",), ("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",)], "value string").withColumn("o", F.lit(None).cast(ordered.schema["o"].dataType))
    return head.withColumn("k", F.when(F.col("value").startswith("##"), 0).otherwise(1)).unionByName(ordered.withColumn("k", F.lit(2))).orderBy("k", "o").select("value")


def editing(spark: SparkSession, path: str, known: list[str], min_files: int = 1, min_batches: int = 1) -> DataFrame:
    """Judged rows of a union table of edits: A to I alone, on either strand.
    Annotation is left open and not made up."""
    t = table(spark, path, "\t")
    kind = F.upper(F.trim(F.coalesce(pick(t, ["edit_type"]), F.lit(""))))
    rows = judged(t, known, {"file_support_count": min_files, "batch_support_count": min_batches}, kind.isin("A>G", "T>C"))
    dot = F.lit(".")
    return rows.select(
        F.col("chrom_").alias("Chr"), F.col("pos_").alias("Start"), F.col("pos_").alias("End"), F.substring_index(kind, ">", 1).alias("Ref"), F.substring_index(kind, ">", -1).alias("Alt"), *(dot.alias(c) for c in ("Func.refGene", "Gene.refGene", "GeneDetail.refGene", "ExonicFunc.refGene", "AAChange.refGene")),
        kind.alias("edit_type"), whole(t, "file_support_count").alias("file_support_count"), whole(t, "batch_support_count").alias("batch_support_count"), "fate",
    )


def fusions(spark: SparkSession, path: str, known: list[str], min_files: int = 1, of_files: int = 0) -> DataFrame:
    """Fusion rows of several tables merged by genes and breakpoints: greatest
    support, sorted callers; the confidence is the share of all files."""
    t = table(spark, path, ",")
    side = lambda i: (in_reference(pick(t, [f"chrom{i}", f"chr{i}"]), known), pick(t, [f"pos{i}", f"breakpoint{i}_pos"]).try_cast("bigint"))
    (c1, p1), (c2, p2) = side(1), side(2)
    rows = t.select(F.trim(pick(t, ["gene1"])).alias("Gene1"), F.trim(pick(t, ["gene2"])).alias("Gene2"), c1.alias("chrom1"), p1.alias("pos1"), c2.alias("chrom2"), p2.alias("pos2"), whole(t, "file_support_count").alias("files"), F.coalesce(pick(t, ["caller"]), F.lit(".")).alias("caller"))
    sound = rows.where("chrom1 IS NOT NULL AND chrom2 IS NOT NULL AND pos1 IS NOT NULL AND pos2 IS NOT NULL")
    merged = sound.groupBy("Gene1", "Gene2", "chrom1", "pos1", "chrom2", "pos2").agg(F.max("files").alias("files"), F.array_join(F.array_sort(F.collect_set("caller")), "|").alias("callers"))
    place = lambda i: F.concat_ws(":", f"chrom{i}", F.col(f"pos{i}").cast("string"))
    return merged.where(F.col("files") >= min_files).select("Gene1", "Gene2", place(1).alias("breakpoint1"), place(2).alias("breakpoint2"), share_text(F.col("files"), F.lit(of_files)).alias("confidence"), "callers", "files")


def splicing(spark: SparkSession, path: str, min_files: int = 1, of_files: int = 0) -> DataFrame:
    """Events by id with their support as a share."""
    t = table(spark, path, ",")
    rows = t.select(F.trim(pick(t, ["event_id", "AS", "event"])).alias("AS"), pick(t, ["dPSI", "delta_psi"]).try_cast("double").alias("dPSI"), whole(t, "file_support_count").alias("files"))
    kept = rows.where(F.col("AS").isNotNull()).groupBy("AS").agg(F.max("files").alias("files"), F.max_by("dPSI", F.abs("dPSI")).alias("dPSI"))
    return kept.where(F.col("files") >= min_files).select("AS", "dPSI", share_text(F.col("files"), F.lit(of_files)).alias("confidence"), "files")
