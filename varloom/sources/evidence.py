"""Evidence scans: small variants, RNA editing, fusions, splicing, circles.

Every scan returns manifest columns: variant_id, variant_class, source, genes,
locus, confidence and one typed struct per kind of payload, so that scans union
by name and no payload is JSON text.  ``ord`` is the row's place in its source.
Compression follows the file's suffix, as Spark's text readers do; ``readable``
gives compressed data under another name such a suffix.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..session import use_checkpoints

SMALL = "struct<chrom:string,pos:bigint,ref:string,alt:string,vcf_id:string,filter:string,info:string,phase_set:string,haplotypes:array<int>,af:double>"
EDIT = "struct<chrom:string,pos:bigint,end:bigint,ref:string,alt:string,region:string,exonic:string,aachange:array<struct<gene:string,transcript:string,exon:string,cdna:string,protein:string,raw:string>>>"
FUSION = "struct<gene1:string,chrom1:string,pos1:bigint,gene2:string,chrom2:string,pos2:bigint,detection:string,validated:string,tag:string>"
SPLICE = "struct<gene_id:string,event_type:string,chrom:string,strand:string,groups:array<array<bigint>>,event_id:string,dpsi:double,p_val:double>"
CIRCLE = "struct<chrom:string,start:bigint,end:bigint,strand:string,gene:string>"
PAYLOADS = {"small": SMALL, "edit": EDIT, "fusion": FUSION, "splice": SPLICE, "circle": CIRCLE}
KEPT_FILTERS = ("PASS", "HighConf")


#: How gzip data begin, and the endings by which readers know them.
GZIP, GZIP_ENDINGS = (0x1F, 0x8B), (".gz", ".bgz")


def readable(spark: SparkSession, path: str) -> str:
    """The path of a file as text readers can take it.  They know compressed
    files by their names only, so gzip data under another name are copied, as
    they are, to a name that says so, in the shared folder for checkpoints."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(conf)
    if path.endswith(GZIP_ENDINGS) or not fs.exists(place) or fs.getFileStatus(place).isDirectory():
        return path
    stream = fs.open(place)
    try:
        begins = stream.read(), stream.read()
    finally:
        stream.close()
    if begins != GZIP:
        return path
    use_checkpoints(spark)
    target = jvm.org.apache.hadoop.fs.Path(f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}-{place.getName()}.gz")
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, place, target.getFileSystem(conf), target, False, True, conf)
    return target.toString()


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, ord): a file's lines in file order."""
    return spark.read.text(path).withColumn("ord", F.monotonically_increasing_id())


def manifest(df: DataFrame, kind: str, payload: Column) -> DataFrame:
    typed = [(payload if k == kind else F.lit(None)).cast(t).alias(k) for k, t in PAYLOADS.items()]
    return df.select("variant_id", "variant_class", "source", "genes", "locus", F.col("confidence").cast("double").alias("confidence"), *typed, "ord")


def number(x: Column | str, kind: str = "double") -> Column:
    """A number, or null for what is none or not-a-number."""
    c = S.as_column(x).try_cast(kind)
    return F.when(~F.isnan(c), c) if kind == "double" else c


def info_af(info: Column) -> Column:
    """The first of AF, VAF and AF_ALT that is there, and of its comma values
    the first; null if it is no number.  All alleles of a row share it."""
    fields = F.split(info, ";")
    named = [F.get(F.filter(fields, _starts(k)), F.lit(0)) for k in ("AF", "VAF", "AF_ALT")]
    first = F.coalesce(*named)
    return number(F.substring_index(F.substring_index(first, "=", -1), ",", 1))


def _starts(key: str):
    return lambda x: x.startswith(f"{key}=")


def phase(fmt: Column, sample: Column, allele: Column) -> Column:
    """struct(block, haplotypes): only a genotype with a bar is phased; a
    missing block is '*'; allele numbers start at 1."""
    keys, values = F.split(fmt, ":"), F.split(sample, ":")
    at = lambda k: F.get(values, F.array_position(keys, k).cast("int") - 1)
    gt = F.when(F.array_contains(keys, "GT"), at("GT"))
    copies = F.split(gt, "\\|")
    haps = F.filter(F.transform(copies, lambda g, i: F.when(g == allele.cast("string"), i)), lambda i: i.isNotNull())
    phased = gt.contains("|") & (F.size(haps) > 0)
    block = F.when(F.array_contains(keys, "PS"), F.coalesce(F.nullif(at("PS"), F.lit("")), F.lit("*"))).otherwise("*")
    none = F.array().cast("array<int>")
    return F.struct(F.when(phased, block).otherwise("").alias("block"), F.when(phased, haps).otherwise(none).cast("array<int>").alias("haplotypes"))


def read_vcf(spark: SparkSession, path: str, require_pass: bool = True, keep: tuple[str, ...] = KEPT_FILTERS, source: str = "vcf") -> DataFrame:
    """One manifest row per usable allele."""
    f = F.split("value", "\t")
    rows = lines(spark, path).where(~F.col("value").startswith("#")).where(F.size(f) >= 5).select("ord", f.alias("f"))
    part = lambda i: F.get("f", F.lit(i))
    named = rows.select("ord", part(0).alias("chrom"), part(1).try_cast("bigint").alias("pos"), part(2).alias("vcf_id"), F.upper(part(3)).alias("ref"), F.posexplode(F.split(F.upper(part(4)), ",")).alias("k", "alt"), F.coalesce(part(6), F.lit(".")).alias("filter"), F.coalesce(part(7), F.lit("")).alias("info"), part(8).alias("fmt"), part(9).alias("sample"))
    # a reference allele with other letters stays: its variant is reported as an error and not lost
    usable = F.col("pos").isNotNull() & F.col("alt").rlike("^[ACGTN]+$") & (F.col("ref") != "")
    passed = F.col("filter").isin("", ".") | F.arrays_overlap(F.split("filter", ";"), F.array(*(F.lit(x) for x in keep)))
    found = named.where(usable & (passed if require_pass else F.lit(True))).withColumn("ph", phase(F.col("fmt"), F.col("sample"), F.col("k") + 1))
    locus = F.concat("chrom", F.lit(":"), F.col("pos").cast("string"), "ref", F.lit(">"), "alt")
    out = found.select("*", locus.alias("variant_id"), S.small_class("ref", "alt").alias("variant_class"), F.lit(source).alias("source"), F.lit("").alias("genes"), locus.alias("locus"), F.lit(None).alias("confidence"), info_af(F.col("info")).alias("af"))
    return manifest(out, "small", F.struct("chrom", "pos", "ref", "alt", "vcf_id", "filter", "info", F.col("ph.block").alias("phase_set"), F.col("ph.haplotypes").alias("haplotypes"), "af"))


def whole_vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(place, header, value): every line of VCF files as it is, those of the
    header told apart; ``place`` orders them as they stand, in the order of
    the files.  Ends of lines are line feeds; a carriage return stays part of
    its line."""
    named = [paths] if isinstance(paths, str) else paths
    every = None
    for i, path in enumerate(named):
        lines_ = spark.read.option("lineSep", "\n").text(path)
        place = F.struct(F.lit(i).alias("input"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
        one = lines_.select(place.alias("place"), F.col("value").startswith("#").alias("header"), "value")
        every = one if every is None else every.unionByName(one)
    return every


DEFINITION = "^##(contig|INFO|FILTER|FORMAT|ALT)=<(.*)>\\s*$"


def definitions(lines_: DataFrame) -> DataFrame:
    """(kind, id, number, type, length, description) that a header gives;
    what it doesn't say is null."""
    inner = F.regexp_extract("value", DEFINITION, 2)
    field = lambda k: F.nullif(F.regexp_extract(inner, f"(?:^|,){k}=([^,\"]*)", 1), F.lit(""))
    said = F.nullif(F.regexp_extract(inner, '(?:^|,)Description="((?:[^"\\\\]|\\\\.)*)"', 1), F.lit(""))
    found = lines_.where(F.col("header") & F.col("value").rlike(DEFINITION))
    return found.select(F.regexp_extract("value", DEFINITION, 1).alias("kind"), field("ID").alias("id"), field("Number").alias("number"), field("Type").alias("type"), field("length").try_cast("bigint").alias("length"), said.alias("description"))


def write_vcf(lines_: DataFrame, path: str) -> None:
    """Text parts that, one after another, are the file that was read."""
    lines_.repartitionByRange("place").sortWithinPartitions("place").select("value").write.mode("overwrite").option("lineSep", "\n").text(path)


def table(spark: SparkSession, path: str, sep: str) -> DataFrame:
    return spark.read.option("header", True).option("sep", sep).csv(path).withColumn("ord", F.monotonically_increasing_id())


def pick(df: DataFrame, names: list[str]) -> Column:
    """The first of several spellings that the table has, else null."""
    have = {c.lower(): c for c in df.columns}
    found = [have[n.lower()] for n in names if n.lower() in have]
    return F.col(f"`{found[0]}`") if found else F.lit(None).cast("string")


def aachange(text: Column) -> Column:
    """gene:transcript:exon:c.:p. entries; short entries keep what they have."""
    one = lambda x: F.struct(*(F.get(F.split(x, ":"), F.lit(i)).alias(n) for i, n in enumerate(("gene", "transcript", "exon", "cdna", "protein"))), x.alias("raw"))
    entries = F.filter(F.split(text, ","), lambda x: ~x.isin("", ".", "UNKNOWN"))
    return F.transform(entries, one)


def read_editing(spark: SparkSession, path: str, source: str = "rna_editing") -> DataFrame:
    """ANNOVAR tables; a repeated header and rows without a start are dropped."""
    t = table(spark, path, "\t")
    start = pick(t, ["Start"]).try_cast("bigint")
    rows = t.select("ord", pick(t, ["Chr"]).alias("chrom"), start.alias("pos"), pick(t, ["End"]).try_cast("bigint").alias("end"), F.upper(pick(t, ["Ref"])).alias("ref"), F.upper(pick(t, ["Alt"])).alias("alt"), pick(t, ["Func.refGene", "Func.ensGene"]).alias("region"), pick(t, ["ExonicFunc.refGene", "ExonicFunc.ensGene"]).alias("exonic"), pick(t, ["Gene.refGene", "Gene.ensGene"]).alias("genes"), aachange(pick(t, ["AAChange.refGene", "AAChange.ensGene"])).alias("aachange"))
    locus = F.concat("chrom", F.lit(":"), F.col("pos").cast("string"), "ref", F.lit(">"), "alt")
    out = rows.where("pos IS NOT NULL").select("*", F.concat(F.lit("RES:"), locus).alias("variant_id"), F.lit("RNA_EDITING").alias("variant_class"), F.lit(source).alias("source"), locus.alias("locus"), F.lit(None).alias("confidence"))
    return manifest(out, "edit", F.struct("chrom", "pos", "end", "ref", "alt", "region", "exonic", "aachange"))


BREAKPOINT = "^(chr\\w+|\\w+):(\\d+)$"


def separator(spark: SparkSession, path: str) -> str:
    head = spark.read.text(path).first()
    return "\t" if head and head["value"].count("\t") > head["value"].count(",") else ","


def read_fusions(spark: SparkSession, path: str, source: str = "fusion") -> DataFrame:
    """Gene pairs with breakpoints; rows without two readable ones are dropped."""
    t = table(spark, path, separator(spark, path))
    bp = [pick(t, [f"breakpoint{i}", f"bp{i}", f"breakpoint_{i}"]) for i in (1, 2)]
    rows = t.where(bp[0].rlike(BREAKPOINT) & bp[1].rlike(BREAKPOINT)).select(
        "ord", *(F.trim(pick(t, [f"Gene{i}", f"gene_{i}"])).alias(f"gene{i}") for i in (1, 2)), *(F.regexp_extract(bp[i - 1], BREAKPOINT, 1).alias(f"chrom{i}") for i in (1, 2)), *(F.regexp_extract(bp[i - 1], BREAKPOINT, 2).try_cast("bigint").alias(f"pos{i}") for i in (1, 2)),
        pick(t, ["Type"]).alias("detection"), pick(t, ["Validated"]).alias("validated"), pick(t, ["tag"]).alias("tag"), number(pick(t, ["confidence"])).alias("confidence"),
    )
    text = lambda i: F.concat_ws(":", f"chrom{i}", F.col(f"pos{i}").cast("string"))
    out = rows.select("*", F.concat_ws("::", F.concat_ws("--", "gene1", "gene2"), text(1), text(2)).alias("variant_id"), F.lit("FUSION").alias("variant_class"), F.lit(source).alias("source"), F.concat_ws(";", "gene1", "gene2").alias("genes"), F.concat_ws("::", text(1), text(2)).alias("locus"))
    return manifest(out, "fusion", F.struct("gene1", "chrom1", "pos1", "gene2", "chrom2", "pos2", "detection", "validated", "tag"))


EVENT = "^([^;]+);(SE|RI|A3|A5|MX|AF|AL):([^:]+):(.+):([+-])$"


def event_fields(event: Column) -> Column:
    """struct(gene_id, event_type, chrom, groups, strand) of an event id;
    groups hold one or two coordinates."""
    part = lambda i: F.regexp_extract(event, EVENT, i)
    groups = F.transform(F.split(part(4), ":"), lambda g: F.transform(F.split(g, "-"), lambda x: x.try_cast("bigint")))
    sound = event.rlike(EVENT) & ~F.exists(groups, lambda g: F.exists(g, lambda x: x.isNull()))
    return F.when(sound, F.struct(part(1).alias("gene_id"), part(2).alias("event_type"), part(3).alias("chrom"), groups.alias("groups"), part(5).alias("strand")))


def event_column(t: DataFrame) -> str | None:
    """The column that holds event ids: found by grammar in the first rows."""
    for row in t.limit(50).collect():  # a look at the file's head
        for c in t.columns:
            if isinstance(row[c], str) and re.match(EVENT, row[c]):
                return c
    return None


def read_splicing(spark: SparkSession, path: str, source: str = "splicing") -> DataFrame:
    t = table(spark, path, separator(spark, path))
    name = event_column(t)
    if name is None:
        raise ValueError(f"no column of {path} holds splicing event ids")
    rows = t.select("*", event_fields(F.trim(F.col(f"`{name}`"))).alias("e"), F.trim(F.col(f"`{name}`")).alias("event_id")).where("e IS NOT NULL")
    out = rows.select(
        "ord", "e", "event_id", F.col("event_id").alias("variant_id"), F.concat(F.lit("AS_"), "e.event_type").alias("variant_class"), F.lit(source).alias("source"), F.col("e.gene_id").alias("genes"),
        F.concat(F.col("e.chrom"), F.lit(":"), F.array_join(F.transform(F.get("e.groups", F.lit(0)), lambda x: x.cast("string")), "-")).alias("locus"), number(pick(t, ["confidence"])).alias("confidence"), number(pick(t, ["dPSI"])).alias("dpsi"), number(pick(t, ["p_val", "pval", "p-value"])).alias("p_val"),
    )
    return manifest(out, "splice", F.struct("e.gene_id", "e.event_type", "e.chrom", "e.strand", "e.groups", "event_id", "dpsi", "p_val"))


CIRCLE_ID = "^(\\w+):(\\d+)[-|](\\d+)(?::?([+-]))?"


def read_circles(spark: SparkSession, path: str, source: str = "circrna") -> DataFrame:
    """Back-splice junctions by id, else by three columns; ends may be swapped.
    A header line is needed."""
    t = table(spark, path, separator(spark, path))
    ident = pick(t, ["circRNA_id", "circRNA", "circ_id", "id", "name"])
    by_id = lambda i: F.nullif(F.regexp_extract(ident, CIRCLE_ID, i), F.lit(""))
    chrom = F.coalesce(by_id(1), pick(t, ["chrom", "chr", "#chrom"]))
    a = F.coalesce(by_id(2), pick(t, ["start", "chromStart"])).try_cast("bigint")
    b = F.coalesce(by_id(3), pick(t, ["end", "chromEnd", "stop"])).try_cast("bigint")
    rows = t.select("ord", chrom.alias("chrom"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end"), F.coalesce(by_id(4), pick(t, ["strand"]), F.lit("")).alias("strand"), F.coalesce(pick(t, ["gene", "host_gene", "gene_name"]), F.lit("")).alias("gene"), number(pick(t, ["confidence", "score"])).alias("confidence"))
    rows = rows.where("chrom IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL")
    locus = F.concat("chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    out = rows.select("*", F.concat(F.lit("CIRC:"), locus).alias("variant_id"), F.lit("CIRCRNA").alias("variant_class"), F.lit(source).alias("source"), F.col("gene").alias("genes"), locus.alias("locus"))
    return manifest(out, "circle", F.struct("chrom", "start", "end", "strand", "gene"))


#: Order of sources in the manifest.
READERS = {"small_variants": read_vcf, "rna_editing": read_editing, "fusion": read_fusions, "splicing": read_splicing, "circrna": read_circles}


def read_manifest(spark: SparkSession, inputs: dict[str, str], **vcf: bool) -> DataFrame:
    """All sources, in their order; the first row of each variant id wins.
    ``variant_ord`` is a row's place in the manifest."""
    from ..operators.relational import first_wins

    parts = []
    for i, (role, reader) in enumerate(READERS.items()):
        if inputs.get(role):
            made = reader(spark, inputs[role], **(vcf if role == "small_variants" else {}))
            parts.append(made.withColumn("variant_ord", F.lit(i).cast("bigint") * (1 << 56) + F.col("ord")).drop("ord"))
    if not parts:
        raise ValueError("no evidence input is named")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return first_wins(every, ["variant_id"], [F.col("variant_ord")])
