"""Reference scans: annotation, genome, proteomes, lists and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import headers as H
from ..functions import sequence as S
from ..operators.relational import merged
from .evidence import number, pick, table
from .genome import CHUNK, genome_chunks

FEATURES = ("exon", "CDS", "Selenocysteine")


def attribute(text: Column, key: str) -> Column:
    """The first value of a GTF attribute."""
    return F.nullif(F.regexp_extract(text, f'(?:^|[;\\s]){key} "([^"]*)"', 1), F.lit(""))


def read_gtf(spark: SparkSession, path: str, coding_only: bool = True) -> DataFrame:
    """One row per transcript: ids, chrom, strand, biotypes, tags, exons and cds
    in transcription order, frame of the first cds block, Sec sites, and sizes.
    Only wanted features pass the first split; an empty biotype passes."""
    f = F.split("value", "\t")
    part = lambda i: F.get(f, F.lit(i))
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(part(2).isin(*FEATURES))
    a = F.col("attrs")
    named = rows.select(part(0).alias("chrom"), part(2).alias("feature"), part(3).cast("bigint").alias("s"), part(4).cast("bigint").alias("e"), part(6).alias("strand"), F.coalesce(part(7).try_cast("int"), F.lit(0)).alias("frame"), part(8).alias("attrs"))
    kept = named.select("chrom", "feature", "s", "e", "strand", "frame", attribute(a, "transcript_id").alias("tx_id"), attribute(a, "gene_id").alias("gene_id"), attribute(a, "gene_name").alias("gene_name"), F.coalesce(attribute(a, "gene_type"), attribute(a, "gene_biotype"), F.lit("")).alias("biotype"), F.coalesce(attribute(a, "transcript_type"), attribute(a, "transcript_biotype"), F.lit("")).alias("tx_biotype"), F.regexp_extract_all(a, F.lit('tag "([^"]*)"'), F.lit(1)).alias("tags")).where("tx_id IS NOT NULL")
    if coding_only:
        kept = kept.where(F.col("tx_biotype").isin("", "protein_coding", "nonsense_mediated_decay", "non_stop_decay", "protein_coding_LoF", "IG_V_gene", "IG_C_gene", "TR_V_gene", "TR_C_gene") | (F.col("feature") == "CDS"))
    block = F.struct("s", "e", "frame")
    of = lambda feature: F.array_sort(F.collect_set(F.when(F.col("feature") == feature, block)))
    grouped = kept.groupBy("tx_id", "chrom", "strand").agg(F.first("gene_id", True).alias("gene_id"), F.coalesce(F.first("gene_name", True), F.first("gene_id", True)).alias("gene_name"), F.max("biotype").alias("biotype"), F.max("tx_biotype").alias("tx_biotype"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("tags")))).alias("tags"), of("exon").alias("x"), of("CDS").alias("c"), of("Selenocysteine").alias("sec"))
    turned = lambda x: F.when(F.col("strand") == "-", F.reverse(x)).otherwise(x)
    bare = lambda x: F.transform(x, lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e")))
    out = grouped.where(F.size("x") > 0).select("tx_id", "gene_id", "gene_name", "chrom", "strand", "biotype", "tx_biotype", "tags", turned(bare(F.col("x"))).alias("exons"), turned(bare(F.col("c"))).alias("cds"), F.coalesce(F.get(turned(F.col("c")), F.lit(0))["frame"], F.lit(0)).alias("phase"), F.transform("sec", lambda b: F.when(F.col("strand") == "+", b["s"]).otherwise(b["e"])).alias("sec_sites"))
    return sized(out)


def sized(t: DataFrame) -> DataFrame:
    """Transcripts with start, end, lengths and the offset of their cds."""
    return t.select("*", F.array_min(F.transform("exons", lambda b: b["s"])).alias("start"), F.array_max(F.transform("exons", lambda b: b["e"])).alias("end"), S.total_length(F.col("exons")).alias("tx_len"), S.total_length(F.col("cds")).alias("cds_len"), (F.size("cds") > 0).alias("is_coding"), S.cds_offset(F.col("exons"), F.col("cds"), F.col("strand"), F.col("phase")).alias("cds_off"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(ord, header, sequence, line_lengths): entries of a FASTA file; lines
    that begin with # are skipped."""
    raw = spark.read.option("lineSep", "\n>").text(path).withColumn("ord", F.monotonically_increasing_id())
    rows = F.filter(F.split(F.regexp_replace("value", "\r", ""), "\n"), lambda x: ~x.startswith("#") & (x != ""))
    found = raw.select("ord", rows.alias("r")).where(F.size("r") > 0)
    body = F.slice("r", F.lit(2), F.size("r"))
    return found.select("ord", F.regexp_replace(F.get("r", F.lit(0)), "^>", "").alias("header"), F.upper(F.regexp_replace(F.array_join(body, ""), "\\s", "")).alias("sequence"), F.transform(body, F.length).alias("line_lengths"))


def genome(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """(contig, chunk_no, seq): chunks of fixed size for joins by position."""
    return genome_chunks(spark, path, chunk)


def bare_contig(name: Column) -> Column:
    """A contig's name without its prefix; mitochondrial spellings are one."""
    stripped = F.regexp_replace(name, "^(?i)chr", "")
    return F.when(stripped.isin("M", "MT"), "MT").otherwise(stripped)


def transcript_sequences(transcripts: DataFrame, chunks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(tx_id, tx_seq): exons joined in transcription order, complemented on the
    minus strand.  Exons meet the genome chunks they touch; nothing is fetched
    by position."""
    exon = transcripts.select("tx_id", "strand", bare_contig(F.col("chrom")).alias("c"), F.posexplode("exons").alias("i", "x")).select("tx_id", "strand", "c", "i", F.col("x.s").alias("s"), F.col("x.e").alias("e"))
    parts = exon.withColumn("chunk_no", F.explode(F.sequence(F.floor((F.col("s") - 1) / chunk).cast("int"), F.floor((F.col("e") - 1) / chunk).cast("int"))))
    joined = parts.join(merged(chunks.select(bare_contig(F.col("contig")).alias("c"), "chunk_no", "seq")), ["c", "chunk_no"])
    base = F.col("chunk_no").cast("bigint") * chunk
    first, last = F.greatest(F.col("s"), base + 1), F.least(F.col("e"), base + chunk)
    cut = F.substring("seq", (first - base).cast("int"), F.greatest(F.lit(0), last - first + 1).cast("int"))
    pieces = joined.select("tx_id", "strand", "i", "chunk_no", cut.alias("p"))
    per_exon = pieces.groupBy("tx_id", "strand", "i").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "p"))), lambda x: x["p"]), "").alias("p"))
    turned = per_exon.withColumn("p", F.when(F.col("strand") == "-", S.revcomp("p")).otherwise(F.col("p")))
    return turned.groupBy("tx_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "p"))), lambda x: x["p"]), "").alias("tx_seq"))


def proteome(spark: SparkSession, path: str) -> DataFrame:
    """Entries with their header's fields; headers without the grammar are left
    out together with their sequence."""
    rows = fasta(spark, path).select("ord", H.uniprot_fields("header").alias("h"), "sequence")
    return rows.select("ord", "h.*", "sequence").where(F.length("accession") > 0)


def translations(spark: SparkSession, path: str) -> DataFrame:
    """(tx_id, sequence): the second bar field is the transcript; a last stop goes."""
    return fasta(spark, path).select(F.get(F.split("header", "\\|"), F.lit(1)).alias("tx_id"), F.rtrim(F.col("sequence"), F.lit("*")).alias("sequence")).where("tx_id IS NOT NULL")


GENE_NAMES = ("gene_id", "gene", "Gene", "Name", "target_id", "gene_name")
VALUE_NAMES = ("TPM", "tpm", "FPKM", "value", "expression", "count")


def expressed_genes(spark: SparkSession, path: str, least: float = 0.0, gene_col: str | None = None, value_col: str | None = None) -> DataFrame:
    """(gene): genes at or over a value, with and without their version."""
    t = table(spark, path, "\t")
    have = {c.lower() for c in t.columns}
    for given, names, what in ((gene_col, GENE_NAMES, "gene"), (value_col, VALUE_NAMES, "value")):
        if not ({given.lower()} if given else {n.lower() for n in names}) & have:
            raise ValueError(f"the expression table has no {what} column")
    gene, value = pick(t, [gene_col] if gene_col else list(GENE_NAMES)), number(pick(t, [value_col] if value_col else list(VALUE_NAMES)))
    kept = t.select(gene.alias("g"), value.alias("v")).where(F.col("v") >= least)
    return kept.select(F.explode(F.array("g", F.substring_index("g", ".", 1))).alias("gene")).distinct()


def peptide_list(spark: SparkSession, path: str) -> DataFrame:
    """(k): one peptide per line, folded; # lines are skipped."""
    rows = spark.read.text(path).select(F.trim("value").alias("p")).where((F.col("p") != "") & ~F.col("p").startswith("#"))
    return rows.select(F.translate("p", "I", "L").alias("k")).distinct()


def junction_matrix(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Wanted junctions of a wide count matrix: only the first column is split
    off, and the matrix is reduced by a semi-join at once."""
    first = spark.read.text(path).select(F.substring_index("value", "\t", 1).alias("junction"))
    return first.join(wanted.select("junction").distinct(), "junction", "left_semi").distinct()


def junction_catalogue(spark: SparkSession, pattern: str, wanted: DataFrame) -> DataFrame:
    """(junction, tissues): files of one tissue each; coordinates of introns
    become those of the exons' ends."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(pattern).withColumn("tissue", F.input_file_name())
    chrom, start, end = (pick(rows, [n]) for n in ("chrom", "start", "end"))
    named = rows.select("tissue", F.concat(chrom, F.lit(":"), (start.cast("bigint") - 1).cast("string"), F.lit("-"), (end.cast("bigint") + 1).cast("string")).alias("junction"))
    return named.join(wanted.select("junction").distinct(), "junction", "left_semi").groupBy("junction").agg(F.count_distinct("tissue").alias("tissues"))


def truth_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).option("comment", "#").csv(path)


def observed_changes(spark: SparkSession, provenance: str, target: str | None = None) -> DataFrame:
    """(locus, changes) of a written release: by its nested provenance, and by
    the headers of its FASTA parts for loci that the provenance lacks.  A
    header alone is not enough: records of equal sequence share one."""
    rows = spark.read.schema("variants array<struct<locus:string,protein_change:string>>").json(provenance).select(F.explode("variants").alias("v")).select("v.locus", F.col("v.protein_change").alias("change"))
    said = lambda df: df.where("locus <> '' AND change <> ''")
    known = said(rows)
    if target is not None:
        header = F.substring("value", F.lit(2), F.length("value"))
        keys = H.header_map(header)
        change = F.coalesce(F.try_element_at(keys, F.lit("CHANGE")), F.nullif(F.regexp_extract(header, "(?:^|\\s)(p\\.\\S+)", 1), F.lit("")))
        named = said(spark.read.text(target).where(F.col("value").startswith(">")).select(F.try_element_at(keys, F.lit("LOC")).alias("locus"), change.alias("change")))
        known = known.unionByName(named.join(known.select("locus").distinct(), "locus", "left_anti"))
    return known.groupBy("locus").agg(F.array_sort(F.collect_set("change")).alias("changes"))
