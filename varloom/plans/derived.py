"""The builders and scans over a genome that is derived from the tables.

Every part has a gene of two exons in a chunk of its own, on five contigs and on
either strand; its bases are the digest of its key.  The builders run on it as
they do on an annotation, and SQL says the same of the digest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import headers as H
from ..functions import peptides as P
from ..functions import sequence as S
from ..operators.relational import dealt, merged
from ..session import use_checkpoints
from ..sources import evidence
from ..sources import genome as G
from ..sources.reference import sized, transcript_sequences
from . import audits, build, constructed, events, faults, package
from .generic import SQL_CODE, SQL_FRAGMENTS, SQL_JX, SQL_SEQ, as_entries, entries, exons, query, reference_keys, sql_nt, sql_peptides, table

#: Bases of a gene, its exons within them (1-based), and where translation begins on the transcript.
GENE, EXONS, CDS_OFF = 128, ((1, 44), (61, 124)), 4
CONTIGS = 5


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that the cluster names."""
    use_checkpoints(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def gene_place(key: Column) -> tuple[Column, Column]:
    """(contig, base before the gene)."""
    return F.concat(F.lit("chr"), (key % CONTIGS).cast("string")), F.floor(key / CONTIGS) * G.CHUNK


def derived_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return dealt(table(spark, sf_dir, "part"), "p_partkey").select(gene_place(key)[0].alias("contig"), F.floor(key / CONTIGS).cast("int").alias("chunk_no"), P.nucleotides(key, GENE // 32).alias("seq"))


def derived_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transcript for each part, shaped as the annotation's are."""
    key = F.col("p_partkey")
    contig, base = gene_place(key)
    minus = key % 2 == 1
    block = lambda s, e: F.struct((base + s).cast("bigint").alias("s"), (base + e).cast("bigint").alias("e"))
    turned = lambda *blocks: F.when(minus, F.array(*reversed(blocks))).otherwise(F.array(*blocks))
    (s1, e1), (s2, e2) = EXONS
    # the coding part leaves the same number of bases at either end
    rows = dealt(table(spark, sf_dir, "part"), "p_partkey").select(
        F.concat(F.lit("T"), key.cast("string")).alias("tx_id"), F.concat(F.lit("G"), key.cast("string")).alias("gene_id"), F.concat(F.lit("N"), key.cast("string")).alias("gene_name"), contig.alias("chrom"), F.when(minus, "-").otherwise("+").alias("strand"),
        F.lit("protein_coding").alias("biotype"), F.lit("protein_coding").alias("tx_biotype"), F.array().cast("array<string>").alias("tags"), turned(block(s1, e1), block(s2, e2)).alias("exons"), turned(block(s1 + CDS_OFF, e1), block(s2, e2 - CDS_OFF)).alias("cds"), F.lit(0).alias("phase"),
        F.array().cast("array<bigint>").alias("sec_sites"), key.alias("key"), "p_size",
    )
    return sized(rows)


def derived(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(transcripts, sequences, chunks); sequences are read several times, and
    written once."""
    use_checkpoints(spark)
    transcripts, chunks = derived_transcripts(spark, sf_dir), derived_chunks(spark, sf_dir)
    return transcripts, transcript_sequences(transcripts, chunks).checkpoint(), chunks


SQL_GENE = f"SELECT p_partkey AS key, p_size, {sql_nt('p_partkey', GENE // 32)} AS nt FROM part"
SQL_TX = f"""g AS ({SQL_GENE}), x AS (SELECT key, p_size, key % 2 = 1 AS minus, CASE WHEN key % 2 = 1 THEN reverse(translate(substr(nt, 1, 44) || substr(nt, 61, 64), 'ACGT', 'TGCA')) ELSE substr(nt, 1, 44) || substr(nt, 61, 64) END AS seq FROM g)"""


def sql_codons(seq: str) -> str:
    return f"list_transform(range(0, length({seq}) // 3), lambda i: substr({seq}, CAST(3 * i + 1 AS BIGINT), 3))"


def sql_read(codons: str, sec: bool = False) -> str:
    """A list of codons as residues up to the first stop."""
    one = f"coalesce({SQL_CODE}[c], 'X')"
    return f"split_part(array_to_string(list_transform({codons}, lambda c: {f'''CASE WHEN c = 'TGA' THEN 'U' ELSE {one} END''' if sec else one}), ''), '*', 1)"


# ---------------------------------------------------------------- genome scans

FASTA_CHUNK = 4_096
_SQL_LETTERS = "translate(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"


@query(f"""WITH s AS (SELECT doc_id, {_SQL_LETTERS} AS seq FROM documents), c AS (SELECT doc_id, seq, unnest(range(0, CAST(ceil(length(seq) / {FASTA_CHUNK}) AS BIGINT))) AS chunk_no FROM s)
SELECT 'chr' || doc_id AS contig, CAST(chunk_no AS INTEGER) AS chunk_no, CAST(length(substr(seq, chunk_no * {FASTA_CHUNK} + 1, {FASTA_CHUNK})) AS INTEGER) AS n_bases, md5(substr(seq, chunk_no * {FASTA_CHUNK} + 1, {FASTA_CHUNK})) AS bases_md5 FROM c""")
def genome_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as a FASTA file, a contig each, and read as chunks."""
    bases = F.translate(F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")), "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")
    path = scratch(spark, "fasta")
    rows = table(spark, sf_dir, "documents").select("doc_id", bases.alias("seq"))
    rows.select(F.concat(F.lit(">chr"), F.col("doc_id").cast("string"), F.lit(" a document\n"), H.wrapped("seq", 60))).write.text(path)
    found = G.genome_chunks(spark, path, FASTA_CHUNK)
    return found.select("contig", "chunk_no", F.length("seq").alias("n_bases"), F.md5("seq").alias("bases_md5"))


@query("""WITH c AS (SELECT CASE p_partkey % 3 WHEN 0 THEN 'chr' || p_partkey WHEN 1 THEN CAST(p_partkey AS VARCHAR) ELSE 'chrchr' || p_partkey END AS contig FROM part UNION ALL SELECT 'MT'),
n AS (SELECT DISTINCT CASE l_linenumber WHEN 1 THEN 'chr' || l_partkey WHEN 2 THEN CAST(l_partkey AS VARCHAR) WHEN 3 THEN 'chrchr' || l_partkey WHEN 4 THEN 'chrM' WHEN 5 THEN 'M' ELSE 'scaffold' || l_partkey END AS chrom FROM lineitem),
o AS (SELECT contig AS alias, 1 AS tier, contig FROM c UNION ALL SELECT CASE WHEN starts_with(contig, 'chr') THEN substr(contig, 4) ELSE 'chr' || contig END, 2, contig FROM c UNION ALL SELECT m, 3, contig FROM c, (SELECT unnest(['chrM', 'MT', 'M', 'chrMT']) AS m) WHERE contig IN ('chrM', 'MT', 'M', 'chrMT'))
SELECT chrom, first(contig ORDER BY tier, contig) AS contig FROM n LEFT JOIN o ON chrom = alias GROUP BY chrom""")
def contig_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in several styles, and the contigs they stand for."""
    key, line = F.col("p_partkey").cast("string"), F.col("l_partkey").cast("string")
    own = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("chr"), key)).when(F.col("p_partkey") % 3 == 1, key).otherwise(F.concat(F.lit("chrchr"), key))
    contigs = table(spark, sf_dir, "part").select(own.alias("contig")).union(spark.createDataFrame([("MT",)], "contig string"))
    n = F.col("l_linenumber")
    name = F.when(n == 1, F.concat(F.lit("chr"), line)).when(n == 2, line).when(n == 3, F.concat(F.lit("chrchr"), line)).when(n == 4, "chrM").when(n == 5, "M").otherwise(F.concat(F.lit("scaffold"), line))
    names = table(spark, sf_dir, "lineitem").select(name.alias("chrom")).distinct()
    return G.resolved(names, "chrom", contigs)


#: Lines as variants of sequence style: an accession, a 0-based position, what goes and what comes; some are not readable.
_SQL_SPDI = """SELECT l_orderkey, l_linenumber, 'NC_' || CASE WHEN l_partkey % 29 = 27 THEN '012920.1' ELSE lpad(CAST(l_partkey % 29 AS VARCHAR), 6, '0') || '.' || (l_suppkey % 12) END AS acc,
 CAST(CASE WHEN l_quantity = 13 THEN 'x' WHEN l_quantity = 17 THEN '-1' ELSE CAST(l_orderkey * 37 % 4000 AS VARCHAR) END AS VARCHAR) AS place,
 CASE l_linenumber WHEN 1 THEN 'A' WHEN 2 THEN '' WHEN 3 THEN 'acg' WHEN 4 THEN 'A' WHEN 5 THEN '' ELSE 'Z' END AS gone, CASE l_linenumber WHEN 1 THEN 'T' WHEN 2 THEN 'GATT' WHEN 3 THEN '' WHEN 4 THEN 'g' WHEN 5 THEN '' ELSE 'C' END AS new FROM lineitem"""
_SPDI_CHUNK = 32
_SQL_NC = "CASE WHEN n BETWEEN 1 AND 22 THEN 'chr' || n WHEN n = 23 THEN 'chrX' WHEN n = 24 THEN 'chrY' WHEN n = 25 THEN 'MT' END"


@query(f"""WITH g AS (SELECT {_SQL_NC} AS contig, p_partkey // 25 AS chunk_no, {sql_nt('p_partkey', 1)} AS seq FROM (SELECT p_partkey, 1 + p_partkey % 25 AS n FROM part)),
r AS (SELECT *, acc || ':' || place || ':' || gone || ':' || new || CASE WHEN l_quantity = 19 THEN ':x' ELSE '' END AS spdi, try_cast(CASE WHEN regexp_full_match(place, '[0-9]+') THEN place END AS BIGINT) AS p, try_cast(nullif(regexp_extract(acc, '^NC_0000(\\d\\d)\\.\\d+$', 1), '') AS INTEGER) AS n FROM ({_SQL_SPDI.replace("l_linenumber,", "l_linenumber, l_quantity,", 1)})),
c AS (SELECT *, CASE WHEN acc LIKE 'NC_012920%' THEN 'chrM' WHEN n <= 24 THEN {_SQL_NC} END AS chrom, upper(gone) AS x, upper(new) AS y FROM r),
f AS (SELECT *, CASE WHEN l_quantity = 19 OR p IS NULL THEN 'not_readable' WHEN chrom IS NULL THEN 'unknown_accession' WHEN NOT regexp_full_match(x, '[ACGTN]*') OR NOT regexp_full_match(y, '[ACGTN]*') THEN 'not_bases' WHEN x = '' AND y = '' THEN 'no_change' WHEN (x = '' OR y = '') AND p < 1 THEN 'no_base_before' END AS problem FROM c),
h AS (SELECT f.*, nullif(substr(g.seq, (p - 1) % {_SPDI_CHUNK} + 1, 1), '') AS anchor FROM f LEFT JOIN g ON problem IS NULL AND (x = '' OR y = '') AND g.contig = CASE WHEN chrom = 'chrM' THEN 'MT' ELSE chrom END AND g.chunk_no = (p - 1) // {_SPDI_CHUNK}),
z AS (SELECT *, CASE WHEN problem IS NULL AND (x = '' OR y = '') AND anchor IS NULL THEN 'no_base_before' ELSE problem END AS q FROM h)
SELECT l_orderkey, l_linenumber, spdi, CASE WHEN q IS NULL THEN chrom END AS chrom, CASE WHEN q IS NULL THEN p + CASE WHEN x = '' OR y = '' THEN 0 ELSE 1 END END AS pos,
 CASE WHEN q IS NULL THEN CASE WHEN x = '' OR y = '' THEN anchor || x ELSE x END END AS ref, CASE WHEN q IS NULL THEN CASE WHEN x = '' OR y = '' THEN anchor || y ELSE y END END AS alt, q AS problem FROM z""")
def spdi_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence-style variants written as genomic ones, with anchor bases from
    a genome of human contigs."""
    n = 1 + F.col("p_partkey") % 25
    contig = F.when(n <= 22, F.concat(F.lit("chr"), n.cast("string"))).when(n == 23, "chrX").when(n == 24, "chrY").otherwise("MT")
    chunks = dealt(table(spark, sf_dir, "part"), "p_partkey").select(contig.alias("contig"), F.floor(F.col("p_partkey") / 25).cast("int").alias("chunk_no"), P.nucleotides(F.col("p_partkey")).alias("seq"))
    key, line, quantity = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_quantity")
    acc = F.when(key % 29 == 27, "012920.1").otherwise(F.concat(F.lpad((key % 29).cast("string"), 6, "0"), F.lit("."), (F.col("l_suppkey") % 12).cast("string")))
    at = F.when(quantity == 13, "x").when(quantity == 17, "-1").otherwise((F.col("l_orderkey") * 37 % 4000).cast("string"))
    gone = F.when(line.isin(1, 4), "A").when(line.isin(2, 5), "").when(line == 3, "acg").otherwise("Z")
    new = F.when(line == 1, "T").when(line == 2, "GATT").when(line.isin(3, 5), "").when(line == 4, "g").otherwise("C")
    spdi = F.concat(F.lit("NC_"), acc, F.lit(":"), at, F.lit(":"), gone, F.lit(":"), new, F.when(quantity == 19, ":x").otherwise(""))
    rows = dealt(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", spdi.alias("spdi"))
    return constructed.spdi_to_vcf(rows, "spdi", chunks, _SPDI_CHUNK)


@query("""SELECT 'chr' || n_nationkey AS contig, CAST(1000 + n_nationkey * 10 AS BIGINT) AS length, coalesce(k, 0) AS n_records, lowest FROM nation LEFT JOIN
 (SELECT o_custkey % 25 AS c, count(*) AS k, min(o_orderkey) AS lowest FROM orders GROUP BY 1) ON c = n_nationkey""")
def vcf_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A VCF written from orders, with a contig definition for each nation: its
    header as a table, joined with its body as it is read back."""
    path = scratch(spark, "vcf")
    key = F.col("o_orderkey").cast("string")
    line = F.concat_ws("\t", F.concat(F.lit("chr"), (F.col("o_custkey") % 25).cast("string")), key, F.lit("."), F.lit("A"), F.lit("T"), F.lit("."), F.lit("PASS"), F.concat(F.lit("AC="), key))
    contig = F.concat(F.lit("##contig=<ID=chr"), F.col("n_nationkey").cast("string"), F.lit(",length="), (1000 + F.col("n_nationkey") * 10).cast("string"), F.lit(">"))
    head = table(spark, sf_dir, "nation").agg(F.array_join(F.array_sort(F.collect_list(contig)), "\n").alias("h")).select(F.concat(F.lit("##fileformat=VCFv4.2\n"), "h", F.lit("\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")).alias("value"))
    head.coalesce(1).write.text(f"{path}/head")
    table(spark, sf_dir, "orders").select(line).write.text(f"{path}/body")
    lines = evidence.whole_vcf(spark, [f"{path}/head", f"{path}/body"])
    defined = evidence.definitions(lines).where("kind = 'contig'").select(F.col("id").alias("contig"), "length")
    fields = F.split("value", "\t")
    body = lines.where("NOT header").select(F.get(fields, F.lit(0)).alias("contig"), F.get(fields, F.lit(1)).cast("bigint").alias("pos")).groupBy("contig").agg(F.count("*").alias("n_records"), F.min("pos").alias("lowest"))
    return defined.join(body, "contig", "left").select("contig", "length", F.coalesce("n_records", F.lit(0)).alias("n_records"), "lowest")


# ---------------------------------------------------------------- rows without a builder

_PLACE = "a position is missing or on no contig"


@query(f"""WITH v AS (SELECT CAST(o_orderkey AS VARCHAR) AS variant_id, o_orderpriority AS variant_class, CASE o_custkey % 31 WHEN 3 THEN NULL WHEN 5 THEN ' ' ELSE 'chr' || o_custkey % 5 END AS chrom,
 CASE o_orderkey % 11 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN 9223372036854775807 ELSE o_orderkey END AS pos, CASE o_custkey % 7 WHEN 0 THEN 'R' WHEN 1 THEN '' ELSE 'AC' END AS ref, CASE WHEN o_orderkey % 37 = 7 THEN NULL ELSE 'G' END AS alt, o_orderstatus = 'F' AS fusion FROM orders),
f AS (SELECT *, CASE WHEN coalesce(trim(chrom), '') = '' THEN 'no contig is named' WHEN coalesce(pos NOT BETWEEN 1 AND 2147483647, true) THEN '{_PLACE}' WHEN fusion AND coalesce(alt, '') = '' THEN 'a partner has no name'
  WHEN NOT fusion AND (coalesce(ref IN ('R', ''), true) OR alt IS NULL) THEN 'alleles are not bases' WHEN chrom = 'chr3' THEN 'the genome lacks the contig' END AS detail FROM v)
SELECT variant_id, variant_class, CAST(CASE WHEN detail IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_proteins, CASE WHEN detail IS NULL THEN 'protein_built' ELSE 'error' END AS outcome, coalesce(detail, 'missense') AS detail FROM f""")
def row_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of a manifest with every kind of unreadable row: each is one
    error, and all others are built."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    chrom = F.when(customer % 31 == 5, " ").when(customer % 31 != 3, F.concat(F.lit("chr"), (customer % 5).cast("string")))
    pos = F.when(key % 11 == 0, 0).when(key % 11 == 2, (1 << 63) - 1).when(key % 11 != 1, key)
    ref = F.when(customer % 7 == 0, "R").when(customer % 7 == 1, "").otherwise("AC")
    alt = F.when(key % 37 != 7, "G")
    fusion = F.col("o_orderstatus") == "F"
    small = F.struct(chrom.alias("chrom"), pos.cast("bigint").alias("pos"), ref.alias("ref"), alt.alias("alt"), F.lit(None).cast("double").alias("af"))
    pair = F.struct(alt.alias("gene1"), chrom.alias("chrom1"), pos.cast("bigint").alias("pos1"), F.lit("G2").alias("gene2"), F.lit("chr1").alias("chrom2"), F.lit(5).cast("bigint").alias("pos2"))
    manifest = table(spark, sf_dir, "orders").select(key.cast("string").alias("variant_id"), F.col("o_orderpriority").alias("variant_class"), F.when(~fusion, small).alias("small"), F.when(fusion, pair).alias("fusion"))
    unread = spark.createDataFrame([("3",)], "contig string")
    sound, failed = faults.screened(manifest, unread, ("small", "fusion"))
    # a record for each sound row, by arithmetic that an unreadable one would not stand
    end = F.coalesce(F.col("small.pos") + F.length("small.ref"), F.col("fusion.pos1") + F.col("fusion.pos2"))
    made = sound.select("variant_id", F.repeat(F.lit("A"), (end % 5 + 8).cast("int")).alias("sequence"), F.lit("missense").alias("consequence"), F.lit("").alias("gene"))
    return package.dispositions(manifest, made, failed=failed)[1]


@query(f"""WITH s AS (SELECT doc_id AS id, {SQL_SEQ} AS seq, lang, source FROM documents WHERE doc_id % 3 <> 0), b AS (SELECT item_id AS id, {SQL_SEQ} AS seq FROM benchmark),
{sql_peptides("pep", "s")}, {sql_peptides("ref", "b")}, r AS (SELECT DISTINCT replace(p, 'I', 'L') AS k FROM ref),
n AS (SELECT lang, replace(p, 'I', 'L') AS k FROM pep JOIN s USING (id) WHERE replace(p, 'I', 'L') NOT IN (SELECT k FROM r))
SELECT class, count(DISTINCT k) AS n_added FROM (SELECT lang AS class, k FROM n UNION ALL SELECT 'release', k FROM n) GROUP BY class""")
def search_space_without_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search space of a release whose entries on transcripts that decay
    are left out: their peptides don't count."""
    rows = as_entries(entries(spark, sf_dir), "lang").withColumn("nmd", F.when(F.col("entry_id") % 3 == 0, "likely").when(F.col("entry_id") % 3 == 1, "unlikely"))
    return package.search_space(package.peptide_rows(package.without_decay(rows), reference_keys(spark, sf_dir), fields=("entry_id", "classes")))


# ---------------------------------------------------------------- builders

#: Published changes of a gene: a residue, often the one that is there, its number, and one that some edit gives.
_TO = "GERVMSD*K"


@query(f"""WITH {SQL_TX}, l AS (SELECT DISTINCT l_partkey AS key, CAST(l_quantity AS BIGINT) % 40 AS no, substr('{_TO}', CAST(1 + l_suppkey % {len(_TO)} AS BIGINT), 1) AS t, l_linenumber = 1 AS lie FROM lineitem),
c AS (SELECT l.*, minus, seq, CASE WHEN no > 0 THEN substr(seq, CAST({CDS_OFF} + 3 * (no - 1) + 1 AS BIGINT), 3) END AS codon FROM l JOIN x USING (key)),
d AS (SELECT *, CASE WHEN length(codon) = 3 THEN {SQL_CODE}[codon] END AS own FROM c), e AS (SELECT *, CASE WHEN lie THEN 'W' ELSE coalesce(own, 'A') END AS f FROM d),
h AS (SELECT *, list_filter([0, 1, 2], lambda i: substr(codon, CAST(i + 1 AS BIGINT), 1) = 'A' AND {SQL_CODE}[substr(codon, 1, CAST(i AS BIGINT)) || 'G' || substr(codon, CAST(i + 2 AS BIGINT))] = t)[1] AS edit FROM e),
p AS (SELECT *, 'p.' || f || no || t AS change, {CDS_OFF} + 3 * (no - 1) + edit AS off, CASE WHEN no = 0 OR length(codon) < 3 THEN 'beyond_the_end' WHEN own <> f THEN 'another_residue' WHEN edit IS NULL THEN 'no_single_edit' END AS problem FROM h)
SELECT 'N' || key AS gene, change, problem, CASE WHEN problem IS NULL THEN (key // {CONTIGS}) * {G.CHUNK} + CASE WHEN minus THEN CASE WHEN off < 64 THEN 124 - off ELSE 44 - (off - 64) END ELSE CASE WHEN off < 44 THEN 1 + off ELSE 61 + off - 44 END END END AS pos,
 CASE WHEN problem IS NULL THEN CASE WHEN minus THEN 'T' ELSE 'A' END END AS ref, CASE WHEN problem IS NULL THEN codon END AS codon FROM p""")
def published_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genomic sites of published recodings."""
    transcripts, sequences, _ = derived(spark, sf_dir)
    no = F.col("l_quantity").cast("bigint") % 40
    letter = F.substring(F.lit(_TO), (1 + F.col("l_suppkey") % len(_TO)).cast("int"), F.lit(1))
    asked = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key"), no.alias("no"), letter.alias("t"), (F.col("l_linenumber") == 1).alias("lie")).distinct()
    own = transcripts.join(merged(sequences), "tx_id").select("key", S.residues(F.substring("tx_seq", F.lit(CDS_OFF + 1), F.length("tx_seq"))).alias("aas"))
    there = F.when(F.col("no") > 0, F.get("aas", (F.col("no") - 1).cast("int")))
    named = asked.join(merged(own), "key").select(F.concat(F.lit("N"), F.col("key").cast("string")).alias("gene"), F.concat(F.lit("p."), F.when(F.col("lie"), "W").otherwise(F.coalesce(there, F.lit("A"))), F.col("no").cast("string"), "t").alias("change"))
    return constructed.editing_sites(named, transcripts, sequences).select("gene", "change", "problem", "pos", "ref", "codon")


@query(f"""WITH {SQL_TX}, c AS (SELECT key, {sql_codons(f"substr(seq, {CDS_OFF + 1})")} AS cs FROM x), r AS (SELECT key, {sql_read("cs")} AS short, {sql_read("cs", True)} AS whole FROM c)
SELECT 'SECT_N' || key || '_T' || key AS seq_id, short AS sequence, 'p.U' || (length(short) + 1) || '*' AS protein_change, CAST(length(short) AS BIGINT) AS variant_pos_aa, whole AS ref_protein FROM r WHERE length(short) >= 4 AND short <> whole""")
def sec_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proteins that end at a selenocysteine: every codon is said to be a site,
    and those that read as a stop are."""
    transcripts, sequences, _ = derived(spark, sf_dir)
    codons = F.sequence(F.lit(0), F.lit(34))
    sites = F.filter(F.transform(codons, lambda i: S.tx_to_genomic(F.col("exons"), F.col("strand"), CDS_OFF + 3 * i)), lambda x: x.isNotNull())
    made = build.sec_termination(transcripts.withColumn("sec_sites", sites), sequences, 4)
    return made.select("seq_id", "sequence", "protein_change", "variant_pos_aa", "ref_protein")


_SQL_TURNS = " UNION ALL ".join(f"SELECT key, {f} AS frame, array_to_string(list_transform({sql_codons(f'substr(turns, {f + 1})')}, lambda c: {SQL_CODE}[c]), '') AS aas FROM y" for f in range(3))
_PERIOD = 108


@query(f"""WITH {SQL_TX}, y AS (SELECT key, repeat(seq, 3) AS turns FROM x), t AS ({_SQL_TURNS}), c AS (SELECT key, frame, string_split(aas, '*') AS cs FROM t), d AS (SELECT key, frame, cs, unnest(range(1, len(cs) + 1)) AS i FROM c),
o AS (SELECT key, frame, CASE WHEN contains(cs[i], 'M') THEN substr(cs[i], instr(cs[i], 'M')) ELSE '' END AS orf, length(array_to_string(cs[1:i - 1], '*')) + CASE WHEN i > 1 THEN 1 ELSE 0 END + CASE WHEN contains(cs[i], 'M') THEN instr(cs[i], 'M') - 1 ELSE 0 END AS off FROM d),
k AS (SELECT *, frame + 3 * off AS a, frame + 3 * off + 3 * length(orf) AS b FROM o WHERE length(orf) >= 10), w AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY length(orf) DESC, frame, a) AS n FROM k WHERE (b - 1) // {_PERIOD} > a // {_PERIOD})
SELECT 'C' || key AS variant_id, orf AS sequence, 'p.bsj@' || greatest(1, ({_PERIOD} - a) // 3 + 1) AS protein_change, CAST(greatest(1, ({_PERIOD} - a) // 3 + 1) AS BIGINT) AS variant_pos_aa, 'frame' || frame || ';translation_cycles_' || ((b - 1) // {_PERIOD} - a // {_PERIOD}) || ';crosses_backsplice_junction' AS notes FROM w WHERE n = 1""")
def circ_orfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open frames over the back-splice of circles, one circle for each gene."""
    transcripts, _, chunks = derived(spark, sf_dir)
    circles = transcripts.select(F.concat(F.lit("C"), F.col("key").cast("string")).alias("variant_id"), "chrom", "start", "end", "strand", F.col("gene_name").alias("gene"), F.lit("s").alias("source"), F.lit(None).cast("double").alias("confidence"))
    made = build.circles(circles, transcripts.drop("key", "p_size"), chunks, min_aa=10)
    return made.select("variant_id", "sequence", "protein_change", "variant_pos_aa", F.array_join("notes", ";").alias("notes"))


def sql_changed(*offsets: str) -> str:
    """x.seq with transitions at transcript offsets."""
    out = "seq"
    for o in offsets:
        out = f"(substr({out}, 1, CAST({o} AS BIGINT)) || translate(substr({out}, CAST({o} + 1 AS BIGINT), 1), 'ACGT', 'GTAC') || substr({out}, CAST({o} + 2 AS BIGINT)))"
    return out


_OFFS = [f"({CDS_OFF} + (p_size * 5 + {23 * i}) % 96)" for i in range(3)]
_SQL_PROTEIN = lambda seq: sql_read(sql_codons(f"substr({seq}, {CDS_OFF + 1})"))
#: Three substitutions of each gene: without phase, on one haplotype, or two on one and one on the other.
_SQL_COMBO = f"""WITH {SQL_TX}, m AS (SELECT *, CASE key % 3 WHEN 0 THEN 'unphased' ELSE 'b|0' END AS label, {_SQL_PROTEIN("seq")} AS ref_p, CASE WHEN key % 3 = 2 THEN {_SQL_PROTEIN(sql_changed(*_OFFS[:2]))} ELSE {_SQL_PROTEIN(sql_changed(*_OFFS))} END AS combo,
 CASE WHEN key % 3 = 2 THEN [{', '.join(_SQL_PROTEIN(sql_changed(o)) for o in _OFFS[:2])}] ELSE [{', '.join(_SQL_PROTEIN(sql_changed(o)) for o in _OFFS)}] END AS singles FROM x),
n AS (SELECT * FROM m WHERE combo <> '' AND combo <> ref_p), own_s AS (SELECT key AS id, combo AS seq FROM n), {sql_peptides("own", "own_s")},
forms AS (SELECT key, unnest(list_concat([ref_p], singles)) AS seq FROM n), forms_s AS (SELECT row_number() OVER () AS id, key, seq FROM forms), {sql_peptides("cov", "forms_s")},
held AS (SELECT DISTINCT key, replace(p, 'I', 'L') AS k FROM cov JOIN forms_s USING (id)), fresh AS (SELECT DISTINCT id AS key FROM own WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.key = own.id AND held.k = replace(own.p, 'I', 'L'))),
z AS (SELECT n.*, coalesce(list_filter(range(0, least(length(ref_p), length(combo))), lambda i: substr(ref_p, CAST(i + 1 AS BIGINT), 1) <> substr(combo, CAST(i + 1 AS BIGINT), 1))[1], least(length(ref_p), length(combo))) AS idx,
 list_transform(list_filter(range(0, least(length(ref_p), length(combo))), lambda i: substr(ref_p, CAST(i + 1 AS BIGINT), 1) <> substr(combo, CAST(i + 1 AS BIGINT), 1)), lambda i: substr(ref_p, CAST(i + 1 AS BIGINT), 1) || (i + 1) || substr(combo, CAST(i + 1 AS BIGINT), 1)) AS diffs FROM n JOIN fresh USING (key))
SELECT 'COMBO_T' || key || '_' || lpad(CAST(row_number() OVER (ORDER BY 'T' || key, label) AS VARCHAR), 6, '0') AS seq_id, combo AS sequence, CAST(idx + 1 AS BIGINT) AS variant_pos_aa,
 'p.[' || CASE WHEN length(ref_p) = length(combo) THEN CASE WHEN key % 3 = 0 THEN array_to_string(diffs, '(;)') ELSE array_to_string(diffs, ';') END WHEN idx >= length(ref_p) THEN 'ext*?' WHEN idx >= length(combo) THEN substr(ref_p, CAST(idx + 1 AS BIGINT), 1) || (idx + 1) || '*' ELSE substr(ref_p, CAST(idx + 1 AS BIGINT), 1) || (idx + 1) || 'fs' END || ']' AS protein_change,
 CASE WHEN key % 3 = 0 THEN 'combinatorial;unphased' ELSE 'combinatorial;phased' END AS notes FROM z"""


@query(_SQL_COMBO)
def combo_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One protein for each haplotype with several variants, where a peptide of
    it comes from no single one."""
    transcripts, sequences, _ = derived(spark, sf_dir)
    each = transcripts.join(merged(sequences), "tx_id").select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("i"))
    off = (F.lit(CDS_OFF) + (F.col("p_size") * 5 + 23 * F.col("i")) % 96).cast("bigint")
    base = F.substring("tx_seq", (off + 1).cast("int"), F.lit(1))
    shown = lambda c: F.when(F.col("strand") == "-", S.revcomp(c)).otherwise(c)
    kind = F.col("key") % 3
    none = F.array().cast("array<int>")
    haps = F.when(kind == 0, none).when((kind == 2) & (F.col("i") == 2), F.array(F.lit(1))).otherwise(F.array(F.lit(0)))
    variants = each.select(
        F.concat_ws(":", "tx_id", F.col("i").cast("string")).alias("variant_id"), "chrom", S.tx_to_genomic(F.col("exons"), F.col("strand"), off).alias("pos"), shown(base).alias("ref"), shown(F.translate(base, "ACGT", "GTAC")).alias("alt"), F.lit("SNV").alias("variant_class"), F.lit("s").alias("source"),
        F.when(kind == 0, "").otherwise("b").alias("phase_set"), haps.alias("haplotypes"),
    )
    made = build.combinations(variants, transcripts.drop("key", "p_size"), sequences)
    return made.select("seq_id", "sequence", "variant_pos_aa", "protein_change", F.array_join("notes", ";").alias("notes"))


# ---------------------------------------------------------------- splicing events by their ids

_SQL_IDS = f"""{SQL_JX}, m AS (SELECT gene, gene % 2 = 0 AS plus, count(DISTINCT tx) AS n FROM x GROUP BY gene HAVING count(DISTINCT tx) > 1),
t AS (SELECT DISTINCT gene, e, nxt, nxe, nx2 FROM j WHERE nx2 IS NOT NULL), o AS (SELECT gene, tx, list(s ORDER BY s) AS ss, list(e ORDER BY s) AS es FROM x GROUP BY ALL HAVING count(*) > 1),
l AS (SELECT DISTINCT gene, es[1] AS v, ss[1] AS o, ss[2] AS k FROM o), r AS (SELECT DISTINCT gene, ss[-1] AS v, es[-1] AS o, es[-2] AS k FROM o),
g AS (SELECT t.gene, 'SE' AS p, 'SE' AS q, e || '-' || nxt || ':' || nxe || '-' || nx2 AS f FROM t JOIN q ON q.gene = t.gene AND q.lo = e AND q.hi = nx2
UNION SELECT a.gene, 'A3', 'A5', a.lo || '-' || a.hi || ':' || b.lo || '-' || b.hi FROM q a JOIN q b ON a.gene = b.gene AND a.lo = b.lo AND a.hi < b.hi
UNION SELECT a.gene, 'A5', 'A3', a.lo || '-' || a.hi || ':' || b.lo || '-' || b.hi FROM q a JOIN q b ON a.gene = b.gene AND a.hi = b.hi AND a.lo > b.lo
UNION SELECT q.gene, 'RI', 'RI', x.s || ':' || q.lo || '-' || q.hi || ':' || x.e FROM q JOIN x ON x.gene = q.gene AND x.s < q.lo AND x.e > q.hi
UNION SELECT a.gene, 'MX', 'MX', a.e || '-' || a.nxt || ':' || a.nxe || '-' || a.nx2 || ':' || a.e || '-' || b.nxt || ':' || b.nxe || '-' || a.nx2 FROM t a JOIN t b ON a.gene = b.gene AND a.e = b.e AND a.nx2 = b.nx2 AND a.nxe < b.nxt
UNION SELECT a.gene, 'AF', 'AL', a.o || ':' || a.v || '-' || a.k || ':' || b.o || ':' || b.v || '-' || a.k FROM l a JOIN l b ON a.gene = b.gene AND a.k = b.k AND a.v < b.v
UNION SELECT a.gene, 'AL', 'AF', a.k || '-' || a.v || ':' || a.o || ':' || a.k || '-' || b.v || ':' || b.o FROM r a JOIN r b ON a.gene = b.gene AND a.k = b.k AND a.v < b.v),
i AS (SELECT DISTINCT CASE WHEN plus THEN p ELSE q END AS type, 'G' || g.gene AS gene, f, 'chr' || g.gene % 7 AS chrom, CASE WHEN plus THEN '+' ELSE '-' END AS strand, n FROM g JOIN m USING (gene)),
ids AS (SELECT gene || ';' || type || ':' || chrom || ':' || f || ':' || strand AS event_id, type, gene, chrom, strand, n AS n_transcripts, string_split(f, ':') AS gs FROM i)"""


def annotated_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived genes' transcripts as an annotation has them."""
    rows = exons(spark, sf_dir).groupBy("gene", "tx").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("exons"))
    minus = F.col("gene") % 2 == 1
    return rows.select(F.concat(F.lit("G"), F.col("gene").cast("string")).alias("gene_id"), F.col("tx").cast("string").alias("tx_id"), F.concat(F.lit("chr"), (F.col("gene") % 7).cast("string")).alias("chrom"), F.when(minus, "-").otherwise("+").alias("strand"), F.when(minus, F.reverse("exons")).otherwise(F.col("exons")).alias("exons"))


@query(f"WITH {_SQL_IDS} SELECT event_id, type, gene, chrom, strand, n_transcripts FROM ids")
def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all seven kinds of events, by strand."""
    return events.event_ids(annotated_exons(spark, sf_dir))


@query(f"""WITH {_SQL_IDS} SELECT DISTINCT event_id, chrom || ':' || unnest(CASE type WHEN 'SE' THEN [gs[1], gs[2], split_part(gs[1], '-', 1) || '-' || split_part(gs[2], '-', 2)] ELSE list_filter(gs, lambda g: contains(g, '-')) END) AS junction FROM ids""")
def event_junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the annotation to ids, and from those back to the junctions that
    each event needs."""
    return events.required_junctions(events.event_ids(annotated_exons(spark, sf_dir)))


# ---------------------------------------------------------------- audits

_SQL_MASKED = "regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')"


@query(f"""WITH s AS (SELECT CASE doc_id % 5 WHEN 0 THEN 'chr' || doc_id || '_alt' WHEN 1 THEN 'chr' || doc_id || '_random' WHEN 2 THEN 'chrUn_' || doc_id ELSE 'chr' || doc_id END AS contig, doc_id % 5 AS k, {_SQL_MASKED} AS seq FROM documents)
SELECT contig, CAST(length(seq) AS BIGINT) AS length, CAST(length(regexp_replace(seq, '[^a-z]', '', 'g')) AS BIGINT) AS n_masked, CAST(length(regexp_replace(seq, '[^nN]', '', 'g')) AS BIGINT) AS n_unknown, CASE k WHEN 0 THEN 'alternative' WHEN 1 THEN 'unlocalised' WHEN 2 THEN 'unplaced' ELSE 'primary' END AS kind FROM s WHERE seq <> ''""")
def genome_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as contigs in letters of both cases, audited."""
    kind, key = F.col("doc_id") % 5, F.concat(F.lit("chr"), F.col("doc_id").cast("string"))
    contig = F.when(kind == 0, F.concat(key, F.lit("_alt"))).when(kind == 1, F.concat(key, F.lit("_random"))).when(kind == 2, F.concat(F.lit("chrUn_"), F.col("doc_id").cast("string"))).otherwise(key)
    path = scratch(spark, "masked")
    rows = table(spark, sf_dir, "documents").select(contig.alias("contig"), F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "").alias("seq"))
    rows.select(F.concat(F.lit(">"), "contig", F.lit("\n"), H.wrapped("seq", 80))).write.text(path)
    return audits.genome_audit(spark, path)


@query(f"""WITH s AS (SELECT doc_id, source, {SQL_SEQ} AS seq, upper({_SQL_MASKED}) AS raw FROM documents), r AS (SELECT * FROM s WHERE raw <> '')
SELECT 'database' AS what, CASE WHEN doc_id % 3 = 0 THEN 'tr' ELSE 'sp' END AS key, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT 'field', k, count(*) FROM r, (SELECT unnest(['OS', 'GN']) AS k) WHERE k = 'OS' OR doc_id % 7 <> 0 GROUP BY ALL
UNION ALL SELECT 'isoform', '', count(*) FROM r WHERE doc_id % 4 = 0 HAVING count(*) > 0 UNION ALL SELECT 'wrapped', '', count(*) FROM r WHERE length(raw) > 60 HAVING count(*) > 0 UNION ALL SELECT 'no_methionine', '', count(*) FROM r WHERE NOT starts_with(raw, 'M') HAVING count(*) > 0
UNION ALL SELECT 'residue', x, CAST(sum(length(raw) - length(replace(raw, x, ''))) AS BIGINT) AS n FROM r, (SELECT unnest(['U', 'O', 'X', 'B', 'Z', 'J']) AS x) GROUP BY x HAVING sum(length(raw) - length(replace(raw, x, ''))) > 0
UNION ALL SELECT 'genes_of_several_entries', '', count(*) FROM (SELECT source FROM r WHERE doc_id % 7 <> 0 GROUP BY source HAVING count(*) > 1) HAVING count(*) > 0""")
def proteome_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as entries of a proteome, audited."""
    key = F.col("doc_id")
    path = scratch(spark, "proteome")
    head = F.concat(F.lit(">"), F.when(key % 3 == 0, "tr").otherwise("sp"), F.lit("|D"), key.cast("string"), F.when(key % 4 == 0, "-1").otherwise(""), F.lit("|X_HUMAN a protein OS=Homo sapiens"), F.when(key % 7 != 0, F.concat(F.lit(" GN="), "source")).otherwise(""))
    rows = table(spark, sf_dir, "documents").select(head.alias("head"), F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")).alias("seq")).where("seq <> ''")
    rows.select(F.concat("head", F.lit("\n"), H.wrapped("seq", 60))).write.text(path)
    return audits.proteome_audit(spark, path)


# ---------------------------------------------------------------- builders of single events

def sql_protein(seq: str) -> str:
    return sql_read(sql_codons(f"substr({seq}, {CDS_OFF + 1})"))


#: Three variants of each gene within its second exon: a transition, two bases less, three bases more.
_SQL_PLACED = f"""{SQL_TX}, v AS (SELECT x.key, minus, seq, i, 62 + (g.p_size * 5 + 7 * i) % 50 AS r, CASE i WHEN 1 THEN 3 ELSE 1 END AS n, nt FROM x JOIN g USING (key), (SELECT unnest([0, 1, 2]) AS i)),
w AS (SELECT *, substr(nt, CAST(r AS BIGINT), CAST(n AS BIGINT)) AS ref FROM v), u AS (SELECT *, CASE i WHEN 0 THEN translate(ref, 'ACGT', 'GTAC') WHEN 1 THEN left(ref, 1) ELSE ref || 'GAA' END AS alt, CASE WHEN minus THEN 124 - (r + n - 1) ELSE 44 + (r - 61) END AS start FROM w),
m AS (SELECT *, length(alt) - n AS delta, substr(seq, 1, CAST(start AS BIGINT)) || CASE WHEN minus THEN reverse(translate(alt, 'ACGT', 'TGCA')) ELSE alt END || substr(seq, CAST(start + n + 1 AS BIGINT)) AS mut FROM u),
p AS (SELECT *, {sql_protein("seq")} AS rp, {sql_protein("mut")} AS ap, contains(array_to_string(list_transform({sql_codons(f"substr(seq, {CDS_OFF + 1})")}, lambda c: {SQL_CODE}[c]), ''), '*') AS rs, contains(array_to_string(list_transform({sql_codons(f"substr(mut, {CDS_OFF + 1})")}, lambda c: {SQL_CODE}[c]), ''), '*') AS stop FROM m),
e AS (SELECT *, CASE WHEN start >= {CDS_OFF} + 3 * length(rp) + CASE WHEN rs THEN 3 ELSE 0 END THEN '3_prime_UTR' WHEN delta % 3 <> 0 THEN 'frameshift' WHEN rp = ap THEN 'synonymous' WHEN length(ap) > 0 AND left(rp, 1) = 'M' AND left(ap, 1) <> 'M' THEN 'start_lost'
  WHEN delta > 0 THEN 'inframe_insertion' WHEN delta < 0 THEN 'inframe_deletion' WHEN length(ap) < length(rp) AND stop THEN 'stop_gained' WHEN length(ap) > length(rp) THEN 'stop_lost' ELSE 'missense' END AS effect,
  coalesce(list_filter(range(0, least(length(rp), length(ap))), lambda i: substr(rp, CAST(i + 1 AS BIGINT), 1) <> substr(ap, CAST(i + 1 AS BIGINT), 1))[1], least(length(rp), length(ap))) AS idx, CASE WHEN minus THEN 64 ELSE 44 END AS junction FROM p),
f AS (SELECT *, substr(rp, CAST(idx + 1 AS BIGINT), 1) AS x, substr(ap, CAST(idx + 1 AS BIGINT), 1) AS y FROM e)"""


@query(f"""WITH {_SQL_PLACED} SELECT 'N' || key || '_T' || key || '_chr' || key % {CONTIGS} || '_' || ((key // {CONTIGS}) * {G.CHUNK} + r) || '_' || ref || '_' || alt AS seq_id, ap AS sequence, effect AS consequence, rp AS ref_protein, CASE WHEN effect <> 'synonymous' THEN CAST(idx + 1 AS BIGINT) END AS variant_pos_aa,
 CASE WHEN effect = 'synonymous' THEN 'p.(=)' WHEN effect = 'frameshift' AND x <> '' THEN 'p.' || x || (idx + 1) || CASE WHEN y <> '' THEN y ELSE '*' END || 'fs*' || (length(ap) - idx) WHEN effect = 'stop_gained' AND x <> '' THEN 'p.' || x || (idx + 1) || '*' WHEN x <> '' AND y <> '' THEN 'p.' || x || (idx + 1) || y WHEN x <> '' THEN 'p.' || x || (idx + 1) || 'del' ELSE '' END AS protein_change,
 CASE WHEN effect NOT IN ('frameshift', 'stop_gained') THEN 'not_applicable' WHEN NOT stop THEN 'no_stop' WHEN junction + CASE WHEN delta <> 0 AND junction > start THEN delta ELSE 0 END - ({CDS_OFF} + 3 * length(ap)) > 50 THEN 'likely' ELSE 'escapes' END AS nmd FROM f""")
def variant_proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proteins of substitutions, deletions and insertions on either strand."""
    transcripts, sequences, _ = derived(spark, sf_dir)
    key = F.col("p_partkey")
    contig, base = gene_place(key)
    each = dealt(table(spark, sf_dir, "part"), "p_partkey").select(key.alias("key"), contig.alias("chrom"), base.alias("base"), P.nucleotides(key, GENE // 32).alias("nt"), "p_size", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("i"))
    r = 62 + (F.col("p_size") * 5 + 7 * F.col("i")) % 50
    ref = F.substring("nt", r, F.when(F.col("i") == 1, 3).otherwise(1))
    alt = F.when(F.col("i") == 0, F.translate(ref, "ACGT", "GTAC")).when(F.col("i") == 1, F.substring(ref, F.lit(1), F.lit(1))).otherwise(F.concat(ref, F.lit("GAA")))
    variants = each.select(
        F.concat_ws(":", F.col("key").cast("string"), F.col("i").cast("string")).alias("variant_id"), "chrom", (F.col("base") + r).cast("bigint").alias("pos"), ref.alias("ref"), alt.alias("alt"), F.concat(F.lit("N"), F.col("key").cast("string")).alias("genes"),
        S.small_class(ref, alt).alias("variant_class"), F.lit("s").alias("source"), F.lit(None).cast("double").alias("confidence"),
    )
    return build.small_variants(variants, transcripts.drop("key", "p_size"), sequences).select("seq_id", "sequence", "consequence", "ref_protein", "variant_pos_aa", "protein_change", "nmd")


_SQL_UPTO = "CASE WHEN minus THEN CASE WHEN r > 60 THEN 125 - r WHEN r > 44 THEN 64 ELSE 109 - r END ELSE CASE WHEN r <= 44 THEN r WHEN r <= 60 THEN 44 ELSE r - 16 END END"


@query(f"""WITH {SQL_TX}, a AS (SELECT x.*, 5 + (p_size * 7 + key) % 116 AS r FROM x), b AS (SELECT *, {_SQL_UPTO} AS upto, {_SQL_UPTO} - CASE WHEN r BETWEEN 45 AND 60 THEN 0 ELSE 1 END AS before FROM a),
j AS (SELECT f.key AS k5, t.key AS k3, f.r AS r5, t.r AS r3, substr(f.seq, 1, CAST(f.upto AS BIGINT)) AS head, substr(t.seq, CAST(t.before + 1 AS BIGINT)) AS tail, t.before - {CDS_OFF} AS k FROM b f JOIN b t ON t.key = xor(f.key, 1) WHERE f.upto > {CDS_OFF}),
p AS (SELECT *, {sql_protein("(head || tail)")} AS prot, length(head) - {CDS_OFF} AS nt FROM j)
SELECT 'N' || k5 || '--N' || k3 || '_T' || k5 || '--T' || k3 || '_chr' || k5 % {CONTIGS} || '_' || ((k5 // {CONTIGS}) * {G.CHUNK} + r5) || '_chr' || k3 % {CONTIGS} || '_' || ((k3 // {CONTIGS}) * {G.CHUNK} + r3) AS seq_id, prot AS sequence,
 CASE WHEN nt % 3 = 0 AND k >= 0 AND k % 3 = 0 THEN 'in_frame_fusion' ELSE 'frameshift_fusion' END AS consequence, 'p.junction@' || (nt // 3 + 1) AS protein_change, CAST(CASE WHEN length(prot) >= nt // 3 + 1 THEN nt // 3 + 1 END AS BIGINT) AS novel_start FROM p WHERE prot <> ''""")
def fusion_chimeras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chimeras of neighbouring genes in both orders, with breakpoints in exons
    and introns."""
    transcripts, sequences, _ = derived(spark, sf_dir)
    key = F.col("p_partkey")
    contig, base = gene_place(key)
    one = dealt(table(spark, sf_dir, "part"), "p_partkey").select(key.alias("key"), F.concat(F.lit("N"), key.cast("string")).alias("gene"), contig.alias("chrom"), (base + 5 + (F.col("p_size") * 7 + key) % 116).cast("bigint").alias("pos"))
    other = one.select((F.col("key") - 1).alias("of"), F.col("gene").alias("gene2"), F.col("chrom").alias("chrom2"), F.col("pos").alias("pos2"))
    pairs = one.where("key % 2 = 0").join(merged(other), F.col("key") == F.col("of")).select(F.col("key").cast("string").alias("variant_id"), F.col("gene").alias("gene1"), F.col("chrom").alias("chrom1"), F.col("pos").alias("pos1"), "gene2", "chrom2", "pos2", F.lit("s").alias("source"), F.lit(None).cast("double").alias("confidence"))
    return build.fusions(pairs, transcripts.drop("key", "p_size"), sequences).select("seq_id", "sequence", "consequence", "protein_change", "novel_start")


_SQL_TAILS = " UNION ALL ".join(f"SELECT key, {f} AS frame, array_to_string(list_transform({sql_codons(f'substr(tail, {f + 1})')}, lambda c: {SQL_CODE}[c]), '') AS aas FROM y" for f in range(3))


@query(f"""WITH {SQL_TX}, r AS (SELECT key, seq, {sql_protein("seq")} AS prot FROM x), y AS (SELECT key, substr(seq, {CDS_OFF} + 3 * length(prot) + 4) AS tail FROM r), t AS ({_SQL_TAILS}), c AS (SELECT key, frame, string_split(aas, '*') AS cs FROM t), d AS (SELECT key, frame, cs, unnest(range(1, len(cs) + 1)) AS i FROM c),
o AS (SELECT key, frame, cs[i] AS orf, length(array_to_string(cs[1:i - 1], '*')) + CASE WHEN i > 1 THEN 1 ELSE 0 END AS off FROM d), w AS (SELECT *, frame + 3 * off AS a, row_number() OVER (PARTITION BY key ORDER BY length(orf) DESC, frame, off) AS n FROM o WHERE length(orf) >= 6)
SELECT 'NC_UTR_T' || key || '_utr3_' || a AS seq_id, orf AS sequence, 'frame' || frame || ';region=utr3' AS notes FROM w WHERE n = 1 AND orf NOT IN (SELECT prot FROM r)""")
def untranslated_orfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest open frame behind each gene's stop, with or without a start
    codon, but for known proteins."""
    transcripts, sequences, _ = derived(spark, sf_dir)
    known = sequences.select(S.protein_of(F.substring("tx_seq", F.lit(CDS_OFF + 1), F.length("tx_seq"))).alias("sequence"))
    made = build.noncanonical(transcripts.drop("key", "p_size"), sequences, known, min_aa=6, require_atg=False)
    return made.select("seq_id", "sequence", F.array_join(F.slice("notes", F.lit(1), F.lit(2)), ";").alias("notes"))


# ---------------------------------------------------------------- pairs of an edit and a constructed substitution

_SQL_OFF = f"({CDS_OFF} + (p_size * 5 + key) % 100)"
_SQL_RP_FRAGMENTS = SQL_FRAGMENTS.replace("seq", "rp")


@query(f"""WITH {SQL_TX}, a AS (SELECT key, minus, seq, {_SQL_OFF} AS o FROM x), b AS (SELECT *, {sql_protein("seq")} AS rp, {sql_protein(sql_changed("o"))} AS ep, (o - {CDS_OFF}) // 3 AS idx FROM a), c AS (SELECT * FROM b WHERE ep <> '' AND ep <> rp),
f AS (SELECT key, idx, {_SQL_RP_FRAGMENTS} AS fr FROM c), f1 AS (SELECT key, idx, fr, unnest(range(1, len(fr) + 1)) AS i FROM f), f2 AS (SELECT key, idx, fr, i, unnest(range(i, least(i + 2, len(fr)) + 1)) AS j FROM f1),
f3 AS (SELECT key, idx, length(array_to_string(fr[1:i - 1], '')) AS s, length(array_to_string(fr[1:j], '')) AS e FROM f2), f4 AS (SELECT key, s, e FROM f3 WHERE e - s BETWEEN 6 AND 50 AND s <= idx AND idx < e QUALIFY row_number() OVER (PARTITION BY key ORDER BY e - s DESC, s) = 1),
t AS (SELECT c.*, unnest(range(s, e)) AS cand FROM c JOIN f4 USING (key)), u AS (SELECT *, {CDS_OFF} + 3 * cand AS q FROM t WHERE cand <> idx), v AS (SELECT *, {sql_protein(sql_changed("q"))} AS sp FROM u),
w AS (SELECT * FROM v WHERE sp <> '' AND sp <> rp QUALIFY row_number() OVER (PARTITION BY key ORDER BY cand) = 1), z AS (SELECT *, {sql_protein(sql_changed("o", "q"))} AS bp FROM w),
own_s AS (SELECT key AS id, bp AS seq FROM z), {sql_peptides("own", "own_s")}, forms_s AS (SELECT row_number() OVER () AS id, key, seq FROM (SELECT key, unnest([rp, ep, sp]) AS seq FROM z)), {sql_peptides("cov", "forms_s")},
held AS (SELECT DISTINCT key, replace(p, 'I', 'L') AS k FROM cov JOIN forms_s USING (id)), h AS (SELECT id AS key, string_agg(p, ',' ORDER BY length(p), p) AS peptides FROM own WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.key = own.id AND held.k = replace(own.p, 'I', 'L')) GROUP BY id)
SELECT 'T' || key AS tx_id, (key // {CONTIGS}) * {G.CHUNK} + CASE WHEN minus THEN CASE WHEN q < 64 THEN 124 - q ELSE 108 - q END ELSE CASE WHEN q < 44 THEN 1 + q ELSE 17 + q END END AS snv_pos, CASE WHEN minus THEN translate(substr(seq, CAST(q + 1 AS BIGINT), 1), 'ACGT', 'TGCA') ELSE substr(seq, CAST(q + 1 AS BIGINT), 1) END AS snv_ref,
 CAST(idx AS INTEGER) AS edited_residue, CAST(cand AS INTEGER) AS snv_residue, peptides FROM z JOIN h USING (key)""")
def edit_and_substitution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For an edit in each gene a substitution in the same peptide, and the
    peptides that neither gives alone."""
    transcripts, sequences, _ = derived(spark, sf_dir)
    off = (F.lit(CDS_OFF) + (F.col("p_size") * 5 + F.col("key")) % 100).cast("bigint")
    base = F.substring("tx_seq", (off + 1).cast("int"), F.lit(1))
    shown = lambda c: F.when(F.col("strand") == "-", S.revcomp(c)).otherwise(c)
    edits = transcripts.join(merged(sequences), "tx_id").select(F.col("tx_id").alias("variant_id"), "chrom", S.tx_to_genomic(F.col("exons"), F.col("strand"), off).alias("pos"), shown(base).alias("ref"), shown(F.translate(base, "ACGT", "GTAC")).alias("alt"), F.col("gene_name").alias("genes"))
    found = constructed.cross_evidence(edits, transcripts.drop("key", "p_size"), sequences)
    return found.select("tx_id", "snv_pos", "snv_ref", "edited_residue", "snv_residue", F.array_join("peptides", ",").alias("peptides"))
