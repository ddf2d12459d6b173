"""The generic forms of the engine's operators over plain tables.

The tables hold no genomes, so each query derives its relation from columns:
letters of a text as a protein, a key's digest as bases, keys as coordinates.
ORACLE_SQL has the same query as SQL for an independent engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import digestion as D
from ..functions import headers as H
from ..functions import peptides as P
from ..functions import sequence as S
from ..functions.frames import with_frames
from ..operators import relational as R
from . import checks, package, truth

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- peptides

#: Documents of this source stand for the normal tissue, all others are entries.
NORMAL = "src19"

SQL_SEQ = "regexp_replace(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g')"
SQL_FRAGMENTS = "list_filter(string_split(replace(replace(regexp_replace(seq, '([KR])', '\\1|', 'g'), 'K|P', 'KP'), 'R|P', 'RP'), '|'), lambda x: x <> '')"


def sql_peptides(name: str, source: str) -> str:
    """CTEs name_fr and name: distinct (id, peptide) of a (id, seq) relation."""
    return f"""{name}_fr AS (SELECT id, {SQL_FRAGMENTS} AS fr FROM {source}),
{name}_i AS (SELECT id, fr, unnest(range(1, len(fr) + 1)) AS i FROM {name}_fr),
{name}_j AS (SELECT id, fr, i, unnest(range(i, least(i + 2, len(fr)) + 1)) AS j FROM {name}_i),
{name} AS (SELECT DISTINCT id, array_to_string(fr[i:j], '') AS p FROM {name}_j WHERE length(array_to_string(fr[i:j], '')) BETWEEN 6 AND 50)"""


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = R.dealt(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text"), "doc_id")
    return docs.select("doc_id", "lang", "source", "n_chars", P.protein_like("text").alias("seq"))


def as_entries(df: DataFrame, *classes: str) -> DataFrame:
    """Release entries: the document's number, its classes and a variant position."""
    pos = F.lit(1) + F.col("n_chars") % F.length("seq")
    kept = df.where(F.length("seq") > 0)
    return kept.select(F.col("doc_id").alias("entry_id"), F.col("source").alias("variant_class"), F.array(*classes or ["source"]).alias("classes"), pos.alias("variant_pos_aa"), F.col("seq").alias("sequence"))


def reference_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return package.peptide_keys(table(spark, sf_dir, "benchmark").select(P.protein_like("text").alias("sequence")))


@query(f"""WITH s AS (SELECT doc_id AS id, {SQL_SEQ} AS seq FROM documents), {sql_peptides("pep", "s")}
SELECT id AS doc_id, p AS peptide FROM pep""")
def tryptic_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.digested(entries(spark, sf_dir), "seq", ["doc_id"]).select("doc_id", "peptide")


@query(f"""WITH s AS (SELECT doc_id AS id, {SQL_SEQ} AS seq FROM documents), {sql_peptides("pep", "s")}
SELECT id AS doc_id, count(*) AS n_peptides, avg(length(p)) AS mean_length, max(length(p)) AS longest FROM pep GROUP BY id""")
def digest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and mean length of each entry's peptides."""
    return D.digest_sizes(entries(spark, sf_dir), "seq", ["doc_id"])


@query(f"""WITH s AS (SELECT doc_id AS id, {SQL_SEQ} AS seq FROM documents), b AS (SELECT item_id AS id, {SQL_SEQ} AS seq FROM benchmark),
{sql_peptides("pep", "s")}, {sql_peptides("ref", "b")}, r AS (SELECT DISTINCT replace(p, 'I', 'L') AS k FROM ref)
SELECT id AS doc_id, count(*) AS n_novel, min(p) AS example FROM pep WHERE replace(p, 'I', 'L') NOT IN (SELECT k FROM r) GROUP BY id""")
def novel_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = package.peptide_rows(as_entries(entries(spark, sf_dir)), reference_keys(spark, sf_dir), fields=("entry_id",))
    return rows.where("novel").groupBy(F.col("entry_id").alias("doc_id")).agg(F.count("*").alias("n_novel"), F.min("peptide").alias("example"))


FUNNEL_SQL = f"""WITH s AS (SELECT doc_id AS id, {SQL_SEQ} AS seq, source, n_chars FROM documents), b AS (SELECT item_id AS id, {SQL_SEQ} AS seq FROM benchmark),
{sql_peptides("pep", "s")}, {sql_peptides("ref", "b")},
r AS (SELECT DISTINCT replace(p, 'I', 'L') AS k FROM ref),
nrm AS (SELECT DISTINCT replace(p, 'I', 'L') AS k FROM pep JOIN s USING (id) WHERE source = '{NORMAL}'),
e AS (SELECT id, source, p, replace(p, 'I', 'L') AS k, seq, 1 + n_chars % length(seq) AS pos FROM pep JOIN s USING (id) WHERE source <> '{NORMAL}'),
v AS (SELECT id, source, k, p, replace(p, 'I', 'L') IN (SELECT k FROM nrm) AS in_normal,
  len(list_filter(range(greatest(1, pos - length(p) + 1), pos + 1), lambda i: substr(seq, i, length(p)) = p)) > 0 AS spanning
  FROM e WHERE k NOT IN (SELECT k FROM r)),
f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id, p) AS n, count(*) OVER (PARTITION BY k) AS c FROM v),
u AS (SELECT k, count(DISTINCT id) AS entries FROM v GROUP BY k)
SELECT source AS class, count(*) AS novel_vs_reference, count(*) FILTER (NOT in_normal) AS not_in_normal_tissue,
  count(*) FILTER (NOT in_normal AND spanning) AS variant_spanning, count(*) FILTER (NOT in_normal AND spanning AND entries = 1) AS proteotypic
FROM f JOIN u USING (k) WHERE n = 1 GROUP BY source"""


@query(FUNNEL_SQL)
def candidate_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Novel peptides, those not in normal tissue, those over the variant and
    those of one entry only, nested, by class of the first entry."""
    every = entries(spark, sf_dir)
    normal = package.peptide_keys(every.where(F.col("source") == NORMAL), "seq")
    rows = package.peptide_rows(as_entries(every.where(F.col("source") != NORMAL)), reference_keys(spark, sf_dir), normal, fields=("entry_id", "variant_class"))
    return package.funnel(rows, ("variant_class",)).withColumnRenamed("variant_class", "class")


@query(f"""WITH s AS (SELECT doc_id AS id, {SQL_SEQ} AS seq, n_chars FROM documents), {sql_peptides("pep", "s")},
e AS (SELECT id, p, seq, 1 + n_chars % length(seq) AS pos FROM pep JOIN s USING (id))
SELECT id AS doc_id, p AS peptide FROM e WHERE len(list_filter(range(greatest(1, pos - length(p) + 1), pos + 1), lambda i: substr(seq, i, length(p)) = p)) > 0""")
def spanning_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.digested(as_entries(entries(spark, sf_dir)), "sequence", ["entry_id"], position="variant_pos_aa")
    return rows.where("spanning").select(F.col("entry_id").alias("doc_id"), "peptide")


@query(f"""WITH s AS (SELECT doc_id AS id, {SQL_SEQ} AS seq, lang, source FROM documents), b AS (SELECT item_id AS id, {SQL_SEQ} AS seq FROM benchmark),
{sql_peptides("pep", "s")}, {sql_peptides("ref", "b")}, r AS (SELECT DISTINCT replace(p, 'I', 'L') AS k FROM ref),
n AS (SELECT lang, source, replace(p, 'I', 'L') AS k FROM pep JOIN s USING (id) WHERE replace(p, 'I', 'L') NOT IN (SELECT k FROM r))
SELECT class, count(DISTINCT k) AS n_added FROM (SELECT lang AS class, k FROM n UNION ALL SELECT source, k FROM n UNION ALL SELECT 'release', k FROM n) GROUP BY class""")
def search_space_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct new peptides of the release and of every class that reaches
    them; classes overlap."""
    rows = package.peptide_rows(as_entries(entries(spark, sf_dir), "lang", "source"), reference_keys(spark, sf_dir), fields=("entry_id", "classes"))
    return package.search_space(rows)


@query(f"""WITH s AS (SELECT lang, {SQL_SEQ} AS seq FROM documents),
m AS (SELECT DISTINCT lang, substr(seq, i, 7) AS m FROM s, unnest(range(1, length(seq) - 5)) AS t(i)),
n AS (SELECT lang, count(*) AS n FROM m GROUP BY lang), b AS (SELECT x.lang AS a, y.lang AS b, count(*) AS n_both FROM m x JOIN m y ON x.m = y.m AND x.lang < y.lang GROUP BY ALL)
SELECT a, b, na.n AS n_a, nb.n AS n_b, n_both, n_both / (na.n + nb.n - n_both) AS jaccard FROM b JOIN n na ON na.lang = a JOIN n nb ON nb.lang = b""")
def kmer_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.jaccard_pairs(D.kmer_items(entries(spark, sf_dir), "seq", "lang", 7), "lang", "item")


@query(f"""WITH s AS (SELECT doc_id, {SQL_SEQ} AS seq FROM documents), f AS (SELECT doc_id, seq, {SQL_FRAGMENTS} AS fr FROM s)
SELECT doc_id, md5(array_to_string(list_transform(fr, lambda x: CASE WHEN right(x, 1) IN ('K', 'R') THEN reverse(left(x, length(x) - 1)) || right(x, 1) ELSE reverse(x) END), '')) AS decoy_md5, length(seq) AS n, md5(reverse(seq)) AS reverse_md5 FROM f""")
def pseudo_reverse_decoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir).select("doc_id", F.md5(P.pseudo_reverse_decoy("seq")).alias("decoy_md5"), F.length("seq").cast("bigint").alias("n"), F.md5(P.reverse_decoy("seq")).alias("reverse_md5"))


@query()
def shuffle_decoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded shuffles within fragments; needs Python's generator."""
    from ..functions.decoys import shuffled

    return shuffled(entries(spark, sf_dir).select("doc_id", "seq"), "seq").select("doc_id", F.length("seq").alias("n"), F.md5("decoy").alias("decoy_md5"))


@query()
def compare_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's protein against the benchmark item of its number."""
    from ..functions.compare import compared

    bench = table(spark, sf_dir, "benchmark").select("item_id", P.protein_like("text").alias("other"))
    n = bench.agg(F.max("item_id").alias("top"))
    own = entries(spark, sf_dir).select("doc_id", "seq").crossJoin(F.broadcast(n)).withColumn("item_id", F.col("doc_id") % (F.col("top") + 1)).drop("top")
    return compared(own.join(bench, "item_id"), "seq", "other").select("doc_id", "item_id", "comparison.*")


# ---------------------------------------------------------------- intervals

SQL_TX = "SELECT p_partkey AS tx, p_partkey % 5 AS contig, p_partkey * 37 % 100000 AS st, p_partkey * 37 % 100000 + p_size * 40 AS en, p_brand AS gene, p_type, p_size FROM part"
SQL_VAR = "SELECT o_orderkey AS v, o_orderkey % 5 AS contig, o_orderkey * 91 % 100000 AS pos FROM orders"


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("p_partkey") * 37 % 100000
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("tx"), (F.col("p_partkey") % 5).alias("tx_contig"), at.alias("st"), (at + F.col("p_size") * 40).alias("en"), F.col("p_brand").alias("gene"), "p_type", "p_size")


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("v"), (F.col("o_orderkey") % 5).alias("contig"), (F.col("o_orderkey") * 91 % 100000).alias("pos"))


def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.interval_pairs(variants(spark, sf_dir), transcripts(spark, sf_dir), "pos", "st", "en", [("contig", "tx_contig")], width=1024)


@query(f"SELECT v, tx, pos - st AS tx_offset FROM ({SQL_VAR}) v JOIN ({SQL_TX}) t ON v.contig = t.contig AND pos BETWEEN st AND en")
def interval_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups(spark, sf_dir).select("v", "tx", (F.col("pos") - F.col("st")).alias("tx_offset"))


@query(f"""SELECT v, gene, tx FROM (SELECT v, gene, tx, row_number() OVER (PARTITION BY v, gene ORDER BY p_type <> 'STANDARD', p_type <> 'PROMO', p_size DESC, en - st DESC, tx) AS n
FROM ({SQL_VAR}) v JOIN ({SQL_TX}) t ON v.contig = t.contig AND pos BETWEEN st AND en) WHERE n = 1""")
def representative_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("p_type") != "STANDARD", F.col("p_type") != "PROMO", -F.col("p_size"), F.col("st") - F.col("en"), F.col("tx")]
    found = R.first_over(variants(spark, sf_dir), R.dealt(transcripts(spark, sf_dir), "tx"), "pos", "st", "en", [("contig", "tx_contig")], "gene", order, ["tx"])
    return found.select("v", "gene", "tx")


SQL_PROBE = "SELECT DISTINCT l_partkey AS q, CASE l_partkey % 4 WHEN 0 THEN 'G' || l_partkey || '.' || l_partkey % 3 WHEN 1 THEN 'G' || l_partkey WHEN 2 THEN 'Brand#' || l_partkey % 9 ELSE 'none' END AS symbol FROM lineitem"
SQL_ALIAS = "SELECT p_partkey AS tx, 'G' || p_partkey || '.' || p_partkey % 3 AS a, 1 AS tier FROM part UNION ALL SELECT p_partkey, 'G' || p_partkey, 2 FROM part UNION ALL SELECT p_partkey, p_brand, 3 FROM part"


@query(f"""WITH q AS ({SQL_PROBE}), a AS ({SQL_ALIAS}), j AS (SELECT q, symbol, tx, tier, min(tier) OVER (PARTITION BY q) AS best FROM q JOIN a ON symbol = a)
SELECT q.q, q.symbol, min(tier) AS tier, count(tx) AS n_hits, min(tx) AS first_tx FROM q LEFT JOIN (SELECT * FROM j WHERE tier = best) h ON h.q = q.q GROUP BY ALL""")
def tiered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols by gene id, id without version, then name: first tier that hits."""
    key = F.col("l_partkey")
    text = lambda *x: F.concat(*(c if isinstance(c, Column) else F.lit(c) for c in x))
    symbol = F.when(key % 4 == 0, text("G", key.cast("string"), ".", (key % 3).cast("string"))).when(key % 4 == 1, text("G", key.cast("string"))).when(key % 4 == 2, text("Brand#", (key % 9).cast("string"))).otherwise("none")
    probe = table(spark, sf_dir, "lineitem").select(key.alias("q"), symbol.alias("symbol")).distinct()
    part = table(spark, sf_dir, "part")
    tx = F.col("p_partkey")
    kinds = F.array(F.struct(text("G", tx.cast("string"), ".", (tx % 3).cast("string")).alias("a"), F.lit(1).alias("tier")), F.struct(text("G", tx.cast("string")).alias("a"), F.lit(2).alias("tier")), F.struct(F.col("p_brand").alias("a"), F.lit(3).alias("tier")))
    index = part.select(tx.alias("tx"), F.explode(kinds).alias("x")).select("tx", "x.*")
    # names have many transcripts: sum them up per alias before the join, probe rows then stay one to one
    summed = index.groupBy("a", "tier").agg(F.count("*").alias("n_hits"), F.min("tx").alias("first_tx"))
    hits = R.tiered_lookup(probe, "symbol", summed, "a", "tier").select("q", "tier", "n_hits", "first_tx")
    return probe.join(hits, "q", "left").select("q", "symbol", "tier", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), "first_tx")


# ---------------------------------------------------------------- sequences

def sql_nt(key: str, parts: int) -> str:
    return " || ".join(f"translate(md5({key} || ':{i}'), '0123456789abcdef', 'ACGTACGTACGTACGT')" for i in range(parts))


_CODONS = [a + b + c for a in S.BASES for b in S.BASES for c in S.BASES]
SQL_CODE = f"map([{', '.join(repr(c) for c in _CODONS)}], [{', '.join(repr(a) for a in S.STANDARD_CODE)}])"


def sql_aas(nt: str) -> str:
    return f"array_to_string(list_transform(range(0, length({nt}) // 3), lambda i: coalesce({SQL_CODE}[substr({nt}, CAST(3 * i + 1 AS BIGINT), 3)], 'X')), '')"


@query(f"""WITH s AS (SELECT p_partkey, {sql_nt("p_partkey", 3)} AS nt FROM part), t AS (SELECT p_partkey, nt, {sql_aas("nt")} AS aas FROM s)
SELECT p_partkey, split_part(aas, '*', 1) AS protein, contains(aas, '*') AS stop_found, length(nt) % 3 AS trailing_partial FROM t""")
def translate_orf(spark: SparkSession, sf_dir: str) -> DataFrame:
    nt = P.nucleotides(F.col("p_partkey"), 3)
    out = R.dealt(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", S.translate_orf(nt).alias("t"))
    return out.select("p_partkey", "t.protein", "t.stop_found", F.col("t.trailing_partial").cast("bigint").alias("trailing_partial"))


@query(f"""SELECT p_partkey, reverse(translate(nt, 'ACGT', 'TGCA')) AS revcomp FROM (SELECT p_partkey, {sql_nt("p_partkey", 1)} AS nt FROM part)""")
def reverse_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", S.revcomp(P.nucleotides(F.col("p_partkey"))).alias("revcomp"))


SQL_REF_ALT = f"""SELECT p_partkey, ref, substr(ref, 1, off) || ins || substr(ref, off + n + 1) AS alt, n, length(ins) AS m FROM (SELECT p_partkey, {sql_nt("p_partkey", 2)} AS ref, p_partkey % 40 AS off, p_size % 4 AS n, substr('GATTACA', 1, CAST(p_partkey % 5 AS BIGINT)) AS ins FROM part)"""


def ref_alt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.dealt(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", P.nucleotides(F.col("p_partkey"), 2).alias("ref"), (F.col("p_partkey") % 40).cast("int").alias("at"), (F.col("p_size") % 4).alias("n"), F.substring(F.lit("GATTACA"), F.lit(1), (F.col("p_partkey") % 5).cast("int")).alias("ins"))
    return rows.select("p_partkey", "ref", S.splice(F.col("ref"), F.col("at"), F.col("n"), F.col("ins")).alias("alt"), "n", F.length("ins").alias("m"))


@query(f"""SELECT p_partkey, coalesce(list_filter(range(0, least(length(ref), length(alt))), lambda i: substr(ref, i + 1, 1) <> substr(alt, i + 1, 1))[1], least(length(ref), length(alt))) AS idx FROM ({SQL_REF_ALT})""")
def first_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ref_alt(spark, sf_dir).select("p_partkey", S.first_difference("ref", "alt").cast("bigint").alias("idx"))


@query(f"""WITH t AS (SELECT p_partkey, n, m, {sql_aas("ref")} AS ra, {sql_aas("alt")} AS aa FROM ({SQL_REF_ALT})),
u AS (SELECT p_partkey, n, m, split_part(ra, '*', 1) AS r, split_part(aa, '*', 1) AS a, contains(aa, '*') AS stop FROM t)
SELECT p_partkey, CASE WHEN abs(m - n) % 3 <> 0 THEN 'frameshift' WHEN r = a THEN 'synonymous' WHEN a <> '' AND r[1] = 'M' AND a[1] <> 'M' THEN 'start_lost'
 WHEN m > n THEN 'inframe_insertion' WHEN m < n THEN 'inframe_deletion' WHEN length(a) < length(r) AND stop THEN 'stop_gained' WHEN length(a) > length(r) THEN 'stop_lost' ELSE 'missense' END AS consequence FROM u""")
def consequence_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ref_alt(spark, sf_dir).select("p_partkey", "n", "m", S.protein_of("ref").alias("r"), S.translate_orf("alt").alias("a"))
    return t.select("p_partkey", S.consequence(F.col("r"), F.col("a.protein"), F.col("n"), F.col("m"), F.col("a.stop_found")).alias("consequence"))


@query("""WITH e AS (SELECT l_orderkey, l_linenumber, CAST(sum(l_quantity) AS BIGINT) * 10 AS len FROM lineitem GROUP BY ALL),
x AS (SELECT l_orderkey, list(len ORDER BY l_linenumber) AS lens, CAST(sum(len) AS BIGINT) AS total FROM e GROUP BY l_orderkey),
y AS (SELECT l_orderkey, lens, total - lens[len(lens)] AS last, l_orderkey * 13 % total AS stop FROM x)
SELECT l_orderkey, CASE WHEN len(lens) = 1 THEN 'escapes' WHEN last - stop > 50 THEN 'likely' ELSE 'escapes' END AS nmd,
 CASE WHEN len(lens) = 1 THEN 'single_exon_transcript' WHEN last - stop > 50 THEN 'stop_' || (last - stop) || 'nt_upstream_of_last_junction' WHEN stop >= last THEN 'stop_in_last_exon' ELSE 'stop_within_50nt_of_last_junction' END AS reason FROM y""")
def nmd_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    exons = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg((F.sum("l_quantity").cast("bigint") * 10).alias("len"))
    lens = exons.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "len"))), lambda x: x["len"]).alias("lens"), F.sum("len").alias("total"))
    state = S.nmd(F.col("l_orderkey") * 13 % F.col("total"), F.col("lens"), F.lit(0), F.lit(0), F.lit(True))
    return lens.select("l_orderkey", state.alias("x")).select("l_orderkey", "x.nmd", "x.reason")


_FRAMES = " UNION ALL ".join(f"SELECT p_partkey, {f} AS frame, {sql_aas(f'substr(nt, {f + 1})')} AS aas FROM s" for f in range(3))


@query(f"""WITH s AS (SELECT p_partkey, {sql_nt("p_partkey", 6)} AS nt FROM part), t AS ({_FRAMES}),
c AS (SELECT p_partkey, frame, string_split(aas, '*') AS cs FROM t), d AS (SELECT p_partkey, frame, cs, unnest(range(1, len(cs) + 1)) AS i FROM c),
o AS (SELECT p_partkey, frame, i, cs[i] AS chunk, CASE WHEN contains(cs[i], 'M') THEN substr(cs[i], instr(cs[i], 'M')) ELSE '' END AS orf, length(array_to_string(cs[1:i - 1], '*')) + CASE WHEN i > 1 THEN 1 ELSE 0 END + CASE WHEN contains(cs[i], 'M') THEN instr(cs[i], 'M') - 1 ELSE 0 END AS off FROM d),
k AS (SELECT p_partkey, frame, orf, frame + 3 * off AS nt_start, row_number() OVER (PARTITION BY p_partkey ORDER BY length(orf) DESC, frame, off) AS n FROM o WHERE length(orf) >= 8)
SELECT p_partkey, CAST(frame AS BIGINT) AS frame, CAST(nt_start AS BIGINT) AS nt_start, orf FROM k WHERE n = 1""")
def three_frame_orfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_frames(R.dealt(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", P.nucleotides(F.col("p_partkey"), 6).alias("nt")), "nt", "found", min_aa=8)
    out = found.select("p_partkey", F.get("found", F.lit(0)).alias("o")).where(F.col("o").isNotNull())
    return out.select("p_partkey", F.col("o.frame").cast("bigint").alias("frame"), F.col("o.nt_start").cast("bigint").alias("nt_start"), F.col("o.protein").alias("orf"))


# ---------------------------------------------------------------- manifest and packaging

@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
 ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS n FROM lineitem) WHERE n = 1""")
def manifest_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")]
    return R.first_wins(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")


#: Classes in order of priority; others rank last.
PRIORITY = ("src3", "src1", "src0", "src7", "src2")


#: Records of documents: a class, an id that several share, a place and a sequence.
SQL_RECORDS = "SELECT lang || '_' || source AS seq_id, source AS variant_class, lpad(CAST(doc_id AS VARCHAR), 10, '0') AS locus, text AS sequence, doc_id FROM documents WHERE text <> ''"
SQL_ORDERED = f"""r AS ({SQL_RECORDS}), o1 AS (SELECT *, variant_class || '_' || lpad(CAST(row_number() OVER (PARTITION BY variant_class ORDER BY seq_id, locus) AS VARCHAR), 6, '0') AS serial FROM r),
 o AS (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY serial) AS k, min(serial) OVER (PARTITION BY variant_class, sequence) AS kept_serial FROM o1)"""
SQL_RANK = f"coalesce(list_position([{', '.join(repr(x) for x in PRIORITY)}], variant_class), 99)"


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text <> ''")
    none = {c: F.lit(None).cast("string").alias(c) for c in ("transcript", "variant_id", "consequence", "gene", "protein_change", "source", "nmd")}
    return docs.select(F.concat_ws("_", "lang", "source").alias("seq_id"), F.col("source").alias("variant_class"), F.lpad(F.col("doc_id").cast("string"), 10, "0").alias("locus"), F.col("text").alias("sequence"), F.lit(None).cast("bigint").alias("variant_pos_aa"), F.lit(None).cast("double").alias("confidence"), *none.values())


@query(f"""WITH {SQL_ORDERED} SELECT locus, serial, CASE WHEN k = 1 THEN seq_id ELSE seq_id || '_dup' || k END AS entry_id, kept_serial, serial = kept_serial AS kept FROM o""")
def serial_and_dup_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serials within classes, ids made unique, and the record that stands for
    each class and sequence."""
    return package.write_order(document_records(spark, sf_dir)).select("locus", "serial", "entry_id", "kept_serial", "kept")


@query(f"""WITH {SQL_ORDERED} SELECT sha256(sequence) AS digest, first(variant_class ORDER BY {SQL_RANK}, serial) AS variant_class, first(serial ORDER BY {SQL_RANK}, serial) AS serial, count(*) AS n_records, string_agg(DISTINCT variant_class, ',' ORDER BY variant_class) AS classes FROM o GROUP BY sequence""")
def class_priority_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry for each sequence, of the best ranked class that reaches it."""
    found = package.entries(package.write_order(document_records(spark, sf_dir)), PRIORITY)
    return found.select("digest", "variant_class", "serial", "n_records", F.array_join("classes", ",").alias("classes"))


@query(f"""WITH {SQL_ORDERED} SELECT kept_serial, serial, locus, first_value(locus) OVER (PARTITION BY kept_serial ORDER BY serial) AS kept_locus FROM o QUALIFY serial <> kept_serial""")
def merged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records were merged into which."""
    return package.merged_loci(package.write_order(document_records(spark, sf_dir))).select("kept_serial", "serial", "locus", "kept_locus")


@query("""SELECT event_type, count(*) AS n_in, count(*) FILTER (af IS NULL) AS n_unknown, count(*) FILTER (af IS NULL OR af >= 0.25) AS n_kept FROM (
 SELECT event_type, CASE WHEN user_id % 7 = 0 THEN NULL ELSE value / 100 END AS af FROM events) GROUP BY event_type""")
def af_filter_null_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unknown frequency is not a low one: it passes."""
    af = F.when(F.col("user_id") % 7 != 0, F.col("value") / 100)
    rows = table(spark, sf_dir, "events").select("event_type", af.alias("af"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n_in"), F.count_if(F.col("af").isNull()).alias("n_unknown"), F.count_if(F.col("af").isNull() | (F.col("af") >= 0.25)).alias("n_kept"))


#: Orders as variants with a frequency, their lines as protein records: a third of the suppliers is not expressed, a status stands for rows that could not be read.
SQL_DISPOSITION = """SELECT variant_id, variant_class, CAST(n_proteins AS BIGINT) AS n_proteins, CASE WHEN low THEN 'below_min_af' WHEN failed THEN 'error' WHEN n IS NULL THEN 'no_protein' WHEN n_proteins > 0 THEN 'protein_built'
  WHEN n_same > 0 AND same IN ('5_prime_UTR', '3_prime_UTR') THEN 'utr_variant' WHEN n_same > 0 AND same = 'synonymous' THEN 'synonymous_only' WHEN n_same > 0 THEN 'synonymous_or_utr' WHEN n_short > 0 THEN 'below_min_length' ELSE 'filtered' END AS outcome,
 CASE WHEN low THEN 'af=' || af || '<0.05' WHEN failed THEN 'unreadable' WHEN n IS NULL THEN '' WHEN n_proteins > 0 THEN names WHEN n_same > 0 AND same = 'synonymous' THEN 'no residue changes' WHEN n_same > 0 THEN same WHEN n_short > 0 THEN '<20 aa' ELSE names END AS detail FROM (
 SELECT v.*, n, coalesce(CASE WHEN NOT low THEN kept END, 0) AS n_proteins, n_same, n_short, same, names FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS variant_id, o_orderpriority AS variant_class, CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 50) / 100 END AS af, coalesce(o_orderkey % 7 <> 0 AND (o_orderkey % 50) / 100 < 0.05, false) AS low, o_orderstatus = 'P' AS failed FROM orders) v LEFT JOIN (
  SELECT variant_id, count(*) AS n, count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason = 'unchanged') AS n_same, count(*) FILTER (reason = 'short') AS n_short,
   coalesce(string_agg(DISTINCT consequence, ';' ORDER BY consequence) FILTER (reason = 'unchanged'), '') AS same, string_agg(DISTINCT consequence, ';' ORDER BY consequence) AS names FROM (
   SELECT CAST(l_orderkey AS VARCHAR) AS variant_id, c AS consequence, CASE WHEN l_suppkey % 3 = 0 THEN 'silent' WHEN l_quantity < 20 THEN 'short' WHEN c <> 'missense' THEN 'unchanged' END AS reason FROM (
    SELECT *, CASE WHEN l_returnflag = 'R' THEN 'synonymous' WHEN l_returnflag = 'A' THEN '5_prime_UTR' ELSE 'missense' END AS c FROM lineitem)) GROUP BY variant_id) b ON b.variant_id = v.variant_id)"""


def dispositions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(manifest, outcomes)."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    manifest = orders.select(key.cast("string").alias("variant_id"), F.col("o_orderpriority").alias("variant_class"), F.struct(F.when(key % 7 != 0, (key % 50) / 100).alias("af")).alias("small"))
    consequence = F.when(F.col("l_returnflag") == "R", "synonymous").when(F.col("l_returnflag") == "A", "5_prime_UTR").otherwise("missense")
    records = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("variant_id"), F.repeat(F.lit("A"), F.col("l_quantity").cast("int")).alias("sequence"), consequence.alias("consequence"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string"), F.lit(".1")).alias("gene"))
    suppliers = table(spark, sf_dir, "lineitem").select("l_suppkey").distinct().where("l_suppkey % 3 <> 0")
    failed = orders.where("o_orderstatus = 'P'").select(key.cast("string").alias("variant_id"), F.lit("unreadable").alias("detail"))
    _, outcomes = package.dispositions(manifest, records, 20, False, 0.05, suppliers.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("gene")), failed)
    return manifest, outcomes


@query(SQL_DISPOSITION)
def disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every input exactly once, with the first outcome that fits."""
    return dispositions(spark, sf_dir)[1]


@query(f"""SELECT coalesce(variant_class, 'TOTAL') AS variant_class, count(*) AS n_input, CAST(sum(n_proteins) AS BIGINT) AS n_proteins, {', '.join(f"count(*) FILTER (outcome = '{o}') AS {o}" for o in checks.LABELS)},
 count(*) FILTER (outcome = 'protein_built') / count(*) AS rate FROM ({SQL_DISPOSITION}) GROUP BY ROLLUP (variant_class)""")
def recovery_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.recovery(dispositions(spark, sf_dir)[1])


def sql_violation(check: str, text: str, key: str, source: str) -> str:
    """One row for the rows of ``source``, as the checks word it."""
    return f"SELECT '{check}' AS check_name, 'error' AS severity, count(*) || ' {text}: ' || min(CAST({key} AS VARCHAR)) || CASE WHEN count(*) > 1 THEN ' ... ' || max(CAST({key} AS VARCHAR)) ELSE '' END AS message FROM ({source}) HAVING count(*) > 0"


_SQL_FAULTY = "SELECT CAST(o_orderkey AS VARCHAR) AS variant_id FROM orders WHERE o_orderkey % 17 <> 0 UNION ALL SELECT 'alien' || o_orderkey FROM orders WHERE o_orderkey % 41 = 0 UNION ALL SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 23 = 1"


@query(f"""WITH m AS (SELECT CAST(o_orderkey AS VARCHAR) AS variant_id FROM orders), o AS ({_SQL_FAULTY})
{sql_violation('I2', 'inputs without outcome', 'variant_id', 'SELECT variant_id FROM m WHERE variant_id NOT IN (SELECT variant_id FROM o)')}
UNION ALL {sql_violation('I2', 'outcomes without input', 'variant_id', 'SELECT variant_id FROM o WHERE variant_id NOT IN (SELECT variant_id FROM m)')}
UNION ALL {sql_violation('I2', 'inputs with several outcomes', 'variant_id', 'SELECT variant_id FROM o GROUP BY variant_id HAVING count(*) > 1')}""")
def reconcile_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The release check of outcomes, on outcomes with a fault of each kind."""
    manifest, outcomes = dispositions(spark, sf_dir)
    number = F.col("variant_id").cast("bigint")
    alien = outcomes.where(number % 41 == 0).withColumn("variant_id", F.concat(F.lit("alien"), "variant_id"))
    return checks.i2_disposition(manifest, outcomes.where(number % 17 != 0).unionByName(alien).unionByName(outcomes.where(number % 23 == 1)))


@query(f"""WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS entry_id FROM documents), p AS (SELECT CAST(doc_id AS VARCHAR) AS entry_id, lang AS part FROM documents WHERE doc_id % 17 <> 0 UNION ALL SELECT CAST(doc_id AS VARCHAR), 'extra' FROM documents WHERE doc_id % 23 = 0 UNION ALL SELECT 'alien' || doc_id, 'alien' FROM documents WHERE doc_id % 41 = 0)
{sql_violation('I1', 'entries in no class file', 'entry_id', 'SELECT entry_id FROM d WHERE entry_id NOT IN (SELECT entry_id FROM p)')}
UNION ALL {sql_violation('I1', 'entries of class files only', 'entry_id', 'SELECT entry_id FROM p WHERE entry_id NOT IN (SELECT entry_id FROM d)')}
UNION ALL {sql_violation('I1', 'entries in several class files', 'entry_id', 'SELECT entry_id FROM p GROUP BY entry_id HAVING count(DISTINCT part) > 1')}""")
def partition_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The release check of class files, on parts with one fault of each kind:
    left out, foreign, in two parts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("entry_id"), F.col("lang").alias("class"))
    parts = docs.where("doc_id % 17 <> 0").union(docs.where("doc_id % 23 = 0").withColumn("class", F.lit("extra"))).union(docs.where("doc_id % 41 = 0").withColumn("entry_id", F.concat(F.lit("alien"), "entry_id")).withColumn("class", F.lit("alien")))
    return checks.i1_partition(docs.select("entry_id"), parts.select("entry_id", "class"))


@query("""WITH req AS (SELECT DISTINCT l_orderkey AS ev, l_partkey AS j FROM lineitem WHERE l_returnflag = 'R'), obs AS (SELECT l_partkey AS j, count(DISTINCT l_suppkey % 20) AS tissues FROM lineitem WHERE l_linestatus = 'F' AND l_quantity > 20 GROUP BY ALL)
SELECT ev, min(tissues) AS min_tissues FROM req LEFT JOIN obs USING (j) GROUP BY ev HAVING count(*) = count(tissues)""")
def junction_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events all of whose junctions were observed, with the least support."""
    lines = table(spark, sf_dir, "lineitem")
    need = lines.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("event_id"), F.col("l_partkey").alias("junction")).distinct()
    seen = lines.where("l_linestatus = 'F' AND l_quantity > 20").groupBy(F.col("l_partkey").alias("junction")).agg(F.count_distinct(F.col("l_suppkey") % 20).alias("tissues"))
    return truth.normal_events(need, seen).withColumnsRenamed({"event_id": "ev", "tissues": "min_tissues"})


@query("""SELECT variant_class, min(c) AS low, max(c) AS high, list(c ORDER BY c)[count(*) // 2 + 1] AS upper_median FROM (SELECT l_returnflag || l_linestatus AS variant_class, l_extendedprice AS c FROM lineitem) GROUP BY 1""")
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("variant_class"), F.col("l_extendedprice").alias("confidence"))
    return checks.confidence_profile(rows)


@query("""WITH g AS (SELECT l_suppkey, l_returnflag, max(l_quantity) AS support, string_agg(DISTINCT l_linestatus, '|' ORDER BY l_linestatus) AS kinds, arg_min(l_orderkey, l_orderkey * 100 + l_linenumber) AS first_order, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_returnflag, support, kinds, first_order, n, n / (SELECT max(n) FROM g) AS share FROM g WHERE n >= 3""")
def union_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records merged by key; the share is of the maximum before the filter."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        F.max("l_quantity").alias("support"), F.array_join(F.array_sort(F.collect_set("l_linestatus")), "|").alias("kinds"),
        F.min("l_orderkey").alias("first_order"), F.count("*").alias("n"),
    )
    top = g.agg(F.max("n").alias("top"))
    return g.crossJoin(F.broadcast(top)).where("n >= 3").select("l_suppkey", "l_returnflag", "support", "kinds", "first_order", "n", (F.col("n") / F.col("top")).alias("share"))


@query("""WITH t AS (SELECT lang AS category, toxic = 1 AS truth, n_chars % 3 <> 0 AS observed, position('trash' in lower(text)) > 0 OR position('stupid' in lower(text)) > 0 AS said FROM labels JOIN documents USING (doc_id)), c AS (
 SELECT coalesce(category, 'TOTAL') AS category, count(*) AS n, count(*) FILTER (observed AND truth = said) AS n_found, count(*) FILTER (observed) AS seen FROM t GROUP BY ROLLUP (category))
SELECT category, n, n_found, n_found / n AS recall, CASE WHEN seen > 0 THEN n_found / seen END AS precision FROM c""")
def recall_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as asserted changes, words as observed ones, in two spellings;
    a third of the places is not observed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", (F.lower("text").contains("trash") | F.lower("text").contains("stupid")).alias("said"))
    rows = table(spark, sf_dir, "labels").select("doc_id", "toxic").join(docs, "doc_id")
    asserted = rows.select(F.col("doc_id").cast("string").alias("locus"), F.when(F.col("toxic") == 1, "p.(Lys1Glu)").otherwise("p.Lys1Arg").alias("change"), F.col("lang").alias("category"))
    observed = rows.where("n_chars % 3 <> 0").select(F.concat(F.lit("chr"), F.col("doc_id").cast("string")).alias("locus"), F.array(F.lit("p.A9V"), F.when(F.col("said"), "p.K1E").otherwise("K1R")).alias("changes"))
    return truth.accuracy(truth.score(asserted, observed))


# ---------------------------------------------------------------- combinations

SQL_PLACED = "SELECT DISTINCT l_orderkey AS tx, l_partkey % 500 AS start, 1 + l_linenumber % 5 AS len, CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'B' || l_suppkey % 4 END AS ps, l_linenumber % 2 AS hap FROM lineitem"


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    ps = F.when(F.col("l_suppkey") % 3 == 0, "").otherwise(F.concat(F.lit("B"), (F.col("l_suppkey") % 4).cast("string")))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tx"), (F.col("l_partkey") % 500).alias("start"), (1 + F.col("l_linenumber") % 5).alias("len"), ps.alias("ps"), (F.col("l_linenumber") % 2).alias("hap")).distinct()


@query(f"""WITH v AS ({SQL_PLACED}), b AS (SELECT tx, count(*) AS n, count(*) FILTER (ps = '') AS loose, count(DISTINCT nullif(ps, '')) AS blocks FROM v GROUP BY tx)
SELECT tx, ps || '|' || hap AS phase, true AS phased, count(*) AS members FROM v WHERE ps <> '' GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT tx, 'unphased', false, n FROM b WHERE n > 1 AND (loose > 0 OR blocks > 1)""")
def phase_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Haplotypes with two variants or more, and one unphased group where the
    caller left the phase open."""
    from .combine import phase_groups as groups

    return groups(placements(spark, sf_dir), "tx", "ps", "hap")


@query(f"""WITH v AS ({SQL_PLACED}), l AS (SELECT tx, start, len, lead(start) OVER (PARTITION BY tx ORDER BY start, len, ps, hap) AS nxt FROM v)
SELECT tx, count(*) AS n, bool_or(coalesce(nxt < start + len, false)) AS clash FROM l GROUP BY tx""")
def combo_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("tx").orderBy("start", "len", "ps", "hap")
    rows = placements(spark, sf_dir).withColumn("nxt", F.lead("start").over(w))
    return rows.groupBy("tx").agg(F.count("*").alias("n"), F.bool_or(F.coalesce(F.col("nxt") < F.col("start") + F.col("len"), F.lit(False))).alias("clash"))


@query("""WITH f AS (SELECT DISTINCT l_partkey AS g1, (l_partkey * 7 + l_suppkey) % (SELECT count(*) FROM part) AS g2, l_quantity AS bp FROM lineitem), o AS (
 SELECT g1 AS g5, g2 AS g3, bp FROM f UNION ALL SELECT g2, g1, bp FROM f)
SELECT g5, g3, CAST(bp AS BIGINT) AS bp, a.p_brand AS brand5, b.p_brand AS brand3, a.p_size * 3 + b.p_size AS junction FROM o JOIN part a ON a.p_partkey = g5 JOIN part b ON b.p_partkey = g3 WHERE a.p_size >= 5""")
def fusion_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both orders of each pair, each partner looked up on its own."""
    part = table(spark, sf_dir, "part")
    n = part.agg(F.count("*").alias("n_parts"))
    pairs = table(spark, sf_dir, "lineitem").crossJoin(F.broadcast(n)).select(F.col("l_partkey").alias("g1"), ((F.col("l_partkey") * 7 + F.col("l_suppkey")) % F.col("n_parts")).alias("g2"), F.col("l_quantity").cast("bigint").alias("bp")).distinct()
    both = pairs.select("bp", F.explode(F.array(F.struct(F.col("g1").alias("g5"), F.col("g2").alias("g3")), F.struct(F.col("g2").alias("g5"), F.col("g1").alias("g3")))).alias("o")).select("o.*", "bp")
    five = part.where("p_size >= 5").select(F.col("p_partkey").alias("g5"), F.col("p_brand").alias("brand5"), F.col("p_size").alias("s5"))
    three = part.select(F.col("p_partkey").alias("g3"), F.col("p_brand").alias("brand3"), F.col("p_size").alias("s3"))
    return both.join(five, "g5").join(three, "g3").select("g5", "g3", "bp", "brand5", "brand3", (F.col("s5") * 3 + F.col("s3")).alias("junction"))


# ---------------------------------------------------------------- splicing events

#: Four transcripts to a gene; exons follow from the part's key and size.
SQL_EXONS = "SELECT p_partkey // 4 AS gene, p_partkey AS tx, 1000 + k * 100 + CASE WHEN k = 1 THEN p_size % 3 * 10 ELSE 0 END AS s, 1050 + k * 100 + CASE WHEN k = 2 THEN p_partkey % 3 * 10 WHEN k = 3 AND p_size % 5 = 0 THEN 100 ELSE 0 END AS e FROM part, unnest(range(0, 6)) AS t(k) WHERE (p_size + k * 7) % 6 <> 1 AND NOT (p_size % 5 = 0 AND k = 4)"


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("k"), F.col("p_size")
    rows = R.dealt(table(spark, sf_dir, "part"), "p_partkey").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(5)))).where(((size + k * 7) % 6 != 1) & ~((size % 5 == 0) & (k == 4)))
    s = 1000 + k * 100 + F.when(k == 1, size % 3 * 10).otherwise(0)
    e = 1050 + k * 100 + F.when(k == 2, F.col("p_partkey") % 3 * 10).when((k == 3) & (size % 5 == 0), 100).otherwise(0)
    return rows.select(F.floor(F.col("p_partkey") / 4).alias("gene"), F.col("p_partkey").alias("tx"), s.cast("bigint").alias("s"), e.cast("bigint").alias("e"))


SQL_JX = f"x AS ({SQL_EXONS}), j AS (SELECT gene, tx, s, e, lead(s) OVER (PARTITION BY tx ORDER BY s) AS nxt, lead(e) OVER (PARTITION BY tx ORDER BY s) AS nxe, lead(s, 2) OVER (PARTITION BY tx ORDER BY s) AS nx2, lead(e, 2) OVER (PARTITION BY tx ORDER BY s) AS ne2, lead(s, 3) OVER (PARTITION BY tx ORDER BY s) AS nx3 FROM x), q AS (SELECT DISTINCT gene, e AS lo, nxt AS hi FROM j WHERE nxt IS NOT NULL)"

SQL_EVENTS = f"""WITH {SQL_JX},
se AS (SELECT DISTINCT 'SE' AS type, j.gene, e || '-' || nxt || ':' || nxe || '-' || nx2 AS form FROM j JOIN q ON q.gene = j.gene AND q.lo = j.e AND q.hi = j.nx2),
a5 AS (SELECT DISTINCT 'A_acceptor' AS type, a.gene, a.lo || '-' || a.hi || ':' || b.lo || '-' || b.hi AS form FROM q a JOIN q b ON a.gene = b.gene AND a.lo = b.lo AND a.hi < b.hi),
a3 AS (SELECT DISTINCT 'A_donor' AS type, a.gene, a.lo || '-' || a.hi || ':' || b.lo || '-' || b.hi AS form FROM q a JOIN q b ON a.gene = b.gene AND a.hi = b.hi AND a.lo < b.lo),
ri AS (SELECT DISTINCT 'RI' AS type, q.gene, x.s || ':' || q.lo || '-' || q.hi || ':' || x.e AS form FROM q JOIN x ON x.gene = q.gene AND x.s < q.lo AND x.e > q.hi),
mx AS (SELECT DISTINCT 'MX' AS type, a.gene, a.e || '-' || a.nxt || ':' || a.nxe || '-' || a.nx2 || ':' || b.nxt || ':' || b.nxe AS form FROM j a JOIN j b ON a.gene = b.gene AND a.e = b.e AND a.nx2 = b.nx2 AND a.nxe < b.nxt)
SELECT * FROM se UNION ALL SELECT * FROM a5 UNION ALL SELECT * FROM a3 UNION ALL SELECT * FROM ri UNION ALL SELECT * FROM mx"""


@query(SQL_EVENTS)
def event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternative splicing events between transcripts of a gene."""
    from .events import internal_events

    return internal_events(exons(spark, sf_dir))


@query(f"""WITH x AS ({SQL_EXONS}), n AS (SELECT gene, tx, min(s) AS s1, max(s) AS sl, min(e) AS e1, max(e) AS el, list(s ORDER BY s)[2] AS s2, list(e ORDER BY s)[count(*) - 1] AS ek FROM x GROUP BY ALL HAVING count(*) > 1)
SELECT DISTINCT 'first' AS side, a.gene, a.s1 || ':' || a.e1 || '-' || a.s2 || ':' || b.s1 || ':' || b.e1 || '-' || b.s2 AS form FROM n a JOIN n b ON a.gene = b.gene AND a.s2 = b.s2 AND a.e1 < b.s1
UNION ALL SELECT DISTINCT 'last', a.gene, a.ek || '-' || a.sl || ':' || a.el || ':' || b.ek || '-' || b.sl || ':' || b.el FROM n a JOIN n b ON a.gene = b.gene AND a.ek = b.ek AND a.el < b.sl""")
def terminal_event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternative first and last exons that share the junction's other side."""
    from .events import terminal_events

    return terminal_events(exons(spark, sf_dir))


# ---------------------------------------------------------------- headers and provenance

@query("""SELECT doc_id, 'vt|' || upper(lang) || '_' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '|' || trim(regexp_replace(source || ' ' || lang, '[^A-Za-z0-9_.:\\-]+', '_', 'g'), '_') || ' VT=' || upper(lang) || ' GN=' || source || CASE WHEN n_chars % 3 = 0 THEN '' ELSE ' CONF=' || n_chars % 3 END AS header FROM documents""")
def header_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    confidence = F.when(F.col("n_chars") % 3 != 0, (F.col("n_chars") % 3).cast("string"))
    name = H.sanitised(F.concat_ws(" ", "source", "lang"))
    first = F.concat(F.lit("vt|"), F.upper("lang"), F.lit("_"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit("|"), name)
    return docs.select("doc_id", H.joined(first, {"VT": F.upper("lang"), "GN": F.col("source"), "CONF": confidence}).alias("header"))


@query(f"""WITH {SQL_ORDERED} SELECT sha256(sequence) AS digest, string_agg(serial || '/' || variant_class || '/' || locus, ';' ORDER BY serial) AS variants, length(first(sequence)) AS length, count(*) AS n FROM o GROUP BY sequence""")
def provenance_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = package.write_order(document_records(spark, sf_dir))
    nested = package.provenance(ordered, package.entries(ordered, PRIORITY))
    said = F.transform("variants", lambda v: F.concat_ws("/", v["serial"], v["variant_class"], v["locus"]))
    return nested.select("digest", F.array_join(said, ";").alias("variants"), F.col("length").cast("bigint").alias("length"), F.size("variants").cast("bigint").alias("n"))


@query("""SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, max(length(l)) AS longest, count(DISTINCT length(l)) AS n_lengths FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS l FROM documents) GROUP BY doc_id, text""")
def layout_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each text: how many, the longest, and how many lengths."""
    lens = F.transform(F.split("text", "\\n"), F.length)
    rows = table(spark, sf_dir, "documents").select("doc_id", lens.alias("l"))
    return rows.select("doc_id", F.size("l").cast("bigint").alias("n_lines"), F.array_max("l").cast("bigint").alias("longest"), F.size(F.array_distinct("l")).cast("bigint").alias("n_lengths"))


@query("""SELECT p_brand AS name, count(DISTINCT p_type) AS n_ids FROM part GROUP BY p_brand HAVING count(DISTINCT p_type) > 1""")
def ambiguous_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("name")).agg(F.count_distinct("p_type").alias("n_ids")).where("n_ids > 1")


@query("""WITH c AS (SELECT l_orderkey AS v, l_partkey % 300 AS pos, l_suppkey % 50 AS tx FROM lineitem), s AS (SELECT p_partkey % 50 AS tx, p_partkey AS pep, p_partkey * 11 % 300 AS a, p_partkey * 11 % 300 + p_size AS b FROM part),
h AS (SELECT DISTINCT v, c.tx, pos, pep FROM c JOIN s ON c.tx = s.tx AND pos BETWEEN a AND b), m AS (SELECT tx, pep, count(DISTINCT pos) AS n FROM h GROUP BY ALL)
SELECT (SELECT count(*) FROM (SELECT DISTINCT tx, pos FROM c)) AS n_subs, count(*) AS n_discoverable, count(*) FILTER (together) AS n_cooccurring FROM (SELECT h.tx, pos, bool_or(n > 1) AS together FROM h JOIN m ON h.tx = m.tx AND h.pep = m.pep GROUP BY ALL)""")
def cooccurrence_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substitutions, those within a peptide, and those that share one."""
    subs = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 300).alias("pos"), (F.col("l_suppkey") % 50).alias("tx")).distinct()
    start = F.col("p_partkey") * 11 % 300
    spans = table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).alias("span_tx"), F.col("p_partkey").alias("pep"), start.alias("a"), (start + F.col("p_size")).alias("b"))
    hits = R.interval_join(subs, spans, "pos", "a", "b", [("tx", "span_tx")], width=32).select("tx", "pos", "pep")
    shared = hits.groupBy("tx", "pep").agg(F.count("*").alias("n"))
    flags = hits.join(shared, ["tx", "pep"]).groupBy("tx", "pos").agg(F.bool_or(F.col("n") > 1).alias("together"))
    found = flags.agg(F.count("*").alias("n_discoverable"), F.count_if("together").alias("n_cooccurring"))
    return subs.agg(F.count("*").alias("n_subs")).crossJoin(found)  # one row each
