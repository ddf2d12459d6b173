"""Cases that are made rather than called: published changes traced back to
genomic sites, sequence-style variants written as genomic ones, and pairs of
variants whose peptide neither gives alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import peptides as P
from ..functions import sequence as S
from ..operators import relational as R
from ..session import use_checkpoints
from ..sources import genome as G
from .annotate import candidates, placement, representative

# Accessions of the human chromosomes, and of the mitochondrial genome.
CHROMOSOME, AUTOSOMES, SEX, MITO_ACCESSION = "^NC_0000(\\d\\d)\\.\\d+$", 22, {23: "chrX", 24: "chrY"}, "NC_012920"


def accession_contig(accession: Column) -> Column:
    """The contig of a chromosome's accession; null for others."""

    def named(n: Column) -> Column:
        names = F.when(n.between(1, AUTOSOMES), F.concat(F.lit("chr"), n.cast("string")))
        for number, name in SEX.items():
            names = names.when(n == number, name)
        return names.when(accession.startswith(MITO_ACCESSION), "chrM")

    return S.once(F.regexp_extract(accession, CHROMOSOME, 1).try_cast("int"), named)


#: All contigs that an accession can stand for.
ACCESSION_CONTIGS = (*(f"chr{n}" for n in range(1, AUTOSOMES + 1)), *SEX.values(), "chrM")


def spdi_to_vcf(rows: DataFrame, spdi: str, chunks: DataFrame, chunk: int = G.CHUNK) -> DataFrame:
    """The rows with chrom, pos, ref and alt of sequence:position:deleted:inserted,
    and the problem of those that can't be written so.  Positions there start
    at 0; a pure insertion or deletion gets the base before it, from the genome
    (contig, chunk_no, seq) whose contigs may have either style of name."""

    def told(parts: Column) -> Column:
        part = lambda i: F.get(parts, F.lit(i))
        at = F.when(part(1).rlike("^[0-9]+$"), part(1).try_cast("bigint"))
        return S.once(F.struct(accession_contig(part(0)).alias("chrom"), at.alias("at"), F.upper(part(2)).alias("gone"), F.upper(part(3)).alias("new"), F.size(parts).alias("n")), judged)

    def judged(x: Column) -> Column:
        bases = lambda name: x[name].rlike("^[ACGTN]*$")
        bare = (x["gone"] == "") | (x["new"] == "")
        problem = (
            F.when(F.col(spdi).isNull() | (x["n"] != 4) | x["at"].isNull(), "not_readable").when(x["chrom"].isNull(), "unknown_accession").when(~bases("gone") | ~bases("new"), "not_bases")
            .when((x["gone"] == "") & (x["new"] == ""), "no_change").when(bare & (x["at"] < 1), "no_base_before")
        )
        return F.struct(*(x[c].alias(c) for c in ("chrom", "at", "gone", "new")), bare.alias("bare"), problem.alias("problem"))

    # a text is read once, as a row of its own: what asks for a part of it, or filters by one, doesn't read it again
    read = rows.select("*", F.explode(F.array(S.once(F.split(F.col(spdi), ":", -1), told))).alias("_x")).withColumn("problem", F.col("_x.problem"))
    x = lambda name: F.col(f"_x.{name}")
    bare = x("bare")
    columns = rows.columns
    plain = read.where(~(F.col("problem").isNull() & bare)).withColumn("_anchor", F.lit(None).cast("string"))
    # only those that need a base meet the genome; its names for the contigs of accessions are a row for each of these
    names = G.contig_names(chunks.select("contig")).where(F.col("alias").isin(*ACCESSION_CONTIGS)).withColumnsRenamed({"alias": "_alias", "contig": "_resolved"})
    open_ = read.where(F.col("problem").isNull() & bare).join(F.broadcast(names), x("chrom") == F.col("_alias"), "left").drop("_alias")
    anchored = G.base_at(open_, "_resolved", x("at"), chunks, "_anchor", chunk).drop("_resolved").withColumn("problem", F.when(F.col("_anchor").isNull(), "no_base_before"))
    both = plain.unionByName(anchored)
    fine = F.col("problem").isNull()
    whole = lambda side: F.when(bare, F.concat("_anchor", x(side))).otherwise(x(side))
    return both.select(*columns, F.when(fine, x("chrom")).alias("chrom"), F.when(fine, x("at") + F.when(bare, 0).otherwise(1)).alias("pos"), F.when(fine, whole("gone")).alias("ref"), F.when(fine, whole("new")).alias("alt"), "problem")


# ------------------------------------------------------------------ sites of published changes


def edited_codons(spark: SparkSession, before: str = "A", after: str = "G") -> DataFrame:
    """(codon, mito, residue, edit_at, edited, becomes): what each codon
    becomes when one of its bases is edited; of edits with one outcome the
    first base's."""
    codons = [a + b + c for a in S.BASES for b in S.BASES for c in S.BASES]
    rows, seen = [], set()
    for mito, code in ((False, S.STANDARD_CODE), (True, S.MITO_CODE)):
        read = dict(zip(codons, code, strict=True))
        for codon in codons:
            for i, base in enumerate(codon):
                edited = codon[:i] + after + codon[i + 1 :]
                if base == before and (mito, codon, read[edited]) not in seen:
                    seen.add((mito, codon, read[edited]))
                    rows.append((codon, mito, read[codon], i, edited, read[edited]))
    return spark.createDataFrame(rows, "codon string, mito boolean, residue string, edit_at int, edited string, becomes string")


CHANGE = "^(?:p\\.)?([A-Z*])([0-9]+)([A-Z*])$"


def editing_sites(changes: DataFrame, transcripts: DataFrame, sequences: DataFrame, before: str = "A", after: str = "G") -> DataFrame:
    """The genomic site of each published recoding (gene, change): changes with
    tx_id, chrom, pos, strand, ref, alt, codon, edited and the problem of those
    without one.  A site needs a codon that stands for the residue the change
    begins with, and one edit of it that gives the residue it ends with, on the
    gene's best transcript; on the minus strand the genome shows complements."""
    part = lambda i: F.nullif(F.regexp_extract("change", CHANGE, i), F.lit(""))
    asked = changes.select(*changes.columns, part(1).alias("_from"), part(2).try_cast("int").alias("_at"), part(3).alias("_to"))
    best = representative(transcripts).join(R.merged(transcripts.where("cds_off IS NOT NULL").select("tx_id", "chrom", "strand", "exons", "cds_off")), "tx_id").join(R.merged(sequences), "tx_id").withColumnRenamed("alias", "_gene")
    joined = asked.join(R.merged(best), F.col("gene") == F.col("_gene"), "left").withColumn("_off", F.col("cds_off") + 3 * (F.col("_at") - 1))
    read = joined.withColumn("_codon", F.when(F.col("_at") > 0, F.substring("tx_seq", (F.col("_off") + 1).cast("int"), F.lit(3)))).withColumn("_mito", F.coalesce(F.col("chrom").isin(*S.MITO_CONTIGS), F.lit(False)))
    table = F.broadcast(edited_codons(changes.sparkSession, before, after))  # one row at most for each base of each codon
    found = read.join(table, (F.col("_codon") == F.col("codon")) & (F.col("_mito") == F.col("mito")) & (F.col("_to") == F.col("becomes")) & (F.col("_from") == F.col("residue")), "left")
    pos = S.tx_to_genomic(F.col("exons"), F.col("strand"), F.col("_off") + F.col("edit_at"))
    shown = lambda base: F.when(F.col("strand") == "-", S.revcomp(F.lit(base))).otherwise(F.lit(base))
    own = F.when(F.col("_mito"), F.try_element_at(S.codon_map(S.MITO_CODE), F.col("_codon"))).otherwise(F.try_element_at(S.codon_map(), F.col("_codon")))
    problem = (
        F.when(F.col("_from").isNull() | F.col("_at").isNull() | F.col("_to").isNull(), "not_readable").when(F.col("tx_id").isNull(), "no_coding_transcript").when(F.coalesce(F.length("_codon"), F.lit(0)) < 3, "beyond_the_end")
        .when(F.coalesce(own != F.col("_from"), F.lit(True)), "another_residue").when(F.col("codon").isNull(), "no_single_edit")
    )
    fine = problem.isNull()
    given = lambda c, name: F.when(fine, c).alias(name)
    return found.select(*changes.columns, given(F.col("tx_id"), "tx_id"), given(F.col("chrom"), "chrom"), given(pos, "pos"), given(F.col("strand"), "strand"), given(shown(before), "ref"), given(shown(after), "alt"), given(F.col("_codon"), "codon"), given(F.col("edited"), "edited"), problem.alias("problem"))


# ------------------------------------------------------------------ pairs across kinds of evidence

# The base that a constructed substitution puts in another's place.
SWAP = {"A": "G", "G": "A", "C": "T", "T": "C"}


def cross_evidence(edits: DataFrame, transcripts: DataFrame, sequences: DataFrame, missed: int = 2, least: int = 6, most: int = 50) -> DataFrame:
    """For each recoding edit of one base (variant_id, chrom, pos, ref, alt,
    genes) a constructed substitution in the same peptide, and the peptides
    that only the two together give.

    On the best transcript at the site the longest tryptic peptide over the
    edited residue is taken; of its other codons the first whose first base,
    swapped, changes the protein carries the substitution.  Rows: variant_id,
    tx_id, chrom, snv_pos, snv_ref, snv_alt, edited_residue and snv_residue
    (0-based), and peptides, the shortest first."""
    use_checkpoints(edits.sparkSession)
    single = edits.where("length(ref) = 1 AND length(alt) = 1")
    tx = transcripts.where("is_coding AND cds_off IS NOT NULL").join(R.merged(sequences), "tx_id").withColumnRenamed("chrom", "tx_chrom")
    placed = candidates(single, transcripts, "representative").join(R.merged(single), "variant_id").join(R.merged(tx), "tx_id").withColumn("p", placement()).where("p IS NOT NULL AND p.start >= cds_off")
    mito = F.col("tx_chrom").isin(*S.MITO_CONTIGS)
    sec = S.sec_codons(F.col("exons"), F.col("strand"), F.col("sec_sites"), F.col("cds_off"))

    def read(*ps: Column) -> Column:
        seq = F.col("tx_seq")
        for p in ps:
            seq = S.splice(seq, p["start"], p["len"], p["allele"])
        return S.protein_of(F.substring(seq, (F.col("cds_off") + 1).cast("int"), F.length(seq)), mito, sec)

    own = placed.withColumn("ref_p", read()).withColumn("edit_p", read(F.col("p"))).where("edit_p <> '' AND edit_p <> ref_p")
    own = own.withColumn("idx", F.floor((F.col("p.start") - F.col("cds_off")) / 3).cast("int")).withColumn("b", P.peptide_bounds("ref_p", F.col("idx"), missed, least, most)).where("b IS NOT NULL").checkpoint()
    # the best transcript of a site's genes, and each codon of its peptide as a row
    first = R.first_wins(own.select("variant_id", "tx_id"), ["variant_id"], [F.col("tx_id")])
    codons = own.join(R.merged(first), ["variant_id", "tx_id"], "left_semi").withColumn("codon_no", F.explode(F.sequence(F.col("b.start"), F.col("b.end") - 1))).where("codon_no <> idx")
    off = F.col("cds_off") + 3 * F.col("codon_no")
    base = F.substring("tx_seq", (off + 1).cast("int"), F.lit(1))
    swapped = F.try_element_at(F.create_map(*(F.lit(x) for pair in SWAP.items() for x in pair)), base)
    tried = codons.withColumn("q", F.struct(off.cast("bigint").alias("start"), F.lit(1).cast("bigint").alias("len"), swapped.alias("allele"))).withColumn("snv_base", base).where("q.allele IS NOT NULL")
    tried = tried.withColumn("snv_p", read(F.col("q"))).where("snv_p <> '' AND snv_p <> ref_p").checkpoint()
    chosen = R.first_wins(tried.select("variant_id", "tx_id", "codon_no"), ["variant_id", "tx_id"], [F.col("codon_no")])
    # one row for each edit: its proteins are read once and digested once
    pair = tried.join(R.merged(chosen), ["variant_id", "tx_id", "codon_no"]).withColumn("both_p", read(F.col("p"), F.col("q"))).checkpoint()
    folded = lambda c: F.transform(P.digest(c, missed, least, most), P.fold)
    known = pair.withColumn("known", F.array_union(folded("ref_p"), F.array_union(folded("edit_p"), folded("snv_p"))))
    fresh = F.array_except(P.digest("both_p", missed, least, most), F.filter(P.digest("both_p", missed, least, most), lambda p: F.array_contains(F.col("known"), P.fold(p))))
    ordered = F.transform(F.array_sort(F.transform(fresh, lambda p: F.struct(F.length(p).alias("n"), p.alias("p")))), lambda x: x["p"])
    minus = F.col("strand") == "-"
    shown = lambda c: F.when(minus, S.revcomp(c)).otherwise(c)
    return known.select(
        "variant_id", "tx_id", F.col("tx_chrom").alias("chrom"), S.tx_to_genomic(F.col("exons"), F.col("strand"), F.col("q.start")).alias("snv_pos"), shown(F.col("snv_base")).alias("snv_ref"), shown(F.col("q.allele")).alias("snv_alt"),
        F.col("idx").alias("edited_residue"), F.col("codon_no").alias("snv_residue"), ordered.alias("peptides"),
    ).where(F.size("peptides") > 0)
