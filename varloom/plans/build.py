"""Builders: evidence rows become protein records.

A record has seq_id, sequence, variant_class, consequence, gene, transcript,
protein_change, variant_pos_aa, ref_protein_len, locus, source, confidence,
novel_start, novel_end, notes and variant_id.  All builders are joins and
expressions; only open frames are looked for in Arrow batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import peptides as P
from ..functions import sequence as S
from ..functions.frames import with_frames
from ..operators import relational as R
from ..session import use_checkpoints
from ..sources.reference import bare_contig
from .annotate import aliases, candidates, placement, ranking, representative

RECORD = ["variant_id", "seq_id", "sequence", "variant_class", "consequence", "gene", "transcript", "protein_change", "variant_pos_aa", "ref_protein_len", "locus", "source", "confidence", "novel_start", "novel_end", "notes", "ref_protein", "nmd"]
KINDS = {"variant_pos_aa": "bigint", "ref_protein_len": "bigint", "novel_start": "bigint", "novel_end": "bigint", "confidence": "double"}


def records(df: DataFrame, **columns: Column) -> DataFrame:
    """Record columns, null where none is given."""
    notes = F.array().cast("array<string>")
    made = [(columns.get(c, notes if c == "notes" else F.lit(None)) if c in columns or c not in df.columns else F.col(c)).cast("array<string>" if c == "notes" else KINDS.get(c, "string")).alias(c) for c in RECORD]
    return df.select(*made)


def note(*pairs: tuple[Column, Column | str]) -> Column:
    """The notes whose condition holds, in order."""
    each = [F.when(c, x if isinstance(x, Column) else F.lit(x)) for c, x in pairs]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def is_mito(chrom: Column | str) -> Column:
    return S.as_column(chrom).isin(*S.MITO_CONTIGS)


def small_variants(variants: DataFrame, transcripts: DataFrame, sequences: DataFrame, mode: str = "all") -> DataFrame:
    """Proteins of variants (variant_id, chrom, pos, ref, alt, genes,
    variant_class, source, confidence) on every transcript they lie in."""
    tx = transcripts.join(R.merged(sequences), "tx_id")
    hits = candidates(variants, transcripts, mode).join(R.merged(variants), "variant_id").join(R.merged(tx.withColumnRenamed("chrom", "tx_chrom")), "tx_id").where(bare_contig(F.col("chrom")) == bare_contig(F.col("tx_chrom")))
    # as a row of its own, so that the filter doesn't work the placement out again
    placed = hits.where("cds_off IS NOT NULL").select("*", F.explode(F.array(placement())).alias("p")).where("p IS NOT NULL")
    start, n, delta = F.col("p.start"), F.col("p.len"), F.length("p.allele") - F.col("p.len")
    upstream = start < F.col("cds_off")
    spliced = placed.select("*", S.splice(F.col("tx_seq"), start, n, F.col("p.allele")).alias("mut"), (F.col("cds_off") + F.when(upstream, delta).otherwise(0)).alias("mut_off"), delta.alias("delta"), is_mito("tx_chrom").alias("mito"))
    from_cds = lambda seq, off: F.substring(F.col(seq), (F.col(off) + 1).cast("int"), F.length(seq))
    exons, strand, sites = F.col("exons"), F.col("strand"), F.col("sec_sites")
    read = spliced.withColumn("ref_sec", S.sec_codons(exons, strand, sites, F.col("cds_off"))).withColumn("alt_sec", S.sec_codons(exons, strand, sites, F.col("mut_off"), start, F.col("delta")))
    read = read.withColumn("r", S.translate_orf(from_cds("tx_seq", "cds_off"), F.col("mito"), F.col("ref_sec"))).withColumn("a", S.translate_orf(from_cds("mut", "mut_off"), F.col("mito"), F.col("alt_sec")))
    orf_end = F.col("cds_off") + 3 * F.length("r.protein") + F.when(F.col("r.stop_found"), 3).otherwise(0)
    effect = F.when(start + n - 1 < F.col("cds_off"), "5_prime_UTR").when(start >= orf_end, "3_prime_UTR").otherwise(S.consequence(F.col("r.protein"), F.col("a.protein"), n, F.length("p.allele"), F.col("a.stop_found")))
    called = read.withColumn("consequence", effect).withColumn("idx", S.first_difference("r.protein", "a.protein"))
    lengths = F.transform(exons, S.block_length)
    decay = S.nmd(F.col("mut_off") + 3 * F.length("a.protein"), lengths, start, F.col("delta"), F.col("a.stop_found"))
    cut = F.col("consequence").isin("frameshift", "stop_gained")
    flagged = called.withColumn("decay", F.when(cut, decay))
    observed = F.substring(F.col("tx_seq"), (start + 1).cast("int"), n.cast("int"))
    changed = F.col("consequence") != "synonymous"
    pos = F.when(changed, F.col("idx") + 1)
    notes = note(
        (F.col("p.trimmed"), "vcf_anchor_outside_cds"),
        (observed != F.col("p.expected"), F.concat(F.lit("REF_MISMATCH(expected="), "p.expected", F.lit(",found="), observed, F.lit(")"))),
        (upstream & (F.col("delta") != 0), "5UTR_indel_shifts_CDS_start"),
        (F.size("ref_sec") > 0, F.concat(F.lit("selenoprotein_"), F.size("ref_sec").cast("string"), F.lit("_Sec_codons"))),
        (F.col("mito"), "mitochondrial_genetic_code"), (F.col("a.protein") == "", "empty_alt_protein"), (~F.col("r.stop_found"), "ref_orf_no_stop"), (~F.col("a.stop_found"), "alt_orf_runs_to_transcript_end"),
        (F.col("r.ambiguous_codons") + F.col("a.ambiguous_codons") > 0, "ambiguous_bases_translated_as_X"), (F.col("decay.nmd") == "likely", "NMD_likely"),
    )
    shift = F.col("consequence") == "frameshift"
    return records(
        flagged, seq_id=F.concat_ws("_", "gene_name", "tx_id", "chrom", F.col("pos").cast("string"), "ref", "alt"), sequence=F.col("a.protein"), gene=F.col("gene_name"), transcript=F.col("tx_id"),
        protein_change=S.change_text(F.col("consequence"), F.col("r.protein"), F.col("a.protein"), F.col("idx")), variant_pos_aa=pos, ref_protein_len=F.length("r.protein"),
        locus=F.concat("chrom", F.lit(":"), F.col("pos").cast("string"), "ref", F.lit(">"), "alt"), novel_start=pos, novel_end=F.when(shift, F.length("a.protein").cast("bigint")).otherwise(pos), notes=notes,
        ref_protein=F.col("r.protein"), nmd=F.coalesce(F.col("decay.nmd"), F.lit("not_applicable")),
    )


# ------------------------------------------------------------------ splicing


def event_forms() -> Column:
    """Array of struct(form, need, spans): the junctions each form needs; an
    intron that a form retains instead; null where the groups don't fit."""
    g, kind = F.col("groups"), F.col("event_type")
    at = lambda i, j: F.get(F.get(g, F.lit(i)), F.lit(j)).cast("string")
    pair = lambda x: F.concat_ws("-", F.array_min(x).cast("string"), F.array_max(x).cast("string"))
    nth = lambda i: pair(F.get(g, F.lit(i)))
    form = lambda name, *need: F.struct(F.lit(name).alias("form"), (F.array(*need) if need else F.array()).cast("array<string>").alias("need"), F.lit(None).cast("string").alias("spans"))
    sizes = F.transform(g, F.size)
    all_two = F.forall(sizes, lambda n: n == 2)
    twos = F.filter(g, lambda x: F.size(x) == 2)
    retained = F.struct(F.lit("form1").alias("form"), F.array().cast("array<string>").alias("need"), F.concat_ws("-", at(1, 0), at(1, 1)).alias("spans"))
    return (
        F.when((kind == "SE") & (F.size(g) == 2) & all_two, F.array(form("form1", F.concat_ws("-", at(0, 0), at(0, 1)), F.concat_ws("-", at(1, 0), at(1, 1))), form("form2", F.concat_ws("-", at(0, 0), at(1, 1)))))
        .when(kind.isin("A3", "A5") & (F.size(g) == 2) & all_two, F.array(form("form1", nth(0)), form("form2", nth(1))))
        .when((kind == "RI") & (F.size(g) == 3) & (F.get(sizes, F.lit(1)) == 2), F.array(retained, form("form2", F.concat_ws("-", at(1, 0), at(1, 1)))))
        .when((kind == "MX") & (F.size(g) == 4) & all_two, F.array(form("form1", nth(0), nth(1)), form("form2", nth(2), nth(3))))
        .when(kind.isin("AF", "AL") & (F.size(g) == 4) & (F.size(twos) == 2), F.array(form("form1", pair(F.get(twos, F.lit(0)))), form("form2", pair(F.get(twos, F.lit(1))))))
    )


def edited_exons() -> Column:
    """The template's exons with the event's included form built in, in genome
    order; null where the event doesn't say how."""
    g, kind = F.col("groups"), F.col("event_type")
    ex = F.array_sort(F.transform("exons", lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e"))))
    at = lambda i, j: F.get(F.get(g, F.lit(i)), F.lit(j))
    block = lambda s, e: F.array(F.struct(s.cast("bigint").alias("s"), e.cast("bigint").alias("e")))
    tidy = lambda x: F.array_sort(F.array_distinct(x))
    skipped = tidy(F.concat(F.filter(ex, lambda b: (b["e"] <= at(0, 0)) | (b["s"] >= at(1, 1))), block(at(0, 1), at(1, 0))))
    kept = tidy(F.concat(F.filter(ex, lambda b: (b["e"] < at(0, 0)) | (b["s"] > at(2, 0))), block(at(0, 0), at(2, 0))))
    one, two = F.get(g, F.lit(0)), F.get(g, F.lit(1))
    shared = F.array_intersect(one, two)
    alts = F.array_sort(F.array_except(F.array_union(one, two), shared))
    starts, ends = F.arrays_overlap(alts, F.transform(ex, lambda b: b["s"])), F.arrays_overlap(alts, F.transform(ex, lambda b: b["e"]))
    moved = F.transform(ex, lambda b: F.struct(F.when(starts & F.array_contains(alts, b["s"]), F.array_min(alts)).otherwise(b["s"]).alias("s"), F.when(ends & F.array_contains(alts, b["e"]), F.array_max(alts)).otherwise(b["e"]).alias("e")))
    clear = (F.size(shared) == 1) & (F.size(alts) == 2) & (starts != ends)
    return F.when((kind == "SE") & (F.size(g) == 2), skipped).when((kind == "RI") & (F.size(g) == 3), kept).when(kind.isin("A3", "A5") & (F.size(g) == 2) & clear, tidy(moved))


def _event_locus() -> Column:
    return F.concat("event_chrom", F.lit(":["), F.array_join(F.transform(F.get("groups", F.lit(0)), lambda x: x.cast("string")), ", "), F.lit("]"))


def splicing(events: DataFrame, transcripts: DataFrame, sequences: DataFrame, construct: bool = True, per_form: int = 2, chunks: DataFrame | None = None) -> DataFrame:
    """Isoforms of events (variant_id, event_id, event_type, gene_id, chrom,
    strand, groups, source, confidence): annotated transcripts that hold all
    junctions of a form, the best two of each; else, from ``chunks`` of the
    genome, the representative transcript with the event built in."""
    from ..sources.reference import sized, transcript_sequences

    own = events.select("variant_id", "event_id", "event_type", F.col("gene_id").alias("event_gene"), F.col("chrom").alias("event_chrom"), "groups", "source", "confidence")
    readable = own.withColumn("forms", event_forms()).where("forms IS NOT NULL")
    coding = transcripts.where("is_coding")
    a = aliases(coding)
    tier = a.groupBy("alias").agg(F.min("tier").alias("tier"))
    of_gene = a.join(tier, ["alias", "tier"]).select(F.col("alias").alias("event_gene"), "tx_id")
    tried = readable.select("*", F.explode("forms").alias("f")).join(of_gene, "event_gene").join(coding, "tx_id")
    low, high = F.substring_index("f.spans", "-", 1).cast("bigint"), F.substring_index("f.spans", "-", -1).cast("bigint")
    fits = F.when(F.col("f.spans").isNotNull(), F.exists("exons", lambda b: (b["s"] <= low) & (b["e"] >= high))).otherwise(F.size(F.array_except("f.need", S.junctions(F.col("exons")))) == 0)
    hits = tried.where(fits).withColumn("form", F.col("f.form"))
    tagged = lambda name: ~F.exists("tags", lambda t: t.startswith(name))
    top = R.top_rows(hits, ["variant_id", "form"], [tagged("MANE_Select"), tagged("Ensembl_canonical"), -F.col("cds_len"), F.col("tx_id")], per_form)
    read = top.join(sequences, "tx_id").withColumn("off", F.coalesce("cds_off", S.first_atg_offset("tx_seq"))).where("off IS NOT NULL")
    read = read.withColumn("t", S.translate_orf(F.substring("tx_seq", (F.col("off") + 1).cast("int"), F.length("tx_seq")), is_mito("chrom"), S.sec_codons(F.col("exons"), F.col("strand"), F.col("sec_sites"), F.col("off")))).where("t.protein <> ''")
    known = records(
        read, seq_id=F.concat_ws("_", "event_gene", "event_type", "form", "tx_id"), sequence=F.col("t.protein"), variant_class=F.concat(F.lit("AS_"), "event_type"), consequence=F.concat("event_type", F.lit("_"), "form", F.lit("_annotated_isoform")),
        gene=F.coalesce("gene_name", "event_gene"), transcript=F.col("tx_id"), protein_change=F.lit(""), ref_protein_len=F.length("t.protein"), locus=_event_locus(),
        notes=F.concat(note((F.col("cds_off").isNull(), "start_codon_inferred_first_ATG"), (~F.col("t.stop_found"), "orf_runs_to_transcript_end"), (F.col("t.ambiguous_codons") > 0, "ambiguous_bases_translated_as_X"), (F.col("t.selenocysteines") > 0, F.concat(F.lit("selenoprotein_"), F.col("t.selenocysteines").cast("string"), F.lit("_Sec")))), F.array(F.concat(F.lit("form="), "form"), F.lit("matched_annotated_transcript"))),
    )
    if not construct or chunks is None:
        return known
    # an event is matched by its junctions, whether or not a protein came of it
    unmatched = readable.join(hits.select("variant_id").distinct(), "variant_id", "left_anti")
    template = representative(coding).withColumnRenamed("alias", "event_gene")
    edited = unmatched.join(template, "event_gene").join(coding, "tx_id").withColumn("built", edited_exons()).where("built IS NOT NULL AND size(built) > 0")
    synth = edited.select(F.concat_ws("|", "variant_id", "tx_id").alias("tx_id"), F.col("tx_id").alias("template"), "gene_id", "gene_name", "chrom", "strand", F.when(F.col("strand") == "-", F.reverse("built")).otherwise(F.col("built")).alias("exons"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("cds"), F.lit(0).alias("phase"), "variant_id", "event_gene", "event_type", "event_chrom", "groups", "source", "confidence")
    made = sized(synth).join(transcript_sequences(synth, chunks), "tx_id").withColumn("off", S.first_atg_offset("tx_seq")).where("off IS NOT NULL")
    made = made.withColumn("t", S.translate_orf(F.substring("tx_seq", F.col("off") + 1, F.length("tx_seq")))).where("t.protein <> ''")
    return known.unionByName(records(
        made, seq_id=F.concat_ws("_", "event_gene", "event_type", F.lit("constructed"), "template"), sequence=F.col("t.protein"), variant_class=F.concat(F.lit("AS_"), "event_type"), consequence=F.concat("event_type", F.lit("_constructed_isoform")),
        gene=F.coalesce("gene_name", "event_gene"), transcript=F.concat("template", F.lit("_"), "event_type", F.lit("synth")), protein_change=F.lit(""), locus=_event_locus(),
        notes=F.concat(F.array(F.lit("constructed_isoform"), F.lit("start_codon_inferred_first_ATG")), note((~F.col("t.stop_found"), "orf_runs_to_transcript_end"))),
    ))


# ------------------------------------------------------------------ fusions


def fusions(pairs: DataFrame, transcripts: DataFrame, sequences: DataFrame, both_orders: bool = True, least_nt: int = 30) -> DataFrame:
    """Chimeras of pairs (variant_id, gene1, chrom1, pos1, gene2, chrom2, pos2,
    source, confidence), each gene five-prime once."""
    side = lambda i: F.struct(F.col(f"gene{i}").alias("gene"), F.col(f"chrom{i}").alias("chrom"), F.col(f"pos{i}").alias("pos"))
    orders = [F.struct(side(1).alias("five"), side(2).alias("three"))] + ([F.struct(side(2).alias("five"), side(1).alias("three"))] if both_orders else [])
    turned = pairs.select("variant_id", "source", "confidence", F.posexplode(F.array(*orders)).alias("order", "o"))
    coding = transcripts.where("is_coding")
    partners = turned.select(F.explode(F.array("o.five", "o.three")).alias("p")).select("p.*").distinct()
    near = partners.join(R.merged(aliases(coding)), F.col("gene") == F.col("alias")).join(R.merged(coding.select("tx_id", "tags", "cds_len", "tx_len", "start", "end", F.col("chrom").alias("tx_chrom"))), "tx_id")
    same = bare_contig(F.col("chrom")) == bare_contig(F.col("tx_chrom"))
    at = same & F.col("pos").between(F.col("start"), F.col("end"))
    # best tier first within a place, so a locus hit of a name beats another gene's id elsewhere
    best = R.first_wins(near.withColumn("far", ~at), ["gene", "chrom", "pos"], [F.col("far"), F.col("tier"), *ranking()]).where(same)
    tx = best.select("gene", F.col("chrom").alias("at_chrom"), "pos", "tx_id").join(R.merged(transcripts.select("tx_id", "exons", "strand", "cds_off")), "tx_id").join(R.merged(sequences), "tx_id")
    named = lambda n: F.struct(*(F.col(c) for c in ("gene", "at_chrom", "pos", "tx_id", "exons", "strand", "cds_off", "tx_seq"))).alias(n)
    five, three = tx.select(F.struct("gene", F.col("at_chrom").alias("chrom"), "pos").alias("k5"), named("f")), tx.select(F.struct("gene", F.col("at_chrom").alias("chrom"), "pos").alias("k3"), named("t"))
    j = turned.join(R.merged(five), F.col("o.five") == F.col("k5")).join(R.merged(three), F.col("o.three") == F.col("k3"))
    n5 = S.bases_upto(F.col("f.exons"), F.col("f.strand"), F.col("f.pos"))
    n3 = S.bases_before(F.col("t.exons"), F.col("t.strand"), F.col("t.pos"))
    j = j.withColumn("n5", n5).withColumn("n3", n3).withColumn("head", F.substring("f.tx_seq", F.lit(1), F.col("n5").cast("int"))).withColumn("tail", F.substring("t.tx_seq", (F.col("n3") + 1).cast("int"), F.length("t.tx_seq")))
    j = j.where((F.col("f.cds_off") < F.length("head")))
    j = j.withColumn("x", S.translate_orf(F.substring(F.concat("head", "tail"), (F.col("f.cds_off") + 1).cast("int"), F.length("head") + F.length("tail")))).where("x.protein <> ''")
    coding_nt = F.length("head") - F.col("f.cds_off")
    at_aa = F.floor(coding_nt / 3) + 1
    k = F.col("n3") - F.col("t.cds_off")
    native = F.when(k >= 0, coding_nt % 3 == k % 3)
    in_frame = (coding_nt % 3 == 0) & F.coalesce(native, F.lit(False))
    exonic = lambda side: S.genomic_to_tx(F.col(f"{side}.exons"), F.col(f"{side}.strand"), F.col(f"{side}.pos")).isNotNull()
    place = lambda side: F.concat_ws(":", F.col(f"{side}.at_chrom"), F.col(f"{side}.pos").cast("string"))
    return records(
        j, seq_id=F.concat_ws("_", F.concat("f.gene", F.lit("--"), "t.gene"), F.concat("f.tx_id", F.lit("--"), "t.tx_id"), "f.at_chrom", F.col("f.pos").cast("string"), "t.at_chrom", F.col("t.pos").cast("string")), sequence=F.col("x.protein"), variant_class=F.lit("FUSION"),
        consequence=F.when(in_frame, "in_frame_fusion").otherwise("frameshift_fusion"), gene=F.concat("f.gene", F.lit("--"), "t.gene"), transcript=F.concat("f.tx_id", F.lit("--"), "t.tx_id"), protein_change=F.concat(F.lit("p.junction@"), at_aa.cast("string")), variant_pos_aa=at_aa,
        locus=F.concat(place("f"), F.lit("::"), place("t")), novel_start=F.when(F.length("x.protein") >= at_aa, at_aa), novel_end=F.when(F.length("x.protein") >= at_aa, F.length("x.protein")),
        notes=note(
            (~exonic("f"), "bp5_intronic_snapped_to_exon_end"), (~exonic("t"), "bp3_intronic_snapped_to_exon_start"), ((F.length("head") < least_nt) | (F.length("tail") < least_nt), "short_partner_segment"),
            (coding_nt % 3 == 0, "junction_on_codon_boundary"), (coding_nt % 3 != 0, F.concat(F.lit("junction_mid_codon(offset="), (coding_nt % 3).cast("string"), F.lit(")"))),
            (native, "3p_native_frame"), (~native, "3p_frameshifted"), (k < 0, "bp3_in_5UTR_of_partner"), (~F.col("x.stop_found"), "orf_runs_to_transcript_end"),
        ),
    )


# ------------------------------------------------------------------ circles and non-canonical frames


def circles(events: DataFrame, transcripts: DataFrame, chunks: DataFrame, min_aa: int = 30, require_atg: bool = True, cycles: int = 3, per_event: int = 1) -> DataFrame:
    """Open frames over the back-splice of circles (variant_id, chrom, start,
    end, strand, gene, source, confidence): the host with most exons that gives
    one is used."""
    from ..sources.reference import transcript_sequences

    own = events.select("variant_id", F.col("chrom").alias("circ_chrom"), F.col("start").alias("lo"), F.col("end").alias("hi"), F.col("gene").alias("circ_gene"), "source", "confidence")
    by_name = own.where("circ_gene <> ''").join(R.merged(aliases(transcripts)), F.col("circ_gene") == F.col("alias"))
    best = by_name.groupBy("variant_id").agg(F.min("tier").alias("tier"))
    by_name = by_name.join(R.merged(best), ["variant_id", "tier"]).select("variant_id", "tx_id")
    rest = own.join(R.merged(by_name.select("variant_id").distinct()), "variant_id", "left_anti").withColumn("contig", bare_contig(F.col("circ_chrom")))
    slim = transcripts.where("is_coding").select("tx_id", "start", "end", bare_contig(F.col("chrom")).alias("tx_contig"))
    by_place = R.interval_join(rest, slim, "lo", "start", "end", [("contig", "tx_contig")]).select("variant_id", "tx_id")
    hosts = own.join(R.merged(by_name.union(by_place).distinct()), "variant_id").join(R.merged(transcripts), "tx_id").where(bare_contig(F.col("chrom")) == bare_contig(F.col("circ_chrom")))
    inside = hosts.withColumn("n_all", F.size("exons")).withColumn("exons", F.filter("exons", lambda b: (b["s"] >= F.col("lo")) & (b["e"] <= F.col("hi")))).where("size(exons) > 0").withColumn("host", F.col("tx_id")).withColumn("tx_id", F.concat_ws("|", "variant_id", "tx_id"))
    seqs = inside.join(R.merged(transcript_sequences(inside, chunks)), "tx_id").where(F.length("tx_seq") >= 3)
    period = F.length("tx_seq")
    turned = with_frames(seqs.withColumn("turns", F.repeat(F.col("tx_seq"), F.lit(cycles))), "turns", "o", min_aa, require_atg).drop("turns")
    found = turned.withColumn("o", F.filter("o", lambda o: F.floor((o["nt_end"] - 1) / period) > F.floor(o["nt_start"] / period))).where("size(o) > 0")
    first = R.first_wins(found, ["variant_id"], [-F.col("n_all"), F.col("host")])
    each = first.select("*", F.explode(F.slice("o", F.lit(1), F.lit(per_event))).alias("x"))
    at = F.greatest(F.lit(1), F.floor((period - F.col("x.nt_start")) / 3) + 1)
    turns = F.floor((F.col("x.nt_end") - 1) / period) - F.floor(F.col("x.nt_start") / period)
    gene = F.coalesce(F.nullif("circ_gene", F.lit("")), "gene_name")
    return records(
        each, seq_id=F.concat_ws("_", F.lit("CIRC"), gene, "host", "circ_chrom", F.col("lo").cast("string"), F.col("hi").cast("string")), sequence=F.col("x.protein"), variant_class=F.lit("CIRCRNA"), consequence=F.lit("circrna_backsplice_orf"), gene=gene, transcript=F.col("host"),
        protein_change=F.concat(F.lit("p.bsj@"), at.cast("string")), variant_pos_aa=at, locus=F.concat("circ_chrom", F.lit(":"), F.col("lo").cast("string"), F.lit("-"), F.col("hi").cast("string")), novel_start=at, novel_end=F.length("x.protein"),
        notes=F.concat(F.array(F.concat(F.lit("frame"), F.col("x.frame").cast("string")), F.concat(F.lit("translation_cycles_"), turns.cast("string")), F.lit("crosses_backsplice_junction")), F.array(*([] if require_atg else [F.lit("no_atg_start")])).cast("array<string>")),
    )


# Words of biotypes and the class they stand for, in order; and biotypes of RNAs that are not read.
BIOTYPE_WORDS = {"pseudogene": "NC_PSEUDOGENE", "lncrna": "NC_LNCRNA", "lincrna": "NC_LNCRNA", "antisense": "NC_LNCRNA", "processed_transcript": "NC_LNCRNA", "retained_intron": "NC_LNCRNA"}
UNREAD_BIOTYPES = ("mirna", "snrna", "snorna", "rrna", "trna", "misc_rna", "scarna", "srna", "vault_rna", "ribozyme")


def biotype_class(biotype: Column) -> Column:
    """A non-coding biotype's class; null for none, coding and unread ones."""
    b = F.lower(F.trim(F.coalesce(biotype, F.lit(""))))
    out = F.lit("NC_ALTORF")
    for word, kind in reversed(BIOTYPE_WORDS.items()):
        out = F.when(b.contains(word), kind).otherwise(out)
    return F.when(~b.isin("", "protein_coding") & ~b.rlike("|".join(UNREAD_BIOTYPES)), out)


def noncanonical(transcripts: DataFrame, sequences: DataFrame, known: DataFrame, min_aa: int = 30, require_atg: bool = True, per_transcript: int = 1) -> DataFrame:
    """Open frames of non-coding transcripts and of the untranslated regions of
    coding ones, but for those equal to a known (sequence) protein."""
    readable = F.col("is_coding") | biotype_class(F.col("tx_biotype")).isNotNull()
    seq = transcripts.where(readable).join(R.merged(sequences), "tx_id")
    cds_len = 3 * F.length(S.protein_of(F.substring("tx_seq", (F.col("cds_off") + 1).cast("int"), F.length("tx_seq")))) + 3
    part = lambda name, text, off: F.struct(F.lit(name).alias("region"), text.alias("nt"), off.cast("bigint").alias("off"))
    whole = F.array(part("transcript", F.col("tx_seq"), F.lit(0)))
    end = F.col("cds_off") + cds_len
    utrs = F.array(part("utr5", F.substring("tx_seq", F.lit(1), F.col("cds_off").cast("int")), F.lit(0)), part("utr3", F.substring("tx_seq", (end + 1).cast("int"), F.length("tx_seq")), end))
    regions = seq.select("*", F.explode(F.when(F.col("is_coding"), utrs).otherwise(whole)).alias("g")).withColumn("nt", F.col("g.nt"))
    orfs = with_frames(regions, "nt", "frames", min_aa, require_atg).select("*", F.explode(F.slice("frames", F.lit(1), F.lit(per_transcript))).alias("o"))
    fresh = orfs.join(R.merged(known.select(F.col("sequence").alias("p")).distinct()), F.col("o.protein") == F.col("p"), "left_anti")
    kind = F.when(F.col("g.region") == "transcript", biotype_class(F.col("tx_biotype"))).otherwise("NC_UTR")
    return records(
        fresh, variant_id=F.lit(None), seq_id=F.concat_ws("_", kind, "tx_id", "g.region", F.col("o.nt_start").cast("string")), sequence=F.col("o.protein"), variant_class=kind, consequence=F.lit("noncanonical_orf"), gene=F.coalesce("gene_name", "gene_id"), transcript=F.col("tx_id"),
        locus=F.concat_ws(":", "chrom", F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string"))), source=F.lit("annotation"), novel_start=F.lit(1), novel_end=F.length("o.protein"),
        notes=F.concat(F.array(F.concat(F.lit("frame"), F.col("o.frame").cast("string")), F.concat(F.lit("region="), "g.region")), note((~F.col("o.started_at_atg"), "no_atg_start"), (~F.col("o.stop_found"), "orf_runs_to_transcript_end"))),
    )


def sec_termination(transcripts: DataFrame, sequences: DataFrame, min_aa: int = 8) -> DataFrame:
    """Selenoproteins read with their Sec codon as a stop."""
    t = transcripts.where("is_coding AND size(sec_sites) > 0 AND cds_off IS NOT NULL").join(R.merged(sequences), "tx_id").withColumn("sec", S.sec_codons(F.col("exons"), F.col("strand"), F.col("sec_sites"), F.col("cds_off")))
    nt, mito = F.substring("tx_seq", (F.col("cds_off") + 1).cast("int"), F.length("tx_seq")), is_mito("chrom")
    read = t.select("*", S.protein_of(nt, mito).alias("short"), S.protein_of(nt, mito, F.col("sec")).alias("full"))
    kept = read.where((F.length("short") >= min_aa) & (F.col("short") != F.col("full")))
    n = F.length("short")
    return records(
        kept, variant_id=F.lit(None), seq_id=F.concat_ws("_", F.lit("SECT"), F.coalesce("gene_name", "gene_id"), "tx_id"), sequence=F.col("short"), variant_class=F.lit("SEC_TERMINATION"), consequence=F.lit("selenocysteine_termination"), gene=F.coalesce("gene_name", "gene_id"), transcript=F.col("tx_id"),
        protein_change=F.concat(F.lit("p.U"), (n + 1).cast("string"), F.lit("*")), variant_pos_aa=n, ref_protein_len=F.length("full"), locus=F.concat("chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string")), source=F.lit("reference_annotation"), novel_start=n, novel_end=n, ref_protein=F.col("full"),
        notes=F.array(F.lit("selenocysteine_termination"), F.concat(F.lit("readthrough_length_"), F.length("full").cast("string"))),
    )


# ------------------------------------------------------------------ combinations


def combinations(variants: DataFrame, transcripts: DataFrame, sequences: DataFrame, most: int = 8, missed: int = 2, need_peptide: bool = True, allow_unphased: bool = True) -> DataFrame:
    """One protein per haplotype with two or more variants (variant_id, chrom,
    pos, ref, alt, variant_class, source, phase_set, haplotypes) on it.  Kept
    are forms with a peptide that no single variant and no reference gives."""
    use_checkpoints(variants.sparkSession)
    slim = transcripts.where("is_coding AND cds_off IS NOT NULL")
    by_place = R.interval_join(variants.withColumn("contig", bare_contig(F.col("chrom"))), slim.select("tx_id", "start", "end", "exons", "strand", bare_contig(F.col("chrom")).alias("tx_contig")), "pos", "start", "end", [("contig", "tx_contig")])
    # met by each way of grouping
    placed = by_place.withColumn("p", placement()).where("p IS NOT NULL").drop("exons", "start", "end", "tx_contig", "contig", "strand").checkpoint()
    locus = F.concat("chrom", F.lit(":"), F.col("pos").cast("string"), "ref", F.lit(">"), "alt")
    member = F.struct("chrom", "pos", locus.alias("locus"), "variant_class", "source", F.col("p.start").alias("start"), F.col("p.len").alias("len"), F.col("p.allele").alias("allele"))
    known = (F.col("phase_set") != "") & (F.size("haplotypes") > 0)
    loose = placed.groupBy("tx_id").agg(F.count("*").alias("n"), F.count_if(~known).alias("n_loose"), F.count_distinct(F.when(known, F.col("phase_set"))).alias("blocks"))
    phased = placed.where(known).select("tx_id", "phase_set", F.explode("haplotypes").alias("h"), member.alias("m")).groupBy("tx_id", F.concat_ws("|", "phase_set", F.col("h").cast("string")).alias("label")).agg(F.array_sort(F.collect_list("m")).alias("ms")).withColumn("phased", F.lit(True))
    groups = phased
    if allow_unphased:
        undecided = loose.where("n > 1 AND (n_loose > 0 OR blocks > 1 OR blocks = 0)").select("tx_id")
        groups = phased.unionByName(placed.join(R.merged(undecided), "tx_id", "left_semi").groupBy("tx_id").agg(F.array_sort(F.collect_list(member)).alias("ms")).select("tx_id", F.lit("unphased").alias("label"), "ms", F.lit(False).alias("phased")))
    sized_ = groups.where((F.size("ms") > 1) & (F.size("ms") <= most))
    tx = sized_.join(R.merged(slim), "tx_id").join(R.merged(sequences), "tx_id").withColumn("mito", is_mito("chrom"))

    def read(ms: Column) -> Column:
        seq = S.splice_all(F.col("tx_seq"), ms)
        shift = F.aggregate(F.filter(ms, lambda m: m["start"] < F.col("cds_off")), F.lit(0).cast("bigint"), lambda acc, m: (acc + F.length(m["allele"]) - m["len"]).cast("bigint"))
        off = F.col("cds_off") + shift
        at = F.filter(F.transform("sec_sites", lambda g: S.genomic_to_tx(F.col("exons"), F.col("strand"), g)), lambda x: x.isNotNull() & ~F.exists(ms, lambda m: (m["start"] + m["len"] > x) & (m["start"] < x + 3)))
        moved = F.transform(at, lambda x: x - off + F.aggregate(F.filter(ms, lambda m: m["start"] + m["len"] <= x), F.lit(0).cast("bigint"), lambda acc, m: (acc + F.length(m["allele"]) - m["len"]).cast("bigint")))
        sec = F.transform(F.filter(moved, lambda r: (r >= 0) & (r % 3 == 0)), lambda r: F.floor(r / 3).cast("int"))
        return S.protein_of(F.substring(seq, (off + 1).cast("int"), F.length(seq)), F.col("mito"), sec)

    # the combination, the reference and each single form are rows, so that each is read once
    key = ["tx_id", "label"]
    none = F.filter(F.col("ms"), lambda _: F.lit(False))
    each = F.posexplode(F.concat(F.array("ms", none), F.transform("ms", lambda m: F.array(m)))).alias("form", "held")
    forms = tx.select(*key, "tx_seq", "cds_off", "exons", "strand", "sec_sites", "mito", each).select(*key, "form", read(F.col("held")).alias("p")).checkpoint()
    at = lambda form: F.max(F.when(F.col("form") == form, F.col("p")))
    read_ = forms.groupBy(*key).agg(at(0).alias("combo"), at(1).alias("ref_p")).where("combo <> '' AND combo <> ref_p")
    made = sized_.join(R.merged(slim.select("tx_id", "gene_id", "gene_name")), "tx_id").join(R.merged(read_), key)
    fresh = made
    if need_peptide:
        # peptides meet what the single forms and the reference cover as rows, not inside a lambda that would digest anew for each
        peptides = forms.join(R.merged(read_.select(*key)), key, "left_semi").where("p IS NOT NULL").select(*key, "form", F.explode(P.digest("p", missed)).alias("x")).select(*key, "form", P.fold("x").alias("k"))
        own, covered = peptides.where("form = 0").select(*key, "k"), peptides.where("form > 0").select(*key, "k").distinct()
        fresh = made.join(R.merged(own.join(R.merged(covered), [*key, "k"], "left_anti").select(*key).distinct()), key, "left_semi")
    # the filter comes first: only forms that pass it hide later equal ones
    unique = R.first_wins(fresh, ["tx_id", "combo"], [~F.col("phased"), F.col("label")])
    numbered = R.dense_numbers(unique, [], ["tx_id", "label"], "serial")
    idx = S.first_difference("ref_p", "combo")
    r, c = S.letters(F.col("ref_p")), S.letters(F.col("combo"))
    diffs = F.filter(F.transform(F.arrays_zip(r.alias("r"), c.alias("c")), lambda z, i: F.when(z["r"] != z["c"], F.concat(z["r"], (i + 1).cast("string"), z["c"]))), lambda x: x.isNotNull())
    shown = F.when(F.size(diffs) > 8, F.concat(F.slice(diffs, F.lit(1), F.lit(8)), F.array(F.concat(F.lit("+"), (F.size(diffs) - 8).cast("string"), F.lit("_more"))))).otherwise(diffs)
    at = lambda p: F.substring(p, idx + 1, F.lit(1))
    single = F.when(idx >= F.length("ref_p"), "ext*?").when(idx >= F.length("combo"), F.concat(at(F.col("ref_p")), (idx + 1).cast("string"), F.lit("*"))).otherwise(F.concat(at(F.col("ref_p")), (idx + 1).cast("string"), F.lit("fs")))
    changes = F.when(F.length("ref_p") == F.length("combo"), shown).otherwise(F.array(single))
    classes = F.array_sort(F.array_distinct(F.transform("ms", lambda m: m["variant_class"])))
    return records(
        numbered, variant_id=F.lit(None), seq_id=F.concat(F.lit("COMBO_"), "tx_id", F.lit("_"), F.lpad(F.col("serial").cast("string"), 6, "0")), sequence=F.col("combo"), variant_class=F.lit("COMBO"), consequence=F.lit("combinatorial"), gene=F.coalesce("gene_name", "gene_id"), transcript=F.col("tx_id"),
        protein_change=F.concat(F.lit("p.["), F.when(F.col("phased"), F.array_join(changes, ";")).otherwise(F.array_join(changes, "(;)")), F.lit("]")), variant_pos_aa=idx + 1, ref_protein_len=F.length("ref_p"),
        locus=F.array_join(F.transform("ms", lambda m: m["locus"]), ";"), source=F.array_join(F.array_sort(F.array_distinct(F.transform("ms", lambda m: m["source"]))), ";"), novel_start=idx + 1, novel_end=F.length("combo"), ref_protein=F.col("ref_p"),
        notes=F.concat(F.array(F.lit("combinatorial"), F.when(F.col("phased"), "phased").otherwise("unphased")), note((F.size(classes) > 1, F.concat(F.lit("cross_evidence_"), F.array_join(classes, "+"))))),
    )
