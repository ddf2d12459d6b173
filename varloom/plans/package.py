"""Packaging: protein records become a release of entries and peptides.

Columns are carried, headers are never parsed again, so every header style
packages.  One entry stands for each sequence; its class is the best ranked of
the classes that reach it.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import digestion as D
from ..functions import headers as H
from ..functions import peptides as P
from ..operators import relational as R
from ..session import use_checkpoints
from ..species import KNOWN, Species

# Classes in the order in which one names a sequence that several reach; others rank last.
CLASS_PRIORITY = ("FUSION", "INDEL", "SNV", "MNV", "RNA_EDITING", "AS_SE", "AS_RI", "AS_MX", "AS_A3", "AS_A5", "AS_AF", "AS_AL", "CIRCRNA", "SEC_TERMINATION", "REFERENCE")
UNCHANGED = ("synonymous", "5_prime_UTR", "3_prime_UTR")


def rank_of(variant_class: Column, priority: tuple[str, ...] = CLASS_PRIORITY) -> Column:
    at = F.array_position(F.array(*(F.lit(c) for c in priority)), variant_class)
    return F.when(at > 0, at).otherwise(99)


def low_frequency(least: float | None) -> Column:
    """Whether the manifest states a frequency under the least: an unknown one
    is not a low one."""
    af = F.col("small.af")
    return F.coalesce(af < least, F.lit(False)) if least is not None else F.lit(False)


def dispositions(manifest: DataFrame, records: DataFrame, least_aa: int = 8, keep_unchanged: bool = True, min_af: float | None = None, expressed: DataFrame | None = None, failed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept records, one outcome for each variant).

    Records are tested for expression, length and change in this order; an
    unnamed gene passes.  A variant with a record that is kept is built,
    whatever became of its others; else records that change nothing decide,
    then short ones, then any.  ``failed`` (variant_id, detail) are rows that
    could not be read."""
    slim = manifest.select("variant_id", "variant_class", low_frequency(min_af).alias("low_af"), F.col("small.af").cast("string").alias("af_text"))
    names = None
    if expressed is not None:
        # by the name without its version, so that one join tests a gene under both of its names
        names = expressed.where("gene IS NOT NULL").groupBy(F.substring_index("gene", ".", 1).alias("_g")).agg(F.collect_set("gene").alias("_names"))

    def judged(rows: DataFrame, short: Column) -> DataFrame:
        silent, bare = F.lit(False), F.substring_index("gene", ".", 1)
        if names is not None:
            rows = rows.join(names, bare == F.col("_g"), "left")
            silent = (F.coalesce("gene", F.lit("")) != "") & ~F.coalesce(F.array_contains("_names", F.col("gene")) | F.array_contains("_names", bare), F.lit(False))
        same = F.col("consequence").isin(*UNCHANGED) & F.lit(not keep_unchanged)
        return rows.withColumn("reason", F.when(silent, "not_expressed").when(short, "too_short").when(same, "unchanged"))

    # an outer join, so that the test is not pushed into the plan that makes the sequences
    tested = judged(records.join(slim.select("variant_id", "low_af"), "variant_id", "left"), F.length("sequence") < least_aa)
    kept = tested.where("reason IS NULL AND NOT coalesce(low_af, false)").select(records.columns)
    # outcomes need no sequences, and a variant's frequency is met once its records are summed
    own = [c for c in ("variant_id", "gene", "consequence") if c in records.columns]
    facts = judged(records.select(*own, (F.length("sequence") < least_aa).alias("_short")), F.col("_short"))
    kinds = lambda c: F.array_sort(F.collect_set(c))
    of = lambda why: F.col("reason") == why
    by = facts.groupBy("variant_id").agg(F.count_if(F.col("reason").isNull()).alias("n_proteins"), F.count_if(of("unchanged")).alias("n_same"), F.count_if(of("too_short")).alias("n_short"), kinds(F.when(of("unchanged"), F.col("consequence"))).alias("same"), kinds("consequence").alias("all"))
    joined = slim.join(by, "variant_id", "left")
    if failed is not None:
        joined = joined.join(failed.groupBy("variant_id").agg(F.min("detail").alias("failure")), "variant_id", "left")
    else:
        joined = joined.withColumn("failure", F.lit(None).cast("string"))
    every, only = F.array_join("all", ";"), F.array_join("same", ";")
    utr = F.size(F.array_except("same", F.array(F.lit("5_prime_UTR"), F.lit("3_prime_UTR")))) == 0
    # each case with what it is called and what is said of it
    cases = [
        (F.col("low_af"), "below_min_af", F.concat(F.lit("af="), "af_text", F.lit(f"<{min_af}"))),
        (F.col("failure").isNotNull(), "error", F.col("failure")),
        (F.col("all").isNull(), "no_protein", F.lit("")),
        (F.col("n_proteins") > 0, "protein_built", every),
        ((F.col("n_same") > 0) & utr, "utr_variant", only),
        ((F.col("n_same") > 0) & (only == "synonymous"), "synonymous_only", F.lit("no residue changes")),
        (F.col("n_same") > 0, "synonymous_or_utr", only),
        (F.col("n_short") > 0, "below_min_length", F.lit(f"<{least_aa} aa")),
    ]
    outcome, detail = F.lit("filtered"), every
    for when, name, said in reversed(cases):
        outcome, detail = F.when(when, name).otherwise(outcome), F.when(when, said).otherwise(detail)
    return kept, joined.select("variant_id", "variant_class", F.when(F.col("low_af"), 0).otherwise(F.coalesce("n_proteins", F.lit(0))).cast("bigint").alias("n_proteins"), outcome.alias("outcome"), F.coalesce(detail, F.lit("")).alias("detail"))


def without_protein(outcomes: DataFrame, variants: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Says why a small variant gave none: no coding transcript there, a
    reference allele that starts in an exon and ends outside of it, or no exon."""
    from ..functions import sequence as S
    from ..sources.reference import bare_contig

    missing = outcomes.where("outcome = 'no_protein'").select("variant_id").join(variants, "variant_id").withColumn("contig", bare_contig(F.col("chrom")))
    slim = transcripts.where("is_coding").select("start", "end", "exons", "strand", bare_contig(F.col("chrom")).alias("tx_contig"))
    over = R.interval_join(missing, slim, "pos", "start", "end", [("contig", "tx_contig")])
    within = lambda n: S.tx_interval(F.col("exons"), F.col("strand"), F.col("pos"), n).isNotNull()
    length = F.length("ref")
    crosses = (length > 1) & within(F.lit(1)) & ~within(length)
    why = over.groupBy("variant_id").agg(F.bool_or(crosses).alias("crosses"), F.count("*").alias("n_near"))
    joined = outcomes.join(missing.select("variant_id", length.alias("span")), "variant_id", "left").join(why, "variant_id", "left")
    small, near = F.col("span").isNotNull(), F.col("n_near").isNotNull()
    outcome = F.when(small & ~near, "no_coding_transcript_at_locus").when(F.col("crosses"), "crosses_splice_junction").when(small, "not_in_coding_exon").otherwise(F.col("outcome"))
    detail = (
        F.when(small & ~near, "no coding transcript spans the position").when(F.col("crosses"), F.concat("span", F.lit(" bases of reference run over the end of an exon")))
        .when(small, F.concat("n_near", F.lit(" coding transcripts span the position, none with an exon there"))).otherwise(F.col("detail"))
    )
    return joined.select("variant_id", "variant_class", "n_proteins", outcome.alias("outcome"), detail.alias("detail"))


def with_reference(kept: DataFrame) -> DataFrame:
    """Each kept variant's transcript adds its unchanged protein once."""
    wild = kept.where("ref_protein IS NOT NULL AND ref_protein <> ''").groupBy("transcript").agg(F.min_by(F.struct("gene", "ref_protein"), "seq_id").alias("x"))
    made = wild.select(F.concat(F.lit("REF_"), "transcript").alias("seq_id"), F.col("x.ref_protein").alias("sequence"), F.lit("REFERENCE").alias("variant_class"), F.lit("reference").alias("consequence"), F.col("x.gene").alias("gene"), "transcript")
    return kept.unionByName(made, allowMissingColumns=True)


def write_order(records: DataFrame) -> DataFrame:
    """Records with serial, unique id and the record that stands for them: of
    equal class and sequence the first stays and the others are merged.

    Records are written once, with a number each; what is sorted, numbered and
    compared then are slim rows without the sequences, which meet the records
    by that number."""
    use_checkpoints(records.sparkSession)
    held = records.where("sequence <> ''").withColumn("digest", F.sha2("sequence", 256)).withColumn("_record", F.monotonically_increasing_id()).checkpoint()
    slim = held.select("_record", "variant_class", "seq_id", "locus", "transcript", "digest")
    numbered = R.dense_numbers(slim, ["variant_class"], ["seq_id", "locus", "transcript", "_record"], "n").select("_record", "variant_class", "seq_id", "digest", F.concat("variant_class", F.lit("_"), F.lpad(F.col("n").cast("string"), 6, "0")).alias("serial"))
    suffixed = R.dense_numbers(numbered, ["seq_id"], ["serial"], "k").withColumn("entry_id", F.when(F.col("k") == 1, F.col("seq_id")).otherwise(F.concat("seq_id", F.lit("_dup"), F.col("k").cast("string"))))
    first = suffixed.groupBy("variant_class", "digest").agg(F.min("serial").alias("kept_serial"))
    named = suffixed.join(first, ["variant_class", "digest"]).select("_record", "serial", "entry_id", "kept_serial")
    return held.join(named, "_record").withColumn("kept", F.col("serial") == F.col("kept_serial")).drop("_record")


def merged_loci(ordered: DataFrame) -> DataFrame:
    """The sidecar: which records were merged into which."""
    kept = ordered.where("kept").select("serial", F.col("locus").alias("kept_locus"), F.col("transcript").alias("kept_transcript"))
    gone = ordered.where("NOT kept").select("kept_serial", "serial", "locus", "transcript", "gene", "consequence", "variant_class")
    return gone.join(kept.withColumnRenamed("serial", "kept_serial"), "kept_serial")


def entries(ordered: DataFrame, priority: tuple[str, ...] = CLASS_PRIORITY) -> DataFrame:
    """One row per sequence: class, id and fields of its first record by rank."""
    best = F.struct(rank_of(F.col("variant_class"), priority).alias("rank"), F.col("serial"))
    fields = F.struct("entry_id", "serial", "variant_class", "consequence", "gene", "transcript", "protein_change", "variant_pos_aa", "locus", "source", "confidence", "nmd", "sequence")
    g = ordered.groupBy("digest").agg(F.min_by(fields, best).alias("f"), F.array_sort(F.collect_set("variant_class")).alias("classes"), F.count("*").alias("n_records"))
    return g.select("digest", "f.*", "classes", F.filter("classes", lambda c: c != F.col("f.variant_class")).alias("also"), "n_records")


ENTRY_FIELDS = ("digest", "entry_id", "variant_class", "gene", "locus", "protein_change", "classes")


def peptide_rows(entry: DataFrame, reference: DataFrame, normal: DataFrame | None = None, missed: int = 2, least: int = 6, most: int = 50, fields: tuple[str, ...] = ENTRY_FIELDS) -> DataFrame:
    """(entry fields, peptide, k, novel, spanning, in_normal): each entry's
    peptides against the reference's keys (k) and the normal tissue's (k).
    Every peptide of an entry without a variant position spans it."""
    rows = D.digested(entry, "sequence", list(fields), missed, least, most, "variant_pos_aa" if "variant_pos_aa" in entry.columns else None)
    rows = rows.withColumn("k", P.fold("peptide"))
    flag = lambda keys, name: keys.select("k").distinct().withColumn(name, F.lit(True))
    out = rows.join(flag(reference, "known"), "k", "left").withColumn("novel", F.col("known").isNull()).drop("known")
    if normal is None:
        return out.withColumn("in_normal", F.lit(False))
    return out.join(flag(normal, "n"), "k", "left").withColumn("in_normal", F.col("n").isNotNull()).drop("n")


def peptide_keys(proteins: DataFrame, seq: str = "sequence", missed: int = 2, least: int = 6, most: int = 50) -> DataFrame:
    """(k): the folded peptides of proteins."""
    return D.digested(proteins, seq, [], missed, least, most).select(P.fold("peptide").alias("k")).distinct()


def without_decay(entry: DataFrame) -> DataFrame:
    """Entries but for those whose transcript is likely to decay.  They go
    before peptides are made, so nothing counts theirs."""
    return entry.where("NOT coalesce(nmd = 'likely', false)")


def annotated(entry: DataFrame, peptides: DataFrame, drop_known: bool = False) -> DataFrame:
    """Entries with their peptide counts and an example, the least of them."""
    fresh = F.col("novel") & F.col("spanning")
    counts = peptides.groupBy("digest").agg(F.count("*").alias("n_peptides"), F.count_if("novel").alias("n_novel"), F.count_if(fresh).alias("n_variant_peptides"), F.count_if(F.col("novel") & ~F.col("in_normal")).alias("n_novel_vs_normal"), F.count_if("in_normal").alias("n_in_normal"), F.count_if(fresh & ~F.col("in_normal")).alias("n_variant_vs_normal"), F.min(F.when(fresh, F.col("peptide"))).alias("example"))
    out = entry.join(counts, "digest", "left").fillna(0, ["n_peptides", "n_novel", "n_variant_peptides", "n_novel_vs_normal", "n_in_normal", "n_variant_vs_normal"])
    return out.where("n_novel > 0 OR variant_class = 'REFERENCE'") if drop_known else out


def first_flags(peptides: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """(k, f, n): what a novel key's first entry says of it, and how many
    entries have it; ``also`` are further fields of that entry."""
    first = F.min_by(F.struct("in_normal", "spanning", *also), F.struct("entry_id", "peptide"))
    ends = (F.min("entry_id") == F.max("entry_id")).alias("single")
    return peptides.where("novel").groupBy("k").agg(first.alias("f"), ends)


def funnel(peptides: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Novel keys, those not in normal tissue, those over a variant, those of
    one entry: one row, or one for each of the fields ``by`` of the first entry."""
    found = first_flags(peptides, by)
    fresh = ~F.col("f.in_normal")
    return found.groupBy(*(F.col(f"f.{c}").alias(c) for c in by)).agg(F.count("*").alias("novel_vs_reference"), F.count_if(fresh).alias("not_in_normal_tissue"), F.count_if(fresh & F.col("f.spanning")).alias("variant_spanning"), F.count_if(fresh & F.col("f.spanning") & F.col("single")).alias("proteotypic"))


def candidate_table(peptides: DataFrame) -> DataFrame:
    """A row for each novel key: its first entry's peptide, gene and place, in
    how many entries it is, and its flags; ordered by gene and peptide."""
    first = F.min_by(F.struct("peptide", "entry_id", "variant_class", "gene", "locus", "protein_change", "spanning", "in_normal"), F.struct("entry_id", "peptide"))
    found = peptides.where("novel").groupBy("k").agg(first.alias("f"), F.count_distinct("entry_id").alias("n_entries"))
    return found.select("f.*", "n_entries", (F.col("n_entries") == 1).alias("proteotypic")).orderBy("gene", "peptide")


def search_space(peptides: DataFrame) -> DataFrame:
    """Distinct new keys of the release and of each class that reaches them; a
    key's classes are gathered before they are counted, so a key is shuffled
    once."""
    keys = peptides.where("novel").groupBy("k").agg(F.array_distinct(F.flatten(F.collect_set("classes"))).alias("classes"))
    return keys.select(F.explode(F.concat(F.array(F.lit("release")), "classes")).alias("class")).groupBy("class").agg(F.count("*").alias("n_added"))


def summary(entry: DataFrame) -> DataFrame:
    share = F.round(100 * F.count_if(F.col("n_novel") > 0) / F.count("*"), 4)
    return entry.groupBy("variant_class").agg(F.count("*").alias("n"), F.count_distinct(F.nullif("gene", F.lit(""))).alias("n_genes"), F.count_if(F.col("n_novel") > 0).alias("n_with_novel"), F.sum("n_novel").alias("n_novel"), F.count_if(F.col("nmd") == "likely").alias("n_nmd"), F.avg(F.length("sequence")).alias("mean_length"), share.alias("pct_with_novel"))


def provenance(ordered: DataFrame, entry: DataFrame) -> DataFrame:
    """One nested row per entry: every record that reached its sequence."""
    one = F.struct("serial", "variant_id", "variant_class", "consequence", "gene", "transcript", "protein_change", "locus", "source")
    rows = ordered.groupBy("digest").agg(F.array_sort(F.collect_list(one)).alias("variants"))
    return entry.select("digest", "entry_id", F.length("sequence").alias("length")).join(rows, "digest")


DECOY = "DECOY_"
DECOYS = {"none": None, "reverse": P.reverse_decoy, "pseudo_reverse": P.pseudo_reverse_decoy, "shuffle": "shuffle"}


def decoys(entry: DataFrame, method: str = "pseudo_reverse", prefix: str = DECOY) -> DataFrame:
    """One decoy for each target; empty for no method."""
    how = DECOYS[method]
    if how is None:
        return entry.limit(0).withColumn("is_decoy", F.lit(True))
    if how == "shuffle":
        from ..functions.decoys import shuffled

        made = shuffled(entry, "sequence").drop("sequence").withColumnRenamed("decoy", "sequence")
    else:
        made = entry.withColumn("sequence", how("sequence"))
    return made.withColumn("entry_id", F.concat(F.lit(prefix), "entry_id")).withColumn("is_decoy", F.lit(True)).select(*entry.columns, "is_decoy")


def split_class(variant_class: Column, entry_id: Column) -> Column:
    return F.when(variant_class.isNotNull() & (variant_class != ""), variant_class).when(entry_id.rlike("^(sp|tr)\\|"), "REFERENCE_PROTEOME").otherwise("UNCLASSIFIED")


def appended_reference(entry: DataFrame, proteome: DataFrame) -> DataFrame:
    """Reference proteins whose sequence no entry has yet."""
    return proteome.join(entry.select("sequence").distinct(), "sequence", "left_anti")


def as_entries(proteins: DataFrame, entry: DataFrame) -> DataFrame:
    """Proteins (header, sequence) of a reference as entries of their own: the
    header stays as it is and names them."""
    own = proteins.select(F.substring_index("header", " ", 1).alias("entry_id"), "header", "sequence")
    kinds = {f.name: f.dataType for f in entry.schema}
    return own.select(*((F.col(c) if c in own.columns else F.lit(None).cast(kinds[c])).alias(c) for c in entry.columns), "header")


def fasta_lines(entry: DataFrame, style: str = "uniprot", width: int = 60, species: Species = KNOWN["human"], normal: bool = False) -> DataFrame:
    """(entry_id, value): header and wrapped sequence of each entry.  An entry
    with a ``header`` keeps it; counts of peptides follow where there are any."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    r = {c: text(c) for c in ("entry_id", "serial", "variant_class", "consequence", "gene", "transcript", "protein_change", "locus", "source", "confidence", "sequence")}
    r["seq_id"] = F.regexp_replace(r["entry_id"], f"^{DECOY}", "") if "is_decoy" in entry.columns else r["entry_id"]
    head = (H.uniprot_of(species) if style == "uniprot" else H.STYLES[style])(r)
    if "n_peptides" in entry.columns:
        counts = {c: text(c) for c in ("n_novel", "n_variant_peptides", "n_peptides", "n_in_normal", "n_novel_vs_normal", "n_variant_vs_normal")}
        head = F.concat(head, H.peptide_counts(counts | {"also": F.array_join("also", ",")}, normal))
    if "is_decoy" in entry.columns:
        head = F.when(F.col("is_decoy"), F.concat(F.lit(DECOY), head, F.lit(" DECOY=1"))).otherwise(head)
    if "header" in entry.columns:
        own = F.when(F.col("is_decoy"), F.concat(F.lit(DECOY), "header", F.lit(" DECOY=1"))).otherwise(F.col("header")) if "is_decoy" in entry.columns else F.col("header")
        head = F.coalesce(own, head)
    return entry.select("entry_id", F.concat(F.lit(">"), head, F.lit("\n"), H.wrapped("sequence", width)).alias("value"))


def write_fasta(entry: DataFrame, path: str, style: str = "uniprot", by_class: bool = False, species: Species = KNOWN["human"], normal: bool = False) -> None:
    """Text parts ordered by id; with ``by_class`` one folder for each class."""
    lines = fasta_lines(entry, style, species=species, normal=normal)
    if by_class:
        kinds = entry.select("entry_id", split_class(F.col("variant_class"), F.col("entry_id")).alias("class"))
        lines.join(kinds, "entry_id").repartitionByRange("class", "entry_id").sortWithinPartitions("class", "entry_id").select("class", "value").write.mode("overwrite").partitionBy("class").text(path)
        return
    if style == "peff":
        # the file's own lines stand before its first entry
        ends = entry.agg(F.min("entry_id").alias("first"), F.count("*").alias("n")).first()
        before = "\n".join(H.peff_file_header(species, ends["n"]))
        lines = lines.withColumn("value", F.when(F.col("entry_id") == F.lit(ends["first"]), F.concat(F.lit(before + "\n"), "value")).otherwise(F.col("value")))
    lines.repartitionByRange("entry_id").sortWithinPartitions("entry_id").select("value").write.mode("overwrite").text(path)


def isoform_lines(transcripts: DataFrame) -> DataFrame:
    """GTF lines of exons and cds blocks."""
    attrs = F.format_string('gene_id "%s"; transcript_id "%s";', "gene_id", "tx_id")
    part = lambda name, col: transcripts.select("tx_id", "chrom", "strand", attrs.alias("a"), F.posexplode(col).alias("i", "b")).select("tx_id", F.lit(name).alias("f"), "i", F.concat_ws("\t", "chrom", F.lit("varloom"), F.lit(name), F.col("b.s").cast("string"), F.col("b.e").cast("string"), F.lit("."), "strand", F.lit("."), "a").alias("value"))
    return part("exon", "exons").unionByName(part("CDS", "cds"))


def record_table(ordered: DataFrame) -> DataFrame:
    """All records, those merged into others, too."""
    kinds = dict(ordered.dtypes)
    return ordered.select(*(F.array_join(c, ";").alias(c) if kinds[c].startswith("array") else F.col(c) for c in ordered.columns if c != "digest"))


def class_index(entry: DataFrame) -> DataFrame:
    """(value): a Markdown table of the class folders."""
    kinds = entry.groupBy(split_class(F.col("variant_class"), F.col("entry_id")).alias("class")).agg(F.count("*").alias("n")).orderBy("class").collect()  # a row for each class
    lines = ["| class | entries |", "|---|---|", *(f"| {x['class']} | {x['n']} |" for x in kinds)]
    return entry.sparkSession.createDataFrame([(x,) for x in lines], "value string").coalesce(1)


def write_release(spark: SparkSession, entry: DataFrame, peptides: DataFrame, ordered: DataFrame, path: str, style: str = "uniprot", decoy: str = "pseudo_reverse", species: Species = KNOWN["human"], split: bool = True, extra: DataFrame | None = None, normal: bool = False, isoforms: DataFrame | None = None, extra_files: tuple[str, ...] = ()) -> None:
    """Tables and FASTA of a release; checksums come last, of what is there.
    ``extra`` are proteins (header, sequence) that are appended to the entries;
    ``isoforms`` are transcripts whose exons are written."""
    every = entry if extra is None else entry.withColumn("header", F.lit(None).cast("string")).unionByName(as_entries(extra, entry))
    flagged = every.withColumn("is_decoy", F.lit(False))
    write_fasta(every, f"{path}/target", style, species=species, normal=normal)
    write_fasta(flagged.unionByName(decoys(every, decoy)), f"{path}/target_decoy", style, species=species, normal=normal)
    if split:
        write_fasta(every, f"{path}/by_class", style, by_class=True, species=species, normal=normal)
        class_index(every).write.mode("overwrite").text(f"{path}/by_class_index")
    flat = entry.withColumn("classes", F.array_join("classes", ";")).withColumn("also", F.array_join("also", ";"))
    tables = {
        "entries": flat, "search_space": search_space(peptides), "summary_by_class": summary(entry), "merged_loci": merged_loci(ordered), "peptides": peptides.withColumn("classes", F.array_join("classes", ";")),
        "peptide_candidates": candidate_table(peptides), "candidate_funnel": funnel(peptides), "records": record_table(ordered),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").option("sep", "\t").option("header", True).csv(f"{path}/{name}")
    provenance(ordered, entry).write.mode("overwrite").json(f"{path}/provenance")
    if isoforms is not None:
        isoform_lines(isoforms).orderBy("tx_id", F.desc("f"), "i").select("value").write.mode("overwrite").text(f"{path}/isoforms")
    for name in extra_files:
        copied(spark, name, f"{path}/extra")
    checksums(spark, path).write.mode("overwrite").option("sep", "\t").csv(f"{path}/MANIFEST")


def copied(spark: SparkSession, name: str, folder: str) -> None:
    """A file's bytes under its own name in a folder, by the file systems'
    streams: from any store to any other, and as they are."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(name), jvm.org.apache.hadoop.fs.Path(f"{folder}/{name.rsplit('/', 1)[-1]}")
    jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, True, conf)


#: Bytes up to which a task holds a file to hash it; larger ones are streamed.
MOST_HELD = 128 << 20


def checksums(spark: SparkSession, path: str, most: int = MOST_HELD) -> DataFrame:
    """(sha256, file, bytes) of what a release holds, hashed in tasks, a file
    each; files beyond ``most`` bytes are read as streams.  A file that can't be
    read has no sha256."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    walk = fs.listFiles(fs_path, True)  # a release has some hundred files
    while walk.hasNext():
        f = walk.next()
        name, last = f.getPath().toString(), f.getPath().getName()
        if (last.startswith("part-") or "/extra/" in name) and not last.endswith(".crc") and "/MANIFEST/" not in name:
            found.append((name, f.getLen()))
    key = lambda name: "/".join(name.rsplit("/", 2)[1:])
    listed = spark.createDataFrame([(key(name), size, _digest(fs, spark._jvm, name) if size > most else None) for name, size in found], "file string, bytes bigint, streamed string")
    held = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).load(path).where(F.col("length") <= most)
    hashed = held.select(F.array_join(F.slice(F.split("path", "/"), F.lit(-2), F.lit(2)), "/").alias("file"), F.sha2("content", 256).alias("held"))
    # a file without bytes has no split that a task could read
    return listed.join(hashed, "file", "left").select(F.coalesce("streamed", "held", F.when(F.col("bytes") == 0, F.sha2(F.lit(b""), 256))).alias("sha256"), "file", "bytes")


def _digest(fs, jvm, name: str) -> str | None:
    """A file's SHA-256 from a stream in the driver's JVM: one buffer is held."""
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(name))
    try:
        return jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    except Py4JJavaError:  # what is damaged has no digest, and the check of digests says so
        return None
    finally:
        stream.close()
