"""Release checks as queries: each returns rows (check_name, severity, message)
for what it found, none for a clean release."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import relational as R


def violation(df: DataFrame, check: str, text: str, key: str, severity: str = "error") -> DataFrame:
    """One row for all of ``df``, with a count and the first few keys."""
    found = df.agg(F.count("*").alias("n"), F.min(F.col(key).cast("string")).alias("low"), F.max(F.col(key).cast("string")).alias("high")).where("n > 0")
    return found.select(F.lit(check).alias("check_name"), F.lit(severity).alias("severity"), F.concat(F.col("n").cast("string"), F.lit(f" {text}: "), "low", F.when(F.col("n") > 1, F.concat(F.lit(" ... "), "high")).otherwise("")).alias("message"))


def i1_partition(whole: DataFrame, parts: DataFrame) -> DataFrame:
    """Entries by class are all entries, each in one class."""
    missing = violation(whole.join(parts, "entry_id", "left_anti"), "I1", "entries in no class file", "entry_id")
    extra = violation(parts.join(whole, "entry_id", "left_anti"), "I1", "entries of class files only", "entry_id")
    several = violation(parts.groupBy("entry_id").agg(F.count_distinct("class").alias("c")).where("c > 1"), "I1", "entries in several class files", "entry_id")
    return missing.union(extra).union(several)


def i2_disposition(manifest: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Every input has one outcome."""
    lost = violation(manifest.join(outcomes, "variant_id", "left_anti"), "I2", "inputs without outcome", "variant_id")
    alien = violation(outcomes.join(manifest, "variant_id", "left_anti"), "I2", "outcomes without input", "variant_id")
    twice = violation(outcomes.groupBy("variant_id").count().where("count > 1"), "I2", "inputs with several outcomes", "variant_id")
    return lost.union(alien).union(twice)


def bucket(variant_class: Column, entry_id: Column) -> Column:
    return F.when(entry_id.rlike("^(sp|tr)\\|"), "reference").when(variant_class == "REFERENCE", "wildtype").otherwise("variant")


def i3_counts(entry: DataFrame, stated: dict[str, int]) -> DataFrame:
    """Counts by kind are those stated and add up."""
    counts = entry.agg(*(F.count_if(bucket(F.col("variant_class"), F.col("entry_id")) == k).alias(k) for k in ("variant", "wildtype", "reference")), F.count("*").alias("total"))
    wrong = reduce(lambda a, b: a | b, [F.col(k) != v for k, v in stated.items()], F.lit(False)) | (F.col("variant") + F.col("wildtype") + F.col("reference") != F.col("total"))
    return violation(counts.where(wrong), "I3", "count tables differ, total", "total")


def i4_unique(entry: DataFrame) -> DataFrame:
    return violation(entry.groupBy("entry_id").count().where("count > 1"), "I4", "ids used more than once", "entry_id")


def i5_layout(fasta: DataFrame, width: int = 60) -> DataFrame:
    """All lines of a sequence but its last are ``width`` long."""
    body = F.slice("line_lengths", F.lit(1), F.greatest(F.lit(0), F.size("line_lengths") - 1))
    bad = F.exists(body, lambda n: n != width) | (F.element_at("line_lengths", -1) > width)
    return violation(fasta.where(F.size("line_lengths") > 0).where(bad), "I5", "entries with another line layout", "header")


def i6_agreement(compared: DataFrame, least: float = 0.9) -> DataFrame:
    """Translations agree with the annotation's; nothing compared is a warning."""
    rate = compared.agg(F.count("*").alias("n"), F.count_if("same").alias("k")).withColumn("rate", F.col("k") / F.nullif("n", F.lit(0)))
    return violation(rate.where(F.col("rate") < least), "I6", "agreement rates under the least", "rate").union(violation(rate.where("n = 0"), "I6", "comparisons without rows", "n", "warning"))


def i7_unchanged(records: DataFrame) -> DataFrame:
    """No record that changes a sequence equals its own reference."""
    same = records.where("ref_protein IS NOT NULL AND sequence = ref_protein AND consequence NOT IN ('synonymous', '5_prime_UTR', '3_prime_UTR', 'reference')")
    return violation(same, "I7", "changed entries equal to their reference", "seq_id", "warning")


def i8_checksums(listed: DataFrame, present: DataFrame) -> DataFrame:
    a, b = listed.select("file", F.col("sha256").alias("want")), present.select("file", "sha256", F.lit(True).alias("there"))
    both = a.join(b, "file", "full")
    made = lambda cond, text: violation(both.where(cond), "I8", text, "file")
    return made("there IS NULL", "listed files missing").union(made("want IS NULL", "files not listed")).union(made("want <> sha256", "files changed")).union(made("there AND sha256 IS NULL", "files that can't be read"))


def i9_decoys(entry: DataFrame) -> DataFrame:
    """As many decoys as targets; by a column, not by a name's prefix."""
    n = entry.agg(F.count_if("is_decoy").alias("decoys"), F.count_if(~F.col("is_decoy")).alias("targets"))
    return violation(n.where("decoys <> targets AND decoys > 0"), "I9", "decoy counts unlike the targets'", "decoys")


CHECKS = ("I1", "I2", "I3", "I4", "I5", "I6", "I7", "I8", "I9")


def state_of(found: list[Row]) -> str:
    """ok, or FAIL or warn with what was found."""
    state = "FAIL" if any(r["severity"] == "error" for r in found) else "warn" if found else "ok"
    return f"{state} {'; '.join(r['message'] for r in found)}".strip()


def run_checks(made: dict[str, Callable[[], DataFrame]], skip: tuple[str, ...] = ()) -> list[tuple[str, str, str]]:
    """(check, state, message) of each check: ok, FAIL, warn, skip or OFF for
    one that has no input.  A check that can't read what it is about fails, and
    the others go on.  An unknown name to skip is an error."""
    unknown = set(skip) - set(CHECKS)
    if unknown:
        raise ValueError(f"no such check: {', '.join(sorted(unknown))}")
    out = []
    for name in CHECKS:
        if name in skip:
            out.append((name, "skip", ""))
        elif name not in made:
            out.append((name, "OFF", ""))
        else:
            try:
                found = made[name]().collect()  # a few rows at most
            except (Py4JError, PySparkException) as e:
                out.append((name, "FAIL", f"could not be read: {_cause(e)}"))
                continue
            state, _, text = state_of(found).partition(" ")
            out.append((name, state, text))
    return out


def _cause(e: Exception) -> str:
    """The last cause of a failed job, in one line."""
    lines = [x.strip() for x in str(e).splitlines()]
    causes = [x.removeprefix("Caused by: ") for x in lines if x.startswith("Caused by: ")]
    return (causes or [x for x in lines if x] or [type(e).__name__])[-1 if causes else 0][:300]


# ------------------------------------------------------------------ validation

#: What counts as the same protein as a reference's.
SAME_PROTEIN = ("identical", "identical_after_met_trim", "isoform_extension", "offset_isoform")


def reference_matches(built: DataFrame, matches: DataFrame) -> DataFrame:
    """(transcript, status): a row for each transcript that stands for itself,
    the reference record before an isoform; ``no_entry`` where the proteome has
    none of its gene."""
    one = R.first_wins(built.select("transcript", "seq_id", "variant_class"), ["transcript"], [F.col("variant_class") != "REFERENCE", F.col("seq_id")])
    return one.join(matches.select("seq_id", F.col("comparison.status").alias("status")), "seq_id", "left").select("transcript", F.coalesce("status", F.lit("no_entry")).alias("status"))


def gate(spark: SparkSession, translations: DataFrame | None, agreement: DataFrame | None, least: float) -> DataFrame:
    """The violation of a run whose proteins differ too much: by the share of
    equal translations of the annotation's own (same) or, only where those have
    nothing to compare, by the share of transcripts whose closest proteome entry
    is the same protein (status).  Nothing to compare at all is no violation."""
    if translations is None and agreement is None:
        return spark.createDataFrame([], "check_name string, severity string, message string")
    share = lambda t, good, what: t.agg(F.count("*").alias("n"), F.count_if(good).alias("k")).select(F.lit(what).alias("what"), "n", "k")
    rates = [share(translations, F.col("same"), "translations")] if translations is not None else []
    rates += [share(agreement, F.col("status").isin(*SAME_PROTEIN), "proteome entries")] if agreement is not None else []
    ranked = reduce(lambda a, b: a.union(b), [r.withColumn("rank", F.lit(i)) for i, r in enumerate(rates)]).where("n > 0")
    first = ranked.agg(F.min_by(F.struct("what", "n", "k"), "rank").alias("f")).where("f IS NOT NULL").select("f.*")
    wrong = first.where(F.col("k") / F.col("n") < least)
    text = F.concat("k", F.lit(" of "), "n", F.lit(" agree with the "), "what", F.lit(f", fewer than {least:.0%}"))
    return wrong.select(F.lit("V3").alias("check_name"), F.lit("error").alias("severity"), text.alias("message"))


def residue_check(sites: DataFrame, proteome: DataFrame) -> DataFrame:
    """match, mismatch, out_of_range or no_uniprot_entry of sites (site_id,
    gene, pos, residue): the best state over a gene's entries."""
    own = proteome.select(F.explode(F.split("gn", " +")).alias("gene"), "sequence")
    joined = sites.join(own, "gene", "left")
    rank = F.when(F.col("sequence").isNull(), 0).when(F.col("pos") > F.length("sequence"), 1).when(F.substring("sequence", F.col("pos").cast("int"), F.lit(1)) == F.col("residue"), 3).otherwise(2)
    best = joined.groupBy("site_id", "gene").agg(F.max(rank).alias("r"))
    return best.select("site_id", "gene", F.element_at(F.array(*(F.lit(x) for x in ("no_uniprot_entry", "out_of_range", "mismatch", "match"))), F.col("r") + 1).alias("state"))


def site_anchors(residues: DataFrame) -> DataFrame:
    """(state, n): sites with an entry that agrees, with none in the proteome,
    and others."""
    site = residues.groupBy("site_id").agg(F.bool_or(F.col("state") == "match").alias("ok"), F.bool_and(F.col("state") == "no_uniprot_entry").alias("none"))
    return site.groupBy(F.when(F.col("ok"), "anchored").when(F.col("none"), "absent").otherwise("mismatch").alias("state")).agg(F.count("*").alias("n"))


def translation_agreement(built: DataFrame, published: DataFrame) -> DataFrame:
    """(tx_id, same): built reference proteins against the annotation's own."""
    first = R.first_wins(built.where("variant_class = 'REFERENCE' OR consequence LIKE '%annotated_isoform'").select(F.col("transcript").alias("tx_id"), "sequence", "seq_id"), ["tx_id"], [F.col("seq_id")])
    return first.join(published.withColumnRenamed("sequence", "theirs"), "tx_id").select("tx_id", (F.col("sequence") == F.col("theirs")).alias("same"))


def longest_entry(proteome: DataFrame) -> DataFrame:
    """A gene's longest entry; of equal ones the greatest accession."""
    own = proteome.select(F.explode(F.split("gn", " +")).alias("gene"), "accession", "sequence")
    return own.groupBy("gene").agg(F.max_by(F.struct("accession", "sequence"), F.struct(F.length("sequence"), F.col("accession"))).alias("x")).select("gene", "x.*")


STATUS = ("identical", "identical_after_met_trim", "isoform_extension", "offset_isoform", "near_identical", "divergent")


def best_match(built: DataFrame, proteome: DataFrame) -> DataFrame:
    """Each record's closest entry of its gene."""
    from ..functions.compare import compared

    own = proteome.select(F.explode(F.split("gn", " +")).alias("gene"), "accession", F.col("sequence").alias("theirs"))
    rows = compared(built.select("seq_id", "gene", "sequence").join(own, "gene"), "sequence", "theirs")
    rank = F.array_position(F.array(*(F.lit(s) for s in STATUS)), F.col("comparison.status"))
    return R.first_wins(rows.select("seq_id", "gene", "accession", "comparison"), ["seq_id"], [rank, -F.col("comparison.identity"), F.col("accession")])


# ------------------------------------------------------------------ reports


def class_counts(manifest: DataFrame) -> DataFrame:
    genes = F.filter(F.transform(F.split(F.regexp_replace(F.coalesce("genes", F.lit("")), ",", ";"), ";"), lambda x: F.trim(x)), lambda g: ~g.isin("", "."))
    n = manifest.groupBy("variant_class").agg(F.count("*").alias("n_records"), F.count_if(F.col("confidence").isNotNull()).alias("n_stated"))
    g = manifest.select("variant_class", F.explode(genes).alias("g")).groupBy("variant_class").agg(F.count_distinct("g").alias("n_genes"))
    return n.join(g, "variant_class", "left").fillna(0, ["n_genes"])


def confidence_profile(manifest: DataFrame) -> DataFrame:
    stated = manifest.where("confidence IS NOT NULL")
    ends = stated.groupBy("variant_class").agg(F.min("confidence").alias("low"), F.max("confidence").alias("high"))
    return ends.join(R.upper_median(stated, ["variant_class"], "confidence"), "variant_class")


def expected_yield(manifest: DataFrame, per_class: dict[str, float] | None = None) -> DataFrame:
    """What each class may give at most: two orders of a fusion, two forms of
    an event with two isoforms each, one of anything else."""
    factor = F.when(F.col("variant_class") == "FUSION", 2).when(F.col("variant_class").startswith("AS_"), 4).otherwise(1)
    for name, value in (per_class or {}).items():
        factor = F.when(F.col("variant_class") == name, value).otherwise(factor)
    return manifest.groupBy("variant_class").agg(F.count("*").alias("n"), F.sum(factor).cast("double").alias("expected"))


def fusion_reach(manifest: DataFrame) -> DataFrame:
    f = manifest.where("fusion IS NOT NULL")
    same = F.col("fusion.chrom1") == F.col("fusion.chrom2")
    return f.agg(F.count_if(same).alias("intra"), F.count_if(~same).alias("inter"))


LABELS = {
    "protein_built": "protein built", "utr_variant": "in an untranslated region", "synonymous_only": "synonymous only", "synonymous_or_utr": "synonymous or untranslated", "below_min_length": "too short", "below_min_af": "too rare",
    "not_expressed": "gene not expressed", "filtered": "filtered", "no_coding_transcript_at_locus": "no coding transcript there", "crosses_splice_junction": "crosses a splice junction", "not_in_coding_exon": "not in a coding exon", "no_protein": "no protein", "error": "error",
}


def recovery(outcomes: DataFrame, entry: DataFrame | None = None) -> DataFrame:
    """By class and in all: inputs, built, rate, proteins and each outcome."""
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in LABELS]
    rolled = outcomes.rollup("variant_class").agg(F.count("*").alias("n_input"), F.sum("n_proteins").alias("n_proteins"), *counts)
    out = rolled.withColumn("variant_class", F.coalesce("variant_class", F.lit("TOTAL"))).withColumn("rate", F.col("protein_built") / F.col("n_input"))
    if entry is None:
        return out
    return out.join(entry.groupBy("variant_class").agg(F.count("*").alias("n_entries")), "variant_class", "left")


def effect_ratio(records: DataFrame) -> DataFrame:
    """Changed to synonymous records, with a verdict; coding exomes are near 2.5."""
    n = records.agg(F.count_if(F.col("consequence").isin("missense", "stop_gained", "stop_lost", "start_lost")).alias("nonsyn"), F.count_if(F.col("consequence") == "synonymous").alias("syn"))
    ratio = F.col("nonsyn") / F.nullif("syn", F.lit(0))
    return n.select("nonsyn", "syn", ratio.alias("ratio"), F.when(ratio.isNull(), "no synonymous records").when(ratio < 1, "low").when(ratio > 10, "high").otherwise("plausible").alias("verdict"))
