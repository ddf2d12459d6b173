"""Truth sets and tool comparison: recall, precision, shared sequences."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import digestion as D
from ..functions import peptides as P
from ..functions.sequence import THREE_LETTER
from ..operators import relational as R

#: Review marks from none to most.
REVIEW = ("no assertion", "single submitter", "multiple submitters", "expert panel", "practice guideline")


def review_rank(status: Column) -> Column:
    """0 to 4; text that isn't known counts as unasserted."""
    found = [F.when(F.lower(status).contains(s), i) for i, s in enumerate(REVIEW)]
    return F.coalesce(*reversed(found), F.lit(0))


def one_letter(change: Column) -> Column:
    """A protein change with three-letter names made one-letter ones."""
    out = F.regexp_replace(F.trim(change), "^p\\.", "")
    for three, one in THREE_LETTER.items():
        out = F.replace(out, F.lit(three), F.lit(one))
    return out


def normal_change(change: Column) -> Column:
    """Spellings of one change made equal: names, parentheses, X for a stop,
    and what follows a frameshift."""
    out = F.regexp_replace(one_letter(F.regexp_replace(change, "[()]", "")), "X$", "*")
    return F.regexp_replace(out, "^([A-Z*]\\d+)[A-Z*]?fs.*$", "$1fs")


def normal_locus(locus: Column) -> Column:
    return F.regexp_replace(locus, "^(?i)chr", "")


def spdi_fields(spdi: Column) -> Column:
    """struct(pos, ref, alt, needs_anchor) of sequence:position:deleted:inserted;
    positions there start at 0, and pure insertions or deletions need the base
    before them to be written as VCF."""
    part = lambda i: F.get(F.split(spdi, ":"), F.lit(i))
    bare = (part(2) == "") | (part(3) == "")
    return F.struct((part(1).cast("bigint") + F.when(bare, 0).otherwise(1)).alias("pos"), part(2).alias("ref"), part(3).alias("alt"), bare.alias("needs_anchor"))


def score(truth: DataFrame, observed: DataFrame) -> DataFrame:
    """Truth rows (locus, change, category) with ``found``: any observed change
    (locus, changes) at the locus is equivalent."""
    seen = observed.select(normal_locus(F.col("locus")).alias("k"), F.transform("changes", normal_change).alias("seen"))
    joined = truth.withColumn("k", normal_locus(F.col("locus"))).join(seen, "k", "left")
    hit = F.array_contains("seen", normal_change(F.col("change")))
    return joined.select(*truth.columns, F.coalesce(hit, F.lit(False)).alias("found"), F.col("seen").isNotNull().alias("observed"))


def accuracy(scored: DataFrame) -> DataFrame:
    """Recall and precision by category and in all; null where nothing counts."""
    ratio = lambda a, b: F.when(b > 0, a / b)
    hit, seen, n = F.count_if("found"), F.count_if("observed"), F.count("*")
    return scored.rollup("category").agg(n.alias("n"), hit.alias("n_found"), ratio(hit, n).alias("recall"), ratio(hit, seen).alias("precision")).withColumn("category", F.coalesce("category", F.lit("TOTAL")))


# Consequence terms from the most to the least severe, and what they are called here.
SEVERITY = (
    "transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained", "frameshift_variant", "stop_lost", "start_lost", "transcript_amplification", "feature_elongation", "feature_truncation", "inframe_insertion", "inframe_deletion", "missense_variant",
    "protein_altering_variant", "splice_donor_5th_base_variant", "splice_region_variant", "splice_donor_region_variant", "splice_polypyrimidine_tract_variant", "incomplete_terminal_codon_variant", "start_retained_variant", "stop_retained_variant", "synonymous_variant",
    "coding_sequence_variant", "mature_miRNA_variant", "5_prime_UTR_variant", "3_prime_UTR_variant", "non_coding_transcript_exon_variant", "intron_variant", "NMD_transcript_variant", "non_coding_transcript_variant", "coding_transcript_variant", "upstream_gene_variant", "downstream_gene_variant", "intergenic_variant", "sequence_variant",
)
TERMS = {
    "missense_variant": "missense", "stop_gained": "stop_gained", "stop_lost": "stop_lost", "start_lost": "start_lost", "frameshift_variant": "frameshift", "inframe_insertion": "inframe_insertion", "inframe_deletion": "inframe_deletion", "synonymous_variant": "synonymous",
    "stop_retained_variant": "synonymous", "start_retained_variant": "synonymous", "5_prime_UTR_variant": "5_prime_UTR", "3_prime_UTR_variant": "3_prime_UTR",
}


def severity(term: Column) -> Column:
    at = F.array_position(F.array(*(F.lit(t) for t in SEVERITY)), term)
    return F.when(at > 0, at).otherwise(len(SEVERITY) + 1)


def most_severe(terms: Column) -> Column:
    """The most severe of several terms; empty for none."""
    ranked = F.array_min(F.transform(terms, lambda t: F.struct(severity(t).alias("rank"), t.alias("term"))))
    return F.coalesce(ranked["term"], F.lit(""))


def consequence_crosscheck(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(variant_id, how, ours, theirs, agrees): ours (variant_id, transcript,
    consequence) against theirs (variant_id, transcript, terms): on the least
    shared transcript, else the most severe term of the variant's."""
    bare = lambda c: F.substring_index(c, ".", 1)
    a, b = ours.select("variant_id", bare("transcript").alias("tx"), F.col("consequence").alias("ours")), theirs.select("variant_id", bare("transcript").alias("tx"), "terms")
    shared = R.first_wins(a.join(b, ["variant_id", "tx"]), ["variant_id"], [F.col("tx"), F.col("ours")])
    rest = a.join(shared.select("variant_id"), "variant_id", "left_anti").groupBy("variant_id").agg(F.array_sort(F.collect_set("ours")).alias("all_ours"))
    worst = b.groupBy("variant_id").agg(F.array_distinct(F.flatten(F.collect_set("terms"))).alias("terms"))
    names = F.create_map(*(F.lit(x) for pair in TERMS.items() for x in pair))
    named = lambda terms: F.try_element_at(names, most_severe(terms))
    one = shared.select("variant_id", F.lit("shared_transcript").alias("how"), F.array("ours").alias("ours"), named(F.col("terms")).alias("theirs"))
    other = rest.join(worst, "variant_id").select("variant_id", F.lit("most_severe").alias("how"), F.col("all_ours").alias("ours"), named(F.col("terms")).alias("theirs"))
    return one.unionByName(other).withColumn("agrees", F.coalesce(F.array_contains("ours", F.col("theirs")), F.lit(False)))


def listed_changes(rows: DataFrame, entry: str, chrom: str, change: str) -> DataFrame:
    """(entry, locus) of tables that list POS:REF>ALT changes by semicolons and
    name the contig in a column of its own."""
    pattern = "^\\s*(\\d+):?([ACGTN]+)>([ACGTN]+)\\s*$"
    each = rows.select(F.col(entry).alias("entry"), F.trim(F.col(chrom)).alias("c"), F.explode(F.split(F.col(change), ";")).alias("x")).where(F.col("x").rlike(pattern))
    part = lambda i: F.regexp_extract("x", pattern, i)
    return each.select("entry", normal_locus(F.concat("c", F.lit(":"), part(1), part(2), F.lit(">"), part(3))).alias("locus")).distinct()


def combined_entries(changes: DataFrame) -> DataFrame:
    """One row: how many entries carry more than one variant."""
    return changes.groupBy("entry").agg(F.count_distinct("locus").alias("n")).agg(F.count_if(F.col("n") > 1).alias("n_combined"))


def tool_stats(entries: DataFrame, k: int = 7) -> DataFrame:
    """Per tool: entries, distinct sequences, k-mers and genes of (tool, gene,
    sequence)."""
    plain = entries.groupBy("tool").agg(F.count("*").alias("entries"), F.count_distinct("sequence").alias("sequences"), F.count_distinct("gene").alias("genes"))
    long = entries.where(F.length(F.replace("sequence", F.lit("*"), F.lit(""))) >= k)
    mers = D.kmer_items(long, "sequence", "tool", k).distinct().groupBy("tool").agg(F.count("*").alias("kmers"))
    return plain.join(mers, "tool", "left")


def tool_pairs(entries: DataFrame, k: int = 7) -> DataFrame:
    """Jaccard of sequences and of k-mers for each pair of tools."""
    return R.jaccard_pairs(entries.select("tool", F.col("sequence").alias("x")), "tool", "x").withColumn("of", F.lit("sequences")).unionByName(R.jaccard_pairs(D.kmer_items(entries, "sequence", "tool", k), "tool", "item").withColumn("of", F.lit("kmers")))


def disagreeing_genes(entries: DataFrame, tools: list[str]) -> DataFrame:
    """(a, b, gene): both tools translate the gene and share no sequence of it."""
    per = entries.groupBy("tool", "gene").agg(F.collect_set(F.sha2("sequence", 256)).alias("s"))
    out = None
    for a, b in combinations(sorted(tools), 2):
        x, y = per.where(F.col("tool") == a).select("gene", F.col("s").alias("x")), per.where(F.col("tool") == b).select("gene", F.col("s").alias("y"))
        one = x.join(y, "gene").where(~F.arrays_overlap("x", "y")).select(F.lit(a).alias("a"), F.lit(b).alias("b"), "gene")
        out = one if out is None else out.union(one)
    return out


def normal_peptides(normal: DataFrame, reference: DataFrame) -> DataFrame:
    """(p, k): folded peptides of normal tissue that the reference lacks."""
    keys = lambda df: df.select(F.explode(P.digest("sequence")).alias("p")).select("p", P.fold("p").alias("k"))
    return keys(normal).join(keys(reference).select("k").distinct(), "k", "left_anti").distinct()


def normal_events(events: DataFrame, observed: DataFrame) -> DataFrame:
    """(event_id, tissues): events (event_id, junction) all of whose junctions
    (junction, tissues) were seen, with the least number of tissues."""
    whole = R.divide(events, "event_id", "junction", observed, "junction")
    return events.join(observed, "junction").join(whole, "event_id").groupBy("event_id").agg(F.min("tissues").alias("tissues"))
