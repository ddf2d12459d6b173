"""Reports: small aggregates as Markdown."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import checks

#: Rows of a table in a report; a larger one says how many are left out.
MOST_ROWS = 200


def cell(value: Any) -> str:
    if value is None:
        return ""
    return f"{value:.4g}" if isinstance(value, float) else str(value).replace("|", "\\|")


def section(title: str, df: DataFrame, order: str | None = None) -> list[str]:
    """A heading and the rows of an aggregate as a table."""
    columns = df.columns
    rows = (df.orderBy(order) if order else df).limit(MOST_ROWS + 1).collect()
    out = ["", f"## {title}", "", f"| {' | '.join(columns)} |", f"|{'---|' * len(columns)}"]
    out += [f"| {' | '.join(cell(r[c]) for c in columns)} |" for r in rows[:MOST_ROWS]]
    return out + (["", f"Only the first {MOST_ROWS} rows are shown."] if len(rows) > MOST_ROWS else [])


def by_source(manifest: DataFrame) -> DataFrame:
    """(what, value, n): variants by source, region, exonic function and kind of event."""
    parts = {"source": F.col("source"), "region": F.col("edit.region"), "exonic function": F.col("edit.exonic"), "event": F.col("splice.event_type")}
    each = F.explode(F.filter(F.array(*(F.when(c.isNotNull(), F.struct(F.lit(k).alias("what"), c.alias("value"))) for k, c in parts.items())), lambda x: x.isNotNull()))
    return manifest.select(each.alias("x")).select("x.*").groupBy("what", "value").agg(F.count("*").alias("n"))


def bad_alleles(manifest: DataFrame) -> DataFrame:
    """Variants by class whose alleles are not bases."""
    bad = lambda c: F.coalesce(~F.col(c).rlike("^[ACGTN]+$"), F.lit(False))
    return manifest.groupBy("variant_class").agg(F.count_if(bad("small.ref") | bad("small.alt") | bad("edit.ref") | bad("edit.alt")).alias("n_bad"))


def gaps(manifest: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Classes whose variants and outcomes differ in number."""
    a, b = manifest.groupBy("variant_class").agg(F.count("*").alias("n_input")), outcomes.groupBy("variant_class").agg(F.count("*").alias("n_outcomes"))
    both = a.join(b, "variant_class", "full").fillna(0, ["n_input", "n_outcomes"])
    return both.withColumn("gap", F.col("n_input") - F.col("n_outcomes")).where("gap <> 0")


def quality(manifest: DataFrame) -> list[str]:
    """The report on what came in."""
    lines = ["# Input report"]
    lines += section("Variants by class", checks.class_counts(manifest), "variant_class")
    lines += section("Confidence where it is stated", checks.confidence_profile(manifest), "variant_class")
    lines += section("By source and kind", by_source(manifest), "what")
    lines += section("Alleles that are not bases", bad_alleles(manifest), "variant_class")
    lines += section("Expected proteins at most", checks.expected_yield(manifest), "variant_class")
    return lines + section("Fusions within and between chromosomes", checks.fusion_reach(manifest))


def recovered(manifest: DataFrame, outcomes: DataFrame, records: DataFrame, entry: DataFrame) -> list[str]:
    """The report on what became of it."""
    lines = ["# Recovery report"]
    lines += section("Outcomes by class", checks.recovery(outcomes, entry), "variant_class")
    lines += section("Classes with variants and outcomes that differ", gaps(manifest, outcomes), "variant_class")
    return lines + section("Changed and unchanged records", checks.effect_ratio(records))


def validated(tables: dict[str, DataFrame], least: float) -> list[str]:
    """The report on the agreement with published proteins."""
    lines = ["# Validation report"]
    if "residues" in tables:
        lines += section("Residues at edited sites", checks.site_anchors(tables["residues"]), "state")
    if "translations" in tables:
        rate = tables["translations"].agg(F.count("*").alias("compared"), F.count_if("same").alias("identical")).withColumn("rate", F.col("identical") / F.nullif("compared", F.lit(0)))
        lines += [*section("Translations against the annotation's own", rate), "", f"The least rate is {least}."]
    if "matches" in tables:
        lines += section("Closest entries of the proteome", tables["matches"].groupBy("comparison.status").agg(F.count("*").alias("n")), "status")
    return lines


def comparison(entries: DataFrame, k: int = 7) -> list[str]:
    """The report on tools: (tool, gene, sequence)."""
    from . import truth

    lines = ["# Tool comparison", *section("Entries by tool", truth.tool_stats(entries, k), "tool")]
    return lines + section("Shared sequences and k-mers", truth.tool_pairs(entries, k), "of")
