"""A written release: where its pieces are, and whether they fit together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import checks, package
from .sources import reference

PIECES = ("target", "target_decoy", "by_class", "entries", "summary_by_class", "MANIFEST")


@dataclass
class Release:
    path: str
    pieces: dict[str, str] = field(default_factory=dict)
    disposition: str | None = None
    problems: list[str] = field(default_factory=list)


def locate(spark: SparkSession, folder: str) -> Release:
    """The release in a folder, or the one folder in it that is one; several
    are a problem and not a choice."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return Release(folder, problems=[f"{folder} is not there"])
    child = lambda parent, name: spark._jvm.org.apache.hadoop.fs.Path(f"{parent}/{name}")
    own = [folder] if fs.exists(child(folder, "target")) else [x.getPath().toString() for x in fs.listStatus(place) if fs.exists(child(x.getPath().toString(), "target"))]
    if len(own) != 1:
        return Release(folder, problems=[f"{len(own)} releases in {folder}" + (": " + ", ".join(sorted(own)) if own else "")])
    found = Release(own[0], {p: f"{own[0]}/{p}" for p in PIECES if fs.exists(child(own[0], p))})
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{own[0]}_disposition")
    found.disposition = beside.toString() if fs.exists(beside) else None
    found.problems = [f"no {p} in {own[0]}" for p in ("target", "entries", "MANIFEST") if p not in found.pieces]
    return found


def headers(spark: SparkSession, path: str) -> DataFrame:
    """(entry_id, header, class) of the entries in a folder of FASTA parts; the
    class is the part's folder, where there is one."""
    rows = spark.read.text(path).where(F.col("value").startswith(">"))
    header = F.substring("value", F.lit(2), F.length("value"))
    kind = F.col("class").cast("string") if "class" in rows.columns else F.lit(None).cast("string")
    return rows.select(F.substring_index(header, " ", 1).alias("entry_id"), header.alias("header"), kind.alias("class"))


def table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).csv(path)


def file_checks(spark: SparkSession, release: Release, width: int = 60) -> dict[str, Callable[[], DataFrame]]:
    """The checks that the files alone allow, each on what was written."""
    at = release.pieces
    made: dict[str, Callable[[], DataFrame]] = {}
    if "target" in at:
        made["I4"] = lambda: checks.i4_unique(headers(spark, at["target"]))
        made["I5"] = lambda: checks.i5_layout(reference.fasta(spark, at["target"]), width)
    if {"target", "by_class"} <= set(at):
        made["I1"] = lambda: checks.i1_partition(headers(spark, at["target"]).select("entry_id"), headers(spark, at["by_class"]).select("entry_id", "class"))
    if {"target", "entries", "summary_by_class"} <= set(at):
        made["I3"] = lambda: counts_as_stated(spark, at)
    if "target_decoy" in at:
        made["I9"] = lambda: checks.i9_decoys(headers(spark, at["target_decoy"]).withColumn("is_decoy", F.col("header").endswith(" DECOY=1")))
    if "MANIFEST" in at:
        made["I8"] = lambda: checks.i8_checksums(spark.read.option("sep", "\t").csv(at["MANIFEST"]).toDF("sha256", "file", "bytes"), package.checksums(spark, release.path))
    return made


def counts_as_stated(spark: SparkSession, at: dict[str, str]) -> DataFrame:
    """The entries of the FASTA, by kind, against the tables."""
    stated = table(spark, at["summary_by_class"]).agg(*(F.coalesce(F.sum(F.when(c, F.col("n").cast("bigint"))), F.lit(0)).alias(k) for k, c in (("variant", F.col("variant_class") != "REFERENCE"), ("wildtype", F.col("variant_class") == "REFERENCE")))).first()
    written = headers(spark, at["target"])
    foreign = F.col("entry_id").rlike("^(sp|tr)\\|")
    n = written.agg(F.count("*").alias("total"), F.count_if(foreign).alias("reference")).first()
    listed = table(spark, at["entries"]).withColumn("entry_id", F.coalesce("entry_id", F.lit("")))
    faults = checks.i3_counts(listed, {"variant": stated["variant"], "wildtype": stated["wildtype"]})
    own = n["total"] - n["reference"]
    differ = listed.agg(F.count("*").alias("n")).where(F.col("n") != own)
    return faults.union(checks.violation(differ, "I3", f"tables against {own} entries of the FASTA, listed", "n"))


def audit(spark: SparkSession, folder: str, skip: tuple[str, ...] = (), more: dict[str, Callable[[], DataFrame]] | None = None) -> tuple[Release, dict[str, str]]:
    """The state of each check of a release, from its files and from ``more``."""
    release = locate(spark, folder)
    made = {} if release.problems else file_checks(spark, release) | (more or {})
    return release, {name: f"{state} {text}".strip() for name, state, text in checks.run_checks(made, skip)}
