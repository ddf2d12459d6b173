"""Builds the peptide library of a search: which peptides of a table of
translated entries no reference protein has.

    python -m jobs.peptide_library --entries E --reference R --out O --config jobs/peptide_library.json

``O/library`` has a row for each new key (a peptide with I read as L), by the
group of its first entry: the peptide and the entry it is first found in, how
many entries have it, and its decoy.  ``O/groups`` counts keys by group.  Both
are made anew by each run, so a run after a failed one, or a second one over
the same tables, gives the same rows.

Cases: letters that are no residues are left out; entries without a sequence have
no peptides; entries without a group are in the group ``unnamed``; entries that
share an id count as one; of equal ids the least peptide and group are told.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from jobs.common import LOG, Digest, count, main, named
from varloom.functions import packing as K
from varloom.session import ship

#: Bytes of entries, as stored, for each bucket of keys.
BUCKET_BYTES = 2 << 20
#: Bytes of entries, as stored, whose peptides are moved at once: of more, a share of the buckets is made at a time.
TURN_BYTES, MOST_TURNS = 480 << 20, 4
#: Keys are sorted, so those that begin alike take little space by their differences.
WRITTEN = {"compression": "zstd", "parquet.writer.version": "v2"} | {f"parquet.enable.dictionary#{c}": "false" for c in ("k", "peptide", "decoy")}
#: While the library is written: sorted rows of a group go to its open file and are not sorted again, and files of a shuffle go when it is done.
WRITING = {"spark.sql.maxConcurrentOutputFileWriters": "64", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@dataclass(frozen=True)
class Settings(Digest):
    reference_column: str = "text"


def dealing(entries: DataFrame, cfg: Settings) -> K.Cut:
    """How the peptides of entries are dealt, by the size of their files."""
    size = int(entries._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    buckets = min(max(size // BUCKET_BYTES, 2 * entries.sparkSession.sparkContext.defaultParallelism), K.MOST_BUCKETS)
    return K.Cut(cfg.missed_cleavages, cfg.least_length, cfg.most_length, buckets, min(max(1, -(-size // TURN_BYTES)), MOST_TURNS))


def library(entries: DataFrame, reference: DataFrame, cfg: Settings, cut: K.Cut | None = None, turn: int = 0) -> DataFrame:
    """(k, peptide, entry_id, n_entries, proteotypic, decoy, group) of the
    buckets of a turn; sorted by group and key within each bucket."""
    cut = cut or K.Cut(cfg.missed_cleavages, cfg.least_length, cfg.most_length)
    own = entries.select(F.col(f"`{cfg.id_column}`").alias("id"), named(cfg.group_column).alias("group"), F.col(f"`{cfg.sequence_column}`").alias("sequence"))
    known = reference.select(F.col(f"`{cfg.reference_column}`").alias("sequence"))
    runs = K.packed_runs(own, "sequence", cut, turn, "id", "group").unionByName(K.packed_runs(known, "sequence", cut, turn))
    kind = own.schema["id"].dataType
    # only packed runs are moved, and small partitions joined; what follows from a peptide is made after that
    return K.met(runs.hint("rebalance", "bucket"), kind.simpleString(), to_arrow_type(kind), cut)


@contextmanager
def settings_of(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build(spark: SparkSession, entries: str, reference: str, out: str, cfg: Settings | None = None) -> dict[str, int]:
    """The job: rows read and written."""
    cfg = cfg or Settings()
    ship(spark)
    done = {}
    tables = {name: spark.read.parquet(path) for name, path in (("entries", entries), ("reference", reference))}
    for name, path in (("entries", entries), ("reference", reference)):
        done[name] = count(tables[name], f"read {name},", path)
    cut = dealing(tables["entries"], cfg)
    with settings_of(spark, WRITING):
        for turn in range(cut.passes):
            made = library(tables["entries"], tables["reference"], cfg, cut, turn)
            made.write.mode("append" if turn else "overwrite").options(**WRITTEN).partitionBy("group").parquet(f"{out}/library")
    written = read(spark, out, tables["entries"].schema[cfg.id_column].dataType.simpleString())
    done["library"] = count(written, "wrote library,", f"{out}/library")
    groups = written.groupBy("group").agg(F.count("*").alias("n_keys"), F.count_if("proteotypic").alias("n_proteotypic"))
    groups.write.mode("overwrite").parquet(f"{out}/groups")
    done["groups"] = count(spark.read.parquet(f"{out}/groups"), "wrote groups,", f"{out}/groups")
    LOG.info("library done: %s", done)
    return done


def read(spark: SparkSession, out: str, id_kind: str = "bigint") -> DataFrame:
    """The library as written; a group's name is text, whatever it looks like."""
    return spark.read.schema(f"k string, peptide string, entry_id {id_kind}, n_entries bigint, proteotypic boolean, decoy string, `group` string").parquet(f"{out}/library")


if __name__ == "__main__":
    sys.exit(main("peptide_library", Settings, lambda spark, args, cfg: build(spark, args.entries, args.reference, args.out, cfg), {"entries": "table of translated entries", "reference": "table of reference proteins", "out": "folder of the library"}))
