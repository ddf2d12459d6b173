"""Keeps the peptides of normal tissues up to date as samples arrive.

    python -m jobs.normal_background --samples S --out O --config jobs/normal_background.json

``S`` is a growing folder of Parquet files of translated samples.  A run reads
the files that no run has read (a file stream with the checkpoint ``O/stream``)
until there are no more, and ends.  ``O/background`` has, by tissue, each key
(a peptide with I read as L) with the number of samples that have it and the
least id of them; ``normal_keys`` reads from it the keys of so many tissues,
which is the list that a search leaves out.

A batch writes what it counts into its own partitions of ``O/parts`` and then
the tissues it met anew from all parts (as they are, where no other batch has
the tissue), so a batch that is done once more after
a failure gives the same.  A run without new files changes nothing.

Cases: samples without a sequence have no peptides; those without a tissue are
in the tissue ``unnamed``; rows count each, whatever their ids; a null id is
never the least one unless all are null.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from jobs.common import LOG, Digest, count, main, named
from varloom.functions import digestion as D
from varloom.functions import peptides as P
from varloom.operators import relational as R
from varloom.session import ship

#: Shares of a tissue's keys, each of which one task sums and writes.
SHARES = 64


@dataclass(frozen=True)
class Settings(Digest):
    files_per_batch: int = 1_000


def counted(samples: DataFrame, cfg: Settings) -> DataFrame:
    """(tissue, k, n_samples, first_id) of some samples.  Sequences are folded
    before they are cut, so a sample has a key once.  Samples are dealt to all
    tasks before they are cut, and keys are moved once: to a share of their
    tissue, where they are summed and whence they are written."""
    own = R.dealt(samples.select(F.col(f"`{cfg.id_column}`").alias("id"), named(cfg.group_column).alias("tissue"), F.col(f"`{cfg.sequence_column}`").alias("sequence")))
    rows = D.digested(own.withColumn("sequence", P.fold(P.protein_like("sequence"))), "sequence", ["id", "tissue"], cfg.missed_cleavages, cfg.least_length, cfg.most_length)
    return dealt_keys(rows.select("tissue", F.col("peptide").alias("k"), F.lit(1).alias("n"), "id")).agg(F.sum("n").alias("n_samples"), F.min("id").alias("first_id")).drop("share")


def dealt_keys(rows: DataFrame) -> GroupedData:
    """The rows by tissue and key, dealt by tissue and share: a task has few tissues, so it writes few files."""
    shared = rows.withColumn("share", F.pmod(F.xxhash64("k"), F.lit(SHARES)))
    return shared.repartition("tissue", "share").groupBy("tissue", "share", "k")


def merged(parts: DataFrame) -> DataFrame:
    return dealt_keys(parts).agg(F.sum("n_samples").alias("n_samples"), F.min("first_id").alias("first_id")).drop("share")


def samples_as_they_come(spark: SparkSession, path: str, like: DataFrame, cfg: Settings) -> DataFrame:
    """The table as a stream of its files; a path of one file is that file of
    its folder."""
    reader = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", cfg.files_per_batch)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        return reader.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())
    return reader.parquet(path)


def update(spark: SparkSession, samples: str, out: str, cfg: Settings | None = None) -> dict[str, int]:
    """The job: rows of new samples read, and batches and rows of background
    that there are now."""
    cfg = cfg or Settings()
    ship(spark)
    whole = spark.read.parquet(samples)
    id_kind = whole.schema[cfg.id_column].dataType.simpleString()
    stored = f"batch bigint, tissue string, k string, n_samples bigint, first_id {id_kind}"
    done = {"samples": 0, "batches": 0}

    def take(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        done["samples"] += count(batch, f"batch {number}: read samples,", samples)
        done["batches"] += 1
        rows = counted(batch, cfg).withColumn("batch", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "tissue").parquet(f"{out}/parts")
        parts = own.read.schema(stored).parquet(f"{out}/parts")
        # a tissue's batches: of one that no other batch has, the part is the background as it is
        held = parts.select("tissue", "batch").distinct().groupBy("tissue").agg(F.count("*").alias("batches"), F.bool_or(F.col("batch") == number).alias("met")).where("met")
        of = lambda which: parts.join(F.broadcast(held.where(which)), "tissue", "left_semi")  # noqa: E731  a row for each folder of a tissue
        for found in (of("batches = 1").drop("batch"), merged(of("batches > 1"))):
            found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tissue").parquet(f"{out}/background")
        LOG.info("batch %d: wrote its parts and its tissues' background: %s", number, out)

    stream = samples_as_they_come(spark, samples, whole, cfg)
    query = stream.writeStream.option("checkpointLocation", f"{out}/stream").trigger(availableNow=True).foreachBatch(take).start()
    query.awaitTermination()
    done["background"] = count(read(spark, out, id_kind), "background has", f"{out}/background")
    LOG.info("background done: %s", done)
    return done


def read(spark: SparkSession, out: str, id_kind: str = "bigint") -> DataFrame:
    """(tissue, k, n_samples, first_id) as it stands."""
    return spark.read.schema(f"tissue string, k string, n_samples bigint, first_id {id_kind}").parquet(f"{out}/background")


def normal_keys(background: DataFrame, least_tissues: int = 1) -> DataFrame:
    """(k): keys of at least so many tissues."""
    return background.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") >= least_tissues).select("k")


if __name__ == "__main__":
    sys.exit(main("normal_background", Settings, lambda spark, args, cfg: update(spark, args.samples, args.out, cfg), {"samples": "growing folder of translated samples", "out": "folder of the background"}))
