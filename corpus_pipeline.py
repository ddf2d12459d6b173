"""A training-corpus pipeline: five stages over ``documents``, in order.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept.  All but the last return the columns of ``documents``; the last returns
each remaining document's token ids, as digests, and whether they decode to its
text.

Cases, the same for each stage: a null or empty text is clean, its own class, and
has no ids; a null id is kept as it is and is never a copy; texts are taken whole;
of rows with equal texts the one of the least id stays, and rows that share an id
are one document and stay or go together; repeated rows are judged each; an empty table gives an empty one;
further columns, whatever their names, are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm import bpe, decontam, minhash, secrets_scan, toxicity
from varloom.llm.common import crc_mod, let_go, read_table, use_checkpoints
from varloom.llm.training_order import shared_path
from varloom.session import ship

#: Ids of dropped copies that are broadcast at most (16 MB); more are joined by a shuffle.
MOST_BROADCAST = 1_000_000


def _held(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents under column names that no operator uses, and the name of
    each column there."""
    names = {c: f"_held{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _given_back(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*(F.col(held).alias(c) for c, held in names.items()))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score is one half or more."""
    ship(spark)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), crc_mod(F.col("_id"), 5) != 0)
    held, names = _held(docs)
    scored = toxicity.score(held, model, names["doc_id"], names["text"], keep=held.columns)
    return _given_back(scored.where("score < 0.5"), names)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each near-duplicate class (five-word
    shingles, similarity of 0.8 or more)."""
    ship(spark)
    use_checkpoints(spark)
    let_go(spark)
    found = minhash.near_duplicates(docs, k=5, percent=80)
    dropped = found.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct().checkpoint()
    few = dropped.count() <= MOST_BROADCAST
    held, names = _held(docs)
    kept = held.join(F.broadcast(dropped) if few else dropped, F.col(names["doc_id"]) == F.col("_gone"), "left_anti")
    return _given_back(kept, names)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    ship(spark)
    held, names = _held(docs)
    found = decontam.find_windows(spark, held, read_table(spark, sf_dir, "benchmark"), names["doc_id"], names["text"], keep=held.columns)
    return _given_back(found.where(F.size("hits") == 0), names)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Marks secrets, plain and wrapped, out of the texts."""
    ship(spark)
    held, names = _held(docs)
    clean = secrets_scan.redacted(secrets_scan.scan(held, names["doc_id"], names["text"], keep=held.columns), names["text"])
    if "n_chars" in names:
        clean = clean.withColumn(names["n_chars"], F.char_length(names["text"]).cast(docs.schema["n_chars"].dataType))
    return _given_back(clean, names)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, decoded again."""
    ship(spark)
    rank_file, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    out = bpe.decode(bpe.encode(docs, rank_file, pattern), rank_file)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("minhash_near_dedup", without_copies),
    ("benchmark_decontamination", without_benchmarks),
    ("secret_scan", without_secrets),
    ("byte_bpe", tokenised),
]

#: SQL can't express the classifier of the first stage; tests hold the stages against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = shared_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return docs
