"""The jobs as queries: each run twice into one new folder, and read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobs import normal_background, peptide_library
from varloom.plans.generic import SQL_FRAGMENTS, SQL_SEQ, sql_peptides
from varloom.session import use_checkpoints


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder that the cluster names."""
    use_checkpoints(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def job1_peptide_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library of all documents, by source, against the benchmark's items."""
    out = new_folder(spark, "peptide-library")
    for _ in range(2):
        peptide_library.build(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/benchmark.parquet", out)
    return peptide_library.read(spark, out)


def job2_normal_background(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The background of all documents, by source."""
    out = new_folder(spark, "normal-background")
    for _ in range(2):
        normal_background.update(spark, f"{sf_dir}/documents.parquet", out)
    return normal_background.read(spark, out)


_DECOY = "array_to_string(list_transform(fr, lambda x: CASE WHEN right(x, 1) IN ('K', 'R') THEN reverse(left(x, length(x) - 1)) || right(x, 1) ELSE reverse(x) END), '')"
LIBRARY_SQL = f"""
WITH s AS (SELECT doc_id AS id, {SQL_SEQ} AS seq, coalesce(nullif(source, ''), 'unnamed') AS source FROM documents), b AS (SELECT item_id AS id, {SQL_SEQ} AS seq FROM benchmark),
{sql_peptides("pep", "s")}, {sql_peptides("ref", "b")}, r AS (SELECT DISTINCT replace(p, 'I', 'L') AS k FROM ref),
e AS (SELECT id, source, p, replace(p, 'I', 'L') AS k FROM pep JOIN s USING (id) WHERE replace(p, 'I', 'L') NOT IN (SELECT k FROM r)),
n AS (SELECT k, count(DISTINCT id) AS n FROM e GROUP BY k), f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id, p, source) AS i FROM e),
x AS (SELECT source, k, p, id, n, {SQL_FRAGMENTS.replace("seq", "p")} AS fr FROM f JOIN n USING (k) WHERE i = 1)
SELECT source AS "group", k, p AS peptide, id AS entry_id, n AS n_entries, n = 1 AS proteotypic, {_DECOY} AS decoy FROM x
"""
BACKGROUND_SQL = f"""
WITH s AS (SELECT row_number() OVER () AS id, doc_id, coalesce(nullif(source, ''), 'unnamed') AS source, replace({SQL_SEQ}, 'I', 'L') AS seq FROM documents), {sql_peptides("pep", "s")}
SELECT source AS tissue, p AS k, count(*) AS n_samples, min(doc_id) AS first_id FROM pep JOIN s USING (id) GROUP BY source, p
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"job1_peptide_library": job1_peptide_library, "job2_normal_background": job2_normal_background}
ORACLE_SQL: dict[str, str] = {"job1_peptide_library": LIBRARY_SQL, "job2_normal_background": BACKGROUND_SQL}
