"""Sessions, and the package's way to the executors."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: What a session of our own sets; a given session keeps its own settings.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


#: Rows of an Arrow batch: batches of texts are megabytes each, and a worker holds a few.
ARROW_ROWS, TEXT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1200"


def session(master: str = "local[*]", **more: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("varloom")
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package's sources to the executors, once for each context,
    so that Python workers find it wherever they run."""
    context = spark.sparkContext
    if spark.conf.get(ARROW_ROWS) == "10000":  # the default; a session's own choice stays
        spark.conf.set(ARROW_ROWS, TEXT_ROWS)
    if getattr(context, "_varloom_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    sources = sorted(p for p in root.rglob("*.py"))
    digest = hashlib.sha256(b"".join(p.read_bytes() for p in sources)).hexdigest()[:16]
    folder = tempfile.mkdtemp(prefix="varloom-")
    archive = os.path.join(folder, f"varloom-{digest}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sources:
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(archive)
    context._varloom_shipped = True
    return spark


def use_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder the cluster names.  A session that
    names none gets a temporary folder on a single machine; on a cluster that
    is an error, as executors would not see each other's files."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="varloom-"))
