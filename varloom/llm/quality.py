"""Quality classifier: a generalised additive model with pairwise terms.

Cyclic boosting of shallow trees learns one lookup table per feature and one per
chosen pair of features; a text's score is the sigmoid of a sum of table
entries, which is vectorised over a slice of texts.  The model is fitted on the
driver from the feature rows of at most MOST_LABELLED labelled documents (those
of least id hash); texts are never collected.

Cases: a null or empty text has the features of no words and gets a score;
texts of any length are whole; repeated rows are scored each, and learned once; an id
with several labels has the greatest; without labelled
rows every score is one half; an empty table gives an empty one; other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import AdditiveModel, fit_additive, sigmoid
from .common import slices
from .features import FEATURE_BYTES, QUALITY_NAMES, labelled_sample, quality_features

#: Labelled rows that the model is fitted on.
MOST_LABELLED = 20_000


def feature_rows(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample, on the driver, by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", FEATURE_BYTES):
            x = quality_features(batch.column("_text"))
            yield pa.RecordBatch.from_arrays([batch.column("_id").cast(pa.string()), pa.array(x.tolist(), pa.list_(pa.float64())), batch.column("y")], ["i", "x", "y"])

    rows = sample.select(F.col("_id").cast("string").alias("_id"), "_text", "y").mapInArrow(run, "i string, x array<double>, y int").toArrow().sort_by("i")
    return np.array(rows["x"].to_pylist(), float).reshape(-1, len(QUALITY_NAMES)), rows["y"].to_numpy().astype(float)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, target: str = "quality", most: int = MOST_LABELLED) -> AdditiveModel:
    return fit_additive(*feature_rows(labelled_sample(docs, labels, target, learn, most)))


def score(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) of every text."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", FEATURE_BYTES):
            p = sigmoid(model.raw(quality_features(batch.column("_text"))))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(p, pa.float64())], ["_id", "score"])

    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)
