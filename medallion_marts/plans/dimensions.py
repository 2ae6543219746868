"""Labels of codes by locale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators.latest import latest_state

#: A dimension's labels of one locale are broadcast up to this many.
BROADCAST_LABELS = 200_000


def latest_labels(dimension: DataFrame) -> DataFrame:
    ties = [c for c in dimension.columns if c.startswith("_tie")]
    return latest_state(dimension, schemas.DIMENSION.keys, schemas.DIMENSION.version, ties or ["value"])


def localize(df: DataFrame, dimension: DataFrame, code_col: str, locale: str, label_col: str | None = None) -> DataFrame:
    """df with the label of a code in a locale; the code itself where there is none."""
    labels = latest_labels(dimension.where(F.col("locale") == locale)).select(F.col("code").alias("_code"), F.col("value").alias("_label"))
    if labels.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        labels = F.broadcast(labels)
    name = label_col or f"{code_col}_label"
    return df.join(labels, F.col(code_col) == F.col("_code"), "left").withColumn(name, F.coalesce("_label", F.col(code_col))).drop("_code", "_label")
