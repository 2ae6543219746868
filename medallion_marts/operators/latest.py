"""The newest version of each key, and conforming to a schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..functions.values import default_of


def latest_state(df: DataFrame, keys: Iterable[str], version: str | Iterable[str], tie_break: Iterable[str] = ()) -> DataFrame:
    """One row for each key: the one with the greatest version, ties going to the greatest of tie_break.

    Filters on other than key columns belong after this, or older versions come back. Spark
    prunes with a partial window limit before the shuffle, so a hot key sends one row a task.
    """
    version = [version] if isinstance(version, str) else list(version)
    order = [F.col(c).desc_nulls_last() for c in [*version, *tie_break]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def latest_by_max(df: DataFrame, keys: Iterable[str], version: str | Iterable[str], tie_break: Iterable[str] = ()) -> DataFrame:
    """`latest_state` as an aggregate: the row with the greatest version, combined before the shuffle.

    Whole rows in aggregation buffers make Spark sort before and after the shuffle; `bench.py` times
    both forms. A null version counts as less than any other, as it does there.
    """
    keys, version = list(keys), [version] if isinstance(version, str) else list(version)
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version, *tie_break)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.`{c}`") for c in df.columns])


def conform(df: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """Columns by name, cast to the schema; missing columns and nulls become defaults."""
    there, defaults = set(df.columns), defaults or {}
    out = []
    for f in schema.fields:
        missing = F.lit(defaults[f.name]).cast(f.dataType) if f.name in defaults else default_of(f.dataType)
        out.append((F.coalesce(F.col(f"`{f.name}`").cast(f.dataType), missing) if f.name in there else missing).alias(f.name))
    return df.select(*out)
