"""Change flags, running totals, arrears and the prior period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.fiscal import next_fiscal_label


def change_flags(df: DataFrame, keys: list[str], order: list[str], groups: dict[str, list[str]]) -> DataFrame:
    """For each group of columns a flag that is 1 where any differs from the row before; first rows have 0."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df
    for flag, columns in groups.items():
        changed = F.lit(False)
        for c in columns:
            changed = changed | (F.col(c) != F.coalesce(F.lag(c, 1).over(w), F.col(c)))
        out = out.withColumn(flag, changed.cast("int"))
    return out


def running_totals(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, tuple[str, str]]) -> DataFrame:
    """columns: value -> (name of its running sum, name of its sum over the keys)."""
    whole = Window.partitionBy(*keys)
    running = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for value, (so_far, total) in columns.items():
        df = df.withColumn(so_far, F.sum(value).over(running)).withColumn(total, F.sum(value).over(whole))
    return df


def arrears(df: DataFrame, keys: list[str], columns: list[str], min_start: int) -> DataFrame:
    """Per key and fiscal year: totals, last year's, and those of all earlier years from min_start on.

    df has `fy_start` and `financial_year`. The year after a key's last one is added, without
    totals of its own; its last year and its arrears are both that last year's totals.
    Window frames by range of years, so no self-join.
    """
    base = df.where(F.col("fy_start") >= min_start)
    w = Window.partitionBy(*keys).orderBy("fy_start")
    year, before = w.rangeBetween(-1, -1), w.rangeBetween(Window.unboundedPreceding, -1)
    out = base.withColumn("_last", F.max("fy_start").over(Window.partitionBy(*keys)))
    for c in columns:
        out = out.withColumn(f"last_year_{c}", F.coalesce(F.sum(f"total_{c}").over(year), F.lit(0)))
        out = out.withColumn(f"arrears_{c}", F.coalesce(F.sum(f"total_{c}").over(before), F.lit(0)))
    # The added row comes out of each key's last one, so the base is read once.
    kinds = {f.name: f.dataType for f in out.schema.fields}
    own = F.struct(F.col("financial_year"), *[F.col(f"{p}_{c}").cast(kinds[f"total_{c}"]).alias(f"{p}_{c}") for p in ("total", "last_year", "arrears") for c in columns])
    nothing = lambda c: F.lit(0).cast(kinds[f"total_{c}"])
    added = F.struct(
        next_fiscal_label(F.col("fy_start")).alias("financial_year"),
        *[nothing(c).alias(f"total_{c}") for c in columns],
        *[F.col(f"total_{c}").alias(f"{p}_{c}") for p in ("last_year", "arrears") for c in columns],
    )
    rows = F.when(F.col("fy_start") == F.col("_last"), F.array(own, added)).otherwise(F.array(own))
    return out.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")


def prior_period(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Rows joined with those of the fiscal year before; columns: value -> name for last year's.

    A row without one in the next year gives one there, with zero values of its own.
    """
    now = df.select(*keys, "fy_start", "financial_year", *columns)
    then = df.select(*keys, (F.col("fy_start") + 1).alias("fy_start"), next_fiscal_label(F.col("fy_start")).alias("_label"), *[F.col(c).alias(name) for c, name in columns.items()])
    joined = now.join(then, [*keys, "fy_start"], "full")
    value = lambda c: F.coalesce(c, F.lit(0).cast(joined.schema[c].dataType)).alias(c)
    return joined.select(*keys, F.coalesce("financial_year", "_label").alias("financial_year"), *[value(c) for c in columns], *[value(c) for c in columns.values()])
