"""Defaults for missing values, conditional aggregates, and the tax-head pivot."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, StringType, TimestampNTZType, TimestampType


def default_of(kind: DataType) -> Column:
    """The value that stands for a missing one."""
    if isinstance(kind, StringType):
        return F.lit("")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.timestamp_millis(F.lit(0)).cast(kind)
    if isinstance(kind, DateType):
        return F.lit("1970-01-01").cast(kind)
    if isinstance(kind, BooleanType):
        return F.lit(False)
    return F.lit(0).cast(kind)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(value: Column, condition: Column) -> Column:
    """A sum that is 0 where nothing qualifies."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def millis(epoch: Column) -> Column:
    """Epoch milliseconds to a time; missing ones are the epoch."""
    return F.timestamp_millis(F.coalesce(epoch, F.lit(0)))


AMOUNT = "decimal(18,4)"


def _head(detail: Column) -> Column:
    return F.coalesce(detail["taxHeadMasterCode"], F.lit(""))


def heads_of(details: Column) -> Column:
    """The different heads of an event's details; a missing one is empty."""
    return F.coalesce(F.array_distinct(F.transform(details, _head)), F.array().cast("array<string>"))


def head_sums(details: Column, heads: Column, name: str) -> Column:
    """A map from each head to its sum of amounts, given as text, within the row: no explode, no shuffle. What is no number is 0.

    Spark interprets functions over arrays, where making a struct costs more than a sum, so none is made.
    """
    zero = F.lit(0).cast(AMOUNT)
    plus = lambda total, d: (total + F.coalesce(d[name].try_cast(AMOUNT), zero)).cast(AMOUNT)
    of = lambda h: F.aggregate(details, zero, lambda total, d: F.when(_head(d) == h, plus(total, d)).otherwise(total))
    return F.map_from_arrays(heads, F.transform(heads, of))


def total_of(sums: Column) -> Column:
    return F.aggregate(F.map_values(sums), F.lit(0).cast(AMOUNT), lambda total, d: (total + d).cast(AMOUNT))


def pivot_heads(sums: Column, heads: tuple[str, ...], suffix: str = "") -> list[Column]:
    """One column for each head from `head_sums`."""
    return [F.coalesce(sums[head], F.lit(0).cast(AMOUNT)).alias(head.lower() + suffix) for head in heads]
