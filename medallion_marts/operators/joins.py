"""Outer joins whose unmatched side takes default values instead of nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import default_of


def default_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", fills: dict | None = None) -> DataFrame:
    """A left or full equi-join on same-named columns; the filled columns can be used in further joins at once."""
    if how not in ("left", "full"):
        raise ValueError(f"how must be left or full, not {how!r}")
    fills = fills or {}
    joined = left.join(right, on, how)
    from_right = {f.name: f.dataType for f in right.schema.fields if f.name not in on}
    fillable = dict(from_right)
    if how == "full":
        fillable |= {f.name: f.dataType for f in left.schema.fields if f.name not in on}
    return joined.select(*[F.coalesce(F.col(c), F.lit(fills[c]) if c in fills else default_of(fillable[c])).alias(c) if c in fillable else F.col(c) for c in joined.columns])
