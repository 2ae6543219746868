"""Dashboard views over marts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fiscal import fiscal_start
from ..operators.windows import arrears, prior_period, running_totals

#: The first fiscal year that arrears look at.
MIN_FY_START = 2023


def cumulative_collections_by_month(cat) -> DataFrame:
    """Running payments and amounts within each tenant's fiscal year, all statuses together."""
    base = cat.mart("collections_by_month").groupBy("tenant_id", "financial_year", "year_month").agg(F.sum("total_payments").alias("total_payments"), F.sum("total_collected_amount").alias("total_collected_amount"))
    base = base.select("tenant_id", "financial_year", F.to_date(F.concat("year_month", F.lit("-01"))).alias("month_date"), "total_payments", "total_collected_amount")
    return running_totals(
        base,
        ["tenant_id", "financial_year"],
        ["month_date"],
        {"total_payments": ("cumulative_payments", "fy_total_payments"), "total_collected_amount": ("cumulative_collected_amount", "fy_total_collected_amount")},
    )


def demand_collection_with_arrears(cat, min_fy_start: int = MIN_FY_START) -> DataFrame:
    """Each fiscal year with last year's totals and those of all earlier years, and one year to come."""
    base = cat.mart("demand_and_collection_summary").withColumn("fy_start", fiscal_start(F.col("financial_year")))
    return arrears(base, ["tenant_id"], ["demand", "collection", "outstanding"], min_fy_start)


def payment_summary_with_last_year(cat) -> DataFrame:
    """Payments by mode and type with last year's; ones without a counterpart this year appear with zeros."""
    base = cat.mart("payment_summary_by_fy").withColumn("fy_start", fiscal_start(F.col("financial_year")))
    names = {"total_payments": "last_year_total_payments", "total_amount_collected": "last_year_total_amount"}
    return prior_period(base, ["tenant_id", "payment_mode", "property_type"], names)


VIEWS = {f.__name__: f for f in (cumulative_collections_by_month, demand_collection_with_arrears, payment_summary_with_last_year)}


def _last_and_before(measures: tuple[str, ...]) -> str:
    return ", ".join(f"coalesce(sum(total_{m}) OVER ({frame}), 0) AS {name}_{m}" for name, frame in (("last_year", "year"), ("arrears", "before")) for m in measures)


_MEASURES = ("demand", "collection", "outstanding")
#: The views in SQL over marts by name; {..} are filled in by `view_sql`.
_SQL = {
    "cumulative_collections_by_month": """
WITH base AS (
  SELECT tenant_id, financial_year, to_date(concat(year_month, '-01')) AS month_date, sum(total_payments) AS total_payments, sum(total_collected_amount) AS total_collected_amount
  FROM {collections_by_month} GROUP BY tenant_id, financial_year, year_month)
SELECT *, sum(total_payments) OVER so_far AS cumulative_payments, sum(total_payments) OVER year AS fy_total_payments,
  sum(total_collected_amount) OVER so_far AS cumulative_collected_amount, sum(total_collected_amount) OVER year AS fy_total_collected_amount
FROM base
WINDOW year AS (PARTITION BY tenant_id, financial_year), so_far AS (PARTITION BY tenant_id, financial_year ORDER BY month_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "demand_collection_with_arrears": f"""
WITH base AS (SELECT *, CAST(substring(financial_year, 1, 4) AS INT) AS fy_start FROM {{demand_and_collection_summary}}),
whole AS (
  SELECT *, {_last_and_before(_MEASURES)}, max(fy_start) OVER (PARTITION BY tenant_id) AS last_start FROM base WHERE fy_start >= {{min_fy_start}}
  WINDOW year AS (PARTITION BY tenant_id ORDER BY fy_start RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING), before AS (PARTITION BY tenant_id ORDER BY fy_start RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT tenant_id, financial_year, {", ".join(f"CAST({p}_{m} AS DECIMAL(18,{4 if m == 'outstanding' else 2})) AS {p}_{m}" for p in ("total", "last_year", "arrears") for m in _MEASURES)} FROM whole
UNION ALL
SELECT tenant_id, concat(fy_start + 1, '-', substring(fy_start + 2, 3, 2)), {", ".join("0" for _ in _MEASURES)}, {", ".join(f"total_{m}" for _ in range(2) for m in _MEASURES)} FROM whole WHERE fy_start = last_start""",
    "payment_summary_with_last_year": """
WITH now AS (SELECT tenant_id, payment_mode, property_type, financial_year, CAST(substring(financial_year, 1, 4) AS INT) AS fy_start, total_payments, total_amount_collected FROM {payment_summary_by_fy}),
before AS (SELECT tenant_id, payment_mode, property_type, fy_start + 1 AS fy_start, total_payments AS payments, total_amount_collected AS amount FROM now)
SELECT tenant_id, payment_mode, property_type, coalesce(financial_year, concat(fy_start, '-', substring(fy_start + 1, 3, 2))) AS financial_year, coalesce(total_payments, 0) AS total_payments,
  coalesce(total_amount_collected, 0) AS total_amount_collected, coalesce(payments, 0) AS last_year_total_payments, coalesce(amount, 0) AS last_year_total_amount
FROM now FULL JOIN before USING (tenant_id, payment_mode, property_type, fy_start)""",
}


def view_sql(name: str, mart: Callable[[str], str], min_fy_start: int | None = None) -> str:
    """A view's query in Spark SQL; mart gives the name that a mart has in it."""
    marts = ("collections_by_month", "demand_and_collection_summary", "payment_summary_by_fy")
    return _SQL[name].format(**{m: mart(m) for m in marts}, min_fy_start=MIN_FY_START if min_fy_start is None else min_fy_start).strip()
