"""Backfill of demand details, joined with the newest header of their demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fiscal import month_number
from ..operators.latest import latest_state

KEYS = ["tenant_id", "demand_id"]
HEADER = ["consumer_code", "consumer_type", "business_service", "payer", "tax_period_from", "tax_period_to", "status", "is_payment_completed", "financial_year", "minimum_amount_payable", "bill_expiry_time", "fixed_bill_expiry_date"]
DETAIL = ["event_time", *KEYS, "demand_detail_id", "tax_head_code", "tax_amount", "collection_amount", "created_by", "created_time", "last_modified_by", "last_modified_time"]


def months_with_data(details: DataFrame, zone: str | None = None) -> DataFrame:
    """(month) like 202404, of the details' modification."""
    return details.select(month_number(F.col("last_modified_time"), zone).alias("month")).distinct()


def backfill_demand_details(details: DataFrame, headers: DataFrame, months: list[str] | None = None, zone: str | None = None) -> DataFrame:
    """Details of the given months, or of all, with their demand's attributes and the greater version.

    A header is taken whole from its newest row; its version is the greatest of all its rows.
    """
    month = month_number(F.col("last_modified_time"), zone)
    d = details.where(month.isin(months)) if months is not None else details
    newest = latest_state(headers, KEYS, ["last_modified_time", "version"])
    greatest = headers.groupBy(*KEYS).agg(F.max("version").alias("header_version"))
    h = newest.select(*KEYS, *[c for c in HEADER if c in headers.columns]).join(greatest, KEYS)
    out = d.select(*[c for c in DETAIL if c in details.columns], "version", month.alias("month")).join(h, KEYS)
    return out.withColumn("version", F.greatest("version", "header_version")).drop("header_version").withColumnRenamed("status", "demand_status")


def write_backfill(rows: DataFrame, path: str, time_col: str = "last_modified_time") -> None:
    """Replaces the months that rows hold and leaves the others: a repeated run changes nothing.

    Rows are dealt by month before, large months to several tasks, and sorted by time (if they have
    one) within files: files a month do not grow with the tasks before, and row groups hold short
    spans of time.
    """
    by_month = rows.hint("rebalance", "month").sortWithinPartitions("month", *[c for c in (time_col,) if c in rows.columns])
    by_month.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
