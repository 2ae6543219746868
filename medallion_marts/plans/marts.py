"""The sixteen marts, each a frame over the newest state of the entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.fiscal import day_of, fiscal_year, year_month
from ..functions.values import count_where, sum_where
from ..operators.joins import default_join
from ..operators.latest import conform
from ..operators.windows import change_flags
from .silver import FLAGS

PROPERTY_TAX = "PT"


def _mart(name: str, df: DataFrame) -> DataFrame:
    return conform(df, schemas.mart_schema(name))


def _demands(cat, *conditions) -> DataFrame:
    """Active property-tax demands in their newest state. Conditions stay behind the choice of versions."""
    df = cat.latest("demand").where((F.col("business_service") == PROPERTY_TAX) & (F.col("demand_status") == "ACTIVE"))
    for c in conditions:
        df = df.where(c)
    return df


def active_property_distribution_summary(cat) -> DataFrame:
    keys = ["tenant_id", "property_type", "ownership_category", "usage_category"]
    df = cat.latest("property_address").where("status = 'ACTIVE'").groupBy(*keys).agg(F.count("*").alias("property_count"))
    return _mart("active_property_distribution_summary", df)


def new_properties_by_fy(cat) -> DataFrame:
    df = cat.latest("property_address").where("created_time IS NOT NULL AND status = 'ACTIVE'")
    return _mart("new_properties_by_fy", df.groupBy("tenant_id", "financial_year").agg(F.count("property_id").alias("new_property_count")))


def demand_and_collection_summary(cat) -> DataFrame:
    sums = {"total_demand": "total_tax_amount", "total_collection": "total_collection_amount", "total_outstanding": "outstanding_amount"}
    df = _demands(cat, F.col("financial_year") != "").groupBy("tenant_id", "financial_year")
    return _mart("demand_and_collection_summary", df.agg(*[F.sum(c).alias(name) for name, c in sums.items()]))


def collections_by_month(cat) -> DataFrame:
    """By the fiscal year of the transaction, not the stored one, and the month of creation."""
    df = cat.latest("payment").where(F.col("businessservice") == PROPERTY_TAX)
    df = df.select("tenant_id", fiscal_year(F.col("transaction_date"), zone=cat.zone).alias("fy"), year_month(F.col("created_time"), cat.zone).alias("year_month"), "payment_status", "total_amount_paid")
    df = df.groupBy("tenant_id", "fy", "year_month", "payment_status").agg(F.count("*").alias("total_payments"), F.sum("total_amount_paid").alias("total_collected_amount"))
    return _mart("collections_by_month", df.withColumnRenamed("fy", "financial_year"))


def properties_with_demand_by_fy(cat) -> DataFrame:
    """A row for each demand: properties repeat."""
    df = _demands(cat, F.col("financial_year") != "")
    return _mart("properties_with_demand_by_fy", df.withColumnRenamed("consumer_code", "properties_with_demand"))


def defaulters(cat) -> DataFrame:
    df = _demands(cat, F.col("outstanding_amount") > 0)
    return _mart("defaulters", df.withColumnRenamed("consumer_code", "property_id"))


def property_change_metrics(cat) -> DataFrame:
    """What changed from a property's audit snapshot to the next; as stored, if nights have stored it."""
    if (stored := cat.change_metrics()) is not None:
        return _mart("property_change_metrics", stored)
    audit = cat.versions("property_audit")
    ties = [c for c in audit.columns if c == "_ingested_at" or c.startswith("_tie")]
    return _mart("property_change_metrics", change_flags(audit, ["tenant_id", "property_id"], ["audit_created_time", *ties], FLAGS))


def _change_sums(df: DataFrame) -> DataFrame:
    names = {
        "ownership_changes": "ownership_category_changed",
        "area_changes": "area_changed",
        "workflow_reopens": "workflow_state_changed",
        "usage_category_changes": "usage_category_changed",
        "owner_count_changed": "owners_changed",
    }
    out = df.agg(*[F.sum(c).alias(name) for name, c in names.items()])
    return out.withColumn("total_updates", sum((F.col(n) for n in names), F.lit(0)))


def property_risk_summary(cat) -> DataFrame:
    """A property that changed its type has a row for each."""
    df = _change_sums(cat.mart("property_change_metrics").groupBy("tenant_id", "property_id", "property_type"))
    risky = (F.col("ownership_changes") > 1) | (F.col("area_changes") > 2) | (F.col("workflow_reopens") > 1)
    return _mart("property_risk_summary", df.withColumn("risk_score", risky.cast("int")))


def property_changes_by_fy(cat) -> DataFrame:
    df = cat.mart("property_change_metrics").withColumn("financial_year", fiscal_year(F.col("audit_created_time"), zone=cat.zone))
    return _mart("property_changes_by_fy", _change_sums(df.groupBy("tenant_id", "property_type", "financial_year")))


def property_demand_vs_assessed_by_fy(cat) -> DataFrame:
    """Properties with a demand, with an assessment, and with one but not the other."""
    keys = ["tenant_id", "financial_year", "property_id"]
    demand = cat.mart("properties_with_demand_by_fy").select("tenant_id", "financial_year", F.col("properties_with_demand").alias("property_id")).distinct()
    assessed = cat.latest("assessment").where("status = 'ACTIVE'").select("tenant_id", F.col("financialyear").alias("financial_year"), F.col("propertyid").alias("property_id")).distinct()
    both = default_join(demand.withColumn("in_demand", F.col("property_id")), assessed.withColumn("in_assessed", F.col("property_id")), keys, "full")
    has_demand, has_assessment = F.col("in_demand") != "", F.col("in_assessed") != ""
    return _mart(
        "property_demand_vs_assessed_by_fy",
        both.groupBy("tenant_id", "financial_year").agg(
            count_where(has_assessment).alias("total_properties_assessed"),
            count_where(has_demand).alias("total_properties_with_demand"),
            count_where(has_demand & ~has_assessment).alias("total_properties_with_demand_no_assessment"),
            count_where(has_assessment & ~has_demand).alias("total_properties_with_assessment_no_demand"),
        ),
    )


def assessment_summary_by_fy(cat) -> DataFrame:
    """Assessments by owners and by others. A property whose owners' rows name several types counts under each."""
    a = cat.latest("assessment").where("status = 'ACTIVE' AND financialyear != ''")
    a = a.select("tenant_id", F.col("financialyear").alias("financial_year"), F.col("propertyid").alias("property_id"), "channel", F.col("created_by").alias("user_id"))
    owners = cat.latest("property_owner")
    types = owners.select("tenant_id", "property_id", "property_type").distinct()
    users = owners.select("tenant_id", "property_id", "user_id").distinct().withColumn("owner", F.col("user_id"))
    joined = default_join(default_join(a, types, ["tenant_id", "property_id"]), users, ["tenant_id", "property_id", "user_id"])
    return _mart(
        "assessment_summary_by_fy",
        joined.groupBy("tenant_id", "financial_year", "property_type", "channel").agg(
            F.count("*").alias("total_assessments"),
            count_where(F.col("owner") != "").alias("assessments_by_owner"),
            count_where(F.col("owner") == "").alias("assessments_by_others"),
        ),
    )


def payment_summary_by_fy(cat) -> DataFrame:
    """Payments by the fiscal year of the transaction; a payment below what is due is a part payment."""
    p = cat.latest("payment").where(F.col("businessservice") == PROPERTY_TAX)
    p = p.select("tenant_id", F.col("billid").alias("bill_id"), fiscal_year(F.col("transaction_date"), zone=cat.zone).alias("financial_year"), "payment_mode", "total_amount_paid", "total_due")
    bills = cat.latest("bill").select("tenant_id", "bill_id", F.col("consumercode").alias("property_id"))
    types = cat.latest("property_address").select("tenant_id", "property_id", "property_type")
    joined = default_join(default_join(p, bills, ["tenant_id", "bill_id"]), types, ["tenant_id", "property_id"])
    part = F.col("total_amount_paid") < F.col("total_due")
    return _mart(
        "payment_summary_by_fy",
        joined.groupBy("tenant_id", "financial_year", "property_type", "payment_mode").agg(
            F.count("*").alias("total_payments"),
            F.sum("total_amount_paid").alias("total_amount_collected"),
            count_where(part).alias("total_part_payments"),
            sum_where(F.col("total_amount_paid"), part).alias("total_amount_collected_in_part_payments"),
        ),
    )


def rebate_summary_by_fy(cat, strict: bool = False) -> DataFrame:
    """Rebates of demands that have any. The average is rounded; strict cuts it off after four places."""
    d = _demands(cat, F.col("financial_year") != "", (F.col("pt_time_rebate") != 0) | (F.col("pt_adhoc_rebate") != 0))
    d = d.select("tenant_id", F.col("consumer_code").alias("property_id"), "financial_year", (F.abs("pt_time_rebate") + F.abs("pt_adhoc_rebate")).alias("rebate"))
    types = cat.latest("property_address").select("tenant_id", "property_id", "property_type")
    g = default_join(d, types, ["tenant_id", "property_id"]).groupBy("tenant_id", "financial_year", "property_type")
    average = F.avg("rebate")
    if strict:
        average = F.floor(average * 10000) / 10000
    return _mart("rebate_summary_by_fy", g.agg(average.alias("avg_rebate_amount"), F.sum("rebate").alias("total_rebate_amount"), F.count("*").alias("demands_with_rebate")))


def daily_collection_summary(cat) -> DataFrame:
    p = cat.latest("payment").where(F.col("businessservice") == PROPERTY_TAX).withColumn("collection_date", day_of(F.col("created_time"), cat.zone))
    return _mart("daily_collection_summary", p.groupBy("tenant_id", "payment_status", "collection_date").agg(F.sum("total_amount_paid").alias("total_amount")))


def property_payment_mode_by_fy(cat, raw_versions: bool = False) -> DataFrame:
    """Payments by property and mode. raw_versions counts every stored version instead of the newest."""
    read = cat.versions if raw_versions else cat.latest
    p = read("payment").where(F.col("businessservice") == PROPERTY_TAX).select("tenant_id", F.col("billid").alias("bill_id"), "payment_mode", "financial_year")
    b = read("bill").select("tenant_id", "bill_id", F.col("consumercode").alias("property_id"))
    df = p.join(b, ["tenant_id", "bill_id"]).groupBy("tenant_id", "property_id", "payment_mode", "financial_year").agg(F.count("*").alias("total_payments"))
    return _mart("property_payment_mode_by_fy", df)


def collection_by_transaction_fy_and_demand_fy(cat) -> DataFrame:
    """Two payments on one bill count its details twice."""
    p = cat.latest("payment").where((F.col("businessservice") == PROPERTY_TAX) & (F.col("payment_status") != "CANCELLED"))
    p = p.select("tenant_id", F.col("billid").alias("bill_id"), F.col("financial_year").alias("transaction_financial_year"))
    d = cat.latest("bill_detail").select("tenant_id", "bill_id", F.col("financial_year").alias("bill_financial_year"), "amount_paid")
    df = p.join(d, ["tenant_id", "bill_id"]).groupBy("tenant_id", "transaction_financial_year", "bill_financial_year").agg(F.sum("amount_paid").alias("total_amount_paid"))
    return _mart("collection_by_transaction_fy_and_demand_fy", df)


#: In an order in which every mart comes after those it reads.
MARTS = {
    f.__name__: f
    for f in (
        active_property_distribution_summary,
        new_properties_by_fy,
        demand_and_collection_summary,
        collections_by_month,
        properties_with_demand_by_fy,
        defaulters,
        property_change_metrics,
        property_risk_summary,
        property_changes_by_fy,
        property_demand_vs_assessed_by_fy,
        assessment_summary_by_fy,
        payment_summary_by_fy,
        rebate_summary_by_fy,
        daily_collection_summary,
        property_payment_mode_by_fy,
        collection_by_transaction_fy_and_demand_fy,
    )
}
