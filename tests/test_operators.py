"""Hand-computed answers, one group for each rule that is easy to get wrong."""

from datetime import date, datetime, timezone
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion_marts import schemas
from medallion_marts.functions.fiscal import fiscal_start, fiscal_year, next_fiscal_label
from medallion_marts.functions.values import sum_where
from medallion_marts.operators.joins import default_join
from medallion_marts.operators.latest import conform, latest_by_max, latest_state
from medallion_marts.operators.windows import arrears, change_flags, prior_period, running_totals
from medallion_marts.plans import backfill, dimensions, marts, views
from medallion_marts.sources.catalog import FrameCatalog


def t(text):
    return datetime.fromisoformat(text)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_latest_before_filter_and_ties(spark):
    df = spark.createDataFrame([("a", 1, "ACTIVE", 1), ("a", 2, "INACTIVE", 1), ("b", 5, "OLD", 1), ("b", 5, "ACTIVE", 2), ("c", None, "ACTIVE", 1)], "k string, v int, status string, at int")
    newest = latest_state(df, ["k"], "v", ["at"])
    assert rows(newest.where("status = 'ACTIVE'"), "k") == [("b",), ("c",)]
    by_max = latest_by_max(df, ["k"], "v", ["at"])
    assert by_max.columns == df.columns and rows(newest) == rows(by_max)


def test_latest_prunes_before_the_shuffle(spark):
    plan = latest_state(spark.range(10).withColumn("k", F.col("id") % 3), ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.permutations([("a", 1, 1), ("a", 3, 2), ("a", 3, 1), ("b", 2, 9), ("b", 1, 9)]))
def test_latest_ignores_order(spark, data):
    df = spark.createDataFrame(data, "k string, v int, at int").repartition(3)
    assert rows(latest_state(df, ["k"], "v", ["at"])) == [("a", 3, 2), ("b", 2, 9)]


def test_fiscal_years(spark):
    cases = {"2024-03-31 23:59:59.999": "2023-24", "2024-04-01 00:00:00": "2024-25", "1999-04-01": "1999-00", "1970-01-01": "1969-70"}
    df = spark.createDataFrame([(t(k),) for k in cases], "x timestamp")
    assert [r[0] for r in df.select(fiscal_year(F.col("x"))).collect()] == list(cases.values())
    assert spark.range(1).select(next_fiscal_label(F.lit(1998)), fiscal_start(F.lit("2023-24"))).first()[:] == ("1999-00", 2023)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.range(1).select(fiscal_start(F.lit(""))).collect()


def test_conform_fills_defaults(spark):
    spec = schemas.ENTITIES["property_address"]
    row = conform(spark.createDataFrame([(None, "x")], "tenant_id string, other string"), spec.schema, spec.defaults).first()
    assert (row.tenant_id, row.country, row.no_of_floors, row.land_area, row.created_time) == ("", "IN", 0, D("0.00"), datetime(1970, 1, 1))


def test_default_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    right = spark.createDataFrame([("a", "r"), ("c", "s")], "k string, y string")
    assert rows(default_join(left, right, ["k"])) == [("a", 1, "r"), ("b", 2, "")]
    assert rows(default_join(left, right, ["k"], "full")) == [("a", 1, "r"), ("b", 2, ""), ("c", 0, "s")]
    with pytest.raises(ValueError):
        default_join(left, right, ["k"], "inner")


def test_sum_where_without_hits_is_zero(spark):
    assert spark.range(3).agg(sum_where(F.col("id"), F.col("id") > 5)).first()[0] == 0


def test_change_flags(spark):
    data = [("p", 1, "x", 1, 1), ("p", 2, "x", 1, 2), ("p", 3, "y", 1, 2), ("q", 1, "x", 1, 1)]
    out = change_flags(spark.createDataFrame(data, "k string, at int, c string, a int, b int"), ["k"], ["at"], {"c_changed": ["c"], "area": ["a", "b"]})
    assert rows(out, "k", "at", "c_changed", "area") == [("p", 1, 0, 0), ("p", 2, 0, 1), ("p", 3, 1, 0), ("q", 1, 0, 0)]


def test_risk_thresholds(spark):
    def metrics(prop, ownership, area, workflow):
        return [("T", prop, "B", int(k < ownership), 0, int(k < area), int(k < workflow), 0, t("2024-05-01")) for k in range(4)]

    data = [r for p, o, a, w in (("at", 1, 2, 1), ("own", 2, 0, 0), ("area", 0, 3, 0), ("flow", 0, 0, 2)) for r in metrics(p, o, a, w)]

    class Cat(FrameCatalog):
        def mart(self, name):
            return self.frames[name]

    cat = Cat(spark, {"property_change_metrics": spark.createDataFrame(data, schemas.mart_schema("property_change_metrics"))})
    assert rows(marts.property_risk_summary(cat), "property_id", "total_updates", "risk_score") == [("area", 3, 1), ("at", 4, 0), ("flow", 2, 1), ("own", 2, 1)]
    by_fy = marts.property_changes_by_fy(cat)
    assert by_fy.agg(F.sum("total_updates")).first()[0] == 11 and by_fy.first().financial_year == "2024-25"


def test_running_totals_end_at_the_whole(spark):
    df = spark.createDataFrame([("T", m, m * 10) for m in (1, 2, 3)], "k string, m int, v int")
    out = running_totals(df, ["k"], ["m"], {"v": ("so_far", "total")})
    assert rows(out, "m", "so_far", "total") == [(1, 10, 60), (2, 30, 60), (3, 60, 60)]


BASE = [("T", "2021-22", 1), ("T", "2023-24", 10), ("T", "2025-26", 100), ("S", "2024-25", 7)]


def base(spark):
    df = spark.createDataFrame(BASE, "tenant_id string, financial_year string, v int")
    money = F.col("v").cast("decimal(18,2)")
    return df.select("tenant_id", "financial_year", money.alias("total_demand"), money.alias("total_collection"), money.cast("decimal(18,4)").alias("total_outstanding"), fiscal_start(F.col("financial_year")).alias("fy_start"))


def test_arrears_with_gaps_filter_and_added_year(spark):
    out = arrears(base(spark), ["tenant_id"], ["demand", "collection", "outstanding"], 2023)
    assert rows(out, "tenant_id", "financial_year", "total_demand", "last_year_demand", "arrears_demand") == [
        ("S", "2024-25", 7, 0, 0),
        ("S", "2025-26", 0, 7, 7),
        ("T", "2023-24", 10, 0, 0),
        ("T", "2025-26", 100, 0, 10),
        ("T", "2026-27", 0, 100, 100),
    ]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_prior_period(spark):
    data = [("T", "CASH", "2023-24", 1), ("T", "CASH", "2024-25", 2), ("T", "CARD", "2023-24", 5), ("T", "ONLINE", "2024-25", 9)]
    df = spark.createDataFrame(data, "k string, mode string, financial_year string, n int").withColumn("fy_start", fiscal_start(F.col("financial_year")))
    out = prior_period(df, ["k", "mode"], {"n": "last_n"})
    assert rows(out, "mode", "financial_year", "n", "last_n") == [("CARD", "2023-24", 5, 0), ("CARD", "2024-25", 0, 5), ("CASH", "2023-24", 1, 0), ("CASH", "2024-25", 2, 1), ("CASH", "2025-26", 0, 2), ("ONLINE", "2024-25", 9, 0), ("ONLINE", "2025-26", 0, 9)]


PAYMENT = "tenant_id string, payment_id string, billid string, transaction_date timestamp, created_time timestamp, financial_year string, payment_mode string, payment_status string, businessservice string, total_due decimal(12,2), total_amount_paid decimal(12,2), last_modified_time timestamp"


def payment(k, bill, txn, created, fy="x", status="NEW", due="10", paid="10"):
    return ("T", k, bill, t(txn), t(created), fy, "CASH", status, "PT", D(due), D(paid), t(created))


def catalog(spark, **frames):
    return FrameCatalog(spark, frames)


def test_months_by_transaction_year_and_creation_month(spark):
    cat = catalog(spark, payment=spark.createDataFrame([payment("1", "b", "2024-03-31", "2024-04-02", fy="stored")], PAYMENT))
    assert rows(marts.collections_by_month(cat), "financial_year", "year_month", "total_payments") == [("2023-24", "2024-04", 1)]
    assert rows(marts.daily_collection_summary(cat), "collection_date") == [(date(2024, 4, 2),)]
    v = views.cumulative_collections_by_month(cat).first()
    assert (v.month_date, v.cumulative_payments, v.fy_total_payments) == (date(2024, 4, 1), 1, 1)


def test_payments_without_bill_or_property(spark):
    pay = spark.createDataFrame([payment("1", "b1", "2024-05-01", "2024-05-01", paid="4"), payment("2", "none", "2024-05-01", "2024-05-01"), payment("3", "b2", "2024-05-01", "2024-05-01")], PAYMENT)
    bill = spark.createDataFrame([("T", "b1", "p1", t("2024-01-01")), ("T", "b2", "gone", t("2024-01-01"))], "tenant_id string, bill_id string, consumercode string, last_modified_time timestamp")
    prop = spark.createDataFrame([("T", "p1", "BUILTUP", t("2024-01-01")), ("T", "", "EMPTY", t("2024-01-01"))], "tenant_id string, property_id string, property_type string, last_modified_time timestamp")
    out = marts.payment_summary_by_fy(catalog(spark, payment=pay, bill=bill, property_address=prop))
    # A payment without a bill has property '' and so finds the property that is called ''.
    assert rows(out, "property_type", "total_payments", "total_part_payments", "total_amount_collected_in_part_payments") == [("", 1, 0, D("0.00")), ("BUILTUP", 1, 1, D("4.00")), ("EMPTY", 1, 0, D("0.00"))]


def test_two_payments_on_a_bill_count_twice(spark):
    pay = spark.createDataFrame([payment("1", "b", "2024-05-01", "2024-05-01", fy="2024-25"), payment("2", "b", "2024-05-01", "2024-05-01", fy="2024-25"), payment("3", "b", "2024-05-01", "2024-05-01", status="CANCELLED")], PAYMENT)
    detail = spark.createDataFrame([("T", k, "b", D("3"), "2023-24", t("2024-01-01")) for k in "xy"], "tenant_id string, id string, bill_id string, amount_paid decimal(12,2), financial_year string, last_modified_time timestamp")
    out = marts.collection_by_transaction_fy_and_demand_fy(catalog(spark, payment=pay, bill_detail=detail))
    assert rows(out) == [("T", "2024-25", "2023-24", D("12.0000"))]


def test_raw_versions_count_every_version(spark):
    pay = spark.createDataFrame([payment("1", "b", "2024-05-01", "2024-05-01"), payment("1", "b", "2024-05-01", "2024-05-02")], PAYMENT)
    bill = spark.createDataFrame([("T", "b", "p", t("2024-01-01"))], "tenant_id string, bill_id string, consumercode string, last_modified_time timestamp")
    cat = catalog(spark, payment=pay, bill=bill)
    assert marts.property_payment_mode_by_fy(cat).first().total_payments == 1
    assert marts.property_payment_mode_by_fy(cat, raw_versions=True).first().total_payments == 2


def test_owners_with_two_types_multiply_assessments(spark):
    when = t("2024-01-01")
    a = spark.createDataFrame([("T", "1", "2023-24", "p", "ACTIVE", "WEB", "U1", when), ("T", "2", "2023-24", "q", "ACTIVE", "WEB", "", when)], "tenant_id string, assessmentnumber string, financialyear string, propertyid string, status string, channel string, created_by string, last_modified_time timestamp")
    o = spark.createDataFrame([("T", "o1", "p", "U1", "A", when), ("T", "o2", "p", "U2", "B", when), ("T", "o3", "q", "", "A", when)], "tenant_id string, owner_info_uuid string, property_id string, user_id string, property_type string, last_modified_time timestamp")
    out = marts.assessment_summary_by_fy(catalog(spark, assessment=a, property_owner=o))
    # An owner without a user counts as no match.
    assert rows(out, "property_type", "total_assessments", "assessments_by_owner", "assessments_by_others") == [("A", 2, 1, 1), ("B", 1, 1, 0)]


def test_average_is_rounded_or_cut(spark):
    d = spark.createDataFrame([("T", str(k), "p", "PT", "ACTIVE", "2023-24", D(v), D("0"), t("2024-01-01")) for k, v in enumerate(("-0.0001", "-0.0002"))], "tenant_id string, demand_id string, consumer_code string, business_service string, demand_status string, financial_year string, pt_time_rebate decimal(18,4), pt_adhoc_rebate decimal(18,4), last_modified_time timestamp")
    p = spark.createDataFrame([], "tenant_id string, property_id string, property_type string, last_modified_time timestamp")
    cat = catalog(spark, demand=d, property_address=p)
    assert marts.rebate_summary_by_fy(cat).first().avg_rebate_amount == D("0.0002")
    assert marts.rebate_summary_by_fy(cat, strict=True).first().avg_rebate_amount == D("0.0001")


def test_backfill_takes_a_header_whole(spark):
    h = spark.createDataFrame([("T", "d", "old", t("2024-01-01"), 9), ("T", "d", "new", t("2024-02-01"), 1)], "tenant_id string, demand_id string, consumer_code string, last_modified_time timestamp, version int")
    d = spark.createDataFrame([("T", "d", "x", t("2024-03-05"), 3), ("T", "d", "y", t("2024-04-05"), 12), ("T", "none", "z", t("2024-04-05"), 1)], "tenant_id string, demand_id string, demand_detail_id string, last_modified_time timestamp, version int")
    assert rows(backfill.months_with_data(d)) == [("202403",), ("202404",)]
    assert rows(backfill.backfill_demand_details(d, h), "demand_detail_id", "consumer_code", "version") == [("x", "new", 9), ("y", "new", 12)]
    assert rows(backfill.backfill_demand_details(d, h, ["202404"]), "demand_detail_id") == [("y",)]


def test_backfill_write_replaces_its_months_only(spark, tmp_path):
    df = spark.createDataFrame([("a", "202403"), ("b", "202404")], "x string, month string")
    backfill.write_backfill(df, str(tmp_path / "out"))
    backfill.write_backfill(spark.createDataFrame([("c", "202404")], "x string, month string"), str(tmp_path / "out"))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "x") == [("a",), ("c",)]


def test_localize(spark):
    labels = spark.createDataFrame([("A", "en", "old", t("2023-01-01")), ("A", "en", "new", t("2024-01-01")), ("A", "hi", "other", t("2024-01-01"))], schemas.DIMENSION.schema)
    out = dimensions.localize(spark.createDataFrame([("A",), ("B",)], "code_x string"), labels, "code_x", "en")
    assert rows(out) == [("A", "new"), ("B", "B")]
