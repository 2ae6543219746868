"""The entities as views of order, customer and event tables, for tests and benchmarks.

Money is cast to decimals before any arithmetic. `_tie*` columns order versions of equal time.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.fiscal import fiscal_year
from ..operators.latest import conform
from .catalog import FrameCatalog

MONEY, RATE = "decimal(12,2)", "decimal(4,2)"
#: Added to some keys, which then match nothing in other tables.
STRANGE = 1_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that may come as one row group, and so as one task.
ONE_GROUP = 2_000_000


def _spread(df: DataFrame, rows: int) -> DataFrame:
    """df, made of a table of so many rows, over all cores; a large table has many tasks, and its rows are not moved once more."""
    return df if rows > ONE_GROUP else df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _tenant() -> Column:
    return F.concat(F.lit("T"), F.col("c_nationkey").cast("string"))


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _time(name: str) -> Column:
    return F.col(name).cast("timestamp")


def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumns({"price": F.col("l_extendedprice").cast(MONEY), "rate": F.col("l_discount").cast(RATE), "tax": F.col("l_tax").cast(RATE)})
    return lines.join(_ordered(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))


def _line_ties() -> list[Column]:
    return [F.col("l_partkey").alias("_tie1"), F.col("l_suppkey").alias("_tie2"), F.col("price").alias("_tie3")]


def _line_id() -> Column:
    return F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber"))


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, rate = F.col("price"), F.col("rate")
    return _lines(spark, sf_dir).select(
        _tenant().alias("tenant_id"),
        _line_id().alias("demand_id"),
        _text("o_custkey").alias("consumer_code"),
        F.when(F.col("l_returnflag") == "N", "WS").otherwise("PT").alias("business_service"),
        F.when(F.col("l_linestatus") == "O", "ACTIVE").otherwise("CANCELLED").alias("demand_status"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise(fiscal_year(F.col("o_orderdate"))).alias("financial_year"),
        price.alias("total_tax_amount"),
        (price * (1 - rate)).cast(MONEY).alias("total_collection_amount"),
        (price * rate).cast("decimal(18,4)").alias("outstanding_amount"),
        (-price * rate).cast("decimal(18,4)").alias("pt_time_rebate"),
        F.when(F.col("l_returnflag") == "R", (-price * F.col("tax")).cast("decimal(18,4)")).otherwise(F.lit(0).cast("decimal(18,4)")).alias("pt_adhoc_rebate"),
        _time("l_shipdate").alias("last_modified_time"),
        *_line_ties(),
    )


def property_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    # One in ten has a number that no other table knows.
    number = F.when(F.col("c_custkey") % 10 == 0, F.col("c_custkey") + STRANGE).otherwise(F.col("c_custkey"))
    common = [
        _tenant().alias("tenant_id"),
        number.cast("string").alias("property_id"),
        F.col("c_mktsegment").alias("property_type"),
        F.when(F.col("c_acctbal") >= 0, "INDIVIDUAL").otherwise("INSTITUTIONAL").alias("ownership_category"),
    ]
    year = fiscal_year(F.make_date((1995 + F.col("c_custkey") % 7).cast("int"), F.lit(6), F.lit(15))).alias("financial_year")
    base = F.to_timestamp(F.lit("1995-01-01"))
    first = c.select(*common, F.lit("RESIDENTIAL").alias("usage_category"), F.lit("ACTIVE").alias("status"), year, base.alias("created_time"), base.alias("last_modified_time"))
    e = c.join(table(spark, sf_dir, "events"), F.col("user_id") == F.col("c_custkey"))
    later = e.select(*common, F.upper("event_type").alias("usage_category"), F.when(F.col("event_type") == "error", "INACTIVE").otherwise("ACTIVE").alias("status"), year, base.alias("created_time"), _time("ts").alias("last_modified_time"))
    return first.unionByName(later)


def property_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    number = F.explode(F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("k")
    c = c.select("*", number)
    return c.select(
        _tenant().alias("tenant_id"),
        F.concat_ws("-", _text("c_custkey"), _text("k")).alias("owner_info_uuid"),
        _text("c_custkey").alias("property_id"),
        F.concat(F.lit("U"), (F.col("c_custkey") % 50).cast("string")).alias("user_id"),
        F.when((F.col("k") == 2) & (F.col("c_custkey") % 30 == 0), "OTHER").otherwise(F.col("c_mktsegment")).alias("property_type"),
        F.to_timestamp(F.lit("1995-01-01")).alias("last_modified_time"),
    )


def property_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    e = table(spark, sf_dir, "events").join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
    return e.select(
        _tenant().alias("tenant_id"),
        F.concat_ws("-", _text("user_id"), (F.col("event_id") % 40).cast("string")).alias("property_id"),
        F.col("c_mktsegment").alias("property_type"),
        F.col("event_type").alias("ownership_category"),
        (k % 3).cast("string").alias("usage_category"),
        F.floor(F.col("value") / 50).cast("decimal(18,2)").alias("super_built_up_area"),
        F.floor(F.col("value") / 100).cast("decimal(18,2)").alias("land_area"),
        (k % 2).cast("string").alias("workflow_state"),
        (F.col("event_id") % 3).cast("int").alias("owner_count"),
        _time("ts").alias("audit_created_time"),
        F.col("event_id").alias("_tie1"),
    )


def bill(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.when(F.col("o_orderkey") % 17 == 0, F.col("o_orderkey") + STRANGE).otherwise(F.col("o_orderkey"))
    return _ordered(spark, sf_dir).select(_tenant().alias("tenant_id"), number.cast("string").alias("bill_id"), _text("o_custkey").alias("consumercode"), _time("o_orderdate").alias("last_modified_time"))


def bill_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        _tenant().alias("tenant_id"),
        _line_id().alias("id"),
        _text("l_orderkey").alias("bill_id"),
        F.col("price").alias("amount_paid"),
        F.unix_millis(_time("l_shipdate")).alias("from_period"),
        fiscal_year(F.col("l_shipdate")).alias("financial_year"),
        _time("l_shipdate").alias("last_modified_time"),
        *_line_ties(),
    )


def payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = F.col("o_totalprice").cast(MONEY)
    return _ordered(spark, sf_dir).select(
        _tenant().alias("tenant_id"),
        _text("o_orderkey").alias("payment_id"),
        _text("o_orderkey").alias("billid"),
        _time("o_orderdate").alias("transaction_date"),
        (_time("o_orderdate") + F.expr("INTERVAL 10 DAYS")).alias("created_time"),
        fiscal_year(F.col("o_orderdate")).alias("financial_year"),
        F.col("o_orderpriority").alias("payment_mode"),
        F.when(F.col("o_orderstatus") == "F", "CANCELLED").when(F.col("o_orderstatus") == "O", "DEPOSITED").otherwise("NEW").alias("payment_status"),
        F.when(F.col("o_orderkey") % 5 == 0, "WS").otherwise("PT").alias("businessservice"),
        due.alias("total_due"),
        F.when(F.col("o_orderkey") % 3 == 0, (due - 100).cast(MONEY)).otherwise(due).alias("total_amount_paid"),
        _time("o_orderdate").alias("last_modified_time"),
    )


def assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ordered(spark, sf_dir).select(
        _tenant().alias("tenant_id"),
        _text("o_orderkey").alias("assessmentnumber"),
        F.when(F.col("o_orderkey") % 23 == 0, "").otherwise(fiscal_year(F.col("o_orderdate"))).alias("financialyear"),
        _text("o_custkey").alias("propertyid"),
        F.when(F.col("o_orderstatus") == "P", "INACTIVE").otherwise("ACTIVE").alias("status"),
        F.col("o_orderpriority").alias("channel"),
        F.concat(F.lit("U"), ((F.col("o_custkey") + F.col("o_orderkey") % 2) % 50).cast("string")).alias("created_by"),
        _time("o_orderdate").alias("last_modified_time"),
    )


def tenant_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation names as labels of tenants, region names as those of another locale; older labels below them."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    code = F.concat(F.lit("T"), _text("n_nationkey")).alias("code")
    new, old = F.to_timestamp(F.lit("2024-01-01")).alias("created_time"), F.to_timestamp(F.lit("2023-01-01")).alias("created_time")
    rows = n.select(code, F.lit("en_IN").alias("locale"), F.col("n_name").alias("value"), new)
    rows = rows.unionByName(n.select(code, F.lit("rg_IN").alias("locale"), F.col("r_name").alias("value"), new))
    return rows.unionByName(n.select(code, F.lit("en_IN").alias("locale"), F.lit("old").alias("value"), old))


#: Dimension -> table and column that hold its codes.
CODES = {
    "dimension_property_type": ("customer", "c_mktsegment"),
    "dimension_usage_category": ("events", "event_type"),
    "dimension_ownership_category": ("orders", "o_orderstatus"),
    "dimension_payment_mode": ("orders", "o_orderpriority"),
    "dimension_locality": ("supplier", "s_nationkey"),
    "dimension_zone": ("region", "r_name"),
    "dimension_block": ("part", "p_brand"),
}


def code_labels(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A dimension's codes with a label in lower case, older ones below them."""
    of, column = CODES[name]
    codes = table(spark, sf_dir, of).select(_text(column).alias("code")).distinct()
    row = lambda value, day: codes.select("code", F.lit("en_IN").alias("locale"), value.alias("value"), F.to_timestamp(F.lit(day)).alias("created_time"))
    return row(F.lower("code"), "2024-01-01").unionByName(row(F.lit("old"), "2023-01-01"))


def backfill_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ordered(spark, sf_dir).select(
        _tenant().alias("tenant_id"),
        _text("o_orderkey").alias("demand_id"),
        _text("o_custkey").alias("consumer_code"),
        F.lit("PT").alias("business_service"),
        F.col("o_orderstatus").alias("status"),
        fiscal_year(F.col("o_orderdate")).alias("financial_year"),
        _time("o_orderdate").alias("last_modified_time"),
        (1 + F.col("o_orderkey") % 3).alias("version"),
    )


def backfill_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        _tenant().alias("tenant_id"),
        _text("l_orderkey").alias("demand_id"),
        _line_id().alias("demand_detail_id"),
        F.col("l_returnflag").alias("tax_head_code"),
        F.col("price").alias("tax_amount"),
        (F.col("price") * F.col("rate")).cast(MONEY).alias("collection_amount"),
        _time("l_shipdate").alias("last_modified_time"),
        (1 + F.col("l_linenumber") % 4).cast("bigint").alias("version"),
    )


def property_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(raw): a JSON event for each version of a property, with units and owners."""
    p = property_address(spark, sf_dir)
    key = F.col("property_id").cast("int")
    n_units = 1 + key % 3
    unit = lambda k: F.struct(
        F.concat_ws("-u", F.col("property_id"), k.cast("string")).alias("unitId"),
        k.cast("string").alias("floorNo"),
        F.lit("FLAT").alias("unitType"),
        F.col("usage_category").alias("usageCategory"),
        F.lit("SELF").alias("occupancyType"),
        F.lit("2020-02-29").alias("occupancyDate"),
        (k * 10 + F.lit(0.5)).cast("decimal(10,2)").alias("carpetArea"),
        (k * 12).cast("decimal(18,2)").alias("builtUpArea"),
        (key % 1000 + k).cast(MONEY).alias("arvAmount"),
    )
    owner = F.struct(
        F.concat(F.lit("U"), (key % 50).cast("string")).alias("ownerId"),
        F.lit("SPOUSE").alias("relationship"),
        F.concat_ws("-", F.col("property_id"), F.lit("1")).alias("ownerInfoUuid"),
        F.lit("50.0").alias("ownershipPercentage"),
        (key % 2 == 0).alias("isPrimaryOwner"),
        F.lit("ACTIVE").alias("status"),
        F.lit("A. Nobody").alias("name"),
    )
    ms = F.unix_millis
    event = F.struct(
        F.col("tenant_id").alias("tenantId"),
        F.struct(
            F.col("property_id").alias("propertyId"),
            F.col("property_type").alias("propertyType"),
            F.col("usage_category").alias("usageCategory"),
            F.col("ownership_category").alias("ownershipCategory"),
            "status",
            F.col("financial_year").alias("financialYear"),
            (key % 500).cast("decimal(10,2)").cast("string").alias("landArea"),
            F.transform(F.sequence(F.lit(1), n_units), unit).alias("units"),
            F.array(owner).alias("owners"),
            F.struct(F.struct(F.concat(F.lit("L"), (key % 9).cast("string")).alias("code")).alias("locality"), F.struct(F.lit("30.900965").alias("latitude")).alias("geoLocation")).alias("address"),
            F.struct(F.lit("me").alias("createdBy"), ms("created_time").alias("createdTime"), ms("last_modified_time").alias("lastModifiedTime")).alias("auditDetails"),
        ).alias("property"),
    )
    return _spread(p, table(spark, sf_dir, "events").count()).select(F.to_json(event).alias("raw"))


def demand_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(raw): a JSON event for each version of a demand; one of its tax heads has no column."""
    amount = lambda c: c.cast("decimal(18,4)").cast("string")
    detail = lambda head, tax, collected: F.struct(F.lit(head).alias("taxHeadMasterCode"), amount(tax).alias("taxAmount"), amount(collected).alias("collectionAmount"))
    price, rate, zero = F.col("price"), F.col("rate"), F.lit(0)
    event = F.struct(
        _tenant().alias("tenantId"),
        F.struct(
            _line_id().alias("id"),
            _text("o_custkey").alias("consumerCode"),
            F.lit("PT").alias("businessService"),
            F.col("o_orderstatus").alias("status"),
            (F.col("l_linestatus") == "F").alias("isPaymentCompleted"),
            fiscal_year(F.col("o_orderdate")).alias("financialYear"),
            F.array(
                detail("PT_TAX", price, price * rate),
                detail("PT_TIME_REBATE", -price * rate, zero),
                detail("PT_LATE_FEE", price * F.col("tax"), zero),
                detail("PT_TAX", F.lit(1), zero),
            ).alias("demandDetails"),
            F.struct(F.unix_millis(_time("o_orderdate")).alias("createdTime"), F.unix_millis(_time("l_shipdate")).alias("lastModifiedTime")).alias("auditDetails"),
        ).alias("demand"),
    )
    return _spread(_lines(spark, sf_dir), table(spark, sf_dir, "lineitem").count()).select(F.to_json(event).alias("raw"))


ENTITIES = {f.__name__: f for f in (demand, property_address, property_owner, property_audit, bill, bill_detail, payment, assessment)}


def catalog(spark: SparkSession, sf_dir: str) -> FrameCatalog:
    """All entities. Only the columns that the marts read are there."""
    frames = {name: partial(f, spark, sf_dir) for name, f in ENTITIES.items()}
    labels = {name: partial(code_labels, spark, sf_dir, name) for name in CODES}
    return FrameCatalog(spark, frames | labels | {"dimension_tenant_id": partial(tenant_labels, spark, sf_dir)})


def full(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An entity with all columns of its schema."""
    spec = schemas.ENTITIES[name]
    return conform(ENTITIES[name](spark, sf_dir), spec.schema, spec.defaults)
