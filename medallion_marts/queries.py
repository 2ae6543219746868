"""The registered queries and, for each, the same in DuckDB SQL over the given tables."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.fiscal import month_number
from .functions.values import millis
from . import schemas
from .operators.latest import latest_state as latest
from .plans import backfill, dimensions, marts, refresh, silver, views
from .sources import sample_tables as sample
from .sources.events import quarantine, read_events, split_payload
from .sources.tables import CODEC, TableCatalog, buckets_for, without_leftovers
from .streaming.ingest import ingest, raw_window

#: The sample tables' fiscal years are those of the nineties.
MIN_FY_START = 1995


def _mart(function, **params):
    return lambda spark, sf_dir: function(sample.catalog(spark, sf_dir), **params)


def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sample.catalog(spark, sf_dir).latest("demand")
    return df.select("tenant_id", "demand_id", "demand_status", "total_tax_amount", "outstanding_amount", "last_modified_time")


def silver_property_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.to_property_address(sample.property_events(spark, sf_dir))
    return df.select("tenant_id", "property_id", "property_type", "ownership_category", "usage_category", "status", "financial_year", "land_area", "locality", "country", "latitude", "created_by", "created_time", "last_modified_time")


def silver_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.to_property_unit(sample.property_events(spark, sf_dir))
    return df.select("tenant_id", "unit_id", "property_id", "floor_no", "usage_category", "occupancy_date", "carpet_area", "built_up_area", "arv", "active", "last_modified_time")


def silver_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.to_property_owner(sample.property_events(spark, sf_dir))
    return df.select("tenant_id", "owner_info_uuid", "property_id", "user_id", "is_primary_owner", "ownership_percentage", "relationship", "property_status", "last_modified_time")


def silver_demand_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.to_demand(sample.demand_events(spark, sf_dir))
    return df.select("tenant_id", "demand_id", "total_tax_amount", "total_collection_amount", "outstanding_amount", "is_paid", "pt_tax", "pt_tax_collection", "pt_time_rebate", "pt_fire_cess", "last_modified_time")


def silver_bill_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.to_bill_detail(sample.bill_detail(spark, sf_dir).drop("financial_year"))
    return df.groupBy("tenant_id", "financial_year").agg(F.count("*").alias("details"), F.sum("amount_paid").cast("decimal(18,2)").alias("amount_paid"))


def audit_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.audit_snapshot(sample.property_address(spark, sf_dir), sample.property_owner(spark, sf_dir))
    return df.select("tenant_id", "property_id", "property_type", "usage_category", "property_status", "workflow_state", "owner_count")


def backfill_demand_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = backfill.backfill_demand_details(sample.backfill_details(spark, sf_dir), sample.backfill_headers(spark, sf_dir))
    return df.select("tenant_id", "demand_id", "demand_detail_id", "tax_head_code", "tax_amount", "collection_amount", "consumer_code", "business_service", "demand_status", "financial_year", "version", "month", "last_modified_time")


def backfill_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.months_with_data(sample.backfill_details(spark, sf_dir))


def dim_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.latest_labels(sample.tenant_labels(spark, sf_dir)).select("code", "locale", "value")


def dimensions_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest labels of all eight dimensions, through the catalog."""
    cat = sample.catalog(spark, sf_dir)
    parts = [cat.latest(name).select(F.lit(name).alias("dimension"), "code", "locale", "value") for name in schemas.DIMENSIONS]
    return reduce(DataFrame.unionByName, parts)


def _largest(spark: SparkSession, sf_dir: str) -> int:
    return max(sample.table(spark, sf_dir, name).count() for name in ("lineitem", "orders", "customer", "events"))


def _stored(spark: SparkSession, sf_dir: str) -> TableCatalog:
    """A database in the shared folder, whose files go when Spark's JVM ends; its buckets grow with the largest tables."""
    name = f"tables_{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_shared_dir(spark)}/{name}")
    cat = TableCatalog(spark, name, path.toString(), buckets_for(_largest(spark, sf_dir)))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return cat


def _once(df: DataFrame, label: str) -> DataFrame:
    """df, written to the shared folder and read back."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    with without_leftovers(spark):
        df.write.option("compression", CODEC).parquet(path.toString())
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(path.toString())


def _versions(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An entity's versions. Ties in time are settled before, as stored versions have only their arrival."""
    rows, spec = sample.ENTITIES[name](spark, sf_dir), schemas.ENTITIES[name]
    ties = [c for c in rows.columns if c.startswith("_tie")]
    if spec.version is None:
        return rows.withColumn("_ingested_at", F.timestamp_micros(ties[0]))
    return latest(rows, [*spec.keys, spec.version], ties) if ties else rows


#: Rows of the largest table beyond which entities are loaded one after another: each keeps all cores busy, and only one has its shuffle files on disk.
ONE_AT_A_TIME = 5_000_000


def _load_all(cat: TableCatalog, sf_dir: str, names) -> TableCatalog:
    """Stores entities, several small ones at a time: each has its own tables, and small ones leave cores idle."""
    with ThreadPoolExecutor(1 if _largest(cat.spark, sf_dir) > ONE_AT_A_TIME else refresh.AT_ONCE) as pool:
        for loaded in [pool.submit(cat.upsert, name, _versions(cat.spark, sf_dir, name)) for name in names]:
            loaded.result()
    return cat


def refreshed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments are stored, their monthly mart is refreshed twice, and the cumulative view reads the stored mart."""
    cat = _load_all(_stored(spark, sf_dir), sf_dir, ["payment"])
    for _ in range(2):
        refresh.refresh_all(cat, ["collections_by_month"])
    return views.cumulative_collections_by_month(cat)


#: Mart -> a number of it that is summed up to compare whole refreshes.
MEASURED = {
    "active_property_distribution_summary": "property_count",
    "new_properties_by_fy": "new_property_count",
    "demand_and_collection_summary": "total_outstanding",
    "collections_by_month": "total_collected_amount",
    "properties_with_demand_by_fy": "properties_with_demand",
    "defaulters": "outstanding_amount",
    "property_change_metrics": "area_changed",
    "property_risk_summary": "total_updates",
    "property_changes_by_fy": "usage_category_changes",
    "property_demand_vs_assessed_by_fy": "total_properties_with_demand_no_assessment",
    "assessment_summary_by_fy": "assessments_by_owner",
    "payment_summary_by_fy": "total_amount_collected_in_part_payments",
    "rebate_summary_by_fy": "total_rebate_amount",
    "daily_collection_summary": "total_amount",
    "property_payment_mode_by_fy": "total_payments",
    "collection_by_transaction_fy_and_demand_fy": "total_amount_paid",
}


def refreshed_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entities are stored and all sixteen marts refreshed from their newest states; rows, those stamped since the start, and a sum of each stored mart."""
    day = spark.range(1).select(F.current_date()).first()[0]
    cat = _load_all(_stored(spark, sf_dir), sf_dir, sample.ENTITIES)
    refresh.refresh_all(cat)
    sums = lambda c: (F.count("*").alias("rows"), F.count_if(F.col("data_refresh_date") >= F.lit(day)).alias("stamped"), F.sum(F.col(c).cast("decimal(28,4)")).cast("decimal(38,4)").alias("total"))
    parts = [cat.mart(name).agg(*sums(c)).select(F.lit(name).alias("mart"), "rows", "stamped", "total") for name, c in MEASURED.items()]
    return reduce(DataFrame.unionByName, parts)


def loaded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of stored entities after a load and a compaction, and of a mart."""
    cat = _load_all(_stored(spark, sf_dir), sf_dir, ["property_address", "property_owner", "bill"])
    cat.compact("property_address")
    refresh.refresh_all(cat, ["new_properties_by_fy"])
    return cat.counts_report(["property_address", "property_owner", "bill", "new_properties_by_fy"])


#: The days that the sample's events are of, in the zone that `raw_days` counts them in.
ZONE, FIRST_DAY, DAYS = "Asia/Kolkata", date(2024, 1, 1), 31


def raw_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw rows, day after day of another zone than the session's, by the window that a night reads."""
    at = F.col("ts").cast("timestamp")
    raw = sample.table(spark, sf_dir, "events").select(at.alias("event_time"), F.col("props").alias("raw"), month_number(at, ZONE).alias("event_month"))
    days = [str(FIRST_DAY + timedelta(days=k)) for k in range(DAYS)]
    parts = [raw_window(raw, day, ZONE).agg(F.count("*").alias("events"), F.sum(F.length("raw")).alias("characters")).select(F.lit(day).alias("day"), "events", "characters") for day in days]
    return reduce(DataFrame.unionByName, parts).where("events > 0")


def marts_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over two stored marts and a stored view, by their names."""
    cat = _load_all(_stored(spark, sf_dir), sf_dir, ["demand", "assessment", "payment", "bill", "property_address"])
    refresh.refresh_all(cat, ["demand_and_collection_summary", "properties_with_demand_by_fy", "property_demand_vs_assessed_by_fy", "collections_by_month", "payment_summary_by_fy"])
    refresh.create_views(cat, MIN_FY_START)
    return spark.sql(f"""
        SELECT d.tenant_id, d.financial_year, d.total_outstanding, c.total_properties_with_demand, v.arrears_outstanding
        FROM {cat.name('mart_demand_and_collection_summary')} d JOIN {cat.name('mart_property_demand_vs_assessed_by_fy')} c USING (tenant_id, financial_year)
        JOIN {cat.name('v_demand_collection_with_arrears')} v USING (tenant_id, financial_year)""")


#: Nights of `repeated_nights`, and the order in which they run: the second once more at the end.
NIGHTS = ("1999-03-30", "1999-03-31", "1999-04-01")
NIGHTS_RUN = (0, 1, 2, 1)


def _night(changed: Column) -> Column:
    """The night that brings a version of a property: first states in the first one, later ones by the day of the month, whatever the month."""
    return F.when(changed <= F.to_timestamp(F.lit("1995-01-01")), 0).when(F.dayofmonth(changed) <= 15, 2).otherwise(1)


def repeated_nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three nights of property events, versions out of order, one of them run again; then the changes between audit snapshots."""
    cat = _stored(spark, sf_dir)
    changed = millis(F.get_json_object("raw", "$.property.auditDetails.lastModifiedTime").cast("bigint"))
    raw = _once(sample.property_events(spark, sf_dir).withColumn("night", _night(changed)), "raw")
    for k in NIGHTS_RUN:
        silver.run_silver(cat, {"property_events_raw": raw.where(F.col("night") == k)}, day=NIGHTS[k])
    refresh.refresh_all(cat, ["property_change_metrics", "property_risk_summary", "property_changes_by_fy"])
    return cat.mart("property_changes_by_fy").drop("data_refresh_date")


def compacted_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of demands are appended in two loads, the newer first, then compacted: one row for each demand is stored."""
    cat, rows = _stored(spark, sf_dir), _once(_versions(spark, sf_dir, "demand"), "demand")
    for late in (True, False):
        cat.upsert("demand", rows.where((F.month("last_modified_time") > 6) == late))
    cat.compact("demand")
    return cat.versions("demand").groupBy("tenant_id").agg(F.count("*").alias("demands"), F.sum("outstanding_amount").cast("decimal(18,4)").alias("outstanding"), F.max("last_modified_time").alias("newest"))


def backfill_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill is written by months, some of them twice, and read back."""
    path = f"{_shared_dir(spark)}/backfill-{uuid.uuid4().hex}"
    # Worked out once for both runs.
    rows = _once(backfill.backfill_demand_details(sample.backfill_details(spark, sf_dir), sample.backfill_headers(spark, sf_dir)), "details")
    backfill.write_backfill(rows, path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    backfill.write_backfill(rows.where("month >= '199701'"), path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("month").cast("string").alias("month")).agg(F.count("*").alias("details"), F.sum("tax_amount").cast("decimal(18,2)").alias("tax_amount"), F.sum("version").alias("versions"))


def localize(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = sample.catalog(spark, sf_dir)
    df = dimensions.localize(marts.demand_and_collection_summary(cat), cat.versions("dimension_tenant_id"), "tenant_id", "en_IN", "tenant_name")
    return df.groupBy("tenant_name").agg(F.sum("total_demand").cast("decimal(18,2)").alias("total_demand"))


def _shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return found or tempfile.mkdtemp(prefix="spark-shared-")


#: Events in a file of the topic that `raw_ingest_counts` ingests.
TOPIC_ROWS = 250_000


def raw_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand events go through files and the streaming ingest; then they are counted by month of modification."""
    root = f"{_shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    # Compressed texts are not split, so files are kept short.
    sample.demand_events(spark, sf_dir).write.option("compression", "gzip").option("maxRecordsPerFile", TOPIC_ROWS).text(f"{root}/topic")
    stream = read_events(spark, f"{root}/topic", "text")
    ingest(stream, f"{root}/raw", f"{root}/checkpoint").awaitTermination()
    raw = spark.read.schema("event_time timestamp, raw string, event_month string").parquet(f"{root}/raw")
    changed = millis(F.get_json_object("raw", "$.demand.auditDetails.lastModifiedTime").cast("bigint"))
    return raw.groupBy(F.date_format(changed, "yyyyMM").alias("month")).agg(F.count("*").alias("events"))


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as messages; of two in seven, one is a broken text and one an array of two objects."""
    e = sample.table(spark, sf_dir, "events")
    props = F.col("props")
    raw = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), props)).when(F.col("event_id") % 7 == 1, F.concat(F.lit("["), props, F.lit(","), props, F.lit("]"))).otherwise(props)
    good, bad = quarantine(split_payload(e.select("event_type", raw.alias("raw"))))
    both = good.withColumn("fine", F.lit(1)).unionByName(bad.withColumn("fine", F.lit(0)))
    return both.groupBy("event_type").agg(F.sum("fine").alias("good"), F.sum(1 - F.col("fine")).alias("broken"))


_MART_KEYS = (
    ("m01_active_property_distribution_summary", marts.active_property_distribution_summary, {}),
    ("m02_new_properties_by_fy", marts.new_properties_by_fy, {}),
    ("m03_demand_and_collection_summary", marts.demand_and_collection_summary, {}),
    ("m04_collections_by_month", marts.collections_by_month, {}),
    ("m05_properties_with_demand_by_fy", marts.properties_with_demand_by_fy, {}),
    ("m06_defaulters", marts.defaulters, {}),
    ("m07_property_change_metrics", marts.property_change_metrics, {}),
    ("m08_property_risk_summary", marts.property_risk_summary, {}),
    ("m09_property_changes_by_fy", marts.property_changes_by_fy, {}),
    ("m10_property_demand_vs_assessed_by_fy", marts.property_demand_vs_assessed_by_fy, {}),
    ("m11_assessment_summary_by_fy", marts.assessment_summary_by_fy, {}),
    ("m12_payment_summary_by_fy", marts.payment_summary_by_fy, {}),
    ("m13_rebate_summary_by_fy", marts.rebate_summary_by_fy, {}),
    ("m14_daily_collection_summary", marts.daily_collection_summary, {}),
    ("m15_property_payment_mode_by_fy", marts.property_payment_mode_by_fy, {}),
    ("m16_collection_by_transaction_fy_and_demand_fy", marts.collection_by_transaction_fy_and_demand_fy, {}),
    ("v1_cumulative_collections_by_month", views.cumulative_collections_by_month, {}),
    ("v2_demand_collection_with_arrears", views.demand_collection_with_arrears, {"min_fy_start": MIN_FY_START}),
    ("v3_payment_summary_with_last_year", views.payment_summary_with_last_year, {}),
)
QUERIES = {name: _mart(function, **params) for name, function, params in _MART_KEYS}
QUERIES |= {
    f.__name__: f
    for f in (
        latest_state,
        silver_property_address,
        silver_unit,
        silver_owner,
        silver_demand_pivot,
        silver_bill_detail,
        audit_snapshot,
        backfill_demand_details,
        backfill_months,
        dim_latest,
        dimensions_latest,
        refreshed_view,
        refreshed_marts,
        marts_by_name,
        repeated_nights,
        loaded_counts,
        raw_days,
        compacted_demand,
        backfill_written,
        localize,
        raw_ingest_counts,
        quarantine_counts,
    )
}


def _fy(t: str) -> str:
    start = f"(year({t}) - CASE WHEN month({t}) < 4 THEN 1 ELSE 0 END)"
    return f"({start}::VARCHAR || '-' || substr(({start} + 1)::VARCHAR, 3, 2))"


_TENANT = "'T' || c_nationkey"
_NUMBER = "(c_custkey + CASE WHEN c_custkey % 10 = 0 THEN 1000000000 ELSE 0 END)"
_LINES = "(SELECT *, l_extendedprice::DECIMAL(12,2) AS price, l_discount::DECIMAL(4,2) AS rate, l_tax::DECIMAL(4,2) AS tax FROM lineitem) JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
_ORDERED = "orders JOIN customer ON o_custkey = c_custkey"
_NEWEST_LINE = "QUALIFY row_number() OVER (PARTITION BY c_nationkey, l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, price DESC) = 1"
#: The newest state of each entity, as the marts read it.
_CTE = {
    "demand": f"""SELECT {_TENANT} AS tenant_id, l_orderkey || '-' || l_linenumber AS demand_id, o_custkey::VARCHAR AS consumer_code,
        CASE WHEN l_returnflag = 'N' THEN 'WS' ELSE 'PT' END AS business_service,
        CASE WHEN l_linestatus = 'O' THEN 'ACTIVE' ELSE 'CANCELLED' END AS demand_status,
        CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE {_fy('o_orderdate')} END AS financial_year,
        price AS total_tax_amount, (price * (1 - rate))::DECIMAL(12,2) AS total_collection_amount, (price * rate)::DECIMAL(18,4) AS outstanding_amount,
        (-price * rate)::DECIMAL(18,4) AS pt_time_rebate, CASE WHEN l_returnflag = 'R' THEN (-price * tax)::DECIMAL(18,4) ELSE 0::DECIMAL(18,4) END AS pt_adhoc_rebate,
        l_shipdate AS last_modified_time FROM {_LINES} {_NEWEST_LINE}""",
    "all_properties": f"""SELECT {_TENANT} AS tenant_id, {_NUMBER}::VARCHAR AS property_id, c_mktsegment AS property_type,
        CASE WHEN c_acctbal >= 0 THEN 'INDIVIDUAL' ELSE 'INSTITUTIONAL' END AS ownership_category, usage_category, status,
        {_fy("make_date((1995 + c_custkey % 7)::INT, 6, 15)")} AS financial_year, t AS last_modified_time, {_NUMBER} AS number
        FROM customer JOIN (SELECT c_custkey AS k, 'RESIDENTIAL' AS usage_category, 'ACTIVE' AS status, TIMESTAMP '1995-01-01' AS t FROM customer
          UNION ALL SELECT user_id, upper(event_type), CASE WHEN event_type = 'error' THEN 'INACTIVE' ELSE 'ACTIVE' END, ts FROM events) ON k = c_custkey""",
    "property_address": "SELECT * FROM all_properties QUALIFY row_number() OVER (PARTITION BY tenant_id, property_id ORDER BY last_modified_time DESC) = 1",
    "property_owner": f"""SELECT {_TENANT} AS tenant_id, c_custkey || '-' || k AS owner_info_uuid, c_custkey::VARCHAR AS property_id, 'U' || (c_custkey % 50) AS user_id,
        CASE WHEN k = 2 AND c_custkey % 30 = 0 THEN 'OTHER' ELSE c_mktsegment END AS property_type
        FROM customer, (SELECT 1 AS k UNION ALL SELECT 2) WHERE k = 1 OR c_custkey % 3 = 0""",
    "changes": f"""SELECT {_TENANT} AS tenant_id, user_id || '-' || (event_id % 40) AS property_id, c_mktsegment AS property_type, ts AS audit_created_time,
        coalesce((event_type != lag(event_type) OVER w)::INT, 0) AS ownership_category_changed,
        coalesce((k % 3 != lag(k % 3) OVER w)::INT, 0) AS usage_category_changed,
        coalesce((floor(value / 50) != lag(floor(value / 50)) OVER w OR floor(value / 100) != lag(floor(value / 100)) OVER w)::INT, 0) AS area_changed,
        coalesce((k % 2 != lag(k % 2) OVER w)::INT, 0) AS workflow_state_changed,
        coalesce((event_id % 3 != lag(event_id % 3) OVER w)::INT, 0) AS owners_changed
        FROM (SELECT *, json_extract(props, '$.k')::INT AS k FROM events) JOIN customer ON user_id = c_custkey
        WINDOW w AS (PARTITION BY user_id, event_id % 40 ORDER BY ts, event_id)""",
    "bill": f"SELECT {_TENANT} AS tenant_id, (o_orderkey + CASE WHEN o_orderkey % 17 = 0 THEN 1000000000 ELSE 0 END)::VARCHAR AS bill_id, o_custkey::VARCHAR AS consumercode FROM {_ORDERED}",
    "bill_detail": f"SELECT {_TENANT} AS tenant_id, l_orderkey::VARCHAR AS bill_id, price AS amount_paid, {_fy('l_shipdate')} AS financial_year FROM {_LINES} {_NEWEST_LINE}",
    "payment": f"""SELECT {_TENANT} AS tenant_id, o_orderkey::VARCHAR AS billid, o_orderdate AS transaction_date, o_orderdate + INTERVAL 10 DAY AS created_time,
        {_fy('o_orderdate')} AS financial_year, o_orderpriority AS payment_mode,
        CASE o_orderstatus WHEN 'F' THEN 'CANCELLED' WHEN 'O' THEN 'DEPOSITED' ELSE 'NEW' END AS payment_status, o_totalprice::DECIMAL(12,2) AS total_due,
        CASE WHEN o_orderkey % 3 = 0 THEN (o_totalprice::DECIMAL(12,2) - 100)::DECIMAL(12,2) ELSE o_totalprice::DECIMAL(12,2) END AS total_amount_paid
        FROM {_ORDERED} WHERE o_orderkey % 5 != 0""",
    "assessment": f"""SELECT {_TENANT} AS tenant_id, CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE {_fy('o_orderdate')} END AS financial_year, o_custkey::VARCHAR AS property_id,
        o_orderpriority AS channel, 'U' || ((o_custkey + o_orderkey % 2) % 50) AS created_by FROM {_ORDERED} WHERE o_orderstatus != 'P'""",
}
_PT_DEMAND = "business_service = 'PT' AND demand_status = 'ACTIVE'"
_SUMS = """sum(ownership_category_changed + area_changed + workflow_state_changed + usage_category_changed + owners_changed)::BIGINT AS total_updates,
    sum(ownership_category_changed)::BIGINT AS ownership_changes, sum(area_changed)::BIGINT AS area_changes, sum(workflow_state_changed)::BIGINT AS workflow_reopens,
    sum(usage_category_changed)::BIGINT AS usage_category_changes, sum(owners_changed)::BIGINT AS owner_count_changed"""


def _sql(query: str, *names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({_CTE[n]})" for n in names) + " " + query


_M03 = f"SELECT tenant_id, financial_year, sum(total_tax_amount)::DECIMAL(18,2) AS total_demand, sum(total_collection_amount)::DECIMAL(18,2) AS total_collection, sum(outstanding_amount)::DECIMAL(18,4) AS total_outstanding FROM demand WHERE {_PT_DEMAND} AND financial_year != '' GROUP BY 1, 2"
_M04 = f"SELECT tenant_id, {_fy('transaction_date')} AS financial_year, strftime(created_time, '%Y-%m') AS year_month, payment_status, count(*) AS total_payments, sum(total_amount_paid)::DECIMAL(18,4) AS total_collected_amount FROM payment GROUP BY 1, 2, 3, 4"
_M12 = f"""SELECT p.tenant_id, {_fy('transaction_date')} AS financial_year, coalesce(property_type, '') AS property_type, payment_mode, count(*) AS total_payments,
    sum(total_amount_paid)::DECIMAL(18,2) AS total_amount_collected, count(*) FILTER (total_amount_paid < total_due) AS total_part_payments,
    coalesce(sum(total_amount_paid) FILTER (total_amount_paid < total_due), 0)::DECIMAL(18,2) AS total_amount_collected_in_part_payments
    FROM payment p LEFT JOIN bill b ON p.tenant_id = b.tenant_id AND billid = bill_id LEFT JOIN property_address a ON p.tenant_id = a.tenant_id AND consumercode = property_id GROUP BY ALL"""
_TOTALS = [f"sum(b2.total_{c}) FILTER (b2.s = coalesce(b1.s, b2.s + 1) - 1)" for c in ("demand", "collection", "outstanding")]
_PROPERTY_KEYS = "tenant_id, property_type, ownership_category, usage_category"

ORACLE_SQL = {
    "latest_state": _sql("SELECT tenant_id, demand_id, demand_status, total_tax_amount, outstanding_amount, last_modified_time FROM demand", "demand"),
    "m01_active_property_distribution_summary": _sql(f"SELECT {_PROPERTY_KEYS}, count(*) AS property_count FROM property_address WHERE status = 'ACTIVE' GROUP BY ALL", "all_properties", "property_address"),
    "m02_new_properties_by_fy": _sql("SELECT tenant_id, financial_year, count(*) AS new_property_count FROM property_address WHERE status = 'ACTIVE' GROUP BY ALL", "all_properties", "property_address"),
    "m03_demand_and_collection_summary": _sql(_M03, "demand"),
    "m04_collections_by_month": _sql(_M04, "payment"),
    "m05_properties_with_demand_by_fy": _sql(f"SELECT tenant_id, financial_year, consumer_code AS properties_with_demand FROM demand WHERE {_PT_DEMAND} AND financial_year != ''", "demand"),
    "m06_defaulters": _sql(f"SELECT tenant_id, consumer_code AS property_id, demand_id, financial_year, total_tax_amount, total_collection_amount, outstanding_amount::DECIMAL(12,4) AS outstanding_amount FROM demand WHERE {_PT_DEMAND} AND outstanding_amount > 0", "demand"),
    "m07_property_change_metrics": _sql("SELECT * FROM changes", "changes"),
    "m08_property_risk_summary": _sql(
        f"SELECT tenant_id, property_id, property_type, {_SUMS}, (sum(ownership_category_changed) > 1 OR sum(area_changed) > 2 OR sum(workflow_state_changed) > 1)::INT AS risk_score FROM changes GROUP BY 1, 2, 3", "changes"
    ),
    "m09_property_changes_by_fy": _sql(f"SELECT tenant_id, property_type, {_fy('audit_created_time')} AS financial_year, {_SUMS} FROM changes GROUP BY 1, 2, 3", "changes"),
    "m10_property_demand_vs_assessed_by_fy": _sql(
        f"""SELECT tenant_id, financial_year, count(*) FILTER (a) AS total_properties_assessed, count(*) FILTER (d) AS total_properties_with_demand,
        count(*) FILTER (d AND NOT a) AS total_properties_with_demand_no_assessment, count(*) FILTER (a AND NOT d) AS total_properties_with_assessment_no_demand
        FROM (SELECT tenant_id, financial_year, property_id, bool_or(d) AS d, bool_or(NOT d) AS a FROM (
          SELECT tenant_id, financial_year, consumer_code AS property_id, true AS d FROM demand WHERE {_PT_DEMAND} AND financial_year != ''
          UNION ALL SELECT tenant_id, financial_year, property_id, false FROM assessment) GROUP BY 1, 2, 3) GROUP BY 1, 2""",
        "demand",
        "assessment",
    ),
    "m11_assessment_summary_by_fy": _sql(
        """SELECT a.tenant_id, a.financial_year, coalesce(t.property_type, '') AS property_type, channel, count(*) AS total_assessments,
        count(user_id) AS assessments_by_owner, count(*) - count(user_id) AS assessments_by_others
        FROM assessment a LEFT JOIN (SELECT DISTINCT tenant_id, property_id, property_type FROM property_owner) t USING (tenant_id, property_id)
        LEFT JOIN (SELECT DISTINCT tenant_id, property_id, user_id FROM property_owner) u ON a.tenant_id = u.tenant_id AND a.property_id = u.property_id AND created_by = user_id
        WHERE a.financial_year != '' GROUP BY ALL""",
        "assessment",
        "property_owner",
    ),
    "m12_payment_summary_by_fy": _sql(_M12, "payment", "bill", "all_properties", "property_address"),
    "m13_rebate_summary_by_fy": _sql(
        f"""SELECT d.tenant_id, d.financial_year, coalesce(property_type, '') AS property_type,
        (((sum(abs(pt_time_rebate) + abs(pt_adhoc_rebate)) * 20000)::HUGEINT + count(*)) // (2 * count(*)) * 0.0001)::DECIMAL(18,4) AS avg_rebate_amount,
        sum(abs(pt_time_rebate) + abs(pt_adhoc_rebate))::DECIMAL(18,4) AS total_rebate_amount, count(*) AS demands_with_rebate
        FROM demand d LEFT JOIN property_address a ON d.tenant_id = a.tenant_id AND consumer_code = property_id
        WHERE {_PT_DEMAND} AND d.financial_year != '' AND (pt_time_rebate != 0 OR pt_adhoc_rebate != 0) GROUP BY 1, 2, 3""",
        "demand",
        "all_properties",
        "property_address",
    ),
    "m14_daily_collection_summary": _sql("SELECT tenant_id, payment_status, created_time::DATE AS collection_date, sum(total_amount_paid)::DECIMAL(18,2) AS total_amount FROM payment GROUP BY 1, 2, 3", "payment"),
    "m15_property_payment_mode_by_fy": _sql("SELECT p.tenant_id, consumercode AS property_id, payment_mode, financial_year, count(*) AS total_payments FROM payment p JOIN bill b ON p.tenant_id = b.tenant_id AND billid = bill_id GROUP BY ALL", "payment", "bill"),
    "m16_collection_by_transaction_fy_and_demand_fy": _sql(
        "SELECT p.tenant_id, p.financial_year AS transaction_financial_year, d.financial_year AS bill_financial_year, sum(amount_paid)::DECIMAL(18,4) AS total_amount_paid FROM payment p JOIN bill_detail d ON p.tenant_id = d.tenant_id AND billid = bill_id WHERE payment_status != 'CANCELLED' GROUP BY 1, 2, 3",
        "payment",
        "bill_detail",
    ),
    "v1_cumulative_collections_by_month": f"""WITH payment AS ({_CTE['payment']}), m AS ({_M04}),
        b AS (SELECT tenant_id, financial_year, (year_month || '-01')::DATE AS month_date, sum(total_payments)::BIGINT AS total_payments, sum(total_collected_amount)::DECIMAL(28,4) AS total_collected_amount FROM m GROUP BY 1, 2, 3)
        SELECT *, sum(total_payments) OVER r::BIGINT AS cumulative_payments, sum(total_collected_amount) OVER r::DECIMAL(38,4) AS cumulative_collected_amount,
        sum(total_payments) OVER f::BIGINT AS fy_total_payments, sum(total_collected_amount) OVER f::DECIMAL(38,4) AS fy_total_collected_amount FROM b
        WINDOW f AS (PARTITION BY tenant_id, financial_year), r AS (PARTITION BY tenant_id, financial_year ORDER BY month_date ROWS UNBOUNDED PRECEDING)""",
    # The self-join that the window form replaces.
    "v2_demand_collection_with_arrears": f"""WITH demand AS ({_CTE['demand']}), b AS (SELECT *, substr(financial_year, 1, 4)::INT AS s FROM ({_M03}) WHERE substr(financial_year, 1, 4)::INT >= {MIN_FY_START})
        SELECT coalesce(b1.tenant_id, b2.tenant_id) AS tenant_id, coalesce(b1.financial_year, (b2.s + 1) || '-' || substr((b2.s + 2)::VARCHAR, 3, 2)) AS financial_year,
        coalesce(b1.total_demand, 0) AS total_demand, coalesce(b1.total_collection, 0) AS total_collection, coalesce(b1.total_outstanding, 0) AS total_outstanding,
        {", ".join(f"coalesce({x}, 0)::DECIMAL(18,{4 if c == 'outstanding' else 2}) AS last_year_{c}" for x, c in zip(_TOTALS, ("demand", "collection", "outstanding")))},
        {", ".join(f"coalesce(sum(b2.total_{c}), 0)::DECIMAL(18,{4 if c == 'outstanding' else 2}) AS arrears_{c}" for c in ("demand", "collection", "outstanding"))}
        FROM b b1 FULL JOIN b b2 ON b1.tenant_id = b2.tenant_id AND b2.s < b1.s GROUP BY 1, 2, 3, 4, 5""",
    "v3_payment_summary_with_last_year": f"""WITH payment AS ({_CTE['payment']}), bill AS ({_CTE['bill']}), all_properties AS ({_CTE['all_properties']}), property_address AS ({_CTE['property_address']}),
        m AS (SELECT *, substr(financial_year, 1, 4)::INT AS s FROM ({_M12}))
        SELECT coalesce(t1.tenant_id, t2.tenant_id) AS tenant_id, coalesce(t1.payment_mode, t2.payment_mode) AS payment_mode, coalesce(t1.property_type, t2.property_type) AS property_type,
        coalesce(t1.financial_year, (t2.s + 1) || '-' || substr((t2.s + 2)::VARCHAR, 3, 2)) AS financial_year, coalesce(t1.total_payments, 0) AS total_payments,
        coalesce(t1.total_amount_collected, 0) AS total_amount_collected, coalesce(t2.total_amount_collected, 0) AS last_year_total_amount, coalesce(t2.total_payments, 0) AS last_year_total_payments
        FROM m t1 FULL JOIN m t2 ON t1.tenant_id = t2.tenant_id AND t1.payment_mode = t2.payment_mode AND t1.property_type = t2.property_type AND t1.s = t2.s + 1""",
    "silver_property_address": _sql(
        """SELECT tenant_id, property_id, property_type, ownership_category, usage_category, status, financial_year, (number % 500)::DECIMAL(10,2) AS land_area, 'L' || (number % 9) AS locality,
        'IN' AS country, 30.900965::DECIMAL(9,6) AS latitude, 'me' AS created_by, TIMESTAMP '1995-01-01' AS created_time, date_trunc('millisecond', last_modified_time) AS last_modified_time FROM all_properties""",
        "all_properties",
    ),
    "silver_unit": _sql(
        """SELECT tenant_id, property_id || '-u' || k AS unit_id, property_id, k::TINYINT AS floor_no, usage_category, DATE '2020-02-29' AS occupancy_date, (k * 10 + 0.5)::DECIMAL(10,2) AS carpet_area,
        (k * 12)::DECIMAL(18,2) AS built_up_area, (number % 1000 + k)::DECIMAL(12,2) AS arv, 1 AS active, date_trunc('millisecond', last_modified_time) AS last_modified_time
        FROM all_properties, (SELECT unnest([1, 2, 3]) AS k) WHERE k <= 1 + number % 3""",
        "all_properties",
    ),
    "silver_owner": _sql(
        """SELECT tenant_id, property_id || '-1' AS owner_info_uuid, property_id, 'U' || (number % 50) AS user_id, (number % 2 = 0)::INT AS is_primary_owner, '50.0' AS ownership_percentage,
        'SPOUSE' AS relationship, status AS property_status, date_trunc('millisecond', last_modified_time) AS last_modified_time FROM all_properties""",
        "all_properties",
    ),
    "silver_demand_pivot": f"""SELECT {_TENANT} AS tenant_id, l_orderkey || '-' || l_linenumber AS demand_id, (price - price * rate + price * tax + 1)::DECIMAL(12,2) AS total_tax_amount,
        (price * rate)::DECIMAL(12,2) AS total_collection_amount, (price - price * rate + price * tax + 1 - price * rate)::DECIMAL(18,4) AS outstanding_amount, (l_linestatus = 'F')::INT AS is_paid,
        (price + 1)::DECIMAL(18,4) AS pt_tax, (price * rate)::DECIMAL(18,4) AS pt_tax_collection, (-price * rate)::DECIMAL(18,4) AS pt_time_rebate, 0::DECIMAL(18,4) AS pt_fire_cess,
        l_shipdate AS last_modified_time FROM {_LINES}""",
    "silver_bill_detail": f"SELECT {_TENANT} AS tenant_id, {_fy('l_shipdate')} AS financial_year, count(*) AS details, sum(price)::DECIMAL(18,2) AS amount_paid FROM {_LINES} GROUP BY 1, 2",
    "audit_snapshot": _sql(
        """SELECT tenant_id, property_id, property_type, usage_category, status AS property_status, '' AS workflow_state, coalesce(n, 0)::INT AS owner_count
        FROM property_address LEFT JOIN (SELECT tenant_id, property_id, count(*) AS n FROM property_owner GROUP BY 1, 2) USING (tenant_id, property_id)""",
        "all_properties",
        "property_address",
        "property_owner",
    ),
    "backfill_demand_details": f"""SELECT {_TENANT} AS tenant_id, l_orderkey::VARCHAR AS demand_id, l_orderkey || '-' || l_linenumber AS demand_detail_id, l_returnflag AS tax_head_code, price AS tax_amount,
        (price * rate)::DECIMAL(12,2) AS collection_amount, o_custkey::VARCHAR AS consumer_code, 'PT' AS business_service, o_orderstatus AS demand_status, {_fy('o_orderdate')} AS financial_year,
        greatest(1 + l_linenumber % 4, 1 + o_orderkey % 3)::BIGINT AS version, strftime(l_shipdate, '%Y%m') AS month, l_shipdate AS last_modified_time FROM {_LINES}""",
    "backfill_months": f"SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS month FROM {_LINES}",
    "dim_latest": "SELECT 'T' || n_nationkey AS code, locale, CASE locale WHEN 'en_IN' THEN n_name ELSE r_name END AS value FROM nation JOIN region ON n_regionkey = r_regionkey, (SELECT unnest(['en_IN', 'rg_IN']) AS locale)",
    "localize": f"WITH demand AS ({_CTE['demand']}) SELECT n_name AS tenant_name, sum(total_demand)::DECIMAL(18,2) AS total_demand FROM ({_M03}) JOIN nation ON tenant_id = 'T' || n_nationkey GROUP BY 1",
    "raw_ingest_counts": f"SELECT strftime(l_shipdate, '%Y%m') AS month, count(*) AS events FROM {_LINES} GROUP BY 1",
    "quarantine_counts": "SELECT event_type, sum(CASE event_id % 7 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS good, sum((event_id % 7 = 0)::INT)::BIGINT AS broken FROM events GROUP BY 1",
}
_LABELS = "SELECT DISTINCT '{0}' AS dimension, {2}::VARCHAR AS code, 'en_IN' AS locale, lower({2}::VARCHAR) AS value FROM {1}"
ORACLE_SQL |= {
    "dimensions_latest": " UNION ALL ".join([f"SELECT 'dimension_tenant_id' AS dimension, * FROM ({ORACLE_SQL['dim_latest']})", *(_LABELS.format(name, *of) for name, of in sample.CODES.items())]),
    "refreshed_view": ORACLE_SQL["v1_cumulative_collections_by_month"],
    "compacted_demand": _sql("SELECT tenant_id, count(*) AS demands, sum(outstanding_amount)::DECIMAL(18,4) AS outstanding, max(last_modified_time) AS newest FROM demand GROUP BY 1", "demand"),
    "backfill_written": f"SELECT month, count(*) AS details, sum(tax_amount)::DECIMAL(18,2) AS tax_amount, sum(version)::BIGINT AS versions FROM ({ORACLE_SQL['backfill_demand_details']}) GROUP BY 1",
}
ORACLE_SQL |= {
    "refreshed_marts": " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, count(*) AS rows, count(*) AS stamped, sum({column}::DECIMAL(28,4))::DECIMAL(38,4) AS total FROM ({ORACLE_SQL[key]})"
        for (key, function, _), (mart, column) in zip(_MART_KEYS, MEASURED.items())
        if function.__name__ == mart
    ),
    "loaded_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM ({query})"
        for name, query in (
            ("property_address", _sql("SELECT * FROM property_address", "all_properties", "property_address")),
            ("property_owner", _sql("SELECT * FROM property_owner", "property_owner")),
            ("bill", _sql("SELECT * FROM bill", "bill")),
            ("new_properties_by_fy", ORACLE_SQL["m02_new_properties_by_fy"]),
        )
    ),
    "raw_days": "SELECT (ts + INTERVAL 330 MINUTE)::DATE::VARCHAR AS day, count(*) AS events, sum(length(props))::BIGINT AS characters FROM events GROUP BY 1",
    "marts_by_name": f"""SELECT d.tenant_id, d.financial_year, d.total_outstanding, c.total_properties_with_demand, v.arrears_outstanding
        FROM ({ORACLE_SQL['m03_demand_and_collection_summary']}) d JOIN ({ORACLE_SQL['m10_property_demand_vs_assessed_by_fy']}) c USING (tenant_id, financial_year)
        JOIN ({ORACLE_SQL['v2_demand_collection_with_arrears']}) v USING (tenant_id, financial_year)""",
    # A snapshot after each night of the newest states so far, then the changes from one to the next.
    "repeated_nights": _sql(
        f"""SELECT tenant_id, property_type, {_fy("taken")} AS financial_year, sum(changed)::BIGINT AS total_updates, 0::BIGINT AS ownership_changes, 0::BIGINT AS area_changes, 0::BIGINT AS workflow_reopens,
        sum(changed)::BIGINT AS usage_category_changes, 0::BIGINT AS owner_count_changed FROM (
          SELECT *, coalesce((usage_category != lag(usage_category) OVER (PARTITION BY tenant_id, property_id ORDER BY night))::INT, 0) AS changed FROM (
            SELECT night, taken, tenant_id, property_id, property_type, usage_category FROM all_properties,
              (VALUES (0, TIMESTAMP '1999-03-31'), (1, TIMESTAMP '1999-04-01'), (2, TIMESTAMP '1999-04-02')) n(night, taken)
            WHERE CASE WHEN last_modified_time <= TIMESTAMP '1995-01-01' THEN 0 WHEN day(last_modified_time) <= 15 THEN 2 ELSE 1 END <= night
            QUALIFY row_number() OVER (PARTITION BY night, tenant_id, property_id ORDER BY last_modified_time DESC) = 1)) GROUP BY 1, 2, 3""",
        "all_properties",
    ),
}
