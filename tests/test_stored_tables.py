"""Stored tables: newest states, loads, plans without shuffles, refreshes and names."""

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_jobs import demand, head, raws

from medallion_marts import schemas
from medallion_marts.operators.latest import latest_state
from medallion_marts.plans import marts, refresh, silver, views
from medallion_marts.sources import sample_tables as sample
from medallion_marts.sources import tables
from medallion_marts.sources.catalog import FrameCatalog
from medallion_marts.sources.tables import TableCatalog

DEMAND = schemas.ENTITIES["demand"]


def database(spark, folder, **params):
    name = f"db_{uuid.uuid4().hex}"
    return TableCatalog(spark, name, f"{folder}/{name}", **params)


@pytest.fixture
def cat(spark, tmp_path):
    made = database(spark, tmp_path, slices=8)
    yield made
    spark.sql(f"DROP DATABASE {made.database} CASCADE")


@pytest.fixture(scope="module")
def full(spark, small, tmp_path_factory):
    """All sample entities, stored."""
    made = database(spark, tmp_path_factory.mktemp("tables"), buckets=4, slices=2)
    for name in sample.ENTITIES:
        made.upsert(name, sample.full(spark, small, name))
    yield made
    spark.sql(f"DROP DATABASE {made.database} CASCADE")


@pytest.fixture
def shuffled_joins(spark):
    """Without broadcasts, so that plans show what large tables would do."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def versions(spark, rows):
    """rows (demand_id, second of change, status)."""
    start = datetime(2024, 1, 1)
    return spark.createDataFrame([("T", k, start + timedelta(seconds=at), s) for k, at, s in rows], "tenant_id string, demand_id string, last_modified_time timestamp, demand_status string")


def state(df):
    return sorted((r.demand_id, r.last_modified_time, r.demand_status) for r in df.collect())


def recomputed(cat):
    return state(latest_state(cat.versions("demand"), DEMAND.keys, DEMAND.version, ["_ingested_at"]))


@pytest.mark.parametrize("small_load", [0, 100_000])
def test_loads_out_of_order_give_the_newest_state(spark, cat, monkeypatch, small_load):
    """Loads that are shuffled with the stored state, and ones that are broadcast to it."""
    monkeypatch.setattr(tables, "SMALL_LOAD", small_load)
    rng = random.Random(0)
    for load in ("c", "a", "b"):
        cat.upsert("demand", versions(spark, [(f"d{rng.randrange(40)}", rng.randrange(50), f"{load}{k}") for k in range(60)]).dropDuplicates(["demand_id", "last_modified_time"]), load)
        assert state(cat.latest("demand")) == recomputed(cat)
    assert cat.versions("demand").count() > cat.latest("demand").count() > 20


def test_equal_times_go_to_the_later_load(spark, cat):
    for load in ("1", "2"):
        cat.upsert("demand", versions(spark, [("a", 5, f"load {load}")]), load)
    assert state(cat.latest("demand"))[0][2] == "load 2"


def test_a_load_again_replaces_it(spark, cat):
    cat.upsert("demand", versions(spark, [("a", 1, "first"), ("b", 1, "first")]), "night 1")
    cat.upsert("demand", versions(spark, [("a", 9, "wrong"), ("c", 9, "wrong"), ("d", 9, "same")]), "night 2")
    cat.upsert("demand", versions(spark, [("d", 9, "same"), ("b", 5, "right")]), "night 2")
    assert [(k, s) for k, _, s in state(cat.latest("demand"))] == [("a", "first"), ("b", "right"), ("d", "same")]
    cat.upsert("demand", versions(spark, [("a", 1, "x")]).limit(0), "night 2")
    assert [(k, s) for k, _, s in state(cat.latest("demand"))] == [("a", "first"), ("b", "first")] and state(cat.latest("demand")) == recomputed(cat)


def test_only_touched_slices_are_rewritten(spark, cat):
    cat.upsert("demand", versions(spark, [(f"d{k}", 1, "old") for k in range(200)]))
    files = lambda: {f for f in spark.table(cat.name("demand")).inputFiles()}
    before, slice_of = files(), lambda f: f.split("slice=")[1].split("/")[0]
    cat.upsert("demand", versions(spark, [("d7", 2, "new")]))
    changed = {slice_of(f) for f in before ^ files()}
    assert len(changed) == 1 and len({slice_of(f) for f in before}) == 8
    assert sorted(s for _, _, s in state(cat.latest("demand"))) == ["new"] + ["old"] * 199


def test_newest_states_are_read_without_a_shuffle(spark, full):
    for name, spec in schemas.ENTITIES.items():
        if spec.version and full.exists(name):
            plan = plan_of(full.latest(name))
            assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
    # One that works it out from stored rows clustered by the key needs none either.
    bills = latest_state(full.latest("bill"), ["tenant_id", "bill_id"], "last_modified_time")
    assert "Exchange" not in plan_of(bills)


@pytest.mark.parametrize(
    "mart,shuffles",
    [
        ("rebate_summary_by_fy", 1),  # demands and properties meet by bucket; the sums are shuffled
        ("property_payment_mode_by_fy", 1),
        ("collection_by_transaction_fy_and_demand_fy", 1),
        ("payment_summary_by_fy", 2),  # payments and bills meet by bucket, then by what bills say
        ("assessment_summary_by_fy", 3),  # distinct types and users are within a property's bucket
    ],
)
def test_joins_of_stored_entities(full, shuffled_joins, mart, shuffles):
    plan = plan_of(marts.MARTS[mart](full))
    assert plan.count("Exchange hashpartitioning") == shuffles and "Window" not in plan


def test_reads_are_found(spark):
    assert refresh.reads(spark, "property_risk_summary") == (set(), {"property_change_metrics"})
    assert refresh.reads(spark, "property_demand_vs_assessed_by_fy") == ({"assessment"}, {"properties_with_demand_by_fy"})
    assert refresh.reads(spark, "payment_summary_by_fy") == ({"payment", "bill", "property_address"}, set())


def test_marts_wait_for_what_they_read(full, monkeypatch):
    order = []
    monkeypatch.setattr(refresh, "refresh_mart", lambda cat, name: order.append(name))
    assert refresh.refresh_all(full, at_once=3) == list(marts.MARTS) and sorted(order) == sorted(marts.MARTS)
    for mart in marts.MARTS:
        assert all(order.index(before) < order.index(mart) for before in refresh.reads(full.spark, mart)[1])


def test_a_failed_mart_stops_those_that_read_it(full, monkeypatch):
    order = []

    def one(cat, name):
        if name == "property_change_metrics":
            raise ValueError("broken")
        order.append(name)

    monkeypatch.setattr(refresh, "refresh_mart", one)
    with pytest.raises(ValueError, match="broken"):
        refresh.refresh_all(full, at_once=2)
    assert not {"property_risk_summary", "property_changes_by_fy"} & set(order)


def test_readers_see_one_state(spark, cat):
    """A reader that came before a refresh reads on; the next one sees the new mart; older tables go."""
    load = lambda key, tax, at: cat.upsert("demand", silver.to_demand(raws(spark, demand(key, [head("PT_TAX", tax)], at))))
    name = "demand_and_collection_summary"
    load("a", "5", 1000)
    refresh.refresh_all(cat, [name])
    first = spark.table(cat.name(f"mart_{name}"))
    load("b", "7", 2000)
    assert first.collect() == cat.mart(name).collect()  # not refreshed yet
    refresh.refresh_all(cat, [name])
    assert (first.first().total_demand, cat.mart(name).first().total_demand) == (5, 12)
    for _ in range(3):
        refresh.refresh_all(cat, [name])
    assert len([t for t in spark.catalog.listTables(cat.database) if t.name.startswith(f"mart_{name}__")]) == 2


def property_event(key, usage, at, owners=1):
    return {"tenantId": "T", "property": {"propertyId": key, "status": "ACTIVE", "usageCategory": usage, "owners": [{"ownerInfoUuid": f"{key}-{k}"} for k in range(owners)], "auditDetails": {"createdTime": 0, "lastModifiedTime": at}}}


def test_a_night_again_changes_nothing(spark, cat):
    nights = {
        "2024-03-30": [property_event("p", "HOME", 10), property_event("q", "HOME", 10)],
        "2024-03-31": [property_event("p", "SHOP", 20, 2)],
        "2024-04-01": [property_event("q", "SHOP", 5), property_event("p", "HOME", 30, 2)],  # q's is older than what is stored
    }
    run = lambda day: silver.run_silver(cat, {"property_events_raw": raws(spark, *nights[day])}, day=day)
    names = ["property_change_metrics", "property_risk_summary", "property_changes_by_fy"]

    def found():
        refresh.refresh_all(cat, names)
        return [sorted(map(str, cat.mart(n).drop("data_refresh_date").collect())) for n in names]

    for day in nights:
        run(day)
    first = found()
    metrics = {(r.property_id, str(r.audit_created_time)): (r.usage_category_changed, r.owners_changed) for r in cat.mart(names[0]).collect()}
    assert metrics == {
        ("p", "2024-03-31 00:00:00"): (0, 0), ("q", "2024-03-31 00:00:00"): (0, 0), ("p", "2024-04-01 00:00:00"): (1, 1), ("q", "2024-04-01 00:00:00"): (0, 0),
        ("p", "2024-04-02 00:00:00"): (1, 0), ("q", "2024-04-02 00:00:00"): (0, 0),
    }
    assert {(r.financial_year, r.total_updates) for r in cat.mart(names[2]).collect()} == {("2023-24", 0), ("2024-25", 3)}
    for day in ("2024-04-01", "2024-03-31", "2024-04-01"):
        run(day)
        assert found() == first
    assert cat.versions("property_audit").count() == 6


def test_events_are_given_back_when_a_night_fails(spark, cat, monkeypatch):
    monkeypatch.setattr(cat, "upsert", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        silver.run_silver(cat, {"demand_events_raw": raws(spark, demand("a", []))})
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_views_by_name_are_the_views(spark, full):
    wanted = ["demand_and_collection_summary", "collections_by_month", "payment_summary_by_fy"]
    refresh.refresh_all(full, wanted)
    frames = refresh.create_views(full, 1995)
    same = {"cumulative_collections_by_month": {}, "demand_collection_with_arrears": {"min_fy_start": 1995}, "payment_summary_with_last_year": {}}
    for name, params in same.items():
        expected = views.VIEWS[name](full, **params)
        got = spark.sql(f"SELECT * FROM {full.name(f'v_{name}')}")
        assert sorted(got.columns) == sorted(expected.columns) == sorted(frames[name].columns)
        assert sorted(map(str, got.select(*expected.columns).collect())) == sorted(map(str, expected.collect())) != []
    mart = spark.table(full.name("mart_collections_by_month"))
    assert [(f.name, f.dataType) for f in mart.schema][1:] == [(f.name, f.dataType) for f in schemas.mart_schema("collections_by_month")]


def test_a_zone_holds_in_every_session(spark):
    """Fiscal years, months and days of Kolkata, whatever the session's zone is."""
    rows = [(datetime(2024, 3, 31, 18, 29), 1), (datetime(2024, 3, 31, 18, 30), 2), (datetime(2023, 12, 31, 23, 0), 4), (datetime(1969, 12, 31, 18, 30), 8)]
    key, found = "spark.sql.session.timeZone", []
    for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
        spark.conf.set(key, zone)
        try:
            moments = spark.createDataFrame([(int(t.replace(tzinfo=__import__("datetime").timezone.utc).timestamp()), n) for t, n in rows], "s long, n int")
            at = F.timestamp_seconds("s")
            paid = moments.select(F.lit("T").alias("tenant_id"), F.col("n").cast("string").alias("payment_id"), F.lit("PT").alias("businessservice"), F.lit("NEW").alias("payment_status"), at.alias("transaction_date"), at.alias("created_time"), at.alias("last_modified_time"), F.col("n").cast("decimal(12,2)").alias("total_amount_paid"))
            cat = FrameCatalog(spark, {"payment": paid}, zone="Asia/Kolkata")
            months = sorted((r.financial_year, r.year_month, int(r.total_collected_amount)) for r in marts.collections_by_month(cat).collect())
            days = sorted((str(r.collection_date), int(r.total_amount)) for r in marts.daily_collection_summary(cat).collect())
            found.append((months, days))
        finally:
            spark.conf.set(key, "UTC")
    assert found[0] == found[1] == found[2]
    assert found[0][0] == [("1969-70", "1970-01", 8), ("2023-24", "2024-01", 4), ("2023-24", "2024-03", 1), ("2024-25", "2024-04", 2)]
    assert found[0][1] == [("1970-01-01", 8), ("2024-01-01", 4), ("2024-03-31", 1), ("2024-04-01", 2)]


def history(cat):
    """M7 worked out over the whole history."""
    audit = cat.versions("property_audit")
    return marts.property_change_metrics(FrameCatalog(cat.spark, {"property_audit": audit}))


def test_changes_are_carried_from_night_to_night(spark, cat):
    """What nights store is M7 over the whole history, in order, out of order and run again."""
    rng = random.Random(3)

    def run(day):
        rows = [(f"p{rng.randrange(12)}", rng.choice("ab"), rng.choice("xy"), rng.randrange(3), datetime.fromisoformat(day) + timedelta(hours=h)) for h in range(10)]
        frame = spark.createDataFrame([("T", *r) for r in rows], "tenant_id string, property_id string, ownership_category string, usage_category string, owner_count int, audit_created_time timestamp")
        cat.upsert("property_audit", frame, day)
        silver.advance_changes(cat, day)

    for day in ("2024-01-02", "2024-01-03", "2024-01-05", "2024-01-04", "2024-01-01", "2024-01-06", "2024-01-03", "2024-01-06"):
        run(day)
        stored = cat.change_metrics()
        assert sorted(map(str, stored.collect())) == sorted(map(str, history(cat).collect()))
    assert stored.agg(F.sum("usage_category_changed")).first()[0] > 5
    one = cat.versions("property_audit").limit(1)
    cat.upsert("property_audit", spark.createDataFrame(one.collect(), one.schema), "2024-02-01")  # changes are not stored for it
    assert cat.change_metrics() is None and marts.property_change_metrics(cat).count() == history(cat).count()


def test_a_night_reads_no_older_snapshots(spark, cat):
    for day in ("2024-01-01", "2024-01-02"):
        silver.run_silver(cat, {"property_events_raw": raws(spark, property_event("p", day, 10))}, day=day)
    one = cat.versions("property_audit").limit(1)
    cat.upsert("property_audit", spark.createDataFrame(one.collect(), one.schema), "2024-01-03")
    before, snapshots, newest = cat.changes_before("2024-01-03")
    assert newest and all("load=2024-01-03" in f for f in snapshots.inputFiles())
    assert all("property_audit_last" in f for f in before.inputFiles())


def test_backfill_files_are_few_and_sorted(spark, small, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from medallion_marts.plans import backfill

    key, path = "spark.sql.shuffle.partitions", str(tmp_path / "rows")
    rows = backfill.backfill_demand_details(sample.backfill_details(spark, small), sample.backfill_headers(spark, small)).repartition(20)
    before = spark.conf.get(key)
    spark.conf.set(key, "200")
    try:
        backfill.write_backfill(rows, path)
    finally:
        spark.conf.set(key, before)
    months = glob.glob(f"{path}/month=*")
    assert len(months) > 50
    for month in months:
        files = glob.glob(f"{month}/*.parquet")
        assert len(files) <= 2
        for f in files:
            times = pq.ParquetFile(f).read(["last_modified_time"])["last_modified_time"].to_pylist()
            assert times == sorted(times)
    day = spark.read.parquet(path).where("month = '199606' AND last_modified_time < '1996-06-03'")
    assert "PushedFilters: [IsNotNull(last_modified_time), LessThan(last_modified_time" in day._jdf.queryExecution().executedPlan().toString()


def test_buckets_grow_with_the_tables(spark, small, monkeypatch):
    """A bucket, which one task sorts and writes, holds no more rows when tables are larger."""
    from medallion_marts import queries

    assert [tables.buckets_for(n) for n in (0, 600_000, 36_000_000, 216_000_000)] == [8, 8, 36, 216]
    monkeypatch.setattr(tables, "ROWS_A_BUCKET", 500)
    stored = queries._stored(spark, small)
    lines = spark.read.parquet(f"{small}/lineitem.parquet").count()
    assert stored.buckets == -(-lines // 500) > 8
    queries._load_all(stored, small, ["demand"])
    most = stored.latest("demand").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most <= 500
