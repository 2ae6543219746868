"""What keeps time, memory and bytes in proportion to the tables."""

import glob
import time

import pyarrow.parquet as pq

from medallion_marts import queries
from medallion_marts.plans import refresh
from medallion_marts.sources import sample_tables as sample
from medallion_marts.sources import tables
from medallion_marts.sources.events import read_events
from medallion_marts.streaming.ingest import ingest


def test_raw_events_are_stored_compressed(spark, small, tmp_path, monkeypatch):
    """Ingested texts are stored with zstd, and the topic of `raw_ingest_counts` in short compressed files."""
    monkeypatch.setattr(queries, "TOPIC_ROWS", 1000)
    monkeypatch.setattr(queries, "_shared_dir", lambda spark: str(tmp_path))
    counted = sum(r["events"] for r in queries.raw_ingest_counts(spark, small).collect())
    lines = spark.read.parquet(f"{small}/lineitem.parquet").count()
    assert counted == sample.demand_events(spark, small).count() <= lines
    topic = glob.glob(f"{tmp_path}/ingest-*/topic/part-*")
    assert topic and all(f.endswith(".gz") for f in topic) and len(topic) >= counted / 1000
    raw = glob.glob(f"{tmp_path}/ingest-*/raw/*/*.parquet")
    kinds = {pq.ParquetFile(f).metadata.row_group(0).column(c).compression for f in raw for c in range(2)}
    assert kinds == {"ZSTD"}


def test_uncompressed_topics_are_read_too(spark, small, tmp_path):
    sample.demand_events(spark, small).limit(10).write.text(f"{tmp_path}/topic")
    ingest(read_events(spark, f"{tmp_path}/topic", "text"), f"{tmp_path}/raw", f"{tmp_path}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 10


def test_large_tables_are_not_spread_once_more(spark, small, monkeypatch):
    exchanges = lambda: sample.demand_events(spark, small)._jdf.queryExecution().optimizedPlan().toString().count("Repartition")
    assert exchanges() == 1
    rows = sorted(r.raw for r in sample.demand_events(spark, small).collect())
    monkeypatch.setattr(sample, "ONE_GROUP", 0)
    assert exchanges() == 0 and sorted(r.raw for r in sample.demand_events(spark, small).collect()) == rows


def test_backfill_is_worked_out_once(spark, small, tmp_path, monkeypatch):
    """Both runs write what is stored already, so neither joins details with headers again."""
    written = []
    write = queries.backfill.write_backfill
    monkeypatch.setattr(queries.backfill, "write_backfill", lambda rows, path: written.append(rows._jdf.queryExecution().optimizedPlan().toString()) or write(rows, path))
    assert queries.backfill_written(spark, small).count() > 0
    assert len(written) == 2 and not any("Join" in plan or "Window" in plan for plan in written)


def test_a_first_load_is_not_looked_through(spark, small, monkeypatch):
    """There is no stored state that its slices could touch; an empty first load and later ones still work."""
    cat, looked = queries._stored(spark, small), []
    touched = cat._touched
    monkeypatch.setattr(cat, "_touched", lambda rows: looked.append(1) or touched(rows))
    rows = sample.bill(spark, small)
    cat.upsert("bill", rows.limit(0), "0")
    cat.upsert("bill", rows, "1")
    assert not looked and cat.latest("bill").count() == rows.select("tenant_id", "bill_id").distinct().count()
    cat.upsert("bill", rows.limit(5), "2")
    assert looked and cat.latest("bill").count() == rows.select("tenant_id", "bill_id").distinct().count()


def test_pivot_makes_no_struct_for_each_detail(spark, small):
    """Structs cost more than the sums; missing details, heads and amounts that are no numbers still count as before."""
    plan = queries.silver_demand_pivot(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    lambdas = [line for line in plan.splitlines() if "_taxes" in line and "lambdafunction" in line]
    assert lambdas and not any("lambdafunction(struct" in line or "filter(" in line for line in lambdas)
    detail = lambda head, tax, paid: f'{{"taxHeadMasterCode":{head},"taxAmount":{tax},"collectionAmount":{paid}}}'
    details = ["null", "[]", "[null," + detail('"PT_TAX"', '"1.5"', '"x"') + "," + detail("null", '"2"', "null") + "," + detail('"PT_TAX"', '"3"', '"4"') + "]"]
    raw = spark.createDataFrame([(f'{{"tenantId":"t","demand":{{"id":"{k}","demandDetails":{d}}}}}',) for k, d in enumerate(details)], "raw string")
    got = {r.demand_id: tuple(map(float, (r.total_tax_amount, r.total_collection_amount, r.pt_tax, r.pt_tax_collection, r.pt_fire_cess))) for r in queries.silver.to_demand(raw).collect()}
    assert got == {"0": (0, 0, 0, 0, 0), "1": (0, 0, 0, 0, 0), "2": (6.5, 4, 4.5, 4, 0)}


def shuffle_files(spark):
    return set(glob.glob(f"{spark.conf.get('spark.local.dir')}/**/shuffle_*.data", recursive=True))


def test_writes_leave_no_shuffle_files(spark, small, monkeypatch):
    """What a load and a refresh have shuffled goes with them, not when the driver's heap is collected; sessions keep their setting."""
    cat, before, setting = queries._stored(spark, small), shuffle_files(spark), spark.conf.get(tables.CLEANUP)
    peak, write = set(), cat._write_newest
    monkeypatch.setattr(cat, "_write_newest", lambda *a: (write(*a), peak.update(shuffle_files(spark) - before)))
    queries._load_all(cat, small, ["bill", "payment", "property_address"])
    refresh.refresh_all(cat, ["payment_summary_by_fy", "new_properties_by_fy"])
    assert cat.mart("payment_summary_by_fy").count() > 0 and spark.conf.get(tables.CLEANUP) == setting and not tables._writes
    for _ in range(50):  # Spark deletes them in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not [f for f in left if f in peak] and len(left) <= 4  # those of reads by this test


def test_stored_tables_are_compressed(spark, small):
    cat = queries._load_all(queries._stored(spark, small), small, ["bill", "property_audit"])
    refresh.refresh_all(cat, ["property_change_metrics"])
    folder = spark.sql(f"DESCRIBE DATABASE {cat.database}").where("info_name = 'Location'").first()[1].removeprefix("file:")
    files = glob.glob(f"{folder}/**/*.parquet", recursive=True)
    assert {"bill", "bill_versions", "mart_property_change_metrics"} <= {f.removeprefix(folder).split("/")[1].split("__")[0] for f in files}
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_rows} == {"ZSTD"}


def test_large_entities_are_loaded_one_by_one(spark, small, monkeypatch):
    """So that the shuffle files of one load at a time are on disk; small ones still go together."""
    cat, under_way, most = queries._stored(spark, small), [], []

    def upsert(name, rows):
        under_way.append(name)
        most.append(len(under_way))
        time.sleep(1)
        under_way.remove(name)

    monkeypatch.setattr(cat, "upsert", upsert)
    for bound, expected in ((0, {1}), (10**9, {1, 2, 3})):
        monkeypatch.setattr(queries, "ONE_AT_A_TIME", bound)
        most.clear()
        queries._load_all(cat, small, ["bill", "payment", "assessment"])
        assert set(most) <= expected and max(most) == max(expected)
