"""Events to entities, streams, stored tables and refreshes."""

import json
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from medallion_marts.plans import marts, refresh, silver
from medallion_marts.sources import sample_tables as sample
from medallion_marts.sources.tables import TableCatalog
from medallion_marts.sources.events import quarantine, read_events, split_payload
from medallion_marts.streaming.ingest import ingest, raw_window


@pytest.fixture
def stored(spark, tmp_path):
    """stored(...) makes a catalog on a database of its own."""
    made = []

    def make(**params):
        made.append(f"db_{uuid.uuid4().hex}")
        return TableCatalog(spark, made[-1], str(tmp_path / made[-1]), **params)

    yield make
    for name in made:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def raws(spark, *documents):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "raw string")


def demand(key, details, at=1_700_000_000_000):
    return {"tenantId": "T", "demand": {"id": key, "status": "ACTIVE", "businessService": "PT", "financialYear": "2023-24", "demandDetails": details, "auditDetails": {"createdTime": at, "lastModifiedTime": at}}}


def head(code, tax, paid="0"):
    return {"taxHeadMasterCode": code, "taxAmount": tax, "collectionAmount": paid}


def test_tax_heads(spark):
    out = silver.to_demand(raws(spark, demand("a", [head("PT_TAX", "10.5", "1"), head("PT_TAX", "2"), head("PT_NEW", "3")]), demand("b", []), demand("c", None), demand("d", [head("PT_TAX", "rubbish")]), "{broken"))
    got = {r.demand_id: (r.total_tax_amount, r.total_collection_amount, r.pt_tax, r.pt_tax_collection, r.outstanding_amount) for r in out.collect()}
    zero = (D("0.00"), D("0.00"), D("0.0000"), D("0.0000"), D("0.0000"))
    assert got == {"a": (D("15.50"), D("1.00"), D("12.5000"), D("1.0000"), D("14.5000")), "b": zero, "c": zero, "d": zero}


def test_property_event(spark):
    event = {
        "tenantId": "T",
        "property": {
            "propertyId": "p", "propertyType": "BUILTUP", "status": "ACTIVE", "acknowldgementNumber": "ack", "landArea": "12.345",
            "units": [{"unitId": "u1", "floorNo": "2", "occupancyDate": "2020-02-29", "carpetArea": 10.5}, {"unitId": "u2", "floorNo": "roof"}],
            "owners": [{"ownerInfoUuid": "o1", "ownerId": "U1", "name": "secret", "ownershipPercentage": 50.0, "isPrimaryOwner": True}],
            "address": {"locality": {"code": "L1"}, "geoLocation": {"latitude": "31.5"}},
            "auditDetails": {"createdTime": 0, "lastModifiedTime": 1_700_000_000_123},
        },
    }
    raw = raws(spark, event)
    p = silver.to_property_address(raw).first()
    assert (p.acknowledgement_number, p.land_area, p.locality, p.latitude, p.country, p.survey_id) == ("ack", D("12.35"), "L1", D("31.500000"), "IN", "")
    assert p.last_modified_time.microsecond == 123_000
    assert [(u.unit_id, u.floor_no, u.carpet_area, u.active) for u in silver.to_property_unit(raw).orderBy("unit_id").collect()] == [("u1", 2, D("10.50"), 1), ("u2", 0, D("0.00"), 1)]
    owner = silver.to_property_owner(raw).first()
    assert (owner.owner_info_uuid, owner.user_id, owner.is_primary_owner, owner.ownership_percentage) == ("o1", "U1", 1, "50.0") and "secret" not in str(owner)


def test_payloads(spark):
    df = raws(spark, '{"a": 1}', '[{"a": 1}, {"a": 2}]', "", "  ", "{broken", "[broken", '"text"')
    good, bad = quarantine(split_payload(df))
    assert sorted(r.raw.replace(" ", "") for r in good.collect()) == ['{"a":1}', '{"a":1}', '{"a":2}']
    assert sorted(r.raw for r in bad.collect()) == ['"text"', "[broken", "{broken"]


def test_stream_restart_gives_no_duplicates(spark, tmp_path):
    folder, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    raws(spark, demand("a", []), demand("b", [])).write.text(folder)
    for _ in range(2):
        ingest(read_events(spark, folder, "text"), out, mark).awaitTermination()
    raws(spark, demand("c", [])).write.mode("append").text(folder)
    ingest(read_events(spark, folder, "text"), out, mark).awaitTermination()
    raw = spark.read.parquet(out)
    assert raw.count() == 3 and set(raw.columns) == {"event_time", "raw", "event_month"}
    day = raw.select(F.date_format("event_time", "yyyy-MM-dd")).first()[0]
    assert raw_window(raw, day).count() > 0 and raw_window(raw, "1999-01-01").count() == 0


def test_stream_quarantine(spark, tmp_path):
    folder, out, bad, mark = (str(tmp_path / x) for x in ("in", "out", "bad", "mark"))
    raws(spark, demand("a", []), "{broken").write.text(folder)
    ingest(read_events(spark, folder, "text"), out, mark, bad).awaitTermination()
    assert spark.read.parquet(out).count() == 1 and spark.read.parquet(bad).count() == 1
    with pytest.raises(Exception, match="broken messages"):
        ingest(read_events(spark, folder, "text"), out + "2", mark + "2", bad + "2", max_broken=0).awaitTermination()


def test_stored_entities(spark, stored):
    cat = stored()
    for at, status in ((1, "ACTIVE"), (3, "CLOSED"), (2, "ACTIVE")):
        event = demand("a", [head("PT_TAX", "5")], at * 1000)
        event["demand"]["status"] = status
        silver.run_silver(cat, {"demand_events_raw": raws(spark, event)})
    assert cat.versions("demand").count() == 3 and cat.latest("demand").first().demand_status == "CLOSED"
    silver.run_silver(cat, {"demand_events_raw": raws(spark, event)})  # the same again
    assert cat.latest("demand").count() == 1
    cat.compact("demand")
    assert cat.versions("demand").count() == 1 and cat.latest("demand").first().demand_status == "CLOSED"
    assert [tuple(r) for r in cat.counts_report(["demand"]).collect()] == [("demand", 1)]
    with pytest.raises(KeyError):
        cat.versions("bill")


def test_compaction_is_seen_at_once(spark, stored):
    """A frame made before reads the old versions, one made after the compacted ones; loads go on."""
    cat = stored()
    load = lambda key, at: cat.upsert("demand", silver.to_demand(raws(spark, demand(key, [], at))))
    load("a", 1000), load("a", 2000)
    before = cat.versions("demand")
    cat.compact("demand")
    assert before.count() == 2 and cat.versions("demand").count() == 1
    load("b", 3000)
    assert sorted(r.demand_id for r in cat.versions("demand").collect()) == sorted(r.demand_id for r in cat.latest("demand").collect()) == ["a", "b"]


def test_audit_is_appended_after_properties(spark, stored):
    cat = stored()
    event = {"tenantId": "T", "property": {"propertyId": "p", "status": "ACTIVE", "owners": [{"ownerInfoUuid": "o1"}, {"ownerInfoUuid": "o2"}], "units": [{"unitId": "u"}], "auditDetails": {"createdTime": 0, "lastModifiedTime": 5}}}
    workflow = spark.createDataFrame([("T", "p", "OPEN")], "tenant_id string, property_id string, workflow_state string")
    for _ in range(2):
        silver.run_silver(cat, {"property_events_raw": raws(spark, event)}, workflow)
    assert cat.versions("property_unit").count() == 2
    assert [(r.property_id, r.owner_count, r.workflow_state) for r in cat.versions("property_audit").collect()] == [("p", 2, "OPEN")] * 2


def test_broken_budget_is_for_a_block(spark, tmp_path, monkeypatch):
    from medallion_marts.streaming import ingest as module

    monkeypatch.setattr(module, "BLOCK_ROWS", 4)
    folder, out, bad, mark = (str(tmp_path / x) for x in ("in", "out", "bad", "mark"))
    raws(spark, *[x for k in range(6) for x in ("{broken", demand(f"a{k}", []), demand(f"b{k}", []), demand(f"c{k}", []))]).coalesce(1).write.text(folder)
    ingest(read_events(spark, folder, "text"), out, mark, bad, max_broken=1).awaitTermination()
    assert spark.read.parquet(out).count() == 18 and spark.read.parquet(bad).count() == 6


def test_refresh_is_repeatable(spark, small, stored):
    cat = stored()
    for name in sample.ENTITIES:
        cat.upsert(name, sample.full(spark, small, name))
    names = ["property_change_metrics", "property_risk_summary", "demand_and_collection_summary"]
    for _ in range(2):
        assert refresh.refresh_all(cat, names) == ["demand_and_collection_summary", "property_change_metrics", "property_risk_summary"]
    stored = cat.mart("property_risk_summary")
    assert stored.columns[0] == "data_refresh_date"
    assert stored.count() == marts.property_risk_summary(cat).count() > 0
    with pytest.raises(KeyError):
        refresh.refresh_all(cat, ["nothing"])


def test_sums_of_flags_agree(spark, small):
    cat = sample.catalog(spark, small)
    total = lambda df: df.agg(F.sum("total_updates")).first()[0]
    assert total(marts.property_risk_summary(cat)) == total(marts.property_changes_by_fy(cat))


def test_topics_are_read_as_told():
    """What the Kafka source is asked for; the connector itself is not installed here."""
    from medallion_marts.sources import events

    class Reader:
        def __init__(self):
            self.told = {}

        def format(self, name):
            self.told["format"] = name
            return self

        def option(self, key, value):
            self.told[key] = value
            return self

        def options(self, **more):
            self.told |= more
            return self

        def load(self):
            raise StopIteration

    class Session:
        readStream = Reader()

    with pytest.raises(StopIteration):
        events.read_events(Session, "property-events", **{"kafka.bootstrap.servers": "a:9092"})
    assert Session.readStream.told == {"format": "kafka", "subscribe": "property-events", "minPartitions": 3, "maxOffsetsPerTrigger": 65_536, "kafka.bootstrap.servers": "a:9092"}
