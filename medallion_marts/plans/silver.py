"""Raw JSON events to entity tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.fiscal import fiscal_year, midnight
from ..functions.values import head_sums, heads_of, millis, pivot_heads, total_of
from ..operators.latest import conform, latest_state
from ..operators.windows import change_flags


#: Change flags of audit snapshots, and the columns that each looks at.
FLAGS = {
    "ownership_category_changed": ["ownership_category"],
    "usage_category_changed": ["usage_category"],
    "area_changed": ["super_built_up_area", "land_area"],
    "workflow_state_changed": ["workflow_state"],
    "owners_changed": ["owner_count"],
}


def parsed(raw: DataFrame, shape: str) -> DataFrame:
    """The event as columns; texts that are not such an object are left out. What is parsed already stays."""
    if "raw" not in raw.columns:
        return raw
    event = F.from_json("raw", shape, {"mode": "PERMISSIVE"})
    kept = [c for c in ("_ingested_at",) if c in raw.columns]
    # Through a generator, as a filter on the parsed event would be pushed down and parse every text once more.
    return raw.select(*kept, F.inline(F.array(event))).where(F.col("tenantId").isNotNull())


def _audit(of: str) -> list[Column]:
    a = f"{of}.auditDetails"
    return [
        F.col(f"{a}.createdBy").alias("created_by"),
        millis(F.col(f"{a}.createdTime")).alias("created_time"),
        F.col(f"{a}.lastModifiedBy").alias("last_modified_by"),
        millis(F.col(f"{a}.lastModifiedTime")).alias("last_modified_time"),
    ]


def _entity(df: DataFrame, name: str) -> DataFrame:
    spec = schemas.ENTITIES[name]
    return conform(df, spec.schema, spec.defaults)


def _named(df: DataFrame, columns: dict[str, str | Column], *more: Column) -> DataFrame:
    stamp = ["_ingested_at"] if "_ingested_at" in df.columns else []
    return df.select(*stamp, *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()], *more)


_PROPERTY = {
    "tenant_id": "tenantId",
    "property_id": "property.propertyId",
    "property_type": "property.propertyType",
    "ownership_category": "property.ownershipCategory",
}


def to_property_address(raw: DataFrame) -> DataFrame:
    """One row per property event, with its address."""
    p, a = "property", "property.address"
    columns = _PROPERTY | {
        "usage_category": f"{p}.usageCategory",
        "status": f"{p}.status",
        "acknowledgement_number": f"{p}.acknowldgementNumber",  # spelt so in the events
        "source": f"{p}.source",
        "channel": f"{p}.channel",
        "land_area": F.col(f"{p}.landArea").try_cast("decimal(10,2)"),
        "financial_year": f"{p}.financialYear",
        "door_no": f"{a}.doorNo",
        "building_name": f"{a}.buildingName",
        "street": f"{a}.street",
        "locality": f"{a}.locality.code",
        "city": f"{a}.city",
        "district": f"{a}.district",
        "region": f"{a}.region",
        "state": f"{a}.state",
        "country": f"{a}.country",
        "pin_code": f"{a}.pinCode",
        "latitude": F.col(f"{a}.geoLocation.latitude").try_cast("decimal(9,6)"),
        "longitude": F.col(f"{a}.geoLocation.longitude").try_cast("decimal(10,7)"),
    }
    return _entity(_named(parsed(raw, schemas.PROPERTY_EVENT), columns, *_audit("property")), "property_address")


def to_property_unit(raw: DataFrame) -> DataFrame:
    """One row per unit of a property event; times are the property's."""
    df = parsed(raw, schemas.PROPERTY_EVENT).withColumn("u", F.explode("property.units"))
    columns = _PROPERTY | {
        "property_status": "property.status",
        "unit_id": "u.unitId",
        "floor_no": F.col("u.floorNo").try_cast("tinyint"),
        "unit_type": "u.unitType",
        "usage_category": "u.usageCategory",
        "occupancy_type": "u.occupancyType",
        "occupancy_date": F.col("u.occupancyDate").try_cast("date"),
        "carpet_area": "u.carpetArea",
        "built_up_area": "u.builtUpArea",
        "arv": "u.arvAmount",
    }
    return _entity(_named(df, columns, *_audit("property")), "property_unit")


def to_property_owner(raw: DataFrame) -> DataFrame:
    """One row per owner of a property event; names and contacts are not carried over."""
    df = parsed(raw, schemas.PROPERTY_EVENT).withColumn("o", F.explode("property.owners"))
    columns = _PROPERTY | {
        "property_status": "property.status",
        "owner_info_uuid": "o.ownerInfoUuid",
        "user_id": "o.ownerId",
        "status": "o.status",
        "is_primary_owner": F.col("o.isPrimaryOwner").cast("int"),
        "owner_type": "o.ownerType",
        "ownership_percentage": "o.ownershipPercentage",
        "institution_id": "o.institutionId",
        "relationship": "o.relationship",
    }
    return _entity(_named(df, columns, *_audit("property")), "property_owner")


def to_demand(raw: DataFrame) -> DataFrame:
    """One row per demand event: totals over all tax heads, a column for each known one."""
    # The sums are columns of their own, so that each is worked out once for all the columns below.
    details = F.col("demand.demandDetails")
    df = parsed(raw, schemas.DEMAND_EVENT).withColumn("_heads", heads_of(details))
    df = df.withColumns({"_taxes": head_sums(details, F.col("_heads"), "taxAmount"), "_collections": head_sums(details, F.col("_heads"), "collectionAmount")})
    df = df.withColumns({"_tax": total_of(F.col("_taxes")), "_collected": total_of(F.col("_collections"))})
    tax, collected = F.col("_tax"), F.col("_collected")
    columns = {
        "tenant_id": "tenantId",
        "demand_id": "demand.id",
        "consumer_code": "demand.consumerCode",
        "consumer_type": "demand.consumerType",
        "business_service": "demand.businessService",
        "payer": F.to_json("demand.payer"),
        "tax_period_from": millis(F.col("demand.taxPeriodFrom")),
        "tax_period_to": millis(F.col("demand.taxPeriodTo")),
        "demand_status": "demand.status",
        "financial_year": "demand.financialYear",
        "minimum_amount_payable": F.col("demand.minimumAmountPayable").try_cast("decimal(18,4)"),
        "total_tax_amount": tax,
        "total_collection_amount": collected,
        "outstanding_amount": tax - collected,
        "is_paid": F.col("demand.isPaymentCompleted").cast("int"),
    }
    heads = [*pivot_heads(F.col("_taxes"), schemas.TAX_HEADS), *pivot_heads(F.col("_collections"), schemas.TAX_HEADS, "_collection")]
    return _entity(_named(df, columns, *heads, *_audit("demand")), "demand")


def to_bill_detail(rows: DataFrame, zone: str | None = None) -> DataFrame:
    """Bill details with the fiscal year of their period's start."""
    return _entity(rows.withColumn("financial_year", fiscal_year(millis(F.col("from_period")), zone=zone)), "bill_detail")


def audit_snapshot(properties: DataFrame, owners: DataFrame, workflow: DataFrame | None = None) -> DataFrame:
    """A snapshot row of every property's newest state with its number of owners.

    workflow has (tenant_id, property_id, workflow_state), which events do not carry.
    """
    p, o = schemas.ENTITIES["property_address"], schemas.ENTITIES["property_owner"]
    tie = lambda df: ["_ingested_at"] if "_ingested_at" in df.columns else []
    return snapshot_of(latest_state(properties, p.keys, p.version, tie(properties)), latest_state(owners, o.keys, o.version, tie(owners)), workflow)


def snapshot_of(newest: DataFrame, owners: DataFrame, workflow: DataFrame | None = None, at: Column | None = None) -> DataFrame:
    """`audit_snapshot` of newest states, taken at a time (now, if none is given)."""
    counts = owners.groupBy("tenant_id", "property_id").agg(F.count("*").cast("int").alias("owner_count"))
    out = newest.withColumnRenamed("status", "property_status").join(counts, ["tenant_id", "property_id"], "left")
    if workflow is not None:
        out = out.join(workflow, ["tenant_id", "property_id"], "left")
    return _entity(out.drop("_ingested_at").withColumns({"audit_created_time": F.current_timestamp() if at is None else at, "_ingested_at": F.current_timestamp()}), "property_audit")


#: Raw event table -> shape of its events and the entities that come from them.
JOBS = {
    "property_events_raw": (schemas.PROPERTY_EVENT, {"property_address": to_property_address, "property_unit": to_property_unit, "property_owner": to_property_owner}),
    "demand_events_raw": (schemas.DEMAND_EVENT, {"demand": to_demand}),
}


def append_audit(catalog, workflow: DataFrame | None = None, day: str | None = None) -> None:
    """Appends a snapshot of all properties to their history.

    With a day: the snapshot of the midnight after it, of what loads up to that day have brought, in
    place of that day's snapshot if there is one.
    """
    if day is None:
        newest, at = catalog.latest, None
    else:
        newest, at = (lambda name: catalog.latest_by(name, day)), midnight(day, catalog.zone, 1)
    catalog.upsert("property_audit", snapshot_of(newest("property_address"), newest("property_owner"), workflow, at), day)
    if day is not None:
        advance_changes(catalog, day)


def advance_changes(catalog, load: str) -> None:
    """Stores what changed with a load of audit snapshots.

    Each property's last snapshot is carried from night to night, so only the new load goes through
    the window. A load that is run again, or that comes out of order, is worked out with all after it.
    """
    before, snapshots, newest = catalog.changes_before(load)
    both = before.withColumn("load", F.lit(None).cast("string")).unionByName(snapshots)
    flags = change_flags(both, ["tenant_id", "property_id"], ["audit_created_time", "_ingested_at"], FLAGS)
    catalog.put_changes(flags.where(F.col("load").isNotNull()))
    if newest:
        catalog.keep_newest("property_audit_last", snapshots.drop("load"))
    else:
        catalog.keep_newest("property_audit_last", catalog.versions("property_audit"), anew=True)


def run_silver(catalog, raw: dict[str, DataFrame], workflow: DataFrame | None = None, day: str | None = None) -> None:
    """Appends the versions found in a day's raw events (by raw table) to the entities; after properties, an audit snapshot.

    Events are parsed once for all entities that come from them. With a day (yyyy-MM-dd) the run is a
    load of that name: running it again replaces what it brought before.
    """
    for source, (shape, entities) in JOBS.items():
        if source in raw:
            events = parsed(raw[source], shape).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                for name, job in entities.items():
                    catalog.upsert(name, job(events), day)
            finally:
                events.unpersist()
    if "property_events_raw" in raw:
        append_audit(catalog, workflow, day)
