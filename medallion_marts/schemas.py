"""Fixed table definitions: columns, keys and version columns.

Names, types and defaults are fixed values that stored data and dashboards depend on.
No column holds nulls: a missing value is its type's default ('' , 0, false, 1970-01-01).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

TIME = "timestamp"
#: Tax heads with columns of their own, as `pt_x` and `pt_x_collection`.
TAX_HEADS = (
    "PT_TAX",
    "PT_CANCER_CESS",
    "PT_FIRE_CESS",
    "PT_ROUNDOFF",
    "PT_OWNER_EXEMPTION",
    "PT_UNIT_USAGE_EXEMPTION",
    "PT_ADVANCE_CARRYFORWARD",
    "PT_DECIMAL_CEILING_DEBIT",
    "PT_TIME_REBATE",
    "PT_DECIMAL_CEILING_CREDIT",
    "PT_TIME_PENALTY",
    "PT_ADHOC_PENALTY",
    "PT_ADHOC_REBATE",
    "PT_TIME_INTEREST",
)
_AUDIT = f"created_by string, created_time {TIME}, last_modified_by string, last_modified_time {TIME}"
_PARENT = "property_id string, property_type string, ownership_category string, property_status string, no_of_floors tinyint"
_HEADS = ", ".join(f"{head.lower()}{tail} decimal(18,4)" for tail in ("", "_collection") for head in TAX_HEADS)


@dataclass(frozen=True)
class Table:
    """A stored table; without a version it is a plain history that is only appended to."""

    columns: str
    keys: tuple[str, ...] = ()
    version: str | None = "last_modified_time"
    defaults: dict = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)


ENTITIES: dict[str, Table] = {
    "property_address": Table(
        f"_ingested_at {TIME}, id string, tenant_id string, property_id string, survey_id string, account_id string, old_property_id string, "
        "property_type string, usage_category string, ownership_category string, status string, acknowledgement_number string, "
        "creation_reason string, no_of_floors tinyint, source string, channel string, land_area decimal(10,2), super_built_up_area decimal(10,2), "
        f"{_AUDIT}, financial_year string, additionaldetails string, door_no string, plot_no string, building_name string, street string, "
        "landmark string, locality string, city string, district string, region string, state string, country string, pin_code string, "
        "latitude decimal(9,6), longitude decimal(10,7)",
        ("tenant_id", "property_id"),
        defaults={"country": "IN"},
    ),
    "property_unit": Table(
        f"_ingested_at {TIME}, tenant_id string, property_uuid string, unit_id string, floor_no tinyint, unit_type string, usage_category string, "
        "occupancy_type string, occupancy_date date, carpet_area decimal(10,2), built_up_area decimal(18,2), plinth_area decimal(10,2), "
        f"super_built_up_area decimal(10,2), arv decimal(12,2), construction_type string, construction_date bigint, active int, {_AUDIT}, {_PARENT}",
        ("tenant_id", "unit_id"),
        defaults={"active": 1},
    ),
    "property_owner": Table(
        f"_ingested_at {TIME}, tenant_id string, property_uuid string, owner_info_uuid string, user_id string, status string, is_primary_owner int, "
        f"owner_type string, ownership_percentage string, institution_id string, relationship string, {_AUDIT}, {_PARENT}",
        ("tenant_id", "owner_info_uuid"),
    ),
    "demand": Table(
        f"_ingested_at {TIME}, tenant_id string, demand_id string, consumer_code string, consumer_type string, business_service string, payer string, "
        f"tax_period_from {TIME}, tax_period_to {TIME}, demand_status string, financial_year string, minimum_amount_payable decimal(18,4), "
        "bill_expiry_time bigint, fixed_bill_expiry_date bigint, total_tax_amount decimal(12,2), total_collection_amount decimal(12,2), "
        f"{_HEADS}, outstanding_amount decimal(18,4), is_paid int, {_AUDIT}",
        ("tenant_id", "demand_id"),
    ),
    "payment": Table(
        f"_ingested_at {TIME}, tenant_id string, payment_id string, total_due decimal(12,2), total_amount_paid decimal(12,2), transaction_number string, "
        f"transaction_date {TIME}, payment_mode string, instrument_date {TIME}, instrument_number string, instrument_status string, ifsc_code string, "
        f"additional_details string, payer_id string, payment_status string, {_AUDIT}, financial_year string, filestore_id string, receiptnumber string, "
        f"receiptdate {TIME}, receipttype string, businessservice string, billid string, manualreceiptnumber string, manualreceiptdate {TIME}",
        ("tenant_id", "payment_id"),
    ),
    "bill": Table(
        f"_ingested_at {TIME}, tenant_id string, bill_id string, status string, iscancelled boolean, additionaldetails string, "
        "collectionmodesnotallowed string, partpaymentallowed boolean, isadvanceallowed boolean, minimumamounttobepaid decimal(12,2), "
        f"businessservice string, totalamount decimal(12,2), consumercode string, billnumber string, billdate {TIME}, reasonforcancellation string, "
        f"{_AUDIT}, financial_year string",
        ("tenant_id", "bill_id"),
    ),
    "assessment": Table(
        f"_ingested_at {TIME}, tenant_id string, assessmentnumber string, financialyear string, propertyid string, status string, source string, "
        f"channel string, assessmentdate {TIME}, additionaldetails string, {_AUDIT}",
        ("tenant_id", "assessmentnumber"),
    ),
    "property_audit": Table(
        f"_ingested_at {TIME}, tenant_id string, property_id string, property_type string, ownership_category string, usage_category string, "
        "property_status string, workflow_state string, super_built_up_area decimal(18,2), land_area decimal(18,2), owner_count int, "
        f"audit_created_time {TIME}, created_time {TIME}, last_modified_time {TIME}",
        version=None,
    ),
    "bill_detail": Table(
        f"_ingested_at {TIME}, id string, tenant_id string, demand_id string, bill_id string, amount decimal(12,2), amount_paid decimal(12,2), "
        "from_period bigint, to_period bigint, additional_details string, channel string, voucher_header string, boundary string, "
        "collection_type string, bill_description string, expiry_date string, display_message string, call_back_for_apportioning string, "
        f"cancellation_remarks string, {_AUDIT}, financial_year string",
        ("tenant_id", "id"),
    ),
}

#: Each property's last audit snapshot, which the next night's is compared with.
LAST_AUDIT = Table(ENTITIES["property_audit"].columns, ("tenant_id", "property_id"), "audit_created_time")
RAW = Table(f"event_time {TIME}, raw string", version=None)
DIMENSION = Table(f"code string, locale string, value string, created_time {TIME}", ("locale", "code"), "created_time")
DIMENSIONS = tuple(f"dimension_{n}" for n in ("tenant_id", "property_type", "usage_category", "ownership_category", "payment_mode", "locality", "zone", "block"))

_CHANGES = "total_updates bigint, ownership_changes bigint, area_changes bigint, workflow_reopens bigint, usage_category_changes bigint, owner_count_changed bigint"
MARTS: dict[str, str] = {
    "active_property_distribution_summary": "tenant_id string, property_type string, ownership_category string, usage_category string, property_count bigint",
    "new_properties_by_fy": "tenant_id string, financial_year string, new_property_count bigint",
    "demand_and_collection_summary": "tenant_id string, financial_year string, total_demand decimal(18,2), total_collection decimal(18,2), total_outstanding decimal(18,4)",
    "collections_by_month": "tenant_id string, financial_year string, year_month string, payment_status string, total_payments bigint, total_collected_amount decimal(18,4)",
    "properties_with_demand_by_fy": "tenant_id string, financial_year string, properties_with_demand string",
    "defaulters": "tenant_id string, property_id string, demand_id string, financial_year string, total_tax_amount decimal(12,2), total_collection_amount decimal(12,2), outstanding_amount decimal(12,4)",
    "property_change_metrics": "tenant_id string, property_id string, property_type string, ownership_category_changed int, usage_category_changed int, area_changed int, workflow_state_changed int, owners_changed int, audit_created_time timestamp",
    "property_risk_summary": f"tenant_id string, property_id string, property_type string, {_CHANGES}, risk_score int",
    "property_changes_by_fy": f"tenant_id string, property_type string, financial_year string, {_CHANGES}",
    "property_demand_vs_assessed_by_fy": "tenant_id string, financial_year string, total_properties_assessed bigint, total_properties_with_demand bigint, total_properties_with_demand_no_assessment bigint, total_properties_with_assessment_no_demand bigint",
    "assessment_summary_by_fy": "tenant_id string, financial_year string, property_type string, channel string, total_assessments bigint, assessments_by_owner bigint, assessments_by_others bigint",
    "payment_summary_by_fy": "tenant_id string, financial_year string, property_type string, payment_mode string, total_payments bigint, total_amount_collected decimal(18,2), total_part_payments bigint, total_amount_collected_in_part_payments decimal(18,2)",
    "rebate_summary_by_fy": "tenant_id string, financial_year string, property_type string, avg_rebate_amount decimal(18,4), total_rebate_amount decimal(18,4), demands_with_rebate bigint",
    "daily_collection_summary": "tenant_id string, payment_status string, collection_date date, total_amount decimal(18,2)",
    "property_payment_mode_by_fy": "tenant_id string, property_id string, payment_mode string, financial_year string, total_payments bigint",
    "collection_by_transaction_fy_and_demand_fy": "tenant_id string, transaction_financial_year string, bill_financial_year string, total_amount_paid decimal(18,4)",
}


def mart_schema(name: str) -> StructType:
    return StructType.fromDDL(MARTS[name])


#: Shapes of the incoming JSON documents, as far as they are read.
_EVENT_AUDIT = "auditDetails struct<createdBy:string,createdTime:bigint,lastModifiedBy:string,lastModifiedTime:bigint>"
PROPERTY_EVENT = (
    "tenantId string, property struct<propertyId:string,propertyType:string,usageCategory:string,ownershipCategory:string,status:string,"
    "acknowldgementNumber:string,financialYear:string,source:string,channel:string,landArea:string,"
    "units:array<struct<unitId:string,floorNo:string,unitType:string,usageCategory:string,occupancyType:string,occupancyDate:string,"
    "carpetArea:decimal(10,2),builtUpArea:decimal(18,2),arvAmount:decimal(12,2)>>,"
    "owners:array<struct<ownerId:string,relationship:string,ownerType:string,ownerInfoUuid:string,institutionId:string,"
    "ownershipPercentage:string,isPrimaryOwner:boolean,status:string>>,"
    "address:struct<doorNo:string,buildingName:string,street:string,locality:struct<code:string,name:string>,city:string,district:string,"
    "region:string,state:string,country:string,pinCode:string,geoLocation:struct<latitude:string,longitude:string>>,"
    f"{_EVENT_AUDIT.replace(' ', ':', 1)}>"
)
DEMAND_EVENT = (
    "tenantId string, demand struct<id:string,consumerCode:string,consumerType:string,businessService:string,taxPeriodFrom:bigint,taxPeriodTo:bigint,"
    "status:string,isPaymentCompleted:boolean,financialYear:string,minimumAmountPayable:string,payer:struct<name:string,mobileNumber:string,email:string>,"
    "demandDetails:array<struct<taxHeadMasterCode:string,taxAmount:string,collectionAmount:string>>,"
    f"{_EVENT_AUDIT.replace(' ', ':', 1)}>"
)
