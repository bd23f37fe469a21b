"""StructType registry for the CRM entities, batch metadata and control tables.

Raw and bronze tables share one layout: the entity's business columns followed
by the six metadata columns added at write time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Table layouts that must equal the ingested tables' DDL.
# "S" = STRING, "T" = TIMESTAMP; the first column of each entity is its key.
# The spelling "buisness_date" is the tables' own and is kept on purpose.
# ---------------------------------------------------------------------------
ENTITY_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "crm_customers": [
        ("customer_id", "S"), ("customer_name", "S"), ("email", "S"), ("phone", "S"),
        ("city", "S"), ("state", "S"), ("country", "S"), ("created_at", "T"),
        ("updated_at_raw", "T"),
    ],
    "crm_contacts": [
        ("contact_id", "S"), ("customer_id", "S"), ("first_name", "S"), ("last_name", "S"),
        ("email", "S"), ("phone", "S"), ("job_title", "S"), ("department", "S"),
        ("city", "S"), ("state", "S"), ("country", "S"), ("created_at", "T"),
        ("updated_at_raw", "T"),
    ],
    "crm_accounts": [
        ("account_id", "S"), ("account_name", "S"), ("industry", "S"), ("website", "S"),
        ("phone", "S"), ("billing_city", "S"), ("billing_state", "S"),
        ("billing_country", "S"), ("annual_revenue", "S"), ("created_at", "T"),
        ("updated_at_raw", "T"),
    ],
    "crm_leads": [
        ("lead_id", "S"), ("lead_name", "S"), ("company_name", "S"), ("email", "S"),
        ("phone", "S"), ("source_channel", "S"), ("status", "S"), ("created_at", "T"),
        ("updated_at_raw", "T"),
    ],
    "crm_opportunities": [
        ("opportunity_id", "S"), ("customer_id", "S"), ("account_id", "S"),
        ("opportunity_name", "S"), ("stage", "S"), ("amount", "S"), ("close_date", "T"),
        ("probability", "S"), ("created_at", "T"), ("updated_at_raw", "T"),
    ],
    "crm_campaigns": [
        ("campaign_id", "S"), ("campaign_name", "S"), ("campaign_type", "S"),
        ("start_date", "T"), ("end_date", "T"), ("budget", "S"), ("status", "S"),
        ("created_at", "T"), ("updated_at_raw", "T"),
    ],
    "crm_activities": [
        ("activity_id", "S"), ("customer_id", "S"), ("contact_id", "S"),
        ("activity_type", "S"), ("activity_subject", "S"), ("activity_date", "T"),
        ("owner", "S"), ("status", "S"), ("created_at", "T"), ("updated_at_raw", "T"),
    ],
    "crm_products": [
        ("product_id", "S"), ("product_name", "S"), ("category", "S"), ("unit_price", "S"),
        ("currency", "S"), ("stock_quantity", "S"), ("is_active", "S"), ("created_at", "T"),
        ("updated_at_raw", "T"),
    ],
    "crm_orders": [
        ("order_id", "S"), ("customer_id", "S"), ("product_id", "S"), ("order_date", "T"),
        ("quantity", "S"), ("unit_price", "S"), ("total_amount", "S"), ("status", "S"),
        ("created_at", "T"), ("updated_at_raw", "T"),
    ],
    "crm_invoices": [
        ("invoice_id", "S"), ("customer_id", "S"), ("order_id", "S"), ("invoice_date", "T"),
        ("due_date", "T"), ("total_amount", "S"), ("status", "S"), ("payment_status", "S"),
        ("created_at", "T"), ("updated_at_raw", "T"),
    ],
}

BATCH_ID = "batch_id"
BUSINESS_DATE = "buisness_date"
SOURCE_NAME = "source_name"
RECORD_VERSION = "record_version"
INGESTED_AT = "ingested_at"
UPDATED_AT = "updated_at"
METADATA_COLUMNS = [BATCH_ID, BUSINESS_DATE, SOURCE_NAME, RECORD_VERSION, INGESTED_AT, UPDATED_AT]

METADATA_FIELDS = [
    T.StructField(BATCH_ID, T.LongType()),
    T.StructField(BUSINESS_DATE, T.TimestampType()),
    T.StructField(SOURCE_NAME, T.StringType()),
    T.StructField(RECORD_VERSION, T.LongType()),
    T.StructField(INGESTED_AT, T.TimestampType()),
    T.StructField(UPDATED_AT, T.TimestampType()),
]

_TYPES = {"S": T.StringType(), "T": T.TimestampType(), "L": T.LongType(),
          "I": T.IntegerType(), "B": T.BooleanType()}


def _struct(cols: list[tuple[str, str]], not_null: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], n not in not_null) for n, t in cols])


# Control and audit table layouts (nullability as written by the
# run tracker: id, job name, status and the three timestamps are required).
JOB_RUN_CONTROL = _struct(
    [
        ("job_run_id", "L"), ("job_name", "S"), ("source_name", "S"), ("business_date", "T"),
        ("batch_id", "L"), ("run_status", "S"), ("run_type", "S"), ("started_at", "T"),
        ("finished_at", "T"), ("records_read", "L"), ("records_valid", "L"),
        ("records_invalid", "L"), ("records_inserted", "L"), ("records_updated", "L"),
        ("records_merged", "L"), ("error_summary", "S"), ("retry_count", "I"),
        ("created_at", "T"), ("updated_at", "T"),
    ],
    not_null=("job_run_id", "job_name", "run_status", "started_at", "created_at", "updated_at"),
)

DQ_RULES = _struct([
    ("rule_id", "L"), ("job_name", "S"), ("source_name", "S"), ("table_name", "S"),
    ("column_name", "S"), ("rule_name", "S"), ("rule_type", "S"), ("expression", "S"),
    ("threshold_value", "S"), ("severity", "S"), ("is_active", "B"), ("created_at", "T"),
    ("updated_at", "T"),
])

DQ_FAILURE_AUDIT = _struct([
    ("dq_failure_id", "L"), ("job_run_id", "L"), ("job_name", "S"), ("source_name", "S"),
    ("business_date", "T"), ("table_name", "S"), ("record_key", "S"), ("column_name", "S"),
    ("validation_rule", "S"), ("validation_status", "S"), ("error_details", "S"),
    ("created_at", "T"),
])

PREPARED_CUSTOMERS = _struct(
    [
        ("customer_id", "S"), ("customer_name", "S"), ("email", "S"), ("phone", "L"),
        ("city", "S"), ("customer_status", "S"), ("batch_id", "L"), ("source_name", "S"),
        ("record_version", "L"), ("ingested_at", "T"), ("updated_at", "T"),
    ],
    not_null=("customer_id",),
)

RESULT_SCHEMA = _struct([
    ("rule_name", "S"), ("status", "S"), ("severity", "S"), ("message", "S"),
    ("records_checked", "L"), ("records_failed", "L"),
])


def entity_schema(entity: str, with_metadata: bool = True) -> T.StructType:
    """Business schema of an entity, plus the metadata columns by default."""
    base = _struct(ENTITY_COLUMNS[entity])
    if not with_metadata:
        return base
    return T.StructType(base.fields + METADATA_FIELDS)


def entity_key(entity: str) -> str:
    return ENTITY_COLUMNS[entity][0][0]


def business_schema(schema: T.StructType) -> T.StructType:
    """A table schema minus the six metadata columns (names absent are ignored)."""
    return T.StructType([f for f in schema.fields if f.name not in METADATA_COLUMNS])


def registry() -> dict[str, T.StructType]:
    """All declared tables: raw/bronze entities, control, rules, audit, prepared."""
    out: dict[str, T.StructType] = {}
    for layer in ("raw", "bronze"):
        for entity in ENTITY_COLUMNS:
            out[f"{layer}.{entity}"] = entity_schema(entity)
    out["control.job_run_control"] = JOB_RUN_CONTROL
    out["control.dq_rules"] = DQ_RULES
    out["audit.dq_failure_audit"] = DQ_FAILURE_AUDIT
    out["prepared.customers"] = PREPARED_CUSTOMERS
    return out


def registry_frame(spark: SparkSession) -> DataFrame:
    """The registry as rows: one per (table, column) with type and nullability."""
    rows = [
        (table, i + 1, f.name, f.dataType.simpleString(), f.nullable)
        for table, st in registry().items()
        for i, f in enumerate(st.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, ordinal int, column_name string, data_type string, nullable boolean"
    )


def create_tables(spark: SparkSession, database_prefix: str = "", fmt: str = "parquet",
                  tables: list[str] | None = None) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS`` for registry entries; returns the names.

    ``database_prefix`` is prepended to each layer (``raw`` -> ``{prefix}raw``)
    so several environments can share one catalog. NOT NULL is recorded in the
    schema but file formats without constraints do not enforce it.
    """
    made = []
    for key, st in registry().items():
        if tables is not None and key not in tables:
            continue
        layer, name = key.split(".", 1)
        db = f"{database_prefix}{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        full = f"{db}.{name}"
        if not spark.catalog.tableExists(full):
            spark.catalog.createTable(full, source=fmt, schema=st)
        made.append(full)
    return made
