"""Job configs for the CRM entities, built from the schema registry.

Every entity job has the same shape: a dated CSV drop per day, a raw
(staging) table and a bronze (current-state) table, merged on the entity's
key, with the key required. Customers add name and phone checks.
"""

from __future__ import annotations

from . import schemas as S

# ---------------------------------------------------------------------------
# The source file conventions and the extra customer checks of
# the CRM job configs.
# ---------------------------------------------------------------------------
SOURCE_DEFAULTS = {
    "name": "crm",
    "type": "file",
    "format": "csv",
    "header": True,
    "delimiter": ",",
    "date_format": "dd/MM/yyyy",
    "timestamp_format": "yyyy/MM/dd HH:mm:ss",
}
FILE_PATTERN = "crm_{entity}_{{dd}}-{{MM}}-{{yyyy}}.csv"
CUSTOMER_REQUIRED = ["customer_id", "customer_name", "phone"]
CUSTOMER_PHONE_BLOCK = {"phone": {"min_length": 9, "max_length": 10, "numeric_only": True}}


def entity_job(entity: str, landing_path: str, *, catalog: str | None = None, raw_schema: str = "raw",
               master_schema: str = "bronze", fmt: str = "parquet", mode: str = "merge",
               table_root: str | None = None, buckets: int = 64) -> dict:
    """Job config for ``entity`` (``customers``, ``accounts``, ...).

    Tables are catalog tables ``[catalog.]raw_schema.crm_<entity>`` unless
    ``table_root`` is given, in which case they are paths under it.
    """
    table = f"crm_{entity}"
    if table not in S.ENTITY_COLUMNS:
        raise ValueError(f"Unknown entity '{entity}'; known: {[t[4:] for t in S.ENTITY_COLUMNS]}")
    key = S.entity_key(table)

    def ref(schema: str) -> dict:
        if table_root:
            return {"path": f"{table_root.rstrip('/')}/{schema}/{table}", "format": fmt, "table": table}
        out = {"schema": schema, "table": table, "format": fmt}
        if catalog:
            out["catalog"] = catalog
        return out

    validation: dict = {"non_nullable": {"columns": [key]}}
    if entity == "customers":
        validation = {"non_nullable": {"columns": list(CUSTOMER_REQUIRED)}, "rules": dict(CUSTOMER_PHONE_BLOCK)}
    return {
        "job": {"name": entity, "type": "batch", "frequency": "daily", "mode": "load"},
        "source": dict(SOURCE_DEFAULTS, path=landing_path, file_format=FILE_PATTERN.format(entity=entity)),
        "target": {"raw": ref(raw_schema), "master": ref(master_schema),
                   "write": {"mode": mode, "keys": key, "buckets": buckets}},
        "validation": validation,
    }
