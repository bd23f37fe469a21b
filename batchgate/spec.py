"""Normalise job and validation configs into plain specs.

Two validation dialects are accepted:

* job dialect (the YAML job files): ``{"non_nullable": {"columns": [...]},
  "rules": {"<column>": {"min_length": .., "max_length": .., "numeric_only": ..}}}``;
  every key but ``rules`` names a registered rule; ``rules`` holds column blocks.
* rule-list dialect: ``{"rules": [{"name": "length", "column": .., ...}, ...]}``.

Both become one ordered list of rule dicts with a ``name`` and a ``dialect``. They
may stand together: named entries beside a list are kept, in config order, and
each entry follows its own dialect. A section that is neither is refused.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Any

from .session import TableRef

WRITE_MODES = ("merge", "overwrite", "append")


def parse_business_date(value: str) -> dt.date:
    """``yyyy-MM-dd`` -> date; anything else raises ``ValueError``."""
    return dt.datetime.strptime(value, "%Y-%m-%d").date()


def normalize_keys(keys: Any) -> list[str]:
    """Merge keys: one column name or a list of names (composite key)."""
    if keys is None:
        return []
    if isinstance(keys, str):
        return [k.strip() for k in keys.split(",") if k.strip()] if "," in keys else [keys]
    return list(keys)


def normalize_rules(validation: dict | list | None) -> list[dict]:
    """Both validation dialects -> ordered list of rule dicts."""
    if not validation:
        return []
    if isinstance(validation, list):
        return [dict(r, dialect=r.get("dialect", "library")) for r in validation]
    out: list[dict] = []
    for name, cfg in validation.items():
        if name == "rules" and isinstance(cfg, list):
            out.extend(dict(r, dialect=r.get("dialect", "library")) for r in cfg)
            continue
        if not isinstance(cfg, dict) and cfg is not None:
            raise ValueError(f"Validation section '{name}' must be a mapping, got {cfg!r}")
        if name == "rules":
            out.extend(column_block_rules(cfg or {}))
            continue
        cfg = dict(cfg or {})
        cfg["name"] = name
        cfg.setdefault("dialect", "job")
        out.append(cfg)
    return out


def column_block_rules(blocks: dict) -> list[dict]:
    """``{column: {min_length, max_length, numeric_only}}`` -> length/numeric_only rules."""
    out: list[dict] = []
    for column, block in blocks.items():
        block = dict(block or {})
        severity = block.pop("severity", "ERROR")
        lo, hi = block.pop("min_length", None), block.pop("max_length", None)
        if lo is not None or hi is not None:
            out.append({"name": "length", "column": column, "min": lo, "max": hi,
                        "severity": severity, "dialect": "job"})
        if block.pop("numeric_only", False):
            out.append({"name": "numeric_only", "column": column, "severity": severity,
                        "dialect": "job"})
        if block:
            raise ValueError(f"Unsupported keys in rule block for column '{column}': {sorted(block)}")
    return out


@dataclass
class SourceSpec:
    name: str | None = None
    type: str = "file"
    format: str = "csv"
    header: bool = True
    delimiter: str = ","
    path: str = ""
    date_format: str | None = None
    timestamp_format: str | None = None
    file_format: str = ""
    binding: str = "position"      # position | name
    check_header: bool = True      # header names must equal the schema (position binding)
    optional_columns: list[str] = field(default_factory=list)   # name binding: columns that a file may lack
    ignored_columns: list[str] = field(default_factory=list)    # name binding: columns of a file that are read past

    @classmethod
    def of(cls, cfg: dict) -> "SourceSpec":
        known = {k: normalize_keys(cfg[k]) if k in ("optional_columns", "ignored_columns") else cfg[k]
                 for k in cls.__dataclass_fields__ if k in cfg}
        return cls(**known)


@dataclass
class JobSpec:
    name: str
    run_type: str | None
    source: SourceSpec
    raw: TableRef | None
    master: TableRef
    write_mode: str
    keys: list[str]
    rules: list[dict] = field(default_factory=list)
    buckets: int = 64
    dedupe_by: list[str] = field(default_factory=list)
    layout: str | None = None
    rules_table: Any = None
    quarantine: Any = None

    @classmethod
    def of(cls, config: dict) -> "JobSpec":
        job = config.get("job", {})
        validation = config.get("validation")
        rules_table = None
        if isinstance(validation, dict) and "rules_table" in validation:
            rules_table = validation["rules_table"]
            validation = {k: v for k, v in validation.items() if k != "rules_table"}
        target = config["target"]
        write = target.get("write", {})
        mode = write.get("mode", "append")
        if mode not in WRITE_MODES:
            raise ValueError(f"Unsupported write mode '{mode}'; expected one of {WRITE_MODES}")
        keys = normalize_keys(write.get("keys"))
        if mode == "merge" and not keys:
            raise ValueError("Merge mode needs target.write.keys")
        return cls(
            name=job.get("name", "job"),
            run_type=job.get("mode", job.get("type")),
            source=SourceSpec.of(config.get("source", {})),
            raw=TableRef.of(target["raw"]) if target.get("raw") else None,
            master=TableRef.of(target["master"]),
            write_mode=mode,
            keys=keys,
            rules=normalize_rules(validation),
            buckets=int(write.get("buckets", 64)),
            dedupe_by=normalize_keys(write.get("dedupe_by")),
            layout=write.get("layout"),
            rules_table=rules_table,
            quarantine=target.get("quarantine"),
        )
