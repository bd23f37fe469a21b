"""Session-level helpers: the shared scratch location and table references.

Every intermediate this library writes (landed CSV batches, staged merges,
scratch tables used by examples) goes under the folder the cluster names in
``spark.checkpoint.dir``. Only when the session has none (local tests) do we
create one, so nothing ends up in a machine-local folder on a cluster.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


#: Error conditions of a path that holds no table (missing, or a folder without data files).
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def path_missing(error: AnalysisException) -> bool:
    """True only if the error says that nothing is stored there; any other storage
    error must not be taken for an absent table (it would be overwritten)."""
    return (error.getCondition() or "") in _ABSENT


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set up only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:            # a remote (Connect) session has no SparkContext
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if root:
        return root.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf and sc is not None:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir().rstrip("/")
    if conf:
        return conf.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # Unset in a local session (tests): pick a private folder once.
    local = tempfile.mkdtemp(prefix="batchgate-ckpt-")
    if sc is None:
        spark.conf.set("spark.checkpoint.dir", local)
        return local
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    tail = "/".join(p.strip("/") for p in parts if p)
    leaf = f"{tail}-{uuid.uuid4().hex[:12]}" if tail else uuid.uuid4().hex[:12]
    return f"{checkpoint_root(spark)}/batchgate/{leaf}"


def scratch_database(spark: SparkSession, prefix: str = "bg_scratch") -> str:
    """Create a uniquely named database whose files live in the shared folder."""
    name = f"{prefix}_{uuid.uuid4().hex[:10]}"
    location = scratch_path(spark, "db", name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    return name


@dataclass(frozen=True)
class TableRef:
    """A table addressed by catalog name or by path, plus its file format.

    ``name`` is ``[catalog.]schema.table``; ``path`` is used when there is no
    catalog entry. The config form is the reference's
    ``{catalog, schema, table, format}`` dict, optionally with ``path``.
    """

    name: str | None = None
    path: str | None = None
    format: str = "parquet"
    table: str | None = None       # bare table name (schema registry lookup)

    @classmethod
    def of(cls, cfg: "TableRef | dict | str") -> "TableRef":
        if isinstance(cfg, TableRef):
            return cfg
        if isinstance(cfg, str):
            return cls(name=cfg, table=cfg.split(".")[-1])
        fmt = cfg.get("format", "parquet")
        if cfg.get("path"):
            return cls(path=cfg["path"], format=fmt, name=None, table=cfg.get("table"))
        parts = [cfg.get("catalog"), cfg.get("schema"), cfg["table"]]
        return cls(name=".".join(p for p in parts if p), format=fmt, table=cfg["table"])

    @property
    def label(self) -> str:
        return self.name or self.path or "?"

    def exists(self, spark: SparkSession) -> bool:
        if self.name:
            return spark.catalog.tableExists(self.name)
        try:
            spark.read.format(self.format).load(self.path).schema
            return True
        except AnalysisException as e:
            if path_missing(e):
                return False
            raise

    def read(self, spark: SparkSession) -> DataFrame:
        if self.name:
            return spark.table(self.name)
        return spark.read.format(self.format).load(self.path)

    def supports_row_level_dml(self) -> bool:
        """MERGE / UPDATE are only offered by table formats with a commit log."""
        return self.name is not None and self.format.lower() in ("delta", "iceberg", "hudi")
