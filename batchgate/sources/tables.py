"""Catalog / path table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas as S
from ..session import TableRef


def scan_table(spark: SparkSession, table: TableRef | dict | str) -> DataFrame:
    """The whole table (by catalog name or path)."""
    return TableRef.of(table).read(spark)


def table_schema(spark: SparkSession, table: TableRef | dict | str,
                 drop_metadata: bool = True) -> T.StructType:
    """A table's schema, by default without the six batch metadata columns."""
    st = scan_table(spark, table).schema
    return S.business_schema(st) if drop_metadata else st
