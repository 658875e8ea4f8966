"""Catalog checks and guards."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sackcast import schemas as S


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the location can be read; a missing path gives False,
    other errors are raised."""
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


def table_exists(spark: SparkSession, name: str) -> bool:
    """S5 for catalog tables: a missing table (or database) gives False; any other
    error is raised."""
    try:
        return spark.catalog.tableExists(name)
    except AnalysisException as e:
        if "NOT_FOUND" in str(e):
            return False
        raise


def has_rows(spark: SparkSession, path: str, where=None) -> bool:
    """S6/S10 guard: the location exists and the (filtered) read has a row.
    ``isEmpty`` stops at the first row; a ``period`` filter prunes partitions."""
    if not path_exists(spark, path):
        return False
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return not df.isEmpty()


def read_output(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a partitioned output back in its declared column order (the partition
    column comes last on read, so always re-select)."""
    return S.conform(spark.read.schema(schema).parquet(path), schema)
