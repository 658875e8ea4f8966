"""Stored months with a commit protocol.

Layout of a table: ``data/commit=<id>/period=<yyyyMM>/`` holds rows, ``manifest/entry=<id>/``
one row per stored month: (period, product_class, commit, generation, rows, first_month, last_month).
A write first stages its rows under a commit of its own, reads them back into manifest rows,
and publishes these as one small file, which appears at once or not at all (both folders
are the write's own, so writes at the same time don't meet). Readers only see
commits that the manifest names, so a write that fails half-way, or is still running, is
invisible. Of several commits of one month the newest generation counts, and of one
generation (runs at the same time) always the same single one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sackcast import schemas as S
from sackcast.sources.demand import asof_months
from sackcast.sources.tables import path_exists

MANIFEST = T.StructType([
    T.StructField("period", T.IntegerType()), T.StructField(S.CLASS, T.StringType()), T.StructField("commit", T.StringType()),
    T.StructField("generation", T.IntegerType()), T.StructField("rows", T.LongType()),
    T.StructField("first_month", T.DateType()), T.StructField("last_month", T.DateType())])
MONTH_KEY = ["period", S.CLASS]


class MonthTable:
    """A table of months per product class, e.g. the forecasts or the monitoring."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def _all_commits(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/manifest"):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest").select(*MANIFEST.names)

    def months(self) -> DataFrame:
        """The manifest's valid rows: one per stored month and class."""
        best = Window.partitionBy(*MONTH_KEY).orderBy(F.col("generation").desc(), F.col("commit").asc())
        return self._all_commits().withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")

    def month(self, period: int, product_class: str):
        """The manifest row of a stored month, or None (S10 guard)."""
        return self.months().where((F.col("period") == period) & (F.col(S.CLASS) == product_class)).first()

    def write(self, rows: DataFrame, replace: bool = False, check: Callable[[], object] | None = None) -> list[tuple[int, str]]:
        """Store the months of ``rows`` that are not stored yet (``replace``: all of them, as a newer
        generation). Returns the (period, class) pairs that now read from this write. ``check``
        runs when the rows are staged; what it raises leaves them unpublished.

        Rows are spread by (period, warehouse) into files of the advisory size and sorted by key
        inside, so a month has few files with narrow key ranges (O1)."""
        commit = uuid.uuid4().hex
        known = F.broadcast(self.months().select(*MONTH_KEY, "generation"))   # a row a month and class
        staged = S.conform(rows, self.schema)
        if not replace:
            staged = staged.join(known, MONTH_KEY, "left_anti")
        (staged.select(*self.schema.names).hint("rebalance", "period", S.WAREHOUSE).sortWithinPartitions("period", *S.PRODUCT_KEY, S.DATE)
               .write.partitionBy("period").parquet(f"{self.path}/data/commit={commit}"))
        if check is not None:
            check()
        entries = (self._data().where(F.col("commit") == commit).groupBy("period", S.CLASS, "commit")
                   .agg(F.count(F.lit(1)).alias("rows"), F.min(F.trunc(F.col(S.DATE), "MM")).alias("first_month"),
                        F.max(F.trunc(F.col(S.DATE), "MM")).alias("last_month")))
        entries = (entries.join(known, MONTH_KEY, "left")
                   .withColumn("generation", F.coalesce(F.col("generation") + 1, F.lit(0))).select(*MANIFEST.names))
        entries = entries.coalesce(1)   # one file: published whole or not at all
        if entries.isEmpty():
            return []
        entries.write.parquet(f"{self.path}/manifest/entry={commit}")
        won = self.months().where(F.col("commit") == commit).select(*MONTH_KEY)
        return sorted((r[0], r[1]) for r in won.collect())   # one row a month written

    def _data(self) -> DataFrame:
        fields = [f for f in self.schema.fields if f.name != "period"]
        whole = T.StructType([*fields, T.StructField("commit", T.StringType()), T.StructField("period", T.IntegerType())])
        return self.spark.read.schema(whole).parquet(f"{self.path}/data")

    def read(self) -> DataFrame:
        """All stored months, in the declared column order (S14). The manifest prunes the partitions."""
        if not path_exists(self.spark, f"{self.path}/manifest"):
            return self.spark.createDataFrame([], self.schema)
        valid = F.broadcast(self.months().select(*MONTH_KEY, "commit"))   # a row a month and class
        return S.conform(self._data().join(valid, [*MONTH_KEY, "commit"], "left_semi"), self.schema)

    def read_month(self, period: int, product_class: str) -> DataFrame:
        """S10 read-back: the rows of one stored month; one partition is opened."""
        entry = self.month(period, product_class)
        if entry is None:
            return self.spark.createDataFrame([], self.schema)
        return S.conform(self._data().where((F.col("commit") == entry["commit"]) & (F.col("period") == period)
                                            & (F.col(S.CLASS) == product_class)), self.schema)

    def completed(self, asof, product_class: str) -> DataFrame:
        """The forecast whose last month is the one before ``asof`` (the newest such period),
        whatever its horizon; found in the manifest, so one partition is opened."""
        prev = asof_months(asof)["prev"]
        entry = (self.months().where((F.col(S.CLASS) == product_class) & (F.col("last_month") == F.lit(prev)))
                 .orderBy(F.col("period").desc()).first())
        if entry is None:
            return self.spark.createDataFrame([], self.schema)
        return self.read_month(entry["period"], product_class)
