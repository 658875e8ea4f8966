"""Demand scans (S1, S13) and the known-SKU list (S3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.params import Params


def read_demand(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Demand table from files; the eight named columns only (column pruning).
    ``last_sale`` is optional (it is dropped before any output)."""
    df = spark.read.format(fmt).load(path)
    cols = [F.col(c) if c in df.columns or c != S.LAST_SALE else F.lit(None).cast("date").alias(c)
            for c in S.DEMAND_SCHEMA.names]
    return df.select(*cols)


def load_known(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Known-SKU list (S3): the five key columns as strings, picked by header name
    (any order, extra columns ignored).

    CSV is read without type inference, so every column is a string and codes
    keep their leading zeros.
    """
    if fmt == "csv":
        df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(c).cast("string").alias(c) for c in S.PRODUCT_KEY])


def _d(x: dt.date | str) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(x)


def _month_start(d: dt.date, add: int = 0) -> dt.date:
    m = d.year * 12 + d.month - 1 + add
    return dt.date(m // 12, m % 12 + 1, 1)


def asof_months(asof: dt.date | str) -> dict[str, dt.date]:
    """Calendar facts of one as-of date, computed on the driver from the argument."""
    a = _d(asof)
    prev = _month_start(a, -1)
    return {"asof": a, "month": _month_start(a), "prev": prev}


def _date_range(col: Column, lo: dt.date, hi_exclusive: dt.date) -> Column:
    # plain comparisons on the raw column so that Parquet min/max filters apply
    return (col >= F.lit(lo)) & (col < F.lit(hi_exclusive))


def demand_scan(demand: DataFrame, asof, p: Params, history: int | None = None) -> DataFrame:
    """Rows whose month lies in [prev - history, prev] (history + 1 months), one class.

    The reference's interval is inclusive at both ends, so 36 gives 37 months.
    """
    h = p.history_months if history is None else history
    m = asof_months(asof)
    lo = _month_start(m["prev"], -h)
    hi = m["month"]
    return demand.where(_date_range(F.col(S.DATE), lo, hi) & (F.col(S.CLASS) == p.product_class))


def actuals_scan(demand: DataFrame, asof, p: Params) -> DataFrame:
    """Actuals for monitoring, months [m - horizon, m - 1] of the as-of month m."""
    m = asof_months(asof)
    lo = _month_start(m["month"], -p.horizon)
    return demand.where(_date_range(F.col(S.DATE), lo, m["month"]) & (F.col(S.CLASS) == p.product_class))
