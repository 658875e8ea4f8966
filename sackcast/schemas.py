"""Column names, key sets and the output schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# input columns (English names for the reference's configured ones)
CLASS, COMPANY, WAREHOUSE, MATERIAL, UNIT = "product_class", "company", "warehouse", "material", "unit"
LAST_SALE, DATE, QTY, MONTH = "last_sale", "date", "qty", "month"

PRODUCT_KEY = (CLASS, COMPANY, WAREHOUSE, MATERIAL, UNIT)   # 5 columns
WAREHOUSE_KEY = (CLASS, COMPANY, WAREHOUSE)                 # ABC partitions
SERIES_KEY = (COMPANY, WAREHOUSE, MATERIAL, UNIT)           # model item id

Q_COLS = ("q05", "q25", "q50", "q75", "q95")
ERR_COLS = ("err05", "err25", "err50", "err75", "err95")
FLAG_COLS = ("has_sales", "is_eligible", "is_known", "is_active")
STAMP_COLS = ("run_date", "period", "loaded_at", "deleted", "deleted_at")

DEMAND_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in PRODUCT_KEY]
    + [T.StructField(LAST_SALE, T.DateType()), T.StructField(DATE, T.DateType()),
       T.StructField(QTY, T.DoubleType())])

KNOWN_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in PRODUCT_KEY])

_STAMP_FIELDS = [
    T.StructField("run_date", T.StringType()),
    T.StructField("period", T.IntegerType()),
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("deleted", T.BooleanType()),
    T.StructField("deleted_at", T.TimestampType()),
]

FORECAST_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in PRODUCT_KEY]
    + [T.StructField(DATE, T.DateType())]
    + [T.StructField(c, T.LongType()) for c in Q_COLS]
    + [T.StructField("model_type", T.StringType())]
    + [T.StructField(c, T.BooleanType()) for c in FLAG_COLS]
    + _STAMP_FIELDS)

MONITOR_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in PRODUCT_KEY]
    + [T.StructField(DATE, T.DateType()), T.StructField(QTY, T.DoubleType())]
    + [T.StructField(c, T.LongType()) for c in Q_COLS]
    + [T.StructField(c, T.DoubleType()) for c in ERR_COLS]
    + [T.StructField("model_type", T.StringType())]
    + [T.StructField(c, T.BooleanType()) for c in FLAG_COLS]
    + _STAMP_FIELDS)


def conform(df: DataFrame, schema: T.StructType, leading: tuple[str, ...] = ()) -> DataFrame:
    """Select ``leading`` run keys, then the schema's columns in order, cast.

    Casting with ``cast`` keeps nulls as nulls (a text conversion would not).
    """
    return df.select(*leading, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def segment_names(window: int, prefix: str = "", qty_col: str = QTY) -> dict[str, str]:
    """Names of the six segment columns, e.g. ``abc_qty_30m``.

    An empty prefix falls back to the quantity column's name, as the reference does.
    """
    p = prefix or qty_col
    w = str(window).zfill(2)
    return {k: f"{k}_{p}_{w}m" for k in ("value", "cv", "rotation", "abc", "xyz", "fsn")}
