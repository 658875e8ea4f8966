import datetime as dt

from pyspark.sql import functions as F

from sackcast import schemas as S


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def panel_rows(spark, rows, keys=S.PRODUCT_KEY):
    """rows: (key-tuple, 'YYYY-MM', qty) -> panel DataFrame."""
    data = [(*k, d(m + "-01"), float(q) if q is not None else None) for k, m, q in rows]
    schema = ", ".join(f"{c} string" for c in keys) + f", {S.MONTH} date, {S.QTY} double"
    return spark.createDataFrame(data, schema)


def key(material="M1", warehouse="W1", unit="BLS", company="6012", cls="CEMENT"):
    return (cls, company, warehouse, material, unit)


def metrics_df(spark, values, warehouse="W1"):
    rows = [(*key(material=f"M{i:02d}", warehouse=warehouse), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in S.PRODUCT_KEY) + ", value double")


def collect_sorted(df, *cols):
    return [tuple(r) for r in df.orderBy(*cols).select(*cols).collect()]
