"""Model features: T3 lags and rolling means, T4 calendar covariates,
T5 static segment features, T6 future frame."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import month_index, with_group_values


def lag_features(df: DataFrame, n: int = 18, keys=S.SERIES_KEY, qty: str = S.QTY,
                 with_period: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """``{qty}_LAG1..n-1`` and ``{qty}_MEAN2..n-1`` per series in month order.

    MEANw is the mean of the w previous rows, NULL until w rows exist. The leading
    gaps of each column are filled with the series' first non-NULL value of that
    column (fill per series; the reference's fill also crosses series borders,
    which is not reproduced). All columns share one partition/order spec: one
    shuffle, one sort, two Window nodes.
    """
    part = [*by, *keys]
    w = Window.partitionBy(*part).orderBy(S.MONTH)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    raw = {}
    for k in range(1, n):
        raw[f"{qty}_LAG{k}"] = F.lag(qty, k).over(w)
    for win in range(2, n):
        frame = w.rowsBetween(-win, -1)
        raw[f"{qty}_MEAN{win}"] = F.when(F.count(qty).over(frame) >= win, F.avg(qty).over(frame))
    x = df.withColumns(raw)
    filled = {c: F.coalesce(F.col(c), F.first(c, ignorenulls=True).over(whole)) for c in raw}
    x = x.withColumns(filled)
    if with_period:
        prev = F.add_months(F.col(S.MONTH), -1)
        x = x.withColumns({"prev_month": F.month(prev), "prev_year": F.year(prev)})
    return x


CALENDAR_COLS = ("month_num", "month_sin", "month_cos", "quarter", "quarter_sin", "quarter_cos",
                 "half", "half_sin", "half_cos", "t_linear", "t_quadratic", "t_log")


def calendar_columns(ts: Column, origin: Column) -> dict[str, Column]:
    """T4 for a month column and an origin month: 12 covariates.

    ``half_sin`` = sin(pi * half) is ~0 for both halves; kept for parity.
    """
    m = F.month(ts)
    q = F.quarter(ts)
    half = F.when(m <= 6, 1).otherwise(2)
    t = month_index(ts) - month_index(origin)
    two_pi = 2 * math.pi
    return {
        "month_num": m, "month_sin": F.sin(two_pi * m / 12), "month_cos": F.cos(two_pi * m / 12),
        "quarter": q, "quarter_sin": F.sin(two_pi * q / 4), "quarter_cos": F.cos(two_pi * q / 4),
        "half": half, "half_sin": F.sin(two_pi * half / 2), "half_cos": F.cos(two_pi * half / 2),
        "t_linear": t, "t_quadratic": t * t, "t_log": F.log1p(t.cast("double")),
    }


def calendar_features(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """T4 with the data's min month (per run) as origin of the counters."""
    m = with_group_values(df, df, {"_origin": F.min(S.MONTH)}, by)
    return m.withColumns(calendar_columns(F.col(S.MONTH), F.col("_origin"))).drop("_origin")


def static_features(df: DataFrame, segment_cols: list[str], keys=S.SERIES_KEY,
                    by: tuple[str, ...] = ()) -> DataFrame:
    """T5: one row per series with its segment columns (constant per series)."""
    return df.groupBy(*by, *keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in segment_cols])


def future_frame(df: DataFrame, horizon: int, keys=S.SERIES_KEY, by: tuple[str, ...] = ()) -> DataFrame:
    """The next ``horizon`` months after each series' last month, with the T4
    columns whose counters start at the history's min month (per run)."""
    m = with_group_values(df, df, {"_origin": F.min(S.MONTH)}, by)
    last = m.groupBy(*by, *keys).agg(F.max("_origin").alias("_origin"), F.max(S.MONTH).alias("_last"))
    fut = last.select(*by, *keys, "_origin",
                      F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "_last")
    fut = fut.withColumn(S.MONTH, F.add_months(F.col("_last"), F.col("step")))
    return (fut.withColumns(calendar_columns(F.col(S.MONTH), F.col("_origin")))
               .drop("_origin", "_last"))


def model_input(panel: DataFrame, segment_cols: list[str], n: int = 18, keys=S.SERIES_KEY,
                qty: str = S.QTY, by: tuple[str, ...] = ()) -> DataFrame:
    """P11 + T3 + T4 + T5: the frame a per-series model is fed, one row per series
    and month: display ``item_id``, ``timestamp`` (month), ``target`` (quantity),
    the 33 lag/mean features, the 12 calendar covariates (counters from the
    history's min month) and the static segment columns. Features, covariates and
    statics share the series partitioning of the panel."""
    from sackcast.functions import item_id

    x = lag_features(panel.select(*by, *keys, S.MONTH, qty, *segment_cols), n, keys, qty, by=by)
    x = calendar_features(x, by)
    feats = [f"{qty}_LAG{k}" for k in range(1, n)] + [f"{qty}_MEAN{k}" for k in range(2, n)]
    return x.select(*by, *keys, item_id(keys).alias("item_id"), F.col(S.MONTH).alias("timestamp"),
                    F.col(qty).alias("target"), *feats, *CALENDAR_COLS, *segment_cols)
