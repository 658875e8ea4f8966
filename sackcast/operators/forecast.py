"""Forecast paths without a model: T7 recursive moving average, T8 zero;
T13 row assembly with flags; T14 routing and union of the three paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import with_group_values, with_last_month
from sackcast.params import Params


def _last_values(df: DataFrame, k: int, keys, qty: str, by) -> DataFrame:
    """Per series its last ``k`` quantities in month order (array, oldest first),
    plus ``_hi`` = the frame's max month (per run). A series holds at most one row
    per calendar month, so the collected array is bounded by the history length."""
    m = with_group_values(df, df, {"_hi": F.max(S.MONTH)}, by)
    per = m.groupBy(*by, *keys).agg(
        F.max("_hi").alias("_hi"),
        F.array_sort(F.collect_list(F.struct(F.col(S.MONTH).alias("m"), F.col(qty).alias("v")))).alias("_rows"))
    vals = F.transform(F.col("_rows"), lambda r: r["v"])
    return per.select(*by, *keys, "_hi",
                      F.slice(vals, F.greatest(F.lit(1), F.size(vals) - (k - 1)), k).alias("_w"))


def _ma_steps(window: Column, horizon: int) -> Column:
    """T7 recursion as a fold over ``horizon`` steps on a growing array: each step
    appends p = max(0, round_half_even(mean of the last n values)), n = the initial
    window size; that equals dropping the oldest value and pushing p. Returns the
    ``horizon`` projections as bigint."""
    n = F.size(window)

    def step(acc, _):
        mean = F.aggregate(F.slice(acc, -n, n), F.lit(0.0), lambda s, x: s + x) / n
        return F.concat(acc, F.array(F.greatest(F.lit(0.0), F.bround(mean, 0))))

    full = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), window, step)
    return F.transform(F.slice(full, -horizon, horizon), lambda v: v.cast("long"))


def _explode_steps(df: DataFrame, arr: Column, keys, by) -> DataFrame:
    x = df.select(*by, *keys, "_hi", F.posexplode(arr).alias("_pos", "_v"))
    return x.select(*by, *keys, F.add_months(F.col("_hi"), F.col("_pos") + 1).alias(S.MONTH),
                    *[F.col("_v").cast("long").alias(c) for c in S.Q_COLS])


def moving_average_forecast(df: DataFrame, horizon: int = 18, window: int = 12, keys=S.SERIES_KEY,
                            qty: str = S.QTY, by: tuple[str, ...] = ()) -> DataFrame:
    """Recursive moving average over each series' last ``window`` values, for
    ``horizon`` months after the frame's max month; all five quantiles equal.
    Pure Catalyst (higher-order functions), no Python."""
    last = _last_values(df, window, keys, qty, by)
    return _explode_steps(last, _ma_steps(F.col("_w"), horizon), keys, by)


def zero_forecast(df: DataFrame, horizon: int = 18, keys=S.SERIES_KEY, by: tuple[str, ...] = ()) -> DataFrame:
    """Every series of the frame x ``horizon`` months after the frame's max month, value 0."""
    m = with_group_values(df, df, {"_hi": F.max(S.MONTH)}, by)
    ids = m.groupBy(*by, *keys).agg(F.max("_hi").alias("_hi"))
    return _explode_steps(ids, F.array_repeat(F.lit(0).cast("long"), horizon), keys, by)


def known_keys(known: DataFrame, keys=S.SERIES_KEY, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct series keys flagged ``is_known``.

    The reference unions the keys of known-active rows (panel rows in the list)
    and known-inactive rows (list rows not in the panel); that union is exactly
    the list's own keys, so no join with the panel is needed."""
    k = [*by, *keys]
    return known.select(*[F.col(c).cast("string").alias(c) if c in keys else F.col(c) for c in k]) \
        .distinct().withColumn("is_known", F.lit(True))


def not_eligible_forecast(not_eligible: DataFrame, p: Params, keys=S.PRODUCT_KEY, qty: str = S.QTY,
                          by: tuple[str, ...] = (), top_source: DataFrame | None = None,
                          series_flags: DataFrame | None = None) -> DataFrame:
    """T12 + T7 + T8 fused: one aggregation per series of the non-eligible rows gives
    its recent-sales flag and its last ``sales_window`` values; series with recent
    sales get the recursive moving average, the others zeros. Each path starts after
    the max month of its own rows (per run), as the separate paths do; those two
    maxima come from a table of at most two rows per run. Output: ``keys, month,
    q05..q95, model_type, has_sales``.

    ``top_source``: a frame with the same max month as ``not_eligible`` that is
    cheaper to scan (the gap-filled panel: every series reaches its max month).
    ``series_flags``: per-series boolean columns (keyed like ``keys``) joined to the
    series table before the 18-fold explode, missing -> false."""
    src = not_eligible if top_source is None else top_source
    m = with_last_month(not_eligible, src, "_top", by)
    lo = F.add_months(F.col("_top"), -(p.sales_window - 1))
    per = m.groupBy(*by, *keys).agg(
        F.max(S.MONTH).alias("_smax"),
        F.coalesce(F.bool_or((F.col(S.MONTH) > lo) & (F.col(qty) > 0)), F.lit(False)).alias("has_sales"),
        F.array_sort(F.collect_list(F.struct(F.col(S.MONTH).alias("m"), F.col(qty).alias("v")))).alias("_rows"))
    starts = per.groupBy(*by, "has_sales").agg(F.max("_smax").alias("_hi"))
    x = per.join(F.broadcast(starts), [*by, "has_sales"])
    x, flag_cols = join_series_flags(x, series_flags, [*by, *keys])
    vals = F.transform(F.col("_rows"), lambda r: r["v"])
    w = F.slice(vals, F.greatest(F.lit(1), F.size(vals) - (p.sales_window - 1)), p.sales_window)
    steps = F.when(F.col("has_sales"), _ma_steps(w, p.horizon)).otherwise(
        F.array_repeat(F.lit(0).cast("long"), p.horizon))
    y = x.select(*by, *keys, "_hi", "has_sales", *flag_cols, F.posexplode(steps).alias("_pos", "_v"))
    return y.select(
        *by, *keys, F.add_months(F.col("_hi"), F.col("_pos") + 1).alias(S.MONTH),
        *[F.col("_v").alias(c) for c in S.Q_COLS],
        F.when(F.col("has_sales"), p.label_moving_average).otherwise(p.label_zero).alias("model_type"),
        "has_sales", *flag_cols)


def join_series_flags(per: DataFrame, flags: DataFrame | None, part: list[str]):
    """Left join per-series boolean flags (NULL -> false) on the key columns the
    flag table has (e.g. the 4-column series key); returns (frame, flag names)."""
    if flags is None:
        return per, []
    on = [c for c in part if c in flags.columns]
    names = [c for c in flags.columns if c not in on]
    x = per.join(flags, on, "left").withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in names})
    return x, names
