"""T11 with a model other than the seasonal one: a fitted ``QuantileModel``, or a
user's own function (or several, tried in turn) on each series' history and future frame."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import clamp_round_long, with_last_month
from sackcast.operators.features import calendar_features, future_frame
from sackcast.operators.forecast import _ma_steps, join_series_flags
from sackcast.operators.quantile_model import QuantileModel, regression_forecast
from sackcast.params import Params


def series_facts(eligible: DataFrame, p: Params, keys=S.PRODUCT_KEY, qty: str = S.QTY, by: tuple[str, ...] = (),
                 top_source: DataFrame | None = None, series_flags: DataFrame | None = None):
    """(frame, flag names): one row per series with ``_last`` month, A11 ``has_sales``, the
    moving-average steps ``_ma`` and the joined flags."""
    part = [*by, *keys]
    m = with_last_month(eligible, eligible if top_source is None else top_source, "_top", by)
    lo = F.add_months(F.col("_top"), -(p.sales_window - 1))
    per = m.groupBy(*part).agg(
        F.max(S.MONTH).alias("_last"),
        F.coalesce(F.bool_or((F.col(S.MONTH) > lo) & (F.col(qty) > 0)), F.lit(False)).alias("has_sales"),
        F.array_sort(F.collect_list(F.struct(F.col(S.MONTH).alias("m"), F.col(qty).alias("v")))).alias("_rows"))
    vals = F.transform("_rows", lambda e: e["v"])
    window = F.slice(vals, F.greatest(F.lit(1), F.size(vals) - (p.sales_window - 1)), p.sales_window)
    return join_series_flags(per.select(*part, "_last", "has_sales", _ma_steps(window, p.horizon).alias("_ma")), series_flags, part)


def non_decreasing(rows: np.ndarray) -> np.ndarray:
    """Each row's nearest non-decreasing sequence (least squares), by pooling adjacent violators."""
    out = np.array(rows, float)
    for k in np.flatnonzero((np.diff(out, axis=1) < 0).any(axis=1)):
        pools: list[list[float]] = []   # sum and size
        for v in out[k]:
            pools.append([v, 1])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] > pools[-1][0] * pools[-2][1]:
                total, size = pools.pop()
                pools[-1][0] += total
                pools[-1][1] += size
        out[k] = np.concatenate([np.full(size, total / size) for total, size in pools])
    return out


def user_quantiles(eligible: DataFrame, models: tuple[Callable, ...], p: Params, keys=S.PRODUCT_KEY, qty: str = S.QTY,
                   by: tuple[str, ...] = (), names: dict[str, str] | None = None) -> DataFrame:
    """(keys, month, q05..q95 double) of the series for which a model gives a full answer.

    ``model(history, future)`` gets two pandas frames of one series: months with
    quantity, calendar columns (T4) and segments; the coming months with theirs (T6).
    It returns ``month`` and the quantile columns. The next model is tried where one
    raises, leaves months out or gives a number that is not finite; a series that none
    serves has no rows here. Crossing quantiles are pooled."""
    part = [*by, *keys]
    seg = [names[k] for k in ("abc", "xyz", "fsn")] if names else []
    history = calendar_features(eligible.select(*part, S.MONTH, qty, *seg), by)
    future = future_frame(eligible.select(*part, S.MONTH), p.horizon, list(keys), by)
    future = future.toDF(*future.columns)   # columns of its own: both sides come from one frame
    q_cols = list(S.Q_COLS)

    def run(past: pd.DataFrame, coming: pd.DataFrame) -> pd.DataFrame:
        past, coming = past.sort_values(S.MONTH), coming.sort_values(S.MONTH)
        wanted = pd.to_datetime(coming[S.MONTH]).to_numpy()
        for model in models:
            try:
                found = model(past.reset_index(drop=True), coming.reset_index(drop=True))
                found = found.assign(**{S.MONTH: pd.to_datetime(found[S.MONTH])}).sort_values(S.MONTH)
                cells = found[q_cols].to_numpy(float)
            except Exception:   # a user's code: whatever it raises, the next attempt follows
                continue
            if len(found) == len(wanted) and (found[S.MONTH].to_numpy() == wanted).all() and np.isfinite(cells).all():
                out = pd.DataFrame(non_decreasing(cells), columns=q_cols)
                out[S.MONTH] = coming[S.MONTH].to_numpy()
                return out.assign(**{k: past[k].iloc[0] for k in part})[[*part, S.MONTH, *q_cols]]
        return pd.DataFrame({c: pd.Series([], dtype=float if c in q_cols else object) for c in [*part, S.MONTH, *q_cols]})

    kinds = dict(eligible.select(*part).dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in part) + f", {S.MONTH} date, " + ", ".join(f"{c} double" for c in q_cols)
    return history.groupBy(*part).cogroup(future.groupBy(*part)).applyInPandas(run, schema)


def modelled_forecast(eligible: DataFrame, p: Params, model, keys=S.PRODUCT_KEY, qty: str = S.QTY, by: tuple[str, ...] = (),
                      top_source: DataFrame | None = None, series_flags: DataFrame | None = None) -> DataFrame:
    """The eligible path with ``model``: a ``QuantileModel``, a function, or a tuple of functions.
    ``keys, month, q05..q95, model_type, has_sales`` and the flags, ``horizon`` rows for
    every series. Series that no function serves get the recursive moving average."""
    part = [*by, *keys]
    names = S.segment_names(p.segment_window, p.segment_prefix, qty)
    facts, flags = series_facts(eligible, p, keys, qty, by, top_source, series_flags)
    if isinstance(model, QuantileModel):
        rows = regression_forecast(eligible, model, p.horizon, keys, qty, by, names)
        return rows.join(facts.select(*part, "has_sales", *flags), part).select(
            *part, S.MONTH, *S.Q_COLS, F.lit(p.label_regression).alias("model_type"), "has_sales", *flags)
    models = model if isinstance(model, tuple) else (model,)
    rows = user_quantiles(eligible, models, p, keys, qty, by, names).select(
        *part, S.MONTH, *(clamp_round_long(F.col(c)).alias(f"_{c}") for c in S.Q_COLS))
    base = facts.select(*part, "_last", "has_sales", *flags, F.posexplode("_ma").alias("_pos", "_v"))
    base = base.withColumn(S.MONTH, F.add_months(F.col("_last"), F.col("_pos") + 1))
    x = base.join(rows, [*part, S.MONTH], "left")
    served = F.col("_q50").isNotNull()
    return x.select(*part, S.MONTH, *(F.coalesce(f"_{c}", "_v").alias(c) for c in S.Q_COLS),
                    F.when(served, p.label_user).otherwise(p.label_moving_average).alias("model_type"), "has_sales", *flags)
