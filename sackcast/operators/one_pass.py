"""T14 and T16 in one pass over series rows.

The months of a series are collected once (one shuffle by the key). Every as-of date
then reads its own stretch of that array: segment facts, residuals, moving averages and
zeros are expressions of the series' row, so however many dates a backfill has, no
monthly row is multiplied or shuffled again. Only results are: one row per date and
series for the ABC ranking, and ``horizon`` forecast rows at the end.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import clamp_round_long, in_lists_mask, keep, month_index
from sackcast.operators.forecast import _ma_steps, join_series_flags
from sackcast.operators.running import EXACT
from sackcast.operators.segment import classified
from sackcast.operators.selection import residual_quantiles
from sackcast.operators.skus import eligibility_mask
from sackcast.params import Params


def run_series(monthly: DataFrame, runs: list[tuple[dt.date, dt.date, dt.date]], months: int, keys=S.PRODUCT_KEY,
               qty: str = S.QTY) -> DataFrame:
    """One row per as-of date and series with a month in the run's window: ``asof keys _v _hi``.

    ``runs``: (as-of date, first month, month after the last one) of each date. ``_hi``: the
    run's last month with data; ``_v``: the series' quantities up to it, oldest first,
    exactly T1's panel: the last ``months`` months with gaps as 0, and older ones where
    they have a row. The run's last months come from the set of months that occur at all
    (one row a calendar month)."""
    index = lambda d: d.year * 12 + d.month - 1
    base = min(index(lo) for _, lo, _ in runs)
    count = max(index(hi) for _, _, hi in runs) - base
    spans = [(index(lo) - base, index(hi) - base) for _, lo, hi in runs]   # places in the array of all months
    # a series' row becomes dates x horizon rows: a set number of partitions, so that small ones are not merged before that
    parts = int(monthly.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = monthly.repartition(parts, *keys).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct((month_index(S.MONTH) - base).alias("at"), F.col(qty)))).alias("_month"))
    per = per.withColumns({"_all": F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.element_at("_month", i)),
                           "_places": F.map_keys("_month")}).drop("_month")
    per = keep(per)   # read for the runs' last months, the classes and the forecasts
    # the last month with data of each run, over all series
    tops = per.agg(F.array(*[F.max(F.array_max(F.filter("_places", lambda i: (i >= lo) & (i < hi)))) for lo, hi in spans]).alias("tops")).scalar()
    dates = F.array(*[F.struct(F.lit(a).alias("asof"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(k).alias("k"))
                      for k, ((a, _, _), (lo, hi)) in enumerate(zip(runs, spans))])
    x = per.select(*keys, "_all", F.explode(dates).alias("_run"), tops.alias("_tops"))
    x = x.select(F.col("_run.asof").alias("asof"), *keys, F.get("_tops", F.col("_run.k")).alias("_top"), F.col("_run.lo").alias("_lo"),
                 F.slice("_all", F.col("_run.lo") + 1, F.col("_run.hi") - F.col("_run.lo")).alias("_own"))
    x = x.where(F.exists("_own", lambda v: v.isNotNull()))
    before = F.col("_top") - (months - 1) - F.col("_lo")   # months of the run before the filled ones; negative: filled ones before the run
    older = F.filter(F.slice("_own", F.lit(1), F.greatest(before, F.lit(0))), lambda v: v.isNotNull())
    inside = F.slice("_own", F.greatest(before, F.lit(0)) + 1, F.col("_top") - F.col("_lo") - F.greatest(before, F.lit(0)) + 1)
    filled = F.transform(inside, lambda v: F.coalesce(v, F.lit(0.0)))
    quantity = F.concat(older, F.array_repeat(F.lit(0.0), F.greatest(-before, F.lit(0))), filled)
    start = dt.date(base // 12, base % 12 + 1, 1)
    return x.select("asof", *keys, quantity.alias("_v"), F.add_months(F.lit(start), F.col("_top")).alias("_hi"))


def series_facts(series: DataFrame, window: int, names: dict[str, str], keys=S.PRODUCT_KEY) -> DataFrame:
    """W7 + A7/A8/A9 of each date and series, from the last ``window`` months of its array."""
    tail = F.slice("_v", F.greatest(F.lit(1), F.size("_v") - (window - 1)), F.least(F.lit(window), F.size("_v")))
    zero = F.lit(0).cast(EXACT)
    x = series.select("asof", *keys, tail.alias("_t")).withColumn("_p", F.filter("_t", lambda v: v > 0))
    x = x.withColumns({"_n": F.size("_p"), "_mean": F.try_divide(F.aggregate("_p", F.lit(0.0), lambda s, v: s + v), F.size("_p"))})
    squares = F.aggregate("_p", F.lit(0.0), lambda s, v: s + (v - F.col("_mean")) * (v - F.col("_mean")))
    spread = F.sqrt(F.try_divide(squares, F.col("_n") - 1))
    return x.select(
        "asof", *keys,
        F.aggregate("_t", zero, lambda s, v: (s + v.cast(EXACT)).cast(EXACT)).cast("double").alias(names["value"]),
        F.when(F.col("_n") <= 1, F.lit(0.0)).otherwise(F.bround(F.try_divide(spread, F.col("_mean")), 4)).alias(names["cv"]),
        F.bround(F.col("_n") * 12.0 / F.size("_t"), 4).alias(names["rotation"]))


def run_segments(series: DataFrame, p: Params, keys=S.PRODUCT_KEY) -> DataFrame:
    """G4 for every date: ``asof``, product key and the six segment columns."""
    names = S.segment_names(p.segment_window, p.segment_prefix)
    return classified(series_facts(series, p.segment_window, names, keys), p, names, keys, by=("asof",))


def _paths(x: DataFrame, p: Params) -> tuple[Column, dict[str, Column], Column]:
    """(has the seasonal model, its arrays of ``horizon`` values by quantile, the plain path's array)."""
    steps = F.sequence(F.lit(1), F.lit(p.horizon))
    model = F.col("_ok") & (F.col("_n") > 12)

    def values(k: int) -> Column:
        back = lambda h: (F.floor((h - 1) / 12) + 1) * 12
        return F.transform(steps, lambda h: clamp_round_long(F.get("_v", (F.col("_n") + h - 1 - back(h)).cast("int")) + F.col("_rq")[k]))
    window = F.slice("_v", F.greatest(F.lit(1), F.col("_n") - (p.sales_window - 1)), F.least(F.lit(p.sales_window), F.col("_n")))
    plain = F.when(F.col("_ok") | F.col("has_sales"), _ma_steps(window, p.horizon)).otherwise(F.array_repeat(F.lit(0).cast("long"), p.horizon))
    return model, {c: values(k) for k, c in enumerate(S.Q_COLS)}, plain


def run_forecasts(series: DataFrame, segments: DataFrame, flags: DataFrame | None, p: Params, keys=S.PRODUCT_KEY) -> DataFrame:
    """T14 for every date: eligible series by the seasonal quantile model (moving average
    without any 12-month residual), the others by the moving average or zeros (T12).
    ``asof keys month q05..q95 model_type has_sales is_eligible`` and the flags; each series
    gets ``horizon`` rows. Every series reaches the run's last month, where all paths start."""
    part = ["asof", *keys]
    names = S.segment_names(p.segment_window, p.segment_prefix)
    mask = eligibility_mask(p, names)
    ok = segments.select(*part, in_lists_mask(mask).alias("_ok"))
    recent = F.slice("_v", F.greatest(F.lit(1), F.size("_v") - (p.sales_window - 2)), F.least(F.lit(p.sales_window - 1), F.size("_v")))
    x = series.join(ok, part, "left").withColumns({
        "_ok": F.coalesce("_ok", F.lit(False)), "_n": F.size("_v"), "has_sales": F.exists(recent, lambda v: v > 0)})
    x, names_ = join_series_flags(x, flags, part)
    x = x.withColumn("_rq", F.when(F.col("_ok"), residual_quantiles(p.quantiles)))
    model, seasonal, plain = _paths(x, p)
    x = x.select(*part, "_hi", "has_sales", *names_, "_ok", model.alias("_model"), F.when(~model, plain).alias("_plain"),
                 *(F.when(model, v).alias(f"_{c}") for c, v in seasonal.items()))
    x = x.withColumn("_h", F.explode(F.sequence(F.lit(1), F.lit(p.horizon))))
    label = (F.when(F.col("_model"), p.label_model).when(F.col("_ok") | F.col("has_sales"), p.label_moving_average).otherwise(p.label_zero))
    at = lambda c: F.element_at(c, F.col("_h"))
    return x.select(*part, F.add_months(F.col("_hi"), F.col("_h")).alias(S.MONTH),
                    *(F.coalesce(at(f"_{c}"), at("_plain")).alias(c) for c in S.Q_COLS),
                    label.alias("model_type"), "has_sales", F.col("_ok").alias("is_eligible"), *names_)
