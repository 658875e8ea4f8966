"""T16 backfill: many as-of dates in one job, ``asof`` as a leading run key.

The demand is scanned once over the union of all windows and summed to months
once (A1). Segments and forecasts read every date's stretch of the series' own
array of months (``operators/one_pass``): no monthly row is multiplied by the
dates. The frames that do hold a row per date and month (panel, eligible rows,
actuals; user's models read them) take ``by=("asof",)``: their "global" max/min
months are per-date aggregates (one row per date, broadcast), their windows and
aggregations partition by the date as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import caches_released
from sackcast.operators.prepare import complete_months
from sackcast.operators.monitor import monitor_errors
from sackcast.operators.stamp import stamp_columns
from sackcast.params import Params
from sackcast.plans.monthly import RunFrames, forecast_rows, split_run
from sackcast.plans.series import backfill_segments, history_runs, scanned_months, series_forecast
from sackcast.sources.commits import MonthTable
from sackcast.sources.demand import _month_start, asof_months

BY = ("asof",)

__all__ = ["backfill_segments", "backfill_forecast", "backfill_frames", "backfill_monitoring", "monthly_asof_dates", "run_backfill"]


def monthly_asof_dates(asof_end, n: int = 19) -> list:
    """The reference's backfill list: ``n`` monthly dates ending at ``asof_end``
    (same day of month, clamped to the 28th)."""
    end = asof_months(asof_end)
    day = min(end["asof"].day, 28)
    return [_month_start(end["month"], -k).replace(day=day) for k in range(n - 1, -1, -1)]


def backfill_panel(demand: DataFrame, asofs, p: Params, keep_last: bool = False) -> DataFrame:
    """S1 + T2 for every as-of date: ``asof, keys, month, qty``."""
    runs = history_runs(asofs, p.history_months)
    monthly = scanned_months(demand, runs, p)
    arr = F.array(*[F.struct(F.lit(a).alias("asof"), F.lit(l).alias("lo"), F.lit(h).alias("hi")) for a, l, h in runs])
    tagged = monthly.select(
        "*", F.explode(F.filter(arr, lambda r: (F.col(S.MONTH) >= r["lo"]) & (F.col(S.MONTH) < r["hi"]))).alias("_run"))
    tagged = tagged.select(F.col("_run.asof").alias("asof"), *S.PRODUCT_KEY, S.MONTH, S.QTY)
    return complete_months(tagged, p.history_months, by=BY, keep_last=keep_last)


def known_per_run(known: DataFrame, asofs) -> DataFrame:
    """The known list once per as-of date (list rows x dates, no join)."""
    arr = F.array(*[F.lit(asof_months(a)["asof"]) for a in asofs])
    return known.select(F.explode(arr).alias("asof"), *S.PRODUCT_KEY)


def backfill_frames(demand: DataFrame, known: DataFrame, asofs, p: Params) -> RunFrames:
    return split_run(backfill_panel(demand, asofs, p, keep_last=True), known_per_run(known, asofs), p, by=BY,
                     known_list=known)


def backfill_forecast(demand: DataFrame, known: DataFrame, asofs, p: Params, model=None) -> DataFrame:
    """All dates' forecasts, stamped per date, in one plan (``asof`` + 21 columns); ``model`` as in ``forecast_rows``."""
    if model is None:
        rows = series_forecast(demand, known, asofs, p)
    else:
        rows = forecast_rows(backfill_frames(demand, known, asofs, p), p, by=BY, model=model)
    rows = rows.withColumns(stamp_columns(F.col("asof"), p.stamp_time_zone))
    return S.conform(rows, S.FORECAST_SCHEMA, leading=BY)


def backfill_actuals(demand: DataFrame, asofs, p: Params) -> DataFrame:
    """S13 + T2 for every as-of date m: months [m - horizon, m - 1], zero-filled over
    the history window, as in a single run; ``asof`` leads. One scan, one A1."""
    runs = [(asof_months(a)["asof"], _month_start(asof_months(a)["month"], -p.horizon), asof_months(a)["month"])
            for a in asofs]
    monthly = scanned_months(demand, runs, p)
    arr = F.array(*[F.struct(F.lit(a).alias("asof"), F.lit(l).alias("lo"), F.lit(h).alias("hi")) for a, l, h in runs])
    tagged = monthly.select(
        "*", F.explode(F.filter(arr, lambda r: (F.col(S.MONTH) >= r["lo"]) & (F.col(S.MONTH) < r["hi"]))).alias("_run"))
    tagged = tagged.select(F.col("_run.asof").alias("asof"), *S.PRODUCT_KEY, S.MONTH, S.QTY)
    return complete_months(tagged, p.history_months, by=BY)


def monitorable_per_date(forecasts: DataFrame, asofs, p: Params) -> DataFrame:
    """S12 for every monitoring date m at once: the stored forecast rows (one class)
    of the period whose last month is the month before m, tagged ``asof`` = m.
    (The reference ignores months older than prev - 24 while looking for that
    period; that cannot change which period's last month equals prev.)
    The period and date tables have at most one row per period / date."""
    fc = forecasts.where(F.col(S.CLASS) == p.product_class)
    mm = F.trunc(F.to_date(F.col(S.DATE)), "MM")
    last = fc.groupBy("period").agg(F.max(mm).alias("_last"))
    dates = F.array(*[F.struct(F.lit(asof_months(a)["asof"]).alias("asof"),
                               F.lit(asof_months(a)["prev"]).alias("_last")) for a in asofs])
    wanted = last.sparkSession.range(1).select(F.explode(dates).alias("_d")).select("_d.asof", "_d._last")
    chosen = (wanted.join(F.broadcast(last), "_last")
                    .groupBy("asof").agg(F.max("period").alias("period")))
    return fc.join(F.broadcast(chosen), "period")


def backfill_monitoring(forecasts: DataFrame, demand: DataFrame, asofs, p: Params) -> DataFrame:
    """T15 for every date: errors of the forecast that has just completed, against
    that date's actuals; ``asof`` + the 27 monitoring columns, stamped per date.
    ``forecasts``: stored forecast rows (any run dates, FORECAST_SCHEMA columns)."""
    fc = monitorable_per_date(forecasts.drop("asof") if "asof" in forecasts.columns else forecasts, asofs, p)
    act = backfill_actuals(demand, asofs, p)
    out = monitor_errors(fc.drop(*S.STAMP_COLS), act, by=BY)
    out = out.withColumns(stamp_columns(F.col("asof"), p.stamp_time_zone))
    return S.conform(out, S.MONITOR_SCHEMA, leading=BY)


def run_backfill(demand: DataFrame, known: DataFrame, asofs, p: Params, forecast_path: str,
                 monitor_path: str, model=None) -> dict:
    """T16 with sinks: every date's forecast is stored unless its month is already (run-once, as
    S10), then every date's monitoring is computed from the stored forecasts and stored the
    same way. Two write jobs in total, however many dates; each publishes all its months at
    once. Returns the periods written; caches are released at the end."""
    spark = demand.sparkSession
    forecasts = MonthTable(spark, forecast_path, S.FORECAST_SCHEMA)
    monitoring = MonthTable(spark, monitor_path, S.MONITOR_SCHEMA)
    with caches_released():
        wrote = forecasts.write(backfill_forecast(demand, known, asofs, p, model).drop(*BY))
        measured = monitoring.write(backfill_monitoring(forecasts.read(), demand, asofs, p).drop(*BY))
    return {"forecast": [period for period, _ in wrote], "monitoring": [period for period, _ in measured]}
