"""Scan, months and series rows of one or many as-of dates; segments and forecasts from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.operators.forecast import known_keys
from sackcast.operators.one_pass import run_forecasts, run_segments, run_series
from sackcast.operators.prepare import apply_filters, clean_quantity, monthly_sum, periodise
from sackcast.params import Params
from sackcast.sources.demand import _month_start, asof_months


def history_runs(asofs, history: int):
    out = []
    for a in asofs:
        m = asof_months(a)
        out.append((m["asof"], _month_start(m["prev"], -history), m["month"]))
    return out


def scanned_months(demand: DataFrame, runs, p: Params) -> DataFrame:
    """S1 over the union of the runs' windows + P1-P3 + A1."""
    lo = min(r[1] for r in runs)
    hi = max(r[2] for r in runs)
    scan = demand.where((F.col(S.DATE) >= F.lit(lo)) & (F.col(S.DATE) < F.lit(hi))
                        & (F.col(S.CLASS) == p.product_class))
    return monthly_sum(apply_filters(clean_quantity(periodise(scan)), p.filters()))


def backfill_series(demand: DataFrame, asofs, p: Params) -> DataFrame:
    """One row per as-of date and series: its gap-filled months as an array (``run_series``)."""
    runs = history_runs(asofs, p.history_months)
    return run_series(scanned_months(demand, runs, p), runs, p.history_months)


def backfill_segments(demand: DataFrame, asofs, p: Params) -> DataFrame:
    """G4 for every date."""
    return run_segments(backfill_series(demand, asofs, p), p)


def series_forecast(demand: DataFrame, known: DataFrame, asofs, p: Params) -> DataFrame:
    """T14 for every date in one pass over the series: ``asof`` and the forecast rows, not yet stamped."""
    series = backfill_series(demand, asofs, p)
    rows = run_forecasts(series, run_segments(series, p), known_keys(known, S.SERIES_KEY), p)
    return rows.withColumnRenamed(S.MONTH, S.DATE).withColumn("is_active", F.lit(True))
