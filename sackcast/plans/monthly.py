"""One dated run (T17): scan -> panel -> splits -> segments -> forecast -> stamp,
and the monitoring half. Everything up to the sink is one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import caches_released, keep
from sackcast.operators.forecast import known_keys, not_eligible_forecast
from sackcast.operators.model_paths import modelled_forecast
from sackcast.operators.monitor import monitor_errors, monitorable_forecast
from sackcast.operators.prepare import LAST_MONTH, prepare_demand
from sackcast.operators.quantile_model import fit_or_load_regression
from sackcast.operators.seasonal import eligible_forecast, fit_or_load
from sackcast.operators.segment import segment
from sackcast.operators.skus import eligible_split, known_split
from sackcast.operators.stamp import add_period_stamp
from sackcast.params import Params
from sackcast.plans.series import series_forecast
from sackcast.sources.checks import ScanCheck
from sackcast.sources.commits import MonthTable
from sackcast.sources.demand import actuals_scan, demand_scan


def prepared_panel(demand: DataFrame, asof, p: Params, keep_last: bool = False) -> DataFrame:
    """S1 + T2: the gap-free monthly panel of the run (``keep_last``: with the
    internal ``_last_month`` column used by the later steps)."""
    return prepare_demand(demand_scan(demand, asof, p), p.filters(), S.PRODUCT_KEY, (S.QTY,),
                          True, True, p.history_months, keep_last=keep_last)


@dataclass
class RunFrames:
    panel: DataFrame
    segments: DataFrame
    eligible: DataFrame
    not_eligible: DataFrame
    known_active: DataFrame
    unknown: DataFrame
    known_inactive: DataFrame
    known: DataFrame
    known_list: DataFrame | None = None   # the list without run keys (backfill)


def split_run(panel: DataFrame, known: DataFrame, p: Params, by: tuple[str, ...] = (),
              known_list: DataFrame | None = None) -> RunFrames:
    """G6 + G4 + G5 on a prepared panel.

    The panel feeds the known split, the segments, the eligibility join and the
    per-run max months, so it is persisted once (memory, spilling to disk; lost
    blocks are recomputed from lineage). It is one row per key and month, far
    smaller than the demand rows it summarises."""
    panel = keep(panel)
    ka, unk, ki = known_split(panel.drop(LAST_MONTH), known, S.PRODUCT_KEY, by)
    seg = segment(panel, p, by=by)
    el, nel = eligible_split(panel, p, seg, by=by)
    return RunFrames(panel, seg, el, nel, ka, unk, ki, known, known_list)


def forecast_rows(fr: RunFrames, p: Params, params: DataFrame | None = None, by: tuple[str, ...] = (),
                  model=None) -> DataFrame:
    """Eligible -> seasonal quantiles (eligible, active); the rest with recent
    sales -> moving average, without -> zero (not eligible, active); one union.
    ``model``: a ``QuantileModel`` or a user's function (or functions, tried in turn)
    in place of the seasonal quantiles. The three inputs are disjoint, so each series gets exactly ``horizon`` rows."""
    k = [*by, *S.PRODUCT_KEY]
    # is_known matches on the 4-column series key (N10); joined per series,
    # before the rows are multiplied by the horizon
    # (the flag does not depend on the run date: with the plain list at hand, the
    # flag table is built once and joined on the series key for every date)
    if fr.known_list is not None:
        kk = known_keys(fr.known_list, S.SERIES_KEY)
    else:
        kk = known_keys(fr.known, S.SERIES_KEY, by)
    # the panel is gap-filled up to its max month for every series, so each
    # subset's max month is the panel's: read it from the cached panel
    if model is None:
        served = eligible_forecast(fr.eligible, p, params, S.PRODUCT_KEY, by=by, top_source=fr.panel, series_flags=kk)
    else:
        served = modelled_forecast(fr.eligible, p, model, S.PRODUCT_KEY, by=by, top_source=fr.panel, series_flags=kk)
    served = served.withColumn("is_eligible", F.lit(True))
    simple = (not_eligible_forecast(fr.not_eligible, p, S.PRODUCT_KEY, by=by, top_source=fr.panel,
                                    series_flags=kk).withColumn("is_eligible", F.lit(False)))
    rows = served.unionByName(simple)
    return rows.select(*k, F.col(S.MONTH).alias(S.DATE), *S.Q_COLS, "model_type", "has_sales",
                       "is_eligible", "is_known", F.lit(True).alias("is_active"))


def forecast_month(demand: DataFrame, known: DataFrame, asof, p: Params,
                   params: DataFrame | None = None, model_path: str | None = None, model=None) -> DataFrame:
    """The month's forecast in the output layout (21 columns), lazily.

    ``model``: see ``forecast_rows``; ``"regression"`` fits the quantile regression on the run's
    eligible series, or loads the month's coefficients from ``model_path`` (eager, as a fit is).

    ``model_path``: versioned parameter table (T10). The month's version is loaded
    if stored, else fitted on the eligible series, appended and loaded (that write
    is the only eager step)."""
    if model is None and params is None and model_path is None:
        rows = series_forecast(demand, known, [asof], p).drop("asof")
        return S.conform(add_period_stamp(rows, asof, p.stamp_time_zone), S.FORECAST_SCHEMA)
    fr = split_run(prepared_panel(demand, asof, p, keep_last=True), known, p)
    if isinstance(model, str):
        if model != "regression":
            raise ValueError(f"no model {model!r}")
        model = fit_or_load_regression(fr.eligible, asof, p, model_path)
    if model is None and params is None and model_path is not None:
        train = fr.eligible.select(*S.PRODUCT_KEY, S.MONTH, S.QTY)
        params = fit_or_load(demand.sparkSession, train, model_path, asof, p.quantiles, S.PRODUCT_KEY,
                             p.product_class)
    return S.conform(add_period_stamp(forecast_rows(fr, p, params, model=model), asof, p.stamp_time_zone), S.FORECAST_SCHEMA)


def monitoring_month(stored_forecast: DataFrame, demand: DataFrame, asof, p: Params) -> DataFrame:
    """S12 + S13 + T2 + T15 + P8: errors of the forecast that has just completed."""
    return monitoring_errors(monitorable_forecast(stored_forecast, asof, p.product_class), demand, asof, p)


def monitoring_errors(fc: DataFrame, demand: DataFrame, asof, p: Params) -> DataFrame:
    """S13 + T2 + T15 + P8 for the rows of one completed forecast."""
    act = prepare_demand(actuals_scan(demand, asof, p), p.filters(), S.PRODUCT_KEY, (S.QTY,),
                         True, True, p.history_months)
    out = monitor_errors(fc, act)
    return S.conform(add_period_stamp(out, asof, p.stamp_time_zone), S.MONITOR_SCHEMA)


def run_month(demand: DataFrame, known: DataFrame, asof, p: Params, forecast_path: str,
              monitor_path: str, model_path: str | None = None, model=None) -> dict:
    """Run-once guards, store the month's forecast, then the monitoring.

    A month already stored is not computed again. ``forecast`` and ``monitoring`` are the
    stored rows, read back either way (S10, S11): the month's forecast, and the errors of the
    forecast that has just completed (empty if there is none). ``input``: what the scan of
    the demand counted (None where nothing was computed); a broken input raises
    ``BrokenInput`` and publishes nothing. Caches are released at the end."""
    spark = demand.sparkSession
    period = int(str(asof)[:7].replace("-", ""))
    forecasts = MonthTable(spark, forecast_path, S.FORECAST_SCHEMA)
    monitoring = MonthTable(spark, monitor_path, S.MONITOR_SCHEMA)
    wrote_fc = wrote_mon = False
    read = None
    with caches_released():
        if forecasts.month(period, p.product_class) is None:
            scan = ScanCheck(asof, p)
            fc = forecast_month(scan.watch(demand), known, asof, p, model_path=model_path, model=model)
            wrote_fc = (period, p.product_class) in forecasts.write(fc, check=scan.enforce)
            read = scan.report()
        if monitoring.month(period, p.product_class) is None:
            mon = monitoring_errors(forecasts.completed(asof, p.product_class), demand, asof, p)
            wrote_mon = (period, p.product_class) in monitoring.write(mon)
    return {"period": period, "forecast_written": wrote_fc, "monitoring_written": wrote_mon, "input": read,
            "forecast": forecasts.read_month(period, p.product_class),
            "monitoring": monitoring.read_month(period, p.product_class)}
