"""Named queries over the driver's tables (one per operator group of the survey)
and their DuckDB twins. Each query: ``(spark, sf_dir) -> DataFrame``; every one
reads the whole tables through the demand mapping, no sampling or caps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import item_id, split_item_id
from sackcast.operators.features import (CALENDAR_COLS, calendar_features, future_frame, lag_features,
                                         model_input, static_features)
from sackcast.operators.forecast import moving_average_forecast, zero_forecast
from sackcast.operators.monitor import monitorable_forecast
from sackcast.operators.prepare import (LAST_MONTH, apply_filters, clean_quantity, complete_months, monthly_sum,
                                        periodise)
from sackcast.operators.quantile_model import (QuantileModel, fit_quantile_model, regression_forecast)
from sackcast.operators.selection import CANDIDATES, selected_forecast, validate_models
from sackcast.operators.seasonal import PARAM_COLS, backtest, fit_seasonal_quantiles, forecast_with, seasonal_forecast
from sackcast.operators.segment import cumulative_share, segment, segment_metrics
from sackcast.operators.skus import recent_sales_flag, recent_sales_split
from sackcast.operators.stamp import stamp_columns, to_forecast_layout, to_monitor_layout
from sackcast.params import DEFAULT, Params
from sackcast.plans import oracle as O
from sackcast.plans.backfill import backfill_forecast, backfill_monitoring, backfill_segments, monthly_asof_dates
from sackcast.plans.monthly import RunFrames, forecast_month, forecast_rows, monitoring_month, prepared_panel, split_run
from sackcast.sources.demand import demand_scan
from sackcast.sources.fixtures import demand_from_tables, known_from_demand

# Fixed values of the fixtures: the main as-of date and the earlier one whose
# 18 months end at the main run's previous month.
ASOF = "2001-08-15"
ASOF_EARLY = "2000-02-15"
ASOFS = monthly_asof_dates(ASOF, 19)   # the first one is ASOF_EARLY
BACKTEST_CUTOFFS = tuple(f"2000-{m:02d}-01" for m in range(1, 13))   # 12 windows; the first scores all steps
P = DEFAULT
# A fixed model for the compared queries (by quantile level, in the order of FEATURES); the fitted one is ``regression_fit``.
REGRESSION = QuantileModel(P.quantiles, (
    (-0.217, 0.0, -0.002, 0.0, -0.002, -0.001, -0.018, 0.033, -0.008, -0.001, -0.004, -0.092, -0.124, 0.026, 0.021, 0.097),
    (-0.016, 0.01, -0.001, 0.02, -0.001, 0.03, -0.008, 0.024, -0.003, -0.002, -0.001, -0.004, -0.012, 0.007, 0.005, 0.026),
    (0.02, 0.011, -0.003, 0.01, -0.002, -0.001, -0.026, 0.056, -0.012, -0.001, -0.002, 0.022, -0.002, 0.03, 0.031, 0.58),
    (0.939, -0.013, -0.042, 0.001, -0.032, -0.017, 0.204, -1.685, -0.04, 0.02, -0.031, 0.816, 0.123, 0.657, 0.418, 0.66),
    (4.895, -0.016, -0.015, -0.003, -0.09, 0.133, 1.401, -6.14, 0.068, -0.139, -0.284, 2.26, 2.635, -3.079, -0.929, 0.146)))
NAMES = S.segment_names(P.segment_window, P.segment_prefix)
KEYS = list(S.PRODUCT_KEY)


def _demand(spark, sf):
    return demand_from_tables(spark, sf)


def _frames(spark, sf, asof=ASOF, p: Params = P) -> RunFrames:
    d = _demand(spark, sf)
    return split_run(prepared_panel(d, asof, p, keep_last=True), known_from_demand(d), p)


def _r6(c):
    # engine-neutral doubles: 6 decimals, and +0.0 turns a negative zero positive
    return F.bround(c, 6) + F.lit(0.0)


# --- scans and preparation ------------------------------------------------------

def q_demand_scan(spark, sf):
    d = demand_scan(_demand(spark, sf), ASOF, P)
    return apply_filters(d, P.filters()).select(*KEYS, S.DATE, S.QTY)


def q_periodise(spark, sf):
    d = apply_filters(demand_scan(_demand(spark, sf), ASOF, P), P.filters())
    return clean_quantity(periodise(d)).select(*KEYS, S.DATE, "period", S.MONTH, S.QTY)


def _monthly(spark, sf):
    d = apply_filters(demand_scan(_demand(spark, sf), ASOF, P), P.filters())
    return monthly_sum(clean_quantity(periodise(d)))


def q_monthly_demand(spark, sf):
    return _monthly(spark, sf)


def q_complete_months(spark, sf):
    full = complete_months(_monthly(spark, sf), P.history_months)
    return full.groupBy(*KEYS).agg(
        F.count(F.lit(1)).cast("long").alias("n_months"),
        F.count(F.when(F.col(S.QTY) == 0, 1)).cast("long").alias("n_filled"),
        F.min(S.MONTH).alias("first_month"), F.max(S.MONTH).alias("last_month"),
        F.sum(S.QTY).alias("total_qty"))


def q_prepared_panel(spark, sf):
    return prepared_panel(_demand(spark, sf), ASOF, P)


# --- known / unknown --------------------------------------------------------------

def q_known_active(spark, sf):
    return _frames(spark, sf).known_active


def q_unknown_skus(spark, sf):
    return _frames(spark, sf).unknown


def q_known_inactive(spark, sf):
    return _frames(spark, sf).known_inactive


# --- segmentation -----------------------------------------------------------------

def q_cv_rotation(spark, sf):
    return segment_metrics(prepared_panel(_demand(spark, sf), ASOF, P), P.segment_window, NAMES)


def q_cumulative_share(spark, sf):
    m = segment_metrics(prepared_panel(_demand(spark, sf), ASOF, P), P.segment_window, NAMES)
    x = cumulative_share(m, NAMES["value"], list(S.WAREHOUSE_KEY), [S.MATERIAL, S.UNIT], "share")
    return x.select(*KEYS, NAMES["value"], _r6(F.col("share")).alias("share"))


def _segments(spark, sf):
    return _frames(spark, sf).segments


def q_abc_segments(spark, sf):
    return _segments(spark, sf).select(*KEYS, NAMES["value"], NAMES["abc"])


def q_xyz_segments(spark, sf):
    return _segments(spark, sf).select(*KEYS, NAMES["cv"], NAMES["xyz"])


def q_fsn_segments(spark, sf):
    return _segments(spark, sf).select(*KEYS, NAMES["rotation"], NAMES["fsn"])


def q_segment_skus(spark, sf):
    return _segments(spark, sf)


def q_fractional_segments(spark, sf):
    """G4 on fractional quantities: the line items' prices."""
    d = demand_from_tables(spark, sf, "l_extendedprice")
    return segment(prepared_panel(d, ASOF, P), P)


def q_eligible_skus(spark, sf):
    return _frames(spark, sf).eligible.drop(LAST_MONTH)


def q_ineligible_skus(spark, sf):
    return _frames(spark, sf).not_eligible.drop(LAST_MONTH)


def q_recent_sales_split(spark, sf):
    return recent_sales_flag(_frames(spark, sf).not_eligible, P.sales_window, KEYS)


# --- features ---------------------------------------------------------------------

def _lagged(spark, sf):
    return lag_features(_frames(spark, sf).eligible.select(*KEYS, S.MONTH, S.QTY), P.horizon, KEYS)


def q_lag_features(spark, sf):
    return _lagged(spark, sf).select(*KEYS, S.MONTH, S.QTY, *[f"qty_LAG{k}" for k in range(1, P.horizon)])


def q_rolling_means(spark, sf):
    return _lagged(spark, sf).select(*KEYS, S.MONTH, *[_r6(F.col(f"qty_MEAN{k}")).alias(f"qty_MEAN{k}")
                                                      for k in range(2, P.horizon)])


def _cal_out(df):
    ints = ("month_num", "quarter", "half", "t_linear", "t_quadratic")
    return [F.col(c).cast("long").alias(c) if c in ints else _r6(F.col(c)).alias(c) for c in CALENDAR_COLS]


def q_calendar_features(spark, sf):
    x = calendar_features(_frames(spark, sf).eligible.select(*KEYS, S.MONTH, S.QTY))
    return x.select(*KEYS, S.MONTH, *_cal_out(x))


def q_future_frame(spark, sf):
    x = future_frame(_frames(spark, sf).eligible.select(*KEYS, S.MONTH), P.horizon, KEYS)
    return x.select(*KEYS, S.MONTH, F.col("step").cast("long").alias("step"), *_cal_out(x))


def q_model_input(spark, sf):
    seg_cols = [NAMES["abc"], NAMES["xyz"], NAMES["fsn"]]
    x = model_input(_frames(spark, sf).eligible, seg_cols, P.horizon, list(S.SERIES_KEY))
    ints = ("month_num", "quarter", "half", "t_linear", "t_quadratic")
    cal = [F.col(c).cast("long").alias(c) if c in ints else _r6(F.col(c)).alias(c) for c in CALENDAR_COLS]
    lags = [f"qty_LAG{k}" for k in range(1, P.horizon)]
    means = [_r6(F.col(f"qty_MEAN{k}")).alias(f"qty_MEAN{k}") for k in range(2, P.horizon)]
    return x.select(*S.SERIES_KEY, "item_id", "timestamp", "target", *lags, *means, *cal, *seg_cols)


def q_static_features(spark, sf):
    cols = [NAMES["abc"], NAMES["xyz"], NAMES["fsn"]]
    return static_features(_frames(spark, sf).eligible, cols, KEYS)


# --- forecast paths ---------------------------------------------------------------

def q_moving_average_forecast(spark, sf):
    with_s, _ = recent_sales_split(_frames(spark, sf).not_eligible, P.sales_window, KEYS)
    return moving_average_forecast(with_s, P.horizon, P.sales_window, KEYS)


def q_zero_forecast(spark, sf):
    _, without = recent_sales_split(_frames(spark, sf).not_eligible, P.sales_window, KEYS)
    return zero_forecast(without, P.horizon, KEYS)


def q_seasonal_params(spark, sf):
    x = fit_seasonal_quantiles(_frames(spark, sf).eligible, P.quantiles, KEYS)
    return x.select(*KEYS, F.col("n_residuals").cast("long").alias("n_residuals"),
                    *[_r6(F.col(c)).alias(c) for c in PARAM_COLS])


def q_seasonal_forecast(spark, sf):
    el = _frames(spark, sf).eligible
    return seasonal_forecast(el, fit_seasonal_quantiles(el, P.quantiles, KEYS), P.horizon, KEYS)


def _shipped(df: DataFrame) -> DataFrame:
    """The shipped instants as UTC wall clock (TIMESTAMP_NTZ), whatever the session's zone, for comparison."""
    return df.withColumns({c: F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
                           for c in ("loaded_at", "deleted_at")})


def _forecast(spark, sf, asof=ASOF, model=None):
    d = _demand(spark, sf)
    return forecast_month(d, known_from_demand(d), asof, P, model=model)


def q_forecast_flags(spark, sf):
    fc = forecast_rows(_frames(spark, sf), P)
    return fc.select(*KEYS, "model_type", *S.FLAG_COLS).distinct()


def q_full_forecast(spark, sf):
    return _shipped(_forecast(spark, sf))


def q_period_stamp(spark, sf):
    months = _monthly(spark, sf).select(S.MONTH).distinct()
    return _shipped(months.withColumns(stamp_columns(F.col(S.MONTH), P.stamp_time_zone)))


def _stored(spark, sf):
    return _forecast(spark, sf, ASOF_EARLY).unionByName(_forecast(spark, sf, ASOF))


def q_monitorable_period(spark, sf):
    return _shipped(monitorable_forecast(_stored(spark, sf), ASOF, P.product_class))


def q_monitor_errors(spark, sf):
    return _shipped(monitoring_month(_stored(spark, sf), _demand(spark, sf), ASOF, P))


def q_backtest_mae(spark, sf):
    el = _frames(spark, sf).eligible.select(*KEYS, S.MONTH, S.QTY)
    x = backtest(el, list(BACKTEST_CUTOFFS), P.horizon, P.quantiles, KEYS)
    return x.select("cutoff", F.col("step").cast("long").alias("step"), F.col("n").cast("long").alias("n"),
                    _r6(F.col("mae")).alias("mae"))


def q_regression_fit(spark, sf):
    """T9 on the whole eligible panel: the coefficients, by level and feature."""
    return fit_quantile_model(_frames(spark, sf).eligible, P.quantiles, P.horizon, KEYS, names=NAMES).frame(spark)


def q_regression_forecast(spark, sf):
    return regression_forecast(_frames(spark, sf).eligible, REGRESSION, P.horizon, KEYS, names=NAMES)


def _validated(el):
    return validate_models(el, BACKTEST_CUTOFFS, REGRESSION, P.horizon, KEYS, names=NAMES)


def q_model_selection(spark, sf):
    x = _validated(_frames(spark, sf).eligible)
    return x.select(*KEYS, "n_points", *[_r6(F.col(f"mae_{c}")).alias(f"mae_{c}") for c in CANDIDATES], "chosen")


def q_selected_forecast(spark, sf):
    el = _frames(spark, sf).eligible
    return selected_forecast(el, _validated(el), REGRESSION, P.horizon, KEYS, names=NAMES)


def q_backfill_segments(spark, sf):
    return backfill_segments(_demand(spark, sf), ASOFS, P)


def _last12_mean_model(pdf):
    """Example user model for the hook: mean of the last 12 months, 18 months ahead,
    clamped at 0 and rounded half-even. Runs once per series (pandas)."""
    import numpy as np
    import pandas as pd

    pdf = pdf.sort_values("month")
    last = pd.Timestamp(pdf["month"].iloc[-1])
    level = max(0.0, float(np.round(pdf["qty"].tail(12).mean())))
    months = [(last + pd.DateOffset(months=h)).date() for h in range(1, P.horizon + 1)]
    out = pd.DataFrame({c: pdf[c].iloc[0] for c in KEYS}, index=range(len(months)))
    out["month"] = months
    out["q50"] = int(level)
    return out


def q_custom_model_hook(spark, sf):
    el = _frames(spark, sf).eligible.select(*KEYS, S.MONTH, S.QTY)
    schema = ", ".join(f"{c} string" for c in KEYS) + ", month date, q50 bigint"
    return forecast_with(el, _last12_mean_model, schema, KEYS)


def _filtered(spark, sf):
    return apply_filters(demand_scan(_demand(spark, sf), ASOF, P), P.filters())


def q_forecast_template(spark, sf):
    return _shipped(to_forecast_layout(_filtered(spark, sf), ASOF, P))


def q_monitor_template(spark, sf):
    return _shipped(to_monitor_layout(_filtered(spark, sf), ASOF, P))


def q_item_id_parts(spark, sf):
    """The joined id of every series of the panel and its parts."""
    x = _monthly(spark, sf).select(*S.SERIES_KEY).distinct().withColumn("item_id", item_id(S.SERIES_KEY))
    return x.select("item_id", *[c.alias(n) for n, c in split_item_id("item_id", [f"part_{k}" for k in S.SERIES_KEY]).items()])


def q_regression_month(spark, sf):
    """T14 with the quantile regression on the eligible path."""
    return _shipped(_forecast(spark, sf, model=REGRESSION))


def _failing_model(history, future):
    raise ValueError("no answer")


def _spread_model(history, future):
    """A user's model: the mean of the last 12 months; its two low quantiles cross, and one warehouse's series fail."""
    level = float(history["qty"].tail(12).mean())
    if history["warehouse"].iloc[0] == "C001":
        raise ValueError("no answer either")
    return future[["month"]].assign(q05=level * 0.75, q25=level * 0.25, q50=level, q75=level * 1.25, q95=level * 1.5)


def q_custom_model_month(spark, sf):
    """T14 with a user's functions: the first raises, the second serves all series but those of one warehouse."""
    return _shipped(_forecast(spark, sf, model=(_failing_model, _spread_model)))


def _backfill_fc(spark, sf):
    d = _demand(spark, sf)
    return backfill_forecast(d, known_from_demand(d), ASOFS, P)


def q_backfill_forecast(spark, sf):
    return _shipped(_backfill_fc(spark, sf))


def q_backfill_monitoring(spark, sf):
    return _shipped(backfill_monitoring(_backfill_fc(spark, sf), _demand(spark, sf), ASOFS, P))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "demand_scan": q_demand_scan,
    "periodise": q_periodise,
    "monthly_demand": q_monthly_demand,
    "complete_months": q_complete_months,
    "prepared_panel": q_prepared_panel,
    "known_active": q_known_active,
    "unknown_skus": q_unknown_skus,
    "known_inactive": q_known_inactive,
    "cv_rotation": q_cv_rotation,
    "cumulative_share": q_cumulative_share,
    "abc_segments": q_abc_segments,
    "xyz_segments": q_xyz_segments,
    "fsn_segments": q_fsn_segments,
    "segment_skus": q_segment_skus,
    "fractional_segments": q_fractional_segments,
    "eligible_skus": q_eligible_skus,
    "ineligible_skus": q_ineligible_skus,
    "recent_sales_split": q_recent_sales_split,
    "lag_features": q_lag_features,
    "rolling_means": q_rolling_means,
    "calendar_features": q_calendar_features,
    "future_frame": q_future_frame,
    "static_features": q_static_features,
    "model_input": q_model_input,
    "moving_average_forecast": q_moving_average_forecast,
    "zero_forecast": q_zero_forecast,
    "seasonal_params": q_seasonal_params,
    "seasonal_forecast": q_seasonal_forecast,
    "forecast_flags": q_forecast_flags,
    "full_forecast": q_full_forecast,
    "period_stamp": q_period_stamp,
    "monitorable_period": q_monitorable_period,
    "monitor_errors": q_monitor_errors,
    "backtest_mae": q_backtest_mae,
    "regression_fit": q_regression_fit,
    "regression_forecast": q_regression_forecast,
    "model_selection": q_model_selection,
    "selected_forecast": q_selected_forecast,
    "backfill_segments": q_backfill_segments,
    "backfill_forecast": q_backfill_forecast,
    "backfill_monitoring": q_backfill_monitoring,
    "custom_model_hook": q_custom_model_hook,
    "forecast_template": q_forecast_template,
    "monitor_template": q_monitor_template,
    "item_id_parts": q_item_id_parts,
    "regression_month": q_regression_month,
    "custom_model_month": q_custom_model_month,
}


# --- DuckDB twins ---------------------------------------------------------------------

def _lags_sql() -> str:
    cols = []
    for k in range(1, P.horizon):
        lag = f"lag(qty, {k}) over (partition by {O.KEYS} order by month)"
        cols.append(f"coalesce({lag}, first_value(qty) over (partition by {O.KEYS} order by month)) as qty_LAG{k}")
    return ",\n  ".join(cols)


def _means_sql() -> str:
    inner, outer = [], []
    for w in range(2, P.horizon):
        frame = f"over (partition by {O.KEYS} order by month rows between {w} preceding and 1 preceding)"
        inner.append(f"case when count(qty) {frame} >= {w} then avg(qty) {frame} end as m{w}")
        whole = (f"over (partition by {O.KEYS} order by month rows between unbounded preceding "
                 f"and unbounded following)")
        outer.append(f"round_even(coalesce(m{w}, first_value(m{w} ignore nulls) {whole}), 6) + 0.0 as qty_MEAN{w}")
    return ",\n  ".join(inner), ",\n  ".join(outer)


def _calendar_sql(ts: str, origin: str) -> str:
    t = f"((year({ts}) * 12 + month({ts})) - (year({origin}) * 12 + month({origin})))"
    half = f"(case when month({ts}) <= 6 then 1 else 2 end)"
    r6 = lambda e: f"round_even({e}, 6) + 0.0"
    return ",\n  ".join([
        f"cast(month({ts}) as bigint) as month_num",
        f"{r6(f'sin(2 * pi() * month({ts}) / 12)')} as month_sin",
        f"{r6(f'cos(2 * pi() * month({ts}) / 12)')} as month_cos",
        f"cast(quarter({ts}) as bigint) as quarter",
        f"{r6(f'sin(2 * pi() * quarter({ts}) / 4)')} as quarter_sin",
        f"{r6(f'cos(2 * pi() * quarter({ts}) / 4)')} as quarter_cos",
        f"cast({half} as bigint) as half",
        f"{r6(f'sin(2 * pi() * {half} / 2)')} as half_sin",
        f"{r6(f'cos(2 * pi() * {half} / 2)')} as half_cos",
        f"cast({t} as bigint) as t_linear",
        f"cast({t} * {t} as bigint) as t_quadratic",
        f"{r6(f'ln(1 + {t})')} as t_log",
    ])


def _model_input_sql() -> str:
    sk = O.SKEYS
    lags, means_in, means_out = [], [], []
    for k in range(1, P.horizon):
        lag = f"lag(qty, {k}) over (partition by {sk} order by month)"
        lags.append(f"coalesce({lag}, first_value(qty) over (partition by {sk} order by month)) as qty_LAG{k}")
    for w in range(2, P.horizon):
        frame = f"over (partition by {sk} order by month rows between {w} preceding and 1 preceding)"
        means_in.append(f"case when count(qty) {frame} >= {w} then avg(qty) {frame} end as m{w}")
        whole = f"over (partition by {sk} order by month rows between unbounded preceding and unbounded following)"
        means_out.append(f"round_even(coalesce(m{w}, first_value(m{w} ignore nulls) {whole}), 6) + 0.0 as qty_MEAN{w}")
    lag_names = ", ".join(f"qty_LAG{k}" for k in range(1, P.horizon))
    return f"""
select {sk}, concat_ws('_', {sk}) as item_id, month as timestamp, qty as target, {lag_names},
  {", ".join(means_out)},
  {_calendar_sql('month', 'o.origin')},
  abc_qty_30m, xyz_qty_30m, fsn_qty_30m
from (select {sk}, month, qty, abc_qty_30m, xyz_qty_30m, fsn_qty_30m,
        {", ".join(lags)},
        {", ".join(means_in)}
      from r_elig) x, (select min(month) as origin from r_elig) o"""


def _run(tag="r_", asof=ASOF, forecast=False) -> str:
    return ",".join(O.run_ctes(tag, asof, P, forecast))


def oracle_sql() -> dict[str, str]:
    W = O.with_ctes
    K = O.KEYS
    seg_cols = ("value_qty_30m, cv_qty_30m, rotation_qty_30m, abc_qty_30m, xyz_qty_30m, fsn_qty_30m")
    inner, outer = _means_sql()
    qcols = "q05, q25, q50, q75, q95"
    flags = "has_sales, is_eligible, is_known, is_active"
    stamp = "run_date, period, loaded_at, deleted, deleted_at"
    fc_cols = f"{K}, date, {qcols}, model_type, {flags}, {stamp}"
    mon = O.panel_ctes("c_", ASOF, P, actuals=True)
    stored = f"""
stored as (select * from e_forecast union all select * from r_forecast),
chosen as (
  select max(period) as period from (
    select period, max(cast(date_trunc('month', date) as date)) as last
    from stored where product_class = '{P.product_class}'
      and cast(date_trunc('month', date) as date) >= {O._d('1999-07-01')}
    group by period) where last = {O._d('2001-07-01')}),
picked as (select s.* from stored s where s.product_class = '{P.product_class}'
           and s.period = (select period from chosen))"""
    bt_cuts = ", ".join(f"date '{c}'" for c in BACKTEST_CUTOFFS)
    return {
        "demand_scan": W(O.panel_ctes("r_", ASOF, P)) + f"select {K}, date, qty from r_scan "
                       f"where company in ({O._in(P.companies)})",
        "periodise": W(O.panel_ctes("r_", ASOF, P)) + f"select {K}, date, period, month, qty from r_periodised",
        "monthly_demand": W(O.panel_ctes("r_", ASOF, P)) + f"select {K}, month, qty from r_monthly",
        "complete_months": W(O.panel_ctes("r_", ASOF, P)) + f"""
select {K}, count(*) as n_months, count(*) filter (where qty = 0) as n_filled,
       min(month) as first_month, max(month) as last_month, sum(qty) as total_qty
from r_panel group by {K}""",
        "prepared_panel": W(O.panel_ctes("r_", ASOF, P)) + f"select {K}, month, qty from r_panel",
        "known_active": W(_run()) + f"select {K}, month, qty from r_ka",
        "unknown_skus": W(_run()) + f"select {K}, month, qty from r_unk",
        "known_inactive": W(_run()) + f"select {K} from r_ki",
        "cv_rotation": W(_run()) + f"select {K}, value_qty_30m, cv_qty_30m, rotation_qty_30m from r_metrics",
        "cumulative_share": W(_run()) + f"select {K}, value_qty_30m, round_even(_share, 6) + 0.0 as share from r_cls",
        "abc_segments": W(_run()) + f"select {K}, value_qty_30m, abc_qty_30m from r_seg",
        "xyz_segments": W(_run()) + f"select {K}, cv_qty_30m, xyz_qty_30m from r_seg",
        "fsn_segments": W(_run()) + f"select {K}, rotation_qty_30m, fsn_qty_30m from r_seg",
        "segment_skus": W(_run()) + f"select {K}, {seg_cols} from r_seg",
        "fractional_segments": W(_run()).replace("l_quantity as qty", "l_extendedprice as qty") + f"select {K}, {seg_cols} from r_seg",
        "eligible_skus": W(_run()) + f"select {K}, month, qty, {seg_cols} from r_elig",
        "ineligible_skus": W(_run()) + f"select {K}, month, qty, {seg_cols} from r_nelig",
        "recent_sales_split": W(_run()) + f"""
select {K}, coalesce(bool_or(month > cast(t.top - interval {P.sales_window - 1} month as date) and qty > 0), false) as has_sales
from r_nelig, (select max(month) as top from r_nelig) t group by {K}""",
        "lag_features": W(_run()) + f"select {K}, month, qty,\n  {_lags_sql()}\nfrom r_elig",
        "rolling_means": W(_run()) + f"select {K}, month,\n  {outer}\nfrom (select {K}, month,\n  {inner}\nfrom r_elig)",
        "calendar_features": W(_run()) + f"select {K}, month,\n  {_calendar_sql('month', 'o.origin')}\n"
                             f"from r_elig, (select min(month) as origin from r_elig) o",
        "future_frame": W(_run()) + f"""
select {K}, month, step,
  {_calendar_sql('month', 'origin')}
from (select {K}, cast(last + to_months(s.step) as date) as month, cast(s.step as bigint) as step, origin
      from (select {K}, max(month) as last from r_elig group by {K}) l,
           (select min(month) as origin from r_elig) o,
           (select unnest(generate_series(1, {P.horizon})) as step) s)""",
        "static_features": W(_run()) + f"select distinct {K}, abc_qty_30m, xyz_qty_30m, fsn_qty_30m from r_elig",
        "model_input": W(_run()) + _model_input_sql(),
        "moving_average_forecast": W(_run(forecast=True)) + f"select {K}, date as month, {qcols} from r_ma_fc where not is_eligible",
        "zero_forecast": W(_run(forecast=True)) + f"select {K}, date as month, {qcols} from r_zero_fc",
        "seasonal_params": W(_run(forecast=True)) + f"""
select {K}, n_residuals, round_even(pq[1], 6) + 0.0 as p05, round_even(pq[2], 6) + 0.0 as p25,
       round_even(pq[3], 6) + 0.0 as p50, round_even(pq[4], 6) + 0.0 as p75, round_even(pq[5], 6) + 0.0 as p95
from r_el_series""",
        "seasonal_forecast": W(_run(forecast=True)) + f"select {K}, date as month, {qcols} from r_el_fc",
        "forecast_flags": W(_run(forecast=True)) + f"select distinct {K}, model_type, {flags} from r_forecast",
        "full_forecast": W(_run(forecast=True)) + f"select {fc_cols} from r_forecast",
        "period_stamp": W(O.panel_ctes("r_", ASOF, P)) + f"""
select month, strftime(month, '%d-%m-%Y') as run_date, cast(strftime(month, '%Y%m') as int) as period,
       cast(month as timestamp) + interval 5 hour as loaded_at, false as deleted,
       cast(month as timestamp) + interval 5 hour as deleted_at
from (select distinct month from r_monthly)""",
        "monitorable_period": W(_run("e_", ASOF_EARLY, True), _run("r_", ASOF, True), stored)
                              + f"select {fc_cols} from picked",
        "monitor_errors": W(_run("e_", ASOF_EARLY, True), _run("r_", ASOF, True), stored, mon) + f"""
select f.product_class, f.company, f.warehouse, f.material, f.unit, f.date, a.qty,
       f.q05, f.q25, f.q50, f.q75, f.q95,
       f.q05 - a.qty as err05, f.q25 - a.qty as err25, f.q50 - a.qty as err50,
       f.q75 - a.qty as err75, f.q95 - a.qty as err95,
       f.model_type, f.has_sales, f.is_eligible, f.is_known, f.is_active,
       '15-08-2001' as run_date, cast(200108 as int) as period,
       timestamp '2001-08-15 05:00:00' as loaded_at, false as deleted,
       timestamp '2001-08-15 05:00:00' as deleted_at
from picked f left join c_panel a
  on {O._on('f', 'a')} and a.month = f.date
where (select count(*) from c_panel) > 0""",
        "backtest_mae": W(_run()) + f"""
, cuts as (select unnest([{bt_cuts}]) as cutoff),
hist as (select c.cutoff, e.{K.replace(', ', ', e.')}, e.month, e.qty from r_elig e join cuts c on e.month <= c.cutoff),
res as (select h.*, h.qty - p.qty as _r from hist h left join hist p
        on {O._on('h', 'p')} and p.cutoff = h.cutoff and p.month = cast(h.month - interval 12 month as date)),
par as (select cutoff, {K}, max(month) as last, count(_r) as n_res,
               quantile_cont(_r, [{', '.join(str(q) for q in P.quantiles)}]) as pq
        from res group by cutoff, {K}),
fc as (select p.cutoff, p.{K.replace(', ', ', p.')}, cast(p.last + to_months(s.h) as date) as month,
              cast(round_even(greatest(0.0, round_even(b.qty + p.pq[3], 6)), 0) as bigint) as q50
       from par p cross join (select unnest(generate_series(1, {P.horizon})) as h) s
       left join hist b on {O._on('b', 'p')} and b.cutoff = p.cutoff
            and b.month = cast(p.last + to_months(s.h - ((s.h - 1) // 12 + 1) * 12) as date)
       where p.n_res > 0)
select f.cutoff, cast(datediff('month', f.cutoff, f.month) as bigint) as step, count(*) as n,
       round_even(avg(abs(a.qty - f.q50)), 6) + 0.0 as mae
from fc f join r_elig a on {O._on('f', 'a')} and a.month = f.month
group by f.cutoff, step""",
        "regression_forecast": W(_run()) + "," + O.design_ctes("r_", P) + f"""
select {K}, month, {O.regression_quantiles(REGRESSION.coefficients)} from design""",
        "model_selection": W(_run()) + "," + O.design_ctes("r_", P, BACKTEST_CUTOFFS) + "," + O.selection_ctes(REGRESSION.coefficients[2])
                           + f"select {K}, n_points, {', '.join(f'round_even(mae_{c}, 6) + 0.0 as mae_{c}' for c in CANDIDATES)}, chosen from selection",
        "selected_forecast": W(_run()) + "," + O.design_ctes("r_", P, BACKTEST_CUTOFFS, "v_") + "," + O.selection_ctes(REGRESSION.coefficients[2], "v_")
                             + "," + O.design_ctes("r_", P) + f""",
by_regression as (select {K}, month, {O.regression_quantiles(REGRESSION.coefficients)} from design)
select d.product_class, d.company, d.warehouse, d.material, d.unit, d.month,
  {", ".join(f"coalesce(case s.chosen when 'seasonal' then {O.clamped(f'd.raw_season + d.rq[{i + 1}]')} when 'last_year' then {O.clamped('d.raw_season')} when 'level' then {O.clamped('d.mean12 * d.level')} end, g.{c}) as {c}" for i, c in enumerate(S.Q_COLS))},
  s.chosen as model
from design d join selection s on {O._on('d', 's')} join by_regression g on {O._on('d', 'g')} and g.month = d.month""",
        "backfill_forecast": W(*(_run(f"d{k}_", a, True) for k, a in enumerate(ASOFS)))
                             + "\nunion all\n".join(f"select date '{a}' as asof, {fc_cols} from d{k}_forecast" for k, a in enumerate(ASOFS)),
        "backfill_monitoring": W(_run("e_", ASOF_EARLY, True), _run("r_", ASOF, True), stored, mon) + f"""
select date '{ASOF}' as asof, f.product_class, f.company, f.warehouse, f.material, f.unit, f.date, a.qty,
       f.q05, f.q25, f.q50, f.q75, f.q95,
       f.q05 - a.qty as err05, f.q25 - a.qty as err25, f.q50 - a.qty as err50,
       f.q75 - a.qty as err75, f.q95 - a.qty as err95,
       f.model_type, f.has_sales, f.is_eligible, f.is_known, f.is_active,
       '15-08-2001' as run_date, cast(200108 as int) as period,
       timestamp '2001-08-15 05:00:00' as loaded_at, false as deleted,
       timestamp '2001-08-15 05:00:00' as deleted_at
from picked f left join c_panel a
  on {O._on('f', 'a')} and a.month = f.date
where (select count(*) from c_panel) > 0""",
        "custom_model_hook": W(_run()) + f"""
select s.product_class, s.company, s.warehouse, s.material, s.unit,
       cast(s.last + to_months(h.h) as date) as month,
       cast(greatest(0.0, round_even(s.level, 0)) as bigint) as q50
from (select {K}, max(month) as last,
             list_avg(list_slice(list(qty order by month), greatest(1, count(*) - 11), count(*))) as level
      from r_elig group by {K}) s
cross join (select unnest(generate_series(1, {P.horizon})) as h) h""",
        "monitor_template": W(O.panel_ctes("r_", ASOF, P)) + f"""
select {K}, date, cast(trunc(qty) as double) as qty, {", ".join(f"cast(0 as bigint) as {c}" for c in S.Q_COLS)},
       {", ".join(f"0.0::double as {c}" for c in S.ERR_COLS)}, '' as model_type,
       false as has_sales, false as is_eligible, false as is_known, false as is_active,
       '15-08-2001' as run_date, cast(200108 as int) as period,
       timestamp '2001-08-15 05:00:00' as loaded_at, false as deleted,
       timestamp '2001-08-15 05:00:00' as deleted_at
from r_scan where company in ({O._in(P.companies)})""",
        "item_id_parts": W(O.panel_ctes("r_", ASOF, P)) + f"""
select distinct concat_ws('_', {O.SKEYS}) as item_id, company as part_company, warehouse as part_warehouse,
       material as part_material, unit as part_unit from r_monthly""",
        "regression_month": W(_run(forecast=True)) + "," + O.design_ctes("r_", P) + f""",
reg as (select {K}, month, {O.regression_quantiles(REGRESSION.coefficients)} from design)
select {fc_cols} from r_forecast where not is_eligible
union all
select d.product_class, d.company, d.warehouse, d.material, d.unit, d.month as date, {qcols},
       '{P.label_regression}' as model_type, s.has_sales, true as is_eligible, coalesce(k.is_known, false) as is_known, true as is_active,
       '15-08-2001' as run_date, cast(200108 as int) as period, timestamp '2001-08-15 05:00:00' as loaded_at, false as deleted,
       timestamp '2001-08-15 05:00:00' as deleted_at
from reg d join r_el_series s on {O._on('d', 's')} left join r_kk k on {O._on('d', 'k', O.SKEYS)}""",
        "custom_model_month": W(_run(forecast=True), """
u_init as (
  select product_class, company, warehouse, material, unit, last, has_sales, list_slice(vals, greatest(1, len(vals) - 11), len(vals)) as w
  from r_el_series),
u_rec as (
  select product_class, company, warehouse, material, unit, last, has_sales, w as first, 0 as step, w, cast(null as bigint) as v from u_init
  union all
  select product_class, company, warehouse, material, unit, last, has_sales, first, step + 1,
         list_append(list_slice(w, 2, len(w)), greatest(0.0, round_even(list_sum(w) / len(w), 0))),
         cast(greatest(0.0, round_even(list_sum(w) / len(w), 0)) as bigint)
  from u_rec where step < 18),
u_level as (select *, list_sum(first) / len(first) as level, warehouse = 'C001' as failed from u_rec where step > 0)""") + f"""
select {fc_cols} from r_forecast where not is_eligible
union all
select u.product_class, u.company, u.warehouse, u.material, u.unit, cast(last + to_months(step) as date) as date,
       {", ".join(f"case when failed then v else {O.clamped(f'level * {f}')} end as {c}" for c, f in zip(S.Q_COLS, (0.5, 0.5, 1.0, 1.25, 1.5)))},
       case when failed then '{P.label_moving_average}' else '{P.label_user}' end as model_type,
       has_sales, true as is_eligible, coalesce(k.is_known, false) as is_known, true as is_active,
       '15-08-2001' as run_date, cast(200108 as int) as period, timestamp '2001-08-15 05:00:00' as loaded_at, false as deleted,
       timestamp '2001-08-15 05:00:00' as deleted_at
from u_level u left join r_kk k on {O._on('u', 'k', O.SKEYS)}""",
        "forecast_template": W(O.panel_ctes("r_", ASOF, P)) + f"""
select {K}, date, cast(0 as bigint) as q05, cast(0 as bigint) as q25, cast(0 as bigint) as q50,
       cast(0 as bigint) as q75, cast(0 as bigint) as q95, '' as model_type,
       false as has_sales, false as is_eligible, false as is_known, false as is_active,
       '15-08-2001' as run_date, cast(200108 as int) as period,
       timestamp '2001-08-15 05:00:00' as loaded_at, false as deleted,
       timestamp '2001-08-15 05:00:00' as deleted_at
from r_scan where company in ({O._in(P.companies)})""",
        "backfill_segments": W(*(_run(f"d{k}_", a) for k, a in enumerate(ASOFS)))
                             + "\nunion all\n".join(f"select date '{a}' as asof, {K}, {seg_cols} from d{k}_seg" for k, a in enumerate(ASOFS)),
    }
