"""The model path, re-aimed as a seasonal quantile model that Spark fits per series:

T9  fit: residuals r_t = y_t - y_(t-12 months); parameters = exact percentiles of r
    at the configured quantile levels.
T11 predict: base_h = y at (last + h - 12*ceil(h/12)) months, q_h = base_h + param_q,
    clamped at 0 and rounded half-even to an integer.
T10 month-versioned parameter table (``model_version`` partition, vYYYYMM).
T18 rolling-origin backtest with MAE per horizon.
Hook: ``forecast_with`` runs a user's own per-series pandas model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sackcast import schemas as S
from sackcast.functions import clamp_round_long, month_index

PARAM_COLS = tuple(f"p{c[1:]}" for c in S.Q_COLS)   # p05 p25 p50 p75 p95


def fit_seasonal_quantiles(panel: DataFrame, quantiles=(0.05, 0.25, 0.5, 0.75, 0.95),
                           keys=S.SERIES_KEY, qty: str = S.QTY, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per series: ``n_residuals`` and the five residual percentiles
    (NULL when the series has no month with a value 12 months earlier).

    The 12-months-earlier value is found by calendar (RANGE frame on a month
    index), so a gap in the history never pairs the wrong months. The percentile
    holds one series' residuals (at most one per month) in memory."""
    part = [*by, *keys]
    w = Window.partitionBy(*part).orderBy(month_index(S.MONTH)).rangeBetween(-12, -12)
    r = panel.withColumn("_r", F.col(qty) - F.first(qty).over(w))
    agg = r.groupBy(*part).agg(
        F.count("_r").alias("n_residuals"),
        F.percentile(F.col("_r"), F.array(*[F.lit(q) for q in quantiles])).alias("_pq"))
    return agg.select(*part, "n_residuals", *[F.col("_pq")[i].alias(c) for i, c in enumerate(PARAM_COLS)])


def history_map(panel: DataFrame, keys=S.SERIES_KEY, qty: str = S.QTY, by: tuple[str, ...] = ()) -> DataFrame:
    """Per series: last month and a month -> quantity map (at most one entry per month)."""
    return panel.groupBy(*by, *keys).agg(
        F.max(S.MONTH).alias("_last"),
        F.map_from_entries(F.collect_list(F.struct(F.col(S.MONTH), F.col(qty)))).alias("_hist"))


def seasonal_forecast(panel: DataFrame, params: DataFrame, horizon: int = 18, keys=S.SERIES_KEY,
                      qty: str = S.QTY, by: tuple[str, ...] = ()) -> DataFrame:
    """``horizon`` months after each series' last month, five integer quantiles.
    Series without parameters are left out (the caller routes them elsewhere)."""
    part = [*by, *keys]
    ok = params.where(F.col("n_residuals") > 0).select(*part, *PARAM_COLS)
    x = history_map(panel, keys, qty, by).join(ok, part)
    x = x.select(*part, "_last", "_hist", *PARAM_COLS, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_h"))
    back = (F.floor((F.col("_h") - 1) / 12) + 1) * 12
    base = F.element_at(F.col("_hist"), F.add_months(F.col("_last"), F.col("_h") - back))
    return x.select(*part, F.add_months(F.col("_last"), F.col("_h")).alias(S.MONTH),
                    *[clamp_round_long(base + F.col(pc)).alias(qc) for pc, qc in zip(PARAM_COLS, S.Q_COLS)])


# --- T10: month-versioned parameters -------------------------------------------------

def version_label(asof) -> str:
    return "v" + str(asof)[:7].replace("-", "")


def _version(version: str, product_class: str):
    return (F.col("model_version") == F.lit(version)) & (F.col("model_class") == F.lit(product_class))


def model_exists(spark: SparkSession, base: str, version: str, product_class: str = "all") -> bool:
    """Guard: stored parameters of this class and version."""
    from sackcast.sources.tables import has_rows
    return has_rows(spark, base, _version(version, product_class))


ALIAS_SCHEMA = "model_class string, model_version string, step int"


def _promotions(spark: SparkSession, base: str, product_class: str) -> DataFrame:
    from sackcast.sources.tables import path_exists
    path = f"{base}_aliases/{product_class}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], ALIAS_SCHEMA)
    return spark.read.schema(ALIAS_SCHEMA).parquet(path)


def current_version(spark: SparkSession, base: str, product_class: str = "all") -> tuple[str | None, int]:
    """(version, step) that the alias ``latest`` of a class stands for: the last promotion,
    (None, 0) before the first one."""
    last = _promotions(spark, base, product_class).orderBy(F.col("step").desc()).first()
    return (last["model_version"], last["step"]) if last else (None, 0)


def promote(spark: SparkSession, base: str, version: str, product_class: str = "all", after: int | None = None) -> bool:
    """Let ``latest`` stand for ``version`` from now on; an older version rolls back. Each
    promotion is a step of its own, kept as history. ``after``: the step that the caller
    has seen (default: the present one); False where another promotion came first, or
    where the version isn't stored."""
    if not model_exists(spark, base, version, product_class):
        return False
    step = (current_version(spark, base, product_class)[1] if after is None else after) + 1
    row = spark.createDataFrame([(product_class, version, step)], ALIAS_SCHEMA).coalesce(1)
    try:   # a step's folder is made once
        row.write.mode("error").parquet(f"{base}_aliases/{product_class}/taken={step}")
    except AnalysisException:
        return False
    return True


def load_params(spark: SparkSession, base: str, version: str | None = None, product_class: str = "all",
                schema=None) -> DataFrame:
    """Read one version of a class (partition-pruned); ``None`` -> the promoted one, or the
    latest where none was promoted."""
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(base)
    df = df.where(F.col("model_class") == F.lit(product_class))
    version = version or current_version(spark, base, product_class)[0]
    if version is None:
        return df.where(F.col("model_version") == df.agg(F.max("model_version")).scalar())
    return df.where(F.col("model_version") == F.lit(version))


def fit_or_load(spark: SparkSession, panel: DataFrame, base: str, asof, quantiles,
                keys=S.SERIES_KEY, product_class: str = "all") -> DataFrame:
    """Parameters of this class and month: stored ones if there are any, else
    fitted and appended as a new (``model_class``, ``model_version``) partition, promoted
    and read back. Series that have no stored parameters (they appeared later) are fitted
    here, and only they: the panel loses the stored keys before the fit. Version labels
    (vYYYYMM) sort by time."""
    v = version_label(asof)
    label = {"model_class": F.lit(product_class), "model_version": F.lit(v)}
    fields = [f for f in fit_seasonal_quantiles(panel, quantiles, keys).withColumns(label).schema.fields]
    schema = T.StructType(fields)
    new = not model_exists(spark, base, v, product_class)
    if new:
        (fit_seasonal_quantiles(panel, quantiles, keys).withColumns(label)
         .write.mode("append").partitionBy("model_class", "model_version").parquet(base))
        promote(spark, base, v, product_class)
    stored = load_params(spark, base, v, product_class, schema).drop("model_class", "model_version")
    if new:
        return stored
    late = fit_seasonal_quantiles(panel.join(stored.select(*keys), list(keys), "left_anti"), quantiles, keys)
    return stored.unionByName(late)


# --- hook ------------------------------------------------------------------------------

def forecast_with(panel: DataFrame, fn: Callable, schema, keys=S.SERIES_KEY) -> DataFrame:
    """Run a user's own model: ``fn(pandas_df) -> pandas_df`` once per series
    (Arrow batches; one series is at most one row per month)."""
    return panel.groupBy(*keys).applyInPandas(fn, schema=schema)


# --- T18: rolling-origin backtest ------------------------------------------------------

def backtest(panel: DataFrame, cutoffs: list, horizon: int = 18, quantiles=(0.05, 0.25, 0.5, 0.75, 0.95),
             keys=S.SERIES_KEY, qty: str = S.QTY, group_cols: tuple[str, ...] = ()) -> DataFrame:
    """For every cutoff month c: fit on months <= c, forecast c+1..c+horizon,
    compare q50 with the actuals. All cutoffs in one job: each panel row is given
    the cutoffs it is history for (``cutoff`` becomes a run key). Output: MAE of
    q50 per cutoff, horizon step and ``group_cols`` (e.g. a segment column)."""
    cuts = F.array(*[F.lit(str(c)[:10]).cast("date") for c in cutoffs])
    hist = panel.select("*", F.explode(F.filter(cuts, lambda c: F.col(S.MONTH) <= c)).alias("cutoff"))
    by = ("cutoff",)
    params = fit_seasonal_quantiles(hist, quantiles, keys, qty, by)
    fc = seasonal_forecast(hist, params, horizon, keys, qty, by)
    fc = fc.withColumn("step", F.months_between(F.col(S.MONTH), F.col("cutoff")).cast("int"))
    act = panel.select(*keys, *group_cols, S.MONTH, F.col(qty).alias("_actual"))
    j = fc.join(act, [*keys, S.MONTH])
    return (j.groupBy("cutoff", "step", *group_cols)
             .agg(F.count(F.lit(1)).alias("n"),
                  F.avg(F.abs(F.col("_actual") - F.col("q50"))).alias("mae")))


def eligible_forecast(eligible: DataFrame, p, params: DataFrame | None = None, keys=S.PRODUCT_KEY,
                      qty: str = S.QTY, by: tuple[str, ...] = (), top_source: DataFrame | None = None,
                      series_flags: DataFrame | None = None) -> DataFrame:
    """T9 + T11 + A11 fused for the eligible rows: one window (12-month residual)
    and one aggregation per series on the same partitioning give the parameters
    (unless ``params`` are given, e.g. a stored version), the month map, the last
    values and the recent-sales flag. A series without any residual falls back to
    the recursive moving average from its last month. Output: ``keys, month,
    q05..q95, model_type, has_sales``. ``top_source`` and ``series_flags`` as in
    ``not_eligible_forecast``."""
    from sackcast.functions import with_last_month
    from sackcast.operators.forecast import _ma_steps, join_series_flags

    part = [*by, *keys]
    m = with_last_month(eligible, eligible if top_source is None else top_source, "_top", by)
    lo = F.add_months(F.col("_top"), -(p.sales_window - 1))
    w = Window.partitionBy(*part).orderBy(month_index(S.MONTH)).rangeBetween(-12, -12)
    r = m.withColumn("_r", F.col(qty) - F.first(qty).over(w))
    aggs = [
        F.max(S.MONTH).alias("_last"),
        F.coalesce(F.bool_or((F.col(S.MONTH) > lo) & (F.col(qty) > 0)), F.lit(False)).alias("has_sales"),
        F.array_sort(F.collect_list(F.struct(F.col(S.MONTH).alias("m"), F.col(qty).alias("v")))).alias("_rows"),
    ]
    if params is None:
        aggs += [F.count("_r").alias("n_residuals"),
                 F.percentile(F.col("_r"), F.array(*[F.lit(q) for q in p.quantiles])).alias("_pq")]
    per = r.groupBy(*part).agg(*aggs)
    if params is None:
        per = per.select("*", *[F.col("_pq")[i].alias(c) for i, c in enumerate(PARAM_COLS)]).drop("_pq")
    else:
        per = per.join(params.select(*part, "n_residuals", *PARAM_COLS), part, "left")
    per, flag_cols = join_series_flags(per, series_flags, part)
    has_model = F.coalesce(F.col("n_residuals") > 0, F.lit(False))
    hist = F.map_from_entries(F.transform(F.col("_rows"), lambda e: F.struct(e["m"], e["v"])))
    vals = F.transform(F.col("_rows"), lambda e: e["v"])
    win = F.slice(vals, F.greatest(F.lit(1), F.size(vals) - (p.sales_window - 1)), p.sales_window)
    x = per.select(*part, "_last", "has_sales", *flag_cols, *PARAM_COLS, has_model.alias("_model"),
                   hist.alias("_hist"), F.when(~has_model, _ma_steps(win, p.horizon)).alias("_ma"),
                   F.explode(F.sequence(F.lit(1), F.lit(p.horizon))).alias("_h"))
    back = (F.floor((F.col("_h") - 1) / 12) + 1) * 12
    base = F.element_at(F.col("_hist"), F.add_months(F.col("_last"), F.col("_h") - back))
    ma = F.element_at(F.col("_ma"), F.col("_h"))
    qs = [F.when(F.col("_model"), clamp_round_long(base + F.col(pc))).otherwise(ma).alias(qc)
          for pc, qc in zip(PARAM_COLS, S.Q_COLS)]
    return x.select(*part, F.add_months(F.col("_last"), F.col("_h")).alias(S.MONTH), *qs,
                    F.when(F.col("_model"), p.label_model).otherwise(p.label_moving_average).alias("model_type"),
                    "has_sales", *flag_cols)
