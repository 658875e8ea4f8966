"""T9/T11 with the features of T3-T5: one linear quantile regression over all series.

Every series, origin month and step is a row of the design: what the history up to
the origin says about the target month (same month of the last two years, last value,
means of 3, 6 and 12 months, share of months with sales), the calendar, the step and
the segments. Quantities are divided by the series' own level, so one set of
coefficients per quantile level serves series of any size, new ones included.

Fit: the pinball loss by majorisation, a weighted least-squares problem per level and
round. Executors sum its normal equations in whole numbers (fixed point), so the
result depends neither on the partitioning nor on the order of rows; only these sums
(levels x features squared) come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import clamp_round_long, month_index

LEVEL_MONTHS = 24      # months whose mean is a series' level
MOST = 32.0            # features of quantity are held within this many levels
HISTORY_FEATURES = ("season", "season_before", "last", "mean3", "mean6", "mean12")
SEGMENT_FEATURES = (("abc", "A"), ("abc", "B"), ("xyz", "X"), ("xyz", "Y"), ("fsn", "F"))
FEATURES = ("one", *HISTORY_FEATURES, "active", "month_sin", "month_cos", "step_share",
            *(f"is_{v.lower()}" for _, v in SEGMENT_FEATURES))

# fixed point of the fit: features and targets in 1/1024, weights in 1/256, rows of one exact sum (under 2**62)
UNIT, WEIGHT_UNIT, BLOCK = 1024, 256, 1 << 15
# rounds, and the residual that counts as none: it shrinks from the first of these to the second
ROUNDS, LOOSE, TIGHT, SHRINK = 30, 0.5, 0.002, 0.75
RIDGE, SETTLED = 1e-3, 1e-3


@dataclass(frozen=True)
class QuantileModel:
    """Coefficients of ``FEATURES`` by quantile level."""

    levels: tuple[float, ...]
    coefficients: tuple[tuple[float, ...], ...]

    def frame(self, spark) -> DataFrame:
        """(level, feature, coefficient): the form in which a model is stored."""
        return spark.createDataFrame([(q, f, float(c)) for q, row in zip(self.levels, self.coefficients) for f, c in zip(FEATURES, row)],
                                     "level double, feature string, coefficient double")

    @staticmethod
    def load(frame: DataFrame) -> "QuantileModel":
        rows = {(r["level"], r["feature"]): r["coefficient"] for r in frame.collect()}   # levels x features numbers
        levels = tuple(sorted({q for q, _ in rows}))
        return QuantileModel(levels, tuple(tuple(rows[q, f] for f in FEATURES) for q in levels))


def series_history(panel: DataFrame, keys=S.PRODUCT_KEY, qty: str = S.QTY, by: tuple[str, ...] = (),
                   names: dict[str, str] | None = None) -> DataFrame:
    """One row per series: ``_v`` its quantities in month order (at most one per calendar
    month), ``_first`` and ``_last`` month, segment classes ``_abc _xyz _fsn``."""
    seg = [F.first(names[k], ignorenulls=True).alias(f"_{k}") if names else F.lit(None).cast("string").alias(f"_{k}")
           for k in ("abc", "xyz", "fsn")]
    per = panel.groupBy(*by, *keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(S.MONTH).alias("m"), F.col(qty).alias("v")))).alias("_rows"), *seg)
    return per.select(*by, *keys, F.transform("_rows", lambda r: r["v"]).alias("_v"), F.element_at("_rows", 1)["m"].alias("_first"),
                      F.element_at("_rows", -1)["m"].alias("_last"), "_abc", "_xyz", "_fsn")


def _tail_mean(months: int) -> Column:
    tail = F.slice("_v", F.greatest(F.lit(1), F.col("_n") - (months - 1)), F.least(F.lit(months), F.col("_n")))
    return F.aggregate(tail, F.lit(0.0), lambda s, x: s + x) / F.size(tail)


def season_back(step: Column) -> Column:
    """Months from the target to the same calendar month of the last year before the forecast."""
    return ((F.floor((step - 1) / 12) + 1) * 12).cast("int")


def design_rows(history: DataFrame, horizon: int, keys=S.PRODUCT_KEY, by: tuple[str, ...] = (), origins: Column | None = None) -> DataFrame:
    """One row per series, origin month and step 1..``horizon``: ``origin step month level FEATURES target``.

    ``origins``: array column of months (default: each series' last one); those outside
    the series' history are left out. ``target`` is NULL for months after the history.
    The history must be gap-free (as T1 makes it). No shuffle: everything comes from
    the series' own row."""
    part = [*by, *keys]
    at = F.array(F.col("_last")) if origins is None else origins
    x = history.select("*", F.explode(at).alias("origin")).where((F.col("origin") >= F.col("_first")) & (F.col("origin") <= F.col("_last")))
    x = x.withColumn("_n", (month_index("origin") - month_index("_first") + 1).cast("int"))
    tail = F.slice("_v", F.greatest(F.lit(1), F.col("_n") - 11), F.least(F.lit(12), F.col("_n")))
    level = _tail_mean(LEVEL_MONTHS)
    x = x.withColumns({"level": F.when(level > 0, level).otherwise(F.lit(1.0)), "_m3": _tail_mean(3), "_m6": _tail_mean(6), "_m12": _tail_mean(12),
                       "active": F.size(F.filter(tail, lambda v: v > 0)) / F.size(tail)})
    x = x.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    place = F.col("_n") + F.col("step") - 1 - season_back(F.col("step"))   # from 0
    season = F.coalesce(F.get("_v", place), F.col("_m12"))
    x = x.withColumn("_season", season).withColumn("_season_before", F.coalesce(F.get("_v", place - 12), F.col("_season")))
    held = {"season": F.col("_season"), "season_before": F.col("_season_before"), "last": F.get("_v", F.col("_n") - 1),
            "mean3": F.col("_m3"), "mean6": F.col("_m6"), "mean12": F.col("_m12")}
    month = F.add_months(F.col("origin"), F.col("step"))
    turn = 2 * np.pi * F.month(month) / 12
    features = {f: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), held[f] / F.col("level"))) for f in HISTORY_FEATURES}
    features |= {"one": F.lit(1.0), "active": F.col("active"), "month_sin": F.sin(turn), "month_cos": F.cos(turn), "step_share": F.col("step") / horizon}
    features |= {f"is_{v.lower()}": F.coalesce((F.col(f"_{k}") == v).cast("double"), F.lit(0.0)) for k, v in SEGMENT_FEATURES}
    return x.select(*part, "origin", "step", month.alias(S.MONTH), "level", "_v", "_n", *(features[f].alias(f) for f in FEATURES),
                    F.get("_v", F.col("_n") + F.col("step") - 1).alias("target"))


def _normal_equations(rows: DataFrame, coefficients: np.ndarray, levels, epsilon: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums over all rows of w x x', w x y and x for every level, exact in fixed point."""
    d = len(FEATURES)

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                cells = [part.column(f).to_numpy(zero_copy_only=False) for f in FEATURES]
                y = part.column("y").to_numpy(zero_copy_only=False)
                x = np.stack([np.rint(c * UNIT) for c in cells], axis=1).astype(np.int64)
                whole = np.rint(y * UNIT).astype(np.int64)
                found = []
                for k in range(len(levels)):
                    rest = whole / UNIT
                    for j in range(d):     # in this order for every row, whatever the batch
                        rest = rest - x[:, j] / UNIT * coefficients[k, j]
                    w = np.rint(WEIGHT_UNIT / (epsilon + np.abs(rest))).astype(np.int64)
                    xw = x * w[:, None]
                    found.append(np.concatenate([(x.T @ xw).ravel(), xw.T @ whole, x.sum(axis=0)]))
                sums = np.concatenate([*found, [part.num_rows]])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], ["cell", "value"])
    cells = rows.mapInArrow(run, "cell long, value long").groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    size = d * d + 2 * d
    total = [0] * (size * len(levels) + 1)
    for r in cells.collect():   # levels x (features squared + 2 features) numbers, whatever the input
        total[r["cell"]] = int(r["value"])
    at = np.array([[float(v) for v in total[k * size:(k + 1) * size]] for k in range(len(levels))])
    gram = at[:, :d * d].reshape(-1, d, d) / (UNIT * UNIT * WEIGHT_UNIT)
    moment = at[:, d * d:d * d + d] / (UNIT * UNIT * WEIGHT_UNIT)
    return gram, np.stack([moment, at[:, d * d + d:] / UNIT], axis=1), total[-1]


def fit_quantile_model(panel: DataFrame, levels=(0.05, 0.25, 0.5, 0.75, 0.95), horizon: int = 18, keys=S.PRODUCT_KEY, qty: str = S.QTY,
                       names: dict[str, str] | None = None) -> QuantileModel:
    """Coefficients from every series, each of the ``horizon`` months before its last one being an origin,
    and every step whose target is known. A panel without any such row gives the model that repeats ``mean12``.

    The rows of the design are persisted (lost blocks are recomputed) and read once a round."""
    d = len(FEATURES)
    back = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda k: F.add_months(F.col("_last"), -k))
    rows = design_rows(series_history(panel, keys, qty, (), names), horizon, keys, (), back).where(F.col("target").isNotNull())
    y = F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.col("target") / F.col("level")))
    rows = rows.select(*FEATURES, y.alias("y")).persist(StorageLevel.MEMORY_AND_DISK)
    found = np.zeros((len(levels), d))
    found[:, FEATURES.index("mean12")] = 1.0
    try:
        for k in range(ROUNDS):
            epsilon = max(TIGHT, LOOSE * SHRINK ** k)
            gram, moments, n = _normal_equations(rows, found, levels, epsilon)
            if not n:
                break
            new = np.stack([np.linalg.solve(gram[j] + RIDGE * n * np.eye(d), moments[j, 0] + (2 * q - 1) * moments[j, 1])
                            for j, q in enumerate(levels)])
            moved = np.abs(new - found).max()
            found = new
            if moved < SETTLED and epsilon == TIGHT:
                break
    finally:
        rows.unpersist()
    return QuantileModel(tuple(levels), tuple(tuple(np.round(row, 6).tolist()) for row in found))


def predicted(model: QuantileModel, k: int) -> Column:
    """The level's value on a row of the design, in units of quantity."""
    total = None
    for f, c in zip(FEATURES, model.coefficients[k]):
        term = F.col(f) * F.lit(float(c))
        total = term if total is None else total + term
    return F.bround(total * F.col("level"), 6)


def quantile_columns(model: QuantileModel) -> dict[str, Column]:
    """The integer quantiles of a design row; levels that cross are put in order."""
    ordered = F.array_sort(F.array(*(predicted(model, k) for k in range(len(model.levels)))))
    return {c: clamp_round_long(ordered[k]) for k, c in enumerate(S.Q_COLS)}


def regression_forecast(panel: DataFrame, model: QuantileModel, horizon: int = 18, keys=S.PRODUCT_KEY, qty: str = S.QTY,
                        by: tuple[str, ...] = (), names: dict[str, str] | None = None) -> DataFrame:
    """``horizon`` months after each series' last one, five integer quantiles; all series in one pass, none left out."""
    x = design_rows(series_history(panel, keys, qty, by, names), horizon, keys, by)
    return x.select(*by, *keys, S.MONTH, *(v.alias(c) for c, v in quantile_columns(model).items()))


def fit_or_load_regression(panel: DataFrame, asof, p, base: str | None = None, keys=S.PRODUCT_KEY) -> QuantileModel:
    """T10 for the regression: the coefficients stored for the run's class and month under ``base``, else fitted on
    ``panel`` (and stored, if there is a ``base``)."""
    from sackcast.operators.seasonal import model_exists, version_label

    spark, version = panel.sparkSession, version_label(asof)
    label = {"model_class": F.lit(p.product_class), "model_version": F.lit(version)}
    if base is not None and model_exists(spark, base, version, p.product_class):
        stored = spark.read.parquet(base).where((F.col("model_class") == p.product_class) & (F.col("model_version") == version))
        return QuantileModel.load(stored)
    model = fit_quantile_model(panel, p.quantiles, p.horizon, keys, names=S.segment_names(p.segment_window, p.segment_prefix))
    if base is not None:
        model.frame(spark).withColumns(label).coalesce(1).write.mode("append").partitionBy("model_class", "model_version").parquet(base)
    return model
