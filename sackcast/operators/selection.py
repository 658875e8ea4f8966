"""T18 inside T9: each series' model by rolling validation.

Four candidates forecast from every origin month in one pass over the series' rows:
the quantile regression, the seasonal quantile model (same month of the last year plus
the median 12-month residual), that month itself, and the mean of the last 12 months.
The one with the least mean absolute error over all windows is the series' model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import clamp_round_long
from sackcast.operators.quantile_model import QuantileModel, design_rows, predicted, quantile_columns, season_back, series_history

CANDIDATES = ("regression", "seasonal", "last_year", "level")   # in this order where errors are equal


def residual_quantiles(levels) -> Column:
    """Interpolated percentiles of the 12-month differences up to the origin (NULL without any)."""
    rest = F.array_sort(F.transform(F.sequence(F.lit(12), F.col("_n") - 1), lambda i: F.get("_v", i) - F.get("_v", i - 12)))
    rest = F.when(F.col("_n") > 12, rest)
    many = F.size(rest)

    def one(q: float) -> Column:
        place = F.lit(q) * (many - 1)
        low = F.floor(place).cast("int")
        a, b = F.get(rest, low), F.get(rest, F.least(low + 1, many - 1))
        return a + (b - a) * (place - low)
    return F.array(*(one(q) for q in levels))


def _season(step: Column) -> Column:
    return F.get("_v", F.col("_n") + step - 1 - season_back(step))


def candidate_points(model: QuantileModel) -> dict[str, Column]:
    """Every candidate's integer median on a design row that carries ``_rq`` (residual quantiles at 0.5); NULL where it has none."""
    season = _season(F.col("step"))
    return {"regression": clamp_round_long(predicted(model, model.levels.index(0.5))),
            "seasonal": clamp_round_long(season + F.col("_rq")[0]),
            "last_year": clamp_round_long(season),
            "level": clamp_round_long(F.col("mean12") * F.col("level"))}


def validate_models(panel: DataFrame, cutoffs, model: QuantileModel, horizon: int = 18, keys=S.PRODUCT_KEY, qty: str = S.QTY,
                    by: tuple[str, ...] = (), names: dict[str, str] | None = None) -> DataFrame:
    """Per series: ``n_points`` (windows x steps with a known target), ``mae_<candidate>`` and ``chosen``.

    ``cutoffs``: origin months. A candidate without a forecast for some point that
    others have is out; a series without any known target gets ``regression``. One
    aggregation collects the series, a second one on the same keys sums the errors."""
    part = [*by, *keys]
    origins = F.array(*[F.lit(str(c)[:10]).cast("date") for c in cutoffs])
    history = series_history(panel, keys, qty, by, names)
    x = design_rows(history, horizon, keys, by, origins).where(F.col("target").isNotNull())
    x = x.withColumn("_rq", residual_quantiles((0.5,)))
    errors = {c: F.abs(F.col("target") - v) for c, v in candidate_points(model).items()}
    found = x.groupBy(*part).agg(
        F.count(F.lit(1)).alias("n_points"),
        *(F.when(F.count(e) == F.count(F.lit(1)), F.sum(e.cast("decimal(38,6)")).cast("double") / F.count(F.lit(1))).alias(f"mae_{c}") for c, e in errors.items()))
    per = history.select(*part).join(found, part, "left").withColumn("n_points", F.coalesce("n_points", F.lit(0)))
    best = F.least(*(F.col(f"mae_{c}") for c in CANDIDATES))
    chosen = F.coalesce(*(F.when(F.col(f"mae_{c}") == best, F.lit(c)) for c in CANDIDATES), F.lit(CANDIDATES[0]))
    return per.select(*part, "n_points", *(f"mae_{c}" for c in CANDIDATES), chosen.alias("chosen"))


def selected_forecast(panel: DataFrame, chosen: DataFrame, model: QuantileModel, horizon: int = 18, keys=S.PRODUCT_KEY, qty: str = S.QTY,
                      by: tuple[str, ...] = (), names: dict[str, str] | None = None) -> DataFrame:
    """T11 by the series' own model (``chosen``: its column of that name; others get ``regression``): five integer
    quantiles and ``model``. The seasonal model's are residual percentiles, the plain candidates' are all equal. A
    candidate that has no value for a month gives way to the regression there."""
    part = [*by, *keys]
    history = series_history(panel, keys, qty, by, names).join(chosen.select(*part, "chosen"), part, "left")
    x = design_rows(history.withColumn("chosen", F.coalesce("chosen", F.lit(CANDIDATES[0]))), horizon, part)
    x = x.join(history.select(*part, F.coalesce("chosen", F.lit(CANDIDATES[0])).alias("model")), part)
    x = x.withColumn("_rq", residual_quantiles(model.levels))
    season = _season(F.col("step"))
    regression = quantile_columns(model)
    out = {}
    for k, c in enumerate(S.Q_COLS):
        own = (F.when(F.col("model") == "seasonal", clamp_round_long(season + F.col("_rq")[k]))
                .when(F.col("model") == "last_year", clamp_round_long(season))
                .when(F.col("model") == "level", clamp_round_long(F.col("mean12") * F.col("level"))))
        out[c] = F.coalesce(own, regression[c]).alias(c)
    return x.select(*part, S.MONTH, *out.values(), "model")
