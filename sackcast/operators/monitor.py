"""Monitoring: S12 pick the stored forecast that has just completed its horizon,
T15 errors against the actuals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.sources.demand import asof_months


def monitorable_forecast(stored: DataFrame, asof, product_class: str, lookback: int = 24) -> DataFrame:
    """Rows of the stored forecast (one class) whose ``period`` is the one
    whose last month equals the month before ``asof``; months older than
    prev - ``lookback`` are ignored when finding it. Several such periods -> the
    greatest (the reference's LIMIT 1 had no order). None -> empty. Forecasts of any
    horizon are found; a stored table finds the period in its manifest instead
    (``sources.commits.MonthTable.completed``)."""
    prev = asof_months(asof)["prev"]
    mm = F.trunc(F.to_date(F.col(S.DATE)), "MM")
    cls = stored.where(F.col(S.CLASS) == product_class)
    periods = (cls.where(mm >= F.add_months(F.lit(prev), -lookback))
                  .groupBy("period").agg(F.max(mm).alias("_last"))
                  .where(F.col("_last") == F.lit(prev)))
    chosen = periods.agg(F.max("period")).scalar()
    return cls.where(F.col("period") == chosen)


def monitor_errors(forecast: DataFrame, actuals: DataFrame, keys=S.PRODUCT_KEY,
                   qty: str = S.QTY, by: tuple[str, ...] = ()) -> DataFrame:
    """Forecast LEFT JOIN actuals on key + month; err_q = q - actual. A key absent
    from the actuals gets NULL quantity and errors. If either side is empty the
    result is empty (not rows of NULLs): the forecast is filtered by a one-row
    'actuals exist' scalar, still lazy."""
    k = [*by, *keys]
    act = actuals.select(*k, F.col(S.MONTH).alias(S.DATE), F.col(qty).alias(S.QTY))
    if by:
        present = actuals.select(*by).distinct()
        fc = forecast.join(present, list(by), "left_semi")
    else:
        fc = forecast.where(actuals.select(F.count(F.lit(1)) > 0).scalar())
    j = fc.drop(S.QTY).join(act, [*k, S.DATE], "left")
    errs = {e: F.col(q) - F.col(S.QTY) for q, e in zip(S.Q_COLS, S.ERR_COLS)}
    j = j.withColumns(errs)
    return j.select(*by, *S.PRODUCT_KEY, S.DATE, S.QTY, *S.Q_COLS, *S.ERR_COLS, "model_type", *S.FLAG_COLS)
