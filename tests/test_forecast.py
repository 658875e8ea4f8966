import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import clamp_round_long
from sackcast.operators.features import calendar_features, future_frame, lag_features
from sackcast.operators.forecast import moving_average_forecast, zero_forecast
from sackcast.operators.seasonal import backtest, fit_or_load, fit_seasonal_quantiles, forecast_with, seasonal_forecast

from helpers import key, panel_rows


def _series(spark, values, k=None, start=2024):
    k = k or key()
    rows = [(k, f"{start + i // 12}-{i % 12 + 1:02d}", v) for i, v in enumerate(values)]
    return panel_rows(spark, rows)


@pytest.mark.parametrize("window,expected", [
    ([1, 2, 2, 5], [2, 3, 3, 3, 3, 3]),     # 2.5 -> 2 (half even), later 2.75 -> 3
    ([3], [3, 3, 3, 3, 3, 3]),
    ([-4, -2], [0, 0, 0, 0, 0, 0]),         # clamped value enters the window
])
def test_moving_average_micro(spark, window, expected):
    out = moving_average_forecast(_series(spark, window), horizon=6, window=12, keys=S.PRODUCT_KEY)
    rows = out.orderBy(S.MONTH).collect()
    assert [r.q50 for r in rows] == expected
    assert all(r.q05 == r.q25 == r.q50 == r.q75 == r.q95 for r in rows)
    assert rows[0].month == dt.date(2024, len(window) + 1, 1) if len(window) < 12 else True


def test_moving_average_uses_last_twelve(spark):
    vals = [100] * 6 + [12] * 12
    out = moving_average_forecast(_series(spark, vals), horizon=2, window=12, keys=S.PRODUCT_KEY)
    assert [r.q50 for r in out.orderBy(S.MONTH).collect()] == [12, 12]


def test_zero_forecast(spark):
    out = zero_forecast(_series(spark, [1, 2, 3]), horizon=18, keys=S.PRODUCT_KEY)
    rows = out.collect()
    assert len(rows) == 18 and all(r.q95 == 0 for r in rows)
    assert min(r.month for r in rows) == dt.date(2024, 4, 1)


def test_quantile_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-3.0,), (2.4999999999,)], "x double")
    got = [r.q for r in df.select(clamp_round_long(F.col("x")).alias("q")).collect()]
    assert got == [0, 2, 2, 0, 2]


def test_lags_and_means_filled_per_series(spark):
    a = _series(spark, [5, 7, 9, 11], key("A"))
    b = _series(spark, [100, 102, 104, 106], key("B"))
    out = lag_features(a.unionByName(b), n=3, keys=S.PRODUCT_KEY).orderBy("material", S.MONTH).collect()
    by = {m: [r for r in out if r.material == m] for m in "AB"}
    assert [r.qty_LAG1 for r in by["A"]] == [5, 5, 7, 9]
    assert [r.qty_LAG2 for r in by["A"]] == [5, 5, 5, 7]
    assert [r.qty_MEAN2 for r in by["A"]] == [6, 6, 6, 8]
    assert [r.qty_LAG1 for r in by["B"]] == [100, 100, 102, 104]
    assert [r.qty_LAG2 for r in by["B"]] == [100, 100, 100, 102]
    assert [r.qty_MEAN2 for r in by["B"]] == [101, 101, 101, 103]


def test_calendar_and_future(spark):
    s = _series(spark, [1] * 14)
    cal = calendar_features(s).orderBy(S.MONTH).collect()
    assert cal[0].t_linear == 0 and cal[13].t_linear == 13 and cal[13].t_quadratic == 169
    assert cal[2].quarter == 1 and cal[3].quarter == 2 and cal[6].half == 2
    fut = future_frame(s, 18, S.PRODUCT_KEY).orderBy(S.MONTH).collect()
    assert len(fut) == 18 and fut[0].month == dt.date(2025, 3, 1) and fut[0].t_linear == 14


def test_seasonal_model(spark):
    # y = 10 + 12-month pattern; residuals vs. 12 months earlier are all +1
    vals = [10 + (i % 12) + (i // 12) for i in range(36)]
    s = _series(spark, vals)
    params = fit_seasonal_quantiles(s, keys=S.PRODUCT_KEY).first()
    assert params.n_residuals == 24 and params.p05 == params.p95 == 1.0
    fc = seasonal_forecast(s, fit_seasonal_quantiles(s, keys=S.PRODUCT_KEY), 18, S.PRODUCT_KEY)
    rows = fc.orderBy(S.MONTH).collect()
    assert len(rows) == 18
    # h=1 -> y(last - 11) + 1 = vals[24] + 1 ; h=13 -> the same month again
    assert rows[0].q50 == vals[24] + 1 and rows[12].q50 == vals[24] + 1
    assert all(r.q05 <= r.q25 <= r.q50 <= r.q75 <= r.q95 for r in rows)


def test_short_series_has_no_parameters(spark):
    s = _series(spark, [1, 2, 3])
    assert fit_seasonal_quantiles(s, keys=S.PRODUCT_KEY).first().n_residuals == 0
    assert seasonal_forecast(s, fit_seasonal_quantiles(s, keys=S.PRODUCT_KEY), 18, S.PRODUCT_KEY).count() == 0


def test_versioned_parameters(spark, tmp_path):
    s = _series(spark, [1 + i % 5 for i in range(30)])
    base = str(tmp_path / "params")
    p1 = fit_or_load(spark, s, base, "2025-03-10", (0.05, 0.25, 0.5, 0.75, 0.95), S.PRODUCT_KEY)
    assert p1.count() == 1
    n_files = len(list((tmp_path / "params").rglob("*.parquet")))
    p2 = fit_or_load(spark, s, base, "2025-03-20", (0.05, 0.25, 0.5, 0.75, 0.95), S.PRODUCT_KEY)
    assert p2.count() == 1 and len(list((tmp_path / "params").rglob("*.parquet"))) == n_files
    fit_or_load(spark, s, base, "2025-04-01", (0.05, 0.25, 0.5, 0.75, 0.95), S.PRODUCT_KEY)
    from sackcast.operators.seasonal import load_params
    assert load_params(spark, base).select("model_version").distinct().first()[0] == "v202504"


def test_custom_model_hook(spark):
    s = _series(spark, [2.0] * 12, key("A")).unionByName(_series(spark, [4.0] * 12, key("B")))

    def mean_model(pdf: pd.DataFrame) -> pd.DataFrame:
        last = pdf["month"].max()
        months = pd.date_range(last + pd.offsets.MonthBegin(1), periods=3, freq="MS").date
        return pd.DataFrame({"material": pdf["material"].iloc[0], "month": months, "q50": pdf["qty"].mean()})

    out = forecast_with(s, mean_model, "material string, month date, q50 double", S.PRODUCT_KEY)
    got = sorted((r.material, r.q50) for r in out.collect())
    assert got == [("A", 2.0)] * 3 + [("B", 4.0)] * 3


def test_backtest(spark):
    vals = [10 + (i % 12) for i in range(36)]
    out = backtest(_series(spark, vals), ["2025-06-01"], 6, keys=S.PRODUCT_KEY).orderBy("step").collect()
    assert [r.step for r in out] == [1, 2, 3, 4, 5, 6]
    assert all(r.mae == 0.0 for r in out)   # a pure seasonal series is forecast exactly
