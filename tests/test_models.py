"""Quantile regression (T9/T11), model choice by validation (T18), user models in the monthly run."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import caches_released, keep
from sackcast.operators import model_paths as MP
from sackcast.operators import quantile_model as QM
from sackcast.operators.seasonal import backtest
from sackcast.operators.selection import CANDIDATES, selected_forecast, validate_models
from sackcast.params import DEFAULT as P
from sackcast.plans.backfill import backfill_forecast
from sackcast.plans.monthly import forecast_month, prepared_panel, split_run
from sackcast.sources.fixtures import demand_from_tables, known_from_demand

from conftest import SF001, SF01
from helpers import key, panel_rows

ASOF = "2001-08-15"
KEYS = list(S.PRODUCT_KEY)
NAMES = S.segment_names(P.segment_window, P.segment_prefix)
CUTOFFS = [f"2000-{m:02d}-01" for m in range(1, 13)]


@pytest.fixture(scope="module")
def eligible(spark):
    d = demand_from_tables(spark, SF01)
    fr = split_run(prepared_panel(d, ASOF, P, keep_last=True), known_from_demand(d), P)
    return fr.eligible.drop("_last_month").persist()


def series(spark, values, first=(1999, 1), material="M1"):
    months = [(first[0] + (first[1] - 1 + i) // 12, (first[1] - 1 + i) % 12 + 1) for i in range(len(values))]
    return panel_rows(spark, [(key(material), f"{y}-{m:02d}", v) for (y, m), v in zip(months, values)])


def test_design_row_of_one_series(spark):
    values = list(range(1, 31))      # 1999-01 .. 2001-06
    rows = {r.step: r for r in QM.design_rows(QM.series_history(series(spark, values), KEYS), 18, KEYS).collect()}
    assert len(rows) == 18
    level = np.mean(values[-24:])
    one = rows[1]                    # 2001-07: a year before is 2000-07, value 19; two years before 1999-07, value 7
    assert one.month == dt.date(2001, 7, 1) and one.level == level and one.target is None
    assert np.allclose([one.season, one.season_before, one.last, one.mean3, one.mean6, one.mean12, one.active],
                       [19 / level, 7 / level, 30 / level, 29 / level, 27.5 / level, 24.5 / level, 1.0])
    assert np.isclose(rows[13].season, 19 / level)     # the 13th month looks two years back: 2000-07 again
    past = QM.design_rows(QM.series_history(series(spark, values), KEYS), 2, KEYS, (), F.array(F.lit("1999-03-01").cast("date")))
    assert [(r.step, r.target, r.mean12, r.season) for r in past.orderBy("step").collect()] == [(1, 4.0, 1.0, 1.0), (2, 5.0, 1.0, 1.0)]


def pinball(rest, q):
    return np.mean(np.maximum(q * rest, (q - 1) * rest))


def test_fit_is_near_the_least_pinball_loss_and_repeatable(spark, eligible):
    model = QM.fit_quantile_model(eligible, (0.25, 0.5, 0.9), P.horizon, KEYS, names=NAMES)
    again = QM.fit_quantile_model(eligible.repartition(13, "material"), (0.25, 0.5, 0.9), P.horizon, KEYS, names=NAMES)
    assert model == again            # neither partitions nor the order of rows matter
    back = F.transform(F.sequence(F.lit(1), F.lit(P.horizon)), lambda k: F.add_months(F.col("_last"), -k))
    rows = QM.design_rows(QM.series_history(eligible, KEYS, names=NAMES), P.horizon, KEYS, (), back).where("target is not null")
    frame = rows.select(*QM.FEATURES, (F.col("target") / F.col("level")).alias("y")).toPandas()
    x, y = frame[list(QM.FEATURES)].to_numpy(), frame["y"].to_numpy()
    rng = np.random.default_rng(2)
    for q, c in zip(model.levels, model.coefficients):
        best = pinball(y - x @ np.array(c), q)
        assert best < 1.005 * pinball(y - np.quantile(y, q), q)             # not worse than the best constant
        for _ in range(40):                                                 # and than what stands around it
            other = np.array(c) + rng.normal(0, 0.05, len(c))
            assert best < pinball(y - x @ other, q) + 2e-3


def test_stored_and_empty_models(spark, eligible):
    model = QM.QuantileModel((0.1, 0.5), (tuple(np.arange(16) / 8), tuple(np.arange(16) / 4)))
    assert QM.QuantileModel.load(model.frame(spark)) == model
    none = QM.fit_quantile_model(eligible.limit(0), (0.5,), 3, KEYS, names=NAMES)
    assert dict(zip(QM.FEATURES, none.coefficients[0]))["mean12"] == 1.0
    assert QM.regression_forecast(eligible.limit(0), model, 3, KEYS, names=NAMES).count() == 0


def test_validation_error_is_below_the_seasonal_models(spark, eligible):
    """Fitted on months up to the first cutoff only, compared on the 12 windows after it."""
    model = QM.fit_quantile_model(eligible.where(F.col(S.MONTH) <= CUTOFFS[0]), P.quantiles, P.horizon, KEYS, names=NAMES)
    found = validate_models(eligible, CUTOFFS, model, P.horizon, KEYS, names=NAMES).toPandas()
    assert len(found) == 470 and (found["n_points"] == 150).all()
    assert found["mae_regression"].mean() < 0.9 * found["mae_seasonal"].mean()
    best = found[[f"mae_{c}" for c in CANDIDATES]].min(axis=1)
    assert (best == [r[f"mae_{r['chosen']}"] for _, r in found.iterrows()]).all()
    # the same errors of the seasonal model as the backtest of one candidate alone
    alone = backtest(eligible.select(*KEYS, S.MONTH, S.QTY), CUTOFFS, P.horizon, P.quantiles, KEYS).toPandas()
    assert np.isclose((alone["mae"] * alone["n"]).sum() / alone["n"].sum(), found["mae_seasonal"].mean())


def test_choice_on_made_series(spark):
    steady = series(spark, [10.0] * 36, material="M1")
    yearly = series(spark, [float(100 * (m % 12)) for m in range(36)], material="M2")
    short = series(spark, [5.0], (2001, 12), material="M3")
    panel = steady.unionByName(yearly).unionByName(short)
    zero = QM.QuantileModel((0.05, 0.25, 0.5, 0.75, 0.95), ((0.0,) * 16,) * 5)
    found = {r.material: r for r in validate_models(panel, ["2001-01-01", "2001-04-01"], zero, 6, KEYS).collect()}
    assert found["M2"].chosen == "seasonal" and found["M2"].mae_seasonal == 0
    assert found["M1"].mae_level == found["M1"].mae_last_year == 0 and found["M1"].chosen == "seasonal"   # equal: the first one
    assert found["M3"].n_points == 0 and found["M3"].chosen == "regression"
    out = selected_forecast(panel, validate_models(panel, ["2001-01-01"], zero, 6, KEYS), zero, 6, KEYS)
    rows = {(r.material, r.month.month): r for r in out.collect()}
    assert len(rows) == 18 and rows["M2", 3].q50 == 200 and rows["M2", 3].model == "seasonal"


def test_pooling_restores_the_order():
    cells = np.array([[3.0, 1.0, 2.0, 5.0, 4.0], [1, 2, 3, 4, 5], [5, 4, 3, 2, 1]])
    out = MP.non_decreasing(cells)
    assert np.allclose(out, [[2, 2, 2, 4.5, 4.5], [1, 2, 3, 4, 5], [3, 3, 3, 3, 3]])


def user_models():
    """Functions of no module, so that workers need not import this file."""
    def _failing(history, future):
        raise ValueError("no")

    def _partial(history, future):
        return future[["month"]].head(3).assign(q05=1.0, q25=1.0, q50=1.0, q75=1.0, q95=1.0)

    def _constant(history, future):
        if history["warehouse"].iloc[0] == "C001":
            return future[["month"]].assign(q05=np.nan, q25=1.0, q50=1.0, q75=1.0, q95=1.0)
        return future[["month"]].assign(q05=9.0, q25=7.0, q50=11.5, q75=12.5, q95=20.0)
    return _failing, _partial, _constant


def test_user_models_in_the_monthly_run_and_backfill(spark):
    d = demand_from_tables(spark, SF001)
    kn = known_from_demand(d)
    plain = forecast_month(d, kn, ASOF, P)
    models = user_models()
    out = forecast_month(d, kn, ASOF, P, model=models)
    assert out.dtypes == plain.dtypes and out.count() == plain.count()
    el = out.where("is_eligible")
    assert {r[0] for r in el.select("model_type").distinct().collect()} <= {P.label_user, P.label_moving_average}
    served = el.where(F.col("model_type") == P.label_user)
    assert {tuple(r) for r in served.select(*S.Q_COLS).distinct().collect()} == {(8, 8, 12, 12, 20)}
    assert el.where("warehouse = 'C001'").where(F.col("model_type") == P.label_user).count() == 0
    same = [c for c in plain.columns if c not in ("loaded_at", "deleted_at")]
    rest = plain.where("not is_eligible").select(same)
    assert rest.exceptAll(out.where("not is_eligible").select(same)).count() == 0
    both = backfill_forecast(d, kn, ["2000-02-15", ASOF], P, model=models[2])
    last = both.where(F.col("asof") == ASOF).select(same)
    assert last.exceptAll(forecast_month(d, kn, ASOF, P, model=models[2]).select(same)).count() == 0


def test_regression_month_is_fitted_once(spark, tmp_path, monkeypatch):
    d = demand_from_tables(spark, SF001)
    kn = known_from_demand(d)
    base = f"{tmp_path}/coefficients"
    monkeypatch.setattr(QM, "ROUNDS", 3)
    first = forecast_month(d, kn, ASOF, P, model="regression", model_path=base)
    rows = sorted(map(tuple, first.where("is_eligible").select(*KEYS, "date", *S.Q_COLS, "model_type").collect()))
    assert len(rows) == 99 * 18 and {r[-1] for r in rows} == {P.label_regression}
    monkeypatch.setattr(QM, "fit_quantile_model", None)        # stored: nothing is fitted
    again = forecast_month(d, kn, ASOF, P, model="regression", model_path=base)
    assert rows == sorted(map(tuple, again.where("is_eligible").select(*KEYS, "date", *S.Q_COLS, "model_type").collect()))
    with pytest.raises(ValueError):
        forecast_month(d, kn, ASOF, P, model="other")


def test_caches_of_a_run_are_released(spark):
    with caches_released():
        a = keep(spark.range(10))
        assert a.count() == 10 and a.storageLevel.useMemory
    assert not a.storageLevel.useMemory
