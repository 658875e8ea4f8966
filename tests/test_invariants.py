"""Property checks on the sf0.01 tables."""

import pytest
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.params import DEFAULT as P
from sackcast.plans.backfill import backfill_forecast, backfill_frames, monthly_asof_dates
from sackcast.plans.monthly import forecast_month, forecast_rows, prepared_panel, run_month, split_run
from sackcast.sources.fixtures import demand_from_tables, known_from_demand

from conftest import SF001, SF01

ASOF = "2001-08-15"
K = list(S.PRODUCT_KEY)


@pytest.fixture(scope="module")
def frames(spark):
    d = demand_from_tables(spark, SF01)
    return split_run(prepared_panel(d, ASOF, P), known_from_demand(d), P)


def test_panel_shape(frames):
    pn = frames.panel
    assert pn.groupBy(*K, S.MONTH).count().where("count > 1").count() == 0
    per = pn.groupBy(*K).count()
    assert per.agg(F.min("count")).first()[0] >= 36
    assert per.count() == 990


def test_splits_partition_the_panel(frames):
    n = frames.panel.count()
    assert frames.known_active.count() + frames.unknown.count() == n
    assert frames.eligible.count() + frames.not_eligible.count() == n
    assert frames.segments.count() == 990


def test_forecast_invariants(frames):
    fc = forecast_rows(frames, P)
    per = fc.groupBy(*K).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("model_type").alias("t"))
    assert per.count() == 990
    assert per.where("n != 18 or t != 1").count() == 0
    bad = fc.where("not (q05 >= 0 and q05 <= q25 and q25 <= q50 and q50 <= q75 and q75 <= q95)")
    assert bad.count() == 0
    assert fc.count() == 17820


def test_backfill_equals_single_runs(spark):
    d = demand_from_tables(spark, SF001)
    kn = known_from_demand(d)
    dates = ["2000-02-15", ASOF]
    bf = backfill_forecast(d, kn, dates, P).drop("loaded_at", "deleted_at")
    single = None
    for a in dates:
        one = forecast_month(d, kn, a, P).withColumn("asof", F.lit(a).cast("date"))
        single = one if single is None else single.unionByName(one)
    single = single.drop("loaded_at", "deleted_at").select(*bf.columns)
    assert bf.count() == single.count()
    assert bf.exceptAll(single).count() == 0 and single.exceptAll(bf).count() == 0


def test_monthly_dates():
    ds = monthly_asof_dates("2025-12-11", 19)
    assert len(ds) == 19 and str(ds[0]) == "2024-06-11" and str(ds[-1]) == "2025-12-11"


def test_run_month_guards_and_monitoring(spark, tmp_path):
    d = demand_from_tables(spark, SF001)
    kn = known_from_demand(d)
    fpath, mpath = str(tmp_path / "fc"), str(tmp_path / "mon")
    r1 = run_month(d, kn, "2000-02-15", P, fpath, mpath)
    assert r1["forecast_written"] and not r1["monitoring_written"]
    r2 = run_month(d, kn, ASOF, P, fpath, mpath)
    assert r2["forecast_written"] and r2["monitoring_written"]
    r3 = run_month(d, kn, ASOF, P, fpath, mpath)
    assert not r3["forecast_written"] and not r3["monitoring_written"]
    assert r3["forecast"].count() == r2["forecast"].count() > 0
    mon = r3["monitoring"]
    assert mon.count() > 0 and mon.select("period").distinct().first()[0] == 200108
    assert mon.exceptAll(r2["monitoring"]).count() == 0


def test_backfill_monitoring_equals_single_run(spark):
    from sackcast.plans.backfill import backfill_monitoring
    from sackcast.plans.monthly import monitoring_month

    d = demand_from_tables(spark, SF001)
    kn = known_from_demand(d)
    dates = ["2000-02-15", ASOF]
    stored = forecast_month(d, kn, dates[0], P).unionByName(forecast_month(d, kn, ASOF, P))
    one = monitoring_month(stored, d, ASOF, P)
    bf = backfill_monitoring(backfill_forecast(d, kn, dates, P), d, dates, P)
    assert bf.select("asof").distinct().count() == 1          # nothing to monitor at the early date
    bf = bf.drop("asof")
    assert one.count() == bf.count() > 0
    assert one.exceptAll(bf).count() == 0 and bf.exceptAll(one).count() == 0


def test_sliced_running_sum_equals_one_window(spark, frames):
    """The distributed prefix sum on real data against one ordered window per warehouse."""
    from pyspark.sql import Window

    from sackcast import schemas as S
    from sackcast.operators.running import exact, running_totals

    seg = frames.segments.select(*S.PRODUCT_KEY, "value_qty_30m")
    got = running_totals(seg, list(S.WAREHOUSE_KEY), "value_qty_30m", [S.MATERIAL, S.UNIT], "cum", "total")
    whole = Window.partitionBy(*S.WAREHOUSE_KEY)
    upto = (whole.orderBy(F.col("value_qty_30m").desc(), S.MATERIAL, S.UNIT)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    want = seg.withColumns({"total": F.sum(exact("value_qty_30m")).over(whole), "cum": F.sum(exact("value_qty_30m")).over(upto)})
    cols = [*S.PRODUCT_KEY, "cum", "total"]
    assert got.count() == want.count() == 990
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0


def test_versioned_model_in_monthly_run(spark, tmp_path):
    d = demand_from_tables(spark, SF001)
    kn = known_from_demand(d)
    mpath = str(tmp_path / "model")
    with_model = forecast_month(d, kn, ASOF, P, model_path=mpath)
    plain = forecast_month(d, kn, ASOF, P)
    cols = [c for c in plain.columns if c not in ("loaded_at", "deleted_at")]
    assert with_model.select(cols).exceptAll(plain.select(cols)).count() == 0
    stored = spark.read.parquet(mpath)
    assert stored.select("model_version").distinct().first()[0] == "v200108"
    n = stored.count()
    forecast_month(d, kn, ASOF, P, model_path=mpath).count()     # second run loads, writes nothing
    assert spark.read.parquet(mpath).count() == n


def test_run_backfill_writes_once(spark, tmp_path):
    from sackcast import schemas as S
    from sackcast.plans.backfill import run_backfill
    from sackcast.sources.commits import MonthTable

    d = demand_from_tables(spark, SF001)
    kn = known_from_demand(d)
    fpath, mpath = str(tmp_path / "fc"), str(tmp_path / "mon")
    dates = ["2000-02-15", ASOF]
    first = run_backfill(d, kn, dates, P, fpath, mpath)
    assert first == {"forecast": [200002, 200108], "monitoring": [200108]}
    fc, mon = MonthTable(spark, fpath, S.FORECAST_SCHEMA), MonthTable(spark, mpath, S.MONITOR_SCHEMA)
    assert sorted(r.period for r in fc.months().collect()) == [200002, 200108]
    assert [r.period for r in mon.read().select("period").distinct().collect()] == [200108]
    n_fc, n_mon = fc.read().count(), mon.read().count()
    assert n_fc > 0 and n_mon > 0
    assert run_backfill(d, kn, dates, P, fpath, mpath) == {"forecast": [], "monitoring": []}
    assert fc.read().count() == n_fc and mon.read().count() == n_mon
