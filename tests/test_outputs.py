import datetime as dt

from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.operators.monitor import monitor_errors, monitorable_forecast
from sackcast.operators.stamp import add_period_stamp, to_forecast_layout, to_monitor_layout
from sackcast.params import DEFAULT
from sackcast.sources import tables

from helpers import d, key, panel_rows


def _fc(spark, k, months, period, q=5):
    rows = [(*k, d(m + "-01"), q, q, q, q, q, "X", True, True, True, True) for m in months]
    schema = (", ".join(f"{c} string" for c in S.PRODUCT_KEY) + ", date date, "
              + ", ".join(f"{c} bigint" for c in S.Q_COLS) + ", model_type string, "
              + ", ".join(f"{c} boolean" for c in S.FLAG_COLS))
    return add_period_stamp(spark.createDataFrame(rows, schema), dt.date(period // 100, period % 100, 15))


def test_period_stamp(spark):
    df = spark.range(1)
    r = add_period_stamp(df, "2025-12-01").select(
        "run_date", "period", "deleted", (F.col("deleted_at") == F.col("loaded_at")).alias("same")).first()
    assert (r.run_date, r.period, r.deleted, r.same) == ("01-12-2025", 202512, False, True)
    ts = add_period_stamp(df, "2025-12-01").select(F.unix_timestamp("loaded_at").alias("u")).first().u
    assert ts == int(dt.datetime(2025, 12, 1, 5, 0, tzinfo=dt.timezone.utc).timestamp())


def test_layout_templates(spark):
    rows = [("CEMENT", "6012", "W1", "M1", "BLS", None, d("2024-01-05"), 3.0)]
    demand = spark.createDataFrame(rows, S.DEMAND_SCHEMA)
    def shape(schema):
        return [(f.name, f.dataType) for f in schema.fields]
    assert shape(to_forecast_layout(demand, "2024-02-01", DEFAULT).schema) == shape(S.FORECAST_SCHEMA)
    assert shape(to_monitor_layout(demand, "2024-02-01", DEFAULT).schema) == shape(S.MONITOR_SCHEMA)


def test_monitor_errors_nulls_and_empty(spark):
    k1, k2, k3 = key("M1"), key("M2"), key("M3")
    fc = _fc(spark, k1, ["2024-01"], 202301).unionByName(_fc(spark, k2, ["2024-01"], 202301))
    act = panel_rows(spark, [(k1, "2024-01", 3), (k3, "2024-01", 9)])
    out = {r.material: r for r in monitor_errors(fc, act).collect()}
    assert out["M1"].err50 == 2.0 and out["M1"].qty == 3.0
    assert out["M2"].qty is None and out["M2"].err05 is None
    empty = panel_rows(spark, []) if False else act.limit(0)
    assert monitor_errors(fc, empty).count() == 0


def test_monitorable_period(spark):
    k = key()
    early = _fc(spark, k, [f"2024-{m:02d}" for m in range(1, 13)], 202401)
    late = _fc(spark, k, ["2025-01", "2025-02"], 202412)
    stored = early.unionByName(late)
    got = monitorable_forecast(stored, "2025-01-20", "CEMENT")
    assert {r.period for r in got.collect()} == {202401}
    assert monitorable_forecast(stored, "2026-06-20", "CEMENT").count() == 0


def _table(spark, path):
    from sackcast.sources.commits import MonthTable
    return MonthTable(spark, str(path), S.FORECAST_SCHEMA)


def _month(spark, k, months, period):
    return S.conform(_fc(spark, k, months, period), S.FORECAST_SCHEMA)


def test_a_month_is_stored_once(spark, tmp_path):
    t = _table(spark, tmp_path / "forecast")
    fc = _month(spark, key(), ["2024-01", "2024-02"], 202401)
    assert t.month(202401, "CEMENT") is None and t.read().count() == 0
    assert t.write(fc) == [(202401, "CEMENT")]
    assert t.write(fc) == []
    back = t.read()
    assert back.count() == 2 and back.columns == S.FORECAST_SCHEMA.names
    assert t.read_month(202401, "CEMENT").count() == 2 and t.read_month(202402, "CEMENT").count() == 0
    entry = t.month(202401, "CEMENT")
    assert (entry["rows"], entry["first_month"], entry["last_month"]) == (2, dt.date(2024, 1, 1), dt.date(2024, 2, 1))


def test_replacing_a_month_leaves_the_others(spark, tmp_path):
    t = _table(spark, tmp_path / "forecast")
    t.write(_month(spark, key(), ["2024-01"], 202401).unionByName(_month(spark, key(), ["2024-02"], 202402)))
    assert t.write(_month(spark, key(), ["2024-01", "2024-02", "2024-03"], 202401), replace=True) == [(202401, "CEMENT")]
    assert t.read_month(202401, "CEMENT").count() == 3 and t.read_month(202402, "CEMENT").count() == 1
    assert t.read().count() == 4


def test_runs_at_the_same_time_leave_one(spark, tmp_path):
    """Both have staged and seen an empty manifest before either publishes."""
    from concurrent.futures import ThreadPoolExecutor

    t = _table(spark, tmp_path / "forecast")
    frames = [_month(spark, key(), ["2024-01"] * n, 202401) for n in (2, 3)]
    with ThreadPoolExecutor(2) as pool:
        won = list(pool.map(t.write, frames))
    assert t.read().count() in (2, 3) and t.months().count() == 1
    assert [(202401, "CEMENT")] in won


def test_unpublished_rows_are_invisible(spark, tmp_path):
    t = _table(spark, tmp_path / "forecast")
    t.write(_month(spark, key(), ["2024-01"], 202401))
    lost = _month(spark, key(), ["2024-01"] * 5, 202402).withColumn("commit", F.lit("died"))
    lost.write.mode("append").partitionBy("commit", "period").parquet(f"{t.path}/data")
    assert t.read().count() == 1 and t.month(202402, "CEMENT") is None
    assert t.write(_month(spark, key(), ["2024-02"], 202402)) == [(202402, "CEMENT")] and t.read().count() == 2


def test_few_files_a_month(spark, tmp_path):
    import glob
    t = _table(spark, tmp_path / "forecast")
    rows = [_month(spark, key(f"M{i}"), ["2024-01", "2024-02"], 202401).repartition(20) for i in range(4)]
    t.write(rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3]))
    assert len(glob.glob(f"{t.path}/data/commit=*/period=202401/*.parquet")) <= 2
    assert t.read().count() == 8


def test_item_id_helpers_and_table_check(spark):
    from sackcast.functions import item_id, split_item_id

    df = spark.createDataFrame([("6012", "C001", "Brand#1", "BLS")], "company string, warehouse string, material string, unit string")
    r = df.select(item_id(["company", "warehouse", "material", "unit"]).alias("id")).first()
    assert r.id == "6012_C001_Brand#1_BLS"
    back = df.select(item_id(["company", "warehouse"]).alias("id")).select(
        *[c.alias(n) for n, c in split_item_id("id", ["company", "warehouse"]).items()]).first()
    assert (back.company, back.warehouse) == ("6012", "C001")
    assert tables.table_exists(spark, "no_such_table_here") is False


def test_completed_forecast_opens_one_partition(spark, tmp_path):
    """Found by the manifest, whatever its horizon (72 months here)."""
    t = _table(spark, tmp_path / "fc")
    k = key()
    long_ago = [f"{2019 + m // 12}-{m % 12 + 1:02d}" for m in range(72)]   # 2019-01 .. 2024-12
    t.write(_month(spark, k, long_ago, 201901).unionByName(_month(spark, k, ["2022-01"], 202101)))
    got = t.completed("2025-01-20", "CEMENT")
    assert got.count() == 72 and {r.period for r in got.collect()} == {201901}
    import io, contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    pruned = buf.getvalue().split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "commit#" in pruned and "period#" in pruned
    assert monitorable_forecast(t.read(), "2025-01-20", "CEMENT").count() == 72
    assert t.completed("2031-01-20", "CEMENT").count() == 0


def test_load_known_by_header(spark, tmp_path):
    from sackcast.sources import load_known

    f = tmp_path / "known.csv"
    f.write_text("note,unit,material,warehouse,company,product_class\n"
                 "x,BLS,0007,C001,6012,CEMENT\n")
    r = load_known(spark, str(f)).first()
    assert tuple(r) == ("CEMENT", "6012", "C001", "0007", "BLS")


def test_model_versions_by_class_and_late_series(spark, tmp_path):
    from sackcast.operators.seasonal import fit_or_load
    rows = [(s, f"20{y}-{m:02d}-01", float(10 * m + y)) for s in ("a", "b", "late") for y in (21, 22, 23) for m in range(1, 13)]
    panel = spark.createDataFrame(rows, "sku string, month string, qty double").selectExpr("sku", "cast(month as date) month", "qty")
    base, q = f"{tmp_path}/models", (0.05, 0.25, 0.5, 0.75, 0.95)
    first = fit_or_load(spark, panel.where("sku = 'a'"), base, "2024-01-10", q, ["sku"], "x")
    assert [r["sku"] for r in first.collect()] == ["a"]
    assert [r["sku"] for r in fit_or_load(spark, panel.where("sku = 'b'"), base, "2024-01-10", q, ["sku"], "y").collect()] == ["b"]
    again = fit_or_load(spark, panel.where("sku <> 'b'"), base, "2024-01-20", q, ["sku"], "x")
    assert sorted(r["sku"] for r in again.collect()) == ["a", "late"]
    assert fit_or_load(spark, panel.limit(0), f"{tmp_path}/none", "2024-01-10", q, ["sku"], "x").count() == 0


def test_promotion_and_roll_back(spark, tmp_path):
    from sackcast.operators import seasonal
    rows = [("a", f"20{y}-{m:02d}-01", float(10 * m + y)) for y in (21, 22, 23) for m in range(1, 13)]
    panel = spark.createDataFrame(rows, "sku string, month string, qty double").selectExpr("sku", "cast(month as date) month", "qty")
    base, q = f"{tmp_path}/models", (0.05, 0.25, 0.5, 0.75, 0.95)
    assert seasonal.current_version(spark, base, "x") == (None, 0)
    seasonal.fit_or_load(spark, panel.where("month < '2023-06-01'"), base, "2023-06-10", q, ["sku"], "x")
    newest = seasonal.fit_or_load(spark, panel, base, "2024-01-10", q, ["sku"], "x").first()
    assert seasonal.current_version(spark, base, "x") == ("v202401", 2)
    older = seasonal.load_params(spark, base, "v202306", "x").first()
    assert older["p50"] == older["p50"] and older["n_residuals"] != newest["n_residuals"]
    assert seasonal.promote(spark, base, "v202306", "x") is True                    # roll back
    assert seasonal.load_params(spark, base, None, "x").first()["n_residuals"] == older["n_residuals"]
    assert seasonal.promote(spark, base, "v202401", "x", after=2) is False          # step 3 is taken
    assert seasonal.promote(spark, base, "v209901", "x") is False                   # not stored
    assert seasonal.current_version(spark, base, "x") == ("v202306", 3)
    # a month that is stored fits nothing: changed history leaves its parameters as they are
    again = seasonal.fit_or_load(spark, panel.selectExpr("sku", "month", "qty * 100 qty"), base, "2024-01-20", q, ["sku"], "x")
    assert again.count() == 1 and again.first()["p95"] == newest["p95"]


def test_input_is_checked_in_flight(spark, tmp_path):
    import pytest
    from sackcast.plans.monthly import run_month
    from sackcast.sources.checks import BrokenInput
    from sackcast.sources.commits import MonthTable
    from sackcast.sources.fixtures import demand_from_tables, known_from_demand
    demand = demand_from_tables(spark, "/root/testdata/sf0.001")
    known = known_from_demand(demand)
    said = run_month(demand, known, "2001-08-15", DEFAULT, f"{tmp_path}/f", f"{tmp_path}/m")
    assert said["input"] == {"rows": 1756 + said["input"]["other_companies"], "null_keys": 0, "bad_quantities": 0,
                             "other_companies": said["input"]["other_companies"], "months": 37, "has_last_month": True}
    assert run_month(demand, known, "2001-08-15", DEFAULT, f"{tmp_path}/f", f"{tmp_path}/m")["input"] is None
    broken = demand.withColumn("warehouse", F.when(F.col("material") != "Brand#11", F.col("warehouse")))
    with pytest.raises(BrokenInput, match="null_keys"):
        run_month(broken, known, "2001-08-15", DEFAULT, f"{tmp_path}/bf", f"{tmp_path}/bm")
    assert MonthTable(spark, f"{tmp_path}/bf", S.FORECAST_SCHEMA).read().count() == 0


def test_month_without_demand(spark, tmp_path):
    from sackcast.params import DEFAULT
    from sackcast.plans.monthly import run_month
    from sackcast.sources.fixtures import demand_from_tables, known_from_demand
    demand = demand_from_tables(spark, "/root/testdata/sf0.001").limit(0)
    said = run_month(demand, known_from_demand(demand), "2001-08-15", DEFAULT, f"{tmp_path}/f", f"{tmp_path}/m", f"{tmp_path}/p")
    assert (said["period"], said["forecast_written"], said["monitoring_written"]) == (200108, False, False)
    assert said["forecast"].count() == said["monitoring"].count() == 0
