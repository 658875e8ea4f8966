import datetime as dt

from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.operators.prepare import complete_months, monthly_sum, prepare_demand
from sackcast.operators.skus import eligible_split, recent_sales_flag
from sackcast.params import DEFAULT

from helpers import d, key, panel_rows


def test_zero_fill_keeps_older_rows(spark):
    k = key()
    monthly = panel_rows(spark, [(k, "2024-01", 10), (k, "2024-04", 5)])
    out = complete_months(monthly, 3)
    got = sorted((r.month.isoformat(), r.qty) for r in out.collect())
    assert got == [("2024-01-01", 10.0), ("2024-02-01", 0.0), ("2024-03-01", 0.0), ("2024-04-01", 5.0)]


def test_null_key_dropped_nan_and_null_qty_zero(spark):
    rows = [("CEMENT", "6012", "W1", "M1", "BLS", None, d("2024-01-05"), float("nan")),
            ("CEMENT", "6012", "W1", "M1", "BLS", None, d("2024-01-20"), None),
            ("CEMENT", "6012", "W1", "M1", "BLS", None, d("2024-01-21"), 3.0),
            ("CEMENT", "6012", None, "M1", "BLS", None, d("2024-01-21"), 7.0)]
    df = spark.createDataFrame(rows, S.DEMAND_SCHEMA)
    out = prepare_demand(df, {}, complete=False).collect()
    assert len(out) == 1 and out[0].qty == 3.0


def test_filters_in_lists(spark):
    rows = [("CEMENT", c, "W1", "M1", "BLS", None, d("2024-01-05"), 1.0) for c in ("6012", "6052", "6099")]
    df = spark.createDataFrame(rows, S.DEMAND_SCHEMA)
    out = prepare_demand(df, DEFAULT.filters(), complete=False)
    assert sorted(r.company for r in out.collect()) == ["6012", "6052"]


def test_recent_sales_strict_bound(spark):
    a, b, c = key("A"), key("B"), key("C")
    rows = [(a, "2024-02", 1), (b, "2024-01", 4), (c, "2024-12", 0)]
    for k in (a, b, c):
        rows.append((k, "2024-12", 0) if k != c else (k, "2024-11", 0))
    flag = recent_sales_flag(panel_rows(spark, rows), 12, S.PRODUCT_KEY)
    got = {r.material: r.has_sales for r in flag.collect()}
    assert got == {"A": True, "B": False, "C": False}


def test_null_segment_is_not_eligible(spark):
    k1, k2 = key("M1"), key("M2")
    pn = panel_rows(spark, [(k1, "2024-01", 1), (k2, "2024-01", 1)])
    names = S.segment_names(30)
    seg = spark.createDataFrame(
        [(*k1, 1.0, 0.0, 12.0, "A", "X", "F")],
        ", ".join(f"{c} string" for c in S.PRODUCT_KEY)
        + f", {names['value']} double, {names['cv']} double, {names['rotation']} double, "
        + f"{names['abc']} string, {names['xyz']} string, {names['fsn']} string")
    el, nel = eligible_split(pn, DEFAULT, seg)
    assert [r.material for r in el.collect()] == ["M1"]
    assert [r.material for r in nel.collect()] == ["M2"]


def test_known_split_with_numeric_codes(spark):
    from sackcast.operators.skus import known_split

    pn = panel_rows(spark, [(("CEMENT", "6012", "C001", "100", "BLS"), "2024-01", 1),
                            (("CEMENT", "6012", "C001", "200", "BLS"), "2024-01", 2)])
    known = spark.createDataFrame([("CEMENT", 6012, "C001", 100, "BLS"), ("CEMENT", 6012, "C001", 300, "BLS")],
                                  "product_class string, company int, warehouse string, material int, unit string")
    act, unk, ina = known_split(pn, known)
    assert [r.material for r in act.collect()] == ["100"]
    assert [r.material for r in unk.collect()] == ["200"]
    assert [r.material for r in ina.collect()] == ["300"]


def test_read_demand_without_last_sale(spark, tmp_path):
    from sackcast.sources import read_demand

    path = str(tmp_path / "demand")
    spark.createDataFrame([("CEMENT", "6012", "W1", "M1", "BLS", d("2024-01-05"), 2.0)],
                          "product_class string, company string, warehouse string, material string, unit string, "
                          "date date, qty double").write.parquet(path)
    df = read_demand(spark, path)
    assert df.columns == S.DEMAND_SCHEMA.names and df.first().last_sale is None


def test_monthly_sum_of_fractions_does_not_depend_on_order(spark):
    """Doubles added in another order give another last digit; exact decimals don't."""
    import random
    from sackcast.operators.prepare import monthly_sum
    rows = [("CEMENT", "6012", "W1", "M1", "BLS", "2024-01-01", random.Random(i).choice([0.1, 0.7, 1e9, 1e-5])) for i in range(500)]
    rows.append((*rows[0][:6], float("inf")))
    schema = "product_class string, company string, warehouse string, material string, unit string, month string, qty double"
    sums = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        sums.add(monthly_sum(spark.createDataFrame(rows, schema).repartition(seed + 1)).first()["qty"])
    assert len(sums) == 1
