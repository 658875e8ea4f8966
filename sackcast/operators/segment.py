"""Segmentation: G1 ABC by cumulative value share, G2 XYZ by coefficient of
variation, G3 FSN by rotation, G4 all three over the last N months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import with_last_month
from sackcast.operators.running import exact, running_totals
from sackcast.params import Params


def cv_expr(qty: str = S.QTY) -> Column:
    """Over values > 0 only; at most one such value -> 0; else sample std / mean, 4 decimals."""
    pos = F.when(F.col(qty) > 0, F.col(qty))
    return (F.when(F.count(pos) <= 1, F.lit(0.0))
             .otherwise(F.bround(F.stddev_samp(pos) / F.avg(pos), 4)))


def rotation_expr(qty: str = S.QTY) -> Column:
    """Months with a sale > 0, times 12, over the number of months; 4 decimals."""
    return F.bround(F.count(F.when(F.col(qty) > 0, 1)) * 12.0 / F.count(F.lit(1)), 4)


def xyz_expr(cv: Column, breaks=(0.35, 0.80)) -> Column:
    """NULL or <= a -> X, <= b -> Y, else Z."""
    a, b = breaks
    return F.when(cv.isNull() | (cv <= a), "X").when(cv <= b, "Y").otherwise("Z")


def fsn_expr(rot: Column, breaks=(2, 6)) -> Column:
    """>= b -> F, >= a -> S, else N."""
    a, b = breaks
    return F.when(rot >= b, "F").when(rot >= a, "S").otherwise("N")


def cumulative_share(metrics: DataFrame, value_col: str, group_cols, id_cols, out_col: str = "share") -> DataFrame:
    """W1 + A10: share of the group's total reached by each row, rows ordered by
    value descending with the ids as tie-break; adds ``_total`` and ``_cum`` (exact).
    The share is NULL when the group total is <= 0 (no division by zero)."""
    x = running_totals(metrics, list(group_cols), value_col, list(id_cols), "_cum", "_total")
    return x.withColumn(out_col, _share(F.col("_cum")))


def _share(cum: Column) -> Column:
    return F.when(F.col("_total") > 0, cum.cast("double") / F.col("_total").cast("double"))


def abc_classes(metrics: DataFrame, value_col: str, out_col: str, group_cols, id_cols,
                breaks=(0.80, 0.95)) -> DataFrame:
    """G1: per group, total <= 0 -> all C; else share <= a -> A, <= b -> B, else C.
    Then the B repair (W2): a group with A and C but no B turns its first row
    beyond ``a`` (in value order) into B.

    Shares rise as long as values are positive and stay at 1 or more after that, so the
    repair needs no facts of the group: it meets the row beyond both breaks whose
    predecessor (the running sum without the row's own value; there is one) is an A."""
    a, b = breaks
    x = cumulative_share(metrics, value_col, group_cols, id_cols, "_share")
    before = F.col("_cum") - exact(value_col)
    repair = (F.col("_share") > a) & (F.col("_share") > b) & (before > 0) & (_share(before) <= a)
    cls = (F.when(F.col("_total") <= 0, "C").when(F.col("_share") <= a, "A")
            .when((F.col("_share") <= b) | repair, "B").otherwise("C"))
    return x.withColumn(out_col, cls).drop("_share", "_total", "_cum")


def segment_metrics(panel: DataFrame, window: int, names: dict[str, str], keys=S.PRODUCT_KEY,
                    qty: str = S.QTY, by: tuple[str, ...] = ()) -> DataFrame:
    """W7 + A7/A8/A9: value, cv and rotation per key over the last ``window``
    months up to the data's max month (per run)."""
    m = with_last_month(panel, panel, "_hi", by)
    win = m.where((F.col(S.MONTH) >= F.add_months(F.col("_hi"), -(window - 1)))
                  & (F.col(S.MONTH) <= F.col("_hi")))
    return (win.groupBy(*by, *keys)
               .agg(F.coalesce(F.sum(exact(qty)).cast("double"), F.lit(0.0)).alias(names["value"]),
                    cv_expr(qty).alias(names["cv"]),
                    rotation_expr(qty).alias(names["rotation"])))


def classified(metrics: DataFrame, p: Params, names: dict[str, str], keys=S.PRODUCT_KEY,
               warehouse_keys=S.WAREHOUSE_KEY, by: tuple[str, ...] = ()) -> DataFrame:
    """G1-G3 on a table of value, cv and rotation: product key + the six segment columns."""
    id_cols = [k for k in keys if k not in warehouse_keys]
    abc = abc_classes(metrics, names["value"], names["abc"], [*by, *warehouse_keys], id_cols, p.abc_breaks)
    return abc.select(
        *by, *keys, names["value"], names["cv"], names["rotation"], names["abc"],
        xyz_expr(F.col(names["cv"]), p.xyz_breaks).alias(names["xyz"]),
        fsn_expr(F.col(names["rotation"]), p.fsn_breaks).alias(names["fsn"]))


def segment(panel: DataFrame, p: Params, keys=S.PRODUCT_KEY, warehouse_keys=S.WAREHOUSE_KEY,
            qty: str = S.QTY, by: tuple[str, ...] = ()) -> DataFrame:
    """Product key + value, cv, rotation, abc, xyz, fsn (one row per key)."""
    names = S.segment_names(p.segment_window, p.segment_prefix, qty)
    return classified(segment_metrics(panel, p.segment_window, names, keys, qty, by), p, names, keys, warehouse_keys, by)
