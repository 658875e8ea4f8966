"""SKU splits: G6 known / unknown / known-inactive, G5 model-eligible or not,
T12 recent sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import in_lists_mask, with_group_values
from sackcast.operators.segment import segment
from sackcast.params import Params


def _str_keys(df: DataFrame, keys) -> DataFrame:
    # a list may hold codes as numbers; compare as text on both sides
    return df.withColumns({k: F.col(k).cast("string") for k in keys})


def known_split(panel: DataFrame, known: DataFrame, keys=S.PRODUCT_KEY, by: tuple[str, ...] = ()):
    """G6 -> (known_active, unknown, known_inactive).

    known_active: panel rows whose key is in the list (left semi join);
    unknown: panel rows whose key is not (left anti join);
    known_inactive: list rows whose key has no panel row (anti join, sides swapped).
    The list is joined on its key columns; Spark broadcasts it when AQE measures it
    small and sort-merge joins it otherwise.
    With run keys, the list is joined per run: ``known`` must then carry the run keys.
    """
    k = [*by, *keys]
    panel_s = _str_keys(panel, keys)
    known_s = _str_keys(known, keys).select(*k)
    active = panel_s.join(known_s, k, "left_semi")
    unknown = panel_s.join(known_s, k, "left_anti")
    inactive = known_s.join(panel_s.select(*k), k, "left_anti")
    return active, unknown, inactive


def eligibility_mask(p: Params, names: dict[str, str]) -> dict[str, tuple]:
    """Column -> allowed values: the unit list plus the eligible segments."""
    return {S.UNIT: p.eligible_units, names["abc"]: p.eligible_abc,
            names["xyz"]: p.eligible_xyz, names["fsn"]: p.eligible_fsn}


def with_segments(panel: DataFrame, p: Params, segments: DataFrame | None = None,
                  keys=S.PRODUCT_KEY, by: tuple[str, ...] = ()) -> DataFrame:
    """Panel rows with their product's segment columns (left join)."""
    seg = segments if segments is not None else segment(panel, p, keys, by=by)
    return panel.join(seg, [*by, *keys], "left")


def eligible_split(panel: DataFrame, p: Params, segments: DataFrame | None = None,
                   keys=S.PRODUCT_KEY, by: tuple[str, ...] = ()):
    """G5 -> (eligible, not_eligible) panel rows, both with segment columns.
    The mask is two-valued: a row whose segment is NULL is not eligible."""
    names = S.segment_names(p.segment_window, p.segment_prefix)
    x = with_segments(panel, p, segments, keys, by).withColumn(
        "_ok", in_lists_mask(eligibility_mask(p, names)))
    return x.where("_ok").drop("_ok"), x.where(~F.col("_ok")).drop("_ok")


def recent_sales_flag(df: DataFrame, sales_window: int, keys=S.SERIES_KEY, qty: str = S.QTY,
                      by: tuple[str, ...] = (), out: str = "has_sales") -> DataFrame:
    """Per series, any month after (max - (window - 1) months) with qty > 0.
    The bound is strict, so the window covers window - 1 months, as in the reference.
    The max month is that of ``df`` (per run)."""
    m = with_group_values(df, df, {"_hi": F.max(S.MONTH)}, by)
    lo = F.add_months(F.col("_hi"), -(sales_window - 1))
    return m.groupBy(*by, *keys).agg(
        F.coalesce(F.bool_or((F.col(S.MONTH) > lo) & (F.col(qty) > 0)), F.lit(False)).alias(out))


def recent_sales_split(not_eligible: DataFrame, sales_window: int, keys=S.SERIES_KEY,
                       by: tuple[str, ...] = ()):
    """T12 -> (with_sales, without_sales) rows of the non-eligible frame."""
    flag = recent_sales_flag(not_eligible, sales_window, keys, by=by, out="_recent")
    x = not_eligible.join(flag, [*by, *keys], "left").withColumn("_recent", F.coalesce("_recent", F.lit(False)))
    return x.where("_recent").drop("_recent"), x.where(~F.col("_recent")).drop("_recent")
