"""Demand preparation: P1 periodise, P2 clean quantity, P3 filters, A1 monthly sum,
T1 zero-fill of missing months, T2 the composition of all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import all_in, keep, first_of_month, with_group_values
from sackcast.operators.running import EXACT


def periodise(df: DataFrame, date_col: str = S.DATE) -> DataFrame:
    """Parse the date, add ``period`` text (yyyyMM) and ``month`` (first of month, DATE)."""
    d = F.to_date(F.col(date_col))
    return df.withColumns({
        date_col: d,
        "period": F.date_format(d, "yyyyMM"),
        S.MONTH: first_of_month(d),
    })


def clean_quantity(df: DataFrame, qty_cols=(S.QTY,)) -> DataFrame:
    """Quantity to double, NULL and NaN to 0 (``na.fill`` covers both)."""
    df = df.withColumns({c: F.col(c).cast("double") for c in qty_cols})
    return df.na.fill(0.0, subset=list(qty_cols))


def apply_filters(df: DataFrame, filters: dict[str, tuple]) -> DataFrame:
    """Conjunction of ``column IN (values)``; pushed to the scan by Catalyst."""
    return df.where(all_in(filters)) if filters else df


def monthly_sum(df: DataFrame, keys=S.PRODUCT_KEY, qty_cols=(S.QTY,), by: tuple[str, ...] = ()) -> DataFrame:
    """A1: sum per key and month. Rows with a NULL key are dropped first, as the
    reference's group-by does. Partial aggregation runs map-side, so a hot key
    is combined before the shuffle. Sums are taken over exact decimals, so fractional
    quantities give the same month whatever the order of the rows; a quantity that is
    not finite counts as 0."""
    return (df.na.drop(subset=list(keys))
              .groupBy(*by, *keys, S.MONTH)
              .agg(*[F.coalesce(F.sum(F.col(c).try_cast(EXACT)).cast("double"), F.lit(0.0)).alias(c) for c in qty_cols]))


LAST_MONTH = "_last_month"


def complete_months(monthly: DataFrame, months: int, keys=S.PRODUCT_KEY, qty_cols=(S.QTY,),
                    by: tuple[str, ...] = (), keep_last: bool = False) -> DataFrame:
    """Every key gets a row for each of the last ``months`` months up to the
    data's max month (per run), missing ones with quantity 0. Rows older than the
    window are kept as they are.

    One aggregation per key collects that key's monthly rows (bounded by the
    number of calendar months in the input, however many raw rows the key had),
    adds the missing months and explodes back. The output stays hash-partitioned
    by the key, which later per-series aggregations and windows reuse.

    The input is read twice (the run's max month, then the fill), so it is
    persisted: the demand behind it is scanned once. It is one row per key and
    month, far smaller than the demand rows.

    ``keep_last`` keeps the run's max month as column ``_last_month`` on every row,
    so later operators need not aggregate the panel again to find it.
    """
    monthly = keep(monthly)
    m = with_group_values(monthly, monthly, {"_hi": F.max(S.MONTH)}, by)
    vals = [F.col(c) for c in qty_cols]
    per_key = m.groupBy(*by, *keys).agg(
        F.max("_hi").alias("_hi"),
        F.collect_list(F.struct(F.col(S.MONTH).alias("m"), *[v.alias(c) for v, c in zip(vals, qty_cols)])).alias("_rows"),
        F.collect_list(S.MONTH).alias("_have"))
    lo = F.add_months(F.col("_hi"), -(months - 1))
    window = F.sequence(lo, F.col("_hi"), F.expr("INTERVAL 1 MONTH"))
    missing = F.transform(F.array_except(window, F.col("_have")),
                          lambda d: F.struct(d.alias("m"), *[F.lit(0.0).alias(c) for c in qty_cols]))
    full = per_key.select(*by, *keys, "_hi", F.explode(F.concat(F.col("_rows"), missing)).alias("_r"))
    extra = [F.col("_hi").alias(LAST_MONTH)] if keep_last else []
    return full.select(*by, *keys, F.col("_r.m").alias(S.MONTH), *[F.col(f"_r.{c}").alias(c) for c in qty_cols],
                       *extra)


def prepare_demand(df: DataFrame, filters: dict[str, tuple] | None = None, keys=S.PRODUCT_KEY,
                   qty_cols=(S.QTY,), group_by_month: bool = True, complete: bool = True,
                   months: int = 36, by: tuple[str, ...] = (), keep_last: bool = False) -> DataFrame:
    """P1 -> P2 -> P3 -> A1 -> T1, each stage optional as in the reference."""
    out = apply_filters(clean_quantity(periodise(df), qty_cols), filters or {})
    if not group_by_month:
        return out
    out = monthly_sum(out, keys, qty_cols, by)
    if complete:
        out = complete_months(out, months, keys, qty_cols, by, keep_last)
    return out
