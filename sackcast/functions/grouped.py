"""Attach per-run aggregates (global max month, ...) to every row without a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_values(df: DataFrame, source: DataFrame, aggs: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``aggs`` computed over ``source`` (grouped by the run keys ``by``) to ``df``.

    No run keys: each aggregate becomes an uncorrelated scalar subquery, computed
    once with partial aggregation and inlined as a literal (no unpartitioned
    window, no collect). With run keys (backfill): one row per run, at most a
    few dozen, so the broadcast is bounded by the number of as-of dates.
    """
    if not by:
        return df.withColumns({name: source.agg(expr).scalar() for name, expr in aggs.items()})
    g = source.groupBy(*by).agg(*[e.alias(n) for n, e in aggs.items()])
    return df.join(F.broadcast(g), list(by), "inner")


def with_last_month(df: DataFrame, source: DataFrame, name: str, by: tuple[str, ...] = (),
                    carried: str = "_last_month") -> DataFrame:
    """Add the run's max month as ``name``: copied from the ``carried`` column when
    the frame has it (set by the zero-fill, equal to the max month of any
    gap-filled subset), else aggregated from ``source``."""
    if carried in df.columns:
        return df.withColumn(name, F.col(carried))
    return with_group_values(df, source, {name: F.max("month")}, by)
