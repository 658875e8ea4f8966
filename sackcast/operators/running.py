"""Running sum inside a group that may be huge (one warehouse can hold a third of
all products), computed without sending a huge group to a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sums are taken over decimals of this type: exact, so the order in which parts
# are added cannot change them.
EXACT = "decimal(38,14)"

# Value slices per doubling of the value, and parts of a group's zeros.
SLICES, ZERO_PARTS = 256, 32


def exact(value_col: str) -> Column:
    return F.col(value_col).cast(EXACT)


def value_slice(value: Column) -> Column:
    """Number of the value's slice, rising with the value; 0 holds exactly the zeros."""
    high = 1 << 20   # beyond any logarithm of a double times SLICES
    size = lambda v: F.floor(F.log2(v) * SLICES).cast("int")
    return F.when(value > 0, size(value) + high).when(value < 0, -size(-value) - high).otherwise(0)


def running_totals(df: DataFrame, group_cols: list[str], value_col: str, tie_cols: list[str],
                   out_cum: str, out_total: str) -> DataFrame:
    """``out_cum``: sum of ``value_col`` over the rows of the same group ordered by value
    descending, then ``tie_cols`` ascending, up to and including the row; ``out_total``:
    the group's sum. Both exact decimals. Group columns must not be NULL.

    A distributed prefix sum, lazy and the same for every group size: a group's values
    fall into slices of 0.3 % width; the slices' sums (a few thousand rows a group,
    partially aggregated) give each slice the sum above it, and rows are ordered inside
    their own slice only. Zeros, often the largest slice, add nothing in any order: they
    are dealt over ``ZERO_PARTS`` parts. What one task orders is one slice of one group."""
    g = list(group_cols)
    value = F.col(value_col)
    x = df.withColumns({"_slice": value_slice(value),
                        "_part": F.when(value == 0, F.pmod(F.xxhash64(*tie_cols), F.lit(ZERO_PARTS)).cast("int")).otherwise(0)})
    sums = x.groupBy(*g, "_slice").agg(F.sum(exact(value_col)).alias("_sum"))
    whole = Window.partitionBy(*g)
    above = whole.orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({out_total: F.sum("_sum").over(whole), "_above": F.coalesce(F.sum("_sum").over(above), F.lit(0).cast(EXACT))})
    parts = F.when(F.col("_slice") == 0, F.sequence(F.lit(0), F.lit(ZERO_PARTS - 1))).otherwise(F.array(F.lit(0)))
    sums = sums.withColumn("_part", F.explode(parts)).drop("_sum")
    inside = (Window.partitionBy(*g, "_slice", "_part").orderBy(value.desc(), *[F.col(c).asc() for c in tie_cols])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = x.join(sums, [*g, "_slice", "_part"])
    return joined.withColumn(out_cum, (F.col("_above") + F.sum(exact(value_col)).over(inside)).cast(EXACT)).drop("_slice", "_part", "_above")
