"""IN-list predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_in(conditions: dict[str, tuple]) -> Column:
    """AND of ``col IN (values)`` over a dict; empty dict -> TRUE."""
    preds = [F.col(c).isin(list(v)) for c, v in conditions.items()]
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def in_lists_mask(conditions: dict[str, tuple]) -> Column:
    """Two-valued mask: a NULL column makes the row fail, never vanish from both sides."""
    return F.coalesce(all_in(conditions), F.lit(False))
