"""Display ids (P5/P6). Joins always use the key columns themselves; a joined id
is for display only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def item_id(cols, sep: str = "_") -> Column:
    """P5: key columns as text joined by ``sep`` (a NULL key shows as empty text)."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def split_item_id(col, names, sep: str = "_") -> dict[str, Column]:
    """The parts of a joined id back as named columns (only exact when no
    part contains ``sep``; prefer carrying the key columns)."""
    parts = F.split(F.col(col) if isinstance(col, str) else col, sep)
    return {n: parts.getItem(i) for i, n in enumerate(names)}
