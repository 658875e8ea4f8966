"""P8 period stamp; P9/P10 empty-output templates in the output layouts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.params import Params


def stamp_columns(asof, tz: str = "America/Lima") -> dict:
    """The five period columns of a run dated ``asof`` (a date, or a DATE column
    in a backfill). ``loaded_at`` is midnight of that date in ``tz`` (an instant,
    independent of the session time zone)."""
    if isinstance(asof, (dt.date, str)):
        d = F.lit(str(asof)[:10]).cast("date")
    else:
        d = asof.cast("date")
    loaded = F.make_timestamp(F.year(d), F.month(d), F.dayofmonth(d), F.lit(0), F.lit(0), F.lit(0), F.lit(tz))
    return {
        "run_date": F.date_format(d, "dd-MM-yyyy"),
        "period": F.date_format(d, "yyyyMM").cast("int"),
        "loaded_at": loaded,
        "deleted": F.lit(False),
        "deleted_at": loaded,
    }


def utc_wall_clock(d, tz: str = "America/Lima"):
    """Midnight of date ``d`` in ``tz`` as a UTC wall-clock TIMESTAMP_NTZ (for display
    and engine-neutral comparison; independent of the session time zone)."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), d.cast("timestamp_ntz"))


def add_period_stamp(df: DataFrame, asof, tz: str = "America/Lima") -> DataFrame:
    """P8."""
    return df.withColumns(stamp_columns(asof, tz))


def to_forecast_layout(demand: DataFrame, asof, p: Params) -> DataFrame:
    """Reshape demand rows into the forecast layout (quantiles 0, empty model
    type, flags false) and stamp them; the reference uses it as a schema sample."""
    x = demand.drop(S.LAST_SALE, S.QTY).withColumns(
        {**{c: F.lit(0).cast("long") for c in S.Q_COLS}, "model_type": F.lit(""),
         **{c: F.lit(False) for c in S.FLAG_COLS}})
    return S.conform(add_period_stamp(x, asof, p.stamp_time_zone), S.FORECAST_SCHEMA)


def to_monitor_layout(demand: DataFrame, asof, p: Params) -> DataFrame:
    """P10: the same for the monitoring layout (quantity kept, ten zero integers)."""
    x = demand.drop(S.LAST_SALE).withColumns(
        {S.QTY: F.col(S.QTY).cast("long").cast("double"),
         **{c: F.lit(0).cast("long") for c in S.Q_COLS},
         **{c: F.lit(0.0) for c in S.ERR_COLS}, "model_type": F.lit(""),
         **{c: F.lit(False) for c in S.FLAG_COLS}})
    return S.conform(add_period_stamp(x, asof, p.stamp_time_zone), S.MONITOR_SCHEMA)
