"""Run parameters as one frozen dataclass (no JSON reader, no mutation)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


# They must equal the reference job's configuration for the
# same results (window lengths in months, segment thresholds, quantile levels,
# eligibility lists, stamping time zone).
SEGMENT_WINDOW_MONTHS = 30
HISTORY_MONTHS = 36
HORIZON_MONTHS = 18
SALES_WINDOW_MONTHS = 12
ABC_BREAKS = (0.80, 0.95)
XYZ_BREAKS = (0.35, 0.80)
FSN_BREAKS = (2.0, 6.0)
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
ELIGIBLE_UNITS = ("BLS",)
ELIGIBLE_ABC = ("A", "B", "C")
ELIGIBLE_XYZ = ("X", "Y", "Z")
ELIGIBLE_FSN = ("F", "S")
STAMP_TIME_ZONE = "America/Lima"


@dataclass(frozen=True)
class Params:
    """Everything a monthly run needs besides the tables and the as-of date."""

    product_class: str = "CEMENT"
    companies: tuple[str, ...] = ("6012", "6052")
    segment_window: int = SEGMENT_WINDOW_MONTHS
    history_months: int = HISTORY_MONTHS
    horizon: int = HORIZON_MONTHS
    sales_window: int = SALES_WINDOW_MONTHS
    abc_breaks: tuple[float, float] = ABC_BREAKS
    xyz_breaks: tuple[float, float] = XYZ_BREAKS
    fsn_breaks: tuple[float, float] = FSN_BREAKS
    quantiles: tuple[float, ...] = QUANTILES
    eligible_units: tuple[str, ...] = ELIGIBLE_UNITS
    eligible_abc: tuple[str, ...] = ELIGIBLE_ABC
    eligible_xyz: tuple[str, ...] = ELIGIBLE_XYZ
    eligible_fsn: tuple[str, ...] = ELIGIBLE_FSN
    stamp_time_zone: str = STAMP_TIME_ZONE
    # model_type labels written into the forecast table
    label_model: str = "SEASONAL QUANTILE"
    label_regression: str = "QUANTILE REGRESSION"
    label_user: str = "CUSTOM MODEL"
    label_moving_average: str = "MOVING AVERAGE"
    label_zero: str = "ZERO PROJECTION"
    # column-name prefix of the segment columns; empty -> quantity column name
    segment_prefix: str = ""
    # shares of the scanned rows above which a run is refused
    max_null_keys: float = 0.01
    max_bad_quantities: float = 0.25
    extra_filters: dict = field(default_factory=dict)

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    def filters(self) -> dict[str, tuple]:
        """Column -> allowed values applied to the scanned demand."""
        f = {"product_class": (self.product_class,), "company": tuple(self.companies)}
        f.update({k: tuple(v) for k, v in self.extra_filters.items()})
        return f


DEFAULT = Params()
