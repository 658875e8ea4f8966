"""Readers: demand movements, the known-SKU list, stored outputs."""

from sackcast.sources.demand import (
    actuals_scan, demand_scan, load_known, read_demand, asof_months,
)
from sackcast.sources.fixtures import demand_from_tables, known_from_demand, load_tables

__all__ = [
    "actuals_scan", "demand_scan", "load_known", "read_demand", "asof_months",
    "demand_from_tables", "known_from_demand", "load_tables",
]
