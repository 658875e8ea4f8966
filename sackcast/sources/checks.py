"""Checks of a run's input while it is read (S2, S4, S6): metrics observed on the run's own
scan, so no job probes the table beforehand."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sackcast import schemas as S
from sackcast.functions import month_index
from sackcast.params import Params
from sackcast.sources.demand import asof_months, demand_scan


class BrokenInput(ValueError):
    """The demand of a run can't be used."""


class ScanCheck:
    """Counts what a run's scan reads: rows, rows with a NULL key, quantities that are missing or
    not finite, rows of companies the run leaves out, months with rows."""

    def __init__(self, asof, p: Params):
        self.asof, self.p, self.seen = asof, p, Observation()
        self._first = asof_months(asof)["prev"]
        self._months = min(p.history_months + 1, 62)   # one bit a month

    def watch(self, demand: DataFrame) -> DataFrame:
        """The run's part of ``demand`` (S1), observed. Date range and class reach the files as before."""
        scan = demand_scan(demand, self.asof, self.p).select(*S.PRODUCT_KEY, S.DATE, S.QTY)
        null_key = F.lit(False)
        for k in S.PRODUCT_KEY:
            null_key = null_key | F.col(k).isNull()
        qty = F.col(S.QTY).cast("double")
        back = F.lit(self._first.year * 12 + self._first.month - 1) - month_index(S.DATE)
        bit = F.when((back >= 0) & (back < self._months), F.expr("1L")).otherwise(F.expr("0L"))
        return scan.observe(
            self.seen, F.count(F.lit(1)).alias("rows"), F.count_if(null_key).alias("null_keys"),
            F.count_if(qty.isNull() | F.isnan(qty) | (F.abs(qty) == float("inf"))).alias("bad_quantities"),
            F.count_if(~F.coalesce(F.col(S.COMPANY).isin(*self.p.companies), F.lit(False))).alias("other_companies"),
            F.bit_or(bit * F.pow(F.lit(2.0), F.greatest(F.least(back, F.lit(62)), F.lit(0))).cast("long")).alias("month_bits"))

    def report(self) -> dict:
        """The metrics, once the scan has run: counts, ``months`` with rows and whether the last one has any."""
        try:
            found = dict(self.seen.get)
        except Py4JJavaError:   # an input that Spark proves empty is not scanned, and nothing is observed
            found = {"rows": 0, "null_keys": 0, "bad_quantities": 0, "other_companies": 0}
        bits = found.pop("month_bits", None) or 0
        return found | {"months": bin(bits).count("1"), "has_last_month": bool(bits & 1)}

    def enforce(self) -> dict:
        """The report; raises ``BrokenInput`` where a larger share of rows than allowed has no key or no quantity."""
        found = self.report()
        for name, most in (("null_keys", self.p.max_null_keys), ("bad_quantities", self.p.max_bad_quantities)):
            if found["rows"] and found[name] > most * found["rows"]:
                raise BrokenInput(f"{found[name]} of {found['rows']} demand rows: {name} (at most a share of {most} is accepted)")
        return found
