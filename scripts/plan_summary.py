"""Summarise the physical plans of the headline queries (exchanges, broadcasts,
windows, pushed scan filters) into PLANS.md. Usage: python scripts/plan_summary.py [sf_dir]"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from sackcast import schemas as S  # noqa: E402
from sackcast.operators.features import lag_features  # noqa: E402
from sackcast.params import DEFAULT as P  # noqa: E402
from sackcast.plans.backfill import backfill_forecast, monthly_asof_dates  # noqa: E402
from sackcast.plans.monthly import forecast_month, prepared_panel, split_run  # noqa: E402
from sackcast.session import local_session  # noqa: E402
from sackcast.sources.fixtures import demand_from_tables, known_from_demand  # noqa: E402


def summarise(df) -> dict:
    """Distinct exchanges / broadcasts by plan id (a cached input's plan is printed
    under every scan of it, but keeps its ids)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    txt = buf.getvalue()
    shuffles, bcasts = {}, set()
    for m in re.finditer(r"Arguments: (hashpartitioning\(([^\n]*?)\)|rangepartitioning\(([^\n]*?)\)|SinglePartition)"
                         r"[^\n]*\[plan_id=(\d+)\]", txt):
        cols = m.group(2) or m.group(3) or ""
        cols = re.sub(r"#\d+L?", "", cols)
        cols = re.sub(r",\s*\d+$", "", cols)
        kind = m.group(1).split("(")[0]
        shuffles[m.group(4)] = f"{kind}({cols})" if cols else kind
    for m in re.finditer(r"Arguments: HashedRelationBroadcastMode[^\n]*\[plan_id=(\d+)\]", txt):
        bcasts.add(m.group(1))
    keys = sorted(set(shuffles.values()))
    return {
        "distinct exchanges": len(shuffles),
        "exchange keys": keys,
        "distinct broadcasts": len(bcasts),
        "pushed filters (lineitem)": sorted({f for f in re.findall(r"PushedFilters: (\[[^\n]*\])", txt) if "l_" in f}),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    asof = "2001-08-15"
    keys = list(S.PRODUCT_KEY)
    d = demand_from_tables(spark, sf)
    kn = known_from_demand(d)
    fr = split_run(prepared_panel(d, asof, P, keep_last=True), kn, P)
    plans = {
        "prepared_panel (S1+T2)": prepared_panel(d, asof, P),
        "segments (G4)": fr.segments,
        "lag_features (T3)": lag_features(fr.eligible.select(*keys, S.MONTH, S.QTY), P.horizon, keys),
        "full_forecast (T14)": forecast_month(d, kn, asof, P),
        "backfill_19 (T16)": backfill_forecast(d, kn, monthly_asof_dates(asof, 19), P),
    }
    out = ["# PLANS", "",
           "Generated by `python scripts/plan_summary.py`: initial AQE plans at sf0.01, counted by",
           "plan id (so the cached monthly table / panel count once), subqueries included.",
           "Broadcasts are AQE's choices for small sides (fixture dimensions, per-run one-row",
           "tables, segment table at this size); AQE re-decides them on runtime sizes.", ""]
    for name, df in plans.items():
        s = summarise(df)
        out.append(f"## {name}")
        for k, v in s.items():
            out.append(f"- {k}: {v}")
        out.append("")
    open(__file__.rsplit("/scripts/", 1)[0] + "/PLANS.md", "w").write("\n".join(out))
    print("\n".join(out))


if __name__ == "__main__":
    main()
