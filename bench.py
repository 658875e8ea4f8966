"""Bench: headline operators on $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints one JSON line. Each query is run to completion into
Spark's no-op sink (full execution, nothing collected). One untimed pass over
all queries warms the JVM (JIT, code generation); the cache is cleared before
every timed query, so each timing includes its own scan and panel."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sackcast.session import local_session  # noqa: E402


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), app="sackcast-bench")

    from sackcast.params import DEFAULT as P
    from sackcast.operators.features import lag_features
    from sackcast.operators.forecast import moving_average_forecast
    from sackcast.operators.skus import recent_sales_split
    from sackcast.plans.backfill import backfill_forecast, monthly_asof_dates
    from sackcast.plans.monthly import forecast_month, prepared_panel, split_run
    from sackcast.sources.fixtures import demand_from_tables, known_from_demand
    from sackcast import schemas as S

    asof = "2001-08-15"
    keys = list(S.PRODUCT_KEY)

    def demand():
        return demand_from_tables(spark, sf)

    def panel():
        return prepared_panel(demand(), asof, P)

    def segments():
        d = demand()
        return split_run(prepared_panel(d, asof, P, keep_last=True), known_from_demand(d), P).segments

    def lags():
        d = demand()
        el = split_run(prepared_panel(d, asof, P, keep_last=True), known_from_demand(d), P).eligible
        return lag_features(el.select(*keys, S.MONTH, S.QTY), P.horizon, keys)

    def moving_average():
        d = demand()
        ne = split_run(prepared_panel(d, asof, P, keep_last=True), known_from_demand(d), P).not_eligible
        with_s, _ = recent_sales_split(ne, P.sales_window, keys)
        return moving_average_forecast(with_s, P.horizon, P.sales_window, keys)

    def full_forecast():
        d = demand()
        return forecast_month(d, known_from_demand(d), asof, P)

    def backfill_19():
        d = demand()
        return backfill_forecast(d, known_from_demand(d), monthly_asof_dates(asof, 19), P)

    qs = {
        "prepared_panel": panel,
        "segmentation": segments,
        "lag_features": lags,
        "moving_average": moving_average,
        "full_forecast": full_forecast,
        "backfill_19": backfill_19,
    }
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    if only:
        qs = {k: v for k, v in qs.items() if k in only}

    def run(fn):
        fn().write.format("noop").mode("overwrite").save()

    for fn in qs.values():          # warm-up pass, untimed
        run(fn)
    times = {}
    for name, fn in qs.items():
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        run(fn)
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({
        "metric": "sum_of_headline_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
