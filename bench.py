"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set below).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.

The shipment source is joined and landed once (``source_join``, timed); the
operators then run over the landed rows, as a daily job's do. Sinks, streams
and the daily run are timed as registered. Each query runs to completion
through the ``noop`` sink. A warm-up on the smallest scale runs first so that
JVM start-up is not charged to a query, and what a query wrote is deleted
after it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelwise.operators import clean as C  # noqa: E402
from parcelwise.operators import dedup as D  # noqa: E402
from parcelwise.operators import kpis as A  # noqa: E402
from parcelwise.operators import reports as R  # noqa: E402
from parcelwise.plans import registry as Rg  # noqa: E402
from parcelwise.session import build_session, delete_path, ensure_checkpoint_dir, shared_path  # noqa: E402
from parcelwise.sinks import writers as W  # noqa: E402
from parcelwise.sources import readers as SR  # noqa: E402

# operator over the landed rows, by the name of the registered query
OVER_LANDED = {
    "clean_shipments": C.clean,
    "warehouse_kpis": lambda raw: A.warehouse_kpis(C.clean(raw)),
    "route_kpis": lambda raw: A.route_kpis(C.clean(raw)),
    "category_kpis": lambda raw: A.category_kpis(C.clean(raw)),
    "category_kpis_monthly": lambda raw: A.category_kpis_monthly(C.clean(raw)),
    "warehouse_kpis_strict": A.warehouse_kpis_strict,
    "report_on_time_by_warehouse": R.on_time_by_warehouse,
    "report_high_risk_routes": R.high_risk_routes,
    "report_rating_distribution": R.rating_distribution,
    "report_monthly_volume": R.monthly_volume,
    "report_rolling_delay": R.rolling_delay,
    "dedup_latest": D.latest_per_key,
}
WHOLE = ["ingest_raw", "incremental_dedup", "incremental_upsert", "partitioned_overwrite", "stream_ingest", "quality_report"]
HEADLINE = ["source_join", *OVER_LANDED, *WHOLE]


def finish(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="parcelwise-bench")
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        finish(Rg.QUERIES["warehouse_kpis"](spark, warm))
    timings = {}

    def timed(name: str, job) -> None:
        t0 = time.perf_counter()
        job()
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {timings[name]:.2f}s", file=sys.stderr)

    landed = shared_path(spark, "bench")
    land = lambda: W.land_raw(Rg.raw_shipments(spark, sf_dir), landed)
    if "source_join" in names:
        timed("source_join", land)
    else:
        land()
    raw = SR.read_landed(spark, landed)
    for name in names:
        if name in OVER_LANDED:
            timed(name, lambda name=name: finish(OVER_LANDED[name](raw)))
        elif name in Rg.QUERIES:
            timed(name, lambda name=name: finish(Rg.QUERIES[name](spark, sf_dir)))
    delete_path(spark, f"{ensure_checkpoint_dir(spark)}/parcelwise")
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
