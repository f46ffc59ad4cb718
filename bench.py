"""Benchmark: the batch and its queries on the driver tables.

Prints one JSON line:
{"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

* ``etl_final_table``  raw sources -> cleaned, stacked, joined, metrics,
                        attribution -> parquet partitioned by platform
* ``report_*`` / ``dash_*`` / ``lift``  read the written table back (the
                        reference's analysis path)
* ``analyze_write_reports``  the whole analysis step: load, four report CSVs
                        and the lift CSV written
* ``raw_*``            registered queries recomputed from the driver tables
                        (``raw_stream_*``: file stream -> landing -> aggregate)

Each timing is the median of ``BENCH_REPEAT`` warm runs (default 3) after
one untimed warm-up run; the ETL's first (cold) run is also reported as
``etl_final_table_cold``. A run is an action that computes every row
(``noop`` sink, or the parquet write for the ETL).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adtrail.operators import explore as X  # noqa: E402
from adtrail.operators import reports as R  # noqa: E402
from adtrail.operators.lift import channel_lift  # noqa: E402
from adtrail.plans.batch import analyze, transform_sources  # noqa: E402
from adtrail.plans.registry import QUERIES  # noqa: E402
from adtrail.sinks import write_parquet  # noqa: E402
from adtrail.session import build_session, checkpoint_root  # noqa: E402
from adtrail.sources.analytics import load_analytics  # noqa: E402
from adtrail.sources.bindings import ingested_sources  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


VERBOSE = os.environ.get("BENCH_VERBOSE") == "1"


def _time(fn, repeat: int, warmup: int = 1, name: str = "") -> float:
    for _ in range(warmup):
        fn()
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    if VERBOSE:
        print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    return round(statistics.median(runs), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app_name="adtrail-bench",
                          conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    root = checkpoint_root(spark)
    scratch = tempfile.mkdtemp(prefix="bench-", dir=root) if "://" not in root else f"{root}/bench-{int(time.time())}"
    out = {}

    # warm the JVM (class loading, codegen caches) outside the timings
    _run(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())

    counter = iter(range(10**6))

    def etl():
        final = transform_sources(ingested_sources(spark, sf_dir))
        write_parquet(final, f"{scratch}/final_{next(counter)}")

    out["etl_final_table_cold"] = _time(etl, 1, warmup=0, name="etl_cold")
    out["etl_final_table"] = _time(etl, repeat, warmup=0, name="etl")
    last = max(int(m.group(1)) for m in
               (re.match(r"final_(\d+)$", p) for p in os.listdir(scratch)) if m) if "://" not in scratch else 0
    final = load_analytics(spark, f"{scratch}/final_{last}", "parquet")

    analysis = {
        "report_daily_client_spend": lambda: R.daily_client_spend(final),
        "report_clicks_by_platform": lambda: R.clicks_by_platform(final),
        "report_ctr_trends": lambda: R.ctr_trends(final),
        "report_campaign_summary": lambda: R.campaign_summary(final),
        "lift": lambda: channel_lift(final),
        "dash_kpis": lambda: X.key_totals(final),
        "dash_spend_by_platform": lambda: X.spend_by_platform(final),
        "dash_clicks_over_time": lambda: X.clicks_over_time(final),
        "dash_ctr_by_platform": lambda: X.ctr_by_platform(final),
        "dash_web_daily": lambda: X.web_daily(final),
        "dash_revenue_over_time": lambda: X.revenue_over_time(final),
        "dash_date_bounds": lambda: X.date_bounds(final),
        "dash_filter_platform_range": lambda: X.apply_filters(
            final, platform="google_ads", date_range=("1997-01-01", "1997-12-31")),
        "dash_preview": lambda: X.preview(final),
    }
    for name, build in analysis.items():
        out[name] = _time(lambda b=build: _run(b()), repeat, name=name)

    written = {"format": "parquet", "path": f"{scratch}/final_{last}"}
    out["analyze_write_reports"] = _time(
        lambda: analyze(spark, written, f"{scratch}/reports_{next(counter)}"), repeat, name="analyze")

    for name in ["ctr_trends", "attribution", "summary_means", "channel_lift",
                 "daily_client_spend", "parse_quality", "campaigns_per_client",
                 "stream_revenue_daily", "stream_web_daily"]:
        out[f"raw_{name}"] = _time(lambda n=name: _run(QUERIES[n](spark, sf_dir)), repeat, name=name)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    warm = {k: v for k, v in out.items() if not k.endswith("_cold")}
    print(json.dumps({"metric": "total_warm_median_sec", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": out, "sf": float(sf.group(1)) if sf else sf_dir}))


if __name__ == "__main__":
    main()
