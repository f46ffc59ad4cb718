"""Print the executed (AQE final) physical plan of registered queries.

usage: python tools/show_plans.py sf_dir query [query ...]

A name is a registered query, or ``table:<name>`` for an analysis query
over the final table written as parquet (partitioned by platform):
``table:filter_client``, ``table:daily_client_spend``, ``table:ctr_trends``.
Each query is run once (noop sink) so the adaptive plan is final, then its
plan is printed in a compact form: one line per operator, with the pushed
filters and read schema of every scan.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from adtrail.plans.registry import QUERIES  # noqa: E402
from adtrail.session import build_session  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|Aggregate|Scan|Union|Sort|Window|Limit|TakeOrdered|QueryStage|"
                  r"Reused|Expand|Generate|Filter|Project|AQEShuffleRead|WriteFiles)")


def compact(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if "== Initial Plan ==" in line:
            break
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", line)
        if "FileScan" in line:
            head = line.split(" Batched:")[0]
            head = head if len(head) < 140 else head[:137] + "...]"
            parts = [m.group(0) for m in re.finditer(r"(PartitionFilters|PushedFilters): \[[^\]]*\]", line)]
            line = head + " " + ", ".join(parts)
        out.append(line[:400])
    return "\n".join(out)


def table_queries(spark, sf_dir):
    from adtrail.operators import explore as X
    from adtrail.operators import reports as R
    from adtrail.plans.registry import FILTER_CLIENT, FILTER_RANGE, final_table
    from adtrail.session import checkpoint_path
    from adtrail.sinks import write_parquet
    from adtrail.sources.analytics import load_analytics
    path = checkpoint_path(spark, "plans-final")
    write_parquet(final_table(spark, sf_dir), path)
    t = load_analytics(spark, path)
    return {
        "table:filter_client": lambda: X.apply_filters(t, client=FILTER_CLIENT),
        "table:filter_platform_range": lambda: X.apply_filters(t, platform="google_ads",
                                                               date_range=FILTER_RANGE),
        "table:daily_client_spend": lambda: R.daily_client_spend(t),
        "table:ctr_trends": lambda: R.ctr_trends(t),
    }


def main() -> None:
    sf_dir = sys.argv[1]
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    tables = table_queries(spark, sf_dir) if any(n.startswith("table:") for n in sys.argv[2:]) else {}
    for name in sys.argv[2:]:
        df = tables[name]() if name.startswith("table:") else QUERIES[name](spark, sf_dir)
        df.collect() if name in ("preview", "channel_lift", "kpis", "summary_means") else \
            df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### {name}\n```\n{compact(plan)}\n```\n")


if __name__ == "__main__":
    main()
