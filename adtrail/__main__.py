"""Command line: run the batch or the file-arrival refresh.

    python -m adtrail batch   --raw-dir data/raw --out data/processed/final --reports data/reports
    python -m adtrail refresh --landing-dir data/landing --work-dir data/work --out data/processed/v2

``batch`` reads the six exports from one folder under their usual names
(``facebook_ads.jsonl`` with ``--json-lines``);
``refresh`` watches one sub-folder per source (``<landing>/<source>/``)
and recomputes from everything landed so far. ``--format table`` replaces
a catalog table instead of writing a parquet folder.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from adtrail import schemas as S

# fixed values: raw export file names inside the raw folder
RAW_FILES = {
    S.GOOGLE_ADS: "google_ads.csv",
    S.FACEBOOK_ADS: "facebook_ads.json",
    S.EMAIL_CAMPAIGNS: "email_campaigns.csv",
    S.WEB_TRAFFIC: "web_traffic.csv",
    S.CLIENTS: "clients.csv",
    S.REVENUE: "revenue.csv",
}


def _output(args) -> dict:
    if args.format == "table":
        return {"table": {"save": True, "table": args.table}}
    return {"parquet": {"save": True, "path": args.out}}


def main(argv: list[str] | None = None, spark=None) -> dict | None:
    p = argparse.ArgumentParser(prog="adtrail")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("batch", help="ingest -> transform -> save -> reports")
    b.add_argument("--raw-dir", required=True)
    b.add_argument("--csv-multiline", action="store_true",
                   help="CSV exports contain quoted line breaks (one task per file)")
    r = sub.add_parser("refresh", help="land new files, then recompute")
    r.add_argument("--landing-dir", required=True)
    r.add_argument("--work-dir", required=True)
    r.add_argument("--checkpoint-dir", default=None)
    for q in (b, r):
        q.add_argument("--out", default=None, help="parquet folder of the final table")
        q.add_argument("--format", choices=["parquet", "table"], default="parquet")
        q.add_argument("--table", default=S.FINAL_TABLE)
        q.add_argument("--reports", default=None, help="folder for report CSVs")
        q.add_argument("--salt-buckets", type=int, default=0)
        q.add_argument("--date-format", default=None,
                       help="date layout of the exports, e.g. dd.MM.yyyy (default: ISO and common layouts)")
        q.add_argument("--json-lines", action="store_true",
                       help="the facebook export is JSON Lines (splittable) instead of a JSON array")
    args = p.parse_args(argv)
    if args.format == "parquet" and not args.out:
        p.error("--out is required with --format parquet")

    if spark is None:
        from adtrail.session import build_session
        spark = build_session()
    if args.command == "batch":
        from adtrail.plans.batch import run_batch
        paths = {src: os.path.join(args.raw_dir, name) for src, name in RAW_FILES.items()}
        if args.json_lines:
            paths[S.FACEBOOK_ADS] = os.path.join(args.raw_dir, "facebook_ads.jsonl")
        options = {src: {"multiline": args.csv_multiline, "date_format": args.date_format}
                   for src in RAW_FILES if src != S.FACEBOOK_ADS}
        options[S.FACEBOOK_ADS] = {"json_lines": args.json_lines, "date_format": args.date_format}
        written = run_batch(spark, paths, _output(args), args.reports or os.path.join(args.raw_dir, "reports"),
                            read_options=options, salt_buckets=args.salt_buckets)
    else:
        from adtrail.streaming.refresh import refresh
        landing = {src: os.path.join(args.landing_dir, src) for src in RAW_FILES
                   if os.path.isdir(os.path.join(args.landing_dir, src)) or "://" in args.landing_dir}
        written = refresh(spark, landing, args.work_dir, _output(args), args.reports,
                          args.checkpoint_dir, salt_buckets=args.salt_buckets, json_lines=args.json_lines,
                          date_format=args.date_format)
    print(json.dumps({"written": written}))
    return written


if __name__ == "__main__":
    sys.exit(0 if main() is not None else 1)
