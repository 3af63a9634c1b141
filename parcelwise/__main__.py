"""Command line: the jobs a user runs day to day.

    python -m parcelwise ingest    --source CSV --landed PATH [--run-ts TS] [--date-format F ...] [--multi-line]
    python -m parcelwise load      --source CSV --target PATH --buckets N [--run-ts TS] [--date-format F ...] [--multi-line]
    python -m parcelwise transform --landed PATH --out BASE
    python -m parcelwise report    NAME|all --landed PATH [--out PATH] [--show N]
    python -m parcelwise run       --source CSV --base BASE --date YYYY-MM-DD [--database NAME] [--date-format F ...] [--multi-line]
    python -m parcelwise publish   --landed PATH --topic PATH [--format text|kafka] [--option k=v ...]
    python -m parcelwise stream    --topic PATH --sink PATH --checkpoint PATH [--dedup-buckets N]

Under spark-submit the session (master, executors, checkpoint folder) comes
from the submit configuration; the CLI only asks for it.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from parcelwise.operators import dedup as D
from parcelwise.operators import ingest as G
from parcelwise.operators import reports as R
from parcelwise.plans import pipeline as P
from parcelwise.session import ensure_checkpoint_dir
from parcelwise.sinks import writers as W
from parcelwise.sources import readers as SR
from parcelwise.streaming import ingest_stream as T2
from parcelwise.streaming import messages as T1


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="parcelwise")
    sub = parser.add_subparsers(dest="cmd", required=True)

    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--source", required=True)
    source.add_argument("--run-ts")
    source.add_argument("--date-format", action="append", default=[], help="tried after ISO dates, in order")
    source.add_argument("--multi-line", action="store_true", help="quoted line breaks belong to the field (files are not split)")

    p = sub.add_parser("load", parents=[source], help="source CSV merged into an incremental target, newest row per shipment")
    p.add_argument("--target", required=True)
    p.add_argument("--buckets", type=int, required=True)

    p = sub.add_parser("ingest", parents=[source], help="source CSV -> typed rows -> date-partitioned landing")
    p.add_argument("--landed", required=True)
    p.add_argument("--dynamic", action="store_true", help="replace only the dates present")

    p = sub.add_parser("transform", help="landed rows -> warehouse/route/category KPI outputs")
    p.add_argument("--landed", required=True)
    p.add_argument("--out", required=True)

    p = sub.add_parser("report", help="one analytical report (or 'all', from one scan) over the landed rows")
    p.add_argument("name", choices=sorted(R.KEYS) + ["all"])
    p.add_argument("--landed", required=True)
    p.add_argument("--out")
    p.add_argument("--show", type=int, default=0)

    p = sub.add_parser("run", parents=[source], help="validate -> ingest -> transform -> verify -> (publish) -> summary")
    p.add_argument("--base", required=True)
    p.add_argument("--date", required=True)
    p.add_argument("--database", help="publish the KPI outputs to this database's tables")

    p = sub.add_parser("publish", help="landed rows -> one JSON message per row")
    p.add_argument("--landed", required=True)
    p.add_argument("--topic", required=True)
    p.add_argument("--format", default="text")
    p.add_argument("--option", action="append", default=[])

    p = sub.add_parser("stream", help="messages -> typed events appended to a Parquet table")
    p.add_argument("--topic", required=True)
    p.add_argument("--sink", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--format", default="text")
    p.add_argument("--dedup-buckets", type=int)
    p.add_argument("--processing-time", help="run continuously with this trigger instead of once")
    p.add_argument("--option", action="append", default=[])

    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"parcelwise-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)

    if args.cmd in ("ingest", "load"):
        text = SR.read_source_csv(spark, args.source, multi_line=args.multi_line)
        raw = G.ingest(text, run_ts=args.run_ts, date_formats=tuple(args.date_format))
    if args.cmd == "load":
        D.merge_latest(raw, args.target, args.buckets)
    elif args.cmd == "ingest":
        rows, obs = G.observed(raw, "landed")
        W.land_partitioned(rows, args.landed, dynamic=args.dynamic)
        print(json.dumps({"landed_rows": obs.get["rows"]}))
    elif args.cmd == "transform":
        print(json.dumps(P.transform_step(spark, args.landed, P.output_paths(args.out))))
    elif args.cmd == "report" and args.name == "all":
        if not args.out:
            parser.error("report all needs --out (a folder for the five outputs)")
        print(json.dumps(P.reports_step(spark, args.landed, args.out)))
    elif args.cmd == "report":
        df = R.report(SR.read_landed(spark, args.landed), args.name)
        if args.out:
            W.write_output(df, args.out)
        if args.show:
            df.show(args.show, truncate=False)
    elif args.cmd == "run":
        result = P.run_pipeline(spark, args.source, args.base, args.date, run_ts=args.run_ts, date_formats=tuple(args.date_format),
                                multi_line=args.multi_line, database=args.database)
        print(json.dumps({"status": result.status, "source_rows": result.source_rows,
                          "landed_rows": result.landed_rows, "clean_rows": result.clean_rows,
                          "outputs": result.output_rows, "seconds": result.step_seconds}))
    elif args.cmd == "publish":
        T1.publish(SR.read_landed(spark, args.landed), args.topic, fmt=args.format, **_options(args.option))
    elif args.cmd == "stream":
        query = T2.start_ingest(spark, args.topic, args.sink, args.checkpoint, fmt=args.format,
                                dedup_buckets=args.dedup_buckets, available_now=not args.processing_time,
                                processing_time=args.processing_time, **_options(args.option))
        query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
