"""Command line: ``python -m activity_engine <step> --warehouse PATH [...]``.

Steps mirror the studied pipeline's run modes: ``init`` (calendar),
``ingest`` (a JSON payload folder or flat Parquet activity files),
``risk`` (score agent-days, upsert the snapshot), ``export`` (BI feeds) and
``all`` (ingest, risk, export). Run it with ``spark-submit`` so the cluster's
session settings (master, ``spark.checkpoint.dir``) apply; each step prints
its summary as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import uuid

from pyspark.sql import SparkSession

from activity_engine.config import CALENDAR_END, CALENDAR_START
from activity_engine.plans import pipeline as pl
from activity_engine.session import ensure_checkpoint_dir, ensure_session_conf
from activity_engine.sources.payload import Payload, read_activity_files, read_payload
from activity_engine.sources.sinks import export_warehouse
from activity_engine.sources.tables import Warehouse


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="activity_engine")
    p.add_argument("step", choices=["init", "ingest", "risk", "export", "all"])
    p.add_argument("--warehouse", required=True, help="warehouse root (shared storage)")
    p.add_argument("--payload", help="folder of JSON payload documents")
    p.add_argument("--activities", help="folder of flat Parquet activity files")
    p.add_argument("--dlq", help="dead-letter folder (default: <warehouse>/dead_letter)")
    p.add_argument("--export-dir", help="feed folder (default: <warehouse>/exports)")
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--run-id", default=None)
    p.add_argument("--start", default=CALENDAR_START)
    p.add_argument("--end", default=CALENDAR_END)
    p.add_argument("--gate", action="store_true", help="skip the load when DQ fails")
    p.add_argument("--incremental", action="store_true", help="only events after the watermark")
    return p.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> list[dict]:
    ensure_session_conf(spark)
    ensure_checkpoint_dir(spark)
    wh = Warehouse(spark, args.warehouse)
    out = []
    if args.step == "init":
        out.append({"step": "init", "dates_added": pl.init_warehouse(wh, args.start, args.end)})
    if args.step in ("ingest", "all"):
        if args.payload:
            payload = read_payload(spark, args.payload)
        elif args.activities:
            empty = spark.createDataFrame([], "agent_id string")
            acts = read_activity_files(spark, args.activities)
            payload = Payload(empty, empty, empty, acts)
        else:
            raise SystemExit("ingest needs --payload or --activities")
        if wh.read("dim_date") is None:
            pl.init_warehouse(wh, args.start, args.end)
        run_id = args.run_id or str(uuid.uuid4())
        dlq = args.dlq or f"{wh.root}/dead_letter"
        if args.payload:
            res = pl.run_pipeline(wh, payload, run_id, dlq, gate=args.gate,
                                  incremental=args.incremental)
        else:
            res = pl.ingest_activities(wh, payload.activities, run_id, dlq, gate=args.gate,
                                       incremental=args.incremental)
        out.append({"step": "ingest", **res})
    if args.step in ("risk", "all"):
        out.append({"step": "risk", **pl.run_risk_model(wh)})
    if args.step in ("export", "all"):
        target = args.export_dir or f"{wh.root}/exports"
        out.append({"step": "export", "tables": export_warehouse(wh, target, args.format)})
    return out


def main(argv=None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName("activity-engine").getOrCreate()
    for r in run(spark, args):
        print(json.dumps(r, default=str))


if __name__ == "__main__":
    main()
