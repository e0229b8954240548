"""Command line of the jobs, for spark-submit.

    spark-submit run_job.py features --processed P --features F --reports R --hours 24
"""

from __future__ import annotations

import argparse
from datetime import datetime

from freshhaul.models.classifier import score
from freshhaul.models.explain import explain
from freshhaul.plans.features import feature_build
from freshhaul.plans.readings import reprocess
from freshhaul.plans.recovery import recover
from freshhaul.plans.report import daily_report
from freshhaul.plans.serving import serving_views, write_views
from freshhaul.plans.sync import sync_alerts, sync_fleet
from freshhaul.plans.training import (
    gate_registry,
    production_classifier,
    production_shelf_life,
    train_and_gate,
)
from freshhaul.reference import (
    ALERT_LOOKBACK_HOURS,
    FLEET_LOOKBACK_HOURS,
    HISTORY_RETAIN_HOURS,
    TRIGGER,
)
from freshhaul.session import build_session
from freshhaul.sinks.tables import read_history, read_log, read_snapshot
from freshhaul.sources.files import read_readings_csv, read_zone
from freshhaul.sources.kafka import read_kafka
from freshhaul.streaming.one_read import start_zones
from freshhaul.streaming.pipeline import await_any, stream_pipeline


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--scratch", help="shared folder for intermediate tables")
    parser.add_argument("--now", type=datetime.fromisoformat, help="run time, default: the clock")
    jobs = parser.add_subparsers(dest="job", required=True)

    stream = jobs.add_parser("stream", help="messages to raw, processed and alert zones")
    for name in ("--servers", "--topic", "--raw", "--processed", "--alerts", "--checkpoints"):
        stream.add_argument(name, required=True)
    stream.add_argument("--every", default=TRIGGER)
    stream.add_argument("--max-per-trigger", type=int, help="messages of a batch, default: all")
    stream.add_argument("--starting", default="latest", help="offsets of the first start")
    stream.add_argument("--skip-lost", action="store_true", help="go on past expired messages")
    stream.add_argument("--model", help="training output whose production model scores")
    stream.add_argument(
        "--own-alerts", action="store_true", help="derive alerts from messages, not from the zone"
    )
    stream.add_argument("--recent", help="table of the last readings of each truck to keep")
    stream.add_argument("--console", action="store_true")
    stream.add_argument(
        "--one-read", action="store_true", help="one query writes all zones, a folder for each batch"
    )

    features = jobs.add_parser("features", help="hourly feature table and reports")
    for name in ("--processed", "--features", "--reports"):
        features.add_argument(name, required=True)
    features.add_argument("--hours", type=float, default=24)
    features.add_argument("--fallback-csv")
    features.add_argument("--runs")

    alerts = jobs.add_parser("alerts", help="sync new alerts")
    for name in ("--alerts", "--table"):
        alerts.add_argument(name, required=True)
    alerts.add_argument("--hours", type=float, default=ALERT_LOOKBACK_HOURS)

    fleet = jobs.add_parser("fleet", help="sync fleet state and sensor history")
    for name in ("--processed", "--fleet", "--history"):
        fleet.add_argument(name, required=True)
    fleet.add_argument("--hours", type=float, default=FLEET_LOOKBACK_HOURS)
    fleet.add_argument(
        "--rewrite-cutoff", action="store_true", help="rewrite the day that the retention bound cuts"
    )

    report = jobs.add_parser("report", help="daily summary of the feature table")
    for name in ("--features", "--runs"):
        report.add_argument(name, required=True)

    train = jobs.add_parser("train", help="train, measure, register and gate the models")
    train.add_argument("--out", required=True)
    source = train.add_mutually_exclusive_group(required=True)
    source.add_argument("--csv")
    source.add_argument("--processed")

    scoring = jobs.add_parser("score", help="classify the readings of a zone with the production model")
    for name in ("--processed", "--models", "--out"):
        scoring.add_argument(name, required=True)
    scoring.add_argument("--explain", help="folder for what each input adds to each score")

    views = jobs.add_parser("views", help="the dashboard's tables, one folder each")
    for name in ("--fleet", "--history", "--alerts", "--metrics", "--recent", "--truck", "--out"):
        views.add_argument(name, required=True)
    views.add_argument("--models", help="training output whose shelf-life model is in production")

    late = jobs.add_parser("recover", help="processed rows that came too late for the stream")
    for name in ("--raw", "--processed", "--late"):
        late.add_argument(name, required=True)

    gate = jobs.add_parser("gate", help="run the promotion gate over the stored registry")
    gate.add_argument("--models", required=True)

    again = jobs.add_parser("reprocess", help="processed rows from the landed raw messages")
    for name in ("--raw", "--out"):
        again.add_argument(name, required=True)
    return parser.parse_args()


def main() -> None:
    args = arguments()
    shared = {"spark.checkpoint.dir": args.scratch} if args.scratch else {}
    spark = build_session(f"freshhaul-{args.job}", **shared)
    now = args.now or datetime.now()
    if args.job == "stream":
        source = read_kafka(
            spark,
            args.servers,
            args.topic,
            starting=args.starting,
            max_per_trigger=args.max_per_trigger,
            fail_on_data_loss=not args.skip_lost,
        )
        model = production_classifier(spark, args.model) if args.model else None
        names = ("raw", "processed", "alerts", "checkpoints", "recent")
        paths = {n: getattr(args, n) for n in names if getattr(args, n)}
        if args.one_read:
            if args.recent or args.console or args.own_alerts:
                raise SystemExit("--one-read goes without --recent, --console and --own-alerts")
            zones = start_zones(source, paths, trigger={"processingTime": args.every}, model=model)
            await_any(spark, {"zones": zones})
            return
        await_any(
            spark,
            stream_pipeline(
                source,
                paths,
                trigger={"processingTime": args.every},
                console=args.console,
                chain_alerts=not args.own_alerts,
                model=model,
            ),
        )
        return
    if args.job == "features":
        result = feature_build(
            spark, args.processed, args.features, args.reports, now, args.hours,
            args.fallback_csv, args.runs,
        )
    elif args.job == "alerts":
        result = {"inserted": sync_alerts(spark, args.alerts, args.table, now, args.hours)}
    elif args.job == "fleet":
        result = sync_fleet(
            spark, args.processed, args.fleet, args.history, now, args.hours,
            rewrite_cutoff=args.rewrite_cutoff,
        )
    elif args.job == "report":
        result = daily_report(spark, args.features, args.runs, now)
    elif args.job == "score":
        model = production_classifier(spark, args.models)
        if model is None:
            raise SystemExit("no classifier is in production")
        zone = read_zone(spark, args.processed)
        score(zone, model).write.mode("overwrite").parquet(args.out)
        result = {"scored": args.out}
        if args.explain:
            explain(zone, model).write.mode("overwrite").parquet(args.explain)
            result["explained"] = args.explain
    elif args.job == "views":
        result = write_views(
            serving_views(
                read_snapshot(spark, args.fleet, "fleet_status"),
                read_history(spark, args.history, now, HISTORY_RETAIN_HOURS),
                read_log(spark, args.alerts, "alerts"),
                read_log(spark, args.metrics, "model_metrics"),
                now,
                args.truck,
                recent=read_snapshot(spark, args.recent, "recent_readings"),
                fitted=production_shelf_life(spark, args.models) if args.models else None,
            ),
            args.out,
        )
    elif args.job == "recover":
        result = {"recovered": recover(spark, args.raw, args.processed, args.late)}
    elif args.job == "gate":
        result = gate_registry(spark, f"{args.models}/registry")
    elif args.job == "reprocess":
        reprocess(read_zone(spark, args.raw)).write.mode("overwrite").parquet(args.out)
        result = {"processed": args.out}
    else:
        rows = read_readings_csv(spark, args.csv) if args.csv else read_zone(spark, args.processed)
        result = train_and_gate(spark, rows, args.out, now)
    print(result)
    spark.stop()


if __name__ == "__main__":
    main()
