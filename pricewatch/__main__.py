"""Command line for the streaming jobs: one command per process of the
monitoring system, each a Structured Streaming query with its own checkpoint.

    python -m pricewatch normalize --responses DIR --tracked FILE --source seatgeek --out DIR ...
    python -m pricewatch detect    --events DIR --out DIR [--state-table]
    python -m pricewatch store     --events DIR --out DIR
    python -m pricewatch alerts    --alerts DIR --dimension DIR --out DIR
    python -m pricewatch thresholds --events DIR --rules FILE --out DIR
    python -m pricewatch retry     --out DIR
    python -m pricewatch compact   --out DIR
    python -m pricewatch retain    --out DIR [--as-of TIME]
    python -m pricewatch report    --store DIR --out DIR [--hours 48] [--event NAME]

Every command writes under ``--out`` (outputs, rejects, state, metrics) and
keeps its checkpoint in ``--out/_checkpoints/<command>``. Without
``--continuous`` a command processes what is there and stops (availableNow);
with it, it polls every ``--every`` seconds.
"""

from __future__ import annotations

import argparse
import sys

from pricewatch.session import get_spark


def _trigger(args):
    return {"processingTime": f"{args.every} seconds"} if args.continuous else None


def _paths(out: str, name: str) -> str:
    return f"{out.rstrip('/')}/{name}"


def normalize(args, spark):
    from pricewatch.sources.feeds import read_tracked_events
    from pricewatch.streaming import jobs
    tracked = read_tracked_events(spark, args.tracked)
    return jobs.start_normalizer(
        spark, args.responses, tracked, args.source, _paths(args.out, "price_events"),
        _paths(args.out, "listing_rejects"), _paths(args.out, "_checkpoints/normalize"),
        trigger=_trigger(args), max_files_per_trigger=args.max_files)


def _price_events(args, spark, rows=False):
    """A Kafka topic, the normalizer's feed by its log, or else JSON lines
    landed by others (or the feed's lines, where a job needs a stream of
    ``rows``); records that can't be read are tagged, not dropped."""
    from pricewatch.sources import dated, feeds
    if args.kafka:
        return feeds.read_kafka(spark, args.kafka, args.events, args.starting, args.max_offsets)
    if not rows and dated.is_feed(spark, args.events):
        return feeds.price_event_feed(args.events, args.max_files)
    return feeds.read_tagged_events(spark, args.events, stream=True, max_files_per_trigger=args.max_files)


def detect(args, spark):
    from pricewatch.operators.normalize import good_events
    from pricewatch.streaming import jobs
    common = dict(processed_path=_paths(args.out, "processed_prices"),
                  alerts_path=_paths(args.out, "price_alerts"), trigger=_trigger(args))
    rejects = _paths(args.out, "detect_rejects")
    if args.state_table:
        return jobs.start_detector_tables(
            _price_events(args, spark), state_path=_paths(args.out, "baselines"),
            checkpoint=_paths(args.out, "_checkpoints/detect_table"), rejects_path=rejects,
            base_path=_paths(args.out, "baselines_base"), baseline=args.baseline,
            compact_every=args.compact_every,
            metrics_path=_paths(args.out, "system_metrics_detect") if args.metrics else None, **common)
    lines = _price_events(args, spark, rows=True)
    if args.metrics:
        spark.streams.addListener(jobs.MetricsListener(spark, _paths(args.out, "system_metrics_detect")))
    return [jobs.start_detector(good_events(lines), checkpoint=_paths(args.out, "_checkpoints/detect"),
                                listing_ttl=args.listing_ttl, **common),
            jobs.start_rejects(lines, rejects, _paths(args.out, "_checkpoints/detect_rejects"),
                               trigger=_trigger(args))]


def store(args, spark):
    from pricewatch.streaming import jobs
    return jobs.start_storage(
        _price_events(args, spark), _paths(args.out, "price_history"), _paths(args.out, "price_rejects"),
        _paths(args.out, "events"), _paths(args.out, "_checkpoints/store"),
        trigger=_trigger(args), metrics_path=_paths(args.out, "system_metrics"),
        dimension_base_path=_paths(args.out, "events_base"), compact_every=args.compact_every)


def alerts(args, spark):
    from pricewatch.sources.dated import Feed
    from pricewatch.streaming import jobs
    return jobs.start_alert_store(
        Feed(args.alerts, max_batches=args.max_files), _paths(args.out, "price_drop_alerts"),
        _paths(args.out, "alert_rejects"),
        _paths(args.out, "notification_outbox"), _paths(args.out, "_checkpoints/alerts"),
        dimension_path=args.dimension, metrics_path=_paths(args.out, "system_metrics_alerts"),
        trigger=_trigger(args),
        dimension_base_path=f"{args.dimension.rstrip('/')}_base" if args.dimension else None)


def retry(args, spark):
    """Alerts of events that were unknown, once they are known."""
    from pricewatch import fixed
    from pricewatch.streaming import jobs
    return jobs.start_alert_retry(
        _paths(args.out, "alert_rejects"), _paths(args.out, "price_drop_alerts"), _paths(args.out, "price_history"),
        _paths(args.out, "events"), _paths(args.out, "alerts_waiting"), _paths(args.out, "_checkpoints/retry"),
        dimension_base_path=_paths(args.out, "events_base"), trigger=_trigger(args),
        keep_days=fixed.RETENTION_DAYS["price_alerts"])


def thresholds(args, spark):
    from pricewatch.streaming import jobs
    return jobs.start_thresholds(
        _price_events(args, spark), args.rules, _paths(args.out, "alert_triggers"),
        _paths(args.out, "rule_rejects"), _paths(args.out, "last_prices"),
        _paths(args.out, "_checkpoints/thresholds"), trigger=_trigger(args),
        base_path=_paths(args.out, "last_prices_base"), compact_every=args.compact_every)


def retain(args, spark):
    """The streams' retention: whole days go."""
    import datetime as dt

    from pricewatch.sources import store as stores
    as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else dt.datetime.now(dt.timezone.utc)
    print({name: stores.drop_expired(spark, args.out, name, stream, as_of)
           for name, stream in (("price_events", "raw_prices"), ("processed_prices", "processed_prices"),
                                ("price_alerts", "price_alerts"))})


def compact(args, spark):
    from pricewatch.operators.changes import LISTING_KEYS
    from pricewatch.streaming import jobs
    folds = {
        "events": lambda p, b: jobs.compact_dimension(spark, p, b),
        "baselines": lambda p, b: jobs.compact_baselines(spark, p, b, list(LISTING_KEYS), baseline=args.baseline),
        "last_prices": lambda p, b: jobs.compact_baselines(spark, p, b, list(LISTING_KEYS), baseline="previous"),
    }
    done = {name: fold(_paths(args.out, name), _paths(args.out, f"{name}_base")) for name, fold in folds.items()}
    print(done)
    return None


def report(args, spark):
    from pricewatch.plans.report import dashboard_report, write_report
    parts = dashboard_report(spark, args.store, hours=args.hours, event_name=args.event,
                             as_of=args.as_of)
    write_report(parts, args.out)
    return None


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pricewatch")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name, fn, *extra):
        s = sub.add_parser(name)
        s.add_argument("--out", required=True)
        s.add_argument("--continuous", action="store_true")
        s.add_argument("--every", type=int, default=10)
        s.add_argument("--max-files", type=int, default=None)
        s.add_argument("--compact-every", type=int, default=50)
        s.add_argument("--metrics", action="store_true")
        s.add_argument("--kafka", default=None, metavar="SERVERS",
                       help="--events is a topic of these servers")
        s.add_argument("--starting", choices=["earliest", "latest"],
                       default="earliest" if name == "store" else "latest")
        s.add_argument("--max-offsets", type=int, default=None)
        s.add_argument("--baseline", choices=["max", "previous"], default="max")
        for a in extra:
            s.add_argument(*a[0], **a[1])
        s.set_defaults(fn=fn)

    add("normalize", normalize, (["--responses"], {"required": True}),
        (["--tracked"], {"required": True}), (["--source"], {"default": "seatgeek"}))
    add("detect", detect, (["--events"], {"required": True}),
        (["--state-table"], {"action": "store_true"}), (["--listing-ttl"], {"default": None}))
    add("store", store, (["--events"], {"required": True}))
    add("alerts", alerts, (["--alerts"], {"required": True}), (["--dimension"], {"default": None}))
    add("thresholds", thresholds, (["--events"], {"required": True}), (["--rules"], {"required": True}))
    add("retry", retry)
    add("compact", compact)
    add("retain", retain, (["--as-of"], {"default": None}))
    add("report", report, (["--store"], {"required": True}),
        (["--hours"], {"type": int, "default": 48}), (["--event"], {"default": None}),
        (["--as-of"], {"default": None}))
    return p


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    spark = get_spark(args.master, streaming=args.command == "detect" and not args.state_table)
    started = args.fn(args, spark)
    for query in started if isinstance(started, list) else [started]:
        if query is not None:
            query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
