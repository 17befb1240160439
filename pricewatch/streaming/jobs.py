"""Streaming jobs: the detector with its two outputs, the storage side, the
dimension merge, throughput and progress metrics.

Every output is a feed of ``sources/dated``: rows by day and batch, written
once, with a log of finished batches, so a batch that is replayed after a
failure adds nothing to what readers have seen. State (baselines, the event
dimension) is kept as deltas by batch, which a replay overwrites with the same
rows. The checkpoint keeps source progress and detector state, so a restarted
query goes on where it stopped.

Where a job takes a stream of rows it also takes a ``Feed``, and then follows
the log of the job before it: batch by batch, finished ones only.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pricewatch.functions.columns import listing_key
from pricewatch.operators import changes, history, normalize
from pricewatch.operators.normalize import WIRE_REASON
from pricewatch.sources import dated, files
from pricewatch.sources.dated import Feed
from pricewatch.sources.feeds import read_responses, write_batch
from pricewatch.streaming import deltas
from pricewatch.streaming.detector import detect_changes_stream

LOG_ORDER = ("kafka_timestamp", "partition", "offset")
# Names of the observed metrics of the detector query.
DETECTOR_METRICS = "detector"


def observe_changes(classified: DataFrame, name: str = DETECTOR_METRICS) -> DataFrame:
    """Attach the detector's counters; they appear per micro-batch in
    ``query.lastProgress["observedMetrics"]``."""
    t = F.col("change_type")
    return classified.observe(
        name,
        F.count(F.lit(1)).alias("events_processed"),
        F.count_if(t.isin("drop", "increase")).alias("price_changes"),
        F.count_if(t == "drop").alias("price_drops"),
        F.count_if(t == "increase").alias("price_increases"),
        F.count_if(t == "same").alias("unchanged"),
        F.count_if(t == "new").alias("new_listings"),
        F.count_if(t == "invalid").alias("invalid_prices"),
        F.count_if(t == "error").alias("errors"))


class MetricsListener(StreamingQueryListener):
    """Writes what queries observe (``observe_changes`` and the other jobs'
    counters) as rows of the system-metrics feed at ``path``: a metric
    ``<observation>.<counter>`` for each counter of each finished micro-batch.
    Register it with ``spark.streams.addListener``. A row is stamped with the
    micro-batch's time and kept under the query's run and batch number; it's
    monitoring, and a driver that dies between a batch and its report loses
    that report."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = [(f"{name}.{counter}", Decimal(value), p.timestamp)
                 for name, row in (p.observedMetrics or {}).items()
                 for counter, value in row.asDict().items() if value is not None]
        if found:
            rows = self.spark.createDataFrame(found, "metric_name string, metric_value decimal(15,2), at string") \
                .select("metric_name", "metric_value", F.to_timestamp("at").alias("timestamp")).coalesce(1)
            rows.withColumn(dated.DAY, F.to_date("timestamp")) \
                .withColumn(dated.BATCH, F.lit(p.batchId)) \
                .write.mode("append").partitionBy(dated.DAY, dated.BATCH).parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _input(source: DataFrame | Feed, metric: str | None = None, name: str | None = None):
    """(stream, rows of its micro-batches) of a stream of rows or a feed; with
    ``metric`` the rows are observed under it, as ``name``."""
    if isinstance(source, Feed):
        stream, rows, count = source.entries(SparkSession.active()), source.rows, F.sum("rows")
    else:
        stream, rows, count = source, lambda batch: batch, F.count(F.lit(1))
    return stream.observe(metric, count.alias(name)) if metric else stream, rows


def order_of(events: DataFrame) -> tuple[str, ...]:
    """How records follow each other: by the log they came through, where they
    carry its columns, else by scrape time and listing id."""
    return LOG_ORDER if set(LOG_ORDER) <= set(events.columns) else changes.EVENT_ORDER


def _start(stream: DataFrame, process, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w.trigger(availableNow=True)).start()


def _day_of(rows: DataFrame) -> str | None:
    """The column whose day a record is stored under."""
    return next((c for c in ("timestamp", LOG_ORDER[0]) if c in rows.columns), None)


def start_detector(events: DataFrame, processed_path: str, alerts_path: str, checkpoint: str,
                   trigger: dict | None = None, keys=changes.LISTING_KEYS, price: str = "price",
                   order=None, listing_ttl: str | None = None,
                   buckets: int | None = None, engine: str = "pandas_state") -> StreamingQuery:
    """Every event goes to ``processed_path`` with its classification, drops
    also go to ``alerts_path`` as alerts. One state store, two outputs. Rows of
    a listing are taken in ``order`` (``order_of`` by default). With the price's
    text (``_raw_price``) a price that is no number is an ``error``."""
    order = list(order or order_of(events))
    raw = "_raw_price" if "_raw_price" in events.columns else None
    classified = observe_changes(detect_changes_stream(
        events, keys, price, order, buckets=buckets, listing_ttl=listing_ttl, raw_price=raw, engine=engine))

    def route(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            began = dated.begin(batch.sparkSession, processed_path, batch_id)
            shown = batch.drop("_raw_price", "_bad_number")
            drops = changes.drop_alerts(shown, price, alert_time=dated.at(began))
            dated.write(shown, processed_path, batch_id, _day_of(shown), began)
            dated.write(drops, alerts_path, batch_id, "alert_timestamp", began)
        finally:
            batch.unpersist()

    return _start(classified, route, checkpoint, trigger)


def start_rejects(tagged: DataFrame, rejects_path: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Records of ``normalize.tagged_wire`` that can't be read, with their
    text and reason: the reject side of a job whose own input is the good rows
    (the detector with its state in the state store)."""
    def route(batch: DataFrame, batch_id: int) -> None:
        bad = batch.where(F.col(WIRE_REASON).isNotNull()).select("_raw", F.col(WIRE_REASON).alias("reject_reason"))
        dated.write(bad, rejects_path, batch_id)

    return _start(tagged, route, checkpoint, trigger)


def _null_safe_semi(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_pw_r{i}") for i, k in enumerate(keys)]).distinct()
    cond = None
    for i, k in enumerate(keys):
        c = left[k].eqNullSafe(r[f"_pw_r{i}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left_semi")


def _fold_baselines(deltas: DataFrame, keys, baseline: str) -> DataFrame:
    """One row per listing: its baseline, and the batch and order of the
    row that set it (so folded rows fold again the same way)."""
    latest = F.max_by(F.struct("value", "batch_id", "last_order"),
                      F.struct("batch_id", "last_order"))
    if baseline == "max":
        best = F.max_by(F.struct("value", "batch_id", "last_order"),
                        F.struct("value", "batch_id", "last_order"))
        return deltas.groupBy(*keys).agg(best.alias("_f")).select(*keys, "_f.*")
    return deltas.groupBy(*keys).agg(latest.alias("_f")).select(*keys, "_f.*")


def read_baselines(spark: SparkSession, state_path: str, keys, baseline: str = "max",
                   before: int | None = None, base_path: str | None = None) -> DataFrame | None:
    """Each listing's baseline from the compacted base (when given) and the
    state deltas of batches before ``before``: the highest (``max``) or the
    latest (``previous``) value. None when no state has been written."""
    from pricewatch.operators.scan import SEED
    rows = deltas.rows(spark, state_path, base_path, before)
    if rows is None:
        return None
    if baseline == "max":
        # a plain max folds with a hash aggregation (no struct buffer to sort)
        return rows.groupBy(*keys).agg(F.max("value").alias(SEED))
    return _fold_baselines(rows, keys, baseline).select(*keys, F.col("value").alias(SEED))


def compact_baselines(spark: SparkSession, state_path: str, base_path: str, keys,
                      baseline: str = "max") -> int | None:
    """``deltas.compact`` of the detector's baselines (or, with
    ``baseline="previous"``, of last prices). Run it between micro-batches, or
    from a separate job with the query stopped."""
    return deltas.compact(spark, state_path, base_path, lambda rows: _fold_baselines(rows, keys, baseline))


def _compact_now(batch_id: int, every: int | None) -> bool:
    return bool(every) and batch_id % every == every - 1


def start_detector_tables(events: DataFrame | Feed, processed_path: str, alerts_path: str,
                          state_path: str, checkpoint: str, keys=changes.LISTING_KEYS,
                          price: str = "price", order=None,
                          baseline: str = "max", trigger: dict | None = None,
                          base_path: str | None = None,
                          rejects_path: str | None = None,
                          compact_every: int | None = None,
                          metrics_path: str | None = None) -> StreamingQuery:
    """The detector with its state kept as a table instead of in the state
    store. Each micro-batch runs the batch detector (JVM only, hot listings
    split as in batch), seeded with the baselines of the listings it
    touches; it then appends one state row per touched listing (its highest
    valid price in the batch, or its last one for ``baseline="previous"``)
    under its batch id. A batch reads only state of earlier batches, so a
    replayed batch reproduces its output and overwrites its own files.
    ``compact_baselines`` folds old deltas into a base at ``base_path``; with
    ``compact_every`` the job does so itself after each so many batches.

    Records of ``normalize.tagged_wire`` that can't be read go to
    ``rejects_path`` from the same parsed frame; the others are detected. A
    price that is no number is an ``error`` then."""
    from pricewatch.functions.columns import valid_price
    from pricewatch.operators import metrics
    keys, asked = list(keys), order
    stream, rows = _input(events)

    def process(entries: DataFrame, batch_id: int) -> None:
        spark = entries.sparkSession
        if all(dated.finished(spark, p, batch_id) for p in (processed_path, alerts_path)) \
                and files.exists(spark, f"{state_path.rstrip('/')}/batch_id={batch_id}/_SUCCESS"):
            return                          # a replay of a finished batch
        taken = rows(entries).persist()
        try:
            began = dated.begin(spark, processed_path, batch_id)
            batch, raw = taken, None
            if WIRE_REASON in taken.columns:
                batch = normalize.good_events(taken)
                raw = "_raw_price"
                if rejects_path is not None:
                    dated.write(taken.where(F.col(WIRE_REASON).isNotNull())
                                .select("_raw", F.col(WIRE_REASON).alias("reject_reason")),
                                rejects_path, batch_id, began=began)
            order = list(asked or order_of(batch))
            prior = read_baselines(spark, state_path, keys, baseline, before=batch_id,
                                   base_path=base_path)
            seed = None if prior is None else _null_safe_semi(prior, batch, keys)
            classified = changes.classify_changes(batch, keys, price, order, baseline=baseline,
                                                  seed=seed, raw_price=raw)
            classified = classified.persist()
            shown = classified.drop("_raw_price", "_bad_number")
            drops = changes.drop_alerts(shown, price, alert_time=dated.at(began))
            dated.write(shown, processed_path, batch_id, _day_of(shown), began)
            if metrics_path is not None:
                counted = changes.change_metrics(classified)
                counters = metrics.as_system_metrics(metrics.tall(counted), began.isoformat())
                dated.write(counters, metrics_path, batch_id, "timestamp", began)
            dated.write(drops, alerts_path, batch_id, "alert_timestamp", began)
            valid = batch.where(valid_price(price))
            last = F.struct(*[F.col(c) for c in order])
            delta = valid.groupBy(*keys).agg(
                (F.max(price) if baseline == "max" else F.max_by(price, last)).alias("value"),
                F.max(last).alias("last_order"))
            write_batch(delta, state_path, batch_id)
            if base_path and _compact_now(batch_id, compact_every):
                compact_baselines(spark, state_path, base_path, keys, baseline)
            classified.unpersist()
        finally:
            taken.unpersist()

    return _start(stream, process, checkpoint, trigger)


def start_normalizer(spark: SparkSession, responses_path: str, tracked: DataFrame, source: str,
                     out_path: str, rejects_path: str, checkpoint: str,
                     trigger: dict | None = None, max_files_per_trigger: int | None = None,
                     kafka_options: dict | None = None) -> StreamingQuery:
    """The producer side: landed API responses of one source are parsed by
    its adapter, joined to the tracked events and published as price-event
    JSON keyed by listing; listings that do not parse go to rejects. With
    ``kafka_options`` the events go to Kafka instead of JSON text files."""
    listings = read_responses(spark, responses_path, stream=True,
                              max_files_per_trigger=max_files_per_trigger)
    adapter = normalize.ADAPTERS[source]

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            began = dated.begin(batch.sparkSession, out_path, batch_id)
            good, rejects = adapter(batch, tracked, scrape_time=dated.at(began))
            wire = normalize.to_wire(good, key=listing_key(*changes.LISTING_KEYS))
            if kafka_options:
                wire.write.format("kafka").options(**kafka_options).save()
            else:
                dated.write(wire.select("value"), out_path, batch_id, began=began, fmt="text")
            dated.write(rejects, rejects_path, batch_id, began=began)
        finally:
            batch.unpersist()

    return _start(listings, publish, checkpoint, trigger)


STORAGE_METRICS = "storage"


def start_storage(events: DataFrame | Feed, history_path: str, rejects_path: str, dimension_path: str,
                  checkpoint: str, trigger: dict | None = None,
                  metrics_path: str | None = None,
                  dimension_base_path: str | None = None,
                  dedup_within: str | None = None,
                  compact_every: int | None = None) -> StreamingQuery:
    """The storage side: typed history and rejects by day, and the event
    dimension. Events come from records that meet all constraints
    (``history.tag_events``), so what history rejects is no event either. The
    dimension is kept as append-only deltas, one per batch (that batch's first
    sighting of each event), so a batch writes only what it saw;
    ``read_dimension`` folds the deltas (first write wins, ``last_updated`` is
    the latest). Records of ``normalize.tagged_wire`` that can't be read are
    rejects, too, with their text.

    Messages received are observed per micro-batch under ``storage``; with
    ``metrics_path`` every batch also writes its counters (received, stored,
    errors, events created) as system-metrics rows.

    ``dedup_within`` (e.g. ``"1 hour"``) skips a record whose (listing,
    scrape time) was already stored within that delay, across micro-batches
    (``dropDuplicatesWithinWatermark``, for a stream of rows); off by default,
    as in the source system, which stores every delivery."""
    from pricewatch.operators import metrics, validate
    if dedup_within is not None:
        events = (events.withWatermark("timestamp", dedup_within)
                  .dropDuplicatesWithinWatermark(["listing_id", "timestamp"]))
    stream, rows = _input(events, STORAGE_METRICS, "messages_received")

    def store(entries: DataFrame, batch_id: int) -> None:
        spark = entries.sparkSession
        began = dated.begin(spark, history_path, batch_id)
        taken = rows(entries)
        tagged = history.tag_events(taken, dated.at(began), [c for c in LOG_ORDER if c in taken.columns]).persist()
        try:
            reason = F.col(validate.REASON)
            good = tagged.where(reason.isNull())
            typed = good.drop("_raw", validate.REASON, validate.REASONS, *history.EVENT_ATTRS, *LOG_ORDER)
            if not dated.finished(spark, history_path, batch_id):
                write_batch(history.event_dimension(good, order=order_of(good)), dimension_path, batch_id)
            dated.write(typed, history_path, batch_id, "timestamp", began)
            dated.write(tagged.where(reason.isNotNull()), rejects_path, batch_id, began=began)
            if metrics_path is not None and not dated.finished(spark, metrics_path, batch_id):
                known = read_dimension(spark, dimension_path, dimension_base_path, before=batch_id)
                known = good.where(F.lit(False)) if known is None else known      # first batch
                created = history.new_events(good, known.select("event_id"))
                counters = metrics.as_system_metrics(metrics.ingest_metrics(tagged, created),
                                                     began.isoformat())
                dated.write(counters, metrics_path, batch_id, "timestamp", began)
            if dimension_base_path and _compact_now(batch_id, compact_every):
                compact_dimension(spark, dimension_path, dimension_base_path)
        finally:
            tagged.unpersist()

    return _start(stream, store, checkpoint, trigger)


ALERT_METRICS = "alerts"


def start_alert_store(alerts: DataFrame | Feed, stored_path: str, rejects_path: str, outbox_path: str,
                      checkpoint: str, dimension_path: str | None = None,
                      metrics_path: str | None = None, trigger: dict | None = None,
                      footer: str | None = None,
                      dimension_base_path: str | None = None) -> StreamingQuery:
    """The alert side: every alert's notification payload goes to the outbox
    (a sender posts them; nothing is sent from Spark), then the alert is
    stored with money as decimals. An alert whose event the dimension does
    not know is a reject (``unknown_event``): the alert path never creates
    events. Counters (processed, stored, errors) go to ``metrics_path`` as
    system-metrics rows."""
    from pricewatch.operators import metrics, notify
    stream, rows = _input(alerts, ALERT_METRICS, "alerts_processed")

    def store(entries: DataFrame, batch_id: int) -> None:
        spark = entries.sparkSession
        began = dated.begin(spark, stored_path, batch_id)
        batch = rows(entries).drop(dated.DAY, dated.BATCH).persist()
        try:
            payloads = notify.with_payload(batch, **({"footer": footer} if footer else {}))
            dated.write(payloads.select("event_id", "listing_id", "alert_timestamp", "payload"),
                        outbox_path, batch_id, "alert_timestamp", began)
            dim = None
            if dimension_path is not None:
                # A replay asks the dimension that the first try saw, else an
                # alert could be in neither output, or in both.
                through = int(dated.pinned(spark, stored_path, batch_id, "dimension", lambda: str(
                    deltas.newest_batch(spark, dimension_path, dimension_base_path))))
                dim = read_dimension(spark, dimension_path, dimension_base_path, before=through + 1)
                if dim is None:                # no dimension yet: every alert is unknown
                    dim = batch.where(F.lit(False))
                dim = dim.select("event_id")
            stored, rejects = history.store_alerts(batch, dim, dated.at(began))
            stored, rejects = stored.persist(), rejects.persist()
            dated.write(stored, stored_path, batch_id, "alert_timestamp", began)
            dated.write(rejects, rejects_path, batch_id, "alert_timestamp", began)
            if metrics_path is not None:
                counters = metrics.as_system_metrics(metrics.alert_metrics(batch, stored, rejects),
                                                     began.isoformat())
                dated.write(counters, metrics_path, batch_id, "timestamp", began)
            stored.unpersist()
            rejects.unpersist()
        finally:
            batch.unpersist()

    return _start(stream, store, checkpoint, trigger)


LATE = 1 << 30          # batch numbers of alerts that are stored late start here


def start_alert_retry(rejects_path: str, stored_path: str, history_path: str, dimension_path: str, pending_path: str,
                      checkpoint: str, dimension_base_path: str | None = None, trigger: dict | None = None,
                      keep_days: int | None = None) -> StreamingQuery:
    """Alerts that were rejected as ``unknown_event`` are stored once their
    event is known. The job follows two logs, of the alert store's rejects and
    of the storage job's history: a new entry of either is the time to look.
    What waits is kept as one version a batch; an alert leaves it when it is
    stored, so each is stored once, into the feed of the other alerts under
    batch numbers from ``LATE`` on. Alerts older than ``keep_days`` stop
    waiting; they stay in the rejects."""
    rejects, stored_before = Feed(rejects_path), Feed(history_path)
    spark = SparkSession.active()
    stream = rejects.entries(spark).withColumn("_of", F.lit("rejects")).unionByName(
        stored_before.entries(spark).withColumn("_of", F.lit("history")))

    def process(entries: DataFrame, batch_id: int) -> None:
        from pricewatch.operators import validate
        spark = entries.sparkSession
        began = dated.begin(spark, pending_path, batch_id)
        through = int(dated.pinned(spark, pending_path, batch_id, "dimension", lambda: str(
            deltas.newest_batch(spark, dimension_path, dimension_base_path))))
        new = rejects.rows(entries.where(F.col("_of") == "rejects").drop("_of"), empty=True)
        pool = None if new is None else new.where(F.col(validate.REASON) == "unknown_event") \
            .drop(validate.REASON, dated.DAY, dated.BATCH)
        last = max((int(n.split("=")[1]) for n in files.children(spark, pending_path)
                    if n.startswith(deltas.DELTA) and int(n.split("=")[1]) < batch_id), default=None)
        if last is not None:
            waiting = spark.read.parquet(f"{pending_path.rstrip('/')}/{deltas.DELTA}{last}")
            pool = waiting if pool is None else waiting.unionByName(pool)
        if pool is None:                    # no reject has been written yet
            return
        if keep_days is not None:
            pool = pool.where(F.col("alert_timestamp") >= dated.at(began - dt.timedelta(days=keep_days)))
        dim = read_dimension(spark, dimension_path, dimension_base_path, before=through + 1)
        known = pool.where(F.lit(False)).select("event_id") if dim is None else dim.select("event_id").distinct()
        pool = pool.persist()
        try:
            write_batch(pool.join(known, "event_id", "left_anti"), pending_path, batch_id)
            dated.write(pool.join(known, "event_id", "left_semi").select(pool.columns), stored_path,
                        LATE + batch_id, "alert_timestamp", began)
            if last is not None:            # the version before stays, for a replay
                for n in files.children(spark, pending_path):
                    if n.startswith(deltas.DELTA) and int(n.split("=")[1]) < last:
                        files.delete(spark, f"{pending_path.rstrip('/')}/{n}")
        finally:
            pool.unpersist()

    return _start(stream, process, checkpoint, trigger)


def start_thresholds(events: DataFrame | Feed, rules_path: str, triggers_path: str, rejects_path: str,
                     state_path: str, checkpoint: str, trigger: dict | None = None, base_path: str | None = None,
                     keys=changes.LISTING_KEYS, order=None,
                     compact_every: int | None = None) -> StreamingQuery:
    """User thresholds on the stream: a row in ``triggers_path`` (the
    alert_triggers table, with event and listing) where a listing's price comes
    down to a rule's target (``thresholds.threshold_crossings``). The rules
    (JSON lines) are read anew and checked in each micro-batch, so changes take
    effect; rules that break a constraint of their table go to
    ``rejects_path``. The price before is kept as deltas by batch, as the
    detector's baselines are; ``compact_baselines(baseline="previous")`` folds
    them. ``read_rules`` gives the rules with ``last_triggered``."""
    from pricewatch.operators import constraints, thresholds, validate
    from pricewatch.sources.feeds import read_rules_text
    keys, asked = list(keys), order
    stream, rows = _input(events)

    def process(entries: DataFrame, batch_id: int) -> None:
        spark = entries.sparkSession
        if dated.finished(spark, triggers_path, batch_id) \
                and files.exists(spark, f"{state_path.rstrip('/')}/batch_id={batch_id}/_SUCCESS"):
            return                          # a replay of a finished batch
        taken = rows(entries)
        batch = (normalize.good_events(taken) if WIRE_REASON in taken.columns else taken).persist()
        try:
            began = dated.begin(spark, triggers_path, batch_id)
            order = list(asked or order_of(batch))
            checked = constraints.check(read_rules_text(spark, rules_path), "alerts", order=["created_at"]).persist()
            reason = F.col(validate.REASON)
            prior = read_baselines(spark, state_path, keys, "previous", before=batch_id, base_path=base_path)
            seed = None if prior is None else _null_safe_semi(prior, batch, keys)
            fired = thresholds.threshold_crossings(batch, checked.where(reason.isNull()), keys, order, seed).persist()
            dated.write(fired, triggers_path, batch_id, "triggered_at", began)
            dated.write(checked.where(reason.isNotNull()), rejects_path, batch_id, began=began)
            write_batch(thresholds.last_prices(batch, keys, order), state_path, batch_id)
            if base_path and _compact_now(batch_id, compact_every):
                compact_baselines(spark, state_path, base_path, keys, "previous")
            fired.unpersist()
            checked.unpersist()
        finally:
            batch.unpersist()

    return _start(stream, process, checkpoint, trigger)


def read_rules(spark: SparkSession, rules_path: str, triggers_path: str) -> DataFrame:
    """The threshold rules that meet their table's constraints, with
    ``last_triggered`` moved to the newest stored trigger."""
    from pricewatch.operators import constraints, thresholds, validate
    from pricewatch.sources.feeds import read_rules_text
    rules = constraints.check(read_rules_text(spark, rules_path), "alerts", order=["created_at"]) \
        .where(F.col(validate.REASON).isNull()).drop(validate.REASON, validate.REASONS)
    if not dated.is_feed(spark, triggers_path):
        return rules
    return thresholds.move_last_triggered(rules, spark.read.parquet(triggers_path))


_DIM_ATTRS = ("event_name", "venue", "event_date")


def _fold(rows: DataFrame, attrs=_DIM_ATTRS) -> DataFrame:
    first = F.min_by(F.struct(*[F.col(a) for a in attrs]),
                     F.struct(F.col("batch_id"), F.col("created_at")))
    return (rows.groupBy("event_id")
            .agg(first.alias("_f"), F.min("created_at").alias("created_at"),
                 F.max("last_updated").alias("last_updated"), F.max("batch_id").alias("_b"))
            .select("event_id", *[F.col(f"_f.{a}").alias(a) for a in attrs],
                    "created_at", "last_updated", F.col("_b").alias("batch_id")))


def read_dimension(spark: SparkSession, path: str, base_path: str | None = None,
                   attrs=_DIM_ATTRS, before: int | None = None) -> DataFrame | None:
    """The event dimension: the newest compacted base (when given) plus the
    per-batch deltas written after it, folded by one aggregation that
    combines map-side: attributes of the earliest sighting (by batch, then
    time), first and last sighting. None when nothing has been written."""
    rows = deltas.rows(spark, path, base_path, before)
    return None if rows is None else _fold(rows, attrs).drop("batch_id")


def compact_dimension(spark: SparkSession, path: str, base_path: str,
                      attrs=_DIM_ATTRS) -> int | None:
    """``deltas.compact`` of the event dimension."""
    return deltas.compact(spark, path, base_path, lambda rows: _fold(rows, attrs))


def throughput_stream(events: DataFrame, ts: str = "timestamp", every: str = "5 minutes",
                      lateness: str = "10 minutes") -> DataFrame:
    """Messages per tumbling window and per minute; a window is emitted once
    the watermark (max time seen minus ``lateness``) passes its end."""
    from pricewatch.operators.metrics import _minutes
    return (events.withWatermark(ts, lateness)
            .groupBy(F.window(ts, every).alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"))
            .select(F.col("w.start").alias("window_start"), "messages",
                    (F.col("messages") / F.lit(_minutes(every))).alias("per_minute")))
