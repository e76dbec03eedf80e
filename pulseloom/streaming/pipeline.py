"""The whole pipeline as one streaming query.

Each micro-batch is parsed once and kept while its sinks are written: history
tables, dead letters, hot snapshots and counts. What one batch must know of the
ones before (recent passes of the deduplication, live hot entries) is kept in
snapshots named after the batch that wrote them, so a retried batch starts from the
same state and leaves the same files.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from pulseloom.operators import dedup, parse, serving, sinks
from pulseloom.streaming import hot, late

log = logging.getLogger(__name__)

PASSES, METRICS = "dedup_passes", "metrics"


def _write(df: DataFrame, root: str, view: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{view}/batch_id={batch_id}")


def _unique(valid: DataFrame, root: str, batch_id: int, method: str, seconds: int, watermark: int) -> DataFrame:
    """Valid rows that pass deduplication; saves what the next batch must know."""
    spark = valid.sparkSession
    seen = sinks.read_snapshot(spark, root, PASSES, before=batch_id)
    passed = dedup.continued(valid, seen, method, seconds=seconds).persist(StorageLevel.DISK_ONLY)
    keys = dedup.key_columns(valid)
    marks = passed.select(*keys, "timestamp", "received_ts")
    if seen is not None:
        marks = marks.unionByName(seen)
    now = marks.agg(F.max("received_ts")).scalar()
    try:
        _write(dedup.recent(marks, now, keys, seconds=seconds, watermark=watermark), root, PASSES, batch_id)
        sinks.trim(spark, root, PASSES, batch_id)
    except Exception:
        passed.unpersist()
        raise
    return passed


def write_batch(raw: DataFrame, batch_id: int, root: str, profile: str = "typed",
                method: str | None = "throttle", seconds: int = dedup.SECONDS,
                ttl: int = serving.TTL, cap: int = serving.CAP, watermark: int = dedup.WATERMARK,
                order: str = "event", writer: str = "stream", lateness: int | None = None,
                views: Sequence[str] = sinks.VIEWS, **parse_options) -> None:
    """All sinks of one micro-batch.

    With ``lateness``, rows more than so many seconds older than the newest of earlier batches
    go to the dead letters and are counted (see ``late``). ``views`` says which hot views are
    written as snapshots: those that ``run_hot`` keeps as state need none.

    A repeat is found up to ``watermark`` seconds of arrival after the row it repeats;
    ``order`` is that of the latest records (``event`` or ``arrival``); ``writer`` names who
    numbers the batches.
    """
    newest = None if lateness is None else late.known(raw.sparkSession, root, batch_id)
    parsed = parse.parse(raw, profile, **parse_options)
    if lateness is not None:
        parsed = late.mark(parsed, newest, lateness)
    parsed = parsed.persist(StorageLevel.DISK_ONLY)
    passed = None
    try:
        valid = parsed.filter(~F.col("route").isin(parse.INVALID, parse.DROPPED, parse.LATE)).drop("payload", "reasons")
        if method is not None:
            valid = passed = _unique(valid, root, batch_id, method, seconds, watermark)
        sinks.write_history(valid, root, batch_id, profile, writer)
        sinks.write_rejects(parsed, root, batch_id, profile)
        if lateness is not None:
            late.write(parsed, root, batch_id, newest)
        serving_failed = 0
        try:
            sinks.write_serving(valid.drop("route"), root, batch_id, ttl, cap, order=order, views=views)
        except Exception:  # hot views never stop the pipeline
            log.exception("hot views of batch %s not written", batch_id)
            serving_failed = 1
        counts = parsed.groupBy("route").agg(F.count("*").alias("messages"))
        _write(counts.withColumn("serving_failed", F.lit(serving_failed)), root, METRICS, batch_id)
    finally:
        for frame in (passed, parsed):
            if frame is not None:
                frame.unpersist()


def run(raw_stream: DataFrame, root: str, checkpoint: str, profile: str = "typed",
        trigger: dict | None = None, **options) -> StreamingQuery:
    """Start the pipeline; ``options`` are those of ``write_batch``.

    ``method=None`` turns deduplication off, as the lenient profile does by default.
    """
    if profile == "lenient":
        options.setdefault("method", None)
    options.setdefault("writer", checkpoint)  # a new checkpoint numbers its batches anew

    def batch(df: DataFrame, batch_id: int) -> None:
        write_batch(df, batch_id, root, profile, **options)

    writer = raw_stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def run_hot(raw_stream: DataFrame, checkpoint: str, profile: str = "typed", trigger: dict | None = None,
            ttl: int = serving.TTL, cap: int = serving.CAP, clock: str = "received_ts",
            watermark: str = "10 minutes", **parse_options) -> dict[str, StreamingQuery]:
    """Start the hot series and gateway sets as keyed state beside ``run``.

    Deduplication changes neither: equal points are one, and a member is its last write.
    ``hot.series_view`` and ``hot.gateway_view`` read ``checkpoint/series`` and
    ``checkpoint/gateways``.
    """
    parsed = parse.parse(raw_stream, profile, **parse_options)
    valid = parsed.filter(~F.col("route").isin(parse.INVALID, parse.DROPPED)).drop("payload", "reasons", "route")
    started = {"series": hot.start(hot.series(valid, cap, ttl, clock=clock, watermark=watermark),
                                   f"{checkpoint}/series", trigger=trigger)}
    if "gateway_id" in valid.columns:
        started["gateways"] = hot.start(hot.gateways(valid, ttl, clock, watermark), f"{checkpoint}/gateways",
                                        trigger=trigger)
    return started
