"""Streaming sinks: partitioned append, keyed upsert, two sinks from one stream."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlake.streaming import vitals
from wardlake.streaming.upsert import UpsertTable


def _trigger(seconds: int | None) -> dict:
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


@contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Queries started inside keep ``n`` state partitions for the life of their checkpoint.

    Adaptive execution does not resize stateful stages, so the number is set per
    stream; None leaves the session's setting.
    """
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    if n is not None:
        spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def write_append(df: DataFrame, path: str, checkpoint: str, trigger_s: int | None = 30,
                 parts: list[str] | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Exactly-once file append. ``trigger_s=None`` replays what is there and stops."""
    return (
        df.writeStream.format(fmt).outputMode("append").partitionBy(*(parts or []))
        .option("checkpointLocation", checkpoint).trigger(**_trigger(trigger_s)).start(path)
    )


def write_bronze(events: DataFrame, root: str, checkpoint: str,
                 trigger_s: int | None = 30) -> StreamingQuery:
    return write_append(events.withColumn("_ingest_date", F.to_date("arrival_ts")),
                        f"{root}/vitals_stream", f"{checkpoint}/bronze_vitals", trigger_s,
                        ["_ingest_date"])


def write_payloads(raw: DataFrame, root: str, checkpoint: str, trigger_s: int | None = 30,
                   thresholds: vitals.Thresholds = vitals.Thresholds()) -> list[StreamingQuery]:
    """Two sinks of one stream of payloads: readings to Bronze, and the text of what is none to the quarantine."""
    readings = vitals.flag_anomalies(vitals.parse(raw).where(F.col("event_ts").isNotNull()), thresholds)
    bad = vitals.malformed(raw).withColumn("_quarantine_date", F.to_date("arrival_ts"))
    return [
        write_bronze(readings, root, checkpoint, trigger_s),
        write_append(bad, f"{root}/quarantine/vitals_stream", f"{checkpoint}/quarantine_vitals", trigger_s, ["_quarantine_date"])]


def write_minutes(minutes: DataFrame, root: str, checkpoint: str,
                  trigger_s: int | None = 30, partitions: int | None = None) -> StreamingQuery:
    with state_partitions(minutes.sparkSession, partitions):
        return write_append(minutes, f"{root}/vitals_minute", f"{checkpoint}/silver_vitals_minute",
                            trigger_s, ["date_sk"])


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait for every query; the first failure stops the others and is raised."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def write_upsert(rows: DataFrame, table: UpsertTable, checkpoint: str,
                 trigger_s: int | None = 15, partitions: int | None = None) -> StreamingQuery:
    """Update mode into a keyed table: the last state of each key stands, also after a new checkpoint."""
    writer = rows.writeStream.outputMode("update").foreachBatch(table.writer(table.epoch(checkpoint))) \
        .option("checkpointLocation", checkpoint).trigger(**_trigger(trigger_s))
    with state_partitions(rows.sparkSession, partitions):
        return writer.start()
