"""Registered queries: streaming jobs replayed over the events table.

Each reads the events file as a stream, runs to the end of the data and returns the
sink as it reads afterwards. Append mode emits a minute only once the watermark has
passed it, so its SQL twin is limited to closed minutes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlake.bindings import Bindings
from wardlake.contract.registry import query
from wardlake.contract.sources import store
from wardlake.session import shared_dir
from wardlake.streaming import sinks, vitals
from wardlake.streaming.upsert import UpsertTable

MINUTE_COLS = ("minute_start_utc:s device_id:s patient_id:s hospital_code:s bed_number:s "
               "sample_count:i heart_rate_avg:d heart_rate_max:d heart_rate_min:d spo2_avg:d "
               "spo2_min:d systolic_avg:d diastolic_avg:d respiratory_rate_avg:d "
               "temperature_c_avg:d temperature_c_max:d anomaly_event_count:i primary_anomaly_kind:s")


def cores(b: Bindings) -> int:
    """State partitions: one per core of the cluster."""
    return b.spark.sparkContext.defaultParallelism


def flagged(b: Bindings):
    """Events stream through the JSON text a device would send."""
    return vitals.flag_anomalies(vitals.parse(b.as_bodies(b.as_vitals(b.events_stream()))))


def typed(b: Bindings):
    """Events stream as typed readings, microseconds kept."""
    return vitals.flag_anomalies(b.as_vitals(b.events_stream()))


@query("str_01_parse_payload", "event_id:s device_id:s heart_rate_bpm:d spo2_pct:d event_second:s "
       "delay_s:i body:s", """
    SELECT cast(event_id AS varchar) AS event_id, device_id, hr AS heart_rate_bpm, spo2 AS spo2_pct,
        cast(date_trunc('second', ts) AS varchar) AS event_second, 30 AS delay_s, NULL AS body
    FROM reading WHERE event_id % 50 <> 0 AND event_id % 70 <> 0
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN event_id % 50 = 0 THEN '{"event_id": ' || event_id
        ELSE '{"event_id":"' || event_id || '","event_time":"soon"}' END
    FROM reading WHERE event_id % 50 = 0 OR event_id % 70 = 0""")
def parse_payload(b: Bindings):
    """Every payload is a reading or, with its text, in quarantine: some are cut off, some have no time."""
    root, event = shared_dir(b.spark, "parsed"), F.col("event_id").cast("bigint")
    raw = b.as_bodies(b.as_vitals(b.events_stream())).withColumn("event_id", F.get_json_object("body", "$.event_id"))
    raw = raw.withColumn("body", F.when(event % 50 == 0, F.concat(F.lit('{"event_id": '), "event_id"))
                         .when(event % 70 == 0, F.concat(F.lit('{"event_id":"'), "event_id", F.lit('","event_time":"soon"}')))
                         .otherwise(F.col("body"))).drop("event_id")
    sinks.await_all(b.spark, sinks.write_payloads(raw, root, f"{root}/ckpt", None))
    good = b.spark.read.parquet(f"{root}/vitals_stream").withColumns({
        "event_second": F.date_trunc("second", "event_ts"),
        "delay_s": F.unix_timestamp("arrival_ts") - F.unix_timestamp("event_ts")})
    return good.unionByName(b.spark.read.parquet(f"{root}/quarantine/vitals_stream").select("body"), True)


@query("str_03_bronze_append", "ingest_date:s n:i anomalies:i", """
    SELECT cast((ts + interval 30 second)::date AS varchar) AS ingest_date, count(*) AS n,
        count(*) FILTER (is_anomaly) AS anomalies FROM reading GROUP BY 1""")
def bronze_append(b: Bindings):
    root = shared_dir(b.spark, "bronze")
    sinks.await_all(b.spark, [sinks.write_bronze(flagged(b), root, f"{root}/ckpt", None)])
    return b.spark.read.parquet(f"{root}/vitals_stream").groupBy(
        F.col("_ingest_date").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("derived_anomaly"), 1)).alias("anomalies"))


@query("str_04_minute_append", MINUTE_COLS, "SELECT * FROM minute_closed")
def minute_append(b: Bindings):
    root = shared_dir(b.spark, "minutes")
    minutes = vitals.minute_aggregate(typed(b), "5 minutes")
    sinks.await_all(b.spark, [sinks.write_minutes(minutes, root, f"{root}/ckpt", None, cores(b))])
    return b.spark.read.parquet(f"{root}/vitals_minute")


def minute_table(b: Bindings, fold_every: int = 16) -> UpsertTable:
    return UpsertTable(store(b), "fact_minutes", vitals.MINUTE_KEYS, "date_sk", fold_every)


@query("str_05_minute_upsert", MINUTE_COLS, "SELECT * FROM minute_all")
def minute_upsert(b: Bindings):
    """Update mode: open minutes are written too and replaced as they grow; then all again on a new checkpoint."""
    root, table = shared_dir(b.spark, "upsert"), minute_table(b)
    minutes = vitals.minute_aggregate(typed(b), "2 minutes")
    for run in ("first", "reset"):
        sinks.await_all(b.spark, [sinks.write_upsert(minutes, table, f"{root}/{run}", None, cores(b))])
        table.fold()
    return table.read()


@query("snk_06_keyed_upsert", "device_id:s bed_number:s sample_count:i minute_start_utc:s", """
    SELECT device_id, bed_number, 7 * sample_count AS sample_count, minute_start_utc FROM minute_all""")
def keyed_upsert(b: Bindings):
    """Batches of one checkpoint, folded in as the log grows, a replay, and a new checkpoint that counts from 0 again."""
    root, table = shared_dir(b.spark, "upsert"), minute_table(b, fold_every=2)
    # every batch brings the same minutes: they are found once
    minutes, aside = store(b).stage(vitals.minute_aggregate(vitals.flag_anomalies(b.as_vitals(b.events()))))
    for run, batches in (("first", [(0, 1), (1, 2), (2, 3), (2, 3)]), ("reset", [(0, 7)])):
        write = table.writer(table.epoch(f"{root}/{run}"))
        for batch, times in batches:
            write(minutes.withColumn("sample_count", F.col("sample_count") * times), batch)
    table.store.drop(aside)
    return table.read()


@query("str_06_six_minute_buckets", "minutes:i samples:i anomalies:i", """
    SELECT count(*) AS minutes, sum(sample_count) AS samples, sum(anomaly_event_count) AS anomalies
    FROM minute_all""")
def six_minute_buckets(b: Bindings):
    """State kept for six minutes behind the newest event, flushed as it changes."""
    root, table = shared_dir(b.spark, "buckets"), minute_table(b)
    minutes = vitals.minute_aggregate(typed(b), "6 minutes")
    sinks.await_all(b.spark, [sinks.write_upsert(minutes, table, f"{root}/ckpt", None, cores(b))])
    return table.read().agg(
        F.count(F.lit(1)).alias("minutes"), F.sum("sample_count").alias("samples"),
        F.sum("anomaly_event_count").alias("anomalies"))


@query("str_07_late_data", "device_id:s samples:i", """
    SELECT device_id, sum(sample_count) AS samples FROM minute_closed GROUP BY 1""")
def late_data(b: Bindings):
    """A second run brings every event again, all behind the watermark: nothing changes."""
    root = shared_dir(b.spark, "late")
    feed = f"{root}/feed"
    rows = b.events()
    for _ in range(2):
        rows.write.mode("append").parquet(feed)
        src = b.spark.readStream.schema(rows.schema).parquet(feed)
        minutes = vitals.minute_aggregate(vitals.flag_anomalies(b.as_vitals(src)), "5 minutes")
        sinks.await_all(b.spark, [sinks.write_minutes(minutes, root, f"{root}/ckpt", None, cores(b))])
    return b.spark.read.parquet(f"{root}/vitals_minute").groupBy("device_id").agg(
        F.sum("sample_count").alias("samples"))


@query("str_08_two_sinks", "sink:s n:i", """
    SELECT 'bronze' AS sink, count(*) AS n FROM events
    UNION ALL SELECT 'minutes', count(*) FROM minute_closed""")
def two_sinks(b: Bindings):
    """One flagged stream, two queries with their own checkpoints."""
    root = shared_dir(b.spark, "two")
    src = typed(b).withColumn("arrival_ts", F.col("event_ts"))
    sinks.await_all(b.spark, [
        sinks.write_bronze(src, root, f"{root}/ckpt", None),
        sinks.write_minutes(vitals.minute_aggregate(src), root, f"{root}/ckpt", None, cores(b))])
    out = None
    for label, path in [("bronze", "vitals_stream"), ("minutes", "vitals_minute")]:
        one = b.spark.read.parquet(f"{root}/{path}").agg(F.count(F.lit(1)).alias("n")) \
            .withColumn("sink", F.lit(label))
        out = one if out is None else out.unionByName(one)
    return out


@query("str_09_bounded_replay", "runs:i n:i", """
    SELECT 2 AS runs, count(*) AS n FROM events""")
def bounded_replay(b: Bindings):
    """Two bounded runs on one checkpoint: the second finds nothing new."""
    out = shared_dir(b.spark, "replay")
    for _ in range(2):
        sinks.await_all(b.spark, [sinks.write_append(typed(b), out, f"{out}-ckpt", None)])
    return b.spark.read.parquet(out).agg(F.lit(2).alias("runs"), F.count(F.lit(1)).alias("n"))


@query("str_10_minute_fact", "vital_sk:i patient_sk:i hospital_sk:i device_id:s bed_number:s "
       "minute_start_utc:s date_sk:i sample_count:i", """
    SELECT f.*, cast('0x' || substr(md5(f.device_id || '|' || f.bed_number || '|'
        || cast(f.minute_start_utc AS varchar)), 1, 15) AS bigint) AS vital_sk
    FROM minute_fact AS f JOIN minute_closed AS c ON c.minute_start_utc = f.minute_start_utc
        AND c.device_id = f.device_id AND c.bed_number = f.bed_number""")
def minute_fact(b: Bindings):
    """Minute aggregates with facility and patient keys, joined inside the stream."""
    root = shared_dir(b.spark, "fact")
    minutes = vitals.minute_aggregate(typed(b), "5 minutes")
    fact = vitals.fact_minutes(minutes, b.dim_hospital)
    sinks.await_all(b.spark, [sinks.write_minutes(fact, root, f"{root}/ckpt", None, cores(b))])
    return b.spark.read.parquet(f"{root}/vitals_minute")


@query("str_12_duplicate_readings", "device_id:s samples:i", """
    SELECT device_id, sum(sample_count) AS samples FROM minute_closed GROUP BY 1""")
def duplicate_readings(b: Bindings):
    """Every event twice in the stream; one reading per device and time survives."""
    root = shared_dir(b.spark, "dup")
    src = typed(b)
    doubled = src.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    minutes = vitals.minute_aggregate(vitals.dedup(doubled, "5 minutes"), None)
    sinks.await_all(b.spark, [sinks.write_minutes(minutes, root, f"{root}/ckpt", None, cores(b))])
    return b.spark.read.parquet(f"{root}/vitals_minute").groupBy("device_id").agg(
        F.sum("sample_count").alias("samples"))


@query("j_12_stream_static", "hospital_code:s hospital_sk:i n:i", """
    SELECT hospital_code, coalesce(hospital_sk, -1) AS hospital_sk, count(*) AS n
    FROM reading LEFT JOIN facility ON hospital_bk = hospital_code GROUP BY 1, 2""")
def stream_static(b: Bindings):
    """Stream joined to the facility table; an unknown code becomes member -1."""
    out = shared_dir(b.spark, "lookup")
    resolved = vitals.resolve(typed(b), b.dim_hospital)
    sinks.await_all(b.spark, [sinks.write_append(resolved, out, f"{out}-ckpt", None)])
    return b.spark.read.parquet(out).groupBy("hospital_code", "hospital_sk") \
        .agg(F.count(F.lit(1)).alias("n"))
