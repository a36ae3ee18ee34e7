"""Registered queries: feed readers and reads by snapshot.

Each writes a given table as a feed into a new shared folder, ingests it and reads
the Bronze table back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from wardlake.bindings import LOAD_TS, Bindings
from wardlake.contract.registry import query
from wardlake.operators import dims
from wardlake.schemas import FEEDS
from wardlake.session import shared_dir
from wardlake.sources import ingest, streams
from wardlake.sources.tables import TableStore
from wardlake.streaming import sinks, vitals


#: Rows of a file of a feed: a compressed file is read by one task.
FEED_ROWS = 200_000


def store(b: Bindings) -> TableStore:
    return TableStore(b.spark, shared_dir(b.spark, "lake"))


def feed_writer(rows: DataFrame) -> DataFrameWriter:
    """Feeds are text that repeats its names in every row, so they are delivered compressed, in files of bounded size."""
    return rows.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", FEED_ROWS)


@query("src_01_csv_feed", "Id:s BIRTHDATE:s LAST:s GENDER:s STATE:s", """
    SELECT cast(c_custkey AS varchar) AS Id, cast(date_of_birth AS varchar) AS BIRTHDATE,
        c_name || ', "Jr"' || chr(10) || 'II' AS LAST,
        CASE c_custkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'Female' END AS GENDER,
        'NATION_' || c_nationkey AS STATE
    FROM customer JOIN patient ON patient_bk = cast(c_custkey AS varchar)""")
def csv_feed(b: Bindings):
    """CSV with commas, doubled quotes and line breaks inside a value."""
    path, lake = shared_dir(b.spark, "csv"), store(b)
    feed = b.raw_patients().withColumn("LAST", F.concat("LAST", F.lit(', "Jr"\nII')))
    feed_writer(feed).option("header", True).option("escape", '"').csv(path)
    ingest.csv_feeds(b.spark, {"patients": path}, lake, "run-1", ingest_ts=LOAD_TS)
    return lake.read("synthea_patients").drop(*ingest.LINEAGE)


@query("src_02_json_lines", "claim_id:s status:s billed_amount:d items:i first_cpt:s", """
    SELECT claim_bk AS claim_id, status, billed_amount, line_count AS items,
        cast(99000 + (l_suppkey + 1) % 100 AS varchar) AS first_cpt FROM claim""")
def json_lines(b: Bindings):
    """Claims as JSON lines with their nested line items."""
    path, lake = shared_dir(b.spark, "jsonl"), store(b)
    feed_writer(b.raw_claims()).json(path)
    ingest.claims(b.spark, path, lake, "run-1", LOAD_TS)
    return lake.read("claims_raw").select(
        "claim_id", "status", "billed_amount", F.size("line_items").alias("items"),
        F.get("line_items", F.lit(0))["cpt_code"].alias("first_cpt"))


@query("src_02_malformed_lines", "claim_id:s body:s readable:b", """
    SELECT CASE WHEN l_orderkey % 10 <> 7 THEN claim_bk END AS claim_id,
        CASE WHEN l_orderkey % 10 = 7 THEN '{"claim_id":"' || claim_bk END AS body, l_orderkey % 10 <> 7 AS readable
    FROM claim""")
def malformed_lines(b: Bindings):
    """Lines that are cut off go to quarantine with their text; together with the others they are all lines."""
    path, lake = shared_dir(b.spark, "broken"), store(b)
    order = F.split("claim_number", "-")[1].cast("bigint")
    whole = F.to_json(F.struct("claim_id", "claim_number", "status", "billed_amount", "line_items"))
    feed_writer(b.raw_claims().select(F.when(order % 10 == 7, F.concat(F.lit('{"claim_id":"'), "claim_id")).otherwise(whole))).text(path)
    ingest.claims(b.spark, path, lake, "run-1", LOAD_TS)
    good = lake.read("claims_raw").select("claim_id", F.lit(True).alias("readable"))
    return good.unionByName(lake.read("quarantine/bronze/claims_raw").select("body", F.lit(False).alias("readable")), True)


@query("src_03_json_array", "npi:s last_name:s is_active:b", """
    SELECT provider_bk AS npi, last_name, is_active FROM provider""")
def json_array(b: Bindings):
    """Providers as JSON array documents of at most 50 000 members, loaded twice."""
    path, lake = shared_dir(b.spark, "array"), store(b)
    rows = b.raw_providers()
    chunk = F.floor((F.col("npi").cast("bigint") - 1) / 50_000).alias("chunk")
    docs = rows.groupBy(chunk).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    docs.write.partitionBy("chunk").text(path)
    for run in ("run-1", "run-2"):
        ingest.providers(b.spark, path, lake, run, LOAD_TS)
    return lake.read("provider_registry")


@query("src_04_vitals_json", "event_id:s device_id:s heart_rate_bpm:d spo2_pct:d event_time:s", """
    SELECT cast(event_id AS varchar) AS event_id, device_id, hr AS heart_rate_bpm, spo2 AS spo2_pct,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time FROM reading""")
def vitals_json(b: Bindings):
    """Vitals with an explicit schema, batch."""
    path, lake = shared_dir(b.spark, "vitals"), store(b)
    feed_writer(b.as_bodies(b.as_vitals(b.events())).select("body")).text(path)
    ingest.vitals(b.spark, path, lake, "run-1", LOAD_TS)
    return lake.read("vitals_stream")


@query("src_05_table_scan", "start_year_month:s n:i", """
    SELECT strftime(start_at, '%Y-%m') AS start_year_month, count(*) AS n FROM encounter
    WHERE start_at >= timestamp '1998-01-01' GROUP BY 1""")
def table_scan(b: Bindings):
    """Scan of a month-partitioned table; the filter prunes folders."""
    lake = store(b)
    lake.append(b.encounters().select("encounter_bk", "start_year_month"), "enc", ["start_year_month"])
    months = lake.read("enc").where(F.col("start_year_month") >= "1998-01")
    return months.groupBy("start_year_month").agg(F.count(F.lit(1)).alias("n"))


@query("src_06_reference_seed", "hospital_sk:i hospital_bk:s facility_type:s governorate:s "
       "bed_count:i is_active:b lat:d lon:d", "SELECT * FROM facility")
def reference_seed(b: Bindings):
    """All-text seed file, typed on the way to the facility dimension."""
    path = shared_dir(b.spark, "seed")
    b.facility_seed().write.option("header", True).csv(path)
    return dims.hospital_from_seed(ingest.read_csv(b.spark, path, FEEDS["facilities"], False))


@query("src_07_stream_files", "event_id:s device_id:s heart_rate_bpm:d event_second:s", """
    SELECT cast(event_id AS varchar) AS event_id, device_id, hr AS heart_rate_bpm,
        cast(date_trunc('second', ts) AS varchar) AS event_second FROM reading""")
def stream_files(b: Bindings):
    """Streaming text files, a few per trigger, replayed to the end."""
    path, out = shared_dir(b.spark, "in"), shared_dir(b.spark, "out")
    b.as_bodies(b.as_vitals(b.events())).select("body").write.text(path)
    events = vitals.parse(streams.read_files(b.spark, path, max_files=4))
    sinks.await_all(b.spark, [sinks.write_append(events, out, f"{out}-ckpt", None)])
    return b.spark.read.parquet(out).withColumn(
        "event_second", F.date_trunc("second", "event_ts"))


@query("src_10_lineage", "run_id:s ingest_ts:s ingest_date:s file_name:s n:i", """
    SELECT 'run-7' AS run_id, '2001-08-01 00:00:00' AS ingest_ts, '2001-08-01' AS ingest_date,
        'customer.parquet' AS file_name, count(*) AS n FROM customer""")
def lineage(b: Bindings):
    """Lineage columns on rows read from files."""
    stamped = ingest.with_lineage(b.table("customer"), "run-7", LOAD_TS)
    name = F.element_at(F.split("_source_file", "/"), -1)
    return stamped.groupBy(
        F.col("_run_id").alias("run_id"), F.col("_ingest_ts").alias("ingest_ts"),
        F.col("_ingest_date").alias("ingest_date"), name.alias("file_name"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("src_11_versioned_read", "source:s n:i balance_cents:i", """
    SELECT 'version 1' AS source, count(*) AS n,
        sum(cast(round(c_acctbal * 100) AS bigint)) AS balance_cents FROM customer
    UNION ALL SELECT 'current', count(*), sum(cast(round(c_acctbal * 100) AS bigint))
        FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT 'as of now', count(*), sum(cast(round(c_acctbal * 100) AS bigint))
        FROM customer WHERE c_acctbal >= 0""")
def versioned_read(b: Bindings):
    """Two snapshots of a table, one partition each, read by label, as the latest, and as of a day."""
    lake, rows = store(b), b.table("customer")
    lake.append(rows.withColumn("snapshot", F.lit("2001-07-01")), "customer", ["snapshot"])
    lake.append(rows.where("c_acctbal >= 0").withColumn("snapshot", F.lit("2001-08-01")), "customer", ["snapshot"])
    kept, day = lake.read("customer"), F.col("snapshot").cast("string")

    def latest(until: str):
        return kept.where(day == kept.where(day <= until).agg(F.max(day)).scalar())

    parts = [("version 1", kept.where(day == "2001-07-01")), ("current", latest("9999-12-31")),
             ("as of now", latest("2001-08-15"))]
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    out = None
    for label, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("balance_cents")) \
            .withColumn("source", F.lit(label))
        out = one if out is None else out.unionByName(one)
    return out
