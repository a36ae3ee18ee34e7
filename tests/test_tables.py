from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardlake.contract import entries, registry, sources
from wardlake.functions.keys import date_sk
from wardlake.operators import audit, monitor
from wardlake.sources import ingest, streams
from wardlake.streaming import progress, sinks, vitals
from wardlake.streaming.upsert import UpsertTable


def test_overwrite_from_itself_and_append_after_it(spark, store, tuples):
    store.overwrite(spark.range(5), "t")
    store.overwrite(store.read("t").where("id > 2"), "t")
    store.append(spark.range(7, 8), "t")
    assert tuples(store.read("t")) == [(3,), (4,), (7,)]
    assert store._children(f"{store.root}/_staging") == []


def test_failed_overwrite_leaves_the_table(spark, store):
    store.overwrite(spark.range(3), "t")
    with pytest.raises(Exception):
        store.overwrite(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), "t")
    assert store.read("t").count() == 3


def test_null_partition_is_left_alone(spark, store, tuples):
    store.append(days(spark, (None, 1), (20200101, 2), (20200102, 3)), "n", ["date_sk"])
    store.replace_range(days(spark, (20200101, 9)), "n", "date_sk", 20200101, 20200131)
    assert tuples(store.read("n"), "v") == [(1,), (9,)]
    assert store.purge("n", "date_sk", date(2021, 1, 1)) == ["date_sk=20200101"]
    assert tuples(store.read("n"), "v") == [(1,)]


def test_insert_missing_into_an_append_table(spark, store, tuples):
    store.append(days(spark, (1, 1), (None, 2)), "a", ["date_sk"])
    store.insert_missing(days(spark, (1, 5), (None, 6), (2, 7)), "a", ["date_sk"], ["date_sk"])
    assert tuples(store.read("a"), "v") == [(1,), (2,), (7,)]


def test_failure_is_logged(spark, store):
    with pytest.raises(Exception):
        audit.observed_overwrite(store, spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), "gold", "t")
    row = store.read(audit.TABLE).first()
    assert row["status"] == "failed" and "broken" in row["error_message"]


def days(spark, *rows):
    return spark.createDataFrame(list(rows), "date_sk int, v int")


def test_replace_range_drops_emptied_day_and_repeats(spark, store, tuples):
    store.replace_range(days(spark, (20200101, 1), (20200102, 2), (20200103, 3)), "k", "date_sk",
                        20200101, 20200131)
    for _ in range(2):
        store.replace_range(days(spark, (20200102, 9), (20200201, 7)), "k", "date_sk", 20200102, 20200103)
    assert tuples(store.read("k"), "date_sk", "v") == [(20200101, 1), (20200102, 9)]


def test_replace_range_with_nothing_clears_it(spark, store, tuples):
    store.replace_range(days(spark, (20200101, 1), (20200102, 2)), "k", "date_sk", 20200101, 20200131)
    store.replace_range(days(spark, (20990101, 1)), "k", "date_sk", 20200102, 20200105)
    assert tuples(store.read("k"), "date_sk", "v") == [(20200101, 1)]


def test_replace_tail(spark, store, tuples):
    def table(*rows):
        df = spark.createDataFrame(list(rows), "ts timestamp, v int")
        return df.withColumn("date_sk", date_sk("ts"))
    old = table((datetime(2020, 1, 1, 5), 1), (datetime(2020, 1, 2, 1), 2), (datetime(2020, 1, 2, 11), 3))
    store.replace_range(old, "m", "date_sk", 20200101, 20200131)
    new = table((datetime(2020, 1, 2, 1), 20), (datetime(2020, 1, 2, 11, 30), 30))
    store.replace_tail(new, "m", "ts", "date_sk", datetime(2020, 1, 2, 12), 2)
    assert tuples(store.read("m"), "v") == [(1,), (2,), (30,)]


def test_insert_missing_keeps_matched_rows(spark, store, tuples):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    store.insert_missing(a, "ref", ["k"])
    store.insert_missing(spark.createDataFrame([("x", 2), ("y", 3), ("y", 3)], "k string, v int"), "ref", ["k"])
    assert tuples(store.read("ref")) == [("x", 1), ("y", 3)]


def test_purge_drops_old_partitions(spark, store):
    store.append(days(spark, (20200101, 1), (20200301, 2)), "v", ["date_sk"])
    assert store.purge("v", "date_sk", date(2020, 2, 1)) == ["date_sk=20200101"]
    assert store.read("v").count() == 1


def test_audit_counts_written_rows(spark, store):
    assert audit.observed_overwrite(store, spark.range(4), "gold", "t") == 4
    row = store.read(audit.TABLE).collect()[0]
    assert (row["object_name"], row["rows_written"], row["status"]) == ("t", 4, "success")


def test_audit_of_a_run_watches_its_writes(spark, store):
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception):
        with audit.run(store, "night", "r1"):
            assert audit.observed_append(store, spark.range(7).repartition(3), "bronze", "a") == 7
            assert audit.observed_overwrite(store, spark.range(9).where("id < 0"), "gold", "none") == 0
            audit.observed_overwrite(store, broken, "gold", "t")
    with audit.run(store, "increment", "r2"):
        with audit.run(store, "inner", "other"):               # a run inside belongs to the outer one
            days_ = days(spark, (20200101, 1), (20200102, 2), (20200103, 3))
            n = audit.observed(store, "kpi", "k", lambda watch: store.replace_range(days_, "k", "date_sk", 20200101, 20200102, watch))
            assert n == 2
    got = {(r["run_id"], r["layer"], r["object_name"]): (r["rows_written"], r["status"]) for r in store.read(audit.TABLE).collect()}
    assert got == {("r1", "bronze", "a"): (7, "success"), ("r1", "gold", "none"): (0, "success"), ("r1", "gold", "t"): (None, "failed"),
                   ("r1", "run", "night"): (None, "failed"), ("r2", "kpi", "k"): (2, "success"), ("r2", "run", "increment"): (None, "success")}
    runs = {r["run_id"]: r for r in monitor.runs(store.read(audit.TABLE)).collect()}
    assert runs["r1"]["status"] == "failed" and runs["r1"]["rows_written"] == 7 and runs["r2"]["loads"] == 1


def test_ingest_logs_bronze(spark, store, tmp_path):
    spark.createDataFrame([("1", "x"), ("2", "y")], "Id string, CITY string").coalesce(1).write.option("header", True).csv(f"{tmp_path}/p")
    ingest.csv_feeds(spark, {"patients": f"{tmp_path}/p"}, store, "run-7", {"patients": "Id string, CITY string"}, multiline=False)
    row = store.read(audit.TABLE).where("layer = 'bronze'").first()
    assert (row["object_name"], row["rows_written"], row["run_id"]) == ("synthea_patients", 2, "run-7")


def test_a_delivery_is_appended_without_a_shuffle(spark, store, tmp_path, tuples):
    spark.range(6).selectExpr("cast(id as string) as claim_id").repartition(3).write.json(f"{tmp_path}/in")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        ingest.claims(spark, f"{tmp_path}/in", store, "r", datetime(2020, 1, 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(store.files(f"{store.path('claims_raw')}/_ingest_date=2020-01-01")) > 1
    assert tuples(store.read("claims_raw"), "claim_id") == [(str(i),) for i in range(6)]


def test_feeds_are_compressed_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sources, "FEED_ROWS", 2)
    sources.feed_writer(spark.range(5).coalesce(1)).json(f"{tmp_path}/feed")
    assert len(list(tmp_path.glob("feed/*.json.gz"))) == 3
    assert spark.read.schema("id long").json(f"{tmp_path}/feed").count() == 5


def test_upserted_batches_read_minutes_that_were_found_once(spark, tmp_path, monkeypatch):
    entries.load()
    events = [(i, datetime(2024, 1, 1, 0, i % 3), i % 2, "click", 1.5 * i, None) for i in range(12)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{tmp_path}/events.parquet")
    plans, writer = [], UpsertTable.writer

    def seen(table, epoch):
        write = writer(table, epoch)
        return lambda batch, batch_id: (plans.append(batch._jdf.queryExecution().executedPlan().toString()), write(batch, batch_id))

    monkeypatch.setattr(UpsertTable, "writer", seen)
    out = registry.run("snk_06_keyed_upsert", spark, str(tmp_path))
    assert out.agg(F.sum("sample_count")).first()[0] == 7 * 12
    assert len(plans) == 5 and not any("Aggregate" in plan for plan in plans)


def test_malformed_rows_are_kept_with_their_text(spark, store, tmp_path, tuples):
    (tmp_path / "p.csv").write_text('Id,CITY\n1,x\n2\n3,"a ""b"",\nc"\n4,y,z,w\n')
    (tmp_path / "c.json").write_text('{"claim_id":"c1","status":"denied"}\n{"claim_id":"c2\n[]\nnoise\n{"claim_id":"c3","billed_amount":"much"}\n')
    (tmp_path / "r.json").write_text('[{"npi":"1","is_active":true},{"npi":"2","is_active":"maybe"}]')
    ingest.csv_feeds(spark, {"patients": f"{tmp_path}/p.csv"}, store, "r", {"patients": "Id string, CITY string"}, datetime(2020, 1, 1))
    ingest.claims(spark, f"{tmp_path}/c.json", store, "r", datetime(2020, 1, 1))
    ingest.providers(spark, f"{tmp_path}/r.json", store, "r", datetime(2020, 1, 1))
    assert tuples(store.read("synthea_patients"), "Id", "CITY") == [("1", "x"), ("3", 'a "b",\nc')]
    assert tuples(store.read("quarantine/bronze/synthea_patients"), "body", "readable") == [
        ("2", '{"Id":"2"}'), ("4,y,z,w", '{"Id":"4","CITY":"y"}')]
    assert tuples(store.read("claims_raw"), "claim_id") == [("c1",)]
    kept = {r["body"] for r in store.read("quarantine/bronze/claims_raw").collect()}
    assert {'{"claim_id":"c2', "noise", '{"claim_id":"c3","billed_amount":"much"}'} <= kept
    log = {r["object_name"]: (r["rows_read"], r["rows_written"], r["rows_rejected"])
           for r in store.read(audit.TABLE).where("layer = 'bronze'").collect()}
    assert log["synthea_patients"] == (4, 2, 2) and log["claims_raw"] == (1 + len(kept), 1, len(kept))
    assert log["provider_registry"][0] == log["provider_registry"][1] + log["provider_registry"][2]


def test_payloads_are_readings_or_quarantined(spark, tmp_path, tuples):
    rows = [('{"device_id":"d","event_time":"2020-01-01T00:00:00.000Z","heart_rate_bpm":140}',), ("{oops",), (None,), ("",),
            ('{"device_id":"d","event_time":"soon"}',), ("[1]",)]
    spark.createDataFrame(rows, "body string").withColumn("arrival_ts", F.lit(datetime(2020, 1, 1))).write.parquet(f"{tmp_path}/in")
    raw = spark.readStream.schema("body string, arrival_ts timestamp").parquet(f"{tmp_path}/in")
    sinks.await_all(spark, sinks.write_payloads(raw, str(tmp_path), f"{tmp_path}/ckpt", None))
    assert tuples(spark.read.parquet(f"{tmp_path}/vitals_stream"), "device_id", "derived_anomaly_kind") == [("d", "tachycardia")]
    bad = spark.read.parquet(f"{tmp_path}/quarantine/vitals_stream")
    assert sorted(str(r["body"]) for r in bad.collect()) == sorted(str(r[0]) for r in rows[1:])


READING = {"heart_rate_bpm": 80.0, "spo2_pct": 97.0, "systolic_bp": 120.0, "temperature_c": 37.0}


def reading(spark, *changes):
    base = dict(READING, diastolic_bp=80.0, respiratory_rate=15.0, device_id="d", patient_id="p",
                hospital_code="h", bed_number="b1", event_ts=datetime(2020, 1, 1, 0, 0, 5))
    names = list(base)
    kinds = ", ".join(f"{n} " + ("timestamp" if n == "event_ts" else
                                 "string" if isinstance(base[n], str) else "double") for n in names)
    return spark.createDataFrame([tuple({**base, **c}[n] for n in names) for c in changes], kinds)


@pytest.mark.parametrize("change,kind", [
    ({}, None), ({"heart_rate_bpm": 131.0, "spo2_pct": 50.0}, "tachycardia"),
    ({"heart_rate_bpm": 44.0}, "bradycardia"), ({"spo2_pct": 87.9}, "hypoxia"),
    ({"systolic_bp": 181.0}, "hypertension"), ({"temperature_c": 39.6}, "fever"),
    ({"heart_rate_bpm": None}, None), ({"heart_rate_bpm": None, "temperature_c": 40.0}, "fever"),
    ({"heart_rate_bpm": 130.0, "systolic_bp": 70.0}, None)])
def test_anomaly_rule(spark, change, kind):
    row = vitals.flag_anomalies(reading(spark, change)).collect()[0]
    assert row["derived_anomaly_kind"] == kind and row["derived_anomaly"] == (kind is not None)


def test_low_pressure_is_optional(spark):
    row = vitals.flag_anomalies(reading(spark, {"systolic_bp": 70.0}), vitals.Thresholds(sbp_low=80.0))
    assert row.collect()[0]["derived_anomaly_kind"] == "hypotension"


def test_bed_change_keeps_both_rows_and_mode_breaks_ties(spark):
    df = reading(spark, {"temperature_c": 40.0}, {"spo2_pct": 80.0}, {"bed_number": "b2"})
    out = vitals.minute_aggregate(vitals.flag_anomalies(df)).orderBy("bed_number").collect()
    assert [(r["bed_number"], r["sample_count"]) for r in out] == [("b1", 2), ("b2", 1)]
    assert out[0]["primary_anomaly_kind"] == "fever" and out[0]["anomaly_event_count"] == 2
    keyed = vitals.keys(vitals.minute_aggregate(vitals.flag_anomalies(df)))
    assert keyed.select("vital_sk").distinct().count() == 2


def test_unknown_facility_is_member_minus_one(spark):
    hosp = spark.createDataFrame([("other", 1)], "hospital_bk string, hospital_sk bigint")
    assert vitals.resolve(reading(spark, {}), hosp).collect()[0]["hospital_sk"] == -1


def keyed(spark, *rows):
    return spark.createDataFrame([(*r, 20200101 + i % 2) if len(r) == 2 else r for i, r in enumerate(rows)], "k string, v int, date_sk int")


def test_upsert_replay_fold_and_new_checkpoint(spark, store, tmp_path, tuples):
    table = UpsertTable(store, "t", ["k"], "date_sk", fold_every=3)
    write = table.writer(table.epoch(f"{tmp_path}/c1"))
    assert table.epoch(f"{tmp_path}/c1") == 1
    for batch, value in [(0, 1), (1, 2), (1, 2), (10, 3), (2, 9)]:
        write(keyed(spark, ("k", value, 20200101), (f"x{value}", value, 20200100 + value)), batch)
    assert tuples(table.read(), "k", "v") == [("k", 3), ("x1", 1), ("x2", 2), ("x3", 3), ("x9", 9)]
    assert table.epoch(f"{tmp_path}/c2") == 2                  # a new checkpoint counts from 0 but is newer
    table.writer(2)(keyed(spark, ("k", 7, 20200101)), 0)
    assert tuples(table.read().where("k = 'k'"), "k", "v") == [("k", 7)]
    assert table.fold() == ["date_sk=20200101", "date_sk=20200109"] and table._folders() == []
    assert tuples(table.read(), "k", "v") == [("k", 7), ("x1", 1), ("x2", 2), ("x3", 3), ("x9", 9)]
    write(keyed(spark, ("k", 8, 20200101)), 11)                # a late writer of the old checkpoint stays older
    assert tuples(table.read().where("k = 'k'"), "k", "v") == [("k", 7)]


def test_folders_follow_the_data_not_the_triggers(spark, store, tmp_path):
    table = UpsertTable(store, "t", ["k"], "date_sk", fold_every=4)
    write = table.writer(table.epoch(f"{tmp_path}/c"))
    for batch in range(13):
        write(keyed(spark, (f"k{batch % 3}", batch, 20200101 + batch % 3 % 2)), batch)
        assert len(table._folders()) < 4
    table.fold()
    assert len(store._children(table.base)) == 2 and table.read().count() == 3
    before = store.files(f"{table.base}/date_sk=20200101")
    write(keyed(spark, ("n", 1, 20200102), ("m", 1, None)), 13)
    table.fold()
    assert store.files(f"{table.base}/date_sk=20200101") == before   # an untouched day keeps its files
    assert table.read().where("date_sk is null").count() == 1


def test_a_fold_cut_short_shows_each_key_once(spark, store, tmp_path, monkeypatch, tuples):
    table = UpsertTable(store, "t", ["k"], "date_sk", fold_every=99)
    write = table.writer(table.epoch(f"{tmp_path}/c"))
    write(keyed(spark, ("a", 1, 20200101), ("b", 1, 20200102)), 0)
    table.fold()
    write(keyed(spark, ("a", 2, 20200101), ("b", 2, 20200102)), 1)
    real = type(store).drop

    def crash(self, path):
        raise OSError("lost")
    monkeypatch.setattr(type(store), "drop", crash)
    with pytest.raises(OSError):
        table.fold()                                           # new files are in, the old ones too
    monkeypatch.setattr(type(store), "drop", real)
    assert tuples(table.read(), "k", "v") == [("a", 2), ("b", 2)]
    table.fold()
    assert tuples(table.read(), "k", "v") == [("a", 2), ("b", 2)] and table._folders() == []


def test_upsert_of_a_stream_with_a_bed_change_and_a_reset(spark, store, tmp_path, tuples):
    feed = str(tmp_path / "in")
    table = UpsertTable(store, "minutes", vitals.MINUTE_KEYS, "date_sk", fold_every=2)
    rows = reading(spark, {}, {"bed_number": "b2"}, {"event_ts": datetime(2020, 1, 2, 0, 0, 7)})

    def run(checkpoint):
        stream = vitals.flag_anomalies(spark.readStream.schema(rows.schema).parquet(feed))
        sinks.await_all(spark, [sinks.write_upsert(vitals.minute_aggregate(stream, "3 days"), table, f"{tmp_path}/{checkpoint}", None, 2)])
        return tuples(table.read(), "bed_number", "minute_start_utc", "sample_count")

    first, second = (datetime(2020, 1, 1), 1), (datetime(2020, 1, 2), 1)
    rows.coalesce(1).write.parquet(feed)
    assert run("a") == [("b1", *first), ("b1", *second), ("b2", *first)]
    reading(spark, {"event_ts": datetime(2020, 1, 1, 0, 0, 9)}).coalesce(1).write.mode("append").parquet(feed)
    want = [("b1", *second), ("b1", datetime(2020, 1, 1), 2), ("b2", *first)]
    assert sorted(run("a"), key=str) == sorted(want, key=str)
    assert sorted(run("b"), key=str) == sorted(want, key=str)


def test_a_crash_between_two_moves_is_settled(spark, store, monkeypatch, tuples):
    store.overwrite(spark.range(3), "t")
    store.replace_range(days(spark, (20200101, 1), (20200102, 2)), "p", "date_sk", 20200101, 20200131)
    real, calls = type(store)._move, []

    def fail(self, source, target):
        calls.append(target)
        if len(calls) > 1:
            raise KeyboardInterrupt                            # as if the driver had died after the first move
        real(self, source, target)
    for change in (lambda: store.overwrite(spark.range(9), "t"),
                   lambda: store.replace_range(days(spark, (20200102, 9)), "p", "date_sk", 20200102, 20200102)):
        calls.clear()
        monkeypatch.setattr(type(store), "_move", fail)
        with pytest.raises(KeyboardInterrupt):
            change()
        monkeypatch.setattr(type(store), "_move", real)
    store.settle("t")
    store.settle("p")
    assert store.read("t").count() == 3 and tuples(store.read("p"), "v") == [(1,), (2,)]
    assert store.replace_partitions(days(spark, (20200102, 5), (20200105, 6)), "p", "date_sk") == ["date_sk=20200102", "date_sk=20200105"]
    assert tuples(store.read("p"), "v") == [(1,), (5,), (6,)]


def test_a_failed_move_puts_the_old_rows_back(spark, store, monkeypatch):
    store.overwrite(spark.range(3), "t")
    real = type(store)._move

    def fail(self, source, target):
        if "_staging" in source:
            raise OSError("store is down")
        real(self, source, target)
    monkeypatch.setattr(type(store), "_move", fail)
    with pytest.raises(OSError):
        store.overwrite(spark.range(9), "t")
    assert store.read("t").count() == 3


def test_stream_equals_batch_and_drops_late(spark, tmp_path, tuples):
    feed, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [{"event_ts": datetime(2020, 1, 1, 0, m, 1), "heart_rate_bpm": 100.0 + m} for m in range(20)]
    src = reading(spark, *rows)

    def run():
        stream = spark.readStream.schema(src.schema).parquet(feed)
        q = sinks.write_minutes(vitals.minute_aggregate(vitals.flag_anomalies(stream), "5 minutes"),
                                root, f"{root}/ckpt", None, 2)
        sinks.await_all(spark, [q])
        return tuples(spark.read.parquet(f"{root}/vitals_minute"), "minute_start_utc", "sample_count",
                      "heart_rate_avg")

    src.coalesce(1).write.parquet(feed)
    once = run()
    batch = vitals.minute_aggregate(vitals.flag_anomalies(src)).where(
        F.col("minute_end_utc") <= F.lit(datetime(2020, 1, 1, 0, 14, 1)))
    assert once == tuples(batch, "minute_start_utc", "sample_count", "heart_rate_avg")
    reading(spark, {"event_ts": datetime(2020, 1, 1, 0, 1, 2)}).write.mode("append").parquet(feed)
    assert run() == once


def test_progress_of_a_stream_is_a_table(spark, store, tmp_path):
    rows = reading(spark, {}, {"event_ts": datetime(2020, 1, 1, 0, 5)}).withColumn("arrival_ts", F.col("event_ts") + F.expr("interval 3 minutes"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    log = progress.ProgressLog(store, every=1)
    spark.streams.addListener(log)
    try:
        stream = progress.with_lag(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
        query = sinks.write_minutes(vitals.minute_aggregate(vitals.flag_anomalies(stream)), str(tmp_path), f"{tmp_path}/ckpt", None, 2)
        sinks.await_all(spark, [query])
        log.wait([query])
    finally:
        spark.streams.removeListener(log)
    got = monitor.batch_lag(store.read(progress.TABLE)).collect()
    assert [(r["batch_id"], r["input_rows"], r["max_lag_s"], r["is_late"]) for r in got] == [(0, 2, 180, True)]
    assert got[0]["run_id"] == str(query.runId) and got[0]["batch_ms"] > 0


def test_payload_parsing_of_bad_text(spark):
    raw = spark.createDataFrame([('{"device_id":"d","event_time":"2020-01-01T00:00:00.000Z"}',), ("{oops",)],
                                "body string").withColumn("arrival_ts", F.current_timestamp())
    got = vitals.parse(raw).orderBy(F.col("device_id").desc_nulls_last()).collect()
    assert got[0]["event_ts"] == datetime(2020, 1, 1) and got[1]["event_ts"] is None
    assert [r["body"] for r in vitals.malformed(raw).collect()] == ["{oops"]


def test_kafka_options():
    opts = streams.kafka_options("host:9093", "vitals", jaas="x", group_prefix="g")
    assert opts["kafka.security.protocol"] == "SASL_SSL" and "maxOffsetsPerTrigger" not in opts
    assert opts["startingOffsets"] == "earliest" and opts["failOnDataLoss"] == "true"
    assert "kafka.sasl.mechanism" not in streams.kafka_options("h", "t")
