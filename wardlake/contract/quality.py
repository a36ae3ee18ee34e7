"""Registered queries: rules, profiles and monitors."""

from __future__ import annotations

import itertools
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from wardlake.bindings import ASOF, LOAD_TS, Bindings
from wardlake.contract.registry import query
from wardlake.contract.sinks import FAULT_RULE, faulty_encounters
from wardlake.contract.sources import store
from wardlake.contract.sqlbind import pct
from wardlake.operators import audit, dq, monitor, profile, rules, silver
from wardlake.session import shared_dir
from wardlake.streaming import progress, sinks


@query("dq_01_rule_split", "side:s rule:s n:i", """
    SELECT CASE WHEN reason_code IS NULL THEN 'rejected' ELSE 'clean' END AS side,
        CASE WHEN reason_code IS NULL THEN 'reason_present' END AS rule, count(*) AS n
    FROM encounter GROUP BY 1, 2""")
def rule_split(b: Bindings):
    """One rule that is NULL for some rows: NULL counts as rejected."""
    done = dq.split(b.encounters(), F.col("reason_code") >= "A", "reason_present", LOAD_TS)
    clean = done.clean.select(F.lit("clean").alias("side"), F.lit(None).cast("string").alias("rule"))
    bad = done.rejected.select(F.lit("rejected").alias("side"), F.col(dq.RULE).alias("rule"))
    return clean.unionByName(bad).groupBy("side", "rule").agg(F.count(F.lit(1)).alias("n"))


@query("dq_02_rule_chain", "encounter_bk:s rejected_rule:s", f"""
    SELECT encounter_bk, {FAULT_RULE} AS rejected_rule FROM encounter""")
def rule_chain(b: Bindings):
    """Every row with its first failing rule."""
    return dq.apply(faulty_encounters(b), rules.encounter(), LOAD_TS).tagged \
        .withColumnRenamed(dq.RULE, "rejected_rule")


@query("dq_03_patient_rules", "patient_bk:s rejected_rule:s", """
    SELECT patient_bk, CASE WHEN k % 31 = 0 THEN 'dob_present' WHEN k % 17 = 0 THEN 'gender_valid'
        WHEN date_of_birth + CASE WHEN k % 23 = 0 THEN 40000 ELSE 0 END > date '2001-08-01'
            THEN 'dob_not_in_future' END AS rejected_rule
    FROM (SELECT *, cast(patient_bk AS bigint) AS k FROM patient) AS x""")
def patient_rules(b: Bindings):
    k = F.col("patient_bk").cast("bigint")
    moved = F.date_add("date_of_birth", F.when(k % 23 == 0, 40000).otherwise(0))
    df = b.patients().withColumns({
        "date_of_birth": F.when(k % 31 != 0, moved),
        "gender": F.when(k % 17 == 0, F.lit("X")).otherwise(F.col("gender"))})
    return dq.apply(df, rules.patient(ASOF)).tagged.withColumnRenamed(dq.RULE, "rejected_rule")


@query("dq_04_provider_rules", "last_name:s rejected_rule:s", """
    SELECT last_name, CASE WHEN k % 7 = 0 THEN 'npi_present' WHEN k % 5 = 0 OR k % 9 = 0
        THEN 'npi_10_digits' END AS rejected_rule
    FROM (SELECT *, cast(provider_bk AS bigint) AS k FROM provider) AS x""")
def provider_rules(b: Bindings):
    """Missing, short and non-digit NPIs; letters at the right length are rejected too."""
    k = F.col("provider_bk").cast("bigint")
    bad = F.when(k % 7 == 0, F.lit(None).cast("string")) \
        .when(k % 5 == 0, F.substring("provider_bk", 2, 9)) \
        .when(k % 9 == 0, F.concat(F.lit("N"), F.substring("provider_bk", 2, 9))) \
        .otherwise(F.col("provider_bk"))
    df = b.providers().withColumn("provider_bk", bad)
    return dq.apply(df, rules.provider()).tagged.withColumnRenamed(dq.RULE, "rejected_rule")


@query("dq_05_encounter_rules", "side:s rule:s n:i", f"""
    SELECT CASE WHEN r IS NULL THEN 'clean' ELSE 'rejected' END AS side, r AS rule, count(*) AS n
    FROM (SELECT {FAULT_RULE} AS r FROM encounter) AS x GROUP BY 1, 2""")
def encounter_rules(b: Bindings):
    """Clean plus rejected equals the input."""
    done = dq.apply(faulty_encounters(b), rules.encounter(), LOAD_TS)
    side = F.when(F.col(dq.RULE).isNull(), F.lit("clean")).otherwise(F.lit("rejected"))
    return done.tagged.groupBy(side.alias("side"), F.col(dq.RULE).alias("rule")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("dq_06_claim_rules", "claim_bk:s rejected_rule:s", """
    SELECT claim_bk, CASE WHEN l_partkey % 37 = 0 THEN 'status_known'
        WHEN l_partkey % 41 = 0 THEN 'billed_non_negative'
        WHEN l_partkey % 43 = 0 THEN 'paid_le_billed'
        WHEN l_partkey % 11 = 0 AND decision_date IS NOT NULL THEN 'decision_after_submission' END
        AS rejected_rule FROM claim""")
def claim_rules(b: Bindings):
    """Faults by part key; paying one cent over the bill passes, two cents do not."""
    p = F.col("l_partkey")
    df = silver.derive_claim(silver.conform_claim(b.raw_claims(extra=["l_partkey"]), keep=["l_partkey"]))
    cent = F.lit("0.01").cast("decimal(12,2)")
    df = df.withColumns({
        "status": F.when(p % 37 == 0, F.lit("lost")).otherwise(F.col("status")),
        "billed_amount": F.when(p % 41 == 0, -F.col("billed_amount") - 1)
        .otherwise(F.col("billed_amount")),
        "paid_amount": F.when(p % 43 == 0, F.col("billed_amount") + cent + cent)
        .when(p % 47 == 0, F.col("billed_amount") + cent).otherwise(F.col("paid_amount")),
        "decision_date": F.when((p % 11 == 0) & F.col("decision_date").isNotNull(),
                                F.date_sub("submission_date", 1)).otherwise(F.col("decision_date")),
    })
    return dq.apply(df, rules.claim()).tagged.withColumnRenamed(dq.RULE, "rejected_rule")


@query("dq_07_rule_report", "rule_order:i rule:s total:i rejected:i rejected_pct:d", f"""
    SELECT rule_order, rule, total, rejected, {pct('rejected', 'total')} AS rejected_pct FROM (
        SELECT o AS rule_order, r.rule, count(*) FILTER (x.first IS NULL OR x.first >= o) AS total,
            count(*) FILTER (x.first = o) AS rejected
        FROM (SELECT CASE WHEN k % 101 = 0 THEN 2 WHEN k % 97 = 0 THEN 3 WHEN k % 89 = 0 THEN 4
            WHEN k % 83 = 0 AND total_cost_usd > 0 THEN 5 END AS first FROM encounter) AS x
        CROSS JOIN (VALUES (1, 'encounter_id_present'), (2, 'patient_id_present'),
            (3, 'start_at_present'), (4, 'end_after_start'), (5, 'non_negative_cost')) AS r(o, rule)
        GROUP BY o, r.rule) AS y""")
def rule_report(b: Bindings):
    return dq.apply(faulty_encounters(b), rules.encounter(), LOAD_TS).metrics()


@query("dq_09_referential", "total:i missing:i missing_pct:d", f"""
    SELECT count(*) AS total, count(*) FILTER (o_orderkey IS NULL) AS missing,
        {pct('count(*) FILTER (o_orderkey IS NULL)', 'count(*)')} AS missing_pct
    FROM claim LEFT JOIN orders ON cast(o_orderkey AS varchar) = encounter_bk""")
def referential(b: Bindings):
    return profile.ri(b.claims(), "encounter_bk", b.encounters(), "encounter_bk")


@query("dq_10_null_rates", "column_name:s null_rate:r", """
    SELECT * FROM (UNPIVOT (SELECT avg((end_at IS NULL)::int) AS end_at,
        avg((reason_code IS NULL)::int) AS reason_code, avg((start_at IS NULL)::int) AS start_at,
        avg((total_cost_usd IS NULL)::int) AS total_cost_usd FROM encounter)
        ON COLUMNS(*) INTO NAME column_name VALUE null_rate) AS u""")
def null_rates(b: Bindings):
    return profile.null_rates(b.encounters().select("end_at", "reason_code", "start_at",
                                                    "total_cost_usd"))


@query("dq_11_numeric_summary", "n:i mean:r std:r lo:d hi:d p25:r p50:r p75:r p99:r clipped_max:r "
       "high_fence:r", """
    WITH s AS (SELECT cast(total_cost_usd AS double) AS v FROM encounter),
    q AS (SELECT quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50,
        quantile_cont(v, 0.75) AS p75, quantile_cont(v, 0.99) AS p99,
        count(*) AS n, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS lo, max(v) AS hi FROM s)
    SELECT q.*, p99 AS clipped_max, p75 + 1.5 * (p75 - p25) AS high_fence FROM q""")
def numeric_summary(b: Bindings):
    """Describe, 99th-percentile clip and box fences of one measure."""
    enc = b.encounters()
    clipped = profile.clip_at(enc, "total_cost_usd", 0.99).agg(F.max("total_cost_usd").alias("m"))
    fence = profile.box(enc, "total_cost_usd").select("high_fence")
    return profile.numeric(enc, "total_cost_usd").withColumns(
        {"clipped_max": clipped.scalar(), "high_fence": fence.scalar()})


@query("dq_12_top_values", "icd10_code:s n:i", """
    SELECT icd10_code, count(*) AS n FROM condition_feed GROUP BY 1 ORDER BY n DESC, icd10_code LIMIT 15""")
def top_values(b: Bindings):
    return profile.top_values(b.conditions(), "icd10_code", 15)


@query("dq_13_histogram", "bin:i n:i", """
    WITH v AS (SELECT count(*) AS v FROM condition_feed GROUP BY patient_bk),
    s AS (SELECT min(v) AS lo, (max(v) - min(v)) / 25.0::double AS w FROM v)
    SELECT CASE WHEN w > 0 THEN least(floor((v - lo) / w), 24) ELSE 0 END AS bin, count(*) AS n
    FROM v, s GROUP BY 1""")
def histogram(b: Bindings):
    """Conditions per patient in 25 equal bins."""
    per = b.conditions().groupBy("patient_bk").agg(F.count(F.lit(1)).alias("v"))
    return profile.histogram(per, "v", 25)


@query("dq_14_monthly_resample", "month:s n:i", """
    WITH d AS (SELECT date_trunc('month', CASE WHEN month(onset_date) = 5 THEN onset_date + interval 1 month
            ELSE onset_date END)::date AS m, count(*) AS n FROM condition_feed GROUP BY 1)
    SELECT c.month::date AS month, coalesce(n, 0) AS n
    FROM (SELECT unnest(generate_series((SELECT min(m) FROM d)::timestamp,
        (SELECT max(m) FROM d)::timestamp, interval 1 month)) AS month) AS c
    LEFT JOIN d ON d.m = c.month::date""")
def monthly_resample(b: Bindings):
    """All rows; those of May count in June, so each May appears with 0."""
    moved = F.when(F.month("onset_date") == 5, F.add_months("onset_date", 1)).otherwise(F.col("onset_date"))
    return profile.monthly(b.conditions().withColumn("onset_date", moved), "onset_date")


@query("dq_15_correlation", "col_a:s col_b:s corr:r", """
    WITH c AS (SELECT corr(total_cost_usd::double, payer_coverage_usd::double) AS tp,
        corr(total_cost_usd::double, length_of_stay_hours::double) AS tl,
        corr(payer_coverage_usd::double, length_of_stay_hours::double) AS pl FROM encounter)
    SELECT 'total_cost_usd' AS col_a, 'total_cost_usd' AS col_b, 1.0 AS corr
    UNION ALL SELECT 'payer_coverage_usd', 'payer_coverage_usd', 1.0
    UNION ALL SELECT 'length_of_stay_hours', 'length_of_stay_hours', 1.0
    UNION ALL SELECT 'total_cost_usd', 'payer_coverage_usd', tp FROM c
    UNION ALL SELECT 'payer_coverage_usd', 'total_cost_usd', tp FROM c
    UNION ALL SELECT 'total_cost_usd', 'length_of_stay_hours', tl FROM c
    UNION ALL SELECT 'length_of_stay_hours', 'total_cost_usd', tl FROM c
    UNION ALL SELECT 'payer_coverage_usd', 'length_of_stay_hours', pl FROM c
    UNION ALL SELECT 'length_of_stay_hours', 'payer_coverage_usd', pl FROM c""")
def correlation(b: Bindings):
    return profile.corr(b.encounters(), ["total_cost_usd", "payer_coverage_usd",
                                         "length_of_stay_hours"])


LOADS = 10
#: SQL of the delivery that an order came with: eight of equal size, a larger one and one of half size.
LOAD_SQL = "(CASE WHEN o_orderkey % 20 < 16 THEN o_orderkey % 20 // 2 WHEN o_orderkey % 20 < 19 THEN 8 ELSE 9 END)"


def delivered(b: Bindings, load: int):
    """One of LOADS deliveries of the encounter feed; each order is in one."""
    rest = F.col("Id").cast("bigint") % 20
    number = F.when(rest < 16, F.floor(rest / 2)).when(rest < 19, 8).otherwise(9)
    return b.raw_encounters().where(number == load)


def audited(b: Bindings, loads: range, silver_too: bool):
    """The audit of a run per delivery, a day apart: Bronze and, if asked for, Silver of what came.

    Its clock moves on by a minute whenever it is read, in the last run by 45 minutes.
    """
    lake = store(b)
    for load in loads:
        ticks = itertools.count()
        step, begin = timedelta(minutes=45 if load == loads[-1] else 1), datetime(2001, 7, 20) + timedelta(days=load)

        def clock(ticks=ticks, step=step, begin=begin) -> datetime:
            return (begin + next(ticks) * step).replace(tzinfo=timezone.utc)

        with audit.run(lake, "night", f"run-{load}", clock):
            rows = delivered(b, load)
            audit.observed_append(lake, rows, "bronze", "synthea_encounters")
            if silver_too:
                known = F.when(F.col("encounter_bk").cast("bigint") % 13 != 0, F.col("start_at"))
                stays = silver.derive_encounter(silver.conform_encounter(rows)).withColumn("start_at", known)
                checked = dq.apply(stays, rules.encounter(), LOAD_TS + timedelta(days=load))
                audit.observed_silver(lake, checked, lambda clean: clean, "silver/fact_encounter")
    return lake.read(audit.TABLE)


DELIVERED_SQL = f"""(SELECT {LOAD_SQL} AS load, count(*) AS n, count(*) FILTER (o_orderkey % 13 = 0) AS bad,
        timestamp '2001-07-20' + to_days(cast({LOAD_SQL} AS integer)) AS began FROM orders GROUP BY {LOAD_SQL})"""
RULES_SQL = """(VALUES ('encounter_id_present'), ('patient_id_present'), ('start_at_present'),
        ('end_after_start'), ('non_negative_cost')) AS r(rule)"""


@query("dq_16_rejection_rate", "object_name:s rule:s rejected_share:r", f"""
    SELECT 'silver/fact_encounter' AS object_name, rule, avg(CASE WHEN rule = 'start_at_present'
        THEN bad ELSE 0 END::double / n) AS rejected_share
    FROM {DELIVERED_SQL} AS d CROSS JOIN {RULES_SQL} WHERE load IN (1, 2) GROUP BY rule""")
def rejection_rate(b: Bindings):
    """Three nights, of which the first is older than the days looked at."""
    return monitor.rejection_rate(audited(b, range(0, 3), True), datetime(2001, 7, 28), 7)


@query("dq_17_volume_drop", "object_name:s day:s rows_written:i trailing_mean:r is_drop:b", f"""
    SELECT *, coalesce(rows_written < 0.5 * trailing_mean, false) AS is_drop FROM (
        SELECT 'synthea_encounters' AS object_name, began::date AS day, n AS rows_written, avg(n) OVER (
            ORDER BY load ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS trailing_mean
        FROM {DELIVERED_SQL} AS d) AS x""")
def volume_drop(b: Bindings):
    """Ten nights of Bronze, the last with half a delivery."""
    return monitor.volume_drop(audited(b, range(LOADS), False))


@query("dq_18_run_history", "run_id:s run_name:s status:s started_at:s duration_s:i loads:i rows_written:i", f"""
    SELECT 'run-' || load AS run_id, 'night' AS run_name, 'success' AS status, began AS started_at,
        5 * CASE WHEN load = 2 THEN 45 * 60 ELSE 60 END AS duration_s, 2 AS loads, 2 * n - bad AS rows_written
    FROM {DELIVERED_SQL} AS d WHERE load < 3""")
def run_history(b: Bindings):
    """One row per night, whatever number of tables and rules it wrote rows for."""
    return monitor.runs(audited(b, range(3), True), 50)


@query("dq_19_row_counts", "table_name:s n:i", """
    SELECT 'dim_patient' AS table_name, count(*) AS n FROM patient
    UNION ALL SELECT 'dim_provider', count(*) FROM provider
    UNION ALL SELECT 'dim_hospital', count(*) FROM facility
    UNION ALL SELECT 'dim_payer', count(*) FROM payer
    UNION ALL SELECT 'dim_diagnosis', count(*) FROM diagnosis
    UNION ALL SELECT 'fact_encounter', count(*) FROM encounter
    UNION ALL SELECT 'fact_claim', count(*) FROM claim
    UNION ALL SELECT 'fact_vital_signs_minute', count(*) FROM minute_all""")
def row_counts(b: Bindings):
    return monitor.row_counts(b.star("dim_patient", "dim_provider", "dim_hospital", "dim_payer",
                                     "dim_diagnosis", "fact_encounter", "fact_claim",
                                     "fact_vital_signs_minute"))


@query("dq_20_stream_lag", "minute:s max_lag_s:i n:i is_late:b", """
    SELECT minute, max(lag) AS max_lag_s, count(*) AS n, max(lag) > 120 AS is_late
    FROM (SELECT date_trunc('minute', ts + to_seconds(cast(event_id % 200 AS integer))) AS minute,
        floor(epoch(ts + to_seconds(cast(event_id % 200 AS integer)))) - floor(epoch(ts)) AS lag
        FROM events) AS x GROUP BY 1""")
def stream_lag(b: Bindings):
    """Arrival trails the event by up to 199 seconds."""
    late = F.timestamp_add("SECOND", (F.col("event_id").cast("int") % 200), F.col("event_ts"))
    return monitor.stream_lag(b.as_vitals(b.events()).withColumn("arrival_ts", late))


@query("dq_20_stream_progress", "input_rows:i max_lag_s:i is_late:b", """
    SELECT count(*) AS input_rows, max(lag) AS max_lag_s, max(lag) > 120 AS is_late
    FROM (SELECT event_id % 4 AS part, floor(epoch(ts + to_seconds(cast(event_id % (50 * (event_id % 4 + 1)) AS integer))))
        - floor(epoch(ts)) AS lag FROM events) AS x GROUP BY part""")
def stream_progress(b: Bindings):
    """A replay of the events in four micro-batches, of which a listener writes the progress."""
    root, lake = shared_dir(b.spark, "progress"), store(b)
    part, event = F.col("event_id") % 4, F.col("event_id").cast("bigint")
    b.events().repartition(4, part).withColumn("part", part).write.partitionBy("part").parquet(f"{root}/in")
    rows = b.spark.readStream.schema(b.events().schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True) \
        .parquet(f"{root}/in")
    late = F.timestamp_add("SECOND", (event % (50 * (event % 4 + 1))).cast("int"), F.col("event_ts"))
    log = progress.ProgressLog(lake)
    b.spark.streams.addListener(log)
    try:
        readings = progress.with_lag(b.as_vitals(rows).withColumn("arrival_ts", late))
        query = sinks.write_append(readings, f"{root}/out", f"{root}/ckpt", None)
        sinks.await_all(b.spark, [query])
        log.wait([query])
    finally:
        b.spark.streams.removeListener(log)
    return monitor.batch_lag(lake.read(progress.TABLE))


@query("dq_21_claim_in_encounter", "claim_bk:s rejected_rule:s", """
    SELECT claim_bk, CASE WHEN e.encounter_bk IS NULL THEN NULL
        WHEN service_date >= start_at::date AND (end_at IS NULL OR service_date <= end_at::date)
            THEN NULL ELSE 'service_in_encounter' END AS rejected_rule
    FROM claim AS c LEFT JOIN encounter AS e ON e.encounter_bk = c.encounter_bk""")
def claim_in_encounter(b: Bindings):
    return dq.claim_in_encounter(b.claims(), b.encounters()).tagged \
        .withColumnRenamed(dq.RULE, "rejected_rule")


@query("dq_22_known_code", "icd10_code:s rejected_rule:s n:i", """
    SELECT icd10_code, CASE WHEN icd10_code >= 'T' THEN 'code_known' END AS rejected_rule,
        count(*) AS n FROM condition_feed GROUP BY 1, 2""")
def known_code(b: Bindings):
    """The code table ends before T, so later codes go to quarantine."""
    ref = b.dim_diagnosis.where("icd10_code < 'T'")
    done = dq.known_code(b.conditions(), "icd10_code", ref, "icd10_code")
    return done.tagged.groupBy("icd10_code", F.col(dq.RULE).alias("rejected_rule")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("dq_23_alerts", "metric:s subject:s alerts:i highest:r", f"""
    SELECT metric, subject, count(*) AS alerts, max(value) AS highest FROM (
        SELECT 'rejection_pct' AS metric, 'silver/fact_encounter' || s AS subject,
            100.0::double * bad / n AS value, 1.0 AS lim FROM {DELIVERED_SQL} AS d
            CROSS JOIN (VALUES (''), ('/start_at_present')) AS x(s) WHERE load < 3
        UNION ALL SELECT 'run_minutes', 'run-2', 5 * 45, 90.0
        UNION ALL SELECT 'orphan_pct', 'fact_claim',
            {pct('count(*) FILTER (encounter_sk IS NULL)', 'count(*)')}, 2.0 FROM fact_claim) AS m
    WHERE value > lim GROUP BY 1, 2""")
def alerts(b: Bindings):
    """The audit of three nights, one of them over three hours long, and the orphan rate against their limits."""
    metrics = monitor.audit_metrics(audited(b, range(3), True)).unionByName(
        monitor.orphan_metric(b.fact_claim(check=True)))
    return monitor.alerts(metrics, monitor.limits_table(b.spark)).groupBy("metric", "subject").agg(
        F.count(F.lit(1)).alias("alerts"), F.max("value").alias("highest"))
