"""Registered queries: joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wardlake.bindings import ASOF, CHRONIC, LOAD_TS, Bindings
from wardlake.contract.registry import query
from wardlake.contract.sinks import DAILY_COLS, daily_sql
from wardlake.contract.sqlbind import avg2, cents, pct, ratio4
from wardlake.functions import clinical
from wardlake.functions import measures as m
from wardlake.functions.ordering import percentiles
from wardlake.operators import dims, dq, facts, profile, rules, scd, silver
from wardlake.plans import analytics, kpi, queries, views
from wardlake.streaming import vitals

CHRONIC_SQL = "(icd10_code LIKE 'E%' OR icd10_code LIKE 'I%')"


# --- joins ---------------------------------------------------------------------


@query("j_01_inner_equi", "hospital_name:s n:i total:d", """
    SELECT hospital_name, count(*) AS n, sum(total_cost_usd) AS total
    FROM fact_encounter JOIN facility USING (hospital_sk) GROUP BY 1""")
def inner_equi(b: Bindings):
    return b.fact_encounter().join(b.dim_hospital, "hospital_sk").groupBy("hospital_name").agg(
        m.rows().alias("n"), F.sum("total_cost_usd").alias("total"))


@query("j_02_left_enrichment", "encounter_bk:s provider_name:s", """
    SELECT e.encounter_bk, p.full_name AS provider_name FROM encounter AS e
    LEFT JOIN first_supplier AS s USING (encounter_bk)
    LEFT JOIN provider AS p ON p.provider_bk = s.provider_bk""")
def left_enrichment(b: Bindings):
    names = b.providers().select("provider_bk", F.col("full_name").alias("provider_name"))
    return b.encounters(provider=True).join(names, "provider_bk", "left")


def two_loads(b: Bindings):
    """A tenth of the patients is new in the second load, another tenth is missing there; every patient is in one."""
    k = F.col("patient_bk").cast("bigint")
    base = dims.patient_incoming(b.patients())
    first = scd.first_load(base.where(k % 10 != 0), scd.PATIENT_ATTRS, datetime(1900, 1, 1))
    second = base.where(k % 10 != 3).withColumn(
        "marital_status",
        F.when(k % 7 == 0, F.lit("CHANGED")).otherwise(F.col("marital_status")))
    return first, second


def two_versions(b: Bindings):
    """Patient dimension after a second load: moved, missing and new patients."""
    first, second = two_loads(b)
    return scd.merge2(first, second, ["patient_bk"], scd.PATIENT_ATTRS, datetime(1998, 1, 1))


VERSIONS_SQL = """(
    SELECT patient_bk, patient_sk, marital_status, governorate, timestamp '1900-01-01' AS effective_from,
        CASE WHEN k % 7 = 0 AND k % 10 <> 3 THEN timestamp '1998-01-01' END AS effective_to,
        NOT (k % 7 = 0 AND k % 10 <> 3) AS is_current
    FROM (SELECT *, cast(patient_bk AS bigint) AS k FROM patient) AS x WHERE k % 10 <> 0
    UNION ALL
    SELECT patient_bk, patient_sk, CASE WHEN k % 7 = 0 THEN 'CHANGED' ELSE marital_status END,
        governorate, timestamp '1998-01-01', NULL, true
    FROM (SELECT *, cast(patient_bk AS bigint) AS k FROM patient) AS x
    WHERE k % 10 <> 3 AND (k % 10 = 0 OR k % 7 = 0))"""


@query("j_03_current_version", "encounter_bk:s marital_status:s", f"""
    SELECT e.encounter_bk, p.marital_status FROM encounter AS e LEFT JOIN {VERSIONS_SQL} AS p
    ON p.patient_bk = e.patient_bk AND p.is_current""")
def current_version(b: Bindings):
    """Only the open version joins; encounters without one stay."""
    now = two_versions(b).where("is_current").select("patient_bk", "marital_status")
    return b.encounters().join(now, "patient_bk", "left")


@query("j_04_role_playing_date", "service_month:s decision_month:s n:i", """
    SELECT s.month_name AS service_month, d.month_name AS decision_month, count(*) AS n
    FROM fact_claim AS c JOIN calendar AS s ON s.date_sk = c.service_date_sk
    LEFT JOIN calendar AS d ON d.date_sk = c.decision_date_sk GROUP BY 1, 2""")
def role_playing_date(b: Bindings):
    s, d = F.broadcast(b.dim_date).alias("s"), F.broadcast(b.dim_date).alias("d")
    return (
        b.fact_claim().alias("c").join(s, F.col("s.date_sk") == F.col("c.service_date_sk"))
        .join(d, F.col("d.date_sk") == F.col("c.decision_date_sk"), "left")
        .groupBy(F.col("s.month_name").alias("service_month"),
                 F.col("d.month_name").alias("decision_month")).agg(m.rows().alias("n"))
    )


@query("j_05_new_or_changed", "patient_bk:s change:s", """
    SELECT patient_bk, CASE WHEN k % 10 = 0 THEN 'new' ELSE 'changed' END AS change
    FROM (SELECT *, cast(patient_bk AS bigint) AS k FROM patient) AS x
    WHERE k % 10 <> 3 AND (k % 10 = 0 OR k % 7 = 0)""")
def new_or_changed(b: Bindings):
    return scd.changed(*two_loads(b), ["patient_bk"], scd.PATIENT_ATTRS, LOAD_TS)


@query("j_07_code_semi_join", "icd10_code:s n:i", f"""
    SELECT icd10_code, count(*) AS n FROM condition_feed WHERE {CHRONIC_SQL} GROUP BY 1""")
def code_semi_join(b: Bindings):
    return clinical.in_codes(b.conditions(), "icd10_code", CHRONIC).groupBy("icd10_code") \
        .agg(m.rows().alias("n"))


@query("j_08_point_in_time", "encounter_bk:s marital_status:s effective_from:s", f"""
    SELECT e.encounter_bk, p.marital_status, p.effective_from FROM encounter AS e
    LEFT JOIN {VERSIONS_SQL} AS p ON p.patient_bk = e.patient_bk
        AND e.start_at >= p.effective_from AND (p.effective_to IS NULL OR e.start_at < p.effective_to)""")
def point_in_time(b: Bindings):
    """The version in force when the encounter started, half-open at the change."""
    versions = two_versions(b)
    dim = versions.withColumn("valid_from", F.col("effective_from"))
    return scd.as_of(b.encounters(), dim, "patient_bk", "start_at", ["marital_status", "valid_from"]) \
        .withColumnRenamed("valid_from", "effective_from")


@query("j_09_bridge_traversal", "hospital_name:s chapter:s encounters:i", """
    SELECT hospital_name, chapter, count(DISTINCT f.encounter_sk) AS encounters
    FROM bridge AS g JOIN fact_encounter AS f ON f.encounter_sk = g.encounter_sk
    JOIN diagnosis AS d ON d.diagnosis_sk = g.diagnosis_sk
    JOIN facility AS h ON h.hospital_sk = f.hospital_sk GROUP BY 1, 2""")
def bridge_traversal(b: Bindings):
    """Chapters are looked up on the small side first, then counted per encounter once."""
    chapters = b.bridge.join(b.dim_diagnosis.select("diagnosis_sk", "chapter"), "diagnosis_sk") \
        .select("encounter_sk", "chapter").distinct()
    return (
        chapters.join(b.fact_encounter().select("encounter_sk", "hospital_sk"), "encounter_sk")
        .groupBy("hospital_sk", "chapter").agg(m.rows().alias("encounters"))
        .join(b.dim_hospital.select("hospital_sk", "hospital_name"), "hospital_sk")
    )


@query("j_10_anti_join_orphans", "claim_bk:s encounter_bk:s", """
    SELECT claim_bk, encounter_bk FROM claim AS c
    WHERE NOT EXISTS (SELECT 1 FROM encounter AS e WHERE e.encounter_bk = c.encounter_bk)""")
def anti_join_orphans(b: Bindings):
    return profile.orphans(b.claims(), "encounter_bk", b.encounters(), "encounter_bk")


@query("j_11_number_generator", "year:i days:i", """
    SELECT year(start_at) AS year, date_diff('day', date_trunc('year', min(start_at)),
        date_trunc('year', min(start_at)) + interval 1 year) AS days FROM encounter GROUP BY 1""")
def number_generator(b: Bindings):
    """Days of every year that has encounters, from a generated calendar."""
    years = b.encounters().select(F.year("start_at").alias("y")).distinct()
    per = b.dim_date.groupBy("year").agg(m.rows().alias("days"))
    return per.join(years, F.col("year") == F.col("y"), "left_semi")


@query("j_13_facility_metrics", "hospital_name:s encounters:i avg_cost:d readmit:d emergency:i denial:d",
       f"""
    SELECT h.hospital_name, e.n AS encounters, e.avg_cost, e.readmit, e.emergency,
        coalesce(c.denial, 0) AS denial
    FROM facility AS h JOIN (SELECT hospital_sk, count(*) AS n,
            (2 * sum(cast(total_cost_usd * 100 AS hugeint)) + 100 * count(total_cost_usd))
                // (200 * count(total_cost_usd)) AS avg_cost,
            {pct('count(*) FILTER (is_readmission_30d)', 'count(*)', 1)} AS readmit,
            count(*) FILTER (is_emergency) AS emergency FROM fact_encounter GROUP BY 1) AS e
        ON e.hospital_sk = h.hospital_sk
    LEFT JOIN (SELECT hospital_sk, {pct('count(*) FILTER (is_denied)', 'count(*)', 1)} AS denial
        FROM fact_claim GROUP BY 1) AS c ON c.hospital_sk = h.hospital_sk""")
def facility_metrics(b: Bindings):
    """Facilities without claims keep a denial rate of 0."""
    return kpi.facility_map(b.fact_encounter(readmission=True), b.fact_claim(), b.dim_hospital)


@query("j_14_co_occurrence", "code_a:s code_b:s patients:i", f"""
    WITH s AS (SELECT DISTINCT patient_bk, icd10_code FROM condition_feed WHERE {CHRONIC_SQL})
    SELECT x.icd10_code AS code_a, y.icd10_code AS code_b, count(*) AS patients
    FROM s AS x JOIN s AS y ON x.patient_bk = y.patient_bk AND x.icd10_code < y.icd10_code
    GROUP BY 1, 2""")
def co_occurrence(b: Bindings):
    return analytics.co_occurrence(b.conditions(), CHRONIC)


# --- aggregations ----------------------------------------------------------------


@query("agg_01_grouped_measures", "encounter_class:s n:i total:d mean:d lo:d hi:d", f"""
    SELECT encounter_class, count(*) AS n, sum(total_cost_usd) AS total,
        {avg2('total_cost_usd')} AS mean, min(total_cost_usd) AS lo, max(total_cost_usd) AS hi
    FROM encounter GROUP BY 1""")
def grouped_measures(b: Bindings):
    c = "total_cost_usd"
    return b.encounters().groupBy("encounter_class").agg(
        m.rows().alias("n"), m.money(c).alias("total"), m.mean(c, "decimal(12,2)").alias("mean"),
        F.min(c).alias("lo"), F.max(c).alias("hi"))


@query("agg_02_conditional_sums", "carrier:s denied:i denied_billed:d open_claims:i", """
    SELECT carrier, count(*) FILTER (is_denied) AS denied,
        coalesce(sum(billed_amount) FILTER (is_denied), 0) AS denied_billed,
        count(*) FILTER (pending_amount > 0) AS open_claims FROM claim GROUP BY 1""")
def conditional_sums(b: Bindings):
    return b.claims().groupBy("carrier").agg(
        m.count_where(F.col("is_denied")).alias("denied"),
        m.sum_where(F.col("is_denied"), "billed_amount").alias("denied_billed"),
        m.count_where(F.col("pending_amount") > 0).alias("open_claims"))


@query("agg_03_safe_ratio", "service_year_month:s paid_of_decided_pct:d", f"""
    SELECT service_year_month, CASE WHEN coalesce(sum(d), 0) > 0 THEN
        {pct(cents('sum(paid_amount)'), cents('sum(d)'))} END AS paid_of_decided_pct
    FROM (SELECT *, CASE WHEN l_linestatus = 'F' AND month(service_date) <> 2 THEN billed_amount END AS d
        FROM claim) AS x GROUP BY 1""")
def safe_ratio(b: Bindings):
    """February has an empty denominator and yields NULL."""
    rows = silver.derive_claim(silver.conform_claim(
        b.raw_claims(extra=["l_linestatus"]), keep=["l_linestatus"]))
    den = F.when((F.col("l_linestatus") == "F") & (F.month("service_date") != 2),
                 F.col("billed_amount"))
    return rows.groupBy("service_year_month").agg(
        m.pct(F.sum("paid_amount"), F.sum(den), "decimal(9,2)").alias("paid_of_decided_pct"))


@query("agg_04_count_distinct", "encounter_class:s patients:i days:i organizations:i", """
    SELECT encounter_class, count(DISTINCT patient_bk) AS patients,
        count(DISTINCT start_at::date) AS days, count(DISTINCT organization_bk) AS organizations
    FROM encounter GROUP BY 1""")
def count_distinct(b: Bindings):
    return b.encounters().groupBy("encounter_class").agg(
        F.count_distinct("patient_bk").alias("patients"),
        F.count_distinct(F.to_date("start_at")).alias("days"),
        F.count_distinct("organization_bk").alias("organizations"))


@query("agg_05_having", "patient_bk:s n:i", """
    SELECT patient_bk, count(*) AS n FROM encounter GROUP BY 1 HAVING count(*) >= 12""")
def having(b: Bindings):
    return b.encounters().groupBy("patient_bk").agg(m.rows().alias("n")).where(F.col("n") >= 12)


@query("agg_06_distinct_dimension", "payer_name:s", """
    SELECT DISTINCT carrier AS payer_name FROM claim WHERE carrier IS NOT NULL""")
def distinct_dimension(b: Bindings):
    return b.claims().select(F.col("carrier").alias("payer_name")) \
        .where(F.col("payer_name").isNotNull()).distinct()


@query("agg_07_representative", "icd10_code:s smallest:s latest_carrier:s common_status:s", """
    SELECT a.icd10_code, smallest, latest_carrier, common_status
    FROM (SELECT primary_icd10_code AS icd10_code, min(primary_diagnosis_description) AS smallest
        FROM claim GROUP BY 1) AS a
    JOIN (SELECT primary_icd10_code AS c, carrier AS latest_carrier FROM (SELECT *, row_number() OVER (
        PARTITION BY primary_icd10_code ORDER BY service_date DESC, claim_bk DESC) AS rn FROM claim)
        AS r WHERE rn = 1) AS l ON l.c = a.icd10_code
    JOIN (SELECT c, status AS common_status FROM (SELECT primary_icd10_code AS c, status,
        row_number() OVER (PARTITION BY primary_icd10_code ORDER BY count(*) DESC, status) AS rn
        FROM claim GROUP BY 1, 2) AS r WHERE rn = 1) AS s ON s.c = a.icd10_code""")
def representative(b: Bindings):
    """Deterministic stand-ins for "any value": smallest, latest, most frequent."""
    return b.claims().groupBy(F.col("primary_icd10_code").alias("icd10_code")).agg(
        F.min("primary_diagnosis_description").alias("smallest"),
        F.max_by("carrier", F.struct("service_date", "claim_bk")).alias("latest_carrier"),
        F.mode("status", True).alias("common_status"))


@query("agg_08_boolean_mean", "hospital_bk:s denied_share:r", """
    SELECT hospital_bk, avg(is_denied::int) AS denied_share FROM claim GROUP BY 1""")
def boolean_mean(b: Bindings):
    return b.claims().groupBy("hospital_bk").agg(
        F.avg(F.col("is_denied").cast("int")).alias("denied_share"))


@query("agg_09_median", "encounter_class:s median_cost:r", """
    SELECT encounter_class, quantile_cont(total_cost_usd::double, 0.5) AS median_cost
    FROM encounter GROUP BY 1""")
def median(b: Bindings):
    return percentiles(b.encounters(), ["encounter_class"], "total_cost_usd", {"median_cost": 0.5})


@query("agg_10_daily_cube", DAILY_COLS, daily_sql("start_date_sk BETWEEN 20010627 AND 20010801"))
def daily_cube(b: Bindings):
    """The default window: 35 days up to the as-of date."""
    return kpi.daily(b.fact_encounter(readmission=True), ASOF - timedelta(days=35), ASOF, LOAD_TS)


@query("agg_11_two_level_cohort", "conditions:i patients:i", f"""
    SELECT k AS conditions, count(*) AS patients FROM (
        SELECT patient_bk, count(DISTINCT icd10_code) AS k FROM condition_feed
        WHERE {CHRONIC_SQL} GROUP BY 1 HAVING count(DISTINCT icd10_code) >= 2) AS x GROUP BY 1""")
def two_level_cohort(b: Bindings):
    per = clinical.in_codes(b.conditions(), "icd10_code", CHRONIC).groupBy("patient_bk") \
        .agg(F.count_distinct("icd10_code").alias("conditions")).where("conditions >= 2")
    return per.groupBy("conditions").agg(m.rows().alias("patients"))


@query("agg_12_category_mode", "device_id:s kind:s", """
    SELECT device_id, kind FROM (SELECT device_id, kind, row_number() OVER (PARTITION BY device_id
        ORDER BY count(*) DESC, kind) AS rn FROM reading WHERE is_anomaly GROUP BY 1, 2) AS x
    WHERE rn = 1""")
def category_mode(b: Bindings):
    flagged = vitals.flag_anomalies(b.as_vitals(b.events())).where("derived_anomaly")
    return flagged.groupBy("device_id").agg(F.mode("derived_anomaly_kind", True).alias("kind"))


@query("agg_13_grouping_sets", "carrier:s month:s grouping_level:i claims:i denied:i denial_pct:d", f"""
    SELECT carrier, service_year_month AS month, grouping(carrier) * 2 + grouping(service_year_month)
        AS grouping_level, count(*) AS claims, count(*) FILTER (is_denied) AS denied,
        {pct('count(*) FILTER (is_denied)', 'count(*)')} AS denial_pct
    FROM claim GROUP BY GROUPING SETS ((carrier, service_year_month), (carrier),
        (service_year_month), ())""")
def grouping_sets(b: Bindings):
    return analytics.denial_sets(b.claims()).withColumnRenamed("service_year_month", "month")


@query("agg_14_pivot", "governorate:s ambulatory:i emergency:i inpatient:i wellness:i", """
    SELECT governorate, count(*) FILTER (encounter_class = 'ambulatory') AS ambulatory,
        count(*) FILTER (encounter_class = 'emergency') AS emergency,
        count(*) FILTER (encounter_class = 'inpatient') AS inpatient,
        count(*) FILTER (encounter_class = 'wellness') AS wellness
    FROM fact_encounter JOIN facility USING (hospital_sk) GROUP BY 1""")
def pivot(b: Bindings):
    rows = b.fact_encounter().join(b.dim_hospital.select("hospital_sk", "governorate"), "hospital_sk")
    return analytics.pivot_counts(rows, ["governorate"], "encounter_class",
                                  ["ambulatory", "emergency", "inpatient", "wellness"])


@query("agg_15_anomaly_times", "hour_of_day:i shift:s anomalies:i devices:i", """
    SELECT hour(ts) AS hour_of_day, CASE WHEN hour(ts) BETWEEN 7 AND 14 THEN 'morning'
        WHEN hour(ts) BETWEEN 15 AND 22 THEN 'afternoon' ELSE 'night' END AS shift,
        count(*) AS anomalies, count(DISTINCT device_id) AS devices
    FROM reading WHERE is_anomaly GROUP BY 1, 2""")
def anomaly_times(b: Bindings):
    return analytics.anomaly_times(vitals.flag_anomalies(b.as_vitals(b.events())))


@query("agg_16_los_outliers", "reason_code:s stays:i median_los:r outliers:i outlier_pct:d", f"""
    WITH s AS (SELECT reason_code, length_of_stay_hours::double AS v FROM encounter
        WHERE is_inpatient AND end_at IS NOT NULL AND reason_code IS NOT NULL),
    q AS (SELECT reason_code, quantile_cont(v, 0.5) AS median_los, quantile_cont(v, 0.75)
        + 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS fence FROM s GROUP BY 1)
    SELECT reason_code, count(*) AS stays, median_los, count(*) FILTER (v > fence) AS outliers,
        {pct('count(*) FILTER (v > fence)', 'count(*)')} AS outlier_pct
    FROM s JOIN q USING (reason_code) GROUP BY reason_code, median_los""")
def los_outliers(b: Bindings):
    return analytics.los_outliers(b.encounters(), "reason_code")


# --- windows ---------------------------------------------------------------------


@query("win_01_latest_wins", "l_orderkey:i l_linenumber:i l_shipdate:s l_partkey:i l_suppkey:i "
       "l_quantity:d l_extendedprice:d", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
        l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
        FROM lineitem) AS x WHERE rn = 1""")
def latest_wins(b: Bindings):
    """The line keys repeat in the given table, so every repeat must lose to the latest."""
    return dq.latest(b.table("lineitem"), ["l_orderkey", "l_linenumber"],
                     ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])


@query("win_02_readmission", "encounter_bk:s is_readmission_30d:b", """
    SELECT encounter_bk, is_readmission_30d FROM readmit""")
def readmission(b: Bindings):
    return b.encounters(readmission=True)


@query("win_03_top_n_per_group", "hospital_bk:s primary_icd10_code:s n:i", """
    SELECT hospital_bk, primary_icd10_code, n FROM (SELECT hospital_bk, primary_icd10_code,
        count(*) AS n, row_number() OVER (PARTITION BY hospital_bk ORDER BY count(*) DESC,
            primary_icd10_code) AS rn FROM claim GROUP BY 1, 2) AS x WHERE rn <= 3""")
def top_n_per_group(b: Bindings):
    counts = b.claims().groupBy("hospital_bk", "primary_icd10_code").agg(m.rows().alias("n"))
    return queries.top_n(counts, ["hospital_bk"], "n", ["primary_icd10_code"], 3)


@query("win_04_whole_set_percentile", "encounter_bk:s total_cost_usd:d", """
    SELECT encounter_bk, total_cost_usd FROM encounter
    WHERE total_cost_usd::double <= (SELECT quantile_cont(total_cost_usd::double, 0.99) FROM encounter)""")
def whole_set_percentile(b: Bindings):
    return queries.trim_percentile(b.encounters(), "total_cost_usd", 0.99)


@query("win_05_share_of_group", "hospital_bk:s carrier:s n:i share:d", f"""
    SELECT *, {pct('n', 'sum(n) OVER (PARTITION BY hospital_bk)')} AS share FROM (
        SELECT hospital_bk, carrier, count(*) AS n FROM claim GROUP BY 1, 2) AS x""")
def share_of_group(b: Bindings):
    counts = b.claims().groupBy("hospital_bk", "carrier").agg(m.rows().alias("n"))
    return queries.share_of(counts, "hospital_bk", "n", "share")


GAPS_SQL = """(SELECT *, lag(start_at) OVER w AS previous_start, lead(start_at) OVER w AS next_start
    FROM encounter WINDOW w AS (PARTITION BY patient_bk ORDER BY start_at, md5(encounter_bk), encounter_bk))"""


@query("win_07_visit_gap", "encounter_bk:s days_since_last_visit:i is_return:b", f"""
    SELECT encounter_bk, date_diff('day', previous_start::date, start_at::date)
        AS days_since_last_visit,
        coalesce(date_diff('day', previous_start::date, start_at::date) <= 30, false) AS is_return
    FROM {GAPS_SQL} AS g""")
def visit_gap(b: Bindings):
    return analytics.visit_gaps(b.encounters())


@query("win_07_return_rate", "total_encounters:i readmissions:i readmission_rate:d", f"""
    SELECT count(*) AS total_encounters, count(*) FILTER (d <= 30) AS readmissions,
        {ratio4('count(*) FILTER (d <= 30)', 'count(*)')} AS readmission_rate
    FROM (SELECT date_diff('day', previous_start::date, start_at::date) AS d FROM {GAPS_SQL} AS g
        WHERE previous_start IS NOT NULL) AS x""")
def return_rate(b: Bindings):
    return analytics.return_rate(b.encounters())


@query("win_08_cost_segments", "segment:i patients:i min_cost:d max_cost:d segment_cost:d "
       "median_cost:r", """
    SELECT segment, count(*) AS patients, min(c) AS min_cost, max(c) AS max_cost,
        sum(c) AS segment_cost, quantile_cont(c::double, 0.5) AS median_cost
    FROM (SELECT c, ntile(4) OVER (ORDER BY c, md5(patient_bk), patient_bk) AS segment
        FROM (SELECT patient_bk, sum(total_cost_usd) AS c FROM encounter GROUP BY 1) AS x) AS y
    GROUP BY 1""")
def cost_segments(b: Bindings):
    return analytics.cost_segments(b.encounters(), 4)


@query("win_09_provider_rank", "provider_bk:s specialty:s encounters:i avg_cost:d cost_rank:i "
       "cost_dense_rank:i specialty_avg:d", f"""
    SELECT *, rank() OVER (PARTITION BY specialty ORDER BY avg_cost DESC) AS cost_rank,
        dense_rank() OVER (PARTITION BY specialty ORDER BY avg_cost DESC) AS cost_dense_rank,
        (2 * sum(cast(round(avg_cost * 100) AS hugeint)) OVER (PARTITION BY specialty)
            + count(*) OVER (PARTITION BY specialty)) // (2 * count(*) OVER (PARTITION BY specialty))
            / 100.0::double AS specialty_avg
    FROM (SELECT p.provider_bk, p.specialty, count(*) AS encounters,
            {avg2('total_cost_usd')} AS avg_cost
        FROM encounter JOIN first_supplier AS s USING (encounter_bk)
        JOIN provider AS p ON p.provider_bk = s.provider_bk GROUP BY 1, 2) AS x""")
def provider_rank(b: Bindings):
    return analytics.provider_rank(b.encounters(provider=True), b.providers())


@query("win_10_monthly_trend", "month:s encounters:i previous:i change:i running_total:i", """
    SELECT *, lag(encounters) OVER (ORDER BY month) AS previous,
        encounters - lag(encounters) OVER (ORDER BY month) AS change,
        sum(encounters) OVER (ORDER BY month) AS running_total
    FROM (SELECT date_trunc('month', start_at)::date AS month, count(*) AS encounters
        FROM encounter GROUP BY 1) AS x""")
def monthly_trend(b: Bindings):
    return analytics.monthly_trend(b.encounters())


@query("win_11_pareto", "rxnorm_code:s spend:d spend_rank:i cumulative_pct:d", f"""
    SELECT rxnorm_code, spend, rank() OVER (ORDER BY spend DESC) AS spend_rank,
        {pct(cents('sum(spend) OVER (ORDER BY spend DESC, rxnorm_code ROWS UNBOUNDED PRECEDING)'),
             cents('sum(spend) OVER ()'))} AS cumulative_pct
    FROM (SELECT rxnorm_code, sum(total_cost_usd) AS spend FROM medication
        WHERE total_cost_usd IS NOT NULL GROUP BY 1) AS x""")
def pareto(b: Bindings):
    return analytics.pareto(b.medications())


@query("win_12_cohort_retention", "cohort_month:s months_later:i patients:i", """
    SELECT c AS cohort_month, (year(m) - year(c)) * 12 + month(m) - month(c) AS months_later,
        count(*) AS patients
    FROM (SELECT patient_bk, m, min(m) OVER (PARTITION BY patient_bk) AS c FROM (SELECT DISTINCT
        patient_bk, date_trunc('month', start_at)::date AS m FROM encounter) AS x) AS y GROUP BY 1, 2""")
def cohort_retention(b: Bindings):
    return analytics.cohort_retention(b.encounters())


@query("win_12_cohort_matrix", "cohort_month:s m0:i m1:i m2:i m3:i", """
    SELECT c AS cohort_month, count(*) FILTER (k = 0) AS m0, count(*) FILTER (k = 1) AS m1,
        count(*) FILTER (k = 2) AS m2, count(*) FILTER (k = 3) AS m3
    FROM (SELECT c, (year(m) - year(c)) * 12 + month(m) - month(c) AS k FROM (
        SELECT patient_bk, m, min(m) OVER (PARTITION BY patient_bk) AS c FROM (SELECT DISTINCT
        patient_bk, date_trunc('month', start_at)::date AS m FROM encounter) AS x) AS y) AS z
    GROUP BY 1""")
def cohort_matrix(b: Bindings):
    return analytics.cohort_matrix(analytics.cohort_retention(b.encounters()), 3)


@query("win_13_next_visit", "encounter_bk:s next_start:s", f"""
    SELECT encounter_bk, next_start FROM {GAPS_SQL} AS g""")
def next_visit(b: Bindings):
    return analytics.visit_gaps(b.encounters())


# --- sorts and limits --------------------------------------------------------------


@query("srt_01_multi_key_order", "o_orderkey:i o_orderdate:s o_totalprice:d", """
    SELECT o_orderkey, o_orderdate::date AS o_orderdate, o_totalprice FROM orders
    ORDER BY o_orderdate DESC, o_totalprice, o_orderkey""")
def multi_key_order(b: Bindings):
    """Range-partitioned sort, each task one slice of the order."""
    return b.table("orders").orderBy(F.col("o_orderdate").desc(), "o_totalprice", "o_orderkey") \
        .withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("srt_02_top_rows", "o_orderkey:i o_totalprice:d", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top_rows(b: Bindings):
    return b.table("orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query("srt_03_offset_fetch", "o_orderkey:i o_totalprice:d", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey
    LIMIT 50 OFFSET 10""")
def offset_fetch(b: Bindings):
    return b.table("orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").offset(10).limit(50)


@query("srt_04_latest_row", "device_id:s event_id:i heart_rate_bpm:d", """
    SELECT device_id, event_id, hr AS heart_rate_bpm FROM (SELECT *, row_number() OVER (
        PARTITION BY device_id ORDER BY ts DESC, event_id DESC) AS rn FROM reading) AS x WHERE rn = 1""")
def latest_row(b: Bindings):
    order = F.struct("event_ts", F.col("event_id").cast("bigint"))
    best = F.max_by(F.struct("event_id", "heart_rate_bpm"), order)
    return b.as_vitals(b.events()).groupBy("device_id").agg(best.alias("r")) \
        .select("device_id", "r.event_id", "r.heart_rate_bpm")


# --- set operations ------------------------------------------------------------------


@query("set_01_union_by_name", "source:s rule:s n:i", """
    SELECT 'provider' AS source, 'npi_10_digits' AS rule, count(*) AS n FROM provider
        WHERE cast(provider_bk AS bigint) % 5 = 0
    UNION ALL SELECT 'patient', 'gender_valid', count(*) FROM patient
        WHERE cast(patient_bk AS bigint) % 17 = 0""")
def union_by_name(b: Bindings):
    """Rejects of two rule sets over all patients and providers, their columns in different order."""
    key = F.col("patient_bk").cast("bigint")
    patients = b.patients().withColumn("gender", F.when(key % 17 == 0, F.lit("X")).otherwise(F.col("gender")))
    npi = F.col("provider_bk")
    providers = b.providers().withColumn(
        "provider_bk", F.when(npi.cast("bigint") % 5 == 0, F.substring(npi, 2, 9)).otherwise(npi))
    p = dq.apply(patients, rules.patient(ASOF)).rejected.select(
        F.lit("patient").alias("source"), F.col(dq.RULE).alias("rule"), "patient_bk")
    v = dq.apply(providers, rules.provider()).rejected.select(
        "provider_bk", F.col(dq.RULE).alias("rule"), F.lit("provider").alias("source"))
    both = p.unionByName(v, allowMissingColumns=True)
    return both.groupBy("source", "rule").agg(m.rows().alias("n"))


@query("set_02_union_all_counts", "t:s n:i", """
    SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'events', count(*) FROM events""")
def union_all_counts(b: Bindings):
    out = None
    for name in ("orders", "lineitem", "events"):
        one = b.table(name).agg(m.rows().alias("n")).select(F.lit(name).alias("t"), "n")
        out = one if out is None else out.unionAll(one)
    return out


@query("set_03_distinct_list", "hospital_name:s", "SELECT DISTINCT hospital_name FROM view_encounter")
def distinct_list(b: Bindings):
    view = views.encounter_enriched(b.star(*views.ENCOUNTER_TABLES))
    return view.select("hospital_name").distinct().orderBy("hospital_name")


@query("set_06_explode_position", "claim_bk:s line_number:i cpt_code:s description:s units:i "
       "billed_amount:d", "SELECT * FROM claim_line")
def explode_position(b: Bindings):
    return facts.claim_line(b.claims())


@query("set_07_inline_values", "code:s label:s n:i", """
    SELECT code, label, count(*) AS n FROM condition_feed JOIN (VALUES ('I08', 'valves'),
        ('E04', 'goitre'), ('N13', 'kidney')) AS v(code, label) ON code = icd10_code GROUP BY 1, 2""")
def inline_values(b: Bindings):
    inline = b.spark.sql("""SELECT * FROM VALUES ('I08', 'valves'), ('E04', 'goitre'),
        ('N13', 'kidney') AS v(code, label)""")
    return b.conditions().join(F.broadcast(inline), F.col("code") == F.col("icd10_code")) \
        .groupBy("code", "label").agg(m.rows().alias("n"))

