"""Registered queries: dimensions, facts, bridge and views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from wardlake.bindings import LOAD_TS, Bindings
from wardlake.contract.registry import query
from wardlake.contract.relational import VERSIONS_SQL, two_versions
from wardlake.contract.sqlbind import sk
from wardlake.operators import dims, facts, scd
from wardlake.plans import views


@query("dim_01_scd2_merge", "patient_bk:s marital_status:s effective_from:s effective_to:s is_current:b",
       f"SELECT * FROM {VERSIONS_SQL} AS v")
def scd2_merge(b: Bindings):
    """First load plus a load with changed, missing and new patients."""
    return two_versions(b)


@query("dim_01_scd2_provider", "provider_bk:s specialty:s is_current:b effective_from:s effective_to:s",
       """
    SELECT provider_bk, specialty, k % 6 <> 0 AS is_current, timestamp '1900-01-01' AS effective_from,
        CASE WHEN k % 6 = 0 THEN timestamp '2001-08-01' END AS effective_to
    FROM (SELECT *, cast(provider_bk AS bigint) AS k FROM provider) AS x
    UNION ALL SELECT provider_bk, 'SPEC_NEW', true, timestamp '2001-08-01', NULL
    FROM provider WHERE cast(provider_bk AS bigint) % 6 = 0""")
def scd2_provider(b: Bindings):
    """A changed load, then the same load again: the second run adds nothing."""
    k = F.col("provider_bk").cast("bigint")
    incoming = dims.provider_incoming(b.providers(), b.dim_hospital).withColumn(
        "specialty", F.when(k % 6 == 0, F.lit("SPEC_NEW")).otherwise(F.col("specialty")))
    once = scd.merge2(b.dim_provider, incoming, ["provider_bk"], scd.PROVIDER_ATTRS, LOAD_TS)
    return scd.merge2(once, incoming, ["provider_bk"], scd.PROVIDER_ATTRS, LOAD_TS)


@query("dim_02_hospital", "hospital_sk:i hospital_name:s facility_type:s lat:d lon:d",
       "SELECT * FROM facility")
def hospital(b: Bindings):
    return b.dim_hospital


@query("dim_03_payer", "payer_sk:i payer_name:s is_government:b is_active:b", "SELECT * FROM payer")
def payer(b: Bindings):
    return b.dim_payer


@query("dim_04_diagnosis", "diagnosis_sk:i icd10_code:s description:s chapter:s",
       "SELECT * FROM diagnosis")
def diagnosis(b: Bindings):
    return b.dim_diagnosis


@query("dim_05_patient_staging", "patient_sk:i patient_bk:s mrn:s full_name:s date_of_birth:s "
       "age_band:s gender:s governorate:s is_deceased:b", """
    SELECT *, cast(NULL AS varchar) AS mrn FROM patient""")
def patient_staging(b: Bindings):
    return dims.patient_incoming(b.patients())


@query("dim_06_provider_staging", "provider_sk:i provider_bk:s full_name:s specialty:s "
       "primary_facility_sk:i license_expiry:s is_active:b", "SELECT * FROM provider")
def provider_staging(b: Bindings):
    return dims.provider_incoming(b.providers(), b.dim_hospital)


@query("dim_07_calendar", "date_sk:i calendar_date:s year:i quarter:i month:i month_name:s "
       "day_of_month:i day_of_week:i day_name:s us_week:i iso_week:i is_weekend:b is_month_start:b "
       "month_end_date:s quarter_start_date:s visits:i", """
    SELECT c.*, (dayofyear(calendar_date) + dayofweek(date_trunc('year', calendar_date)) + 1 - 2) // 7 + 1
            AS us_week,
        day_of_week IN (1, 7) AS is_weekend, day_of_month = 1 AS is_month_start,
        last_day(calendar_date) AS month_end_date,
        date_trunc('quarter', calendar_date)::date AS quarter_start_date, coalesce(v, 0) AS visits
    FROM calendar AS c LEFT JOIN (SELECT start_at::date AS d, count(*) AS v FROM encounter GROUP BY 1)
        AS e ON e.d = c.calendar_date""")
def calendar(b: Bindings):
    """The calendar with the number of visits that start on each day."""
    visits = b.encounters().groupBy(F.to_date("start_at").alias("d")).agg(
        F.count(F.lit(1)).alias("v"))
    return b.dim_date.join(visits, F.col("calendar_date") == F.col("d"), "left") \
        .withColumn("visits", F.coalesce("v", F.lit(0)))


@query("dim_08_drug", "drug_sk:i rxnorm_code:s description:s", f"""
    SELECT {sk('rxnorm_code')} AS drug_sk, rxnorm_code, min(description) AS description
    FROM medication GROUP BY rxnorm_code""")
def drug(b: Bindings):
    return b.dim_drug


@query("dim_08_procedure", "procedure_sk:i cpt_code:s description:s base_charge_usd:d", f"""
    SELECT {sk('cpt_code')} AS procedure_sk, cpt_code, min(description) AS description,
        min(base_cost_usd) AS base_charge_usd FROM procedure_feed GROUP BY cpt_code""")
def procedure(b: Bindings):
    return dims.procedure(b.procedures())


@query("dim_09_clock", "shift:s am_pm:s minutes:i readings:i", """
    SELECT CASE WHEN h BETWEEN 7 AND 14 THEN 'morning' WHEN h BETWEEN 15 AND 22 THEN 'afternoon'
        ELSE 'night' END AS shift, CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END AS am_pm,
        count(*) AS minutes, sum(coalesce(n, 0)) AS readings
    FROM (SELECT i, i // 60 AS h FROM range(1440) AS r(i)) AS t LEFT JOIN (
        SELECT hour(ts) * 60 + minute(ts) AS m, count(*) AS n FROM events GROUP BY 1) AS e ON e.m = t.i
    GROUP BY 1, 2""")
def clock(b: Bindings):
    """Readings per ward shift over the minutes of the day."""
    ts = F.col("ts").cast("timestamp")
    per = b.events().groupBy((F.hour(ts) * 60 + F.minute(ts)).alias("m")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return dims.clock(b.spark).join(per, F.col("m") == F.col("time_sk"), "left") \
        .groupBy("shift", "am_pm").agg(F.count(F.lit(1)).alias("minutes"),
                                       F.sum(F.coalesce("n", F.lit(0))).alias("readings"))


@query("dim_09_fiscal_holiday", "fiscal_quarter:i is_holiday:b visits:i", """
    SELECT (month(d) + 5) % 12 // 3 + 1 AS fiscal_quarter, month(d) = 1 AND day(d) = 7 AS is_holiday,
        sum(n) AS visits
    FROM (SELECT start_at::date AS d, count(*) AS n FROM encounter GROUP BY 1) AS x GROUP BY 1, 2""")
def fiscal_holiday(b: Bindings):
    """Fiscal years from July and a table of holidays."""
    days = b.spark.createDataFrame([(date(y, 1, 7),) for y in range(1990, 2006)], "calendar_date date")
    cal = dims.calendar(b.spark, date(1990, 1, 1), date(2005, 12, 31), days)
    visits = b.encounters().groupBy(F.to_date("start_at").alias("d")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return visits.join(F.broadcast(cal), F.col("d") == F.col("calendar_date")) \
        .groupBy("fiscal_quarter", "is_holiday").agg(F.sum("n").alias("visits"))


@query("fct_01_encounter", "encounter_sk:i encounter_bk:s patient_sk:i provider_sk:i hospital_sk:i "
       "primary_diagnosis_sk:i start_date_sk:i end_date_sk:i encounter_class:s "
       "length_of_stay_hours:d base_cost_usd:d total_cost_usd:d payer_coverage_usd:d "
       "out_of_pocket_usd:d is_inpatient:b is_emergency:b is_readmission_30d:b", """
    SELECT * REPLACE (CASE WHEN cast(patient_bk AS bigint) % 50 = 0 THEN -1 ELSE patient_sk END
        AS patient_sk, coalesce(provider_sk, -1) AS provider_sk) FROM fact_encounter_dx""")
def encounter(b: Bindings):
    """All parents looked up; some patients are unknown and become member -1."""
    known = b.patients().where(F.col("patient_bk").cast("bigint") % 50 != 0)
    return facts.encounter(b.encounters(True, True), b.dim_hospital, known, b.providers(), b.bridge,
                           method="md5")


@query("fct_02_claim", "claim_sk:i claim_bk:s claim_number:s encounter_sk:i patient_sk:i provider_sk:i "
       "hospital_sk:i payer_sk:i primary_diagnosis_sk:i service_date_sk:i submission_date_sk:i "
       "decision_date_sk:i days_to_decision:i status:s is_denied:b is_paid_in_full:b line_count:i "
       "billed_amount:d allowed_amount:d paid_amount:d denied_amount:d patient_responsibility:d "
       "currency:s", "SELECT * FROM fact_claim")
def claim(b: Bindings):
    return b.fact_claim(check=True)


@query("fct_03_claim_line", "claim_bk:s line_number:i cpt_code:s units:i billed_amount:d",
       "SELECT * FROM claim_line")
def claim_line(b: Bindings):
    return facts.claim_line(b.claims())


@query("fct_04_prescription", "prescription_sk:i encounter_sk:i patient_sk:i drug_sk:i start_date_sk:i "
       "stop_date_sk:i therapy_duration_days:i dispenses:i total_cost_usd:d",
       "SELECT * FROM prescription")
def prescription(b: Bindings):
    return facts.prescription(b.medications())


@query("fct_05_bridge", "encounter_sk:i diagnosis_sk:i is_primary:b", "SELECT * FROM bridge")
def bridge(b: Bindings):
    return b.bridge


@query("fct_06_procedures_folded", "encounter_bk:s procedure_count:i procedure_cost_usd:d "
       "first_performed_at:s", """
    SELECT e.encounter_bk, coalesce(n, 0) AS procedure_count, c AS procedure_cost_usd,
        t AS first_performed_at
    FROM encounter AS e LEFT JOIN (SELECT encounter_bk, count(*) AS n, sum(base_cost_usd) AS c,
        min(performed_at) AS t FROM procedure_feed GROUP BY 1) AS p USING (encounter_bk)""")
def procedures_folded(b: Bindings):
    return facts.with_procedures(b.encounters(), b.procedures())


@query("fct_07_feed_conform", "feed:s code:s n:i first_day:s last_day:s", """
    SELECT 'condition' AS feed, icd10_code AS code, count(*) AS n, min(onset_date) AS first_day,
        max(onset_date) AS last_day FROM condition_feed GROUP BY 2
    UNION ALL SELECT 'medication', rxnorm_code, sum(dispenses), min(start_date), max(stop_date)
        FROM medication GROUP BY 2
    UNION ALL SELECT 'procedure', cpt_code, count(*), min(performed_at)::date, max(performed_at)::date
        FROM procedure_feed GROUP BY 2""")
def feed_conform(b: Bindings):
    """Typed conditions, medications (missing dispenses are 1) and procedures."""
    c = b.conditions().groupBy(F.col("icd10_code").alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.min("onset_date").alias("first_day"),
        F.max("onset_date").alias("last_day")).withColumn("feed", F.lit("condition"))
    md = b.medications().groupBy(F.col("rxnorm_code").alias("code")).agg(
        F.sum("dispenses").alias("n"), F.min("start_date").alias("first_day"),
        F.max("stop_date").alias("last_day")).withColumn("feed", F.lit("medication"))
    p = b.procedures().groupBy(F.col("cpt_code").alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.to_date(F.min("performed_at")).alias("first_day"),
        F.to_date(F.max("performed_at")).alias("last_day")).withColumn("feed", F.lit("procedure"))
    return c.unionByName(md).unionByName(p)


@query("vw_01_encounter_enriched", "encounter_sk:i encounter_id:s encounter_class:s start_date_sk:i "
       "encounter_date:s encounter_year:i encounter_month:i encounter_month_name:s "
       "encounter_day_of_week:s length_of_stay_hours:d is_inpatient:b is_emergency:b "
       "is_readmission_30d:b discharge_status:s total_cost_usd:d payer_coverage_usd:d "
       "out_of_pocket_usd:d patient_id:s patient_name:s age_band:s gender:s patient_governorate:s "
       "hospital_code:s hospital_name:s facility_type:s hospital_governorate:s bed_count:i "
       "provider_name:s provider_specialty:s primary_icd10_code:s primary_diagnosis:s "
       "diagnosis_chapter:s", "SELECT * FROM view_encounter")
def encounter_enriched(b: Bindings):
    return views.encounter_enriched(
        b.star(*views.ENCOUNTER_TABLES, provider=True, readmission=True, diagnosis=True))


@query("vw_02_claim_enriched", "claim_sk:i claim_number:s status:s is_denied:b is_paid_in_full:b "
       "days_to_decision:i line_count:i billed_amount:d allowed_amount:d paid_amount:d "
       "denied_amount:d patient_responsibility:d currency:s service_date:s service_year:i "
       "service_month:i decision_date:s payer_name:s is_government_payer:b hospital_name:s "
       "facility_type:s patient_age_band:s patient_gender:s patient_governorate:s "
       "primary_icd10_code:s primary_diagnosis:s", "SELECT * FROM view_claim")
def claim_enriched(b: Bindings):
    return views.claim_enriched(b.star(*views.CLAIM_TABLES))


@query("vw_03_vitals_minute", "minute_start_utc:s device_id:s bed_number:s patient_id:s patient_name:s "
       "hospital_name:s hospital_governorate:s heart_rate_avg:d heart_rate_min:d heart_rate_max:d "
       "spo2_avg:d spo2_min:d systolic_avg:d diastolic_avg:d respiratory_rate_avg:d "
       "temperature_c_avg:d temperature_c_max:d sample_count:i anomaly_event_count:i "
       "primary_anomaly_kind:s", "SELECT * FROM view_vitals")
def vitals_minute(b: Bindings):
    return views.vitals_minute(b.star(*views.VITAL_TABLES))


