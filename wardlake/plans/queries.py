"""The twelve analytical queries. ``asof`` is an argument; nothing reads the clock.

Date windows are literals on the fact's date key, so they prune before any join.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlake.functions import clinical, dates
from wardlake.functions import measures as m
from wardlake.functions.ordering import percentiles
from wardlake.plans.views import Tables

# Default chronic-condition codes.
CHRONIC_CODES = ["I10", "E11.9", "E78.5", "N18.3", "I25.10", "J45.909"]


def _dated(fact: DataFrame, t: Tables, key: str) -> DataFrame:
    """Fact with calendar attributes; the calendar's size is fixed by its range."""
    return fact.join(F.broadcast(t["dim_date"]), F.col(key) == F.col("date_sk")).drop("date_sk")


def top_n(df: DataFrame, group: list[str], by: str, ties: list[str], n: int) -> DataFrame:
    """First n rows per group of an already aggregated table, in a total order."""
    w = Window.partitionBy(*group).orderBy(F.col(by).desc(), *ties)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def share_of(df: DataFrame, group: str, count: str, out: str) -> DataFrame:
    """Percent of each row's count within its group of an aggregated table."""
    total = F.sum(count).over(Window.partitionBy(group))
    return df.withColumn(out, m.pct(F.col(count), total))


def q01(t: Tables, asof: date, n: int = 10) -> DataFrame:
    """Top primary diagnoses per hospital, 12 months."""
    recent = dates.trailing_days(t["fact_encounter"], "start_date_sk", 12, "month", asof)
    counts = (
        recent.where(F.col("primary_diagnosis_sk").isNotNull())
        .groupBy("hospital_sk", "primary_diagnosis_sk").agg(F.count(F.lit(1)).alias("n"))
        .join(t["dim_hospital"].select("hospital_sk", "hospital_name"), "hospital_sk")
        .join(t["dim_diagnosis"].select(F.col("diagnosis_sk").alias("primary_diagnosis_sk"),
                                        "icd10_code", F.col("description").alias("diagnosis")),
              "primary_diagnosis_sk")
        .groupBy("hospital_name", "icd10_code", "diagnosis")
        .agg(F.sum("n").alias("encounter_count"))
    )
    return top_n(counts, ["hospital_name"], "encounter_count", ["icd10_code"], n) \
        .orderBy("hospital_name", F.col("encounter_count").desc(), "icd10_code")


def q02(t: Tables, asof: date) -> DataFrame:
    """30-day readmission percent by hospital and quarter since two years before."""
    recent = dates.in_days(t["fact_encounter"], "start_date_sk", date(asof.year - 2, 1, 1))
    inpatient = m.count_where(F.col("is_inpatient"))
    again = m.count_where(F.col("is_inpatient") & F.col("is_readmission_30d"))
    return (
        _dated(recent, t, "start_date_sk")
        .join(t["dim_hospital"].select("hospital_sk", "hospital_name"), "hospital_sk")
        .groupBy("hospital_name", "year", "quarter")
        .agg(inpatient.alias("inpatient_discharges"), again.alias("readmissions_30d"),
             m.pct(again, inpatient).alias("readmission_rate_pct"))
        .orderBy("year", "quarter", "hospital_name")
    )


def trim_percentile(df: DataFrame, col: str, p: float) -> DataFrame:
    """Rows at or below the percentile of the column."""
    bound = percentiles(df, [], col, {"b": p}).select("b").scalar()
    return df.where(F.col(col).cast("double") <= bound)


def q03(t: Tables) -> DataFrame:
    """Length of stay by hospital and chapter without the top 1 %.

    Equal stays are counted once. The bound marks counted rows instead of filtering
    them: a filter would move below the counts, and the percentile and the averages
    could no longer share one shuffle.
    """
    stays = (
        t["fact_encounter"].where(F.col("is_inpatient") & F.col("length_of_stay_hours").isNotNull())
        .join(t["dim_hospital"].select("hospital_sk", "hospital_name"), "hospital_sk")
        .join(t["dim_diagnosis"].select(F.col("diagnosis_sk").alias("primary_diagnosis_sk"),
                                        "chapter"), "primary_diagnosis_sk")
        .select("hospital_name", "chapter", "length_of_stay_hours")
    )
    los = "length_of_stay_hours"
    counted = stays.groupBy("hospital_name", "chapter", los).agg(F.count(F.lit(1)).alias("n"))
    bound = percentiles(counted, [], los, {"b": 0.99}, weight="n").select("b").scalar()
    kept = counted.withColumn("k", F.when(F.col(los).cast("double") <= bound, F.col("n")))
    hours, size = F.sum(F.col(los) * F.col("k")).cast("decimal(22,2)"), F.sum("k")
    return (
        kept.groupBy("hospital_name", "chapter")
        .agg(size.alias("inpatient_stays"),
             F.try_divide(hours, size.cast("decimal(20,0)")).cast("decimal(8,2)").alias("avg_los_hours"),
             F.max(F.when(F.col("k").isNotNull(), F.col(los))).cast("decimal(8,2)")
             .alias("max_los_hours"))
        .where(F.col("inpatient_stays").isNotNull())
        .orderBy("hospital_name", F.col("avg_los_hours").desc(), "chapter")
    )


def q04(t: Tables, asof: date) -> DataFrame:
    """Claim denial by count and money per payer and month, 12 months."""
    recent = dates.trailing_days(t["fact_claim"], "service_date_sk", 12, "month", asof)
    denied, total = m.count_where(F.col("is_denied")), F.count(F.lit(1))
    billed, lost = F.sum("billed_amount"), m.sum_where(F.col("is_denied"), "billed_amount")
    return (
        _dated(recent, t, "service_date_sk")
        .join(t["dim_payer"].select("payer_sk", "payer_name"), "payer_sk")
        .groupBy("payer_name", "year", "month")
        .agg(total.alias("total_claims"), denied.alias("denied_claims"),
             m.pct(denied, total).alias("denial_rate_pct"), billed.alias("total_billed"),
             lost.alias("total_denied_billed"), m.pct(lost, billed).alias("dollar_denial_pct"))
        .orderBy("year", "month", F.col("denial_rate_pct").desc(), "payer_name")
    )


def _year_encounters(t: Tables, asof: date) -> DataFrame:
    return dates.in_year(t["fact_encounter"], "start_date_sk", asof.year)


def q05(t: Tables, asof: date) -> DataFrame:
    """Revenue per encounter and class, current year, averaged over claim rows."""
    fe = _year_encounters(t, asof).select("encounter_sk", "hospital_sk", "encounter_class",
                                          "total_cost_usd")
    fc = t["fact_claim"].where(F.col("encounter_sk").isNotNull()) \
        .select("encounter_sk", "billed_amount", "paid_amount")
    rate = m.pct(F.sum("paid_amount"), F.sum("billed_amount"))
    return (
        fe.join(fc, "encounter_sk")
        .join(t["dim_hospital"].select("hospital_sk", "hospital_name"), "hospital_sk")
        .groupBy("hospital_name", "encounter_class")
        .agg(F.count_distinct("encounter_sk").alias("encounters"),
             m.mean("total_cost_usd", "decimal(12,2)").alias("avg_encounter_cost"),
             m.mean("billed_amount", "decimal(12,2)").alias("avg_billed"),
             m.mean("paid_amount", "decimal(12,2)").alias("avg_paid"),
             m.money("paid_amount").alias("total_paid"), rate.alias("collection_rate_pct"))
        .orderBy("hospital_name", F.col("total_paid").desc(), "encounter_class")
    )


def q05_per_encounter(t: Tables, asof: date) -> DataFrame:
    """The same question with claims summed per encounter first, so costs count once."""
    claims = t["fact_claim"].where(F.col("encounter_sk").isNotNull()).groupBy("encounter_sk").agg(
        F.sum("billed_amount").alias("billed"), F.sum("paid_amount").alias("paid"))
    fe = _year_encounters(t, asof)
    return (
        fe.join(claims, "encounter_sk")
        .join(t["dim_hospital"].select("hospital_sk", "hospital_name"), "hospital_sk")
        .groupBy("hospital_name", "encounter_class")
        .agg(F.count(F.lit(1)).alias("encounters"),
             m.mean("total_cost_usd", "decimal(12,2)").alias("avg_encounter_cost"),
             m.mean("billed", "decimal(12,2)").alias("avg_billed"),
             m.mean("paid", "decimal(12,2)").alias("avg_paid"),
             F.sum("paid").cast("decimal(14,2)").alias("total_paid"),
             m.pct(F.sum("paid"), F.sum("billed")).alias("collection_rate_pct"))
    )


def q06(t: Tables, asof: date) -> DataFrame:
    """Emergency visits by weekday, 3 months."""
    recent = dates.trailing_days(t["fact_encounter"], "start_date_sk", 3, "month", asof) \
        .where(F.col("encounter_class") == "emergency")
    los = "length_of_stay_hours"
    return (
        _dated(recent, t, "start_date_sk")
        .join(t["dim_hospital"].select("hospital_sk", "hospital_name"), "hospital_sk")
        .groupBy("hospital_name", "day_name", "day_of_week")
        .agg(F.count(F.lit(1)).alias("ed_visits"),
             m.mean(los, "decimal(8,2)").alias("avg_los_hours"),
             F.max(los).cast("decimal(8,2)").alias("max_los_hours"),
             m.count_where(F.col("is_readmission_30d")).alias("ed_readmissions"))
        .orderBy("hospital_name", "day_of_week")
    )


def chronic_burden(t: Tables, codes: list[str] | None = None, min_conditions: int = 2) -> DataFrame:
    """Patients with several chronic codes by region, age band and gender."""
    chronic = clinical.in_codes(t["dim_diagnosis"], "icd10_code", codes or CHRONIC_CODES)
    per_patient = (
        t["bridge_encounter_diagnosis"].select("encounter_sk", "diagnosis_sk")
        .join(chronic.select("diagnosis_sk", "icd10_code"), "diagnosis_sk")
        .join(t["fact_encounter"].select("encounter_sk", "patient_sk"), "encounter_sk")
        .groupBy("patient_sk").agg(F.count_distinct("icd10_code").alias("k"))
        .where(F.col("k") >= min_conditions)
    )
    people = t["dim_patient"].where("is_current").select("patient_sk", "governorate", "age_band",
                                                         "gender")
    return (
        per_patient.join(people, "patient_sk").groupBy("governorate", "age_band", "gender")
        .agg(F.count(F.lit(1)).alias("patients_with_2_plus"),
             m.mean(F.col("k").cast("decimal(5,2)"), "decimal(9,6)").alias("avg_conditions"))
        .orderBy("governorate", F.col("patients_with_2_plus").desc(), "age_band", "gender")
    )


q07 = chronic_burden


def q08(t: Tables, asof: date, min_encounters: int = 50, limit: int = 50,
        offset: int = 0) -> DataFrame:
    """Active providers by revenue in the current year."""
    pr = t["dim_provider"].where(F.col("is_current") & F.col("is_active")).select(
        "provider_sk", "full_name", "specialty", "primary_facility_sk")
    h = t["dim_hospital"].select(F.col("hospital_sk").alias("primary_facility_sk"), "hospital_name")
    seen = F.count_distinct("encounter_sk")
    return (
        _year_encounters(t, asof).select("provider_sk", "encounter_sk", "patient_sk",
                                         "total_cost_usd")
        .join(pr, "provider_sk").join(h, "primary_facility_sk", "left")
        .groupBy(F.col("full_name").alias("provider_name"), "specialty",
                 F.col("hospital_name").alias("primary_facility"))
        .agg(seen.alias("encounters_ytd"),
             F.count_distinct("patient_sk").alias("unique_patients_ytd"),
             m.mean("total_cost_usd", "decimal(12,2)").alias("avg_encounter_revenue"),
             m.money("total_cost_usd").alias("total_revenue_ytd"))
        .where(F.col("encounters_ytd") >= min_encounters)
        .orderBy(F.col("total_revenue_ytd").desc(), "provider_name").offset(offset).limit(limit)
    )


def q09(t: Tables, asof: date, n: int = 20) -> DataFrame:
    """Drugs by total spend in the current year, aggregated before the name lookup."""
    spend = (
        dates.in_year(t["fact_prescription"], "start_date_sk", asof.year)
        .where(F.col("total_cost_usd").isNotNull())
        .groupBy("drug_sk")
        .agg(F.count(F.lit(1)).alias("prescription_count"),
             F.sum("dispenses").alias("total_dispenses"),
             m.money("total_cost_usd").alias("total_spend"),
             m.mean("total_cost_usd", "decimal(12,2)").alias("avg_cost_per_rx"))
    )
    return (
        spend.join(t["dim_drug"], "drug_sk")
        .select("rxnorm_code", F.col("description").alias("drug"), "prescription_count",
                "total_dispenses", "total_spend", "avg_cost_per_rx")
        .orderBy(F.col("total_spend").desc(), "rxnorm_code").limit(n)
    )


def q10(t: Tables, asof: datetime, hours: int = 24) -> DataFrame:
    """Minutes with anomalies in the last hours, newest first; an alert of an unknown patient or facility stays."""
    since = dates.shift(asof, hours, "hour")
    hot = t["fact_vital_signs_minute"].where(
        (F.col("anomaly_event_count") > 0) & (F.col("date_sk") >= dates.sk_of(since.date()))
        & (F.col("minute_start_utc") >= F.lit(since)))
    p = t["dim_patient"].where("is_current").select(
        "patient_sk", F.col("patient_bk").alias("patient_id"),
        F.col("full_name").alias("patient_name"))
    h = t["dim_hospital"].select("hospital_sk", "hospital_name")
    return hot.join(p, "patient_sk", "left").join(h, "hospital_sk", "left").select(
        "minute_start_utc", "device_id", "bed_number", "patient_id", "patient_name",
        "hospital_name", "heart_rate_avg", "heart_rate_max", "spo2_min", "systolic_avg",
        "diastolic_avg", "temperature_c_max", "anomaly_event_count", "primary_anomaly_kind",
    ).orderBy(F.col("minute_start_utc").desc(), F.col("anomaly_event_count").desc(),
              "device_id", "bed_number")


def q11(t: Tables, asof: date) -> DataFrame:
    """Payer share within each region, 6 months."""
    recent = dates.trailing_days(t["fact_claim"], "service_date_sk", 6, "month", asof)
    p = t["dim_patient"].where("is_current").select("patient_sk", "governorate")
    mix = (
        recent.select("patient_sk", "payer_sk", "billed_amount", "paid_amount")
        .join(t["dim_payer"].select("payer_sk", "payer_name"), "payer_sk")
        .join(p, "patient_sk", "left")
        .groupBy(F.coalesce("governorate", F.lit("Unknown")).alias("governorate"), "payer_name")
        .agg(F.count(F.lit(1)).alias("claim_count"),
             m.money("billed_amount").alias("total_billed"),
             m.money("paid_amount").alias("total_paid"))
    )
    return share_of(mix, "governorate", "claim_count", "share_of_governorate_pct") \
        .orderBy("governorate", F.col("share_of_governorate_pct").desc(), "payer_name")


def q12(t: Tables, asof: date) -> DataFrame:
    """Claims without an encounter per day, 30 days."""
    recent = dates.trailing_days(t["fact_claim"], "service_date_sk", 30, "day", asof)
    daily = recent.groupBy("service_date_sk").agg(
        F.count(F.lit(1)).alias("total_claims"),
        m.count_where(F.col("encounter_sk").isNull()).alias("orphan_claims"))
    return (
        _dated(daily, t, "service_date_sk")
        .select(F.col("calendar_date").alias("service_date"), "total_claims", "orphan_claims",
                m.pct(F.col("orphan_claims"), F.col("total_claims")).alias("orphan_pct"))
        .orderBy("service_date")
    )
