"""Dashboard measures as small result tables.

``enc``, ``clm`` and ``vit`` are the reporting views (or facts with the same
columns). Every function is one aggregate per result.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.functions import dates
from wardlake.functions import measures as m
from wardlake.functions.ordering import percentiles
from wardlake.operators import audit
from wardlake.schemas import DEFAULT_CENTRE, REGION_CENTRES


def filtered(df: DataFrame, day: str, lo: date, hi: date, facility: str | None = None,
             facility_col: str = "hospital_name") -> DataFrame:
    """Interactive filter: inclusive date range and an optional facility."""
    out = df.where(F.col(day).between(F.lit(lo), F.lit(hi)))
    return out if facility is None else out.where(F.col(facility_col) == facility)


def daily(fact: DataFrame, lo: date, hi: date, refreshed_at: datetime | None = None) -> DataFrame:
    """Daily cube per facility and class for ``lo`` to ``hi``."""
    stamp = F.lit(refreshed_at).cast("timestamp") if refreshed_at else F.current_timestamp()
    rows = dates.in_days(fact, "start_date_sk", lo, hi)
    return rows.groupBy(F.col("start_date_sk").alias("date_sk"), "hospital_sk", "encounter_class").agg(
        F.count(F.lit(1)).alias("encounter_count"),
        m.count_where(F.col("is_inpatient")).alias("inpatient_count"),
        m.count_where(F.col("is_emergency")).alias("emergency_count"),
        m.count_where(F.col("is_readmission_30d")).alias("readmission_30d_count"),
        m.mean("length_of_stay_hours", "decimal(8,2)").alias("avg_length_of_stay"),
        m.money("total_cost_usd").alias("total_revenue_usd"),
        m.money("payer_coverage_usd").alias("total_payer_coverage_usd"),
    ).withColumn("refreshed_at", stamp)


def refresh_daily(store, fact: DataFrame, lo: date, hi: date, name: str = "kpi_daily_hospital",
                  refreshed_at: datetime | None = None) -> None:
    """Replace the cube's days ``lo`` to ``hi``; running it twice changes nothing."""
    cube = daily(fact, lo, hi, refreshed_at)
    audit.observed(store, "kpi", name, lambda watch: store.replace_range(
        cube, name, "date_sk", dates.sk_of(lo), dates.sk_of(hi), watch))


def volumes(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("encounters"),
        m.count_where(F.col("is_inpatient")).alias("inpatient_encounters"),
        m.count_where(F.col("is_emergency")).alias("ed_encounters"),
        F.count_distinct("patient_sk").alias("distinct_patients"),
        F.count_distinct("provider_sk").alias("distinct_providers"))


def length_of_stay(fact: DataFrame) -> DataFrame:
    """Mean and exact median stay of inpatient encounters."""
    stays = fact.where("is_inpatient")
    los = "length_of_stay_hours"
    median = percentiles(stays, [], los, {"p": 0.5}).select("p").scalar()
    return stays.agg(m.mean(los, "decimal(10,2)").alias("avg_los_hours")) \
        .withColumn("median_los_hours", median)


def readmissions(fact: DataFrame) -> DataFrame:
    again = m.count_where(F.col("is_inpatient") & F.col("is_readmission_30d"))
    return fact.agg(again.alias("readmissions_30d"),
                    m.ratio(again, m.count_where(F.col("is_inpatient"))).alias("readmission_rate"))


def revenue(clm: DataFrame) -> DataFrame:
    """Amounts, collection rate, denial by count and by money, days to decision."""
    denied, billed = F.col("is_denied"), F.sum("billed_amount")
    return clm.agg(
        billed.alias("billed_amount"), F.sum("paid_amount").alias("paid_amount"),
        F.sum("allowed_amount").alias("allowed_amount"),
        m.ratio(F.sum("paid_amount"), billed).alias("collection_rate"),
        m.ratio(m.count_where(denied), F.count(F.lit(1))).alias("denial_rate_count"),
        m.ratio(m.sum_where(denied, "denied_amount"), billed).alias("denial_rate_money"),
        m.mean(F.col("days_to_decision").cast("decimal(10,2)"), "decimal(10,2)")
        .alias("avg_days_to_decision"))


def to_date_totals(fact: DataFrame, asof: date) -> DataFrame:
    """Encounters month to date, year to date, prior year to date, and the change."""
    key = F.col("start_date_sk")

    def between(lo: date, hi: date):
        return m.count_where(key.between(dates.sk_of(lo), dates.sk_of(hi)))

    prior = dates.shift(asof, 1, "year")
    ytd = between(date(asof.year, 1, 1), asof)
    pytd = between(date(prior.year, 1, 1), prior)
    window = key.between(dates.sk_of(date(prior.year, 1, 1)), dates.sk_of(asof))
    return fact.where(window).agg(
        between(date(asof.year, asof.month, 1), asof).alias("encounters_mtd"),
        ytd.alias("encounters_ytd"), pytd.alias("encounters_pytd"),
        m.pct(ytd - pytd, pytd, "decimal(9,2)").alias("yoy_pct"))


def vital_measures(minutes: DataFrame, asof: datetime) -> DataFrame:
    """Alerts of 24 hours, devices of the last hour, mean heart rate of the newest minute."""
    ts = F.col("minute_start_utc")
    newest = minutes.agg(F.max("minute_start_utc").alias("t")).scalar()
    hour = dates.trailing(ts, 1, "hour", asof)
    return minutes.agg(
        m.sum_where(dates.trailing(ts, 24, "hour", asof), "anomaly_event_count")
        .alias("active_alerts_24h"),
        F.count_distinct(F.when(hour, F.col("device_id"))).alias("devices_last_hour"),
        m.mean(F.when(ts == newest, F.col("heart_rate_avg")), "decimal(6,2)")
        .alias("latest_heart_rate"))


def patient_names(patients: DataFrame) -> DataFrame:
    return patients.where("is_current").select("patient_bk", "full_name")


def facility_labels(hospitals: DataFrame) -> DataFrame:
    """``name (region)`` for display."""
    label = F.concat(F.col("hospital_name"), F.lit(" ("), F.col("governorate"), F.lit(")"))
    return hospitals.select("hospital_bk", label.alias("hospital_label"))


def _beside(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two one-row results with different columns as one row."""
    both = one.unionByName(other, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def network_overview(enc: DataFrame, clm: DataFrame) -> DataFrame:
    """Network totals and rates, one row from one aggregate per view."""
    inpatient, denied = m.count_where(F.col("is_inpatient")), m.count_where(F.col("is_denied"))
    e = enc.agg(
        F.count(F.lit(1)).alias("encounters"), inpatient.alias("inpatient"),
        m.pct(m.count_where(F.col("is_readmission_30d")), inpatient).alias("readmission_pct"))
    c = clm.agg(
        m.pct(denied, F.count(F.lit(1))).alias("denial_pct"),
        m.pct(F.sum("paid_amount"), F.sum("billed_amount")).alias("collection_pct"))
    return _beside(e, c)


def by_facility(enc: DataFrame) -> DataFrame:
    """Drill-down per facility."""
    return enc.groupBy("hospital_name").agg(
        F.count(F.lit(1)).alias("encounters"),
        m.count_where(F.col("is_inpatient")).alias("inpatient"),
        m.count_where(F.col("is_emergency")).alias("emergency"),
        m.mean("total_cost_usd", "decimal(12,2)").alias("avg_cost"))


def daily_volume(enc: DataFrame) -> DataFrame:
    return enc.groupBy("encounter_date").agg(F.count(F.lit(1)).alias("encounters"))


def class_mix(enc: DataFrame) -> DataFrame:
    return enc.groupBy("encounter_class").agg(F.count(F.lit(1)).alias("n"))


def operations(enc: DataFrame) -> DataFrame:
    inpatient = m.count_where(F.col("is_inpatient"))
    stay = F.when(F.col("is_inpatient"), F.col("length_of_stay_hours"))
    return enc.agg(
        F.count(F.lit(1)).alias("encounters"),
        m.mean(stay, "decimal(10,2)").alias("avg_inpatient_los"),
        m.pct(m.count_where(F.col("is_readmission_30d")), inpatient).alias("readmission_pct"),
        m.count_where(F.col("encounter_class") == "emergency").alias("ed_visits"))


def top_diagnoses(enc: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent primary diagnoses (a top-n report)."""
    return (
        enc.where(F.col("primary_diagnosis").isNotNull())
        .groupBy("primary_icd10_code", "primary_diagnosis").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "primary_icd10_code").limit(n)
    )


def status_mix(clm: DataFrame) -> DataFrame:
    title = F.initcap(F.replace(F.col("status"), F.lit("_"), F.lit(" ")))
    return clm.groupBy(title.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def denial_by_payer(clm: DataFrame) -> DataFrame:
    denied = m.count_where(F.col("is_denied"))
    return clm.where(F.col("payer_name").isNotNull()).groupBy("payer_name").agg(
        F.count(F.lit(1)).alias("claims"), denied.alias("denied"),
        m.pct(denied, F.count(F.lit(1))).alias("denial_pct"),
        F.sum("billed_amount").alias("billed"),
        m.pct(F.sum("paid_amount"), F.sum("billed_amount")).alias("collection_pct"))


def monthly_revenue(clm: DataFrame) -> DataFrame:
    return clm.groupBy(F.trunc("service_date", "MONTH").alias("month")).agg(
        F.sum("billed_amount").alias("billed_amount"), F.sum("paid_amount").alias("paid_amount"))


def claim_totals(clm: DataFrame) -> DataFrame:
    return clm.agg(
        F.count(F.lit(1)).alias("claims"), F.sum("billed_amount").alias("billed"),
        m.pct(m.count_where(F.col("is_denied")), F.count(F.lit(1))).alias("denial_pct"),
        m.pct(F.sum("paid_amount"), F.sum("billed_amount")).alias("collection_pct"))


def facility_map(fact: DataFrame, claims: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Facility table of the map: both facts are aggregated on the key, then joined."""
    e = fact.groupBy("hospital_sk").agg(
        F.count(F.lit(1)).alias("encounters"),
        m.mean("total_cost_usd", "decimal(12,0)").alias("avg_cost"),
        m.pct(m.count_where(F.col("is_readmission_30d")), F.count(F.lit(1)), "decimal(5,1)")
        .alias("readmit"),
        m.count_where(F.col("is_emergency")).alias("emergency"))
    c = claims.groupBy("hospital_sk").agg(
        m.pct(m.count_where(F.col("is_denied")), F.count(F.lit(1)), "decimal(5,1)").alias("denial"))
    return (
        hospitals.select("hospital_sk", "hospital_name", "governorate",
                         F.col("bed_count").alias("beds"), "lat", "lon")
        .join(e, "hospital_sk").join(c, "hospital_sk", "left")
        .withColumn("denial", F.coalesce("denial", F.lit(0).cast("decimal(5,1)")))
        .drop("hospital_sk")
    )


def region_rollup(enc: DataFrame, region: str = "patient_governorate") -> DataFrame:
    """Volume and cost per region with the region's centre."""
    spark = enc.sparkSession
    rows = [(k, lat, lon) for k, (lat, lon) in REGION_CENTRES.items()]
    centres = F.broadcast(spark.createDataFrame(rows, "_r string, lat double, lon double"))
    per = enc.groupBy(region).agg(
        F.count(F.lit(1)).alias("encounters"), m.money("total_cost_usd").alias("total_cost"))
    return per.join(centres, F.col(region) == F.col("_r"), "left").select(
        F.col(region).alias("governorate"), "encounters", "total_cost",
        F.coalesce("lat", F.lit(DEFAULT_CENTRE[0])).alias("lat"),
        F.coalesce("lon", F.lit(DEFAULT_CENTRE[1])).alias("lon"))


def vitals_summary(vit: DataFrame, asof: datetime) -> DataFrame:
    """Devices, anomaly minutes and patients of the last 24 hours."""
    day = vit.where(dates.trailing("minute_start_utc", 24, "hour", asof))
    return day.agg(F.count_distinct("device_id").alias("devices"),
                   m.count_where(F.col("anomaly_event_count") > 0).alias("anomaly_minutes"),
                   F.count_distinct("patient_name").alias("patients"))


def vitals_series(vit: DataFrame, asof: datetime, tz: str = "Africa/Cairo") -> DataFrame:
    """Readings of the last 24 hours per patient in local time."""
    return vit.where(dates.trailing("minute_start_utc", 24, "hour", asof)).select(
        "patient_name", dates.to_local("minute_start_utc", tz).alias("local_time"),
        "heart_rate_avg", "spo2_avg", "systolic_avg")


def active_alerts(alert_minutes: DataFrame, n: int = 20) -> DataFrame:
    """The newest n alert minutes (a top-n report)."""
    return alert_minutes.orderBy(F.col("minute_start_utc").desc(), "device_id", "bed_number").limit(n)


def recommendation_line(enc: DataFrame, clm: DataFrame) -> DataFrame:
    """The eight aggregated KPIs handed to the recommendation text."""
    e = enc.agg(
        F.count(F.lit(1)).alias("encounters"),
        m.count_where(F.col("is_inpatient")).alias("inpatient"),
        m.count_where(F.col("is_emergency")).alias("emergency"),
        m.count_where(F.col("is_readmission_30d")).alias("readmit30d"),
        m.mean("length_of_stay_hours", "decimal(10,1)").alias("avg_los_h"))
    c = clm.agg(
        F.count(F.lit(1)).alias("claims"),
        m.pct(m.count_where(F.col("is_denied")), F.count(F.lit(1)), "decimal(5,1)")
        .alias("denial_rate"),
        m.pct(F.sum("paid_amount"), F.sum("billed_amount"), "decimal(5,1)")
        .alias("collection_rate"))
    return _beside(e, c)


def carrier_denial(raw_claims: DataFrame) -> DataFrame:
    """Denied share and status counts per carrier of the raw feed."""
    denied = F.col("status") == "denied"
    return raw_claims.groupBy("carrier").agg(
        F.count(F.lit(1)).alias("claims"),
        m.pct(m.count_where(denied), F.count(F.lit(1))).alias("denial_pct"))
