"""The three reporting views over the star schema.

``t`` maps table names to DataFrames. Facts carry the durable patient and provider
key, so joining the current version keeps facts recorded before a change.

Code tables (days, facilities, payers, diagnoses) are broadcast. Spark can not tell before it runs that an aggregate
of a feed gives a code table, so it would first shuffle all facts by a code of few values. People come first,
while the rows that a shuffle moves are narrow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = dict[str, DataFrame]

ENCOUNTER_TABLES = ["fact_encounter", "dim_date", "dim_patient", "dim_provider", "dim_hospital",
                    "dim_diagnosis"]
CLAIM_TABLES = ["fact_claim", "dim_date", "dim_patient", "dim_payer", "dim_hospital",
                "dim_diagnosis"]
VITAL_TABLES = ["fact_vital_signs_minute", "dim_patient", "dim_hospital"]


def _current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def encounter_enriched(t: Tables) -> DataFrame:
    """One row per fact; attributes of an unknown member (-1) are NULL."""
    fe = t["fact_encounter"]
    dd = F.broadcast(t["dim_date"]).alias("dd")
    p = _current(t["dim_patient"]).alias("p")
    pr = _current(t["dim_provider"]).alias("pr")
    h, dx = F.broadcast(t["dim_hospital"]).alias("h"), F.broadcast(t["dim_diagnosis"]).alias("dx")
    joined = (
        fe.alias("fe")
        .join(p, F.col("p.patient_sk") == F.col("fe.patient_sk"), "left")
        .join(pr, F.col("pr.provider_sk") == F.col("fe.provider_sk"), "left")
        .join(dd, F.col("dd.date_sk") == F.col("fe.start_date_sk"), "left")
        .join(h, F.col("h.hospital_sk") == F.col("fe.hospital_sk"), "left")
        .join(dx, F.col("dx.diagnosis_sk") == F.col("fe.primary_diagnosis_sk"), "left")
    )
    return joined.select(
        "fe.encounter_sk", F.col("fe.encounter_bk").alias("encounter_id"), "fe.encounter_class",
        "fe.start_date_sk", F.col("dd.calendar_date").alias("encounter_date"),
        F.col("dd.year").alias("encounter_year"), F.col("dd.month").alias("encounter_month"),
        F.col("dd.month_name").alias("encounter_month_name"),
        F.col("dd.day_name").alias("encounter_day_of_week"), "fe.length_of_stay_hours",
        "fe.is_inpatient", "fe.is_emergency", "fe.is_readmission_30d", "fe.discharge_status",
        "fe.total_cost_usd", "fe.payer_coverage_usd", "fe.out_of_pocket_usd",
        F.col("p.patient_bk").alias("patient_id"), F.col("p.full_name").alias("patient_name"),
        "p.age_band", "p.gender", F.col("p.governorate").alias("patient_governorate"),
        F.col("h.hospital_bk").alias("hospital_code"), "h.hospital_name", "h.facility_type",
        F.col("h.governorate").alias("hospital_governorate"), "h.bed_count",
        F.col("pr.full_name").alias("provider_name"),
        F.col("pr.specialty").alias("provider_specialty"),
        F.col("dx.icd10_code").alias("primary_icd10_code"),
        F.col("dx.description").alias("primary_diagnosis"),
        F.col("dx.chapter").alias("diagnosis_chapter"))


def claim_enriched(t: Tables) -> DataFrame:
    serv, dec = F.broadcast(t["dim_date"]).alias("ds"), F.broadcast(t["dim_date"]).alias("dc")
    p = _current(t["dim_patient"]).alias("p")
    py, h = F.broadcast(t["dim_payer"]).alias("py"), F.broadcast(t["dim_hospital"]).alias("h")
    dx = F.broadcast(t["dim_diagnosis"]).alias("dx")
    joined = (
        t["fact_claim"].alias("fc")
        .join(p, F.col("p.patient_sk") == F.col("fc.patient_sk"), "left")
        .join(serv, F.col("ds.date_sk") == F.col("fc.service_date_sk"), "left")
        .join(dec, F.col("dc.date_sk") == F.col("fc.decision_date_sk"), "left")
        .join(py, F.col("py.payer_sk") == F.col("fc.payer_sk"), "left")
        .join(h, F.col("h.hospital_sk") == F.col("fc.hospital_sk"), "left")
        .join(dx, F.col("dx.diagnosis_sk") == F.col("fc.primary_diagnosis_sk"), "left")
    )
    return joined.select(
        "fc.claim_sk", "fc.claim_number", "fc.status", "fc.is_denied", "fc.is_paid_in_full",
        "fc.days_to_decision", "fc.line_count", "fc.billed_amount", "fc.allowed_amount",
        "fc.paid_amount", "fc.denied_amount", "fc.patient_responsibility", "fc.currency",
        F.col("ds.calendar_date").alias("service_date"), F.col("ds.year").alias("service_year"),
        F.col("ds.month").alias("service_month"), F.col("dc.calendar_date").alias("decision_date"),
        "py.payer_name", F.col("py.is_government").alias("is_government_payer"),
        "h.hospital_name", "h.facility_type", F.col("p.age_band").alias("patient_age_band"),
        F.col("p.gender").alias("patient_gender"),
        F.col("p.governorate").alias("patient_governorate"),
        F.col("dx.icd10_code").alias("primary_icd10_code"),
        F.col("dx.description").alias("primary_diagnosis"))


def vitals_minute(t: Tables) -> DataFrame:
    """One row per fact, those of unknown facilities and patients too."""
    p, h = _current(t["dim_patient"]).alias("p"), F.broadcast(t["dim_hospital"]).alias("h")
    joined = (
        t["fact_vital_signs_minute"].alias("vs")
        .join(h, F.col("h.hospital_sk") == F.col("vs.hospital_sk"), "left")
        .join(p, F.col("p.patient_sk") == F.col("vs.patient_sk"), "left")
    )
    return joined.select(
        "vs.minute_start_utc", "vs.device_id", "vs.bed_number",
        F.col("p.patient_bk").alias("patient_id"), F.col("p.full_name").alias("patient_name"),
        "h.hospital_name", F.col("h.governorate").alias("hospital_governorate"),
        "vs.heart_rate_avg", "vs.heart_rate_min", "vs.heart_rate_max", "vs.spo2_avg",
        "vs.spo2_min", "vs.systolic_avg", "vs.diastolic_avg", "vs.respiratory_rate_avg",
        "vs.temperature_c_avg", "vs.temperature_c_max", "vs.sample_count",
        "vs.anomaly_event_count", "vs.primary_anomaly_kind")
