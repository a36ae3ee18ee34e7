"""Registered queries: dashboard measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlake.bindings import ASOF, VITALS_ASOF, Bindings
from wardlake.contract.registry import query
from wardlake.contract.sqlbind import avg2, cents, pct, ratio4
from wardlake.plans import kpi, queries, views
from wardlake.schemas import DEFAULT_CENTRE, REGION_CENTRES

_LOS = "cast(length_of_stay_hours AS decimal(10,2))"
_ALL_DENIED = "count(*) FILTER (is_denied)"


def enc_view(b: Bindings, diagnosis: bool = False, readmission: bool = True):
    """The encounter view; provider and diagnosis lookups only where a measure reads them."""
    return views.encounter_enriched(
        b.star(*views.ENCOUNTER_TABLES, readmission=readmission, diagnosis=diagnosis))


def clm_view(b: Bindings):
    return views.claim_enriched(b.star(*views.CLAIM_TABLES))


@query("kpi_01_volumes", "encounters:i inpatient_encounters:i ed_encounters:i distinct_patients:i "
       "distinct_providers:i", """
    SELECT count(*) AS encounters, count(*) FILTER (is_inpatient) AS inpatient_encounters,
        count(*) FILTER (is_emergency) AS ed_encounters, count(DISTINCT patient_sk) AS distinct_patients,
        count(DISTINCT provider_sk) AS distinct_providers FROM fact_encounter""")
def volumes(b: Bindings):
    return kpi.volumes(b.fact_encounter(provider=True))


@query("kpi_02_length_of_stay", "avg_los_hours:d median_los_hours:r", f"""
    SELECT {avg2(_LOS)} AS avg_los_hours,
        quantile_cont(length_of_stay_hours::double, 0.5) AS median_los_hours
    FROM encounter WHERE is_inpatient""")
def length_of_stay(b: Bindings):
    return kpi.length_of_stay(b.encounters())


@query("kpi_03_readmissions", "readmissions_30d:i readmission_rate:d", f"""
    SELECT count(*) FILTER (is_readmission_30d) AS readmissions_30d,
        {ratio4('count(*) FILTER (is_readmission_30d)', 'count(*) FILTER (is_inpatient)')}
            AS readmission_rate FROM readmit""")
def readmissions(b: Bindings):
    return kpi.readmissions(b.encounters(readmission=True))


@query("kpi_04_revenue", "billed_amount:d paid_amount:d allowed_amount:d collection_rate:d "
       "denial_rate_count:d denial_rate_money:d avg_days_to_decision:d", f"""
    SELECT sum(billed_amount) AS billed_amount, sum(paid_amount) AS paid_amount,
        sum(allowed_amount) AS allowed_amount,
        {ratio4(cents('sum(paid_amount)'), cents('sum(billed_amount)'))} AS collection_rate,
        {ratio4(_ALL_DENIED, 'count(*)')} AS denial_rate_count,
        {ratio4(cents('sum(denied_amount) FILTER (is_denied)'), cents('sum(billed_amount)'))}
            AS denial_rate_money,
        {avg2('cast(days_to_decision AS decimal(10,2))')} AS avg_days_to_decision FROM claim""")
def revenue(b: Bindings):
    return kpi.revenue(b.claims())


@query("kpi_05_to_date", "encounters_mtd:i encounters_ytd:i encounters_pytd:i yoy_pct:r", """
    SELECT mtd AS encounters_mtd, ytd AS encounters_ytd, pytd AS encounters_pytd,
        round(100.0::double * (ytd - pytd) / pytd, 2) AS yoy_pct
    FROM (SELECT count(*) FILTER (d BETWEEN date '2001-08-01' AND date '2001-08-01') AS mtd,
        count(*) FILTER (d BETWEEN date '2001-01-01' AND date '2001-08-01') AS ytd,
        count(*) FILTER (d BETWEEN date '2000-01-01' AND date '2000-08-01') AS pytd
        FROM (SELECT start_at::date AS d FROM encounter) AS x) AS y""")
def to_date(b: Bindings):
    return kpi.to_date_totals(b.fact_encounter(), ASOF)


@query("kpi_06_vital_measures", "active_alerts_24h:i devices_last_hour:i latest_heart_rate:d", f"""
    SELECT coalesce(sum(anomaly_event_count) FILTER (minute_start_utc >= timestamp '2024-01-30'), 0)
            AS active_alerts_24h,
        count(DISTINCT device_id) FILTER (minute_start_utc >= timestamp '2024-01-30 23:00:00')
            AS devices_last_hour,
        (SELECT {avg2('cast(heart_rate_avg AS decimal(6,2))')} FROM minute_all
            WHERE minute_start_utc = (SELECT max(minute_start_utc) FROM minute_all))
            AS latest_heart_rate
    FROM minute_all""")
def vital_measures(b: Bindings):
    return kpi.vital_measures(b.fact_minutes(), VITALS_ASOF)


@query("kpi_07_labels", "kind:s key:s label:s", """
    SELECT 'patient' AS kind, patient_bk AS key, full_name AS label FROM patient
    UNION ALL SELECT 'facility', hospital_bk, hospital_name || ' (' || governorate || ')' FROM facility""")
def labels(b: Bindings):
    people = kpi.patient_names(b.dim_patient).select(
        F.lit("patient").alias("kind"), F.col("patient_bk").alias("key"), F.col("full_name").alias("label"))
    places = kpi.facility_labels(b.dim_hospital).select(
        F.lit("facility").alias("kind"), F.col("hospital_bk").alias("key"),
        F.col("hospital_label").alias("label"))
    return people.unionByName(places)


@query("kpi_08_network_overview", "encounters:i inpatient:i readmission_pct:d denial_pct:d "
       "collection_pct:d", f"""
    SELECT e.*, c.* FROM (SELECT count(*) AS encounters, count(*) FILTER (is_inpatient) AS inpatient,
        {pct('count(*) FILTER (is_readmission_30d)', 'count(*) FILTER (is_inpatient)')}
            AS readmission_pct FROM view_encounter) AS e,
    (SELECT {pct(_ALL_DENIED, 'count(*)')} AS denial_pct,
        {pct(cents('sum(paid_amount)'), cents('sum(billed_amount)'))} AS collection_pct
        FROM view_claim) AS c""")
def network_overview(b: Bindings):
    return kpi.network_overview(enc_view(b), clm_view(b))


@query("kpi_08_facility_drill", "hospital_name:s encounters:i inpatient:i emergency:i avg_cost:d", f"""
    SELECT hospital_name, count(*) AS encounters, count(*) FILTER (is_inpatient) AS inpatient,
        count(*) FILTER (is_emergency) AS emergency, {avg2('total_cost_usd')} AS avg_cost
    FROM view_encounter GROUP BY 1""")
def facility_drill(b: Bindings):
    return kpi.by_facility(enc_view(b, readmission=False))


@query("kpi_09_operations", "encounters:i avg_inpatient_los:d readmission_pct:d ed_visits:i", f"""
    SELECT count(*) AS encounters,
        {avg2(f'CASE WHEN is_inpatient THEN {_LOS} END')} AS avg_inpatient_los,
        {pct('count(*) FILTER (is_readmission_30d)', 'count(*) FILTER (is_inpatient)')}
            AS readmission_pct,
        count(*) FILTER (encounter_class = 'emergency') AS ed_visits FROM view_encounter""")
def operations(b: Bindings):
    return kpi.operations(enc_view(b))


@query("kpi_09_daily_volume", "encounter_date:s encounters:i", """
    SELECT encounter_date, count(*) AS encounters FROM view_encounter GROUP BY 1""")
def daily_volume(b: Bindings):
    return kpi.daily_volume(enc_view(b, readmission=False))


@query("kpi_09_class_mix", "encounter_class:s n:i", """
    SELECT encounter_class, count(*) AS n FROM view_encounter GROUP BY 1""")
def class_mix(b: Bindings):
    return kpi.class_mix(enc_view(b, readmission=False))


@query("kpi_09_top_diagnoses", "primary_icd10_code:s primary_diagnosis:s n:i", """
    SELECT primary_icd10_code, primary_diagnosis, count(*) AS n FROM view_encounter
    WHERE primary_diagnosis IS NOT NULL GROUP BY 1, 2 ORDER BY n DESC, primary_icd10_code LIMIT 10""")
def top_diagnoses(b: Bindings):
    return kpi.top_diagnoses(enc_view(b, diagnosis=True, readmission=False))


@query("kpi_10_claim_totals", "claims:i billed:d denial_pct:d collection_pct:d", f"""
    SELECT count(*) AS claims, sum(billed_amount) AS billed, {pct(_ALL_DENIED, 'count(*)')} AS denial_pct,
        {pct(cents('sum(paid_amount)'), cents('sum(billed_amount)'))} AS collection_pct FROM view_claim""")
def claim_totals(b: Bindings):
    return kpi.claim_totals(clm_view(b))


@query("kpi_10_status_mix", "status:s n:i", """
    SELECT CASE status WHEN 'pending_review' THEN 'Pending Review' WHEN 'partially_paid'
        THEN 'Partially Paid' ELSE upper(status[1]) || status[2:] END AS status, count(*) AS n
    FROM claim GROUP BY 1""")
def status_mix(b: Bindings):
    return kpi.status_mix(b.claims())


@query("kpi_10_denial_by_payer", "payer_name:s claims:i denied:i denial_pct:d billed:d "
       "collection_pct:d", f"""
    SELECT payer_name, count(*) AS claims, {_ALL_DENIED} AS denied,
        {pct(_ALL_DENIED, 'count(*)')} AS denial_pct, sum(billed_amount) AS billed,
        {pct(cents('sum(paid_amount)'), cents('sum(billed_amount)'))} AS collection_pct
    FROM view_claim WHERE payer_name IS NOT NULL GROUP BY 1""")
def denial_by_payer(b: Bindings):
    return kpi.denial_by_payer(clm_view(b))


@query("kpi_10_monthly_revenue", "month:s billed_amount:d paid_amount:d", """
    SELECT date_trunc('month', v_service_date)::date AS month, sum(billed_amount) AS billed_amount,
        sum(paid_amount) AS paid_amount FROM view_claim GROUP BY 1""")
def monthly_revenue(b: Bindings):
    return kpi.monthly_revenue(clm_view(b))


@query("kpi_11_facility_map", "hospital_name:s governorate:s beds:i lat:d lon:d encounters:i "
       "avg_cost:d readmit:d emergency:i denial:d", f"""
    SELECT h.hospital_name, h.governorate, h.bed_count AS beds, h.lat, h.lon, e.n AS encounters,
        e.avg_cost, e.readmit, e.emergency, coalesce(c.denial, 0) AS denial
    FROM facility AS h JOIN (SELECT hospital_sk, count(*) AS n,
            (2 * sum(cast(total_cost_usd * 100 AS hugeint)) + 100 * count(total_cost_usd))
                // (200 * count(total_cost_usd)) AS avg_cost,
            {pct('count(*) FILTER (is_readmission_30d)', 'count(*)', 1)} AS readmit,
            count(*) FILTER (is_emergency) AS emergency FROM fact_encounter GROUP BY 1) AS e
        ON e.hospital_sk = h.hospital_sk
    LEFT JOIN (SELECT hospital_sk, {pct(_ALL_DENIED, 'count(*)', 1)} AS denial FROM fact_claim
        GROUP BY 1) AS c ON c.hospital_sk = h.hospital_sk""")
def facility_map(b: Bindings):
    return kpi.facility_map(b.fact_encounter(readmission=True), b.fact_claim(), b.dim_hospital)


_CENTRES = ", ".join(f"('{r}', {lat}, {lon})" for r, (lat, lon) in REGION_CENTRES.items())


@query("kpi_12_region_rollup", "governorate:s encounters:i total_cost:d lat:d lon:d", f"""
    SELECT patient_governorate AS governorate, count(*) AS encounters, sum(total_cost_usd) AS total_cost,
        coalesce(max(v.lat), {DEFAULT_CENTRE[0]}) AS lat, coalesce(max(v.lon), {DEFAULT_CENTRE[1]}) AS lon
    FROM view_encounter LEFT JOIN (VALUES {_CENTRES}) AS v(r, lat, lon) ON r = patient_governorate
    GROUP BY 1""")
def region_rollup(b: Bindings):
    return kpi.region_rollup(enc_view(b, readmission=False))


def vit_view(b: Bindings):
    return views.vitals_minute(b.star(*views.VITAL_TABLES))


@query("kpi_13_vitals_summary", "devices:i anomaly_minutes:i patients:i", """
    SELECT count(DISTINCT device_id) AS devices,
        count(*) FILTER (anomaly_event_count > 0) AS anomaly_minutes,
        count(DISTINCT patient_name) AS patients
    FROM view_vitals WHERE minute_start_utc >= timestamp '2024-01-30'""")
def vitals_summary(b: Bindings):
    return kpi.vitals_summary(vit_view(b), VITALS_ASOF)


@query("kpi_13_vitals_series", "patient_name:s local_time:s heart_rate_avg:d spo2_avg:d systolic_avg:d",
       """
    SELECT patient_name, minute_start_utc + interval 2 hour AS local_time, heart_rate_avg, spo2_avg,
        systolic_avg FROM view_vitals WHERE minute_start_utc >= timestamp '2024-01-30'""")
def vitals_series(b: Bindings):
    return kpi.vitals_series(vit_view(b), VITALS_ASOF)


@query("kpi_14_recommendation_line", "encounters:i inpatient:i emergency:i readmit30d:i avg_los_h:d "
       "claims:i denial_rate:d collection_rate:d", f"""
    SELECT e.*, c.* FROM (SELECT count(*) AS encounters, count(*) FILTER (is_inpatient) AS inpatient,
        count(*) FILTER (is_emergency) AS emergency, count(*) FILTER (is_readmission_30d) AS readmit30d,
        (20 * sum(cast(length_of_stay_hours AS hugeint)) + count(length_of_stay_hours))
            // (2 * count(length_of_stay_hours)) / 10.0::double AS avg_los_h FROM readmit) AS e,
    (SELECT count(*) AS claims, {pct(_ALL_DENIED, 'count(*)', 1)} AS denial_rate,
        {pct(cents('sum(paid_amount)'), cents('sum(billed_amount)'), 1)} AS collection_rate
        FROM claim) AS c""")
def recommendation_line(b: Bindings):
    return kpi.recommendation_line(b.encounters(readmission=True), b.claims())


@query("kpi_15_carrier_denial", "carrier:s claims:i denial_pct:d", f"""
    SELECT carrier, count(*) AS claims, {pct(_ALL_DENIED, 'count(*)')} AS denial_pct
    FROM claim GROUP BY 1""")
def carrier_denial(b: Bindings):
    return kpi.carrier_denial(b.raw_claims())


@query("str_11_active_alerts", "minute_start_utc:s device_id:s bed_number:s anomaly_event_count:i "
       "primary_anomaly_kind:s", """
    SELECT * FROM view_vitals WHERE anomaly_event_count > 0
        AND minute_start_utc >= timestamp '2024-01-30'
    ORDER BY minute_start_utc DESC, device_id, bed_number LIMIT 20""")
def active_alerts(b: Bindings):
    """The newest twenty alert minutes of the last day."""
    hot = queries.q10(b.star("fact_vital_signs_minute", "dim_patient", "dim_hospital"), VITALS_ASOF)
    return kpi.active_alerts(hot)
