"""Registered queries: the twelve analytical questions."""

from __future__ import annotations

from wardlake.bindings import ASOF, CHRONIC, VITALS_ASOF, Bindings
from wardlake.contract.registry import query
from wardlake.contract.sqlbind import avg2, cents, pct
from wardlake.plans import queries

_LOS = "cast(length_of_stay_hours AS decimal(10,2))"


@query("q01_top_diagnoses", "hospital_name:s icd10_code:s diagnosis:s encounter_count:i", """
    SELECT * FROM (SELECT hospital_name, icd10_code, description AS diagnosis,
        count(*) AS encounter_count, row_number() OVER (PARTITION BY hospital_name
            ORDER BY count(*) DESC, icd10_code) AS rn
        FROM fact_encounter_dx AS f JOIN facility USING (hospital_sk)
        JOIN diagnosis AS d ON d.diagnosis_sk = f.primary_diagnosis_sk
        WHERE start_at::date >= date '2000-08-01' GROUP BY 1, 2, 3) AS x WHERE rn <= 10""")
def q01(b: Bindings):
    return queries.q01(b.star("fact_encounter", "dim_hospital", "dim_diagnosis", diagnosis=True), ASOF)


@query("q02_readmission_rate", "hospital_name:s year:i quarter:i inpatient_discharges:i "
       "readmissions_30d:i readmission_rate_pct:d", f"""
    SELECT hospital_name, year(start_at) AS year, quarter(start_at) AS quarter,
        count(*) FILTER (is_inpatient) AS inpatient_discharges,
        count(*) FILTER (is_readmission_30d) AS readmissions_30d,
        {pct('count(*) FILTER (is_readmission_30d)', 'count(*) FILTER (is_inpatient)')}
            AS readmission_rate_pct
    FROM fact_encounter JOIN facility USING (hospital_sk) WHERE year(start_at) >= 1999
    GROUP BY 1, 2, 3""")
def q02(b: Bindings):
    return queries.q02(b.star("fact_encounter", "dim_hospital", "dim_date", readmission=True), ASOF)


@query("q03_length_of_stay", "hospital_name:s chapter:s inpatient_stays:i avg_los_hours:d "
       "max_los_hours:d", f"""
    WITH eligible AS (SELECT hospital_name, chapter, length_of_stay_hours FROM fact_encounter_dx AS f
        JOIN facility USING (hospital_sk)
        JOIN diagnosis AS d ON d.diagnosis_sk = f.primary_diagnosis_sk
        WHERE is_inpatient AND length_of_stay_hours IS NOT NULL)
    SELECT hospital_name, chapter, count(*) AS inpatient_stays, {avg2(_LOS)} AS avg_los_hours,
        max(length_of_stay_hours) AS max_los_hours
    FROM eligible WHERE length_of_stay_hours::double
        <= (SELECT quantile_cont(length_of_stay_hours::double, 0.99) FROM eligible) GROUP BY 1, 2""")
def q03(b: Bindings):
    return queries.q03(b.star("fact_encounter", "dim_hospital", "dim_diagnosis", diagnosis=True))


@query("q04_denial_rate", "payer_name:s year:i month:i total_claims:i denied_claims:i "
       "denial_rate_pct:d total_billed:d total_denied_billed:d dollar_denial_pct:d", f"""
    SELECT payer_name, year(service_date) AS year, month(service_date) AS month,
        count(*) AS total_claims, count(*) FILTER (is_denied) AS denied_claims,
        {pct('count(*) FILTER (is_denied)', 'count(*)')} AS denial_rate_pct,
        sum(billed_amount) AS total_billed,
        coalesce(sum(billed_amount) FILTER (is_denied), 0) AS total_denied_billed,
        {pct(cents('coalesce(sum(billed_amount) FILTER (is_denied), 0)'), cents('sum(billed_amount)'))}
            AS dollar_denial_pct
    FROM fact_claim JOIN payer USING (payer_sk) WHERE service_date >= date '2000-08-01'
    GROUP BY 1, 2, 3""")
def q04(b: Bindings):
    return queries.q04(b.star("fact_claim", "dim_payer", "dim_date"), ASOF)


@query("q05_revenue_per_encounter", "hospital_name:s encounter_class:s encounters:i "
       "avg_encounter_cost:d avg_billed:d avg_paid:d total_paid:d collection_rate_pct:d", f"""
    SELECT hospital_name, encounter_class, count(DISTINCT f.encounter_sk) AS encounters,
        {avg2('total_cost_usd')} AS avg_encounter_cost, {avg2('billed_amount')} AS avg_billed,
        {avg2('paid_amount')} AS avg_paid, sum(paid_amount) AS total_paid,
        {pct(cents('sum(paid_amount)'), cents('sum(billed_amount)'))} AS collection_rate_pct
    FROM fact_encounter AS f JOIN fact_claim AS c ON c.encounter_sk = f.encounter_sk
    JOIN facility AS h ON h.hospital_sk = f.hospital_sk WHERE year(start_at) = 2001 GROUP BY 1, 2""")
def q05(b: Bindings):
    return queries.q05(b.star("fact_encounter", "fact_claim", "dim_hospital"), ASOF)


@query("q05_revenue_once_per_encounter", "hospital_name:s encounter_class:s encounters:i "
       "avg_encounter_cost:d avg_billed:d avg_paid:d total_paid:d collection_rate_pct:d", f"""
    SELECT hospital_name, encounter_class, count(*) AS encounters,
        {avg2('total_cost_usd')} AS avg_encounter_cost, {avg2('billed')} AS avg_billed,
        {avg2('paid')} AS avg_paid, sum(paid) AS total_paid,
        {pct(cents('sum(paid)'), cents('sum(billed)'))} AS collection_rate_pct
    FROM fact_encounter AS f JOIN (SELECT encounter_sk, sum(billed_amount) AS billed,
        sum(paid_amount) AS paid FROM fact_claim GROUP BY 1) AS c ON c.encounter_sk = f.encounter_sk
    JOIN facility AS h ON h.hospital_sk = f.hospital_sk WHERE year(start_at) = 2001 GROUP BY 1, 2""")
def q05_once(b: Bindings):
    return queries.q05_per_encounter(b.star("fact_encounter", "fact_claim", "dim_hospital"), ASOF)


@query("q06_emergency_throughput", "hospital_name:s day_name:s day_of_week:i ed_visits:i "
       "avg_los_hours:d max_los_hours:d ed_readmissions:i", f"""
    SELECT hospital_name, dayname(start_at) AS day_name, dayofweek(start_at) + 1 AS day_of_week,
        count(*) AS ed_visits, {avg2(_LOS)} AS avg_los_hours,
        max(length_of_stay_hours) AS max_los_hours,
        count(*) FILTER (is_readmission_30d) AS ed_readmissions
    FROM fact_encounter JOIN facility USING (hospital_sk)
    WHERE encounter_class = 'emergency' AND start_at::date >= date '2001-05-01' GROUP BY 1, 2, 3""")
def q06(b: Bindings):
    return queries.q06(b.star("fact_encounter", "dim_hospital", "dim_date", readmission=True), ASOF)


@query("q07_chronic_burden", "governorate:s age_band:s gender:s patients_with_2_plus:i "
       "avg_conditions:r", """
    SELECT governorate, age_band, gender, count(*) AS patients_with_2_plus,
        avg(k) AS avg_conditions
    FROM (SELECT f.patient_sk, count(DISTINCT icd10_code) AS k FROM bridge AS g
        JOIN fact_encounter AS f ON f.encounter_sk = g.encounter_sk
        WHERE (icd10_code LIKE 'E%' OR icd10_code LIKE 'I%')
            AND icd10_code IN (SELECT icd10_code FROM diagnosis) GROUP BY 1) AS s
    JOIN patient AS p ON p.patient_sk = s.patient_sk WHERE k >= 2 GROUP BY 1, 2, 3""")
def q07(b: Bindings):
    return queries.q07(b.star("bridge_encounter_diagnosis", "fact_encounter", "dim_diagnosis",
                              "dim_patient"), CHRONIC)


@query("q08_provider_productivity", "provider_name:s specialty:s primary_facility:s encounters_ytd:i "
       "unique_patients_ytd:i avg_encounter_revenue:d total_revenue_ytd:d", f"""
    SELECT p.full_name AS provider_name, specialty, hospital_name AS primary_facility,
        count(DISTINCT encounter_sk) AS encounters_ytd, count(DISTINCT patient_sk) AS unique_patients_ytd,
        {avg2('total_cost_usd')} AS avg_encounter_revenue, sum(total_cost_usd) AS total_revenue_ytd
    FROM fact_encounter AS f JOIN provider AS p ON p.provider_sk = f.provider_sk AND p.is_active
    LEFT JOIN facility AS h ON h.hospital_sk = p.primary_facility_sk
    WHERE year(start_at) = 2001 GROUP BY 1, 2, 3 HAVING count(DISTINCT encounter_sk) >= 10
    ORDER BY total_revenue_ytd DESC, provider_name LIMIT 50""")
def q08(b: Bindings):
    return queries.q08(b.star("fact_encounter", "dim_provider", "dim_hospital", provider=True), ASOF,
                       min_encounters=10)


@query("q09_drug_spend", "rxnorm_code:s drug:s prescription_count:i total_dispenses:i total_spend:d "
       "avg_cost_per_rx:d", f"""
    SELECT rxnorm_code, min(description) AS drug, count(*) AS prescription_count,
        sum(dispenses) AS total_dispenses, sum(total_cost_usd) AS total_spend,
        {avg2('total_cost_usd')} AS avg_cost_per_rx
    FROM prescription WHERE year(start_date) = 2001 AND total_cost_usd IS NOT NULL
    GROUP BY 1 ORDER BY total_spend DESC, rxnorm_code LIMIT 20""")
def q09(b: Bindings):
    return queries.q09(b.star("fact_prescription", "dim_drug"), ASOF)


@query("q10_vital_anomalies", "minute_start_utc:s device_id:s bed_number:s patient_id:s patient_name:s "
       "hospital_name:s heart_rate_avg:d heart_rate_max:d spo2_min:d systolic_avg:d diastolic_avg:d "
       "temperature_c_max:d anomaly_event_count:i primary_anomaly_kind:s", """
    SELECT * FROM view_vitals WHERE anomaly_event_count > 0
        AND minute_start_utc >= timestamp '2024-01-30'""")
def q10(b: Bindings):
    return queries.q10(b.star("fact_vital_signs_minute", "dim_patient", "dim_hospital"), VITALS_ASOF)


@query("q11_payer_mix", "governorate:s payer_name:s claim_count:i total_billed:d total_paid:d "
       "share_of_governorate_pct:d", f"""
    SELECT *, {pct('claim_count', 'sum(claim_count) OVER (PARTITION BY governorate)')}
            AS share_of_governorate_pct
    FROM (SELECT coalesce(governorate, 'Unknown') AS governorate, payer_name, count(*) AS claim_count,
        sum(billed_amount) AS total_billed, sum(paid_amount) AS total_paid
        FROM fact_claim AS c JOIN payer USING (payer_sk)
        LEFT JOIN patient AS p ON p.patient_sk = c.patient_sk
        WHERE service_date >= date '2001-02-01' GROUP BY 1, 2) AS x""")
def q11(b: Bindings):
    return queries.q11(b.star("fact_claim", "dim_payer", "dim_patient"), ASOF)


@query("q12_orphan_claims", "service_date:s total_claims:i orphan_claims:i orphan_pct:d", f"""
    SELECT service_date, count(*) AS total_claims,
        count(*) FILTER (encounter_sk IS NULL) AS orphan_claims,
        {pct('count(*) FILTER (encounter_sk IS NULL)', 'count(*)')} AS orphan_pct
    FROM fact_claim WHERE service_date >= date '2001-07-02' GROUP BY 1""")
def q12(b: Bindings):
    return queries.q12(b.star("fact_claim", "dim_date", check=True), ASOF)
