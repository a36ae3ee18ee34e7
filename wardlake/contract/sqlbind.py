"""The bindings of the domain tables in SQL, written independently of the Spark code."""

from __future__ import annotations

import re

from wardlake.functions.clinical import (AGE_BANDS, ICD10_RANGES, OLDEST_BAND, REGION_BY_DIGIT,
                                         UNCLASSIFIED)
from wardlake.schemas import PAYERS


def sk(expr: str) -> str:
    return f"cast('0x' || substr(md5({expr}), 1, 12) AS bigint)"


def dsk(expr: str) -> str:
    return f"cast(strftime({expr}, '%Y%m%d') AS integer)"


def avg2(expr: str) -> str:
    """Half-up mean of a decimal with two places, in integer arithmetic."""
    cents = f"cast(({expr}) * 100 AS hugeint)"
    return f"(((2 * sum({cents}) + count({expr})) // nullif(2 * count({expr}), 0))::double / 100)"


def pct(num: str, den: str, places: int = 2) -> str:
    """Half-up percentage of two non-negative integers."""
    scale = 10 ** places
    n, d = f"cast({num} AS hugeint)", f"cast({den} AS hugeint)"
    return f"(((200 * {scale} * {n} + {d}) // nullif(2 * {d}, 0))::double / {scale})"


def ratio4(num: str, den: str) -> str:
    n, d = f"cast({num} AS hugeint)", f"cast({den} AS hugeint)"
    return f"(((20000 * {n} + {d}) // nullif(2 * {d}, 0))::double / 10000)"


def cents(expr: str) -> str:
    return f"(({expr}) * 100)"


def _case_region(expr: str) -> str:
    whens = " ".join(f"WHEN '{d}' THEN '{r}'" for d, r in REGION_BY_DIGIT.items())
    return f"CASE right(md5(coalesce({expr}, '')), 1) {whens} END"


def _case_age(dob: str, asof: str) -> str:
    years = f"floor(date_diff('day', {dob}, date '{asof}') / 365.25)"
    whens = " ".join(f"WHEN {years} < {b} THEN '{n}'" for b, n in AGE_BANDS)
    return f"CASE WHEN {dob} IS NULL THEN NULL {whens} ELSE '{OLDEST_BAND}' END"


def _case_chapter(code: str) -> str:
    num = f"coalesce(try_cast(substr({code}, 2, 2) AS integer), 0)"
    whens = " ".join(
        f"WHEN upper(substr({code}, 1, 1)) = '{letter}' AND {num} BETWEEN {lo} AND {hi} THEN '{name}'"
        for letter, lo, hi, name in ICD10_RANGES)
    return f"CASE {whens} ELSE '{UNCLASSIFIED}' END"


def _code(key: str) -> str:
    return f"chr(cast(65 + {key} % 26 AS integer)) || lpad(cast({key} % 100 AS varchar), 2, '0')"


def _npi(key: str) -> str:
    return f"lpad(cast({key} + 1 AS varchar), 10, '0')"


_CARRIER = "CASE WHEN l_partkey % 53 = 0 THEN NULL " + " ".join(
    f"WHEN l_partkey % {len(PAYERS)} = {i} THEN '{p}'" for i, p in enumerate(PAYERS)) + " END"
_GOV = " OR ".join(f"payer_name = '{p}'" for p, g in PAYERS.items() if g)
_KIND = """CASE WHEN hr > 130 THEN 'tachycardia' WHEN hr < 45 THEN 'bradycardia'
    WHEN spo2 < 88 THEN 'hypoxia' WHEN sbp > 180 THEN 'hypertension'
    WHEN temp > 39.5 THEN 'fever' END"""


def _mavg(expr: str) -> str:
    return avg2(f"cast({expr} AS decimal(9,2))")


TABLES = {
    "facility": f"""
        SELECT {sk('n_name')} AS hospital_sk, n_name AS hospital_bk,
            'Facility ' || n_nationkey AS hospital_name,
            CASE WHEN n_nationkey >= 5 THEN 'clinic' ELSE 'hospital' END AS facility_type,
            n_name AS city, r_name AS governorate,
            CASE WHEN n_nationkey >= 5 THEN 0 ELSE 100 + 20 * n_nationkey END AS bed_count,
            true AS is_active, 22.5 + n_nationkey % 9 AS lat, 25.25 + n_nationkey % 11 AS lon
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "pool": """
        SELECT hospital_sk, row_number() OVER (ORDER BY hospital_bk) - 1 AS slot,
            count(*) OVER () AS n FROM facility""",
    "calendar": f"""
        SELECT {dsk('d')} AS date_sk, d AS calendar_date, year(d) AS year, quarter(d) AS quarter,
            month(d) AS month, monthname(d) AS month_name, day(d) AS day_of_month,
            dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name,
            weekofyear(d) AS iso_week
        FROM (SELECT cast(unnest(generate_series(timestamp '1990-01-01', timestamp '2005-12-31',
            interval 1 day)) AS date) AS d)""",
    "patient": f"""
        SELECT patient_bk, {sk('patient_bk')} AS patient_sk, first_name, last_name,
            first_name || ' ' || last_name AS full_name, date_of_birth,
            {_case_age('date_of_birth', '2001-08-01')} AS age_band, gender, marital_status, race,
            ethnicity, address_line, postal_code, deceased_date, deceased_date IS NOT NULL AS is_deceased,
            {_case_region('state')} AS governorate, {_case_region('state')} AS city
        FROM (SELECT cast(c_custkey AS varchar) AS patient_bk, 'F' || (c_custkey % 100) AS first_name,
            c_name AS last_name,
            cast(date '2001-01-01' - cast((c_custkey * 37) % 33000 AS integer) AS date) AS date_of_birth,
            CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'U' END AS gender,
            c_mktsegment AS marital_status, 'R' || (c_custkey % 4) AS race,
            'E' || (c_custkey % 2) AS ethnicity, 'Street ' || c_custkey AS address_line,
            lpad(cast(c_custkey % 100000 AS varchar), 5, '0') AS postal_code,
            CASE WHEN c_custkey % 29 = 0 THEN date '2000-06-01' END AS deceased_date,
            'NATION_' || c_nationkey AS state FROM customer) AS c""",
    "provider": f"""
        SELECT {_npi('s_suppkey')} AS provider_bk, {sk(_npi('s_suppkey'))} AS provider_sk,
            'Doc' AS first_name, s_name AS last_name, 'Doc ' || s_name AS full_name,
            CASE WHEN s_suppkey % 2 = 0 THEN 'MD' ELSE 'DO' END AS credential,
            'SPEC_' || (s_suppkey % 8) AS specialty, 'NATION_' || s_nationkey AS hospital_bk,
            {sk("'NATION_' || s_nationkey")} AS primary_facility_sk,
            'LIC-' || s_suppkey AS license_number,
            cast(date '2002-01-01' + cast(s_suppkey % 700 AS integer) AS date) AS license_expiry,
            cast(date '1990-01-01' + cast(s_suppkey % 2000 AS integer) AS date) AS hire_date,
            s_acctbal >= 0 AS is_active
        FROM supplier""",
    "encounter": f"""
        SELECT *, date_diff('hour', start_at, end_at) AS length_of_stay_hours,
            encounter_class = 'inpatient' AS is_inpatient,
            encounter_class = 'emergency' AS is_emergency,
            total_cost_usd - payer_coverage_usd AS out_of_pocket_usd
        FROM (SELECT *, CASE WHEN k % 41 <> 0
                THEN start_at + to_hours(cast((k % 7) * 24 + k % 24 AS integer)) END AS end_at
            FROM (SELECT o_orderkey AS k, cast(o_orderkey AS varchar) AS encounter_bk,
                cast(o_custkey AS varchar) AS patient_bk, 'ORG-' || (o_orderkey % 97) AS organization_bk,
                CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'emergency' WHEN '2' THEN 'inpatient'
                    WHEN '3' THEN 'inpatient' WHEN '4' THEN 'ambulatory' ELSE 'wellness' END
                    AS encounter_class,
                o_orderpriority AS encounter_type,
                CASE WHEN o_orderkey % 5 > 1 THEN {_code('o_orderkey')} END AS reason_code,
                o_orderdate + to_hours(cast(o_orderkey % 24 AS integer)) AS start_at,
                cast(cast(o_totalprice AS decimal(12,2)) * cast(0.25 AS decimal(4,2)) AS decimal(12,2))
                    AS base_cost_usd,
                cast(o_totalprice AS decimal(12,2)) AS total_cost_usd,
                cast(cast(o_totalprice AS decimal(12,2)) * cast(0.8 AS decimal(4,2)) AS decimal(12,2))
                    AS payer_coverage_usd
            FROM orders) AS a) AS b""",
    "first_supplier": f"""
        SELECT cast(l_orderkey AS varchar) AS encounter_bk, {_npi('min(l_suppkey)')} AS provider_bk
        FROM lineitem GROUP BY l_orderkey""",
    "readmit": """
        SELECT *, coalesce(is_inpatient AND prior_end IS NOT NULL AND start_at >= prior_end
                AND epoch(start_at) - epoch(prior_end) <= 30 * 86400, false) AS is_readmission_30d
        FROM (SELECT *, max(CASE WHEN is_inpatient THEN coalesce(end_at, timestamp '9999-12-31') END) OVER (
                PARTITION BY patient_bk ORDER BY start_at, md5(encounter_bk), encounter_bk
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_end FROM encounter) AS x""",
    "condition_feed": f"""
        SELECT cast(l_orderkey AS varchar) AS encounter_bk, cast(l_orderkey // 10 AS varchar) AS patient_bk,
            {_code('l_partkey')} AS icd10_code,
            CASE WHEN l_partkey % 7 <> 0 THEN 'Condition ' || {_code('l_partkey')} END AS description,
            cast(l_shipdate AS date) AS onset_date
        FROM lineitem""",
    "bridge": f"""
        SELECT encounter_bk, icd10_code, {sk('encounter_bk')} AS encounter_sk,
            {sk('icd10_code')} AS diagnosis_sk,
            row_number() OVER (PARTITION BY encounter_bk ORDER BY onset, icd10_code) = 1 AS is_primary
        FROM (SELECT encounter_bk, icd10_code, min(onset_date) AS onset FROM condition_feed
            GROUP BY 1, 2) AS x""",
    "fact_encounter": f"""
        SELECT {sk('e.encounter_bk')} AS encounter_sk, e.*, {sk('e.patient_bk')} AS patient_sk,
            s.provider_bk, {sk('s.provider_bk')} AS provider_sk, p.hospital_sk,
            {dsk('start_at')} AS start_date_sk, {dsk('end_at')} AS end_date_sk
        FROM readmit AS e LEFT JOIN first_supplier AS s USING (encounter_bk)
        JOIN pool AS p ON {sk('e.organization_bk')} % p.n = p.slot""",
    "fact_encounter_dx": """
        SELECT f.*, b.diagnosis_sk AS primary_diagnosis_sk FROM fact_encounter AS f
        LEFT JOIN (SELECT * FROM bridge WHERE is_primary) AS b ON b.encounter_sk = f.encounter_sk""",
    "claim": f"""
        SELECT *, status = 'denied' AS is_denied, paid_amount = billed_amount AS is_paid_in_full,
            date_diff('day', submission_date, decision_date) AS days_to_decision,
            CASE WHEN status = 'denied' THEN billed_amount ELSE billed_amount - allowed_amount END
                AS denied_amount,
            CASE WHEN status IN ('submitted', 'pending_review') THEN billed_amount ELSE 0 END
                AS pending_amount,
            strftime(service_date, '%Y-%m') AS service_year_month,
            billed_amount - allowed_amount AS patient_responsibility, 'EGP' AS currency
        FROM (SELECT *, allowed_amount AS paid_amount,
                CASE WHEN status NOT IN ('submitted', 'pending_review')
                    THEN cast(submission_date + 14 AS date) END AS decision_date,
                CASE WHEN status = 'denied' THEN 'REASON_' || (l_suppkey % 5) END AS denial_reason
            FROM (SELECT *, cast(CASE status
                    WHEN 'approved' THEN cast(billed_amount * (cast(1 AS decimal(4,2)) - disc)
                        AS decimal(12,2))
                    WHEN 'partially_paid' THEN cast(billed_amount * cast(0.5 AS decimal(4,2))
                        AS decimal(12,2))
                    ELSE 0 END AS decimal(12,2)) AS allowed_amount
                FROM (SELECT *, cast(l_extendedprice AS decimal(12,2)) AS billed_amount,
                    cast(l_discount AS decimal(4,2)) AS disc,
                    md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                        cast(l_quantity AS decimal(12,2)), cast(l_extendedprice AS decimal(12,2)),
                        cast(l_discount AS decimal(4,2)), cast(l_tax AS decimal(4,2)),
                        l_returnflag, l_linestatus, cast(l_shipdate AS date))) AS claim_bk,
                    'CLM-' || l_orderkey || '-' || l_linenumber AS claim_number,
                    cast(l_orderkey // 10 AS varchar) AS patient_bk,
                    CASE WHEN l_partkey % 9 = 4 THEN 'X' || l_orderkey
                        ELSE cast(l_orderkey AS varchar) END AS encounter_bk,
                    {_npi('l_suppkey')} AS provider_bk, 'NATION_' || (l_orderkey % 25) AS hospital_bk,
                    {_CARRIER} AS carrier, cast(l_shipdate AS date) AS service_date,
                    cast(cast(l_shipdate AS date) + l_linenumber AS date) AS submission_date,
                    CASE WHEN l_returnflag = 'R' THEN 'denied'
                        WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'approved'
                        WHEN l_returnflag = 'A' THEN 'partially_paid'
                        WHEN l_linestatus = 'F' THEN 'submitted' ELSE 'pending_review' END AS status,
                    {_code('l_partkey')} AS primary_icd10_code,
                    CASE WHEN l_partkey % 7 <> 0 THEN 'Condition ' || {_code('l_partkey')} END
                        AS primary_diagnosis_description,
                    1 + l_linenumber % 4 AS line_count
                FROM lineitem) AS a) AS b) AS c""",
    "fact_claim": f"""
        SELECT {sk('c.claim_bk')} AS claim_sk, c.*,
            CASE WHEN o.k IS NOT NULL THEN {sk('c.encounter_bk')} END AS encounter_sk,
            {sk('c.patient_bk')} AS patient_sk, {sk('c.provider_bk')} AS provider_sk,
            {sk('c.hospital_bk')} AS hospital_sk, {sk('c.carrier')} AS payer_sk,
            {sk('c.primary_icd10_code')} AS primary_diagnosis_sk,
            {dsk('c.service_date')} AS service_date_sk, {dsk('c.submission_date')} AS submission_date_sk,
            {dsk('c.decision_date')} AS decision_date_sk
        FROM claim AS c LEFT JOIN (SELECT cast(o_orderkey AS varchar) AS k FROM orders) AS o
            ON o.k = c.encounter_bk""",
    "claim_line": """
        SELECT claim_bk, i AS line_number, cast(99000 + (l_suppkey + i) % 100 AS varchar) AS cpt_code,
            'Procedure ' || i AS description, i AS units,
            cast(billed_amount * cast(0.25 AS decimal(4,2)) AS decimal(12,2)) AS billed_amount
        FROM (SELECT *, unnest(range(1, line_count + 1)) AS i FROM claim) AS x""",
    "payer": f"""
        SELECT {sk('payer_name')} AS payer_sk, payer_name, {_GOV} AS is_government, true AS is_active
        FROM (SELECT DISTINCT carrier AS payer_name FROM claim WHERE carrier IS NOT NULL) AS x""",
    "diagnosis": f"""
        SELECT {sk('icd10_code')} AS diagnosis_sk, icd10_code, description,
            {_case_chapter('icd10_code')} AS chapter
        FROM (SELECT primary_icd10_code AS icd10_code, min(primary_diagnosis_description) AS description
            FROM claim GROUP BY 1) AS x""",
    "medication": f"""
        SELECT cast(l_orderkey AS varchar) AS encounter_bk, cast(l_orderkey // 10 AS varchar) AS patient_bk,
            cast(l_partkey AS varchar) AS rxnorm_code, 'Drug ' || l_partkey AS description,
            cast(l_shipdate AS date) AS start_date,
            CASE WHEN l_linenumber <> 7 THEN cast(cast(l_shipdate AS date)
                + cast(l_quantity AS integer) AS date) END AS stop_date,
            cast(l_quantity AS integer) AS dispenses,
            CASE WHEN l_partkey % 61 <> 0 THEN cast(l_extendedprice AS decimal(12,2)) END
                AS total_cost_usd
        FROM lineitem""",
    "prescription": f"""
        SELECT *, {sk("encounter_bk || '|' || rxnorm_code || '|' || start_date")} AS prescription_sk,
            {sk('encounter_bk')} AS encounter_sk, {sk('patient_bk')} AS patient_sk,
            {sk('rxnorm_code')} AS drug_sk, {dsk('start_date')} AS start_date_sk,
            {dsk('stop_date')} AS stop_date_sk,
            date_diff('day', start_date, stop_date) AS therapy_duration_days FROM medication""",
    "procedure_feed": """
        SELECT cast(l_orderkey AS varchar) AS encounter_bk, cast(l_orderkey // 10 AS varchar) AS patient_bk,
            cast(99000 + l_suppkey % 100 AS varchar) AS cpt_code,
            'Procedure ' || (l_suppkey % 100) AS description, l_shipdate AS performed_at,
            cast(l_quantity AS decimal(10,2)) AS base_cost_usd FROM lineitem""",
    "reading": f"""
        SELECT *, kind IS NOT NULL AS is_anomaly FROM (SELECT *, {_KIND} AS kind FROM (
            SELECT event_id, ts, 'DEV-' || user_id AS device_id, cast(user_id AS varchar) AS patient_id,
                'NATION_' || (user_id % 26) AS hospital_code, 'B' || (event_id % 3) AS bed_number,
                (4000 + c % 11000) / 100.0::double AS hr,
                CASE WHEN event_id % 37 <> 0 THEN (8500 + c % 1600) / 100.0::double END AS spo2,
                (9000 + c % 11000) / 100.0::double AS sbp, (5000 + c % 4000) / 100.0::double AS dbp,
                (600 + c % 2400) / 100.0::double AS rr, (3600 + c % 400) / 100.0::double AS temp
            FROM (SELECT *, cast(round(value * 100) AS bigint) AS c FROM events) AS a) AS b) AS d""",
    "minute_all": f"""
        SELECT g.*, k.kind AS primary_anomaly_kind FROM (
            SELECT date_trunc('minute', ts) AS minute_start_utc, device_id, patient_id, hospital_code,
                bed_number, count(*) AS sample_count, {_mavg('hr')} AS heart_rate_avg,
                max(hr) AS heart_rate_max, min(hr) AS heart_rate_min, {_mavg('spo2')} AS spo2_avg,
                min(spo2) AS spo2_min, {_mavg('sbp')} AS systolic_avg, {_mavg('dbp')} AS diastolic_avg,
                {_mavg('rr')} AS respiratory_rate_avg, {_mavg('temp')} AS temperature_c_avg,
                max(temp) AS temperature_c_max,
                sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS anomaly_event_count
            FROM reading GROUP BY 1, 2, 3, 4, 5) AS g
        LEFT JOIN (SELECT * FROM (SELECT date_trunc('minute', ts) AS m, device_id AS d, bed_number AS b,
                kind, row_number() OVER (PARTITION BY date_trunc('minute', ts), device_id, bed_number
                    ORDER BY count(*) DESC, kind) AS rn
                FROM reading WHERE is_anomaly GROUP BY 1, 2, 3, 4) AS r WHERE rn = 1) AS k
            ON k.m = g.minute_start_utc AND k.d = g.device_id AND k.b = g.bed_number""",
    "minute_closed": """
        SELECT * FROM minute_all WHERE minute_start_utc + interval 1 minute
            <= (SELECT max(ts) FROM events) - interval 5 minute""",
    "minute_fact": f"""
        SELECT m.*, {dsk('minute_start_utc')} AS date_sk, {sk('patient_id')} AS patient_sk,
            coalesce(f.hospital_sk, -1) AS hospital_sk
        FROM minute_all AS m LEFT JOIN facility AS f ON f.hospital_bk = m.hospital_code""",
    "view_encounter": """
        SELECT fe.encounter_sk, fe.encounter_bk AS encounter_id, fe.encounter_class, fe.start_date_sk,
            dd.calendar_date AS encounter_date, dd.year AS encounter_year, dd.month AS encounter_month,
            dd.month_name AS encounter_month_name, dd.day_name AS encounter_day_of_week,
            fe.length_of_stay_hours, fe.is_inpatient, fe.is_emergency, fe.is_readmission_30d,
            cast(NULL AS varchar) AS discharge_status, fe.total_cost_usd, fe.payer_coverage_usd,
            fe.out_of_pocket_usd, p.patient_bk AS patient_id, p.full_name AS patient_name, p.age_band,
            p.gender, p.governorate AS patient_governorate, h.hospital_bk AS hospital_code,
            h.hospital_name, h.facility_type, h.governorate AS hospital_governorate, h.bed_count,
            pr.full_name AS provider_name, pr.specialty AS provider_specialty,
            dx.icd10_code AS primary_icd10_code, dx.description AS primary_diagnosis,
            dx.chapter AS diagnosis_chapter
        FROM fact_encounter_dx AS fe LEFT JOIN calendar AS dd ON dd.date_sk = fe.start_date_sk
        LEFT JOIN patient AS p ON p.patient_sk = fe.patient_sk
        LEFT JOIN facility AS h ON h.hospital_sk = fe.hospital_sk
        LEFT JOIN provider AS pr ON pr.provider_sk = fe.provider_sk
        LEFT JOIN diagnosis AS dx ON dx.diagnosis_sk = fe.primary_diagnosis_sk""",
    "view_claim": """
        SELECT fc.*, ds.calendar_date AS v_service_date, ds.year AS service_year,
            ds.month AS service_month, dc.calendar_date AS v_decision_date, py.payer_name,
            py.is_government AS is_government_payer, h.hospital_name, h.facility_type,
            p.age_band AS patient_age_band, p.gender AS patient_gender,
            p.governorate AS patient_governorate, dx.description AS primary_diagnosis
        FROM fact_claim AS fc LEFT JOIN calendar AS ds ON ds.date_sk = fc.service_date_sk
        LEFT JOIN calendar AS dc ON dc.date_sk = fc.decision_date_sk
        LEFT JOIN payer AS py ON py.payer_sk = fc.payer_sk
        LEFT JOIN facility AS h ON h.hospital_sk = fc.hospital_sk
        LEFT JOIN patient AS p ON p.patient_sk = fc.patient_sk
        LEFT JOIN diagnosis AS dx ON dx.diagnosis_sk = fc.primary_diagnosis_sk""",
    "view_vitals": """
        SELECT vs.*, p.full_name AS patient_name, h.hospital_name,
            h.governorate AS hospital_governorate
        FROM minute_fact AS vs LEFT JOIN patient AS p ON p.patient_sk = vs.patient_sk
        LEFT JOIN facility AS h ON h.hospital_sk = vs.hospital_sk""",
}


def with_tables(body: str) -> str:
    """Prefix the body with the bindings it names, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text) and name not in order:
                visit(TABLES[name])
                if name not in order:
                    order.append(name)

    visit(body)
    if not order:
        return body
    parts = [f"{n} AS ({TABLES[n].strip()})" for n in order]
    return re.sub(r"\n\s+", "\n", "WITH " + ",\n".join(parts) + "\n" + body)
