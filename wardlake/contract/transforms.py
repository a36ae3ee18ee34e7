"""Registered queries: projections, filters and derivations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from wardlake.bindings import ASOF, LOAD_TS, Bindings
from wardlake.contract.registry import query
from wardlake.contract.sinks import store
from wardlake.contract.sqlbind import _case_chapter, _case_region, sk
from wardlake.functions import clinical, dates, keys
from wardlake.functions.keys import hash_sk
from wardlake.operators import dims, dq, governance, monitor, profile
from wardlake.plans import kpi, views
from wardlake.streaming import vitals


@query("prj_01_patient_conform", "patient_bk:s first_name:s last_name:s date_of_birth:s gender:s "
       "marital_status:s race:s ethnicity:s address_line:s postal_code:s deceased_date:s "
       "governorate:s city:s age_band:s is_deceased:b", "SELECT * FROM patient")
def patient_conform(b: Bindings):
    return b.patients()


@query("prj_02_provider_conform", "provider_bk:s full_name:s credential:s specialty:s hospital_bk:s "
       "license_number:s license_expiry:s hire_date:s is_active:b", "SELECT * FROM provider")
def provider_conform(b: Bindings):
    return b.providers()


@query("prj_03_encounter_conform", "encounter_bk:s patient_bk:s organization_bk:s encounter_class:s "
       "encounter_type:s reason_code:s start_at:s end_at:s base_cost_usd:d total_cost_usd:d "
       "payer_coverage_usd:d", "SELECT * FROM encounter")
def encounter_conform(b: Bindings):
    return b.encounters()


@query("prj_04_claim_conform", "claim_bk:s claim_number:s encounter_bk:s patient_bk:s provider_bk:s "
       "hospital_bk:s carrier:s primary_icd10_code:s primary_diagnosis_description:s "
       "service_date:s submission_date:s decision_date:s status:s denial_reason:s "
       "billed_amount:d allowed_amount:d paid_amount:d patient_responsibility:d currency:s",
       "SELECT * FROM claim")
def claim_conform(b: Bindings):
    return b.claims()


@query("prj_05_encounter_derive", "encounter_bk:s length_of_stay_hours:d is_inpatient:b "
       "is_emergency:b out_of_pocket_usd:d start_year_month:s", """
    SELECT *, strftime(start_at, '%Y-%m') AS start_year_month FROM encounter""")
def encounter_derive(b: Bindings):
    return b.encounters()


@query("prj_06_claim_derive", "claim_bk:s is_denied:b is_paid_in_full:b days_to_decision:i "
       "denied_amount:d pending_amount:d line_count:i service_year_month:s", "SELECT * FROM claim")
def claim_derive(b: Bindings):
    return b.claims()


@query("prj_07_age_band", "age_band:s n:i youngest:s", """
    SELECT age_band, count(*) AS n, max(date_of_birth) AS youngest FROM patient GROUP BY 1""")
def age_band(b: Bindings):
    band = clinical.age_band(F.col("date_of_birth"), F.lit(ASOF))
    return b.patients().groupBy(band.alias("age_band")).agg(
        F.count(F.lit(1)).alias("n"), F.max("date_of_birth").alias("youngest"))


@query("prj_08_region_remap", "c_custkey:i region:s", f"""
    SELECT c_custkey, {_case_region("c_name")} AS region FROM customer""")
def region_remap(b: Bindings):
    return b.table("customer").select("c_custkey", clinical.remap_region(F.col("c_name")).alias("region"))


@query("prj_09_surrogate_key", "o_orderkey:i single:i combined:i missing:i", f"""
    SELECT o_orderkey, {sk("cast(o_orderkey AS varchar)")} AS single,
        {sk("o_orderkey || '|' || o_custkey")} AS combined, NULL AS missing FROM orders""")
def surrogate_key(b: Bindings):
    return b.table("orders").select(
        "o_orderkey", keys.hash_sk("o_orderkey").alias("single"),
        keys.hash_sk("o_orderkey", "o_custkey").alias("combined"),
        keys.hash_sk(F.lit(None).cast("string")).alias("missing"))


@query("prj_09_key_collisions", "entity:s collisions:i", f"""
    SELECT entity, count(*) FILTER (many) AS collisions FROM (
        SELECT entity, count(DISTINCT bk) > 1 AS many FROM (
            SELECT 'patient' AS entity, cast(c_custkey AS varchar) AS bk FROM customer
            UNION ALL SELECT 'encounter', cast(o_orderkey AS varchar) FROM orders
            UNION ALL SELECT 'drug', cast(p_partkey AS varchar) FROM part) AS x
        GROUP BY entity, {sk("bk")}) AS y GROUP BY entity""")
def key_collisions(b: Bindings):
    found = None
    for entity, table, key in [("patient", "customer", "c_custkey"), ("encounter", "orders", "o_orderkey"), ("drug", "part", "p_partkey")]:
        rows = b.table(table).select(F.col(key).cast("string").alias("bk"), keys.hash_sk(key).alias("sk"))
        one = profile.key_collisions(rows, "bk", "sk").agg(F.count(F.lit(1)).alias("collisions")).select(F.lit(entity).alias("entity"), "collisions")
        found = one if found is None else found.unionByName(one)
    return found


@query("prj_10_date_key", "start_sk:i end_sk:i n:i", """
    SELECT cast(strftime(start_at, '%Y%m%d') AS integer) AS start_sk,
        cast(strftime(end_at, '%Y%m%d') AS integer) AS end_sk, count(*) AS n
    FROM encounter GROUP BY 1, 2""")
def date_key(b: Bindings):
    return b.encounters().groupBy(
        keys.date_sk("start_at").alias("start_sk"), keys.date_sk("end_at").alias("end_sk"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("prj_11_bucket_assign", "encounter_bk:s hospital_bk:s", f"""
    SELECT encounter_bk, hospital_bk FROM encounter JOIN
        (SELECT hospital_bk, row_number() OVER (ORDER BY hospital_bk) - 1 AS slot,
            count(*) OVER () AS n FROM facility) AS p
    ON {sk('organization_bk')} % n = slot""")
def bucket_assign(b: Bindings):
    return keys.bucket_assign(b.encounters(), "organization_bk", b.dim_hospital, "hospital_bk",
                              ["hospital_bk"], "md5")


@query("prj_13_icd10_chapter", "icd10_code:s chapter:s n:i", f"""
    SELECT icd10_code, {_case_chapter('icd10_code')} AS chapter, n FROM (
        SELECT icd10_code, count(*) AS n FROM condition_feed GROUP BY 1) AS x""")
def icd10_chapter(b: Bindings):
    counts = b.conditions().groupBy("icd10_code").agg(F.count(F.lit(1)).alias("n"))
    return clinical.icd10_chapter(counts, "icd10_code")


@query("prj_14_record_hash", "patient_bk:s record_hash:s", """
    SELECT patient_bk, upper(sha256(concat_ws('|', first_name, last_name, date_of_birth, gender,
        marital_status, race, ethnicity, governorate, city, is_deceased))) AS record_hash
    FROM patient""")
def record_hash(b: Bindings):
    return b.dim_patient


@query("prj_15_anomaly_rule", "event_id:i derived_anomaly:b derived_anomaly_kind:s", """
    SELECT event_id, is_anomaly AS derived_anomaly, kind AS derived_anomaly_kind FROM reading""")
def anomaly_rule(b: Bindings):
    return vitals.flag_anomalies(b.as_vitals(b.events()))


@query("prj_16_vital_keys", "device_id:s bed_number:s minute_start_utc:s vital_sk:i slot:i", f"""
    SELECT device_id, bed_number, minute_start_utc,
        cast('0x' || substr(md5(device_id || '|' || bed_number || '|' || cast(minute_start_utc
            AS varchar)), 1, 15) AS bigint) AS vital_sk,
        {sk('device_id')} % 2000 + 1 AS slot FROM minute_fact""")
def vital_keys(b: Bindings):
    return b.fact_minutes().withColumn("slot", vitals.device_member("device_id", 2000))


@query("prj_17_local_time", "event_id:i local_second:s", """
    SELECT event_id, cast(date_trunc('second', ts) + interval 2 hour AS varchar) AS local_second
    FROM events""")
def local_time(b: Bindings):
    """Cairo was two hours ahead of UTC in January 2024."""
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    return b.events().select("event_id", dates.to_local(ts).alias("local_second"))


@query("prj_18_trailing_window", "period:s n:i", """
    SELECT '12 months' AS period, count(*) AS n FROM encounter WHERE start_at >= timestamp '2000-08-01'
    UNION ALL SELECT '30 days', count(*) FROM encounter WHERE start_at >= timestamp '2001-07-02'
    UNION ALL SELECT 'year', count(*) FROM encounter WHERE year(start_at) = 2001
    UNION ALL SELECT 'two years', count(*) FROM encounter WHERE year(start_at) >= 1999""")
def trailing_window(b: Bindings):
    """All windows from one scan."""
    key = keys.date_sk("start_at")
    enc = b.encounters().select(key.alias("sk"))
    cond = {
        "12 months": dates.trailing_sk("sk", 12, "month", ASOF),
        "30 days": dates.trailing_sk("sk", 30, "day", ASOF),
        "year": dates.in_year_sk("sk", ASOF.year),
        "two years": dates.since_year_sk("sk", ASOF.year - 2),
    }
    row = enc.agg(*[F.count(F.when(c, F.lit(1))).alias(n) for n, c in cond.items()])
    pairs = [F.struct(F.lit(n).alias("period"), F.col(f"`{n}`").alias("n")) for n in cond]
    return row.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


@query("prj_19_interactive_filter", "encounter_id:s encounter_date:s hospital_name:s", """
    SELECT encounter_id, encounter_date, hospital_name FROM view_encounter
    WHERE hospital_name = 'Facility 3' AND encounter_date BETWEEN date '1998-01-01' AND date '1999-12-31'
""")
def interactive_filter(b: Bindings):
    view = views.encounter_enriched(b.star(*views.ENCOUNTER_TABLES, diagnosis=True, provider=True))
    return kpi.filtered(view, "encounter_date", date(1998, 1, 1), date(1999, 12, 31), "Facility 3")


@query("prj_20_row_security", "hospital_bk:s role:s n:i", """
    SELECT hospital_bk, 'HospitalOps' AS role, count(*) AS n
    FROM fact_encounter JOIN facility USING (hospital_sk)
    WHERE hospital_bk IN (SELECT n_name FROM nation WHERE n_nationkey % 4 = 0) GROUP BY 1
    UNION ALL SELECT hospital_bk, 'RevenueCycle', count(*)
    FROM fact_encounter JOIN facility USING (hospital_sk) GROUP BY 1""")
def row_security(b: Bindings):
    """A mapped user sees some facilities, the open role all of them."""
    k = F.col("n_nationkey")
    members = b.table("nation").select(
        F.concat(F.lit("user"), (k % 4).cast("string")).alias("user_name"),
        F.col("n_name").alias("hospital_bk"))
    rows = b.fact_encounter().join(b.dim_hospital.select("hospital_sk", "hospital_bk"), "hospital_sk")
    out = None
    for role in ("HospitalOps", "RevenueCycle"):
        one = governance.restrict(rows, "user0", role, members).groupBy("hospital_bk") \
            .agg(F.count(F.lit(1)).alias("n")).withColumn("role", F.lit(role))
        out = one if out is None else out.unionByName(one)
    return out


@query("prj_21_mask", "patient_bk:s full_name:s", """
    SELECT patient_bk, regexp_replace(regexp_replace(regexp_replace(regexp_replace(full_name,
        '[^A-Za-z0-9]', '*', 'g'), '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS full_name FROM patient""")
def mask(b: Bindings):
    return governance.mask(b.dim_patient, ["full_name"], "Analyst")


@query("prj_22_erasure", "table_name:s n:i", """
    SELECT 'silver/encounters' AS table_name, count(*) AS n FROM encounter WHERE cast(patient_bk AS bigint) % 13 <> 0
    UNION ALL SELECT 'bronze/encounters', count(*) FROM encounter WHERE cast(patient_bk AS bigint) % 13 <> 0
    UNION ALL SELECT 'quarantine/encounters', count(*) FROM encounter WHERE cast(patient_bk AS bigint) % 13 <> 0 AND reason_code IS NULL
    UNION ALL SELECT 'gold/encounters', count(*) FROM encounter WHERE cast(patient_bk AS bigint) % 13 <> 0
    UNION ALL SELECT 'silver/patients', count(*) FROM patient WHERE cast(patient_bk AS bigint) % 13 <> 0""")
def erasure(b: Bindings):
    """Some patients removed from every layer, from tables of several layouts and keys."""
    lake, month = store(b), "start_year_month"
    lake.append(b.raw_encounters().withColumn("_ingest_date", F.trunc("START", "YEAR")), "bronze/encounters", ["_ingest_date"])
    checked = dq.split(b.encounters(), F.col("reason_code") >= "A", "reason_present", LOAD_TS)
    dq.write_quarantine(checked, lake, "quarantine/encounters")
    lake.overwrite(b.patients(), "silver/patients")
    lake.append(b.encounters(), "silver/encounters", [month])
    gold = b.fact_encounter().withColumn(dates.MONTH, dates.month_of("start_date_sk"))
    lake.append(gold, "gold/encounters", [dates.MONTH])
    gone = b.patients().where(F.col("patient_bk").cast("bigint") % 13 == 0).select("patient_bk", hash_sk("patient_bk").alias("patient_sk"))
    governance.erase_everywhere(lake, {
        "bronze/encounters": governance.Held("PATIENT", "patient_bk", ("_ingest_date",)),
        "quarantine/encounters": governance.Held("patient_bk", "patient_bk", (dq.RUN, dq.RULE)),
        "silver/patients": governance.Held("patient_bk", "patient_bk"),
        "silver/encounters": governance.Held("patient_bk", "patient_bk", (month,)),
        "gold/encounters": governance.Held("patient_sk", "patient_sk", (dates.MONTH,))}, gone)
    names = ("bronze/encounters", "quarantine/encounters", "silver/patients", "silver/encounters", "gold/encounters")
    return monitor.row_counts({name: lake.read(name) for name in names})


@query("prj_23_suppression", "governorate:s age_band:s gender:s n:i deceased:i", """
    SELECT governorate, age_band, gender, CASE WHEN n >= 5 THEN n END AS n,
        CASE WHEN n >= 5 THEN deceased END AS deceased
    FROM (SELECT governorate, age_band, gender, count(*) AS n,
        count(*) FILTER (is_deceased) AS deceased FROM patient GROUP BY 1, 2, 3) AS x""")
def suppression(b: Bindings):
    cells = b.patients().groupBy("governorate", "age_band", "gender").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("is_deceased"), 1)).alias("deceased"))
    return governance.suppress(cells, "n", ["deceased"])


@query("prj_24_fx", "claim_bk:s billed_local:d", """
    SELECT claim_bk, cast(billed_amount * CASE WHEN service_date >= date '2000-01-01'
            THEN cast(3.6 AS decimal(6,2)) WHEN service_date >= date '1997-01-01'
            THEN cast(3.4 AS decimal(6,2)) ELSE cast(3.1 AS decimal(6,2)) END AS decimal(14,2))
        AS billed_local FROM claim""")
def fx(b: Bindings):
    """Amounts at the rate in force on the service date."""
    rates = b.spark.createDataFrame(
        [("EGP", "3.10", date(1990, 1, 1)), ("EGP", "3.40", date(1997, 1, 1)),
         ("EGP", "3.60", date(2000, 1, 1))], "currency string, rate string, valid_from date",
    ).withColumn("rate", F.col("rate").cast("decimal(6,2)"))
    return clinical.convert_fx(b.claims(), rates, "billed_amount", "billed_local")


@query("prj_25_standard_drug", "rxnorm_code:s description:s n:i", """
    SELECT rxnorm_code, coalesce(p_name, description) AS description, count(*) AS n
    FROM medication LEFT JOIN part ON cast(p_partkey AS varchar) = rxnorm_code AND p_partkey % 2 = 0
    GROUP BY 1, 2""")
def standard_drug(b: Bindings):
    return dims.standard_drug(b.medications(), b.drug_reference()) \
        .groupBy("rxnorm_code", "description").agg(F.count(F.lit(1)).alias("n"))
