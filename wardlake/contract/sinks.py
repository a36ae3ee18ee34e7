"""Registered queries: table sinks. Each returns the table as it reads afterwards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from wardlake.bindings import ASOF, LOAD_TS, VITALS_ASOF, Bindings
from wardlake.contract.registry import query
from wardlake.contract.sources import store
from wardlake.contract.sqlbind import avg2, dsk
from wardlake.operators import audit, dq, governance, rules, silver
from wardlake.plans import kpi, nightly

DAILY_COLS = ("date_sk:i hospital_sk:i encounter_class:s encounter_count:i inpatient_count:i "
              "emergency_count:i readmission_30d_count:i avg_length_of_stay:d "
              "total_revenue_usd:d total_payer_coverage_usd:d")


def daily_sql(where: str = "true") -> str:
    return f"""
    SELECT start_date_sk AS date_sk, hospital_sk, encounter_class, count(*) AS encounter_count,
        count(*) FILTER (is_inpatient) AS inpatient_count,
        count(*) FILTER (is_emergency) AS emergency_count,
        count(*) FILTER (is_readmission_30d) AS readmission_30d_count,
        {avg2('cast(length_of_stay_hours AS decimal(10,2))')} AS avg_length_of_stay,
        sum(total_cost_usd) AS total_revenue_usd, sum(payer_coverage_usd) AS total_payer_coverage_usd
    FROM fact_encounter WHERE {where} GROUP BY 1, 2, 3"""


@query("snk_01_append_by_day", "day:s n:i", """
    SELECT cast(cast(o_orderdate AS date) AS varchar) AS day, 2 * count(*) AS n FROM orders GROUP BY 1""")
def append_by_day(b: Bindings):
    """The same rows appended twice, partitioned by month."""
    lake, rows = store(b), b.table("orders").withColumn("_month", F.date_format("o_orderdate", "yyyy-MM"))
    lake.append(rows, "orders", ["_month"])
    lake.append(rows, "orders", ["_month"])
    return lake.read("orders").groupBy(F.col("o_orderdate").cast("date").alias("day")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("snk_02_overwrite", "c_custkey:i c_name:s", """
    SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0""")
def overwrite(b: Bindings):
    """A full replacement computed from the table's own previous version."""
    lake = store(b)
    lake.overwrite(b.table("customer"), "customer", ["c_mktsegment"])
    lake.overwrite(lake.read("customer").where("c_acctbal < 0"), "customer", ["c_mktsegment"])
    return lake.read("customer")


@query("snk_03_month_partitions", "service_year_month:s n:i billed:d", """
    SELECT service_year_month, count(*) AS n, sum(billed_amount) AS billed FROM claim GROUP BY 1""")
def month_partitions(b: Bindings):
    lake = store(b)
    lake.overwrite(b.claims().drop("line_items"), "fact_claim",
                   ["service_year_month"])
    return lake.read("fact_claim").groupBy("service_year_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("billed_amount").alias("billed"))


def faulty_encounters(b: Bindings):
    """Encounters with faults placed by key arithmetic."""
    k = F.col("encounter_bk").cast("bigint")
    df = silver.derive_encounter(silver.conform_encounter(b.raw_encounters()))
    return df.withColumns({
        "patient_bk": F.when(k % 101 != 0, F.col("patient_bk")),
        "start_at": F.when(k % 97 != 0, F.col("start_at")),
        "end_at": F.when(k % 89 == 0, F.timestamp_add("DAY", F.lit(-30), F.col("start_at")))
        .otherwise(F.col("end_at")),
        "total_cost_usd": F.when(k % 83 == 0, -F.col("total_cost_usd")).otherwise(F.col("total_cost_usd")),
    })


FAULT_RULE = """CASE WHEN k % 101 = 0 THEN 'patient_id_present' WHEN k % 97 = 0 THEN 'start_at_present'
    WHEN k % 89 = 0 THEN 'end_after_start' WHEN k % 83 = 0 AND total_cost_usd > 0
    THEN 'non_negative_cost' END"""


@query("snk_04_quarantine", "encounter_bk:s rejected_rule:s quarantine_date:s", f"""
    SELECT encounter_bk, {FAULT_RULE} AS rejected_rule, '2001-08-01' AS quarantine_date
    FROM encounter WHERE {FAULT_RULE} IS NOT NULL""")
def quarantine(b: Bindings):
    """Rejects of the encounter rules, by date and rule; an empty reject set adds nothing."""
    lake = store(b)
    checked = dq.apply(faulty_encounters(b), rules.encounter(), LOAD_TS)
    dq.write_quarantine(checked, lake, "fact_encounter")
    dq.write_quarantine(dq.apply(checked.clean, rules.encounter(), LOAD_TS), lake, "fact_encounter")
    return lake.read("fact_encounter").select(
        "encounter_bk", F.col(dq.RULE).alias("rejected_rule"),
        F.col("_quarantine_date").alias("quarantine_date"))


@query("snk_07_full_refresh", "payer_sk:i payer_name:s is_government:b is_active:b",
       "SELECT * FROM payer")
def full_refresh(b: Bindings):
    """Type-1 target replaced as a whole, twice."""
    lake = store(b)
    for _ in range(2):
        lake.overwrite(b.dim_payer, "dim_payer")
    return lake.read("dim_payer")


@query("snk_08_range_refresh", DAILY_COLS, daily_sql("""(start_date_sk BETWEEN 19990101 AND 19991231
    AND NOT start_date_sk BETWEEN 19990305 AND 19990310)"""))
def range_refresh(b: Bindings):
    """A year of the daily cube, then a refresh of some days that lost all their rows."""
    lake, fact = store(b), b.fact_encounter(readmission=True)
    year = date(1999, 1, 1), date(1999, 12, 31)
    kpi.refresh_daily(lake, fact, *year, refreshed_at=LOAD_TS)
    kpi.refresh_daily(lake, fact.where("start_date_sk not between 19990305 and 19990310"),
                      date(1999, 3, 1), date(1999, 3, 31), refreshed_at=LOAD_TS)
    return lake.read("kpi_daily_hospital")


@query("snk_09_tail_mirror", "device_id:s bed_number:s minute_start_utc:s sample_count:i", """
    SELECT device_id, bed_number, minute_start_utc,
        sample_count + CASE WHEN minute_start_utc >= timestamp '2024-01-30 22:00:00' THEN 10 ELSE 0 END
            AS sample_count
    FROM minute_fact""")
def tail_mirror(b: Bindings):
    """The last two hours come from a changed source, everything older stays."""
    lake, minutes = store(b), b.fact_minutes()
    lake.replace_range(minutes, "fact_vitals", "date_sk", 20240101, 20240131)
    source = lake.read("fact_vitals").withColumn("sample_count", F.col("sample_count") + 10)
    lake.replace_tail(source, "fact_vitals", "minute_start_utc", "date_sk", VITALS_ASOF, hours=2)
    return lake.read("fact_vitals")


@query("snk_10_insert_missing", "icd10_code:s description:s", """
    SELECT icd10_code, CASE WHEN icd10_code < 'M' THEN 'seeded' ELSE description END AS description
    FROM diagnosis""")
def insert_missing(b: Bindings):
    """Reference rows that are already there keep their values."""
    lake, codes = store(b), b.dim_diagnosis.select("icd10_code", "description")
    lake.insert_missing(codes.where("icd10_code < 'M'").withColumn("description", F.lit("seeded")),
                        "icd10", ["icd10_code"])
    lake.insert_missing(codes, "icd10", ["icd10_code"])
    return lake.read("icd10")


@query("snk_11_load_audit", "object_name:s rule:s rows_read:i rows_written:i rows_rejected:i status:s",
       f"""
    SELECT 'fact_encounter' AS object_name, cast(NULL AS varchar) AS rule, count(*) AS rows_read,
        count(*) FILTER ({FAULT_RULE} IS NULL) AS rows_written,
        count(*) FILTER ({FAULT_RULE} IS NOT NULL) AS rows_rejected, 'success' AS status FROM encounter
    UNION ALL SELECT 'fact_encounter', r.rule, count(*), NULL,
        count(*) FILTER (x.rule = r.rule), 'success'
    FROM (SELECT {FAULT_RULE} AS rule FROM encounter) AS x
    CROSS JOIN (VALUES ('encounter_id_present'), ('patient_id_present'), ('start_at_present'),
        ('end_after_start'), ('non_negative_cost')) AS r(rule) GROUP BY r.rule""")
def load_audit(b: Bindings):
    """Counts observed while clean rows and rejects are written."""
    lake = store(b)
    checked = dq.apply(faulty_encounters(b), rules.encounter(), LOAD_TS)
    audit.observed_silver(lake, checked, lambda clean: clean, "fact_encounter")
    return lake.read(audit.TABLE)


@query("snk_12_backfill", DAILY_COLS, daily_sql("start_date_sk BETWEEN 20000201 AND 20000331"))
def backfill(b: Bindings):
    """A table that lacks March and has wrong costs in February; both are re-processed, February twice."""
    lake, target = store(b), nightly.ENCOUNTERS
    lake.overwrite(b.dim_hospital, "dim_hospital")
    raw = b.raw_encounters().withColumn("_ingest_ts", F.lit(LOAD_TS))
    cfg = nightly.Config(b.spark, lake, ASOF, LOAD_TS, {"synthea_encounters": raw}, method="md5")
    wrong = target.shape(cfg, raw).where("start_year_month <> '2000-03'").withColumn(
        "total_cost_usd", F.when(F.col("start_year_month") == "2000-02", F.lit(1).cast(silver.MONEY)).otherwise(F.col("total_cost_usd")))
    lake.replace_partitions(silver.flag_readmission(wrong), target.name, target.part)
    nightly.backfill(cfg, date(2000, 2, 1), date(2000, 2, 29))
    nightly.backfill(cfg, date(2000, 2, 1), date(2000, 3, 31))
    # later months, whose flags follow from March, are refreshed too
    return lake.read("kpi_daily_hospital").where(F.col("date_sk").between(20000201, 20000331))


@query("snk_13_retention", "source:s n:i", f"""
    SELECT 'vitals_hot' AS source, count(*) AS n FROM minute_fact WHERE date_sk >= 20240101
    UNION ALL SELECT 'claims', count(*) FROM claim
        WHERE {dsk('service_date')} >= {dsk("date '2001-08-01' - interval 1825 day")}
    UNION ALL SELECT 'purged', count(*) FROM minute_fact WHERE date_sk >= 20240115""")
def retention(b: Bindings):
    """Rows inside their retention period, and partitions dropped without a read."""
    lake, minutes = store(b), b.fact_minutes()
    lake.replace_range(minutes, "vitals", "date_sk", 20240101, 20240131)
    lake.purge("vitals", "date_sk", date(2024, 1, 15))
    hot = governance.retain(minutes, "date_sk", "vitals_hot", date(2024, 1, 31))
    claims = governance.retain(b.fact_claim(), "service_date_sk", "claims", ASOF)
    out = None
    for label, df in [("vitals_hot", hot), ("claims", claims), ("purged", lake.read("vitals"))]:
        one = df.agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit(label))
        out = one if out is None else out.unionByName(one)
    return out


