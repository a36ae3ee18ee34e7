"""The given TPC-H-like tables read as the feeds of a hospital network.

| domain | table | rule |
| --- | --- | --- |
| facility | nation, region | one per nation; clinic from key 5 |
| patient | customer | birth date, gender and state from the key |
| provider | supplier | NPI from the key |
| encounter | orders | class from the priority, stay from the key |
| claim, condition, medication, procedure | lineitem | codes from part and supplier keys |
| vitals | events | readings from the value |

All rules are column expressions; nothing is generated.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake import session
from wardlake.operators import dims, facts, scd, silver
from wardlake.plans import views
from wardlake.schemas import PAYERS
from wardlake.sources import streams
from wardlake.streaming import vitals

ASOF = date(2001, 8, 1)
VITALS_ASOF = datetime(2024, 1, 31)
LOAD_TS = datetime(2001, 8, 1)
FIRST_VALID = datetime(1900, 1, 1)
CALENDAR = (date(1990, 1, 1), date(2005, 12, 31))
CHRONIC = [f"{letter}{n:02d}" for letter in "EI" for n in range(100)]
DEC = "decimal(12,2)"


def diagnosis_code(key: Column) -> Column:
    """Letter and two digits from a part key; all 26 letters occur."""
    letter = F.char(F.lit(65) + F.pmod(key, F.lit(26)))
    return F.concat(letter, F.lpad(F.pmod(key, F.lit(100)).cast("string"), 2, "0"))


def npi(key: Column) -> Column:
    return F.lpad((key + 1).cast("string"), 10, "0")


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def _plus_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours.cast("int"), ts)


class Bindings:
    def __init__(self, spark: SparkSession, sf_dir: str):
        session.use_utc(spark)
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table, read as it lies."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._tables[name]

    # --- feeds -----------------------------------------------------------------

    def facility_seed(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_name").alias("hospital_code"),
            F.concat(F.lit("Facility "), k.cast("string")).alias("hospital_name"),
            F.col("n_name").alias("city"), F.col("r_name").alias("governorate"),
            F.when(k >= 5, F.lit("0")).otherwise((F.lit(100) + k * 20).cast("string"))
            .alias("bed_count"),
            F.when(k >= 5, F.lit("1")).otherwise(F.lit("0")).alias("is_clinic"),
            F.concat((F.lit(22) + F.pmod(k, F.lit(9))).cast("string"), F.lit(".5")).alias("lat"),
            F.concat((F.lit(25) + F.pmod(k, F.lit(11))).cast("string"), F.lit(".25")).alias("lon"))

    def raw_patients(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            k.cast("string").alias("Id"),
            F.date_sub(F.lit(date(2001, 1, 1)), F.pmod(k * 37, F.lit(33000)).cast("int"))
            .cast("string").alias("BIRTHDATE"),
            F.when(k % 29 == 0, F.lit("2000-06-01")).alias("DEATHDATE"),
            F.concat(F.lit("F"), (k % 100).cast("string")).alias("FIRST"),
            F.col("c_name").alias("LAST"), F.col("c_mktsegment").alias("MARITAL"),
            F.concat(F.lit("R"), (k % 4).cast("string")).alias("RACE"),
            F.concat(F.lit("E"), (k % 2).cast("string")).alias("ETHNICITY"),
            F.when(k % 3 == 0, F.lit("m")).when(k % 3 == 1, F.lit("Female")).alias("GENDER"),
            F.concat(F.lit("Street "), k.cast("string")).alias("ADDRESS"),
            F.lit("CITY").alias("CITY"),
            F.concat(F.lit("NATION_"), _text("c_nationkey")).alias("STATE"),
            F.lpad((k % 100000).cast("string"), 5, "0").alias("ZIP"))

    def raw_providers(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.table("supplier").select(
            npi(k).alias("npi"), F.lit("Doc").alias("first_name"), F.col("s_name").alias("last_name"),
            F.when(k % 2 == 0, F.lit("MD")).otherwise(F.lit("DO")).alias("credential"),
            F.concat(F.lit("SPEC_"), (k % 8).cast("string")).alias("specialty"),
            F.concat(F.lit("NATION_"), _text("s_nationkey")).alias("primary_facility_code"),
            F.concat(F.lit("LIC-"), k.cast("string")).alias("license_number"),
            F.date_add(F.lit(date(2002, 1, 1)), (k % 700).cast("int")).cast("string")
            .alias("license_expiry"),
            F.date_add(F.lit(date(1990, 1, 1)), (k % 2000).cast("int")).cast("string")
            .alias("hire_date"),
            (F.col("s_acctbal") >= 0).alias("is_active"),
            F.lit("555").alias("phone"), F.lit("doc@example.org").alias("email"))

    def raw_encounters(self, provider: bool = False) -> DataFrame:
        """``provider`` joins the smallest supplier of the order's lines."""
        src = self.table("orders")
        npi_col = F.lit(None).cast("string")
        if provider:
            first = self.table("lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("sk"))
            src = src.join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            npi_col = npi(F.col("sk"))
        k, rank = F.col("o_orderkey"), F.substring("o_orderpriority", 1, 1)
        start = _plus_hours(F.col("o_orderdate").cast("timestamp"), k % 24)
        total = F.col("o_totalprice").cast(DEC)
        return src.select(
            k.cast("string").alias("Id"), _text("o_custkey").alias("PATIENT"),
            npi_col.alias("PROVIDER"),
            F.concat(F.lit("ORG-"), (k % 97).cast("string")).alias("ORGANIZATION"),
            F.when(rank == "1", F.lit("EMERGENCY")).when(rank == "2", F.lit("inpatient"))
            .when(rank == "3", F.lit("snf")).when(rank == "4", F.lit("outpatient"))
            .otherwise(F.lit("wellness")).alias("ENCOUNTERCLASS"),
            F.col("o_orderpriority").alias("DESCRIPTION"), start.alias("START"),
            F.when(k % 41 != 0, _plus_hours(start, (k % 7) * 24 + k % 24)).alias("STOP"),
            (total * F.lit(0.25).cast("decimal(4,2)")).cast(DEC).alias("BASE_ENCOUNTER_COST"),
            total.alias("TOTAL_CLAIM_COST"),
            (total * F.lit(0.8).cast("decimal(4,2)")).cast(DEC).alias("PAYER_COVERAGE"),
            F.when(k % 5 > 1, diagnosis_code(k)).alias("REASONCODE"),
            F.lit(None).cast("string").alias("REASONDESCRIPTION"))

    def raw_claims(self, extra: list[str] | None = None) -> DataFrame:
        """One claim per line; every ninth part points at an encounter that does not exist.

        ``extra`` names table columns to carry along.
        """
        ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
        ln = F.col("l_linenumber")
        billed = F.col("l_extendedprice").cast(DEC)
        left = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
        flag, line = F.col("l_returnflag"), F.col("l_linestatus")
        status = (
            F.when(flag == "R", F.lit("denied"))
            .when((flag == "A") & (line == "F"), F.lit("approved"))
            .when(flag == "A", F.lit("partially_paid"))
            .when(line == "F", F.lit("submitted")).otherwise(F.lit("pending_review")))
        allowed = (
            F.when(status == "approved", (billed * left).cast(DEC))
            .when(status == "partially_paid", (billed * F.lit(0.5).cast("decimal(4,2)")).cast(DEC))
            .otherwise(F.lit(0).cast(DEC)))
        payers = list(PAYERS)
        carrier = F.when(pk % 53 != 0, F.get(F.array(*[F.lit(p) for p in payers]),
                                             F.pmod(pk, F.lit(len(payers))).cast("int")))
        service = F.col("l_shipdate").cast("date")
        submitted = F.date_add(service, ln)
        closed = ~status.isin("submitted", "pending_review")
        code = diagnosis_code(pk)
        identity = F.md5(F.concat_ws(
            "|", ok, pk, sk, ln, F.col("l_quantity").cast(DEC), billed,
            F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)"),
            flag, line, service))
        item = F.transform(
            F.sequence(F.lit(1), F.lit(1) + F.pmod(ln, F.lit(4))),
            lambda i: F.struct(
                (F.lit(99000) + F.pmod(sk + i, F.lit(100))).cast("string").alias("cpt_code"),
                F.concat(F.lit("Procedure "), i.cast("string")).alias("description"),
                (billed * F.lit(0.25).cast("decimal(4,2)")).cast(DEC).alias("billed_amount"),
                i.cast("int").alias("units")))
        return self.table("lineitem").select(
            identity.alias("claim_id"),
            F.concat(F.lit("CLM-"), ok, F.lit("-"), ln).alias("claim_number"),
            F.floor(ok / 10).cast("string").alias("patient_id"),
            F.when(pk % 9 == 4, F.concat(F.lit("X"), ok)).otherwise(ok.cast("string"))
            .alias("encounter_id"),
            npi(sk).alias("provider_npi"),
            F.concat(F.lit("NATION_"), (ok % 25).cast("string")).alias("hospital_code"),
            carrier.alias("carrier"), F.concat(F.lit("POL-"), ok).alias("policy_number"),
            service.alias("service_date"), submitted.alias("submission_date"),
            F.when(closed, F.date_add(submitted, 14)).alias("decision_date"),
            status.alias("status"),
            F.when(status == "denied", F.concat(F.lit("REASON_"), (sk % 5).cast("string")))
            .alias("denial_reason"),
            code.alias("primary_diagnosis_code"),
            F.when(pk % 7 != 0, F.concat(F.lit("Condition "), code))
            .alias("primary_diagnosis_description"),
            billed.alias("billed_amount"), allowed.alias("allowed_amount"),
            allowed.alias("paid_amount"), (billed - allowed).cast(DEC).alias("patient_responsibility"),
            F.lit("EGP").alias("currency"), item.alias("line_items"),
            *(extra or []))

    def _line_feed(self) -> list[Column]:
        ok = F.col("l_orderkey")
        return [ok.cast("string").alias("ENCOUNTER"), F.floor(ok / 10).cast("string").alias("PATIENT")]

    def raw_conditions(self) -> DataFrame:
        code = diagnosis_code(F.col("l_partkey"))
        return self.table("lineitem").select(
            *self._line_feed(), code.alias("CODE"),
            F.when(F.col("l_partkey") % 7 != 0, F.concat(F.lit("Condition "), code))
            .alias("DESCRIPTION"),
            F.col("l_shipdate").cast("date").alias("START"), F.lit(None).cast("date").alias("STOP"))

    def raw_medications(self) -> DataFrame:
        pk, ship = F.col("l_partkey"), F.col("l_shipdate").cast("date")
        qty = F.col("l_quantity").cast("int")
        return self.table("lineitem").select(
            *self._line_feed(), pk.cast("string").alias("CODE"),
            F.concat(F.lit("Drug "), pk).alias("DESCRIPTION"), ship.alias("START"),
            F.when(F.col("l_linenumber") != 7, F.date_add(ship, qty)).alias("STOP"),
            F.when(qty > 1, qty).alias("DISPENSES"),
            F.when(pk % 61 != 0, F.col("l_extendedprice").cast(DEC)).alias("TOTALCOST"))

    def raw_procedures(self) -> DataFrame:
        sk = F.col("l_suppkey")
        return self.table("lineitem").select(
            *self._line_feed(), (F.lit(99000) + F.pmod(sk, F.lit(100))).cast("string").alias("CODE"),
            F.concat(F.lit("Procedure "), F.pmod(sk, F.lit(100)).cast("string")).alias("DESCRIPTION"),
            F.col("l_shipdate").cast("timestamp").alias("START"),
            F.col("l_quantity").cast("decimal(10,2)").alias("BASE_COST"))

    def drug_reference(self) -> DataFrame:
        """Even part keys have a reference name."""
        return self.table("part").where(F.col("p_partkey") % 2 == 0).select(
            _text("p_partkey").alias("rxnorm_code"), F.col("p_name").alias("description"))

    # --- vitals ----------------------------------------------------------------

    @staticmethod
    def as_vitals(events: DataFrame) -> DataFrame:
        """Events as typed readings; ``ts`` becomes a zoned timestamp."""
        cents = F.round(F.col("value") * 100).cast("bigint")
        user = F.col("user_id")

        def reading(base: int, span: int) -> Column:
            return (F.lit(base) + F.pmod(cents, F.lit(span))) / F.lit(100.0)

        ts = F.col("ts").cast("timestamp")
        return events.select(
            _text("event_id").alias("event_id"), ts.alias("event_ts"),
            F.concat(F.lit("DEV-"), user).alias("device_id"), user.cast("string").alias("patient_id"),
            F.concat(F.lit("NATION_"), (user % 26).cast("string")).alias("hospital_code"),
            F.concat(F.lit("B"), (F.col("event_id") % 3).cast("string")).alias("bed_number"),
            reading(4000, 11000).alias("heart_rate_bpm"),
            F.when(F.col("event_id") % 37 != 0, reading(8500, 1600)).alias("spo2_pct"),
            reading(9000, 11000).alias("systolic_bp"), reading(5000, 4000).alias("diastolic_bp"),
            reading(600, 2400).alias("respiratory_rate"), reading(3600, 400).alias("temperature_c"),
            _text("event_type").alias("event_type"), F.col("props"))

    @staticmethod
    def as_bodies(readings: DataFrame) -> DataFrame:
        """Readings as the JSON text a device would send; arrival is 30 s after the event."""
        iso = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        cols = ["event_id", "device_id", "patient_id", "hospital_code", "bed_number",
                "heart_rate_bpm", "spo2_pct", "systolic_bp", "diastolic_bp", "respiratory_rate",
                "temperature_c"]
        return readings.select(
            F.to_json(F.struct(iso.alias("event_time"), *cols)).alias("body"),
            F.timestamp_add("SECOND", F.lit(30), F.col("event_ts")).alias("arrival_ts"))

    def events(self) -> DataFrame:
        return self.table("events")

    def events_stream(self) -> DataFrame:
        """The events file as a stream (a file source needs its folder)."""
        return streams.read_parquet(self.spark, self.dir, "events.parquet", self.events().schema)

    # --- silver ----------------------------------------------------------------

    def patients(self) -> DataFrame:
        return silver.conform_patient(self.raw_patients(), ASOF)

    def providers(self) -> DataFrame:
        return silver.conform_provider(self.raw_providers())

    def encounters(self, provider: bool = False, readmission: bool = False) -> DataFrame:
        """Order keys are unique, so these feeds need no deduplication."""
        df = silver.derive_encounter(silver.conform_encounter(self.raw_encounters(provider)))
        return silver.flag_readmission(df) if readmission else df

    def claims(self) -> DataFrame:
        return silver.derive_claim(silver.conform_claim(self.raw_claims()))

    def conditions(self) -> DataFrame:
        return silver.conform_condition(self.raw_conditions())

    def medications(self) -> DataFrame:
        return silver.conform_medication(self.raw_medications())

    def procedures(self) -> DataFrame:
        return silver.conform_procedure(self.raw_procedures())

    # --- gold ------------------------------------------------------------------

    @cached_property
    def dim_hospital(self) -> DataFrame:
        return dims.hospital_from_seed(self.facility_seed())

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.calendar(self.spark, *CALENDAR)

    @cached_property
    def dim_patient(self) -> DataFrame:
        return scd.first_load(dims.patient_incoming(self.patients()), scd.PATIENT_ATTRS, FIRST_VALID)

    @cached_property
    def dim_provider(self) -> DataFrame:
        incoming = dims.provider_incoming(self.providers(), self.dim_hospital)
        return scd.first_load(incoming, scd.PROVIDER_ATTRS, FIRST_VALID)

    @cached_property
    def dim_payer(self) -> DataFrame:
        return dims.payer(self.claims())

    @cached_property
    def dim_diagnosis(self) -> DataFrame:
        return dims.diagnosis(self.claims())

    @cached_property
    def dim_drug(self) -> DataFrame:
        return dims.drug(self.medications())

    @cached_property
    def bridge(self) -> DataFrame:
        return facts.bridge_diagnosis(self.conditions())

    def fact_encounter(self, provider: bool = False, readmission: bool = False,
                       diagnosis: bool = False) -> DataFrame:
        return facts.encounter(
            self.encounters(provider, readmission), self.dim_hospital,
            bridge=self.bridge if diagnosis else None, method="md5")

    def fact_claim(self, check: bool = False) -> DataFrame:
        return facts.claim(self.claims(), self.raw_encounters().select(
            F.col("Id").alias("encounter_bk")) if check else None)

    def fact_minutes(self) -> DataFrame:
        minutes = vitals.minute_aggregate(vitals.flag_anomalies(self.as_vitals(self.events())))
        return vitals.fact_minutes(minutes, self.dim_hospital)

    def star(self, *names: str, provider: bool = False, readmission: bool = False,
             diagnosis: bool = False, check: bool = False) -> views.Tables:
        """The named tables only, so a query plans no join it does not read."""
        makers = {
            "fact_encounter": lambda: self.fact_encounter(provider, readmission, diagnosis),
            "fact_claim": lambda: self.fact_claim(check),
            "fact_prescription": lambda: facts.prescription(self.medications()),
            "fact_vital_signs_minute": self.fact_minutes,
            "bridge_encounter_diagnosis": lambda: self.bridge,
        }
        return {n: makers[n]() if n in makers else getattr(self, n) for n in names}
