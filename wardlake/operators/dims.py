"""Dimension builders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions import clinical
from wardlake.functions.keys import UNKNOWN_SK, date_sk, hash_sk
from wardlake.schemas import PAYERS

UNKNOWN_BK = "UNKNOWN"


def hospital_from_seed(seed: DataFrame) -> DataFrame:
    """Facility dimension from the all-text seed file."""
    return seed.select(
        hash_sk("hospital_code").alias("hospital_sk"),
        F.col("hospital_code").alias("hospital_bk"), "hospital_name",
        F.when(F.col("is_clinic") == "1", F.lit("clinic")).otherwise(F.lit("hospital"))
        .alias("facility_type"),
        "city", "governorate", F.col("bed_count").try_cast("int").alias("bed_count"),
        F.lit(True).alias("is_active"),
        F.col("lat").try_cast("decimal(9,6)").alias("lat"),
        F.col("lon").try_cast("decimal(9,6)").alias("lon"))


def with_unknown(dim: DataFrame, sk: str, bk: str) -> DataFrame:
    """The dimension and its member -1, which facts point at whose parent has not arrived; a second one is not added."""
    values = {sk: F.lit(UNKNOWN_SK), bk: F.lit(UNKNOWN_BK)}
    row = dim.sparkSession.range(1).select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema])
    return dim.where(F.col(sk) != UNKNOWN_SK).unionByName(row)


def payer_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PAYERS.items()), "payer_name string, is_government boolean")


def payer(claims: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """Distinct carriers of the claim feed; the government flag comes from the seed.

    The seed is a short reference list, the carrier list is a distinct of it plus
    strays; both are small after the distinct and the join size is left to AQE.
    """
    known = (seed if seed is not None else payer_seed(claims.sparkSession)) \
        .select(F.col("payer_name").alias("_p"), "is_government")
    names = claims.select(F.col("carrier").alias("payer_name")) \
        .where(F.col("payer_name").isNotNull()).distinct()
    return names.join(known, F.col("payer_name") == F.col("_p"), "left").select(
        hash_sk("payer_name").alias("payer_sk"), "payer_name",
        F.coalesce("is_government", F.lit(False)).alias("is_government"),
        F.lit(True).alias("is_active"))


def diagnosis(claims: DataFrame) -> DataFrame:
    """One row per ICD-10 code of the claim feed; the smallest description stands for it."""
    codes = (
        claims.where(F.col("primary_icd10_code").isNotNull())
        .groupBy(F.col("primary_icd10_code").alias("icd10_code"))
        .agg(F.min("primary_diagnosis_description").alias("description"))
    )
    return clinical.icd10_chapter(codes, "icd10_code") \
        .select(hash_sk("icd10_code").alias("diagnosis_sk"), "icd10_code", "description", "chapter")


def drug(medications: DataFrame) -> DataFrame:
    return (
        medications.where(F.col("rxnorm_code").isNotNull())
        .groupBy("rxnorm_code").agg(F.min("description").alias("description"))
        .select(hash_sk("rxnorm_code").alias("drug_sk"), "rxnorm_code", "description")
    )


def procedure(procedures: DataFrame) -> DataFrame:
    return (
        procedures.where(F.col("cpt_code").isNotNull())
        .groupBy("cpt_code")
        .agg(F.min("description").alias("description"),
             F.min("base_cost_usd").alias("base_charge_usd"))
        .select(hash_sk("cpt_code").alias("procedure_sk"), "cpt_code", "description",
                "base_charge_usd")
    )


def standard_drug(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Reference description by RxNorm code where one exists, else the source text."""
    ref = reference.select(F.col("rxnorm_code").alias("_code"), F.col("description").alias("_ref"))
    return (
        df.join(ref, F.col("rxnorm_code") == F.col("_code"), "left")
        .withColumn("description", F.coalesce("_ref", "description"))
        .drop("_code", "_ref")
    )


def patient_incoming(silver: DataFrame) -> DataFrame:
    """Staged patient rows; ``patient_sk`` is the durable key shared by all versions."""
    return silver.select(
        hash_sk("patient_bk").alias("patient_sk"), "patient_bk",
        F.lit(None).cast("string").alias("mrn"), "first_name", "last_name",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        "date_of_birth", "age_band", "gender", "marital_status", "race", "ethnicity",
        "governorate", "city", "is_deceased")


def provider_incoming(silver: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Staged provider rows with the facility key looked up by its code."""
    facility = hospitals.select(F.col("hospital_bk").alias("_hb"),
                                F.col("hospital_sk").alias("primary_facility_sk"))
    return silver.join(facility, F.col("hospital_bk") == F.col("_hb"), "left").select(
        hash_sk("provider_bk").alias("provider_sk"), "provider_bk", "full_name", "credential",
        "specialty", "primary_facility_sk", "license_expiry", "hire_date", "is_active")


def calendar(spark: SparkSession, lo: date = date(1900, 1, 1), hi: date = date(2030, 12, 31),
             holidays: DataFrame | None = None, fiscal_start: int = 7) -> DataFrame:
    """One row per day. Weeks come in both readings: US week and ISO week.

    ``holidays`` has a ``calendar_date`` column. ``fiscal_start`` is the first month
    of the fiscal year.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("interval 1 day"))).alias("calendar_date"))
    d = F.col("calendar_date")
    jan1 = F.trunc(d, "YEAR")
    fiscal_month = F.pmod(F.month(d) - F.lit(fiscal_start), F.lit(12))
    out = days.select(
        date_sk(d).alias("date_sk"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        (F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7) + 1).cast("int").alias("us_week"),
        F.weekofyear(d).alias("iso_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        F.last_day(d).alias("month_end_date"),
        F.trunc(d, "QUARTER").alias("quarter_start_date"),
        (F.floor(fiscal_month / 3) + 1).cast("int").alias("fiscal_quarter"))
    if holidays is None:
        return out.withColumn("is_holiday", F.lit(False))
    days_off = holidays.select(F.col("calendar_date").alias("_h")).distinct()
    return out.join(days_off, d == F.col("_h"), "left") \
        .withColumn("is_holiday", F.col("_h").isNotNull()).drop("_h")


def clock(spark: SparkSession) -> DataFrame:
    """One row per minute of the day with am/pm and ward shift."""
    minute = F.col("id")
    hour = F.floor(minute / 60).cast("int")
    return spark.range(1440).select(
        minute.cast("int").alias("time_sk"), hour.alias("hour"),
        F.pmod(minute, F.lit(60)).cast("int").alias("minute"),
        F.when(hour < 12, F.lit("AM")).otherwise(F.lit("PM")).alias("am_pm"),
        clinical.shift_of(hour).alias("shift"))
