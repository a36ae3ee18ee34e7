"""Further analyses: visit gaps, segments, rankings, trends, cohorts, co-occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlake.functions import clinical
from wardlake.functions import measures as m
from wardlake.functions.ordering import neighbours, percentiles, rank_table, running_total, tile_summary


def visit_gaps(enc: DataFrame, days: int = 30) -> DataFrame:
    """Previous and next visit of the patient over all classes, and the gap in days."""
    out = neighbours(enc, "patient_bk", "start_at", "encounter_bk", F.col("start_at"),
                     "previous_start", "next_start")
    gap = F.datediff("start_at", "previous_start")
    return out.withColumn("days_since_last_visit", gap) \
        .withColumn("is_return", F.coalesce(gap <= days, F.lit(False)))


def return_rate(enc: DataFrame, days: int = 30) -> DataFrame:
    """Share of repeat visits within ``days`` of the visit before."""
    seen = neighbours(enc, "patient_bk", "start_at", "encounter_bk", F.col("start_at"), "prev")
    repeat = seen.where(F.col("prev").isNotNull())
    back = m.count_where(F.datediff("start_at", "prev") <= days)
    return repeat.agg(F.count(F.lit(1)).alias("total_encounters"), back.alias("readmissions"),
                      m.ratio(back, F.count(F.lit(1))).alias("readmission_rate"))


def cost_segments(enc: DataFrame, tiles: int = 4) -> DataFrame:
    """Patients cut into equal segments by total cost, with the segment's spread."""
    per = enc.groupBy("patient_bk").agg(
        F.coalesce(F.sum("total_cost_usd"), F.lit(0)).cast("decimal(14,2)").alias("total_cost"))
    return tile_summary(per, "total_cost", tiles, {"median_cost": 0.5}, "segment").select(
        "segment", F.col("n").alias("patients"), F.col("low").alias("min_cost"), F.col("high").alias("max_cost"),
        F.col("sum").cast("decimal(24,2)").alias("segment_cost"), "median_cost").orderBy("segment")


def provider_rank(enc: DataFrame, providers: DataFrame) -> DataFrame:
    """Providers ranked by mean encounter cost within their specialty.

    Ranks come from counted values, so a specialty of any size is never sorted in
    one task.
    """
    cost = enc.where(F.col("total_cost_usd").isNotNull()).groupBy("provider_bk").agg(
        F.count(F.lit(1)).alias("encounters"),
        m.mean("total_cost_usd", "decimal(12,2)").alias("avg_cost"))
    rows = cost.join(providers.select("provider_bk", "full_name", "specialty"), "provider_bk")
    table = rank_table(rows, ["specialty"], ["avg_cost"], descending=True).select(
        F.col("specialty").alias("_s"), F.col("avg_cost").alias("_c"), "n_before", "d_before")
    mean = rows.groupBy(F.col("specialty").alias("_s3")).agg(
        m.mean("avg_cost", "decimal(12,2)").alias("specialty_avg"))
    return (
        rows.join(table, (F.col("specialty") == F.col("_s")) & (F.col("avg_cost") == F.col("_c")))
        .join(mean, F.col("specialty") == F.col("_s3"))
        .select("provider_bk", "full_name", "specialty", "encounters", "avg_cost",
                (F.col("n_before") + 1).alias("cost_rank"),
                (F.col("d_before") + 1).alias("cost_dense_rank"), "specialty_avg")
    )


def monthly_trend(enc: DataFrame) -> DataFrame:
    """Encounters per month with change against the month before and the running total."""
    per = enc.groupBy(F.trunc(F.col("start_at").cast("date"), "MONTH").alias("month")) \
        .agg(F.count(F.lit(1)).alias("encounters"))
    order = Window.orderBy("month")
    return per.withColumns({
        "previous": F.lag("encounters").over(order),
        "change": F.col("encounters") - F.lag("encounters").over(order),
        "running_total": F.sum("encounters").over(
            order.rowsBetween(Window.unboundedPreceding, 0)),
    }).orderBy("month")


def pareto(prescriptions: DataFrame) -> DataFrame:
    """Drugs by spend with their cumulative percent of all spend."""
    spend = prescriptions.where(F.col("total_cost_usd").isNotNull()) \
        .groupBy("rxnorm_code").agg(m.money("total_cost_usd").alias("spend"))
    table = rank_table(spend, [], ["spend"], descending=True) \
        .select(F.col("spend").alias("_c"), (F.col("n_before") + 1).alias("spend_rank"))
    ran = running_total(spend, "spend", "rxnorm_code")
    return ran.join(table, F.col("spend") == F.col("_c")).select(
        "rxnorm_code", "spend", "spend_rank",
        m.pct(F.col("running"), F.col("grand_total")).alias("cumulative_pct"))


def cohort_retention(enc: DataFrame) -> DataFrame:
    """Patients of each first-visit month seen again k months later.

    Visits collapse to one row per patient and month before the window, so a busy
    patient costs at most one row per calendar month.
    """
    month = F.trunc(F.col("start_at").cast("date"), "MONTH")
    active = enc.select("patient_bk", month.alias("m")).distinct()
    first = F.min("m").over(Window.partitionBy("patient_bk"))
    return (
        active.withColumn("cohort_month", first)
        .groupBy("cohort_month", F.months_between("m", "cohort_month").cast("int")
                 .alias("months_later"))
        .agg(F.count(F.lit(1)).alias("patients"))
    )


def cohort_matrix(retention: DataFrame, horizon: int) -> DataFrame:
    """The retention table turned to one column per month offset."""
    wide = pivot_counts(retention, ["cohort_month"], "months_later", list(range(horizon + 1)),
                        "patients")
    return wide.select("cohort_month", *[F.col(str(k)).alias(f"m{k}") for k in range(horizon + 1)])


def pivot_counts(df: DataFrame, rows: list[str], col: str, values: list,
                 amount: str | None = None) -> DataFrame:
    """Counts (or sums) of listed column values side by side; missing cells are 0."""
    cell = F.sum(amount) if amount else F.count(F.lit(1))
    wide = df.groupBy(*rows).pivot(col, values).agg(cell)
    return wide.na.fill(0)


def co_occurrence(bridge: DataFrame, codes: list[str]) -> DataFrame:
    """Number of patients who have both codes, for every pair of the listed codes.

    ``bridge`` has patient_bk and icd10_code. A patient holds at most the listed
    codes, and patients with the same set are counted before the set is paired, so
    no group of rows is ever multiplied with itself.
    """
    sets = (
        bridge.where(F.col("icd10_code").isin(codes)).select("patient_bk", "icd10_code").distinct()
        .groupBy("patient_bk").agg(F.sort_array(F.collect_set("icd10_code")).alias("codes"))
        .groupBy("codes").agg(F.count(F.lit(1)).alias("w"))
        .where(F.size("codes") > 1)
    )
    first = sets.select("codes", "w", F.posexplode("codes").alias("i", "code_a"))
    rest = F.slice("codes", F.col("i") + 2, F.size("codes"))
    return (
        first.select("code_a", "w", F.explode(rest).alias("code_b"))
        .groupBy("code_a", "code_b").agg(F.sum("w").alias("patients"))
    )


def co_occurrence_matrix(pairs: DataFrame, codes: list[str]) -> DataFrame:
    """The pair counts as a matrix with one column per second code."""
    return pivot_counts(pairs, ["code_a"], "code_b", codes, "patients")


def denial_sets(claims: DataFrame) -> DataFrame:
    """Denial rate by payer and service month, by payer, by month and overall."""
    payer, month = F.col("carrier"), F.col("service_year_month")
    denied = m.count_where(F.col("is_denied"))
    return claims.groupingSets([[payer, month], [payer], [month], []], payer, month).agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        F.count(F.lit(1)).alias("claims"), denied.alias("denied"),
        m.pct(denied, F.count(F.lit(1))).alias("denial_pct")).where(F.col("claims") > 0)


def anomaly_times(events: DataFrame) -> DataFrame:
    """Anomalous readings by hour of day and ward shift."""
    hour = F.hour("event_ts")
    return (
        events.where(F.col("derived_anomaly"))
        .groupBy(hour.alias("hour_of_day"), clinical.shift_of(hour).alias("shift"))
        .agg(F.count(F.lit(1)).alias("anomalies"),
             F.count_distinct("device_id").alias("devices"))
    )


def los_outliers(enc: DataFrame, group: str) -> DataFrame:
    """Median stay per group and the share of stays above the upper quartile fence."""
    los = "length_of_stay_hours"
    stays = enc.where(F.col("is_inpatient") & F.col(los).isNotNull() & F.col(group).isNotNull()) \
        .select(group, los)
    q = percentiles(stays, [group], los, {"q1": 0.25, "median_los": 0.5, "q3": 0.75}).select(
        F.col(group).alias("_g"), "median_los",
        (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("fence"))
    counted = stays.groupBy(group, los).agg(F.count(F.lit(1)).alias("n"))
    outside = F.sum(F.when(F.col(los).cast("double") > F.col("fence"), F.col("n")).otherwise(0))
    return (
        counted.join(q, F.col(group) == F.col("_g"))
        .groupBy(group, "median_los")
        .agg(F.sum("n").alias("stays"), outside.alias("outliers"),
             m.pct(outside, F.sum("n")).alias("outlier_pct"))
    )
