"""Monitors over the audit table, the Bronze stream and metric tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlake.functions import dates
from wardlake.functions import measures as m

# Alert limits.
LIMITS = {"rejection_pct": 1.0, "run_minutes": 90.0, "orphan_pct": 2.0}
VOLUME_FLOOR = 0.5
LAG_SECONDS = 120


def rejection_rate(audit: DataFrame, asof: datetime, days: int = 7) -> DataFrame:
    """Mean rejected share per Silver table and rule over the last days."""
    recent = audit.where((F.col("layer") == "silver") & F.col("rule").isNotNull()
                         & dates.trailing("started_at", days, "day", asof))
    share = F.try_divide(F.col("rows_rejected").cast("double"), F.col("rows_read").cast("double"))
    return recent.groupBy("object_name", "rule").agg(F.avg(share).alias("rejected_share"))


def volume_drop(audit: DataFrame, floor: float = VOLUME_FLOOR) -> DataFrame:
    """Daily Bronze rows against the mean of the seven loaded days before; flagged below half."""
    daily = (
        audit.where(F.col("layer") == "bronze")
        .groupBy("object_name", F.to_date("started_at").alias("day"))
        .agg(F.sum("rows_written").alias("rows_written"))
    )
    week = Window.partitionBy("object_name").orderBy("day").rowsBetween(-7, -1)
    return daily.withColumn("trailing_mean", F.avg("rows_written").over(week)).withColumn(
        "is_drop", F.coalesce(F.col("rows_written") < floor * F.col("trailing_mean"), F.lit(False)))


def _per_run(audit: DataFrame) -> DataFrame:
    """One row per run, from its first start to its last end, whether or not its own row was written; rows without a run are none."""
    loads = (F.col("layer") != "run") & F.col("rule").isNull()
    return audit.where(F.col("run_id").isNotNull()).groupBy("run_id").agg(
        F.max(F.when(F.col("layer") == "run", F.col("object_name"))).alias("run_name"),
        F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"),
        F.coalesce(F.sum(F.when(loads, F.col("rows_written"))), F.lit(0)).alias("rows_written"),
        m.count_where(loads).alias("loads"),
        F.when(F.bool_or(F.col("status") == "failed"), F.lit("failed")).otherwise(F.lit("success")).alias("status"))


def runs(audit: DataFrame, n: int = 50) -> DataFrame:
    """The newest runs with their duration in seconds, rows written over all loads, and whether a load failed."""
    seconds = F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")
    return _per_run(audit).withColumn("duration_s", seconds).orderBy(F.col("started_at").desc(), "run_id").limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One labelled count per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionAll(one)
    return out


def stream_lag(bronze: DataFrame, event_ts: str = "event_ts", arrival: str = "arrival_ts",
               limit_s: int = LAG_SECONDS) -> DataFrame:
    """Largest event-to-arrival delay per arrival minute, flagged above the limit."""
    lag = F.unix_timestamp(arrival) - F.unix_timestamp(event_ts)
    return (
        bronze.groupBy(F.date_trunc("minute", F.col(arrival)).alias("minute"))
        .agg(F.max(lag).alias("max_lag_s"), F.count(F.lit(1)).alias("n"))
        .withColumn("is_late", F.col("max_lag_s") > limit_s)
    )


def batch_lag(progress: DataFrame, limit_s: int = LAG_SECONDS) -> DataFrame:
    """Micro-batches of the progress table with their largest lag, flagged above the limit."""
    return progress.select("query", "run_id", "batch_id", "started_at", "input_rows", "batch_ms", "watermark", "max_lag_s").withColumn(
        "is_late", F.coalesce(F.col("max_lag_s") > limit_s, F.lit(False)))


def limits_table(spark, limits: dict[str, float] | None = None) -> DataFrame:
    return spark.createDataFrame(list((limits or LIMITS).items()), "metric string, limit_value double")


def alerts(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """Metric rows (metric, subject, value) above their limit."""
    return metrics.join(F.broadcast(limits), "metric").where(F.col("value") > F.col("limit_value"))


def audit_metrics(audit: DataFrame) -> DataFrame:
    """Rejection percent per load and rule, and minutes per whole run, in the shape ``alerts`` reads."""
    rejected = audit.where(F.col("rows_read") > 0).select(
        F.lit("rejection_pct").alias("metric"),
        F.concat_ws("/", "object_name", "rule").alias("subject"),
        (F.lit(100.0) * F.col("rows_rejected") / F.col("rows_read")).alias("value"))
    minutes = _per_run(audit).select(
        F.lit("run_minutes").alias("metric"), F.col("run_id").alias("subject"),
        ((F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")) / 60).alias("value"))
    return rejected.unionByName(minutes)


def orphan_metric(claims: DataFrame) -> DataFrame:
    """Share of claims without an encounter, one metric row."""
    share = m.pct(m.count_where(F.col("encounter_sk").isNull()), F.count(F.lit(1)))
    return claims.agg(share.cast("double").alias("value")).select(
        F.lit("orphan_pct").alias("metric"), F.lit("fact_claim").alias("subject"), "value")
