"""Data-quality rules: one pass, first failing rule wins, NULL fails."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import measures as m

RULE, AT, RUN = "_rejected_rule", "_rejected_at", "_quarantine_run"
Rules = list[tuple[str, Column]]


@dataclass
class Checked:
    """Rows tagged with their first failing rule (NULL when clean)."""

    tagged: DataFrame
    rules: list[str]
    at: datetime | None = None

    @property
    def clean(self) -> DataFrame:
        return self.tagged.where(F.col(RULE).isNull()).drop(RULE)

    @property
    def rejected(self) -> DataFrame:
        ts = F.lit(self.at).cast("timestamp") if self.at else F.current_timestamp()
        return self.tagged.where(F.col(RULE).isNotNull()).withColumn(AT, ts)

    def metrics(self) -> DataFrame:
        """Per rule: rows it saw (earlier rejects are gone), rows rejected, percent.

        One aggregate over the tagged rows; the rule list is unpivoted afterwards.
        """
        counts = self.tagged.agg(
            F.count(F.lit(1)).alias("_total"),
            *[m.count_where(F.col(RULE) == name).alias(f"_r{i}")
              for i, name in enumerate(self.rules)])
        rows = []
        for i, name in enumerate(self.rules):
            earlier = sum((F.col(f"_r{j}") for j in range(i)), F.lit(0))
            rows.append(F.struct(
                F.lit(i + 1).alias("rule_order"), F.lit(name).alias("rule"),
                (F.col("_total") - earlier).alias("total"),
                F.col(f"_r{i}").alias("rejected")))
        flat = counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        return flat.withColumn("rejected_pct", m.pct(F.col("rejected"), F.col("total")))


def apply(df: DataFrame, rules: Rules, at: datetime | None = None) -> Checked:
    """Tag every row with the first rule that is not TRUE for it.

    Clean and rejected rows are two filters on one expression, instead of one
    filter and two counts per rule.
    """
    tag = F.lit(None).cast("string")
    for name, rule in reversed(rules):
        tag = F.when(F.coalesce(rule, F.lit(False)), tag).otherwise(F.lit(name))
    return Checked(df.withColumn(RULE, tag), [name for name, _ in rules], at)


def split(df: DataFrame, rule: Column, name: str, at: datetime | None = None) -> Checked:
    return apply(df, [(name, rule)], at)


def write_quarantine(checked: Checked, store, name: str, whole: bool = False) -> None:
    """Write rejects by run and rule. A run is known by its time, and its rejects replace those it left before.

    No rejects leave the table as it is, unless they are the ``whole`` of the run. Without a time of the
    run the rejects are appended.
    """
    rows = checked.rejected.withColumn("_quarantine_date", F.to_date(F.col(AT))) \
        .withColumn(RUN, F.date_format(F.col(AT), "yyyyMMddHHmmss").cast("bigint"))
    if checked.at is None:
        store.append(rows, name, [RUN, RULE])
    else:
        run = [int(checked.at.strftime("%Y%m%d%H%M%S"))] if whole else None
        store.replace_partitions(rows, name, RUN, run, [RULE])


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row per key that is largest by ``order``; remaining ties by all columns.

    An aggregate, not a window: copies of one key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    tie = [F.xxhash64(*[F.col(c) for c in df.columns])]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]),
                    F.struct(*[F.col(c) for c in order], *tie))
    return (
        df.groupBy(*keys).agg(best.alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def claim_in_encounter(claims: DataFrame, encounters: DataFrame) -> Checked:
    """Service date within the dates of the claim's encounter; orphans pass."""
    spans = encounters.select(
        F.col("encounter_bk").alias("_eb"), F.to_date("start_at").alias("_lo"),
        F.to_date("end_at").alias("_hi"))
    joined = claims.join(spans, F.col("encounter_bk") == F.col("_eb"), "left")
    inside = (
        F.col("_eb").isNull()
        | ((F.col("service_date") >= F.col("_lo"))
           & (F.col("_hi").isNull() | (F.col("service_date") <= F.col("_hi"))))
    )
    done = split(joined, inside, "service_in_encounter")
    return Checked(done.tagged.drop("_eb", "_lo", "_hi"), done.rules)


def known_code(df: DataFrame, col: str, reference: DataFrame, ref_col: str) -> Checked:
    """Rows whose code is missing from the code table are rejected as ``code_known``."""
    codes = reference.select(F.col(ref_col).alias("_code")).distinct()
    done = split(df.join(codes, F.col(col) == F.col("_code"), "left"),
                 F.col("_code").isNotNull(), "code_known")
    return Checked(done.tagged.drop("_code"), done.rules)
