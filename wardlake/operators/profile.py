"""Column profiles as small result tables."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import measures as m
from wardlake.functions.ordering import percentiles


def _tall(row: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias(label), F.col(n).cast("double").alias(value)) for n in names]
    return row.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def null_rates(df: DataFrame) -> DataFrame:
    """Share of NULLs of every column from one aggregate."""
    rates = [(m.count_where(F.col(c).isNull()) / F.count(F.lit(1))).alias(c) for c in df.columns]
    return _tall(df.agg(*rates), df.columns, "column_name", "null_rate")


def numeric(df: DataFrame, col: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of one column, one row."""
    v = F.col(col).cast("double")
    base = df.select(v.alias("v")).where(F.col("v").isNotNull())
    quart = percentiles(base, [], "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99})
    plain = base.agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("lo"), F.max("v").alias("hi"))
    both = plain.unionByName(quart, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def clip_at(df: DataFrame, col: str, p: float = 0.99) -> DataFrame:
    """Values above the percentile are set to it."""
    bound = percentiles(df, [], col, {"b": p}).select("b").scalar()
    return df.withColumn(col, F.least(F.col(col).cast("double"), bound))


def box(df: DataFrame, col: str) -> DataFrame:
    """Quartiles, range and 1.5-range fences of the positive values."""
    q = percentiles(df.where(F.col(col) > 0), [], col, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    return q.withColumns({"iqr": spread, "low_fence": F.col("q1") - 1.5 * spread,
                          "high_fence": F.col("q3") + 1.5 * spread})


def top_values(df: DataFrame, col: str, n: int | None = None, fill: str | None = None) -> DataFrame:
    """Frequency of the values, largest first; ``n`` makes it a top-n report."""
    value = F.coalesce(F.col(col), F.lit(fill)) if fill is not None else F.col(col)
    ranked = df.groupBy(value.alias(col)).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("n").desc(), F.col(col).asc())
    return ranked.limit(n) if n else ranked


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum falls in the last bin."""
    data = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    stats = data.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = stats.select("lo").scalar(), stats.select("hi").scalar()
    width = (hi - lo) / F.lit(bins)
    slot = F.when(width > 0, F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1))).otherwise(0)
    return data.groupBy(slot.cast("int").alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))


def monthly(df: DataFrame, ts: str) -> DataFrame:
    """Rows per month from the first to the last month, empty months included."""
    counts = df.where(F.col(ts).isNotNull()) \
        .groupBy(F.trunc(F.col(ts).cast("date"), "MONTH").alias("_m")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    span = counts.agg(F.min("_m").alias("a"), F.max("_m").alias("b"))
    months = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return months.join(counts, F.col("month") == F.col("_m"), "left") \
        .select("month", F.coalesce("_n", F.lit(0)).alias("n"))


def corr(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of every pair of columns over rows where both are known, one aggregate."""
    pairs = list(combinations_with_replacement(cols, 2))

    def both(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        return F.corr(x, y)

    row = df.agg(*[both(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                              F.col(f"c{i}").alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"),
                                  F.col(f"c{i}").alias("corr")))
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def ri(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows whose key has no parent: count, total, percent. NULL keys count as missing."""
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    joined = child.select(F.col(fk).alias("_fk")).join(keys, F.col("_fk") == F.col("_pk"), "left")
    missing = m.count_where(F.col("_pk").isNull())
    return joined.agg(F.count(F.lit(1)).alias("total"), missing.alias("missing"),
                      m.pct(missing, F.count(F.lit(1))).alias("missing_pct"))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """The child rows without a parent."""
    keys = parent.select(F.col(pk).alias(fk))
    return child.join(keys, fk, "left_anti")


def key_collisions(df: DataFrame, bk: str, sk: str) -> DataFrame:
    """Surrogate keys that stand for more than one business key, with the least and greatest of them.

    Minimum and maximum are combined before the shuffle, so repeated rows and hot keys cost nothing and no
    list of keys is built. Rows without either key are left out.
    """
    known = df.where(F.col(bk).isNotNull() & F.col(sk).isNotNull())
    return known.groupBy(sk).agg(F.min(bk).alias("least_bk"), F.max(bk).alias("greatest_bk")) \
        .where(F.col("least_bk") != F.col("greatest_bk"))
