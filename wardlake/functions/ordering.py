"""Order-dependent operators that never pull a whole group into one task.

A plain window sends every row of a partition key to one task. The operators here
work in two levels where a group may be large: rows are ordered inside buckets that
preserve the overall order, a small summary row per bucket is accumulated, and the
summary is joined back. The result equals the plain window; the tests compare both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_BEFORE = (Window.unboundedPreceding, -1)
STEPS_PER_OCTAVE = 256
#: Earlier than any time, so rows without a time come first, as in an ascending window.
_NO_TIME = "0001-01-01 00:00:00"


def value_bucket(col: Column) -> Column:
    """Monotone bucket of a number: 256 steps per power of two, mirrored below zero."""
    v = col.cast("double")
    size = F.floor(F.log2(F.abs(v)) * STEPS_PER_OCTAVE) + F.lit(1_000_000)
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0)).cast("bigint")


def _cell(ts: str, spread: Column, bucket: str, first: Column | None) -> Column:
    """Monotone bucket of (time, ``first`` before others, md5 of the tie): the time's ``bucket``.

    Rows without a time or at a midnight, where placeholders gather, are dealt over 4096 cells by the
    md5 that orders them, a microsecond each, before the rest of the bucket.
    """
    at = F.coalesce(F.col(ts), F.lit(_NO_TIME).cast("timestamp"))
    place = F.conv(F.substring(spread, 1, 3), 16, 10).cast("bigint") + 1
    if first is not None:
        place = F.when(first, F.lit(0).cast("bigint")).otherwise(place)
    rest = F.lit(4097).cast("bigint")
    crowded = F.col(ts).isNull() | (at == F.date_trunc("day", at))
    return F.timestamp_micros(F.unix_micros(F.date_trunc(bucket, at)) + F.when(crowded, place).otherwise(rest))


def neighbours(df: DataFrame, key: str, ts: str, tie: str, value: Column, before: str | None = None,
               after: str | None = None, largest: str | None = None, first: Column | None = None,
               bucket: str = "hour") -> DataFrame:
    """Nearest non-null ``value`` among earlier (``before``) and later (``after``) rows of the key, or the ``largest`` earlier one.

    Rows are ordered by (ts, md5 of tie, tie); a NULL time comes first, and NULL keys are one key. Rows for
    which ``first`` holds precede others of the same time. Every key is cut into cells of an hour
    (midnights and missing times into 4096 by the md5), and the edge value of each cell is carried over a
    summary with one row per key and cell. So the largest windows hold the rows of one cell, and the cells
    of one key, whose number the calendar bounds; neither a crowded day nor a NULL key is one task.
    """
    data = df.withColumn("_v", value).withColumn("_h", F.md5(F.col(tie).cast("string")))
    data = data.withColumn("_f", F.lit(True) if first is None else ~first)
    data = data.withColumn("_b", _cell(ts, F.col("_h"), bucket, first))
    place = [ts, "_f", "_h", tie]
    cut = data.groupBy(F.col(key).alias("_k"), F.col("_b").alias("_kb"))
    edge = F.when(F.col("_v").isNotNull(), F.struct(*place, "_v"))
    wanted = [(name, i) for i, name in enumerate((before, after, largest)) if name is not None]
    edges = [F.max(edge), F.min(edge), F.max("_v")]
    carry = cut.agg(*[edges[i].alias(f"_e{i}") for _, i in wanted])

    def ordered(part: list[str], cols: list[str], backwards: bool):
        order = [F.col(c).desc() if backwards else F.col(c).asc() for c in cols]
        return Window.partitionBy(*part).orderBy(*order).rowsBetween(*_BEFORE)

    for _, i in wanted:
        over, near = ordered(["_k"], ["_kb"], i == 1), ordered([key, "_b"], place, i == 1)
        if i == 2:
            carry = carry.withColumn("_c2", F.max("_e2").over(over))
            data = data.withColumn("_in2", F.max("_v").over(near))
        else:
            carry = carry.withColumn(f"_c{i}", F.last(F.col(f"_e{i}._v"), ignorenulls=True).over(over))
            data = data.withColumn(f"_in{i}", F.last("_v", ignorenulls=True).over(near))
    carry = carry.select("_k", "_kb", *[f"_c{i}" for _, i in wanted])
    out = data.join(carry, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_kb")), "left")
    found = {0: F.coalesce("_in0", "_c0"), 1: F.coalesce("_in1", "_c1"), 2: F.greatest("_in2", "_c2")}
    return out.select(*df.columns, *[found[i].alias(name) for name, i in wanted])


def rank_table(df: DataFrame, keys: list[str], order: list[str], descending: bool = False,
               weight: str | None = None) -> DataFrame:
    """One row per distinct (keys, order): rows and distinct values that sort before it.

    Equal values are counted before anything is ordered, so a value shared by a
    third of the rows is one row here. ``order[0]`` must be numeric. ``weight`` names a
    count column of input that is already counted. Columns added: ``n`` rows with the
    value, ``n_before``, ``d_before``, ``n_total``.
    """
    def way(name: str, first: bool) -> Column:
        return F.col(name).desc() if descending and first else F.col(name).asc()

    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = (
        df.groupBy(*keys, *order).agg(size.alias("n"))
        .withColumn("_b", value_bucket(F.col(order[0])))
    )
    slot = F.col("_b").desc() if descending else F.col("_b").asc()
    over_buckets = Window.partitionBy(*keys).orderBy(slot).rowsBetween(*_BEFORE)
    offsets = (
        counts.groupBy(*keys, "_b").agg(F.sum("n").alias("_bn"), F.count(F.lit(1)).alias("_bd"))
        .select(
            *keys, "_b",
            F.coalesce(F.sum("_bn").over(over_buckets), F.lit(0)).alias("_off_n"),
            F.coalesce(F.sum("_bd").over(over_buckets), F.lit(0)).alias("_off_d"),
            F.sum("_bn").over(Window.partitionBy(*keys)).alias("n_total"))
    )
    ordering = [way(c, i == 0) for i, c in enumerate(order)]
    inner = Window.partitionBy(*keys, "_b").orderBy(*ordering).rowsBetween(*_BEFORE)
    local = (
        counts.withColumn("_in_n", F.coalesce(F.sum("n").over(inner), F.lit(0)))
        .withColumn("_in_d", F.count(F.lit(1)).over(inner))
    )
    return local.join(offsets, [*keys, "_b"]).select(
        *keys, *order, "n",
        (F.col("_off_n") + F.col("_in_n")).alias("n_before"),
        (F.col("_off_d") + F.col("_in_d")).alias("d_before"),
        "n_total")


def percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                weight: str | None = None) -> DataFrame:
    """Exact interpolated percentiles per key (``percentile_cont``), one row per key."""
    cols = [*keys, value, *([weight] if weight else [])]
    table = rank_table(df.where(F.col(value).isNotNull()).select(*cols), keys, [value], weight=weight)
    outs = []
    for name, p in probs.items():
        pos = (F.col("n_total") - 1) * F.lit(float(p))
        low = F.max(F.when(F.col("n_before") <= F.floor(pos), F.col(value))).cast("double")
        high = F.max(F.when(F.col("n_before") <= F.ceil(pos), F.col(value))).cast("double")
        part = F.max(pos - F.floor(pos))
        outs.append((low + (high - low) * part).alias(name))
    return table.groupBy(*keys).agg(*outs)


def global_row_number(df: DataFrame, value: str, key: str, out: str = "row_num",
                      total: str = "row_total") -> DataFrame:
    """1-based position by (value, md5(key), key) over the whole table.

    Ties on the value are split by the first two digits of md5(key), so even one
    common value spreads over 256 groups. ``key`` is unique and ``value`` not NULL.
    """
    tagged = df.withColumn("_h", F.md5(F.col(key).cast("string"))) \
        .withColumn("_s", F.substring("_h", 1, 2))
    table = rank_table(tagged.select(value, "_s"), [], [value, "_s"]).select(
        F.col(value).alias("_v2"), F.col("_s").alias("_s2"), "n_before", "n_total")
    within = Window.partitionBy(value, "_s").orderBy("_h", key)
    return (
        tagged.withColumn("_r", F.row_number().over(within))
        .join(table, (F.col(value) == F.col("_v2")) & (F.col("_s") == F.col("_s2")))
        .withColumn(out, F.col("n_before") + F.col("_r"))
        .withColumnRenamed("n_total", total)
        .drop("_h", "_s", "_r", "_v2", "_s2", "n_before")
    )


def ntile_of(row_num: Column, total: Column, tiles: int) -> Column:
    """``ntile`` from a row number: the first ``total % tiles`` tiles get one row more."""
    k = F.lit(tiles).cast("bigint")
    small = F.floor(total / k)
    big = total - small * k
    in_big = F.floor((row_num - 1) / (small + 1)) + 1
    in_small = big + F.floor((row_num - 1 - big * (small + 1)) / F.greatest(small, F.lit(1))) + 1
    return F.when(row_num <= big * (small + 1), in_big).otherwise(in_small).cast("int")


def tile_start(tile: Column, total: Column, tiles: int) -> Column:
    """Rows before a tile of ``ntile``; tiles count from 1."""
    small = F.floor(total / F.lit(tiles).cast("bigint"))
    return (tile - 1) * small + F.least(tile - 1, total - small * tiles)


def tile_summary(df: DataFrame, value: str, tiles: int, probs: dict[str, float], out: str = "tile") -> DataFrame:
    """Per tile of ``ntile`` over ``value``: ``n`` rows, ``low``, ``high``, ``sum`` and interpolated percentiles.

    No row is numbered. A distinct value takes a run of places in the whole order, and what a tile gets
    of it is the part of the run inside the tile; a value shared by many rows may feed several tiles. Ties are equal
    values, so their order can not matter. ``value`` is not NULL; a tile without rows is left out.
    """
    runs = rank_table(df.select(value), [], [value])
    first, last = (ntile_of(F.col("n_before") + at, F.col("n_total"), tiles) for at in (F.lit(1), F.col("n")))
    cut = runs.withColumn(out, F.explode(F.sequence(first, last)))
    start = tile_start(F.col(out), F.col("n_total"), tiles)
    cut = cut.withColumn("_from", F.greatest(F.col("n_before") - start, F.lit(0))) \
        .withColumn("_size", tile_start(F.col(out) + 1, F.col("n_total"), tiles) - start)
    cut = cut.withColumn("_n", F.least(F.col("n_before") + F.col("n") - start, F.col("_size")) - F.col("_from"))
    columns = []
    for name, p in probs.items():
        at = (F.col("_size") - 1) * F.lit(float(p))
        low, high = (F.max(F.when(F.col("_from") <= step, F.col(value))).cast("double") for step in (F.floor(at), F.ceil(at)))
        columns.append((low + (high - low) * F.max(at - F.floor(at))).alias(name))
    return cut.groupBy(out).agg(
        F.sum("_n").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.sum(F.col(value) * F.col("_n")).alias("sum"), *columns)


def running_total(df: DataFrame, amount: str, tie: str, out: str = "running",
                  total: str = "grand_total") -> DataFrame:
    """Cumulative sum of ``amount`` from the largest down (ties by ``tie``) and the grand total."""
    data = df.withColumn("_b", value_bucket(F.col(amount)))
    before = Window.orderBy(F.col("_b").desc()).rowsBetween(*_BEFORE)
    offsets = (
        data.groupBy("_b").agg(F.sum(amount).alias("_bs"))
        .select(
            "_b", F.coalesce(F.sum("_bs").over(before), F.lit(0)).alias("_off"),
            F.sum("_bs").over(Window.partitionBy()).alias(total))
    )
    inner = Window.partitionBy("_b").orderBy(F.col(amount).desc(), F.col(tie)) \
        .rowsBetween(Window.unboundedPreceding, 0)
    return (
        data.withColumn("_in", F.sum(amount).over(inner)).join(offsets, "_b")
        .withColumn(out, F.col("_off") + F.col("_in"))
        .drop("_b", "_in", "_off")
    )
