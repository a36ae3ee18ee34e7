import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlake.functions import ordering as o


def history(spark, n=400):
    """One patient holds a third of the rows; times collide."""
    rng = random.Random(7)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"p{rng.randrange(20)}"
        ts = datetime(2020, 1, 1) + timedelta(days=rng.randrange(120), hours=rng.randrange(3) * 8)
        key, ts = (None if i % 17 == 0 else key), (None if i % 11 == 0 else ts)
        data.append((key, ts, f"e{i:04d}", rng.choice([None, rng.randrange(100)])))
    return spark.createDataFrame(data, "k string, ts timestamp, id string, v int")


def plain(df, name, desc):
    parts = [F.col("ts"), F.md5("id"), F.col("id")]
    order = [c.desc() if desc else c.asc() for c in parts]
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.last("v", ignorenulls=True).over(w))


def crowded(spark):
    """One key and NULL with a hot hour, a hot midnight and rows without a time, beside ordinary keys."""
    rng = random.Random(13)
    data = []
    for i in range(900):
        key = rng.choice(["hot", "hot", None, f"p{rng.randrange(9)}"])
        ts = rng.choice([None, datetime(2020, 3, 1), datetime(2020, 3, 1, 7, 0, 0), datetime(2020, 3, 1, 7, rng.randrange(60), rng.randrange(60)),
                         datetime(2020, rng.randrange(1, 13), rng.randrange(1, 28), rng.randrange(24))])
        data.append((key, ts, f"e{i:04d}", rng.choice([None, rng.randrange(1000)])))
    return spark.createDataFrame(data, "k string, ts timestamp, id string, v int")


def test_crowded_keys_equal_plain_window(spark, tuples):
    df = crowded(spark)
    w = Window.partitionBy("k").orderBy("ts", F.md5("id"), "id").rowsBetween(Window.unboundedPreceding, -1)
    want = plain(plain(df, "b", False), "a", True).withColumn("m", F.max("v").over(w))
    got = o.neighbours(df, "k", "ts", "id", F.col("v"), "b", "a", "m")
    assert tuples(got, "id", "b", "a", "m") == tuples(want, "id", "b", "a", "m")


def test_no_cell_holds_a_crowd(spark):
    """A bulk load at one midnight, and rows without a time, are dealt over thousands of cells in their order."""
    df = spark.range(3000).select(F.col("id").cast("string").alias("id"),
                                  F.when(F.col("id") % 2 == 0, F.lit(datetime(2020, 3, 1))).alias("ts"))
    cells = df.withColumn("h", F.md5("id")).withColumn("b", o._cell("ts", F.col("h"), "hour", None))
    assert cells.groupBy("ts", "b").count().agg(F.max("count")).first()[0] < 10
    w = Window.partitionBy("ts").orderBy("h")
    assert cells.withColumn("last", F.lag("b").over(w)).where("last > b").count() == 0


def test_neighbours_equal_plain_window(spark, tuples):
    df = history(spark)
    want = tuples(plain(plain(df, "b", False), "a", True), "id", "b", "a")
    for bucket in ("hour", "day", "week", "year"):
        got = o.neighbours(df, "k", "ts", "id", F.col("v"), "b", "a", bucket)
        assert tuples(got, "id", "b", "a") == want, bucket


def test_neighbours_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, datetime(2020, 1, 1), "a", 1)],
                               "k string, ts timestamp, id string, v int")
    assert o.neighbours(df, "k", "ts", "id", F.col("v"), "b").collect()[0]["b"] is None


def values(spark):
    rng = random.Random(3)
    data = [(f"g{i % 2}", float(rng.choice([0, -5, 7, 7, 7, rng.uniform(-1e6, 1e6)])), f"k{i}")
            for i in range(500)]
    return spark.createDataFrame(data, "g string, v double, id string")


def test_percentiles_match_numpy(spark):
    df = values(spark)
    pdf = df.toPandas()
    got = {r["g"]: r for r in o.percentiles(df, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.99}).collect()}
    for g, part in pdf.groupby("g"):
        for name, p in [("a", 25), ("b", 50), ("c", 99)]:
            assert abs(got[g][name] - np.percentile(part.v, p)) < 1e-6
    whole = o.percentiles(df, [], "v", {"m": 0.5}).collect()[0]["m"]
    assert abs(whole - np.median(pdf.v)) < 1e-6


def test_rank_table_matches_rank(spark, tuples):
    df = values(spark)
    for desc in (False, True):
        order = F.col("v").desc() if desc else F.col("v").asc()
        w = Window.partitionBy("g").orderBy(order)
        want = tuples(df.select("g", "v", F.rank().over(w), F.dense_rank().over(w)).distinct())
        table = o.rank_table(df, ["g"], ["v"], desc)
        assert tuples(table.select("g", "v", F.col("n_before") + 1, F.col("d_before") + 1)) == want


def test_global_row_number_and_ntile(spark, tuples):
    df = values(spark)
    w = Window.orderBy("v", F.md5("id"), "id")
    want = tuples(df.select("id", F.row_number().over(w), F.ntile(7).over(w)))
    got = o.global_row_number(df, "v", "id")
    tiles = o.ntile_of(F.col("row_num"), F.col("row_total"), 7)
    assert tuples(got.select("id", "row_num", tiles)) == want


def test_ntile_with_fewer_rows_than_tiles(spark):
    df = spark.range(3).select((F.col("id") + 1).alias("r"))
    got = [x[0] for x in df.select(o.ntile_of(F.col("r"), F.lit(3), 5)).collect()]
    assert got == [1, 2, 3]


def test_running_total_matches_window(spark, tuples):
    df = values(spark).withColumn("v", F.abs("v").cast("decimal(14,2)"))
    w = Window.orderBy(F.col("v").desc(), "id").rowsBetween(Window.unboundedPreceding, 0)
    assert tuples(o.running_total(df, "v", "id"), "id", "running") == tuples(
        df.select("id", F.sum("v").over(w)))


def test_value_bucket_is_monotone(spark):
    got = [r[0] for r in values(spark).orderBy("v").select(o.value_bucket(F.col("v"))).collect()]
    assert got == sorted(got)


def test_tiles_equal_plain_ntile(spark):
    """A value of a third of the rows lies over several tiles; tiles may outnumber rows."""
    rng = random.Random(21)
    for n, tiles in [(300, 4), (300, 7), (5, 4), (3, 5), (1, 4), (0, 4)]:
        data = [(float(rng.choice([0, 0, 0, -3, 12, rng.uniform(-50, 1e5)])), f"k{i}") for i in range(n)]
        df = spark.createDataFrame(data, "v double, id string")
        cut = df.select("v", F.ntile(tiles).over(Window.orderBy("v", "id")).alias("tile"))
        want = cut.groupBy("tile").agg(F.count("v"), F.min("v"), F.max("v"), F.sum("v"), F.percentile("v", 0.5), F.percentile("v", 0.9))
        got = o.tile_summary(df, "v", tiles, {"a": 0.5, "b": 0.9})
        want, got = (np.array(sorted(tuple(r) for r in x.collect()), dtype=float) for x in (want, got))
        assert want.shape == got.shape and np.allclose(want, got)
