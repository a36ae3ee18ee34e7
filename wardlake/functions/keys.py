"""Surrogate keys, record hashes and bucket assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNKNOWN_SK = -1


def hash_sk(*cols: Column | str) -> Column:
    """First 12 hex digits of md5 of the business key as a bigint; NULL stays NULL.

    Several columns are joined with ``|`` first; the key is NULL when any part is.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    text = parts[0].cast("string")
    for part in parts[1:]:
        text = F.concat(text, F.lit("|"), part.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")


def date_sk(col: Column | str) -> Column:
    """``yyyyMMdd`` as an int, computed on calendar parts rather than formatted text."""
    day = F.col(col) if isinstance(col, str) else col
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def record_hash(*cols: str) -> Column:
    """Upper-case SHA-256 over the attributes joined with ``|``.

    NULL and empty text hash alike. A ``|`` or backslash inside a value is escaped
    so that two different attribute rows never join to the same text.
    """
    parts = []
    for name in cols:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        parts.append(F.replace(text, F.lit("|"), F.lit("\\|")))
    return F.upper(F.sha2(F.concat_ws("|", *parts), 256))


def bucket_hash(col: Column | str, method: str = "crc32") -> Column:
    """Non-negative bigint hash used to spread organisations over a facility pool."""
    text = F.col(col) if isinstance(col, str) else col
    if method == "crc32":
        return F.crc32(text.cast("binary"))
    if method == "md5":
        return hash_sk(text)
    raise ValueError(f"unknown bucket hash {method}")


def bucket_assign(df: DataFrame, key: str, pool: DataFrame, pool_key: str,
                  keep: list[str], method: str = "crc32") -> DataFrame:
    """Give every row one member of ``pool``: position ``hash(key) % size``.

    The pool is numbered in key order, so the assignment does not depend on read order. Its size
    is a scalar subquery of the plan: nothing runs before the result is asked for, and Spark
    sizes the join. The pool is reference data (facilities) and is numbered in one task. An empty pool fails
    the query.
    """
    size = pool.agg(F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("n") == 0, F.raise_error(F.lit("the pool is empty"))).otherwise(F.col("n")).cast("bigint")).scalar()
    numbered = pool.select(
        (F.row_number().over(Window.orderBy(pool_key)) - 1).cast("bigint").alias("_slot"), *keep)
    slotted = df.withColumn("_slot", F.pmod(bucket_hash(key, method), size))
    return slotted.join(numbered, "_slot", "left").drop("_slot")
