"""Surrogate keys that stay apart when the short hashes of two business keys agree.

Keys are 48 bits of a hash. Among some ten million business keys two that agree become likely, so every
business key that shares its short hash with another one gets a wide key instead: 60 other bits, above all
short ones. Both members of a pair change, so the keys do not depend on which one came first. Tables of wide
keys hold those members only, a few rows among billions, and Spark sizes the joins with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions.keys import hash_sk
from wardlake.operators.profile import key_collisions

#: First wide key; short ones are below 2^48.
WIDE_FROM = 1 << 60
_PREFIX = "_wide_"


def wide_sk(bk: Column | str) -> Column:
    """A bigint from the last 15 hex digits of the hash, of which the short key has none but the 12 first."""
    text = F.col(bk) if isinstance(bk, str) else bk
    return F.conv(F.substring(F.md5(text.cast("string")), 18, 15), 16, 10).cast("bigint") + F.lit(WIDE_FROM)


def crowded(df: DataFrame, bk: str) -> DataFrame:
    """Short keys (``_sk``) of several business keys. One aggregate over the key column; NULL has no key."""
    return key_collisions(df.select(bk, hash_sk(bk).alias("_sk")), bk, "_sk").select("_sk")


def members(df: DataFrame, bk: str, short: DataFrame) -> DataFrame:
    """Business keys behind ``short`` keys, each with its wide key ``sk``."""
    return df.select(bk).join(short, hash_sk(bk) == F.col("_sk"), "left_semi").distinct() \
        .select(bk, wide_sk(bk).alias("sk"))


def attach(df: DataFrame, wide: dict[str, DataFrame]) -> DataFrame:
    """Carry the wide key along for each column of ``wide`` that ``df`` has; NULL where the short one holds."""
    for bk, table in wide.items():
        if bk in df.columns:
            some = table.select(F.col(bk).alias("_bk"), F.col("sk").alias(_PREFIX + bk))
            df = df.join(some, F.col(bk) == F.col("_bk"), "left").drop("_bk")
    return df


def carried(df: DataFrame, bk: str) -> list[str]:
    """The attached column of a business key, to be kept by a step that names its columns."""
    return [name for name in (_PREFIX + bk,) if name in df.columns]


def sk_of(df: DataFrame, bk: str) -> Column:
    """The surrogate key of a business key: the wide one if it is attached and set."""
    return F.coalesce(*[F.col(name) for name in carried(df, bk)], hash_sk(bk))


def rekeyed(dim: DataFrame, bk: str, sk: str, wide: dict[str, DataFrame]) -> DataFrame:
    """A dimension, all versions, with wide keys where they are due."""
    if bk not in wide:
        return dim
    return attach(dim, {bk: wide[bk]}).withColumn(sk, F.coalesce(_PREFIX + bk, sk)).select(*dim.columns)
