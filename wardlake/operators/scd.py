"""Type-2 dimensions: merge, change detection, point-in-time join."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from wardlake.functions.keys import hash_sk, record_hash
from wardlake.functions.ordering import neighbours

META = ["effective_from", "effective_to", "is_current", "record_hash"]

PATIENT_ATTRS = ["first_name", "last_name", "date_of_birth", "gender", "marital_status", "race",
                 "ethnicity", "governorate", "city", "is_deceased"]
PROVIDER_ATTRS = ["full_name", "credential", "specialty", "primary_facility_sk",
                  "license_expiry", "hire_date", "is_active"]


def first_load(incoming: DataFrame, attrs: list[str], load_ts: datetime) -> DataFrame:
    """The dimension after its first load: one open version per row."""
    return incoming.withColumns({
        "effective_from": F.lit(load_ts).cast(TimestampType()),
        "effective_to": F.lit(None).cast(TimestampType()),
        "is_current": F.lit(True),
        "record_hash": record_hash(*attrs),
    })


def _side(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_{name}_{k}") for k in keys],
                     F.struct(*[F.col(c) for c in df.columns]).alias(name))


def _paired(current: DataFrame, incoming: DataFrame, keys: list[str], attrs: list[str],
            load_ts: datetime) -> DataFrame:
    """Open versions next to their new rows, one shuffle join on the business key; NULL is a key like others."""
    new = first_load(incoming, attrs, load_ts).select(*current.columns)
    left = _side(current.where(F.col("is_current")), keys, "old")
    right = _side(new, keys, "new")
    match = [F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    joined = left
    cond: Column = match[0]
    for extra in match[1:]:
        cond = cond & extra
    return joined.join(right, cond, "full_outer").select("old", "new")


def changed(current: DataFrame, incoming: DataFrame, keys: list[str], attrs: list[str],
            load_ts: datetime) -> DataFrame:
    """New keys and keys whose attributes changed, with ``change`` = new / changed."""
    rows = _paired(current, incoming, keys, attrs, load_ts).where(F.col("new").isNotNull())
    kind = F.when(F.col("old").isNull(), F.lit("new")).when(
        F.col("old.record_hash") != F.col("new.record_hash"), F.lit("changed"))
    return rows.withColumn("change", kind).where(F.col("change").isNotNull()) \
        .select("new.*", "change")


def merge2(current: DataFrame, incoming: DataFrame, keys: list[str], attrs: list[str],
           load_ts: datetime, born: datetime | None = None) -> DataFrame:
    """The whole dimension after one load.

    New key: one open version from ``load_ts``, or from ``born``, so that facts that came before it find one. Same hash: untouched. Other hash: the open version
    closes at ``load_ts`` and a new one opens there. Key absent from the load:
    untouched. ``incoming`` has one row per key. Every pair yields its one or two
    rows in place, so the dimension is scanned and shuffled once.
    """
    both = _paired(current, incoming, keys, attrs, load_ts)
    old, new = F.col("old"), F.col("new")
    closed = old.withField("effective_to", F.lit(load_ts).cast(TimestampType())) \
        .withField("is_current", F.lit(False))
    fresh = new if born is None else new.withField("effective_from", F.lit(born).cast(TimestampType()))
    rows = (
        F.when(old.isNull(), F.array(fresh))
        .when(new.isNull(), F.array(old))
        .when(F.col("old.record_hash") == F.col("new.record_hash"), F.array(old))
        .otherwise(F.array(closed, new))
    )
    open_side = both.select(F.explode(rows).alias("row")).select("row.*")
    history = current.where(~F.col("is_current"))
    return history.unionByName(open_side)


def with_version_sk(df: DataFrame, bk: str, out: str) -> DataFrame:
    """Key of one version: business key and start of validity."""
    start = F.date_format("effective_from", "yyyy-MM-dd HH:mm:ss")
    return df.withColumn(out, hash_sk(F.col(bk), start))


def as_of(fact: DataFrame, dim: DataFrame, key: str, ts: str, keep: list[str]) -> DataFrame:
    """Attach the dimension version valid at the event time, ``[from, to)``, or NULLs.

    Events and starts of versions are one ordered set, and the last start is carried along
    (``ordering.neighbours``), so a key with any number of events or versions is never one task. Versions
    of a key must not overlap. An event without key or time has no version.
    """
    versions = dim.select(
        F.col(key).alias("_key"), F.col("effective_from").alias("_at"), F.lit(True).alias("_is_version"),
        F.struct(F.col("effective_to").alias("_to"), *keep).alias("_version"),
        *[F.lit(None).cast(f.dataType).alias(f"_x{i}") for i, f in enumerate(fact.schema)])
    kind = versions.schema["_version"].dataType
    events = fact.select(
        F.col(key).alias("_key"), F.col(ts).cast(versions.schema["_at"].dataType).alias("_at"),
        F.lit(False).alias("_is_version"), F.lit(None).cast(kind).alias("_version"),
        *[F.col(f.name).alias(f"_x{i}") for i, f in enumerate(fact.schema)])
    both = versions.unionByName(events)
    tie = F.xxhash64(*[f"_x{i}" for i in range(len(fact.columns))])
    seen = neighbours(both.withColumn("_tie", tie), "_key", "_at", "_tie", F.col("_version"), before="_last",
                      first=F.col("_is_version"))
    last = F.col("_last")
    valid = F.col("_key").isNotNull() & F.col("_at").isNotNull() & (last["_to"].isNull() | (F.col("_at") < last["_to"]))
    return seen.where(~F.col("_is_version")).select(
        *[F.col(f"_x{i}").alias(name) for i, name in enumerate(fact.columns)],
        *[F.when(valid, last[name]).alias(name) for name in keep])
