"""Registry of queries: a Spark callable, its declared output columns, its SQL twin."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.bindings import Bindings
from wardlake.contract import sqlbind

SPARK_TYPES = {"i": "bigint", "d": "double", "s": "string", "b": "boolean"}
DUCK_TYPES = {"i": "bigint", "d": "double", "s": "varchar", "b": "boolean"}
ROUND = 4


@dataclass
class Entry:
    build: Callable[[Bindings], DataFrame]
    columns: list[tuple[str, str]]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(key: str, columns: str, sql: str | None = None):
    """Register ``build(bindings)``.

    ``columns`` lists ``name:type``: i integer, d double, r double rounded to four
    places, s text, b boolean. Both engines cast to it, so decimals, dates and
    timestamps compare by value and not by client type.
    """
    cols = [tuple(c.split(":")) for c in columns.split()]

    def add(build: Callable[[Bindings], DataFrame]):
        if key in ENTRIES:
            raise ValueError(f"{key} is registered twice")
        ENTRIES[key] = Entry(build, cols, sql)
        return build
    return add


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = ENTRIES[key]
    df = entry.build(Bindings(spark, sf_dir))
    out = []
    for name, kind in entry.columns:
        if kind == "r":
            out.append(F.round(F.col(name).cast("double"), ROUND).alias(name))
        else:
            out.append(F.col(name).cast(SPARK_TYPES[kind]).alias(name))
    return df.select(*out)


def duck_sql(key: str) -> str | None:
    entry = ENTRIES[key]
    if entry.sql is None:
        return None
    out = []
    for name, kind in entry.columns:
        if kind == "r":
            out.append(f"round(cast({name} AS double), {ROUND}) AS {name}")
        else:
            out.append(f"cast({name} AS {DUCK_TYPES[kind]}) AS {name}")
    body = f"SELECT {', '.join(out)} FROM ({entry.sql.strip()}) AS result"
    return sqlbind.with_tables(re.sub(r"\n\s+", "\n", body))
