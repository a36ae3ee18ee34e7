"""Row-level security, masking, erasure, small-cell suppression, retention."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.functions import dates

OPEN_ROLES = {"RevenueCycle"}
#: Roles that see personal fields as they are; every other role, unknown ones too, gets them masked.
CLEAR_ROLES = {"RevenueCycle", "Clinician"}

# Days each data class is kept.
RETENTION_DAYS = {"vitals_hot": 90, "vitals_cold": 365, "claims": 5 * 365, "audit": 7 * 365}


def restrict(df: DataFrame, user: str, role: str, membership: DataFrame,
             key: str = "hospital_bk") -> DataFrame:
    """Rows of the facilities mapped to the user; open roles see everything."""
    if role in OPEN_ROLES:
        return df
    mine = membership.where(F.col("user_name") == user).select(key)
    return df.join(mine, key, "left_semi")


def mask(df: DataFrame, cols: list[str], role: str) -> DataFrame:
    """The columns hidden unless the role may see them: letters of any script, digits and signs alike."""
    if role in CLEAR_ROLES:
        return df
    return df.withColumns({c: F.mask(F.col(c), otherChar=F.lit("*")) for c in cols})


def erase(df: DataFrame, subjects: DataFrame, key: str) -> DataFrame:
    """The table without the given subjects."""
    return df.join(subjects.select(key), key, "left_anti")


@dataclass(frozen=True)
class Held:
    """Where a table names the subject: its column, the column of the subjects it equals, and the table's partition columns."""

    key: str
    subject: str
    parts: tuple[str, ...] = ()


def erase_everywhere(store, tables: dict[str, Held], subjects: DataFrame) -> dict[str, list[str]]:
    """Remove the subjects from tables of any layer; the folders that were rewritten, by table.

    A scan of the key and partition columns finds the partitions that hold a subject; only those are rewritten, so a
    few subjects cost a few folders, and other files stay as they are. A table without partitions is
    rewritten if it holds one. Old files are deleted, so the subjects can not be read back. The subjects
    are written aside first: they may come from one of the tables. Rows are read folder by folder and
    written to where they were, so they are not shuffled.
    """
    kept, path = store.stage(subjects)
    done = {}
    for name, held in tables.items():
        rows = store.read(name)
        wanted = kept.select(F.col(held.subject).alias(held.key)).where(F.col(held.key).isNotNull()).distinct()
        hits = rows.join(wanted, held.key, "left_semi")
        if not held.parts:
            done[name] = []
            if not hits.isEmpty():
                store.overwrite(erase(rows, wanted, held.key), name)
                done[name] = [name]
            continue
        part, *sub = held.parts
        values = [r[0] for r in hits.select(part).distinct().collect()]
        here = F.col(part).isin([v for v in values if v is not None])
        if None in values:
            here = here | F.col(part).isNull()
        done[name] = store.replace_partitions(erase(rows.where(here), wanted, held.key), name, part, values, sub, gather=False) if values else []
    store.drop(path)
    return done


def suppress(df: DataFrame, count_col: str, measures: list[str], k: int = 5) -> DataFrame:
    """Hide the count and the measures of cells below ``k``."""
    small = F.col(count_col) < k
    return df.withColumns({c: F.when(~small, F.col(c)) for c in [*measures, count_col]})


def retain(df: DataFrame, day_sk: str, data_class: str, asof: date) -> DataFrame:
    """Rows still inside the retention period; the bound prunes date partitions."""
    keep_from = dates.shift(asof, RETENTION_DAYS[data_class], "day")
    return df.where(F.col(day_sk) >= dates.sk_of(keep_from))
