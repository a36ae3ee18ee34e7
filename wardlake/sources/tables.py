"""Tables on a shared file system, as plain Spark writes in one configurable format.

A table is one folder, partitioned or not, whatever wrote it: rows can be appended, whole
partitions replaced, or all of it. Replacing writes the new files aside first and moves them in when
that write has succeeded, so a failed job leaves the table as it was. What is replaced stands below
``_old`` until the new folder is in its place and comes back if that fails; after a crash in between, the
next write to the table (or ``settle``) puts it back. The move is a rename of folders: readers can see
a table between two partitions' moves, and one writer per table at a time is assumed. History,
concurrent writers and time travel are left to a table format (``fmt``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardlake.functions import dates

#: Folder name of the NULL partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Sees the rows that a write passes on, to count them.
Watch = Callable[[DataFrame], DataFrame] | None
#: Folder below ``_old`` that holds a whole table.
WHOLE = "__table__"


class TableStore:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    # --- file system -----------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, path: str) -> list[tuple[str, str]]:
        """(name, path) of the sub-folders; a listing of folders, never of rows."""
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        return [(s.getPath().getName(), s.getPath().toString())
                for s in fs.listStatus(p) if s.isDirectory()]

    def drop(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _there(self, path: str) -> bool:
        fs, p = self._fs(path)
        return bool(fs.exists(p))

    def exists(self, name: str) -> bool:
        return self._there(self.path(name))

    def files(self, path: str) -> list[str]:
        """Paths of the files right below a folder."""
        fs, p = self._fs(path)
        return [s.getPath().toString() for s in fs.listStatus(p) if s.isFile()] if fs.exists(p) else []

    def make(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.mkdirs(p)

    def _move(self, source: str, target: str) -> None:
        fs, p = self._fs(target)
        fs.mkdirs(p.getParent())
        if not fs.rename(self._fs(source)[1], p):
            raise OSError(f"{source} could not be moved to {target}")

    def _old(self, name: str, child: str = "") -> str:
        return f"{self.root}/_old/{name}/{child or WHOLE}"

    def _swap(self, new: str, name: str, child: str = "") -> None:
        """Put the folder ``new`` where the table or one partition stands, which comes back if the move fails."""
        target, old = f"{self.path(name)}/{child}" if child else self.path(name), self._old(name, child)
        had = self._there(target)
        if had:
            self._move(target, old)
        try:
            self._move(new, target)
        except Exception:
            if had:
                self._move(old, target)
            raise
        if had:
            self.drop(old)

    def settle(self, name: str) -> None:
        """Finish what a crash left between two moves: the old folder goes back, unless the new one is in its place."""
        for child, full in self._children(f"{self.root}/_old/{name}"):
            target = self.path(name) if child == WHOLE else f"{self.path(name)}/{child}"
            if self._there(target):
                self.drop(full)
            elif child == WHOLE or "=" in child:
                self._move(full, target)

    def _finished(self, path: str) -> bool:
        return self._there(f"{path}/_SUCCESS")

    # --- reads -----------------------------------------------------------------

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        """Current rows."""
        reader = self.spark.read.format(self.fmt)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(self.path(name))

    # --- writes ----------------------------------------------------------------

    @staticmethod
    def _balanced(df: DataFrame, parts: list[str] | None, watch: Watch = None) -> DataFrame:
        """Group rows by target folder so each gets few files; AQE splits a big folder. ``watch`` sees the rows last."""
        rows = df.hint("rebalance", *parts) if parts else df
        return rows if watch is None else watch(rows)

    def append(self, df: DataFrame, name: str, parts: list[str] | None = None, watch: Watch = None, gather: bool = True) -> None:
        """Add rows. ``gather=False`` saves the shuffle by folder, for rows of few folders in tasks of fair size."""
        self.settle(name)
        self._balanced(df, parts if gather else None, watch).write.format(self.fmt).mode("append").partitionBy(*(parts or [])).save(self.path(name))

    def _aside(self, df: DataFrame, parts: list[str] | None, watch: Watch = None, gather: bool = True) -> str:
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        self._balanced(df, parts if gather else None, watch).write.format(self.fmt).mode("errorifexists").partitionBy(*(parts or [])).save(path)
        return path

    def overwrite(self, df: DataFrame, name: str, parts: list[str] | None = None, watch: Watch = None) -> None:
        """Full replacement; the rows may come from the table itself. The old files are gone afterwards."""
        new = self._aside(df, parts, watch)
        self.settle(name)
        self._swap(new, name)

    def stage(self, df: DataFrame, parts: list[str] | None = None) -> tuple[DataFrame, str]:
        """Write rows aside once, to be read several times or to replace their own source."""
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        df.write.format(self.fmt).mode("overwrite").partitionBy(*(parts or [])).save(path)
        return self.spark.read.format(self.fmt).schema(df.schema).load(path), path

    def replace_range(self, df: DataFrame, name: str, part: str, lo: int | str,
                      hi: int | str, watch: Watch = None) -> None:
        """Replace every row with ``lo <= part <= hi`` by ``df``; safe to repeat.

        The rows are written aside, and the folders of that write say what is new. Only then do
        partitions in the range change, each by a swap that never leaves it without rows; one that had rows
        and now has none goes last. Partitions outside the range, the NULL one too, are not touched.
        """
        new = self._aside(df.where(F.col(part).between(lo, hi)), [part], watch)
        if self.fmt in ("parquet", "orc", "json", "csv") and not self._finished(new):
            raise OSError(f"the rows for {name} were not written completely")
        prefix = f"{part}="
        fresh = {c: full for c, full in self._children(new) if c.startswith(prefix)}
        self.settle(name)
        for child, full in fresh.items():
            self._swap(full, name, child)
        for child, full in self._children(self.path(name)):
            value = child[len(prefix):]
            if child.startswith(prefix) and child not in fresh and value != NULL_PARTITION and lo <= type(lo)(value) <= hi:
                self.drop(full)
        self.drop(new)

    def replace_partitions(self, df: DataFrame, name: str, part: str, values: list | None = None,
                           sub: list[str] | None = None, watch: Watch = None, gather: bool = True) -> list[str]:
        """Replace partitions, each by a swap, and return the names of their folders; ``gather`` as in ``append``.

        Replaced are those that ``df`` has rows for. With ``values`` it must have rows for no others, and those
        of the list that it has none for go. ``sub`` names further partition columns below.
        """
        new = self._aside(df, [part, *(sub or [])], watch, gather)
        if self.fmt in ("parquet", "orc", "json", "csv") and not self._finished(new):
            raise OSError(f"the rows for {name} were not written completely")
        self.settle(name)
        wanted = None if values is None else {f"{part}={NULL_PARTITION if v is None else v}" for v in values}
        fresh = [child for child, _ in self._children(new) if child.startswith(f"{part}=")]
        if wanted is not None and not wanted.issuperset(fresh):
            raise ValueError(f"{name}: rows for {sorted(set(fresh) - wanted)}, which are not to be replaced")
        for child in fresh:
            self._swap(f"{new}/{child}", name, child)
        for child in (wanted or set()) - set(fresh):
            self.drop(f"{self.path(name)}/{child}")
        self.drop(new)
        return sorted(wanted or fresh)

    def replace_tail(self, source: DataFrame, name: str, ts: str, part: str, asof: datetime,
                     hours: int = 2) -> None:
        """Mirror the last ``hours`` of ``source`` into the table, older rows untouched.

        ``part`` is the ``yyyyMMdd`` key of ``ts``. The cut-off day is rebuilt from its
        kept rows; every later day of the table is replaced.
        """
        cut = dates.shift(asof, hours, "hour")
        cut_sk = dates.sk_of(cut.date())
        fresh = source.where((F.col(part) >= cut_sk) & (F.col(ts) >= F.lit(cut)))
        if self.exists(name):
            old = self.read(name).where((F.col(part) >= cut_sk) & (F.col(ts) < F.lit(cut)))
            fresh = old.unionByName(fresh)
        self.replace_range(fresh, name, part, cut_sk, 99991231)

    def insert_missing(self, df: DataFrame, name: str, keys: list[str], parts: list[str] | None = None) -> None:
        """Add rows whose key is not in the table yet; matched rows are not touched. NULL is a key value."""
        fresh = df.dropDuplicates(keys)
        if self.exists(name):
            known = self.read(name).select(*[F.col(k).alias(f"_known_{k}") for k in keys])
            same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
            fresh = fresh.join(known, same, "left_anti")
        staged, path = self.stage(fresh)
        self.append(staged, name, parts)
        self.drop(path)

    def purge(self, name: str, part: str, before: date) -> list[str]:
        """Drop whole ``yyyyMMdd`` partitions older than ``before``; no row is read."""
        gone = []
        for child, full in self._children(self.path(name)):
            value = child.split("=", 1)[-1]
            if child.startswith(f"{part}=") and value != NULL_PARTITION and int(value) < dates.sk_of(before):
                self.drop(full)
                gone.append(child)
        return sorted(gone)
