"""A table that micro-batches update by key.

Each micro-batch lands in a log folder of its own, so a trigger writes only what changed. When the log has
``fold_every`` folders they are folded into the base: the partitions that the log touches are written anew
with the newest row of each key, and the folders go. So the number of folders follows the data, not the triggers.

A row's version is (epoch, batch). The epoch belongs to a checkpoint; a new checkpoint counts batches
from 0 again, but in the next epoch, so its rows are newer than all before. A replayed batch overwrites its own
folder. A fold adds the new files before the old ones go, and reads take the newest version of a key, so a
crash at any point loses nothing: what was folded twice is one row. One stream per table at a time; a reader
that listed files just before a fold may have to start again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.sources.tables import TableStore

EPOCH, BATCH = "_epoch", "_batch"


class UpsertTable:
    """``keys`` name a row; ``part``, a column that follows from the keys, names its partition."""

    def __init__(self, store: TableStore, name: str, keys: list[str], part: str, fold_every: int = 16):
        self.store, self.name, self.keys, self.part, self.fold_every = store, name, keys, part, fold_every
        root = store.path(name)
        self.base, self.log, self.epochs, self.folding = f"{root}/base", f"{root}/log", f"{root}/epochs", f"{root}/folding"

    def epoch(self, checkpoint: str) -> int:
        """The epoch of a checkpoint folder; one without a mark begins the next, and is marked before its first batch."""
        marks = f"{checkpoint.rstrip('/')}/upsert_epoch"
        known = [int(child) for child, _ in self.store._children(marks)]
        if known:
            return max(known)
        new = 1 + max((int(child) for child, _ in self.store._children(self.epochs)), default=0)
        self.store.make(f"{self.epochs}/{new}")
        self.store.make(f"{marks}/{new}")
        return new

    def writer(self, epoch: int) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` function: the batch goes to its log folder, and a long log is folded in."""
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.format(self.store.fmt).mode("overwrite").save(f"{self.log}/{EPOCH}={epoch}/{BATCH}={batch_id}")
            if len(self._folders()) >= self.fold_every:
                self.fold()
        return write

    def _folders(self) -> list[str]:
        return [full for _, epoch in self.store._children(self.log) for _, full in self.store._children(epoch)]

    def _load(self, root: str, folders: list[str] | None = None) -> DataFrame:
        rows = self.store.spark.read.format(self.store.fmt).option("basePath", root).load(folders or root)
        return rows.withColumns({c: F.col(c).cast("bigint") for c in (EPOCH, BATCH)})

    def _touched(self, log: DataFrame, how: str) -> DataFrame:
        """Base rows in (``left_semi``) or outside (``left_anti``) the partitions of the log."""
        parts = log.select(F.col(self.part).alias("_touched")).distinct()
        return self._load(self.base).join(parts, F.col(self.part).eqNullSafe(F.col("_touched")), how)

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys]
        version = F.struct(EPOCH, BATCH)
        best = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), version).alias("_row"))
        return best.select(*[F.col(c) if c in self.keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])

    def fold(self) -> list[str]:
        """Fold the log into the base; the names of the partitions that were written anew."""
        store, folders = self.store, self._folders()
        if not folders:
            return []
        log = self._load(self.log, folders)
        rows = log.unionByName(self._touched(log, "left_semi")) if store._children(self.base) else log
        new = store._aside(self._newest(rows), [self.part])
        store.make(self.folding)
        done = []
        for child, full in store._children(new):
            if not child.startswith(f"{self.part}="):
                continue
            target = f"{self.base}/{child}"
            old = store.files(target)
            for file in store.files(full):
                store._move(file, f"{target}/{file.rsplit('/', 1)[-1]}")
            for file in old:
                store.drop(file)
            done.append(child)
        for folder in folders:
            store.drop(folder)
        store.drop(self.folding)
        store.drop(new)
        return sorted(done)

    def read(self) -> DataFrame:
        """The newest row of each key. Only partitions that the log touches are compared, unless a fold was cut short."""
        folders, has_base = self._folders(), bool(self.store._children(self.base))
        if not folders:
            rows = self._load(self.base)
            whole = self._newest(rows) if self.store._there(self.folding) else rows
        else:
            log = self._load(self.log, folders)
            if not has_base:
                whole = self._newest(log)
            elif self.store._there(self.folding):
                whole = self._newest(log.unionByName(self._load(self.base)))
            else:
                whole = self._newest(log.unionByName(self._touched(log, "left_semi"))).unionByName(self._touched(log, "left_anti"))
        return whole.drop(EPOCH, BATCH)
