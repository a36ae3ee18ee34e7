"""Load audit: what a run's writes wrote and rejected, observed while they wrote, failures included."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardlake.functions import measures as m
from wardlake.operators.dq import RULE, Checked, write_quarantine
from wardlake.schemas import AUDIT, AUDIT_COLUMNS

TABLE = "load_audit"
#: Layer of the one row that stands for a whole run.
RUN = "run"


def _utcnow() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class Run:
    """The run that audit rows belong to, and its clock."""

    run_id: str
    clock: Callable[[], datetime] = _utcnow


_CURRENT: ContextVar[Run | None] = ContextVar("run", default=None)


def now() -> datetime:
    run = _CURRENT.get()
    return _utcnow() if run is None else run.clock()


def record(store, rows: list[dict]) -> None:
    """Append audit rows of the current run; keys missing from a dict are NULL."""
    run = _CURRENT.get()
    stamp = {} if run is None else {"run_id": run.run_id}
    data = [tuple((stamp | r).get(n) for n in AUDIT_COLUMNS) for r in rows]
    store.append(store.spark.createDataFrame(data, AUDIT).coalesce(1), TABLE)


@contextmanager
def logged(store, layer: str, name: str):
    """Times a load; a failure is recorded with its message and raised again."""
    entry = dict(layer=layer, object_name=name, started_at=now(), status="success")
    try:
        yield entry
    except Exception as e:
        record(store, [entry | dict(finished_at=now(), status="failed", error_message=str(e)[:2000])])
        raise


@contextmanager
def run(store, name: str, run_id: str | None = None, clock: Callable[[], datetime] = _utcnow):
    """All loads inside carry one run id; a row of layer ``run`` says how long the run took and how it ended.

    A run inside a run belongs to the outer one.
    """
    if _CURRENT.get() is not None:
        yield _CURRENT.get()
        return
    token = _CURRENT.set(Run(run_id or uuid.uuid4().hex, clock))
    try:
        with logged(store, RUN, name) as entry:
            yield _CURRENT.get()
        record(store, [entry | dict(finished_at=now())])
    finally:
        _CURRENT.reset(token)


class Watch:
    """Aggregates of the rows that a write passes on, taken by the write itself."""

    def __init__(self, **measures: Column) -> None:
        self.seen, self.measures = Observation(), {"rows": F.count(F.lit(1)), **measures}

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *[column.alias(name) for name, column in self.measures.items()])

    def __getitem__(self, name: str) -> int:
        # a plan that is known to give no rows has nothing to observe
        return self.seen.get.get(name) or 0


def observed(store, layer: str, name: str, write: Callable[[Watch], object]) -> int:
    """Run a write that watches its rows, and log how many there were."""
    watch = Watch()
    with logged(store, layer, name) as entry:
        write(watch)
        n = watch["rows"]
    record(store, [entry | dict(rows_written=n, finished_at=now())])
    return n


def observed_overwrite(store, df: DataFrame, layer: str, name: str, parts: list[str] | None = None) -> int:
    """Overwrite a table and log how many rows were written."""
    return observed(store, layer, name, lambda watch: store.overwrite(df, name, parts, watch))


def observed_append(store, df: DataFrame, layer: str, name: str, parts: list[str] | None = None) -> int:
    return observed(store, layer, name, lambda watch: store.append(df, name, parts, watch))


def observed_silver(store, checked: Checked, finish: Callable[[DataFrame], DataFrame], name: str,
                    parts: list[str] | None = None, write: Callable[[DataFrame], int] | None = None) -> dict[str, int]:
    """Write clean rows (through ``finish``) and quarantine; log the rejects of every rule.

    The tagged rows are parsed and written aside once, which counts them by rule; both targets read
    them from there, and clean and rejected rows lie in different partitions. ``write`` puts the finished
    rows into the table and says how many; without it they become the table.
    """
    by_rule = Watch(**{f"r{i}": m.count_where(F.col(RULE) == rule) for i, rule in enumerate(checked.rules)})
    with logged(store, "silver", name) as entry:
        tagged, path = store.stage(by_rule(checked.tagged), [RULE])
        staged = Checked(tagged, checked.rules, checked.at)
        clean, watch = finish(staged.clean), Watch()
        if write is None:
            store.overwrite(clean, name, parts, watch)
            written = watch["rows"]
        else:
            written = write(clean)
        write_quarantine(staged, store, f"quarantine/{name}", whole=True)
        store.drop(path)
    total = by_rule["rows"]
    rejected = {rule: by_rule[f"r{i}"] for i, rule in enumerate(checked.rules)}
    done = entry | dict(finished_at=now(), rows_read=total)
    record(store, [done | dict(rows_written=written, rows_rejected=sum(rejected.values()))]
           + [done | dict(rule=rule, rows_rejected=n) for rule, n in rejected.items()])
    return rejected
