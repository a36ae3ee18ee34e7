"""Bronze readers: explicit schemas, source columns untouched, lineage stamped."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from wardlake.operators import audit
from wardlake.schemas import FEEDS
from wardlake.sources.tables import TableStore

CORRUPT = "_corrupt"
LINEAGE = ["_ingest_ts", "_ingest_date", "_source_file", "_run_id"]


def with_lineage(df: DataFrame, run_id: str, ingest_ts: datetime | None = None) -> DataFrame:
    """Stamp load time, load date, source file and run id on rows read from files."""
    ts = F.lit(ingest_ts).cast("timestamp") if ingest_ts else F.current_timestamp()
    return df.withColumns({
        "_ingest_ts": ts,
        "_ingest_date": F.to_date(ts),
        "_source_file": F.col("_metadata.file_path"),
        "_run_id": F.lit(run_id),
    })


def read_csv(spark: SparkSession, path: str, schema: str,
             multiline: bool = True) -> DataFrame:
    """Header CSV with doubled quotes. Values stay text; typing happens in Silver.

    ``multiline`` allows line breaks inside quotes but makes each file one task;
    switch it off for feeds without them so that big files split.
    """
    return (
        _reader(spark, schema).option("header", True).option("multiLine", multiline)
        .option("escape", '"').option("enforceSchema", False).csv(path)
    )


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _reader(spark, schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _reader(spark, schema).option("multiLine", True).json(path)


def _reader(spark: SparkSession, schema: str) -> DataFrameReader:
    """Rows that can not be read keep their text in ``_corrupt``, which is NULL for others."""
    return spark.read.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def readable(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(rows: DataFrame) -> DataFrame:
    """Rows that could not be read: their text, what could be read of them as JSON, and their lineage."""
    parsed = [c for c in rows.columns if c not in (*LINEAGE, CORRUPT)]
    return rows.where(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("body"), F.to_json(F.struct(*parsed)).alias("readable"),
        F.lit("row_readable").alias("_rejected_rule"), *LINEAGE)


def csv_feeds(spark: SparkSession, paths: dict[str, str], store: TableStore, run_id: str,
              schemas: dict[str, str] | None = None,
              ingest_ts: datetime | None = None, multiline: bool = True) -> list[str]:
    """One append-only Bronze table ``synthea_<feed>`` per CSV feed; ``multiline`` as in ``read_csv``."""
    known = schemas or FEEDS
    names = []
    for feed, path in sorted(paths.items()):
        rows = with_lineage(read_csv(spark, path, known[feed.lower()], multiline), run_id, ingest_ts)
        names.append(_deliver(store, rows, f"synthea_{feed.lower()}", run_id))
    return names


def _deliver(store: TableStore, rows: DataFrame, name: str, run_id: str, snapshot: bool = False) -> str:
    """Put a delivery into a Bronze table and its malformed rows into quarantine, and log both under the run.

    A delivery has one load date, so its readable rows have one target folder and need no shuffle.
    """
    with audit.run(store, "ingest", run_id):
        good, bad = audit.Watch(), audit.Watch()
        with audit.logged(store, "bronze", name) as entry:
            store.append(malformed(rows), f"quarantine/bronze/{name}", ["_ingest_date"], bad)
            if snapshot:
                store.overwrite(readable(rows), name, None, good)
            else:
                store.append(readable(rows), name, ["_ingest_date"], good, gather=False)
            counts = dict(rows_read=good["rows"] + bad["rows"], rows_written=good["rows"], rows_rejected=bad["rows"])
        audit.record(store, [entry | counts | dict(finished_at=audit.now())])
    return name


def claims(spark: SparkSession, path: str, store: TableStore, run_id: str,
           ingest_ts: datetime | None = None) -> str:
    rows = with_lineage(read_jsonl(spark, path, FEEDS["claims"]), run_id, ingest_ts)
    return _deliver(store, rows, "claims_raw", run_id)


def providers(spark: SparkSession, path: str, store: TableStore, run_id: str,
              ingest_ts: datetime | None = None) -> str:
    """The registry is a full snapshot, so it replaces the table."""
    rows = with_lineage(read_json_array(spark, path, FEEDS["providers"]), run_id, ingest_ts)
    return _deliver(store, rows, "provider_registry", run_id, snapshot=True)


def vitals(spark: SparkSession, path: str, store: TableStore, run_id: str,
           ingest_ts: datetime | None = None) -> str:
    rows = with_lineage(read_jsonl(spark, path, FEEDS["vitals"]), run_id, ingest_ts)
    return _deliver(store, rows, "vitals_stream", run_id)
