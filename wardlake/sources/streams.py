"""Streaming sources. Every reader yields ``body`` (text) and ``arrival_ts``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """A folder of JSON-lines files, ``max_files`` per trigger, arrival = read time."""
    return (
        spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)
        .select(F.col("value").alias("body"))
        .withColumn("arrival_ts", F.current_timestamp())
    )


def kafka_options(bootstrap: str, topic: str, jaas: str | None = None,
                  starting_offsets: str = "earliest", group_prefix: str | None = None,
                  max_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Reader options for Kafka and for brokers that speak its protocol over SASL.

    The defaults lose nothing: a first start reads the backlog, a trigger takes all there is,
    and offsets that are gone stop the query.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if jaas:
        opts.update({
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": jaas,
        })
    if group_prefix:
        opts["groupIdPrefix"] = group_prefix
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return opts


def read_kafka(spark: SparkSession, opts: dict[str, str]) -> DataFrame:
    """Needs the public ``spark-sql-kafka-0-10`` package on the classpath."""
    raw = spark.readStream.format("kafka").options(**opts).load()
    return raw.select(F.col("value").cast("string").alias("body"),
                      F.col("timestamp").alias("arrival_ts"))


def read_parquet(spark: SparkSession, folder: str, file_glob: str, schema) -> DataFrame:
    """Stream the Parquet files of a folder that match a name pattern."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(folder)
    )
