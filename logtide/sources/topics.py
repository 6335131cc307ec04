"""Message sources: a topic reader and staged files with the same (key, value) shape.

The Kafka connector is not on this image's classpath, so ``read_topic`` is a
thin adapter that is not exercised offline; tests and replays use files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.schemas import MESSAGE_SCHEMA

# Records of a staged file at most.
RECORDS_PER_FILE = 25_000


def read_topic(spark: SparkSession, servers: str, topic: str, group: str | None = None,
               starting_offsets: str = "latest") -> DataFrame:
    """Streaming (key, value) text records from a topic (needs the Kafka connector)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if group:
        reader = reader.option("kafka.group.id", group)
    try:
        loaded = reader.load()
    except Exception as err:  # the connector package is not on the classpath
        raise RuntimeError(
            "topic source needs the spark-sql-kafka-0-10 connector on the classpath "
            "(spark.jars.packages); use read_staged for files") from err
    return loaded.select(F.col("key").cast("string").alias("key"),
                                F.col("value").cast("string").alias("value"))


def read_staged(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (key, value) records from JSON-lines files dropped into ``path``."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def stage(df: DataFrame, path: str) -> None:
    """Append (key, value) records as new compressed files under ``path`` (a topic stand-in).

    Such a file is read by one task, so its records are limited.
    """
    df.select("key", "value").write.mode("append").option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).json(path)
