"""Sinks: committed batches, store split by type, keyed upserts.

A micro-batch writes only into folders named by its batch id, in overwrite
mode. It counts from the moment its mark is there: one small file under the
job's output that holds the number of the last whole batch and is replaced in
one rename after everything else has been written. Readers take marked
batches only, so what a crash left half-written is never seen, and the batch
that is run again replaces it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.session import delete_path

# Partition column of the store by type: a copy of the type that keeps null and empty apart.
TYPE_FOLDER = "type_folder"
# File under a job's output that holds the number of its last whole batch.
MARK = "_committed"
# Versions of a keyed state that stay for readers that have just opened them.
KEEP_VERSIONS = 3


def committed(spark: SparkSession, out: str) -> int | None:
    """The last batch that is whole under ``out``; None before the first."""
    jvm = spark._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{out}/{MARK}")
    fs = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(mark):
        return None
    stream = fs.open(mark)
    try:
        return int(stream.readUTF())
    finally:
        stream.close()


def commit(spark: SparkSession, out: str, batch_id: int) -> None:
    """Mark ``batch_id`` as whole. Call it last: the mark is written aside and renamed over the old one."""
    jvm = spark._jvm
    mark, aside = (jvm.org.apache.hadoop.fs.Path(f"{out}/{name}") for name in (MARK, f"{MARK}.next"))
    fs = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(aside, True)
    stream.writeUTF(str(batch_id))
    stream.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(aside), fs.makeQualified(mark), overwrite)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: list[str] | None = None) -> None:
    """Write one micro-batch's rows under ``path/batch_id=N`` (overwrite = idempotent)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/batch_id={batch_id}")


def read_batch(spark: SparkSession, path: str, *batches: int) -> DataFrame:
    """Rows that the named batches wrote, with ``batch_id``; a missing batch is an error."""
    return spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={b}" for b in batches])


def read_output(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Rows that whole batches wrote to the output ``name`` of the job under ``out``, with ``batch_id``."""
    last = committed(spark, out)
    if last is None:
        raise RuntimeError(f"no batch is committed under {out}")
    # The schema is a whole batch's: folders that are not marked may hold anything.
    schema = read_batch(spark, f"{out}/{name}", last).schema
    return spark.read.schema(schema).parquet(f"{out}/{name}").where(F.col("batch_id") <= last)


def expire_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Delete what a batch wrote; a batch that is not there is fine."""
    delete_path(spark, f"{path}/batch_id={batch_id}")


def type_folder(type_: Column) -> Column:
    """Folder name of a type. The prefix keeps ``01`` a text, and an empty type apart from none."""
    return F.coalesce(F.concat(F.lit("type_"), type_), F.lit("none"))


def by_type(df: DataFrame) -> DataFrame:
    return df.withColumn(TYPE_FOLDER, type_folder(F.col("type")))


def write_by_type(df: DataFrame, path: str, mode: str = "overwrite",
                  max_records_per_file: int = 5_000_000) -> None:
    """Store records separately by type: one folder per type value; ``type`` stays a data column.

    No shuffle on type first: types are few and one may hold a large share of
    the rows, so each task writes its own rows (at most one open file per
    type), with files capped in size.
    """
    (by_type(df).write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(TYPE_FOLDER).parquet(path))


def read_by_type(spark: SparkSession, path: str, type_: str | None) -> DataFrame:
    """Records of one type (None: without a type), read from its folder alone."""
    folder = type_folder(F.lit(type_).cast("string"))
    return spark.read.parquet(path).where(F.col(TYPE_FOLDER) == folder).drop(TYPE_FOLDER)


def upsert(df: DataFrame, path: str, key: str, batch_id: int) -> None:
    """Keyed upserts: the state of the batch before and this batch's rows, the latest row of each key
    (by ``batch_id``; of one batch's rows any one fixed row), written as the state of this batch.

    A new state is written beside the old one and counts when the job marks the batch. One grouping with
    map-side combine; its cost follows the keys that are stored.
    """
    spark = df.sparkSession
    rows = df.withColumn("upto", F.lit(batch_id).cast("long"))
    if batch_id:
        try:
            before = spark.read.parquet(f"{path}/version={batch_id - 1}")
        except AnalysisException as err:
            raise RuntimeError(f"state of batch {batch_id - 1} under {path} is missing or unreadable; "
                               f"batch {batch_id} cannot go on without it") from err
        rows = rows.unionByName(before)
    whole = F.struct("upto", *[c for c in rows.columns if c not in ("upto", key)])
    latest = rows.groupBy(key).agg(F.max(whole).alias("row")).select(key, "row.*")
    latest.select(*rows.columns).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
    delete_path(spark, f"{path}/version={batch_id - KEEP_VERSIONS}")


def read_latest(spark: SparkSession, out: str, name: str) -> DataFrame | None:
    """Current rows of the keyed state ``name`` of the job under ``out``: the state of its last whole batch;
    None before the first."""
    last = committed(spark, out)
    return None if last is None else spark.read.parquet(f"{out}/{name}/version={last}").drop("upto")
