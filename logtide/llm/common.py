"""Helpers shared by the training-data operators: shared-folder tables, sessions, token separators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.session import checkpointed
from logtide.sources.tables import read_table

#: Characters that part words: space and the control characters tab to carriage return.
SEPARATORS = " \t\n\x0b\x0c\r"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Columns of the documents table at ``sf_dir``."""
    return read_table(spark, sf_dir, "documents", *columns)


def text_of(column: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the session's shared folder and read back: lineage ends in files
    that every executor sees, so work lost with an executor is never redone from the source."""
    return checkpointed(df, name)


def with_python(spark: SparkSession) -> None:
    """Let Python workers import this package when only the driver's ``sys.path`` holds it."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, _ROOT])


@contextmanager
def arrow_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """For jobs run within it, Arrow batches for Python end at ``most`` bytes (and the row that reaches them): wide
    rows of a task don't stand whole in the JVM's buffers and the worker's."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fold_ratio(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``; a null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus




def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table doesn't have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
