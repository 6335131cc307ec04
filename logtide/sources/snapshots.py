"""Polled dimension as a stream: a Python data source over numbered snapshots.

A snapshot is a folder ``version=N`` of Parquet files (area, countries) under one path; N grows.
Each trigger polls the folder names; the offset is the number of the newest snapshot, so the
checkpoint of the query that reads it says which snapshots it has taken, and a restart goes on
from there. A snapshot without rows moves the offset and brings none.

    spark.dataSource.register(SnapshotSource)
    spark.readStream.format("area_snapshots").option("path", folder).load()
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "area_snapshots"
SCHEMA = "version long, area string, countries string"


class SnapshotSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return SnapshotReader(self.options["path"])


class SnapshotReader(DataSourceStreamReader):
    """Offsets are {"version": N}: all snapshots up to N; -1 before the first."""

    def __init__(self, path: str):
        self.path = path
        self._last = -1

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def _versions(self) -> list[int]:
        """Numbers of the snapshots that are whole: Spark's writer leaves ``_SUCCESS`` last."""
        store, root = self._store()
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        numbers = [int(m[1]) for x in found if (m := re.fullmatch(r"version=(\d+)", x.base_name))]
        done = store.get_file_info([f"{root}/version={n}/_SUCCESS" for n in numbers]) if numbers else []
        return sorted(n for n, x in zip(numbers, done, strict=True) if x.type == fs.FileType.File)

    def initialOffset(self) -> dict:
        return {"version": -1}

    def latestOffset(self) -> dict:
        self._last = max([self._last, *self._versions()])
        return {"version": self._last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._last = max(self._last, end["version"])
        return [InputPartition(n) for n in self._versions() if start["version"] < n <= end["version"]]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import pyarrow.dataset as ds

        store, root = self._store()
        files = [x.path for x in store.get_file_info(fs.FileSelector(f"{root}/version={partition.value}"))
                 if x.type == fs.FileType.File and x.base_name.endswith(".parquet")]
        if not files:
            return
        for batch in ds.dataset(files, filesystem=store, format="parquet").to_batches(columns=["area", "countries"]):
            for row in batch.to_pylist():
                yield partition.value, row["area"], row["countries"]


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Streaming (version, area, countries) rows of the snapshots under ``path``, polled at every trigger."""
    spark.dataSource.register(SnapshotSource)
    return spark.readStream.format(FORMAT).option("path", path).load()
