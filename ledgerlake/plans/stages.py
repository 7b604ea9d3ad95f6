"""Stage tables: frames that several plans read, kept once per session under a name.

`Stages.frame(spark, key, build)` builds a frame the first time and marks it to be
persisted; building runs no job, the first action that reads the frame fills it.
Later calls with an equal key get the very same frame, so nothing is planned, scanned or
kept twice. With `keep=False` the frame is only named: plans that read it compute just the columns
they need, which is less than keeping a wide frame whole. MEMORY_AND_DISK keeps the
lineage: blocks of a lost executor are recomputed. `release` lets them go again, and a frame of a stopped session
is dropped as soon as another session asks.

`Tables` holds frames for one query only: each is written as a compressed table, whose query's shuffle
files go at once, and dropped when it is no longer read. So disk holds a step and its inputs, not the
shuffles of all steps and the same rows several times.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.session import drop_path, scratch_path, shuffles_released


class Stages:
    def __init__(self) -> None:
        self._frames: dict[Hashable, DataFrame] = {}
        self._owner: str | None = None

    def _enter(self, spark: SparkSession) -> None:
        owner = spark.sparkContext.applicationId
        if owner != self._owner:
            self._frames.clear()
            self._owner = owner

    def frame(self, spark: SparkSession, key: Hashable, build: Callable[[], DataFrame], keep: bool = True) -> DataFrame:
        self._enter(spark)
        if key not in self._frames:
            frame = build()
            self._frames[key] = frame.persist(StorageLevel.MEMORY_AND_DISK) if keep else frame
        return self._frames[key]

    def keys(self) -> list[Hashable]:
        return list(self._frames)

    def release(self, spark: SparkSession, key: Hashable | None = None) -> None:
        """Unpersist one stage, or all of them."""
        self._enter(spark)
        for k in [key] if key is not None else self.keys():
            frame = self._frames.pop(k, None)
            if frame is not None:
                frame.unpersist()


class Tables:
    """Tables below the shared checkpoint folder, dropped at the latest when the block ends."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._base = spark, scratch_path(spark, f"steps-{uuid.uuid4().hex}")

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *_) -> None:
        drop_path(self._spark, self._base)

    def write(self, name: str, frame: DataFrame) -> DataFrame:
        with shuffles_released(self._spark):
            frame.write.option("compression", "zstd").parquet(f"{self._base}/{name}")
        return self._spark.read.parquet(f"{self._base}/{name}")

    def drop(self, name: str) -> None:
        drop_path(self._spark, f"{self._base}/{name}")
