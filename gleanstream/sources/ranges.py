"""Which batches of a folder of batches have been merged, and where their rows are now.

Below a folder of batches, ``_merged/list=N`` is a small table of ranges: the batches from ``first``
to ``last`` of a stream are in ``folder``. The newest list counts, as a whole, so one rename takes
readers from the batch folders to the merged ones. Spark's scans of the batches pass over names that
begin with an underscore.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MERGED = "_merged"
RANGE_FIELDS = "stream_id string, first bigint, last bigint, folder string, size bigint"


class Range(NamedTuple):
    stream_id: str
    first: int
    last: int
    folder: str
    size: int

    def holds(self, stream_id: str, batch_id: int) -> bool:
        return self.stream_id == stream_id and self.first <= batch_id <= self.last


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, place = files_of(spark, path)
    return [one.getPath().getName() for one in files.listStatus(place)] if files.exists(place) else []


def list_path(root: str, number: int) -> str:
    return f"{root}/{MERGED}/list={number}"


def list_numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the lists, newest first."""
    return sorted((int(name.removeprefix("list=")) for name in names_in(spark, f"{root}/{MERGED}")
                   if name.startswith("list=")), reverse=True)


def read_list(spark: SparkSession, root: str, number: int) -> tuple[Range, ...]:
    rows = spark.read.schema(RANGE_FIELDS).parquet(list_path(root, number)).collect()
    return tuple(sorted(Range(*row) for row in rows))


def merged_ranges(spark: SparkSession, root: str) -> tuple[Range, ...]:
    """The newest list: a few ranges a stream."""
    numbers = list_numbers(spark, root)
    return read_list(spark, root, numbers[0]) if numbers else ()


def in_ranges(ranges: tuple[Range, ...]) -> Column:
    """Whether a stored row belongs to one of the ranges; on batch folders this prunes folders."""
    return reduce(lambda one, other: one | other, [
        (F.col("stream_id") == one.stream_id) & F.col("batch_id").between(one.first, one.last)
        for one in ranges], F.lit(False))
