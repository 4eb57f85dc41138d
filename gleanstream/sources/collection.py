"""Reading the posting collection back.

A collection is a folder for each batch, and merged folders for ranges of settled batches. A reader
takes the list of ranges first and then the batches outside them, so it sees every batch once
while a compaction runs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gleanstream.schemas import POSTING
from gleanstream.sources.ranges import MERGED, Range, in_ranges, merged_ranges

STORED = T.StructType([
    *POSTING.fields,
    T.StructField("stream_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])


def read_ranges(spark: SparkSession, root: str, ranges: Iterable[Range]) -> DataFrame:
    """The rows of merged folders."""
    return spark.read.schema(STORED).parquet(*[f"{root}/{MERGED}/{one.folder}" for one in ranges])


def read_collection(spark: SparkSession, postings_dir: str) -> DataFrame:
    """Every stored posting; ``stream_id`` and ``batch_id`` tell where it came from."""
    ranges = merged_ranges(spark, postings_dir)
    batches = spark.read.schema(STORED).parquet(postings_dir)
    if not ranges:
        return batches
    return batches.where(~in_ranges(ranges)).unionByName(read_ranges(spark, postings_dir, ranges))


def read_batches(
    spark: SparkSession, postings_dir: str, batches: Iterable[tuple[str, int]]
) -> DataFrame:
    """Some batches, without listing the rest of the collection."""
    batches = tuple(batches)
    ranges = merged_ranges(spark, postings_dir)
    wanted = [(one, [batch for batch in batches if one.holds(*batch)]) for one in ranges]
    wanted = [(one, held) for one, held in wanted if held]
    merged = {batch for _, held in wanted for batch in held}
    paths = [batch_path(postings_dir, *batch) for batch in batches if batch not in merged]
    if paths:
        found = spark.read.schema(STORED).option("basePath", postings_dir).parquet(*paths)
    else:
        found = spark.createDataFrame([], STORED)
    for one, held in wanted:  # merged folders keep batches together, so files are skipped by statistics
        only = in_ranges(tuple(one._replace(first=batch, last=batch) for _, batch in held))
        found = found.unionByName(read_ranges(spark, postings_dir, [one]).where(only))
    return found


def batch_path(root: str, stream_id: str, batch_id: int) -> str:
    return f"{root}/stream_id={stream_id}/batch_id={batch_id}"
