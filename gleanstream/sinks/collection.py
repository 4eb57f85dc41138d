"""Appending to the posting collection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gleanstream.schemas import POSTING_FIELDS
from gleanstream.sources.collection import batch_path
from gleanstream.sources.ranges import merged_ranges


def append_batch(postings: DataFrame, postings_dir: str, stream_id: str, batch_id: int) -> int:
    """Store one micro-batch and return how many rows it has.

    The batch has its own folder, so a replay after a crash replaces itself
    instead of adding copies. A batch that has been merged into a range is stored there already
    and is not written again. The rows are counted in the pass that writes them.
    """
    return append_observed(postings, postings_dir, stream_id, batch_id)["records"]


def append_observed(
    postings: DataFrame, postings_dir: str, stream_id: str, batch_id: int,
    metrics: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """The same, with more aggregates of what is written, taken in the same pass."""
    wanted = {"records": F.count(F.lit(1)), **(metrics or {})}
    if any(one.holds(stream_id, batch_id) for one in merged_ranges(postings.sparkSession, postings_dir)):
        return postings.agg(*(column.alias(name) for name, column in wanted.items())).first().asDict()
    seen = Observation()
    postings.observe(seen, *(column.alias(name) for name, column in wanted.items())).select(
        *POSTING_FIELDS).write.mode("overwrite").parquet(batch_path(postings_dir, stream_id, batch_id))
    return dict(seen.get)
