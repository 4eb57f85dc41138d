"""Merging the folders of settled batches into few large files, under readers and replays.

A stream never repeats a batch once it has begun a later one, so all its batches but the last are
settled. Settled batches that follow one another become one range: their rows are written to a new
folder, without a shuffle, and a new list of ranges takes its place by one rename. Until then readers
see the batches, from then on the range; a reader that began before keeps its files, because
:func:`clear_merged` removes what a list replaced only when that list is old enough.

A range is merged again with the range before it when it has grown to that one's size. So every row
is rewritten about log(n) times in the life of a collection, and a stream has about log(n) ranges.
A batch that lies in a range is never stored again: see :func:`gleanstream.sinks.collection.append_batch`.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from gleanstream.sinks.claims import put_if_absent, remove
from gleanstream.sinks.refresh_log import RefreshLog
from gleanstream.sources.collection import STORED, batch_path, read_ranges
from gleanstream.sources.ranges import (
    MERGED, RANGE_FIELDS, Range, files_of, list_numbers, list_path, names_in, read_list,
)

#: Size a merged file should have.
FILE_BYTES = 128 * 2**20
#: Seconds that what was replaced stays readable.
KEEP_SECONDS = 24 * 3600
#: Batch folders that one read is given.
_PATHS_AT_ONCE = 20_000


class OtherCompaction(Exception):
    """Another compaction of the same folder was quicker; nothing was changed by this one."""


def stored_batches(spark: SparkSession, root: str) -> dict[str, list[int]]:
    """Ids of the batch folders of each stream, in order; from their names alone."""
    found = {}
    for stream in names_in(spark, root):
        if stream.startswith("stream_id="):
            found[stream.removeprefix("stream_id=")] = sorted(
                int(name.removeprefix("batch_id=")) for name in names_in(spark, f"{root}/{stream}")
                if name.startswith("batch_id="))
    return found


def _islands(batches: Iterable[int]) -> list[tuple[int, int]]:
    """Ids in order as (first, last) of each stretch without a gap."""
    found: list[tuple[int, int]] = []
    for batch in batches:
        if found and found[-1][1] + 1 == batch:
            found[-1] = (found[-1][0], batch)
        else:
            found.append((batch, batch))
    return found


def _size(spark: SparkSession, path: str) -> int:
    files, place = files_of(spark, path)
    return files.getContentSummary(place).getLength()


def _settled(
    batches: dict[str, list[int]], ranges: tuple[Range, ...],
    covered: Iterable[tuple[str, int, int]] | None,
) -> list[tuple[str, int, int]]:
    """Stretches of batches that can be merged: not merged yet, not the last of a stream, covered."""
    covers = None if covered is None else [tuple(one) for one in covered]
    found = []
    for stream, ids in batches.items():
        held = [one for one in ranges if one.stream_id == stream]
        spans = None if covers is None else [one for one in covers if one[0] == stream]
        free = [
            batch for batch in ids[:-1]
            if not any(one.first <= batch <= one.last for one in held)
            and (spans is None or any(first <= batch <= last for _, first, last in spans))]
        found += [(stream, first, last) for first, last in _islands(free)]
    return found


def _rows(spark: SparkSession, root: str, stream: str, batches: range, olds: list[Range]) -> DataFrame:
    """Rows of batch folders and of older ranges."""
    found = None
    for start in range(0, len(batches), _PATHS_AT_ONCE):
        paths = [batch_path(root, stream, batch) for batch in batches[start:start + _PATHS_AT_ONCE]]
        part = spark.read.schema(STORED).option("basePath", root).parquet(*paths)
        found = part if found is None else found.unionByName(part)
    return found.unionByName(read_ranges(spark, root, olds)) if olds else found


def compact(
    spark: SparkSession, root: str, covered: Iterable[tuple[str, int, int]] | None = None,
    file_bytes: int = FILE_BYTES, at_least: int = 2,
) -> tuple[Range, ...]:
    """Merge the settled batches below ``root``; returns the ranges that were written.

    With ``covered`` (stream, first, last), only batches inside are merged: those whose refresh is
    logged, in the folder of a published snapshot. Stretches of fewer than ``at_least`` batches wait.
    Nothing to do, an empty folder and a folder that does not exist give no ranges. What a
    compaction that died has written is not in any list, and is never read.
    """
    numbers = list_numbers(spark, root)
    number = numbers[0] if numbers else 0
    ranges = list(read_list(spark, root, number)) if numbers else []
    written = []
    for stream, first, last in _settled(stored_batches(spark, root), tuple(ranges), covered):
        if last - first + 1 < at_least:
            continue
        size = sum(_size(spark, batch_path(root, stream, batch)) for batch in range(first, last + 1))
        begin, olds = first, []
        while True:  # the ranges before, as long as they are not larger than what is in hand
            before = next((one for one in ranges if one.holds(stream, begin - 1)), None)
            if before is None or before.size > size:
                break
            ranges.remove(before)
            olds.append(before)
            begin, size = before.first, size + before.size
        folder = f"range={begin}-{last}-{uuid.uuid4().hex}"
        files = max(1, -(-size // file_bytes))
        _rows(spark, root, stream, range(first, last + 1), olds).coalesce(files).write.parquet(
            f"{root}/{MERGED}/{folder}")
        one = Range(stream, begin, last, folder, max(1, _size(spark, f"{root}/{MERGED}/{folder}")))
        ranges.append(one)
        written.append(one)
    if written:
        _switch(spark, root, number + 1, ranges)
    return tuple(one for one in written if one in ranges)


def _switch(spark: SparkSession, root: str, number: int, ranges: list[Range]) -> None:
    """Make these the ranges that count, unless another compaction has made a list of that number."""
    stage = f"{root}/{MERGED}/unlisted-{uuid.uuid4().hex}"
    spark.createDataFrame([tuple(one) for one in ranges], RANGE_FIELDS).coalesce(1).write.parquet(stage)
    if not put_if_absent(spark, stage, list_path(root, number)):
        raise OtherCompaction(f"list {number} of {root} is there already")


def _age(spark: SparkSession, path: str) -> float:
    files, place = files_of(spark, path)
    return time.time() - files.getFileStatus(place).getModificationTime() / 1000


def clear_merged(spark: SparkSession, root: str, keep_seconds: float = KEEP_SECONDS) -> int:
    """Delete what lists older than ``keep_seconds`` have replaced; returns the folders deleted.

    These are the batch folders that lie in a range of the newest such list, earlier lists, and
    merged folders that no list from that one on names. ``keep_seconds`` must be longer than any
    reader, or write of a replayed batch, takes.
    """
    numbers = list_numbers(spark, root)
    settled = next((number for number in numbers if _age(spark, list_path(root, number)) >= keep_seconds), None)
    if settled is None:
        return 0
    ranges = read_list(spark, root, settled)
    named = {one.folder for number in numbers if number >= settled for one in read_list(spark, root, number)}
    gone = [
        batch_path(root, stream, batch) for stream, ids in stored_batches(spark, root).items()
        for batch in ids if any(one.holds(stream, batch) for one in ranges)]
    for name in names_in(spark, f"{root}/{MERGED}"):
        path = f"{root}/{MERGED}/{name}"
        if name.startswith("list="):
            if int(name.removeprefix("list=")) < settled:
                gone.append(path)
        elif name not in named and _age(spark, path) >= keep_seconds:
            gone.append(path)
    for path in gone:
        remove(spark, path)
    return len(gone)


def compact_store(spark: SparkSession, store: str, keep_seconds: float = KEEP_SECONDS) -> dict[str, int]:
    """Merge and clear a store's postings and the rows of its incremental snapshot.

    A consumer may go on meanwhile. Returns the folders deleted below each.
    """
    covered = [tuple(row) for row in RefreshLog(spark, f"{store}/refreshes").covered().collect()]
    compact(spark, f"{store}/postings")
    compact(spark, f"{store}/published/rows", covered)
    return {name: clear_merged(spark, f"{store}/{name}", keep_seconds) for name in ("postings", "published/rows")}
