"""Merging stored batches while they are read, replayed and published."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from gleanstream.schemas import POSTING_FIELDS
from gleanstream.sinks import compaction
from gleanstream.sinks import snapshot as snap
from gleanstream.sinks.collection import append_batch
from gleanstream.sources.collection import STORED, batch_path, read_batches, read_collection
from gleanstream.sources.ranges import list_numbers, merged_ranges
from test_streaming import batch, consumer, published


def rows_of(frame):
    return sorted((r["stream_id"], r["batch_id"], r["SearchWord"] or "") for r in frame.collect())


def posts(spark, *words):
    return spark.createDataFrame([(word,) for word in words], "word string").select(
        *[F.col("word").alias(name) for name in POSTING_FIELDS])


def fill(spark, root, stream, count):
    """``count`` batches of one to three rows, in one write."""
    spark.range(count * 2).select(
        *[F.concat(F.lit("w"), F.col("id")).alias(name) for name in POSTING_FIELDS],
        F.lit(stream).alias("stream_id"), (F.col("id") % count).alias("batch_id"),
    ).repartition(4, "batch_id").write.mode("append").partitionBy("stream_id", "batch_id").parquet(root)


def parquet_files(root):
    return [name for folder, _, names in os.walk(root) for name in names if name.endswith(".parquet")]


def test_ranges_hold_the_same_rows(spark, tmp_path):
    root = str(tmp_path / "postings")
    for number in range(6):
        append_batch(posts(spark, f"a{number}", f"b{number}"), root, "s", number)
    append_batch(posts(spark, "t0"), root, "t", 0)
    append_batch(posts(spark).limit(0), root, "t", 1)
    append_batch(posts(spark, "t2"), root, "t", 2)
    before = rows_of(read_collection(spark, root))

    written = compaction.compact(spark, root)
    # the last batch of a stream may still be replayed
    assert [(one.stream_id, one.first, one.last) for one in written] == [("s", 0, 4), ("t", 0, 1)]
    assert rows_of(read_collection(spark, root)) == before
    assert rows_of(read_batches(spark, root, [("s", 1), ("s", 5), ("t", 0)])) == [
        row for row in before if row[:2] in {("s", 1), ("s", 5), ("t", 0)}]
    # nothing more to do
    assert compaction.compact(spark, root) == ()
    assert list_numbers(spark, root) == [1]

    # batch folders go when the list is old enough, and not before
    assert compaction.clear_merged(spark, root) == 0
    assert compaction.clear_merged(spark, root, 0) == 7
    assert not os.path.exists(batch_path(root, "s", 4)) and os.path.exists(batch_path(root, "s", 5))
    assert rows_of(read_collection(spark, root)) == before


def test_a_replay_inside_a_range_adds_nothing(spark, tmp_path):
    root = str(tmp_path / "postings")
    for number in range(3):
        append_batch(posts(spark, f"a{number}"), root, "s", number)
    compaction.compact(spark, root)
    compaction.clear_merged(spark, root, 0)
    before = rows_of(read_collection(spark, root))
    assert append_batch(posts(spark, "a1"), root, "s", 1) == 1
    assert rows_of(read_collection(spark, root)) == before
    # a batch outside still replaces itself
    append_batch(posts(spark, "z2"), root, "s", 2)
    assert rows_of(read_collection(spark, root)) == [*before[:2], ("s", 2, "z2")]


def test_ranges_grow_by_size(spark, tmp_path):
    root = str(tmp_path / "postings")
    before, number = [], 0
    for _ in range(9):
        for _ in range(2):
            append_batch(posts(spark, f"a{number}"), root, "s", number)
            number += 1
        compaction.compact(spark, root, at_least=1)
        ranges = merged_ranges(spark, root)
        assert [one.first for one in ranges] == [0, *[one.last + 1 for one in ranges[:-1]]]
        before.append(len(ranges))
    assert ranges[-1].last == number - 2
    assert max(before) <= 5
    assert len(rows_of(read_collection(spark, root))) == number


def test_only_one_of_two_compactions_counts(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "postings")
    for number in range(4):
        append_batch(posts(spark, f"a{number}"), root, "s", number)
    before, rows = rows_of(read_collection(spark, root)), compaction._rows

    def slow(*args):
        monkeypatch.setattr(compaction, "_rows", rows)
        compaction.compact(spark, root)
        return rows(*args)

    monkeypatch.setattr(compaction, "_rows", slow)
    with pytest.raises(compaction.OtherCompaction):
        compaction.compact(spark, root)
    assert list_numbers(spark, root) == [1]
    assert rows_of(read_collection(spark, root)) == before
    # what the loser wrote is cleared with the rest
    compaction.clear_merged(spark, root, 0)
    assert sum(name.startswith("range=") for name in os.listdir(f"{root}/_merged")) == 1


def test_many_batches_become_few_files_under_a_reader(spark, tmp_path):
    root, count = str(tmp_path / "postings"), 300
    fill(spark, root, "s", count)
    early, seen, done = read_collection(spark, root), [], threading.Event()

    def read():
        while not done.is_set():
            seen.append(read_collection(spark, root).count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        compaction.compact(spark, root)
        assert early.count() == 2 * count  # a plan from before the switch keeps its files
    finally:
        done.set()
        reader.join()
    assert set(seen) == {2 * count}
    compaction.clear_merged(spark, root, 0)
    assert len(parquet_files(f"{root}/_merged")) <= 3
    assert len(parquet_files(root)) <= 5
    assert read_collection(spark, root).count() == 2 * count


def test_published_rows_and_pending_batches(spark, tmp_path):
    root = str(tmp_path)

    class Flaky(snap.IncrementalSnapshot):
        down = False

        def publish(self, rows, refresh):
            if self.down:
                raise OSError("target is down")
            return super().publish(rows, refresh)

    flaky = Flaky(f"{root}/published")
    job = consumer(root, flaky, stream_id="s")
    for number, word in enumerate("abc"):
        job.process(batch(spark, word), number)
    flaky.down = True
    job.process(batch(spark, "d"), 3)
    job.process(batch(spark, "e"), 4)

    compaction.compact_store(spark, root, keep_seconds=0)
    # postings are merged up to the last batch, published rows only as far as refreshes are logged
    assert [(one.first, one.last) for one in merged_ranges(spark, f"{root}/postings")] == [(0, 3)]
    assert [(one.first, one.last) for one in merged_ranges(spark, f"{root}/published/rows")] == [(0, 1)]
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == ["a", "b", "c"]

    # a new process makes up for what is pending, out of a range; a replay of the last batch too
    again = consumer(root, stream_id="s")
    again.process(batch(spark, "e"), 4)
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == list("abcde")
    again.process(batch(spark, "f"), 5)
    compaction.compact_store(spark, root, keep_seconds=0)
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == list("abcdef")
    assert len(rows_of(read_collection(spark, f"{root}/postings"))) == 6


def test_nothing_to_merge(spark, tmp_path):
    assert compaction.compact(spark, str(tmp_path / "none")) == ()
    assert compaction.clear_merged(spark, str(tmp_path / "none"), 0) == 0
    root = str(tmp_path / "one")
    append_batch(posts(spark, "a"), root, "s", 0)
    assert compaction.compact(spark, root) == ()
    assert read_collection(spark, root).schema == STORED
