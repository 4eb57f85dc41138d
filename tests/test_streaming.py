import threading
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gleanstream.operators import decode
from gleanstream.operators.clean import snapshot, with_search_word
from gleanstream.operators.decode import decode_postings
from gleanstream.plans import inputs
from gleanstream.schemas import POSTING_FIELDS, PUBLISHED
from gleanstream.sinks import log as log_sink
from gleanstream.sinks import snapshot as snap
from gleanstream.sinks.collection import append_batch
from gleanstream.sinks.refresh_log import RefreshLog, read_refresh_log
from gleanstream.sources.collection import read_collection
from gleanstream.sources.log import read_log, stream_log
from gleanstream.streaming.consumer import ListingConsumer, run_until_stopped

N = 1000
MALFORMED = 60


@pytest.fixture
def log(spark, sf, tmp_path):
    path = str(tmp_path / "log")
    rows = inputs.messages(spark, sf).withColumn("topic", F.lit("jobs-data"))
    log_sink.publish_to_log(rows.repartition(4), path)
    return path


class Clock:
    """Second n of a day at the n-th refresh."""

    def __init__(self):
        self.n = 0

    def __call__(self):
        self.n += 1
        return f"2024-01-01 00:00:{self.n:02d}"


def consumer(root, publisher=None, **options):
    return ListingConsumer(
        postings_dir=f"{root}/postings", log_dir=f"{root}/refreshes",
        publisher=publisher or snap.IncrementalSnapshot(f"{root}/published"),
        checkpoint_dir=f"{root}/checkpoint", **{"query_at": Clock(), **options})


def drain(spark, log, job, files=2):
    query = job.start(stream_log(spark, log, files_per_batch=files), until_drained=True)
    query.awaitTermination()
    return query


def published(spark, root):
    return snap.read_published(spark, f"{root}/published", f"{root}/refreshes")


def refreshes(spark, root):
    rows = read_refresh_log(spark, f"{root}/refreshes").orderBy("refreshed_at").collect()
    return [(r["batch_id"], r["status"], r["records"]) for r in rows]


@pytest.mark.parametrize("kind", ["incremental", "full"])
def test_batches_restart_and_snapshot(spark, sf, log, tmp_path, kind):
    root = str(tmp_path)

    def publisher():
        if kind == "full":
            return snap.FullSnapshot(f"{root}/published")
        return snap.IncrementalSnapshot(f"{root}/published")

    drain(spark, log, consumer(root, publisher()))
    postings = read_collection(spark, f"{root}/postings")
    assert postings.count() == N
    assert sorted(r["batch_id"] for r in postings.select("batch_id").distinct().collect()) == [0, 1]
    assert postings.where("SearchWord IS NULL").count() == MALFORMED
    assert [status for _, status, _ in refreshes(spark, root)] == ["ok", "ok"]
    assert sum(n for _, _, n in refreshes(spark, root)) == N

    rows = published(spark, root)
    assert rows.columns == PUBLISHED.names
    assert rows.count() == N - MALFORMED
    assert [r[0] for r in rows.select("QueryAt").distinct().collect()] == ["2024-01-01 00:00:02"]
    want = snapshot(postings, "2024-01-01 00:00:02")
    assert rows.exceptAll(want).count() == 0 and want.exceptAll(rows).count() == 0

    # a restart finds nothing new and changes nothing
    drain(spark, log, consumer(root, publisher()))
    assert read_collection(spark, f"{root}/postings").count() == N
    assert len(refreshes(spark, root)) == 2

    # new messages are one more batch of the same stream
    rows = inputs.messages(spark, sf).withColumn("topic", F.lit("jobs-data"))
    log_sink.publish_to_log(rows, log)
    drain(spark, log, consumer(root, publisher(), query_at=lambda: "2024-01-02 00:00:00"))
    assert read_collection(spark, f"{root}/postings").count() == 2 * N
    rows = published(spark, root)
    assert rows.count() == 2 * (N - MALFORMED)
    assert [r[0] for r in rows.select("QueryAt").distinct().collect()] == ["2024-01-02 00:00:00"]


def batch(spark, *words):
    text = ",".join(f'"{name}":"x"' for name in (
        "Job", "Company", "Salary", "Location", "Deadline", "JobDetails", "Created"))
    return spark.createDataFrame(
        [("name", f'{{"SearchKeyWord":"{w}",{text}}}' if w else "bad", 0, i) for i, w in enumerate(words)],
        "key string, value string, partition int, offset bigint")


def test_replay_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    job = consumer(root, stream_id="s")
    for batch_id, words in ((0, "ab"), (0, "ab"), (1, "c"), (1, "c")):
        job.process(batch(spark, *words), batch_id)
    # as after a crash: a new process gets batch 1 again
    consumer(root, stream_id="s").process(batch(spark, "c"), 1)
    assert read_collection(spark, f"{root}/postings").count() == 3
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == ["a", "b", "c"]
    assert [r[0] for r in refreshes(spark, root)] == [0, 1]


def test_two_streams_share_a_collection(spark, tmp_path):
    root = str(tmp_path)
    consumer(root, stream_id="s").process(batch(spark, "a"), 0)
    consumer(root, stream_id="t").process(batch(spark, "b"), 0)
    assert read_collection(spark, f"{root}/postings").count() == 2
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == ["a", "b"]


def test_empty_and_malformed_batches(spark, tmp_path):
    root = str(tmp_path)
    job = consumer(root, stream_id="s")
    job.process(batch(spark, "a").where("false"), 0)
    job.process(batch(spark, None, None), 1)
    job.process(batch(spark, "a", None), 2)
    assert [r[2] for r in refreshes(spark, root)] == [0, 2, 2]
    assert read_collection(spark, f"{root}/postings").count() == 4
    assert [r["SearchWord"] for r in published(spark, root).collect()] == ["a"]


class Failing(snap.IncrementalSnapshot):
    def __init__(self, published_dir, fails):
        super().__init__(published_dir)
        self.fails = fails

    def publish(self, rows, refresh):
        if refresh.batch_id in self.fails:
            raise OSError("target is down")
        return super().publish(rows, refresh)


def test_publish_failure(spark, tmp_path):
    """The append is kept, the error is recorded, the next refresh makes up for it."""
    root = str(tmp_path)
    job = consumer(root, Failing(f"{root}/published", fails={1, 2}), stream_id="s")
    job.process(batch(spark, "a"), 0)
    job.process(batch(spark, "b"), 1)
    job.process(batch(spark, None), 2)
    assert read_collection(spark, f"{root}/postings").count() == 3
    assert [r["SearchWord"] for r in published(spark, root).collect()] == ["a"]
    log = read_refresh_log(spark, f"{root}/refreshes")
    assert [r["error"] for r in log.where("status = 'failed'").collect()] == ["target is down"] * 2
    # another process goes on
    consumer(root, Failing(f"{root}/published", fails=set()), stream_id="s").process(batch(spark, "c"), 3)
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == ["a", "b", "c"]


def test_other_failures_end_the_stream(spark, log, tmp_path):
    class Unreadable(snap.IncrementalSnapshot):
        def prepare(self, spark, postings_dir, refresh):
            return super().prepare(spark, postings_dir + "-gone", refresh)

    root = str(tmp_path)
    with pytest.raises(StreamingQueryException):
        drain(spark, log, consumer(root, Unreadable(f"{root}/published")))


def test_new_checkpoint_does_not_overwrite(spark, log, tmp_path):
    """Batch ids start again at 0, under another stream id."""
    root = str(tmp_path)
    drain(spark, log, consumer(root))
    other = consumer(root)
    other.checkpoint_dir = f"{root}/checkpoint-2"
    drain(spark, log, other)
    assert read_collection(spark, f"{root}/postings").count() == 2 * N


def test_trace(spark, log, tmp_path):
    root = str(tmp_path)
    drain(spark, log, consumer(root, trace_dir=f"{root}/trace"))
    trace = spark.read.parquet(f"{root}/trace")
    assert trace.select("key", "value", "place", "row").distinct().count() == N


def test_stream_lifecycle(spark, log, tmp_path):
    """A timed trigger, batches until stopped, one refresh per batch and none when idle."""
    root = str(tmp_path)
    query = consumer(root).start(stream_log(spark, log, files_per_batch=2), interval="1 second")
    assert query.isActive
    query.processAllAvailable()
    done = len(refreshes(spark, root))
    assert done == 2
    assert not query.awaitTermination(3)
    assert len(refreshes(spark, root)) == done
    query.stop()
    run_until_stopped(query)
    assert not query.isActive


def test_nothing_published_yet(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing"):
        published(spark, str(tmp_path))


def test_full_snapshot_alternates_and_replaces(spark, tmp_path):
    root = str(tmp_path)
    job = consumer(root, snap.FullSnapshot(f"{root}/published"), stream_id="s")
    places = []
    for batch_id, word in enumerate("abc"):
        job.process(batch(spark, word), batch_id)
        places.append(snap.last_refresh(spark, f"{root}/refreshes")["place"])
    assert places == ["full/slot=0", "full/slot=1", "full/slot=0"]
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == ["a", "b", "c"]


def test_full_snapshot_dedup(spark, tmp_path):
    root = str(tmp_path)
    publisher = snap.FullSnapshot(f"{root}/published", dedup=True)
    consumer(root, publisher, stream_id="s").process(batch(spark, "a", "a", "b"), 0)
    assert published(spark, root).count() == 2


def test_grid(spark, tmp_path):
    root = str(tmp_path)
    publisher = snap.GridSnapshot(f"{root}/published")
    consumer(root, publisher, stream_id="s").process(batch(spark, "=1+1", "+a", "x\\\"y", "l\\nm"), 0)
    grid = snap.read_published_grid(spark, f"{root}/published", f"{root}/refreshes")
    assert grid.columns == PUBLISHED.names
    assert sorted(r["SearchWord"] for r in grid.collect()) == ["'+a", "'=1+1", "l\nm", 'x"y']
    raw = spark.read.text(f"{root}/published/grid/slot=0").collect()
    assert sum(r[0] == ",".join(PUBLISHED.names) for r in raw) >= 1
    with pytest.raises(ValueError, match="own reader"):
        published(spark, root)


def test_grid_limits(spark):
    wide = spark.range(1).select(*[F.lit("x").alias(f"c{i}") for i in range(27)])
    with pytest.raises(ValueError, match="26"):
        snap.grid_cells(wide)
    row = spark.createDataFrame([("=a", None)], "a string, b string")
    assert tuple(snap.grid_cells(row, escape_formulas=False).first()) == ("=a", None)


def test_typed_view(spark):
    rows = [("2024-02-30 00:00:00", "2024-01-01 00:00:00"), ("soon", "2024-1-1 00:00:00"), (None, "")]
    frame = spark.createDataFrame(rows, "Created string, QueryAt string")
    got = [tuple(r) for r in snap.typed_snapshot(frame).collect()]
    assert got[0][0] is None and str(got[0][1]) == "2024-01-01 00:00:00"
    assert got[1] == (None, None) == got[2]


def test_append_counts(spark, tmp_path):
    rows = spark.createDataFrame([("x",) * 8] * 3, list(POSTING_FIELDS))
    assert append_batch(rows, str(tmp_path), "s", 0) == 3


def test_operators_run_on_a_stream(spark, log, tmp_path):
    """Decode and filter are the same expressions on a stream as on a table."""
    stream = with_search_word(decode_postings(stream_log(spark, log)))
    assert stream.isStreaming
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "rows")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "rows")).count() == N - MALFORMED


def test_consumer_may_start_before_the_first_publish(spark, sf, tmp_path):
    root, path = str(tmp_path), str(tmp_path / "log")
    query = consumer(root).start(stream_log(spark, path), interval="1 second")
    try:
        query.processAllAvailable()
        assert read_collection(spark, f"{root}/postings").count() == 0
        rows = inputs.messages(spark, sf).withColumn("topic", F.lit("jobs-data"))
        log_sink.publish_to_log(rows, path)
        query.processAllAvailable()
        assert read_collection(spark, f"{root}/postings").count() == N
    finally:
        query.stop()
    assert published(spark, root).count() == N - MALFORMED


def test_full_snapshot_never_writes_over_the_one_in_use(spark, tmp_path, monkeypatch):
    """A refresh that was written but not logged is written again to the same place."""
    root = str(tmp_path)
    job = consumer(root, snap.FullSnapshot(f"{root}/published"), stream_id="s")
    job.process(batch(spark, "a"), 0)

    def broken(*_):
        raise OSError("log is down")

    monkeypatch.setattr("gleanstream.streaming.consumer.write_refresh_log", broken)
    with pytest.raises(OSError):
        job.process(batch(spark, "b"), 1)
    monkeypatch.undo()
    assert [r["SearchWord"] for r in published(spark, root).collect()] == ["a"]
    job.process(batch(spark, "b"), 1)
    assert snap.last_refresh(spark, f"{root}/refreshes")["place"] == "full/slot=1"
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == ["a", "b"]


KINDS = {"rows": snap.IncrementalSnapshot, "full": snap.FullSnapshot, "grid": snap.GridSnapshot}


@pytest.mark.parametrize("first,second", [("grid", "rows"), ("full", "rows"), ("rows", "full"), ("rows", "rows")])
def test_kinds_follow_each_other(spark, tmp_path, first, second):
    """Whatever kind of snapshot was kept before, the next one has every stored row."""
    root = str(tmp_path)
    consumer(root, KINDS[first](f"{root}/published"), stream_id="s").process(batch(spark, "a"), 0)
    consumer(root, KINDS[second](f"{root}/published"), stream_id="s").process(batch(spark, "b"), 1)
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == ["a", "b"]
    consumer(root, KINDS["rows"](f"{root}/published"), stream_id="s").process(batch(spark, "c"), 2)
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == ["a", "b", "c"]


def test_stream_given_up_after_a_failed_publish(spark, tmp_path):
    root = str(tmp_path)
    consumer(root, Failing(f"{root}/published", fails={0}), stream_id="s").process(batch(spark, "a"), 0)
    consumer(root, stream_id="t").process(batch(spark, "b"), 0)
    assert sorted(r["SearchWord"] for r in published(spark, root).collect()) == ["a", "b"]


def test_failed_grid_leaves_the_last_one(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    job = consumer(root, snap.GridSnapshot(f"{root}/published"), stream_id="s")
    job.process(batch(spark, "a"), 0)
    export = snap.grid_export

    def midway(rows, path, *rest):
        export(rows.limit(1), path, *rest)
        raise OSError("target is down")

    monkeypatch.setattr(snap, "grid_export", midway)
    job.process(batch(spark, "b"), 1)
    monkeypatch.undo()

    def words():
        grid = snap.read_published_grid(spark, f"{root}/published", f"{root}/refreshes")
        return sorted(r["SearchWord"] for r in grid.collect())

    assert words() == ["a"]
    job.process(batch(spark, "c"), 2)
    assert words() == ["a", "b", "c"]


def test_refresh_log_stays_small(spark, tmp_path):
    """Many refreshes, gaps and failures: few files are read, and they say the same."""
    log = RefreshLog(spark, str(tmp_path), compact_every=10)
    for batch_id in range(64):
        failed = batch_id % 13 == 5
        log.append("s" if batch_id % 2 else "t", batch_id, kind="rows", query_at=f"at {batch_id}", records=1,
                   place=None if failed else "rows", error="down" if failed else None,
                   covers=() if failed else [("s" if batch_id % 2 else "t", batch_id)])
    assert len(log.rows().inputFiles()) <= 11
    assert log.last("rows")["query_at"] == "at 63" and log.last("full") is None
    covered = {(row["covered_stream"], batch_id) for row in log.covered().collect()
               for batch_id in range(row["first"], row["last"] + 1)}
    assert covered == {("s" if i % 2 else "t", i) for i in range(64) if i % 13 != 5}


def test_unfinished_compaction_does_not_count(spark, tmp_path):
    log = RefreshLog(spark, str(tmp_path))
    log.append("s", 0, kind="rows", query_at="q", records=1, place="rows", error=None, covers=[("s", 0)])
    log.compact()
    assert log.version() == 1 and log.last()["query_at"] == "q"
    (tmp_path / "version=2" / "head").mkdir(parents=True)
    assert log.version() == 1 and log.covered().count() == 1


def test_rejects_of_a_stream_in_one_parse(spark, log, tmp_path, monkeypatch):
    root = str(tmp_path)
    parses = []
    real = decode.parse_object
    monkeypatch.setattr(decode, "parse_object", lambda *args: parses.append(1) or real(*args))
    job = consumer(root, rejects_dir=f"{root}/rejects")
    drain(spark, log, job)
    assert len(parses) == len(job.counts) == 2  # one a batch
    found = spark.read.parquet(f"{root}/rejects")
    assert found.count() == MALFORMED == sum(one["rejected"] for one in job.counts.values())
    want = decode.decode_rejects(read_log(spark, log), ("key", "place", "row"))
    both = found.select("key", "place", "row", "value", "reason")
    assert both.exceptAll(want).isEmpty() and want.exceptAll(both).isEmpty()
    assert {row["reason"] for row in found.collect()} >= {"no text", "not a JSON object", "lacks: Salary"}
    # a replay replaces its rejects
    rows = read_log(spark, log)
    again = consumer(f"{root}/r", stream_id="s", rejects_dir=f"{root}/r/rejects")
    for _ in range(2):
        again.process(rows, 0)
    assert spark.read.parquet(f"{root}/r/rejects").count() == MALFORMED


def test_counts_need_no_second_read(spark, tmp_path):
    reads = []
    real = type(spark.read).parquet

    def noted(self, *paths, **options):
        reads.append(paths)
        return real(self, *paths, **options)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.read), "parquet", noted)
        assert append_batch(batch(spark, "a", "b").select(F.lit("x").alias("SearchWord"), *[
            F.lit("y").alias(name) for name in POSTING_FIELDS[1:]]), str(tmp_path), "s", 0) == 2
    assert reads == []


class Slow(snap.IncrementalSnapshot):
    """Takes a second for each refresh, and says when one begins."""

    def __init__(self, published_dir):
        super().__init__(published_dir)
        self.begun = threading.Event()

    def publish(self, rows, refresh):
        self.begun.set()
        time.sleep(1)
        return super().publish(rows, refresh)


@pytest.mark.parametrize("how", ["request", "file"])
def test_a_stop_lets_the_batch_under_way_end(spark, log, tmp_path, how):
    root = str(tmp_path)
    job = consumer(root, Slow(f"{root}/published"))
    query = job.start(stream_log(spark, log, files_per_batch=1), interval="0 seconds")
    stop_file = tmp_path / "stop"

    def ask():
        job.publisher.begun.wait(60)  # in the middle of the first batch
        job.request_stop() if how == "request" else stop_file.write_text("")

    threading.Thread(target=ask).start()
    run_until_stopped(query, job, spark, str(stop_file))
    assert not query.isActive
    done = refreshes(spark, root)
    assert 1 <= len(done) < 4 and all(status == "ok" for _, status, _ in done)
    commits = sorted(int(one.name) for one in (tmp_path / "checkpoint" / "commits").iterdir()
                     if one.name.isdigit())
    assert commits == [one for one, _, _ in done]  # what was done is committed: nothing is replayed
    after = consumer(root)
    drain(spark, log, after, files=1)
    assert sorted(after.counts)[0] == commits[-1] + 1
    assert read_collection(spark, f"{root}/postings").count() == N


def test_other_failures_are_not_taken_for_a_stop(spark, log, tmp_path, monkeypatch):
    job = consumer(str(tmp_path))
    monkeypatch.setattr(job, "_process", lambda *_: 1 / 0)
    query = job.start(stream_log(spark, log), interval="0 seconds")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        run_until_stopped(query, job, spark)


@pytest.mark.parametrize("kind", [snap.IncrementalSnapshot, snap.FullSnapshot])
def test_an_idle_stream_publishes_again(spark, log, tmp_path, kind):
    root = str(tmp_path)
    job = consumer(root, kind(f"{root}/published"))
    query = job.start(stream_log(spark, log), interval="1 second")
    query.processAllAvailable()
    stamps = {published(spark, root).first()["QueryAt"]}
    rows = published(spark, root).count()

    def stop():
        while len(refreshes(spark, root)) < 4 and query.isActive:
            time.sleep(0.2)
        job.request_stop()

    waiting = threading.Thread(target=stop)
    waiting.start()
    run_until_stopped(query, job, spark, idle_refresh=0.5)
    waiting.join()
    done = refreshes(spark, root)
    assert len(done) >= 4 and [records for _, _, records in done[1:]] == [0] * (len(done) - 1)
    now = published(spark, root)
    assert now.first()["QueryAt"] not in stamps and now.count() == rows == N - MALFORMED
    assert read_collection(spark, f"{root}/postings").count() == N


def test_an_idle_refresh_makes_up_for_a_failed_one(spark, tmp_path):
    root = str(tmp_path)

    class Down(snap.IncrementalSnapshot):
        def publish(self, rows, refresh):
            raise OSError("target is down")

    job = consumer(root, Down(f"{root}/published"), stream_id="s")
    job.process(batch(spark, "a"), 0)
    job.publisher = snap.IncrementalSnapshot(f"{root}/published")
    assert not job.refresh_when_idle(spark, 60)
    assert job.refresh_when_idle(spark, 0)
    assert [row["SearchWord"] for row in published(spark, root).collect()] == ["a"]


def test_reading_does_not_deal_the_rows_by_stream(spark, sf, tmp_path):
    job = consumer(str(tmp_path), stream_id="s")
    for batch_id in range(2):
        job.process(inputs.messages(spark, sf), batch_id)
    found = published(spark, tmp_path)
    assert found.count() == 2 * (N - MALFORMED)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # one stream has all rows
