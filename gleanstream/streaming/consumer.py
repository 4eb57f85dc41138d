"""The micro-batch consumer: trace, decode and append, then publish again."""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanstream.operators.decode import decode_log_strings, decode_tagged, record_trace
from gleanstream.session import now_stamp
from gleanstream.sinks.collection import append_observed
from gleanstream.sinks.refresh_log import RefreshLog
from gleanstream.sinks.snapshot import (
    Publisher, Refresh, last_refresh, pending_batches, stored_marks, write_refresh_log,
)
from gleanstream.sources.collection import batch_path

BATCH_INTERVAL = "10 seconds"
#: Batches of which a consumer remembers the counts.
COUNTS_KEPT = 1000
#: Times that a refresh is made anew because another refresher was quicker.
REFRESH_ATTEMPTS = 10
_POLL = 0.05
_PLACES = ("partition", "offset", "place", "row")


class Stopped(Exception):
    """Raised instead of beginning a batch after a stop was asked for; nothing was done for it."""


@dataclass
class ListingConsumer:
    """Handles the micro-batches of one stream.

    A batch is appended before the snapshot is refreshed, so a refresh always
    contains the batch that caused it. A publish that fails is logged and made up
    for by the next one; any other failure ends the stream, which then resumes
    from its checkpoint and replays the batch.

    Every batch is parsed once. With ``rejects_dir``, records that decode to a row of nulls are
    also kept there, with the reason and their place, in a folder for each batch, so that a replay
    replaces them too. ``counts`` has what the last batches of this run came to, taken while they were
    written.

    :meth:`request_stop` lets a running batch end and begins no other; :meth:`refresh_when_idle`
    publishes again, with a new stamp, if nothing has for a while. Batches and idle refreshes
    never run at the same time. Several consumers, each with a checkpoint of its own, may refresh one
    store: see :mod:`gleanstream.sinks.snapshot`.
    """

    postings_dir: str
    log_dir: str
    publisher: Publisher
    checkpoint_dir: str
    trace_dir: str | None = None
    null_text: str = "literal"
    query_at: Callable[[], str] = now_stamp
    stream_id: str | None = None
    rejects_dir: str | None = None
    counts: dict[int, dict[str, int]] = field(default_factory=dict)
    _work: threading.Lock = field(default_factory=threading.Lock, repr=False)
    _stop: threading.Event = field(default_factory=threading.Event, repr=False)
    _refreshed: float | None = None
    _pending: tuple[tuple[str, int], ...] | None = None
    _place: str | None = None
    _seen: int | None = None

    def _last_place(self, spark: SparkSession) -> str | None:
        last = last_refresh(spark, self.log_dir, self.publisher.kind)
        return last["place"] if last is not None else None

    def _stream_id(self, spark: SparkSession) -> str:
        """The id Spark keeps inside the checkpoint: same after a restart, new if it is new."""
        if self.stream_id is None:
            row = spark.read.schema("id string").json(f"{self.checkpoint_dir}/metadata").first()
            self.stream_id = row["id"]
        return self.stream_id

    def process(self, batch: DataFrame, batch_id: int) -> None:
        with self._work:
            if self._stop.is_set():
                raise Stopped(f"batch {batch_id} is left to the next start")
            self._process(batch, batch_id)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = self._stream_id(spark)
        raw = decode_log_strings(batch)
        if self.trace_dir:
            record_trace(raw).write.mode("overwrite").parquet(
                batch_path(self.trace_dir, stream_id, batch_id))
        places = tuple(name for name in ("key", *_PLACES) if name in raw.columns)
        tagged = decode_tagged(raw, places, self.null_text)
        if self.rejects_dir:  # read twice; without the second table the one write is the one parse
            tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.counts[batch_id] = append_observed(
                tagged, self.postings_dir, stream_id, batch_id,
                {"rejected": F.count("reason")})
            if self.rejects_dir:
                tagged.where("reason IS NOT NULL").select(*places, "value", "reason").write.mode(
                    "overwrite").parquet(batch_path(self.rejects_dir, stream_id, batch_id))
        finally:
            if self.rejects_dir:
                tagged.unpersist()
        for old in sorted(self.counts)[:-COUNTS_KEPT]:
            del self.counts[old]
        self._refresh(spark, stream_id, batch_id, self.counts[batch_id]["records"])

    def request_stop(self) -> None:
        """End after the batch under way; safe from any thread and from a signal handler."""
        self._stop.set()

    def refresh_when_idle(self, spark: SparkSession, after: float) -> bool:
        """Publish again if no refresh was made for so many seconds; says whether it did.

        An idle refresh has a stream id of its own in the log, so that it replaces no batch's.
        """
        if self._refreshed is None:
            self._refreshed = time.monotonic()
        if time.monotonic() - self._refreshed < after or not self._work.acquire(blocking=False):
            return False
        try:
            if time.monotonic() - self._refreshed < after:
                return False
            self._refresh(spark, f"{self._stream_id(spark)}-idle", int(time.time() * 1000), 0, idle=True)
            return True
        finally:
            self._work.release()

    def _refresh(
        self, spark: SparkSession, stream_id: str, batch_id: int, records: int, idle: bool = False,
    ) -> None:
        kind, rewrites = self.publisher.kind, self.publisher.rewrites
        log = RefreshLog(spark, self.log_dir)
        if self._pending is None:
            # read once: from here on this process sees to its own batches, and others to theirs
            self._place = self._last_place(spark)
            self._pending = pending_batches(spark, self.postings_dir, self.log_dir)
        foreign = tuple(batch for batch in self._pending if batch != (stream_id, batch_id))
        marks = stored_marks(spark, self.postings_dir, foreign)
        for _ in range(REFRESH_ATTEMPTS):
            after = log.newest() if rewrites else None
            if after != self._seen:
                self._place = self._last_place(spark)
            refresh = Refresh(
                stream_id, batch_id, self.query_at(), self._pending, self._place, idle,
                lambda: stored_marks(spark, self.postings_dir, foreign) == marks,
                (lambda: self._last_place(spark)) if rewrites else None)
            rows = self.publisher.prepare(spark, self.postings_dir, refresh)
            place = error = None
            try:
                try:
                    place = self.publisher.publish(rows, refresh)
                except Exception as problem:  # noqa: BLE001 - a target's failure must not end the stream
                    error = str(problem) or type(problem).__name__
                logged = write_refresh_log(
                    spark, self.log_dir, refresh, kind, records, place, error, None if error else after)
            finally:
                self.publisher.release(spark, refresh)
            if logged:
                self._seen = after + 1 if rewrites and error is None else None
                break
        else:
            place, error = None, "other refreshers were quicker each time"
            write_refresh_log(spark, self.log_dir, refresh, kind, records, place, error)
        if error is None:
            self._pending, self._place = (), place
        else:
            self._pending = refresh.batches
        self._refreshed = time.monotonic()

    def start(
        self, source: DataFrame, interval: str = BATCH_INTERVAL, until_drained: bool = False
    ) -> StreamingQuery:
        """Run on ``source``; ``until_drained`` takes what is there in batches and stops."""
        writer = source.writeStream.foreachBatch(self.process).option(
            "checkpointLocation", self.checkpoint_dir)
        if until_drained:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=interval).start()


def _exists(spark: SparkSession, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def run_until_stopped(
    query: StreamingQuery, consumer: ListingConsumer | None = None,
    spark: SparkSession | None = None, stop_file: str | None = None, idle_refresh: float | None = None,
) -> None:
    """Block until the query ends, or is asked to, then stop it.

    It is asked to by an interrupt, by SIGTERM, or by a file that appears. With a consumer, the batch
    under way ends and is committed first, and none is begun after it, so nothing is replayed at the
    next start. ``idle_refresh`` is the time in seconds after which an idle stream publishes again.
    """
    if consumer is None:
        try:
            query.awaitTermination()
        except KeyboardInterrupt:
            pass
        finally:
            query.stop()
        return
    in_main = threading.current_thread() is threading.main_thread()
    before = signal.signal(signal.SIGTERM, lambda *_: consumer.request_stop()) if in_main else None
    try:
        while query.isActive:
            try:
                if stop_file and not consumer._stop.is_set() and _exists(spark, stop_file):
                    consumer.request_stop()
                if consumer._stop.is_set():
                    # between batches: none is begun any more, and the last one is committed
                    if not query.status["isTriggerActive"] and not consumer._work.locked():
                        query.stop()
                elif idle_refresh is not None:
                    consumer.refresh_when_idle(spark, idle_refresh)
                time.sleep(_POLL)
            except KeyboardInterrupt:
                consumer.request_stop()
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if not (consumer._stop.is_set() and Stopped.__name__ in str(error)):
                raise
    finally:
        if in_main:
            signal.signal(signal.SIGTERM, before)
