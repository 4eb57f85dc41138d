"""The log of refreshes: numbered commits, with a compacted head so that reading it never gets slower.

Every refresh is one small folder, ``commits/part=P/commit=N``. It gets its number by a rename that
never replaces, so several processes may refresh one store: each number is one refresh, none is lost,
and the order of the numbers is that of the refreshes. One that must follow what it has read names
the number it has read up to, and is refused if another was quicker.

``version=V/head`` holds what all commits up to ``version=V/through=N`` come to: the newest good one of
each kind, and the batches that the incremental snapshot covers, as ranges. Every hundredth commit
makes the next version; two processes that make the same one say the same, and one of them counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleanstream.sinks.claims import put_if_absent, remove
from gleanstream.sources.ranges import files_of, names_in

_RANGES = "array<struct<stream_id: string, first: bigint, last: bigint>>"
FIELDS = (
    "kind string, status string, error string, records bigint, query_at string, place string, "
    f"refreshed_at timestamp, covers {_RANGES}, stream_id string, batch_id bigint"
)
#: Refreshes after which the log is compacted.
COMPACT_EVERY = 100
#: Commits that lie in one folder.
_PART = 1000


class RefreshLog:
    def __init__(self, spark: SparkSession, log_dir: str, compact_every: int = COMPACT_EVERY):
        self.spark, self.log_dir, self.compact_every = spark, log_dir, compact_every
        self._rows: DataFrame | None = None

    def _numbers(self, path: str, prefix: str) -> list[int]:
        """Numbers behind a prefix among the names of a folder, newest first."""
        return sorted((int(name.removeprefix(prefix)) for name in names_in(self.spark, path)
                       if name.startswith(prefix)), reverse=True)

    def version(self) -> int:
        """The newest version whose head is complete; 0 has none."""
        return next((number for number in self._numbers(self.log_dir, "version=") if "_SUCCESS" in names_in(
            self.spark, f"{self.log_dir}/version={number}/head")), 0)

    def _through(self, version: int) -> int:
        """The last commit that a version's head takes in."""
        return next(iter(self._numbers(f"{self.log_dir}/version={version}", "through=")), 0)

    def newest(self) -> int:
        """The number of the newest commit; 0 before the first."""
        for part in self._numbers(f"{self.log_dir}/commits", "part="):
            for number in self._numbers(f"{self.log_dir}/commits/part={part}", "commit="):
                return number
        return 0

    def _commit(self, number: int) -> str:
        return f"{self.log_dir}/commits/part={number // _PART}/commit={number}"

    def read_once(self) -> RefreshLog:
        """This log as of now: later questions are answered from the same few rows."""
        rows = self.rows()
        self._rows = self.spark.createDataFrame(rows.collect(), rows.schema)
        return self

    def rows(self, upto: int | None = None) -> DataFrame:
        """The head's rows and all refreshes since; of a batch that was replayed since, the last."""
        if self._rows is not None:
            return self._rows
        version = self.version()
        after, upto = self._through(version), self.newest() if upto is None else upto
        found = self.spark.createDataFrame([], f"{FIELDS}, commit bigint")
        names = found.columns
        if version:
            found = found.unionByName(self.spark.read.schema(found.schema).parquet(
                f"{self.log_dir}/version={version}/head"))
        paths = [self._commit(number) for number in range(after + 1, upto + 1)]
        if paths:
            since = self.spark.read.schema(found.schema).option(
                "basePath", f"{self.log_dir}/commits").parquet(*paths)
            found = found.unionByName(since.groupBy("stream_id", "batch_id").agg(F.max_by(F.struct(
                *[name for name in names if name not in ("stream_id", "batch_id")]), "commit").alias(
                "one")).select("stream_id", "batch_id", "one.*").select(*names))
        return found

    def append(
        self, stream_id: str, batch_id: int, *, kind: str, query_at: str, records: int,
        place: str | None, error: str | None, covers: Iterable[tuple[str, int]] = (),
        after: int | None = None,
    ) -> bool:
        """Log a refresh. With ``after``, only as the commit that follows that one; says whether it did."""
        ranges = F.array(*[F.struct(
            F.lit(stream).alias("stream_id"), F.lit(batch).cast("bigint").alias("first"),
            F.lit(batch).cast("bigint").alias("last")) for stream, batch in covers])
        stage = f"{self.log_dir}/unlogged/{uuid.uuid4().hex}"
        self.spark.range(1).select(
            F.lit(kind).alias("kind"), F.lit("failed" if error else "ok").alias("status"),
            F.lit(error).cast("string").alias("error"), F.lit(records).cast("bigint").alias("records"),
            F.lit(query_at).alias("query_at"), F.lit(place).cast("string").alias("place"),
            F.current_timestamp().alias("refreshed_at"), ranges.cast(_RANGES).alias("covers"),
            F.lit(stream_id).alias("stream_id"), F.lit(batch_id).cast("bigint").alias("batch_id"),
        ).coalesce(1).write.parquet(stage)
        while True:
            number = (self.newest() if after is None else after) + 1
            if put_if_absent(self.spark, stage, self._commit(number)):
                break
            if after is not None:
                remove(self.spark, stage)
                return False
        if number % self.compact_every == 0:
            self.compact(number)
        return True

    def covered(self, rows: DataFrame | None = None) -> DataFrame:
        """(covered_stream, first, last): batches in the incremental snapshot, as joined ranges."""
        ranges = (self.rows() if rows is None else rows).where("status = 'ok'").select(F.explode("covers").alias("one")).select("one.*")
        order = W.partitionBy("stream_id").orderBy("first", "last")
        before = F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1))
        return ranges.withColumn("before", before).select(
            "stream_id", "first", "last", (F.coalesce(F.col("first") > F.col("before") + 1, F.lit(True))).alias(
                "apart")).withColumn("island", F.sum(F.col("apart").cast("int")).over(order)).groupBy(
            "stream_id", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).select(
            F.col("stream_id").alias("covered_stream"), "first", "last")

    def last(self, *kinds: str):
        """The newest good refresh of the kinds (of any, if none is named), or None."""
        good = self.rows().where("status = 'ok'")
        if kinds:
            good = good.where(F.col("kind").isin(*kinds))
        newest = F.max(F.struct("commit", "refreshed_at", "stream_id", "batch_id", "kind", "query_at", "place"))
        return good.agg(newest.alias("newest")).first()["newest"]

    def compact(self, through: int | None = None) -> None:
        """Start a new version whose head says the same, up to a commit, in a row for each kind."""
        through = self.newest() if through is None else through
        version = self.version()
        if through <= self._through(version):
            return
        rows = self.rows(through)
        newest = rows.where("status = 'ok'").groupBy("kind").agg(
            F.max_by(F.struct(*[name for name in rows.columns if name != "kind"]), "commit").alias("one"))
        ranges = [tuple(row) for row in self.covered(rows).collect()]  # a few a stream
        every = F.array(*[F.struct(
            F.lit(stream).alias("stream_id"), F.lit(first).cast("bigint").alias("first"),
            F.lit(last).cast("bigint").alias("last")) for stream, first, last in ranges]).cast(_RANGES)
        head = newest.select("kind", "one.*").withColumn(
            "covers", F.when(F.size("covers") > 0, every).otherwise(F.array().cast(_RANGES)))
        stage = f"{self.log_dir}/unlogged/{uuid.uuid4().hex}"
        head.select(*rows.columns).coalesce(1).write.parquet(f"{stage}/head")
        files, mark = files_of(self.spark, f"{stage}/through={through}")
        files.mkdirs(mark)
        if not put_if_absent(self.spark, stage, f"{self.log_dir}/version={version + 1}"):
            remove(self.spark, stage)


def read_refresh_log(spark: SparkSession, log_dir: str) -> DataFrame:
    return RefreshLog(spark, log_dir).rows()
