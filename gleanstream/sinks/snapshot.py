"""Publishing the snapshot.

Readers always see one whole refresh: every clean posting with one ``QueryAt``.
There are three ways to keep it, each in a folder of its own below the published one.

``IncrementalSnapshot`` writes the new batches only. ``QueryAt`` is the same for
all rows of a refresh, so it is kept once per refresh and attached on reading.
A refresh costs as much as its batch, however long the history is. What is new is
what no logged refresh covers, whichever stream stored it, so a batch whose publish
failed, or whose stream was given up, is made up for by the next refresh. A batch is written aside
and takes its place by one rename, if no other refresher was quicker; both come to the same rows.

``FullSnapshot`` and ``GridSnapshot`` rewrite every row each time, for targets that
need a plain table or a headed grid. They alternate between two folders, so the last
refresh stays readable until the next one is logged. A refresher claims its folder, so that of
several each has its own; a refresh that is not the next in the log after what it has read must be made
anew, because it may lack what the quicker one has. A refresher that dies keeps its claim, and has it
back under the same stream id; else the folder below ``_claims`` may be deleted by hand.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanstream.functions.cells import typed_cells
from gleanstream.functions.text import guard_formula, parse_stamp
from gleanstream.operators.clean import snapshot, stamp_query_at, with_search_word
from gleanstream.schemas import POSTING_FIELDS, PUBLISHED, PUBLISHED_FIELDS, SNAPSHOT_MAX_COLUMNS
from gleanstream.sinks.claims import claim, put_if_absent, remove
from gleanstream.sinks.refresh_log import RefreshLog
from gleanstream.sources.collection import batch_path, read_batches, read_collection
from gleanstream.sources.ranges import files_of, in_ranges, merged_ranges


@dataclass(frozen=True)
class Refresh:
    """One refresh: the batch that asked for it, all batches to publish, the last good place.

    An idle refresh has no batch of its own: it moves the stamp on, and makes up for what is pending.
    ``unchanged`` says whether the pending batches are still what they were when they were read, and
    ``newest_place`` where the last good refresh of the kind is by now; without them none is asked.
    """

    stream_id: str
    batch_id: int
    query_at: str
    pending: tuple[tuple[str, int], ...] = ()
    last_place: str | None = None
    idle: bool = False
    unchanged: Callable[[], bool] | None = None
    newest_place: Callable[[], str | None] | None = None

    @property
    def batches(self) -> tuple[tuple[str, int], ...]:
        """The pending batches and the refresh's own."""
        if self.idle:
            return self.pending
        return tuple(dict.fromkeys((*self.pending, (self.stream_id, self.batch_id))))


class PendingChanged(Exception):
    """A pending batch was stored anew while it was read; the next refresh takes it up."""


class Publisher(Protocol):
    kind: str
    #: Whether a refresh replaces the one before, and so must follow it in the log.
    rewrites: bool

    def prepare(self, spark: SparkSession, postings_dir: str, refresh: Refresh) -> DataFrame:
        """The rows to write; an unreadable collection fails here."""

    def publish(self, rows: DataFrame, refresh: Refresh) -> str:
        """Write them and say where they are, below the published folder."""


class IncrementalSnapshot:
    kind = "rows"
    rewrites = False

    def __init__(self, published_dir: str):
        self.published_dir = published_dir

    def prepare(self, spark, postings_dir, refresh):
        return with_search_word(read_batches(spark, postings_dir, refresh.batches))

    def publish(self, rows, refresh):
        folder = f"{self.published_dir}/{self.kind}"
        merged = merged_ranges(rows.sparkSession, folder)
        batches = [batch for batch in refresh.batches if not any(one.holds(*batch) for one in merged)]
        if not batches:  # an idle refresh, or a replay of what is there: its stamp is in the log
            return self.kind
        if len(batches) < len(refresh.batches):
            rows = rows.where(~in_ranges(merged))
        spark, stage = rows.sparkSession, f"{folder}/_unplaced/{uuid.uuid4().hex}"
        if len(batches) == 1:
            rows.select(*POSTING_FIELDS).write.parquet(batch_path(stage, *batches[0]))
        else:
            rows.write.partitionBy("stream_id", "batch_id").parquet(stage)
        try:
            if refresh.unchanged is not None and not refresh.unchanged():
                raise PendingChanged("a pending batch was stored anew while it was read")
            for batch in batches:
                files, written = files_of(spark, batch_path(stage, *batch))
                if files.exists(written):  # without rows it has no folder
                    put_if_absent(spark, batch_path(stage, *batch), batch_path(folder, *batch))
        finally:
            remove(spark, stage)
        return self.kind

    def release(self, spark, refresh):
        """Nothing is claimed."""


class _Rewriting:
    """What is rewritten as a whole, in one of the folders of its kind."""

    kind: str
    published_dir: str
    rewrites = True

    def _claims(self) -> str:
        return f"{self.published_dir}/{self.kind}/_claims"

    def _claimed_slot(self, spark: SparkSession, refresh: Refresh) -> str:
        """The first folder that is neither the last good one nor another refresher's."""
        for number in itertools.count():
            place, name = f"{self.kind}/slot={number}", f"{self._claims()}/slot={number}"
            if place == refresh.last_place or not claim(spark, name, refresh.stream_id):
                continue
            # since the log was read another may have published here and let go
            if refresh.newest_place is None or refresh.newest_place() != place:
                return place
            remove(spark, name)

    def release(self, spark: SparkSession, refresh: Refresh) -> None:
        """Let go of what the refresher has claimed, after its refresh was logged or given up."""
        files, folder = files_of(spark, self._claims())
        if files.exists(folder):
            for one in files.listStatus(folder):
                mine = files_of(spark, f"{one.getPath()}/{refresh.stream_id}")[1]
                if files.exists(mine):
                    files.delete(one.getPath(), True)


class FullSnapshot(_Rewriting):
    """``dedup`` drops whole-row copies, which needs a shuffle of the collection."""

    kind = "full"

    def __init__(self, published_dir: str, dedup: bool = False):
        self.published_dir = published_dir
        self.dedup = dedup

    def prepare(self, spark, postings_dir, refresh):
        return snapshot(read_collection(spark, postings_dir), refresh.query_at, self.dedup)

    def publish(self, rows, refresh):
        place = self._claimed_slot(rows.sparkSession, refresh)
        rows.write.mode("overwrite").parquet(f"{self.published_dir}/{place}")
        return place


class GridSnapshot(_Rewriting):
    """A headed grid of text cells for a spreadsheet, rewritten at each refresh."""

    kind = "grid"

    def __init__(self, published_dir: str, escape_formulas: bool = True):
        self.published_dir = published_dir
        self.escape_formulas = escape_formulas

    def prepare(self, spark, postings_dir, refresh):
        return snapshot(read_collection(spark, postings_dir), refresh.query_at)

    def publish(self, rows, refresh):
        place = self._claimed_slot(rows.sparkSession, refresh)
        grid_export(rows, f"{self.published_dir}/{place}", self.escape_formulas)
        return place


def write_refresh_log(
    spark: SparkSession, log_dir: str, refresh: Refresh, kind: str, records: int,
    place: str | None, error: str | None, after: int | None = None,
) -> bool:
    """Log a refresh; with ``after``, only if no other came after that commit."""
    return RefreshLog(spark, log_dir).append(
        refresh.stream_id, refresh.batch_id, kind=kind, query_at=refresh.query_at, records=records,
        place=place, error=error, covers=refresh.batches if kind == IncrementalSnapshot.kind else (),
        after=after)


def stored_marks(
    spark: SparkSession, postings_dir: str, batches: Iterable[tuple[str, int]],
) -> dict[tuple[str, int], int | None]:
    """When each batch was stored whole, in milliseconds; None for one that is being written.

    Merged batches are whole and never change.
    """
    ranges, found = merged_ranges(spark, postings_dir), {}
    for batch in batches:
        files, mark = files_of(spark, f"{batch_path(postings_dir, *batch)}/_SUCCESS")
        if any(one.holds(*batch) for one in ranges):
            found[batch] = 0
        else:
            found[batch] = files.getFileStatus(mark).getModificationTime() if files.exists(mark) else None
    return found


def pending_batches(spark: SparkSession, postings_dir: str, log_dir: str) -> tuple[tuple[str, int], ...]:
    """Whole stored batches of any stream that no refresh has put into the incremental snapshot."""
    stored = read_collection(spark, postings_dir).select("stream_id", "batch_id").distinct()
    covered = RefreshLog(spark, log_dir).covered()
    rows = stored.join(covered, (stored["stream_id"] == covered["covered_stream"]) & stored["batch_id"].between(
        covered["first"], covered["last"]), "left_anti")
    found = [(row["stream_id"], row["batch_id"]) for row in rows.sort("stream_id", "batch_id").collect()]
    marks = stored_marks(spark, postings_dir, found)
    return tuple(batch for batch in found if marks[batch] is not None)


def last_refresh(spark: SparkSession, log_dir: str, *kinds: str):
    """The newest successful refresh, of some kinds or of any, as one row, or None."""
    return RefreshLog(spark, log_dir).last(*kinds)


def read_published(spark: SparkSession, published_dir: str, log_dir: str) -> DataFrame:
    """The snapshot as of the newest successful refresh, incremental or full."""
    log = RefreshLog(spark, log_dir).read_once()
    last = log.last(IncrementalSnapshot.kind, FullSnapshot.kind)
    if last is None:
        raise ValueError("nothing has been published yet that this reads; a grid has its own reader")
    if last["kind"] == FullSnapshot.kind:
        return spark.read.schema(PUBLISHED).parquet(f"{published_dir}/{last['place']}")
    rows = read_collection(spark, f"{published_dir}/{last['place']}")
    covered = log.covered()
    # a batch is visible once its refresh is logged; a row per stream, or few, go to the tasks, for dealt
    # by stream all rows of one would lie in one task
    visible = rows.join(F.broadcast(covered), (rows["stream_id"] == covered["covered_stream"]) & rows["batch_id"].between(
        covered["first"], covered["last"]), "left_semi")
    return stamp_query_at(visible.select(*POSTING_FIELDS), last["query_at"])


def read_published_grid(spark: SparkSession, published_dir: str, log_dir: str) -> DataFrame:
    """The newest grid that was written whole."""
    last = last_refresh(spark, log_dir, GridSnapshot.kind)
    if last is None:
        raise ValueError("no grid has been published yet")
    return read_grid(spark, f"{published_dir}/{last['place']}")


def typed_snapshot(published: DataFrame, cells: Sequence[str] = ()) -> DataFrame:
    """Stamps as timestamps, as a sheet would read them; other text gives NULL.

    Columns named in ``cells`` become typed cells, see :func:`gleanstream.functions.cells.typed_cell`.
    """
    return typed_cells(published, cells).withColumns({
        "Created": parse_stamp(F.col("Created")),
        "QueryAt": parse_stamp(F.col("QueryAt")),
    })


def grid_cells(published: DataFrame, escape_formulas: bool = True) -> DataFrame:
    """Cell texts in column order."""
    if len(published.columns) > SNAPSHOT_MAX_COLUMNS:
        raise ValueError(f"a grid has at most {SNAPSHOT_MAX_COLUMNS} columns")
    return published.select(*[
        (guard_formula(F.col(name)) if escape_formulas else F.col(name)).alias(name)
        for name in published.columns
    ])


# Quotes are doubled, as spreadsheets expect, and nothing in a cell is trimmed or dropped.
_GRID = {
    "header": True, "quote": '"', "escape": '"', "charToEscapeQuoteEscaping": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def grid_export(published: DataFrame, path: str, escape_formulas: bool = True) -> None:
    """Headed CSV, written by all tasks; every part starts with the header row."""
    cells = grid_cells(published.select(*PUBLISHED_FIELDS), escape_formulas)
    cells.write.mode("overwrite").options(**_GRID).csv(path)


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """The grid as rows; a blank cell is NULL, whether it was NULL or empty text."""
    return spark.read.schema(PUBLISHED).options(**_GRID, multiLine=True).csv(path)
