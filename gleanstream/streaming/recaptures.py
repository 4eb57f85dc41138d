"""Listings seen again on pages captured in another micro-batch.

:func:`gleanstream.operators.extract.drop_recaptures` sees one table. On a stream, what was seen before
is kept as state: for each listing a digest and its earliest stamp, some hundred bytes whatever the
listing is. The state is dealt by the digest, and forgotten when a listing was not seen for a while.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues,
)
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DIGEST, _NUMBER, _SEEN, _TEXTS = "_digest", "_number", "_seen", "_texts"
#: Seconds after which a listing that was not seen again is forgotten.
REMEMBER = 30 * 24 * 3600
#: A sighting is written if the written one is older by one part of so many of the time above; a
#: listing is forgotten as much later, never earlier.
SIGHTINGS = 1000
#: How far the cluster's clock may be set back without a row being taken for late.
CLOCK_SLACK = "1 hour"


class EarliestCapture(StatefulProcessor):
    """Lets the earliest row of a key through when the key is first seen, and nothing after that.

    The time goes by messages to the state store. A key that is known costs one, unless its stamp is
    earlier or its sighting so much later that it is written.
    """

    def __init__(self, names: list[str], remember: int):
        self.names, self.remember, self.grain = names, remember, remember * 1000 // SIGHTINGS
        self.row = Row(*names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.earliest = handle.getValueState("earliest", "number bigint, seen bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        first, number = None, 0
        for row in rows:  # one row is held, however many a key has
            own = row[_NUMBER] or 0
            if first is None or own < number:
                first, number = row, own
        known = self.earliest.get()
        seen = timerValues.getCurrentProcessingTimeInMs()
        if known is None:
            self.earliest.update((number, seen))
            self.handle.registerTimer(self._until(seen))
            return iter((self.row(*(first[name] for name in self.names)),))
        if number < known[0] or seen - known[1] >= self.grain:
            self.earliest.update((min(number, known[0]), seen))
        return iter(())

    def handleExpiredTimer(
        self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo,
    ) -> Iterator[Row]:
        """A key has one timer: it goes on to the last sighting, or the key is forgotten."""
        until = self._until(self.earliest.get()[1])
        if until > expiredTimerInfo.getExpiryTimeInMs():
            self.handle.registerTimer(until)
        else:
            self.earliest.clear()
        return iter(())

    def _until(self, seen: int) -> int:
        return seen + self.remember * 1000 + self.grain

    def close(self) -> None:
        pass


def drop_recaptures_in_stream(
    listings: DataFrame, created: str = "Created", remember: int = REMEMBER,
    clock_slack: str = CLOCK_SLACK,
) -> DataFrame:
    """Each listing of a stream once: the earliest capture of the first batch that has it.

    Listings are the same if all columns but ``created`` are equal, nulls included. An earlier stamp in a
    later batch publishes nothing, but is kept as the listing's earliest. Text that is no stamp is not
    older or newer than any: each such text stays, once. A listing that was not seen for ``remember``
    seconds and a thousandth, and ``clock_slack`` more, counts as new. Time is that of the batch in which a
    row arrives, so no row is late. State needs the RocksDB store: the session's streams that begin from now on use it.
    """
    conf = listings.sparkSession.conf
    if "RocksDB" not in conf.get(_PROVIDER, ""):
        conf.set(_PROVIDER, _ROCKSDB)
    same = [name for name in listings.columns if name != created]
    stamped = F.col(created).rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")
    whole = F.to_json(F.struct(
        *same, F.when(~F.coalesce(stamped, F.lit(False)), F.col(created)).alias(created),
        F.coalesce(stamped, F.lit(False)).alias("_stamped")), {"ignoreNullFields": "false"})
    keyed = listings.withColumns({
        _DIGEST: F.sha2(whole, 256),
        _NUMBER: F.when(stamped, F.translate(created, "-: ", "").cast("bigint")),
        _SEEN: F.current_timestamp()}).withWatermark(_SEEN, clock_slack)
    # a column costs its share of every row and of every key's own record batch, so strings go as one
    texts = [field.name for field in listings.schema if field.dataType == StringType()]
    others = [name for name in listings.columns if name not in texts]
    packed = keyed.select(_DIGEST, _NUMBER, F.array(*map(F.col, texts)).alias(_TEXTS), *others)
    kept = StructType([StructField(_TEXTS, ArrayType(StringType())), *(listings.schema[name] for name in others)])
    first = packed.groupBy(_DIGEST).transformWithState(
        EarliestCapture(kept.names, remember), kept, "Append", "EventTime")
    return first.select(*(
        F.col(_TEXTS)[texts.index(name)].alias(name) if name in texts else name for name in listings.columns))
