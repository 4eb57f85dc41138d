import time
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from gleanstream.streaming.recaptures import EarliestCapture, drop_recaptures_in_stream

SCHEMA = "Job string, Company string, Created string"
BATCHES = [
    [("a", "x", "2024-01-05 00:00:00"), ("a", "x", "2024-01-03 00:00:00"), ("b", None, "2024-01-05 00:00:00"),
     ("n", "x", None), ("n", "x", "soon")],
    [("b", None, "2024-01-06 00:00:00"), ("b", "", "2024-01-06 00:00:00")],
    [("c", "x", "2024-01-07 00:00:00"), ("n", "x", "soon"), ("n", "x", "later"), ("n", "x", None)],
    [("a", "x", "2024-01-08 00:00:00"), ("a", "x", "2024-01-01 00:00:00"), ("d", "x", "2024-01-08 00:00:00")],
]
WANT = {("a", "x", "2024-01-03 00:00:00"), ("b", None, "2024-01-05 00:00:00"), ("n", "x", None),
        ("n", "x", "soon"), ("b", "", "2024-01-06 00:00:00"), ("c", "x", "2024-01-07 00:00:00"),
        ("n", "x", "later"), ("d", "x", "2024-01-08 00:00:00")}


@pytest.fixture
def stores(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    yield
    spark.conf.set(name, before)


def run(spark, root, batches, remember=3600, pause=0):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        # a query for each batch: what was seen outlives the process
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        drop_recaptures_in_stream(stream, remember=remember, clock_slack="0 seconds").writeStream.format("parquet").option(
            "path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(
            availableNow=True).start().awaitTermination()
        time.sleep(pause)
    return [tuple(row) for row in spark.read.schema(SCHEMA).parquet(f"{root}/out").collect()]


def test_a_listing_is_published_once_over_batches_and_restarts(spark, tmp_path, stores):
    got = run(spark, tmp_path, BATCHES)
    assert sorted(got, key=str) == sorted(WANT, key=str)
    state = spark.read.format("statestore").option("stateVarName", "earliest").load(f"{tmp_path}/checkpoint")
    assert state.count() == len(WANT)
    # the earlier stamp of batch 4 is known, though nothing is published for it
    assert state.where(F.col("value.number") == 20240101000000).count() == 1


def test_state_is_forgotten(spark, tmp_path, stores):
    row = ("a", "x", "2024-01-05 00:00:00")
    assert run(spark, tmp_path, [[row], [("b", "x", row[2])], [row]], remember=1, pause=2).count(row) == 2


class Handle:
    """A state store of one key that notes the messages it gets."""

    def __init__(self):
        self.messages, self.value = [], None

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.messages.append("exists")
        return self.value is not None

    def get(self):
        self.messages.append("get")
        return self.value

    def update(self, value):
        self.messages.append("update")
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.messages.append("timer")
        self.timer = at


class At:
    def __init__(self, ms):
        self.ms = ms

    getCurrentProcessingTimeInMs = getExpiryTimeInMs = lambda self: self.ms


def test_a_known_listing_costs_one_message():
    handle, processor = Handle(), EarliestCapture(["text"], 5000)
    processor.init(handle)

    def batch(number, ms):
        del handle.messages[:]
        now = Row(text="a", _number=number, _seen=datetime.fromtimestamp(ms / 1000))
        return [row.text for row in processor.handleInputRows(("k",), iter([now]), At(ms))], handle.messages

    assert batch(20240105, 1000) == (["a"], ["get", "update", "timer"])
    assert batch(20240106, 5999) == ([], ["get"])
    assert batch(20240104, 5999) == ([], ["get", "update"])
    assert handle.value == (20240104, 5999)
    assert batch(20240107, 11_000) == ([], ["get", "update"])
    assert handle.value == (20240104, 11_000)
    # never forgotten before 5000 s without a sighting, one that was not written included
    batch(20240107, 15_999)
    list(processor.handleExpiredTimer(("k",), At(0), At(5_011_000)))
    assert handle.value and handle.timer == 5_016_000 > 15_999 + 5_000_000
    list(processor.handleExpiredTimer(("k",), At(0), At(handle.timer)))
    assert handle.value is None


def test_columns_of_other_types_and_nulls_go_through(spark, tmp_path, stores):
    schema = "n int, Job string, at timestamp, Created string, tags array<string>"
    rows = [(1, "a", datetime(2024, 1, 5, 1, 2, 3, 4), "2024-01-05 00:00:00", ["x", None]),
            (None, None, None, "2024-01-05 00:00:00", None), (None, "", None, "2024-01-05 00:00:00", [])]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    drop_recaptures_in_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")).writeStream.format(
        "parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.columns == ["n", "Job", "at", "Created", "tags"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(rows, key=str)


def test_columns_without_any_text(spark, tmp_path, stores):
    spark.createDataFrame([(1, "2024-01-05 00:00:00"), (1, "2024-01-04 00:00:00")], "n int, Created string").write.parquet(
        f"{tmp_path}/in")
    stream = spark.readStream.schema("n int, Created string").parquet(f"{tmp_path}/in")
    drop_recaptures_in_stream(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert [tuple(row) for row in spark.read.parquet(f"{tmp_path}/out").collect()] == [(1, "2024-01-04 00:00:00")]
