import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from gleanstream.functions.text import strip_space
from gleanstream.operators.encode import deal_by_key, encode_messages
from gleanstream.schemas import MESSAGE_FIELDS
from gleanstream.sinks import log as sink
from gleanstream.sources import log as source


def messages(spark, n, first=0, key="'name'", topic="t"):
    return spark.range(first, first + n).selectExpr(
        "id", f"{key} AS key", "concat('v', id) AS value", f"'{topic}' AS topic")


def test_a_publish_is_a_plain_append(spark, tmp_path, monkeypatch):
    """No shuffle, and the input is read once."""
    plans = []
    write = DataFrameWriter.parquet

    def noted(self, *args, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    sink.publish_to_log(messages(spark, 1000), str(tmp_path))
    assert len(plans) == 2 and not any("Exchange" in plan for plan in plans[:1])
    assert source.read_log(spark, str(tmp_path), "t").count() == 1000


def test_records_have_places(spark, tmp_path):
    path = str(tmp_path)
    sink.publish_to_log(messages(spark, 100).repartition(3), path, ("id",))
    rows = source.read_log(spark, path, "t").orderBy("place", "row").collect()
    assert len({(r["place"], r["row"]) for r in rows}) == 100
    assert [r["value"] for r in rows] == [f"v{i}" for i in range(100)]  # a sort was asked for


def test_publishes_add_up(spark, tmp_path):
    path = str(tmp_path)
    first = sink.publish_to_log(messages(spark, 10), path)
    second = sink.publish_to_log(messages(spark, 5, first=10), path)
    third = sink.publish_to_log(messages(spark, 3, topic="u"), path)
    report = {r["publish_id"]: tuple(r)[1:] for r in sink.delivery_report(spark, path).collect()}
    assert report == {first: ("t", "ok", 10, None), second: ("t", "ok", 5, None), third: ("u", "ok", 3, None)}
    assert tuple(sink.delivery_report(spark, path, second).first())[1:] == ("t", "ok", 5, None)
    rows = source.read_log(spark, path, "t").collect()
    assert {r["publish_id"] for r in rows} == {first, second} and len(rows) == 15
    assert source.read_log(spark, path, "u").count() == 3


def test_two_topics_in_one_publish(spark, tmp_path):
    path = str(tmp_path)
    both = messages(spark, 10).union(messages(spark, 6, topic="u"))
    sink.publish_to_log(both, path)
    sink.publish_to_log(messages(spark, 2, first=10), path)
    for topic, n in (("t", 12), ("u", 6)):
        rows = source.read_log(spark, path, topic).collect()
        assert sorted(int(r["value"][1:]) for r in rows) == list(range(n))
        assert {r["topic"] for r in rows} == {topic}


def test_topic_names_are_checked(spark):
    for name in ("a/b", "", "x" * 250, "..\\a"):
        with pytest.raises(ValueError):
            source.read_log(spark, "/tmp", name)


def test_nothing_to_publish(spark, tmp_path):
    path = str(tmp_path)
    sink.publish_to_log(messages(spark, 0), path)
    sink.publish_to_log(messages(spark, 2), path)
    assert source.read_log(spark, path, "t").count() == 2
    assert sink.delivery_report(spark, path).count() == 1
    assert sink.delivery_report(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("broken", ["while writing", "before it is moved", "by its topic"])
def test_a_failed_publish_is_reported_and_not_seen(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path)
    sink.publish_to_log(messages(spark, 4), path)
    stream = source.stream_log(spark, path, "t")
    rows = messages(spark, 400, first=4).repartition(4)
    if broken == "while writing":
        rows = rows.withColumn("value", F.when(F.col("id") == 200, F.raise_error(F.lit("broken"))).otherwise(
            F.col("value")))
    elif broken == "before it is moved":
        monkeypatch.setattr(sink, "_move", lambda *_: 1 / 0)
    else:
        rows = rows.withColumn("topic", F.lit("a/b"))
    with pytest.raises(Exception):  # noqa: B017 - each has its own
        sink.publish_to_log(rows, path)
    monkeypatch.undo()
    sink.publish_to_log(messages(spark, 2, first=8), path)
    want = ["v0", "v1", "v2", "v3", "v8", "v9"]
    assert sorted(r["value"] for r in source.read_log(spark, path, "t").collect()) == want
    report = sink.delivery_report(spark, path).collect()
    assert sorted((r["status"], r["messages"]) for r in report) == [("failed", 0), ("ok", 2), ("ok", 4)]
    assert all((r["error"] is None) == (r["status"] == "ok") for r in report)
    query = stream.writeStream.format("parquet").option("path", f"{path}-rows").option(
        "checkpointLocation", f"{path}-cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["value"] for r in spark.read.parquet(f"{path}-rows").collect()) == want


@pytest.mark.parametrize("moment", ["before the move", "while reporting"])
def test_a_publish_of_several_topics_is_seen_in_all_or_none(spark, tmp_path, monkeypatch, moment):
    path = str(tmp_path)
    names = ("t", "u", "v")
    sink.publish_to_log(messages(spark, 2), path)
    streams = {name: source.stream_log(spark, path, name) for name in names}
    many = messages(spark, 6, first=2).withColumn(
        "topic", F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 3 + 1).cast("int")))
    name = "_move" if moment == "before the move" else "_report"
    real = getattr(sink, name)
    calls = []

    def broken(*args):
        calls.append(args)
        if len(calls) == 1:
            raise OSError("target is down")
        return real(*args)

    monkeypatch.setattr(sink, name, broken)
    with pytest.raises(OSError):
        sink.publish_to_log(many, path)
    assert [source.read_log(spark, path, name).count() for name in names] == [2, 0, 0]
    assert {tuple(row)[1:] for row in sink.delivery_report(spark, path).collect()} == {
        ("t", "ok", 2, None), (None, "failed", 0, "target is down")}
    monkeypatch.undo()
    again = sink.publish_to_log(many, path)
    assert [source.read_log(spark, path, name).count() for name in names] == [4, 2, 2]
    report = {(row["topic"], row["status"], row["messages"]) for row in
              sink.delivery_report(spark, path, again).collect()}
    assert report == {(name, "ok", 2) for name in names}
    total = [(row["status"], row["messages"]) for row in sink.delivery_report(spark, path).collect()]
    assert sorted(total) == [("failed", 0), ("ok", 2), ("ok", 2), ("ok", 2), ("ok", 2)]
    for name, stream in streams.items():  # started before the topics had a record
        query = stream.writeStream.format("parquet").option("path", f"{path}-{name}").option(
            "checkpointLocation", f"{path}-{name}-cp").trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.read.parquet(f"{path}-{name}").count() == (4 if name == "t" else 2)


def test_keys_are_dealt_to_partitions(spark):
    rows = messages(spark, 1000, key="IF(id % 10 = 0, NULL, CAST(id % 37 AS STRING))")
    dealt = deal_by_key(rows, 5).withColumn("place", F.spark_partition_id()).collect()
    assert len(dealt) == 1000 and all(row["partition"] == row["place"] for row in dealt)
    places = {}
    for row in dealt:
        assert places.setdefault(row["key"], row["place"]) == row["place"]
    assert len(set(places.values())) == 5 and None in places


def test_published_at(spark, tmp_path):
    moment = datetime.datetime(2024, 1, 1)
    sink.publish_to_log(messages(spark, 1), str(tmp_path), published_at=F.lit(moment))
    assert source.read_log(spark, str(tmp_path), "t").first()["timestamp"] == moment


def test_encode(spark):
    values = ("k w", 'a "q"', "b\\c", None, "é\n", "", "/", "t")
    frame = spark.createDataFrame([values], ", ".join(f"{n} string" for n in MESSAGE_FIELDS))
    row = encode_messages(frame).first()
    assert (row["key"], row["topic"]) == ("name", "jobs-data")
    assert row["value"] == (
        '{"SearchKeyWord":"k w","Job":"a \\"q\\"","Company":"b\\\\c","Salary":null,'
        '"Location":"é\\n","Deadline":"","JobDetails":"/","Created":"t"}')
    assert encode_messages(frame, key=F.col("Job")).first()["key"] == 'a "q"'


def test_strip_space_takes_all_kinds(spark):
    text = "﻿   a b \t\r\n　"
    frame = spark.createDataFrame([(text,), ("\x1ca\x1c",), (" ",), (None,)], "t string")
    assert [r[0] for r in frame.select(strip_space(F.col("t"))).collect()] == ["a b", "\x1ca\x1c", "", None]


def test_broker_settings():
    options = source.kafka_options("h:1", group="g", records_per_batch=10)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "jobs-data", "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed", "kafka.group.id": "g", "maxOffsetsPerTrigger": "10"}


def test_broker_needs_its_connector(spark):
    with pytest.raises(AnalysisException):
        source.stream_kafka(spark, "h:1")
    with pytest.raises(AnalysisException):
        sink.publish_to_kafka(messages(spark, 1), "h:1")
