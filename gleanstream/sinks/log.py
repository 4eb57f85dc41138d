"""Publishing messages.

A publish is one append without a shuffle: tasks write what they have, for all topics, to a folder
that no reader looks at, together with the report of what was delivered to each topic. When all is
written, the folder is renamed into the log: one step, by which all topics of the publish and its
report are there. Readers, streams among them, see a publish as a whole or not at all, and
a report of success can't be wrong. What went wrong is reported apart from the records.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleanstream.sources.log import check_topic, publish_path

_REPORT = "publish_id string, topic string, status string, messages bigint, error string"


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; one step in a file system, and a copy in most object stores."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(target).getParent())
    if not files.rename(path(source), path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def _report(spark: SparkSession, path: str, publish_id: str, rows: list[tuple]) -> None:
    frame = spark.createDataFrame([(publish_id, *row) for row in rows], _REPORT)
    frame.coalesce(1).write.parquet(path)


def publish_to_log(
    messages: DataFrame, log_dir: str, order_by: Sequence[str] = (),
    published_at: Column | None = None,
) -> str:
    """Append ``key, value, topic`` rows to the log; returns the id of this publish.

    Messages stay where and as they are; ``order_by`` asks for a sort of them all. A publish
    that fails leaves nothing to be read in any topic, and is reported as failed.
    """
    spark = messages.sparkSession
    publish_id = uuid.uuid4().hex
    stage = f"{log_dir}/unpublished/{publish_id}"
    moment = F.lit(datetime.now()) if published_at is None else published_at
    rows = messages.sort(*order_by) if order_by else messages
    try:
        rows.select("key", "value", "topic", moment.cast("timestamp").alias("timestamp")).write.partitionBy(
            "topic").parquet(stage)
        # by partition value and row counts of the files
        counts = spark.read.schema("value string, topic string").parquet(stage).groupBy(
            "topic").count().collect()
        for row in counts:
            check_topic(row["topic"] or "")
        if counts:
            _report(spark, f"{stage}/report", publish_id,
                    [(row["topic"], "ok", row["count"], None) for row in counts])
            _move(spark, stage, publish_path(log_dir, publish_id))
    except Exception as error:
        _report(spark, f"{log_dir}/failures/{publish_id}", publish_id,
                [(None, "failed", 0, str(error) or type(error).__name__)])
        raise
    return publish_id


def delivery_report(
    spark: SparkSession, log_dir: str, publish_id: str | None = None
) -> DataFrame:
    """What each publish delivered to each topic, or why it failed; of one publish or of all."""
    found = spark.createDataFrame([], _REPORT)
    for path in (f"{publish_path(log_dir, publish_id or '*')}/report", f"{log_dir}/failures/{publish_id or '*'}"):
        try:
            found = found.unionByName(spark.read.schema(_REPORT).parquet(path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def publish_to_kafka(messages: DataFrame, servers: str) -> DataFrame:
    """The same messages to a broker, confirmed by all in-sync replicas.

    Returns the report, with the count taken in the same pass. A publish that fails raises.
    """
    spark = messages.sparkSession
    seen = Observation()
    (
        messages.select("key", "value", "topic").observe(seen, F.count(F.lit(1)).alias("messages"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").save()
    )
    return spark.createDataFrame([(None, None, "ok", seen.get["messages"], None)], _REPORT)
