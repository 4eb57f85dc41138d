"""The message log as a stream or as a table.

The file-backed log needs nothing but a shared folder. The broker-backed one has
the same columns and needs the Kafka connector jar.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanstream.schemas import RAW, TOPIC

_TOPIC = re.compile(r"[A-Za-z0-9._-]{1,249}")
_IN_FILES = T.StructType([
    *(field for field in RAW.fields if field.name in ("key", "value", "timestamp")),
    T.StructField("publish_id", T.StringType()),
])


def check_topic(topic: str) -> str:
    if not _TOPIC.fullmatch(topic):
        raise ValueError(f"not a topic name: {topic!r}")
    return topic


def publish_path(log_dir: str, publish_id: str) -> str:
    """Folder of one publish: all its topics, and its report."""
    return f"{log_dir}/records/publish_id={publish_id}"


def topic_path(log_dir: str, topic: str) -> str:
    """A pattern for one topic's folder in every publish."""
    return f"{publish_path(log_dir, '*')}/topic={check_topic(topic)}"


def create_topic(spark: SparkSession, log_dir: str, topic: str = TOPIC) -> None:
    """An empty topic, unless it is there; a stream may then start before any publish."""
    folders = spark._jvm.org.apache.hadoop.fs.Path(topic_path(log_dir, topic))
    if not folders.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folders):
        spark.createDataFrame([], _IN_FILES).drop("publish_id").write.mode("ignore").parquet(
            f"{publish_path(log_dir, 'none')}/topic={topic}")


def _raw(records: DataFrame, topic: str) -> DataFrame:
    """``place`` and ``row`` say where a record lies: its file, and its number in there."""
    return records.select(
        "key", "value", F.lit(topic).alias("topic"), "publish_id",
        F.col("_metadata.file_path").alias("place"), F.col("_metadata.row_index").alias("row"),
        "timestamp")


def stream_log(
    spark: SparkSession, log_dir: str, topic: str = TOPIC,
    files_per_batch: int | None = None, bytes_per_batch: int | None = None,
) -> DataFrame:
    """One topic as a stream, from its first record.

    A publish is seen once it is complete. The two bounds keep a micro-batch small when
    the stream starts on a long log.
    """
    create_topic(spark, log_dir, topic)
    # by default files a week older than the newest would be passed over
    reader = spark.readStream.schema(_IN_FILES).option("maxFileAge", "36500d").option(
        "basePath", f"{log_dir}/records")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    elif bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return _raw(reader.parquet(topic_path(log_dir, topic)), topic)


def read_log(spark: SparkSession, log_dir: str, topic: str = TOPIC) -> DataFrame:
    reader = spark.read.schema(_IN_FILES).option("basePath", f"{log_dir}/records")
    return _raw(reader.parquet(topic_path(log_dir, topic)), topic)


def kafka_options(
    servers: str, topic: str = TOPIC, group: str | None = None,
    records_per_batch: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
    }
    if group:
        options["kafka.group.id"] = group
    if records_per_batch:
        options["maxOffsetsPerTrigger"] = str(records_per_batch)
    return options


def stream_kafka(spark: SparkSession, servers: str, topic: str = TOPIC, **limits) -> DataFrame:
    """One broker topic as a stream; progress is kept in the query's checkpoint."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **limits))
    return reader.load().select(*RAW.names)
