"""Listing rows to keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.functions.json_text import encode_object
from gleanstream.functions.text import or_default
from gleanstream.schemas import MESSAGE_FIELDS, MESSAGE_KEY, NOT_ENCODABLE, TOPIC


def or_sentinel(value: Column) -> Column:
    return or_default(value, NOT_ENCODABLE)


def encode_value(fields: tuple[str, ...] = MESSAGE_FIELDS) -> Column:
    """Message text; a row that cannot be encoded is still sent, as a sentinel."""
    return or_sentinel(encode_object(fields))


def encode_messages(
    listings: DataFrame,
    keep: tuple[str, ...] = (),
    key: Column | None = None,
    topic: str = TOPIC,
) -> DataFrame:
    """``key, value, topic`` and the ``keep`` columns.

    The default key is one constant for all. Pass a key column to spread the
    messages over the partitions of a broker's topic.
    """
    return listings.select(
        *keep,
        (F.lit(MESSAGE_KEY) if key is None else key.cast("string")).alias("key"),
        encode_value().alias("value"),
        F.lit(topic).alias("topic"),
    )


def key_partition(key: Column, partitions: int) -> Column:
    """The partition of a topic that a key's messages go to; all without a key go to one."""
    return F.pmod(F.hash(key), F.lit(partitions))


def deal_by_key(messages: DataFrame, partitions: int) -> DataFrame:
    """Messages by partition of their topic, which is named in ``partition``; one shuffle.

    Messages of one key stay together, so that a consumer of the partition sees them all. With
    one key for all, every message goes to one partition: give :func:`encode_messages` a key.
    """
    return messages.repartition(partitions, "key").withColumn(
        "partition", key_partition(F.col("key"), partitions))
