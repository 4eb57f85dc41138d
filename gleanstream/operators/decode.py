"""Log records to posting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.functions.json_text import (
    NESTING_LIMIT, all_present, field_present, field_text, is_object, parse_object,
)
from gleanstream.schemas import MESSAGE_FIELDS, MESSAGE_TO_POSTING


def decode_log_strings(raw: DataFrame) -> DataFrame:
    """Key and value bytes to strings; every other column stays."""
    return raw.withColumns({
        "key": F.col("key").cast("string"),
        "value": F.col("value").cast("string"),
    })


def decode_listings(
    records: DataFrame, keep: tuple[str, ...] = (), null_text: str = "literal"
) -> DataFrame:
    """JSON ``value`` to the eight message fields, plus the ``keep`` columns.

    A record that does not parse, or lacks any key, becomes a row of nulls: it
    travels on and is counted, it is never dropped here.
    """
    parsed = parse_object(records.select(*keep, "value"), "value", MESSAGE_FIELDS)
    complete = all_present(MESSAGE_FIELDS)
    return parsed.select(*keep, *[
        F.when(complete, field_text(name, null_text)).alias(name)
        for name in MESSAGE_FIELDS
    ])


def rename_fields(listings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Message field names to posting column names, in posting order."""
    return listings.select(*keep, *[
        F.col(old).alias(new) for old, new in MESSAGE_TO_POSTING.items()
    ])


def decode_postings(
    records: DataFrame, keep: tuple[str, ...] = (), null_text: str = "literal"
) -> DataFrame:
    return rename_fields(decode_listings(records, keep, null_text), keep)


def _reason() -> Column:
    """Why a parsed record decodes to a row of nulls; looked at for such records only."""
    absent = F.concat_ws(",", *[
        F.when(~field_present(name), F.lit(name)) for name in MESSAGE_FIELDS])
    deep = F.regexp_count("value", F.lit(r"[\[{]")) > NESTING_LIMIT
    return (
        F.when(F.col("value").isNull(), "no text")
        .when(is_object(F.col("value")), F.concat(F.lit("lacks: "), absent))
        .when(deep & F.trim("value").startswith("{"), "nested too deeply for the parser")
        .otherwise("not a JSON object"))


def decode_rejects(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The records that decode to a row of nulls, each with the reason.

    Text that the parser's nesting limit refuses is told apart from malformed text.
    """
    parsed = parse_object(records.select(*keep, "value"), "value", MESSAGE_FIELDS)
    return parsed.where(~all_present(MESSAGE_FIELDS)).select(*keep, "value", _reason().alias("reason"))


def decode_tagged(
    records: DataFrame, keep: tuple[str, ...] = (), null_text: str = "literal"
) -> DataFrame:
    """Postings and rejects in one parse: ``value``, ``reason`` and the posting columns.

    Every record is there, as :func:`decode_postings` gives it; ``reason`` is set, and says what
    :func:`decode_rejects` says, for a record that decodes to a row of nulls.
    """
    parsed = parse_object(records.select(*keep, "value"), "value", MESSAGE_FIELDS)
    complete = all_present(MESSAGE_FIELDS)
    return parsed.select(*keep, "value", F.when(~complete, _reason()).alias("reason"), *[
        F.when(complete, field_text(old, null_text)).alias(new)
        for old, new in MESSAGE_TO_POSTING.items()])


def record_trace(raw: DataFrame) -> DataFrame:
    """Keys and values with their places: partition and offset, or file and row."""
    places = [name for name in ("partition", "offset", "place", "row") if name in raw.columns]
    return raw.select("key", "value", *places)


def batch_count(records: DataFrame) -> DataFrame:
    """How many records arrived, malformed ones included."""
    return records.agg(F.count(F.lit(1)).alias("records"))
