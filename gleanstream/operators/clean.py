"""Stored postings to the published snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.functions.json_text import (
    all_present, field_present, field_text, is_object, parse_object,
)
from gleanstream.schemas import POSTING_FIELDS

_GUARD = POSTING_FIELDS[0]


def only_objects(documents: DataFrame, text: str = "document") -> DataFrame:
    """Keep the rows whose text is a JSON object."""
    return documents.where(is_object(F.col(text)))


def drop_id(rows: DataFrame) -> DataFrame:
    """Remove the storage id."""
    return rows.drop("_id")


def _document_rows(parsed: DataFrame, keep: tuple[str, ...], null_text: str) -> DataFrame:
    guard = field_present(_GUARD)
    return parsed.select(*keep, *[
        F.when(guard, field_text(name, null_text)).alias(name)
        for name in POSTING_FIELDS
    ])


def _absent_fields() -> Column:
    """Names of the keys a document lacks, joined by commas; empty when whole."""
    return F.concat_ws(",", *[
        F.when(~field_present(name), F.lit(name)) for name in POSTING_FIELDS
    ])


def guard_missing(
    documents: DataFrame,
    text: str = "document",
    keep: tuple[str, ...] = (),
    on_missing: str = "quarantine",
    null_text: str = "literal",
) -> DataFrame:
    """JSON documents to posting rows.

    Without a ``SearchWord`` key a document gives a row of nulls. With one but
    without some other key it is an error: ``fail`` ends the job, ``quarantine``
    leaves the row out (see :func:`missing_field_rejects` for those rows).
    """
    parsed = parse_object(documents.select(*keep, text), text, POSTING_FIELDS)
    partial = field_present(_GUARD) & ~all_present(POSTING_FIELDS)
    if on_missing == "fail":
        check = F.when(
            partial,
            F.raise_error(F.concat(F.lit("document lacks: "), _absent_fields())).cast("boolean"),
        ).otherwise(F.lit(True))
        return _document_rows(parsed.where(check), keep, null_text)
    if on_missing != "quarantine":
        raise ValueError("on_missing must be 'fail' or 'quarantine'")
    return _document_rows(parsed.where(~partial), keep, null_text)


def missing_field_rejects(
    documents: DataFrame, text: str = "document", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The documents that quarantine leaves out, each with the reason."""
    parsed = parse_object(documents.select(*keep, text), text, POSTING_FIELDS)
    partial = field_present(_GUARD) & ~all_present(POSTING_FIELDS)
    return parsed.where(partial).select(
        *keep, text, F.concat(F.lit("document lacks: "), _absent_fields()).alias("reason")
    )


def with_search_word(postings: DataFrame) -> DataFrame:
    """Keep the rows that have a search word; reaches the Parquet scan."""
    return postings.where(F.col(_GUARD).isNotNull())


def stamp_query_at(postings: DataFrame, query_at: str) -> DataFrame:
    """One constant for the whole refresh."""
    return postings.withColumn("QueryAt", F.lit(query_at))


def dedup_rows(postings: DataFrame) -> DataFrame:
    """Whole-row dedup; off unless asked for. Copies collapse before the shuffle."""
    return postings.dropDuplicates()


def snapshot(postings: DataFrame, query_at: str, dedup: bool = False) -> DataFrame:
    """All published rows: search word present, stamped, storage columns gone."""
    rows = with_search_word(postings.select(*POSTING_FIELDS))
    if dedup:
        rows = dedup_rows(rows)
    return stamp_query_at(rows, query_at)
