"""Captured pages to messages on a log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from gleanstream.operators.encode import encode_messages
from gleanstream.operators.extract import extract_listings, page_budget
from gleanstream.session import ship_code
from gleanstream.sinks.log import publish_to_log

ORDER = ("page_id", "position")


def listing_messages(
    captures: DataFrame, keyword: str | Column, captured_at: Column,
    page_no: Column | None = None, pages: int | None = None, key: Column | None = None,
    **extraction,
) -> DataFrame:
    """Messages, with the page id and position they come from; one lazy plan."""
    if pages is not None:
        captures = page_budget(captures, page_no, pages)
    rows = extract_listings(captures, keyword, captured_at, **extraction)
    return encode_messages(rows, keep=ORDER, key=key)


def acquire(
    captures: DataFrame, log_dir: str, keyword: str | Column, captured_at: Column, **options,
) -> str:
    """Extract and publish in one pass over the pages; returns the id of the publish."""
    ship_code(captures.sparkSession)
    return publish_to_log(listing_messages(captures, keyword, captured_at, **options), log_dir)
