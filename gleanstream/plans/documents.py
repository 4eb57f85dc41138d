"""A collection of JSON documents to the snapshot."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from gleanstream.operators import clean
from gleanstream.sinks.snapshot import FullSnapshot, Refresh, last_refresh, write_refresh_log


def documents_snapshot(
    documents: DataFrame, query_at: str, rejects_dir: str, text: str = "document",
    dedup: bool = False,
) -> DataFrame:
    """Objects only, storage id gone, guarded, stamped; one lazy plan.

    A document with a search word that lacks another field is written to ``rejects_dir``
    with the reason before this returns, and is left out of the snapshot.
    """
    objects = clean.only_objects(documents, text)
    clean.missing_field_rejects(objects, text).write.mode("overwrite").parquet(rejects_dir)
    return clean.snapshot(clean.drop_id(clean.guard_missing(objects, text)), query_at, dedup)


def publish_documents(
    documents: DataFrame, store: str, query_at: str, text: str = "document", dedup: bool = False,
) -> None:
    """Publish the snapshot of a collection of documents in a store, as a full refresh.

    Readers see it once it is logged; the last one stays readable until then. What lacks a field
    goes to ``rejects-documents`` in the store, a folder for each refresh.
    """
    spark = documents.sparkSession
    published, log = f"{store}/published", f"{store}/refreshes"
    publisher, run = FullSnapshot(published), uuid.uuid4().hex

    def newest_place() -> str | None:
        last = last_refresh(spark, log, publisher.kind)
        return last["place"] if last else None

    refresh = Refresh(f"documents-{run}", 0, query_at, last_place=newest_place(), newest_place=newest_place)
    rows = documents_snapshot(documents, query_at, f"{store}/rejects-documents/run={run}", text, dedup)
    place = error = None
    try:
        place = publisher.publish(rows, refresh)
    except Exception as problem:
        error = str(problem) or type(problem).__name__
        raise
    finally:
        records = spark.read.schema(rows.schema).parquet(f"{published}/{place}").count() if place else 0
        write_refresh_log(spark, log, refresh, publisher.kind, records, place, error)
        publisher.release(spark, refresh)
