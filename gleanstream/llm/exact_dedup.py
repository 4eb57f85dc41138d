"""Exact dedup: two Bloom passes find what may repeat, and only those rows shuffle.

Native: DataFrame functions only. Texts are equal when they are the same after deleting
ASCII white space. Of equal texts the longest original stays, then the smallest doc_id.

Null texts count as empty; null doc_ids come after all others. Rows that share both doc_id
and text are one document: they share a verdict, and :func:`drop_copies` keeps one of them.
An empty table gives an empty result; further columns, of whatever name, are let through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import tables

# Fixed value: the white space that does not tell texts apart.
IGNORED = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), IGNORED, "")


def _hashed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    sha = F.unhex(F.sha2(normalised(F.col(text)), 256))
    return docs.select(
        F.col(doc_id).alias("doc_id"), sha.alias("sha"), F.xxhash64(sha).alias("key"),
        F.coalesce(F.length(text), F.lit(0)).alias("length"))


def _order() -> Column:
    return F.struct(-F.col("length"), F.col("doc_id").isNull(), F.col("doc_id"))


def _repeats(rows: DataFrame, most_bits: int) -> tuple[DataFrame, DataFrame, int]:
    """Groups of two or more equal texts, the repeat filter, and its bits."""
    bits = tables.filter_bits(rows.count(), most_bits)
    bitmaps = tables.stored(tables.repeat_filter(rows, "key", bits), "repeat-filter")
    candidates = tables.with_maybe(rows, "key", bitmaps, bits).filter("maybe")
    groups = candidates.groupBy("sha").agg(
        F.count("*").alias("group_size"), F.min(_order())["doc_id"].alias("keep_id"))
    return tables.stored(groups.filter("group_size > 1"), "text-groups"), bitmaps, bits


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 most_bits: int = tables.FILTER_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = tables.stored(_hashed(docs, text, doc_id), "text-hashes")
    groups, bitmaps, bits = _repeats(rows, most_bits)
    marked = tables.with_maybe(rows, "key", bitmaps, bits)
    alone = marked.filter(~F.col("maybe")).select(
        "doc_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("size"))
    repeated = tables.attach(marked.filter("maybe"), groups, "sha", "group_size").select(
        "doc_id", "sha", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(
            F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("size"))
    return alone.unionByName(repeated).select(
        "doc_id", "keep_id", F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                most_bits: int = tables.FILTER_BITS) -> DataFrame:
    """The documents that stay, with all their columns; only possible repeats are shuffled."""
    groups, bitmaps, bits = _repeats(
        tables.stored(_hashed(docs, text, doc_id), "text-hashes"), most_bits)
    sha = F.unhex(F.sha2(normalised(F.col(f"row.{text}")), 256))
    rows = tables.packed(docs).withColumn("sha", sha).withColumn("key", F.xxhash64("sha"))
    marked = tables.with_maybe(rows, "key", bitmaps, bits)
    checked = tables.attach(marked.filter("maybe"), groups, "sha", "group_size")
    stays = F.col("group_size").isNull() | F.col(f"row.{doc_id}").eqNullSafe(F.col("keep_id"))
    # rows repeated as a whole: equal in doc_id and text
    one = checked.filter(stays).withColumn("_id", F.col(f"row.{doc_id}")).dropDuplicates(
        ["_id", "sha"])
    return marked.filter(~F.col("maybe")).select("row.*").unionByName(one.select("row.*"))


ORACLE_SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(length(text), 0) AS len,
    sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))
      AS text_sha256
  FROM documents),
placed AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM hashed WINDOW w AS (PARTITION BY text_sha256 ORDER BY len DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM placed"""
