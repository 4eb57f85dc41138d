"""Bounded samples of labelled documents, for fitting small models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import tables


def remainder(doc_id: str, modulus: int) -> Column:
    """The fold of a document; null ids have none and are never held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))


def held_out(doc_id: str, modulus: int, fold: int) -> Column:
    return F.coalesce(remainder(doc_id, modulus) == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, fold: int,
                    most: dict[int, int], columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """About ``most[l]`` documents with label l at most, none of the held-out fold.

    Returns doc_id, label, weight (labelled documents that one of the sample stands for) and
    the columns. Choice is by a hash of the id, so a rerun takes the same rows. Labels are cut
    to the sample before the join, which broadcasts no more than ``most`` allows. Null
    labels and ids are left out; contradicting labels of one id count as the larger.
    """
    known = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")
    ).filter(F.col("doc_id").isNotNull() & F.col("label").isin(*most)).groupBy("doc_id").agg(
        F.max("label").alias("label")).filter(remainder("doc_id", modulus) != fold)
    known = tables.stored(known, "labels")
    sizes = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    parts = 1 << 30
    share = F.pmod(F.xxhash64("doc_id"), F.lit(parts))
    wanted = F.lit(False)
    weight = F.lit(1.0)
    for value, size in sizes.items():
        fraction = min(1.0, most[value] / size)
        wanted |= (F.col("label") == value) & (share < int(fraction * parts))
        weight = F.when(F.col("label") == value, 1 / fraction).otherwise(weight)
    chosen = known.filter(wanted).select("doc_id", "label", weight.alias("weight"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *columns).join(
        F.broadcast(chosen), "doc_id").select("doc_id", "label", "weight", *columns)


def distinct_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, fold: int,
                    most: dict[int, int], columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """A stored table of ``most[l]`` documents with label l at most, whatever rows share an id.

    Rows of :func:`labelled_sample` that are equal in all columns count once a label, with the
    weight of all. If there still are more than ``most``, those with the smallest digests stay, and
    weigh the more. Returns digest (hexadecimal), label, weight and the columns.
    """
    whole = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    rows = labelled_sample(docs, labels, label, modulus, fold, most, columns).withColumn(
        "digest", F.sha2(whole, 256))
    rows = tables.stored(rows.groupBy("digest", "label").agg(
        F.sum("weight").alias("weight"), *(F.first(name).alias(name) for name in columns)), "sample")
    sizes = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    for value, size in sizes.items():
        if size > most[value]:
            # bounded: no more than ``most`` digests
            last = rows.filter(F.col("label") == value).select("digest").sort("digest").limit(
                most[value]).agg(F.max("digest")).first()[0]
            rows = rows.filter((F.col("label") != value) | (F.col("digest") <= last)).withColumn(
                "weight", F.when(F.col("label") == value, F.col("weight") * (size / most[value])).otherwise(
                    F.col("weight")))
    return rows
