"""The operators over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanstream.llm import (
    alignment, bpe, decontaminate, exact_dedup, line_dedup, near_dedup, periodic, quality,
    quality_rules, secret_scan, toxicity, url_filter, warc,
)
from gleanstream.session import run_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """A tokenizer file; by default that of the encoding query."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of pages are the labels with the same id: toxic or of low quality is bad."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.expr("toxic = 1 OR quality = 0").alias("bad"))
    return url_filter.judged(table(spark, sf_dir, "pages"), outcomes).drop("reputation")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, with_payload=False, strict=True).drop(
        "url", "html", "problem")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.without_boilerplate(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed",
        F.sha2("clean", 256).alias("clean_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(
        table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(), with_ids=False
    ).select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
        vocabulary("piece_bpe_32k.model"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic.run_digests(periodic.with_planted_runs(docs))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {query.__name__: query for query in (
    op1_exact_dedup, op2_toxicity, op3_url_filter, op4_warc, op5_near_dedup, op6_secret_scan,
    op7_line_dedup, op8_bpe, op9_decontaminate, op10_quality,
    op11_token_alignment, op12_periodic_runs, op13_quality_rules)}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.ORACLE_SQL.strip(),
    "op3_url_filter": url_filter.ORACLE_SQL.strip(),
    "op4_warc": warc.ORACLE_SQL.strip(),
    "op7_line_dedup": line_dedup.ORACLE_SQL.strip(),
    "op9_decontaminate": decontaminate.ORACLE_SQL.strip(),
}
