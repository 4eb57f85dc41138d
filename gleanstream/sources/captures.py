"""Page captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanstream.schemas import CAPTURE


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CAPTURE).parquet(path)


def url_page_number(url: Column) -> Column:
    """``page=<n>`` of a URL; a URL without one is the first page, number 0.

    A number beyond any type is a far page, never the first.
    """
    digits = F.regexp_extract(url, r"[?&]page=(\d+)", 1)
    far = F.lit(2**63 - 1)
    return F.when(F.coalesce(digits, F.lit("")) == "", 0).otherwise(
        F.coalesce(digits.try_cast("bigint"), far))
