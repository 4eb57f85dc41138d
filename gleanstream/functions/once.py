"""Keeping a costly expression from being computed more than once per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, struct: Column, names: Sequence[str]) -> DataFrame:
    """Add the fields of a struct as columns that are computed once per row.

    A plain projection would not do: a later filter on a column of it, also one the
    optimizer derives itself, is pushed below and takes the whole computation along,
    once for every mention of a field. Nothing is pushed below a generator, and one
    of a single element adds no rows and needs no shuffle.
    """
    return df.select("*", F.inline(F.array(struct)).alias(*names))
