import brute
import pytest
from pyspark.sql import functions as F

from gleanstream.llm import exact_dedup, tables

ROWS = [
    (1, "a b"), (2, "ab"), (3, "a\tb "), (4, None), (5, ""), (6, " \n"), (7, "c"), (8, "c"),
    (9, "x y"), (10, "xy"), (11, "😀 a"), (12, "😀a"), (13, "long " * 5000), (14, "long" * 5000),
]


def result(df):
    return {row["doc_id"]: (row["keep_id"], row["group_size"]) for row in df.collect()}


@pytest.mark.parametrize("bits", [tables.BLOCK_BITS, 2**20])
def test_against_plain(spark, bits):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    got = exact_dedup.exact_groups(docs, most_bits=bits)
    assert result(got) == brute.exact_groups(ROWS)
    assert all(row["kept"] == (row["doc_id"] == row["keep_id"]) for row in got.collect())


def test_full_filter_changes_nothing(spark):
    """More rows than the filter has bits: all rows are candidates, and results are the same."""
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), (F.col("id") % 50_000).cast(
        "string").alias("text"))
    got = exact_dedup.exact_groups(docs, most_bits=tables.BLOCK_BITS)
    assert got.filter("kept").count() == 50_000 and got.filter("group_size = 2").count() == 20_000


def test_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_groups(docs)
    assert got.filter("group_size = 1000 AND keep_id = 0").count() == 1000
    assert got.filter("group_size = 1").count() == 2000


def test_copies_go_with_all_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a", 7, "k"), (1, "a", 7, "k"), (2, "a ", 8, "l"), (3, None, None, None),
         (None, "b", 1, "m"), (4, "b", 2, "n"), (None, "z", 3, "o"), (None, "z", 3, "o")],
        "doc_id bigint, text string, sha int, row string")
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    rows = {(row["doc_id"], row["text"], row["sha"], row["row"]) for row in got.collect()}
    assert rows == {(2, "a ", 8, "l"), (3, None, None, None), (4, "b", 2, "n"), (None, "z", 3, "o")}
    assert got.count() == 4


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0


def test_no_python_and_few_rows_shuffled(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    plan = exact_dedup.drop_copies(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
