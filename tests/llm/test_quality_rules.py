import random

import numpy as np
from brute import quality_counts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanstream.llm import quality_rules as rules
from gleanstream.llm import queries

NAMES = list(rules.STATISTICS)


def test_counts_against_plain():
    random.seed(2)
    pieces = ["a", "b", "a b c", "é", " ", " ", "\n", "\n\n", "\t", "\x0b", "\x85", "$", "|#", "a b c\n"]
    for _ in range(500):
        text = "".join(random.choices(pieces, k=random.randint(0, 40)))
        assert rules.counts(text.encode())[:5] == quality_counts(text), repr(text)


def _values(size, seed=1):
    random = np.random.default_rng(seed)
    return {name: np.round(random.random(size), 3) for name in NAMES}


def test_finds_ordered_conjunctions():
    values = _values(6000)
    bad = ((values["symbols_a_word"] >= 0.8) & (values["word_length"] <= 0.5)) | (
        values["repeated_lines"] >= 0.9)
    found = rules.learned(values, bad, np.ones(6000), np.arange(6000) % 3 > 0)
    assert 2 <= len(found.rules) <= 5 and str(found).endswith("else good")
    fresh = _values(4000, seed=9)
    bad = ((fresh["symbols_a_word"] >= 0.8) & (fresh["word_length"] <= 0.5)) | (
        fresh["repeated_lines"] >= 0.9)
    assert ((found.first(fresh, 4000) > 0) == bad).mean() > 0.97


def test_pruning_drops_what_only_fits_the_sample():
    """A third of the labels is noise: rules stay short, and say little of what can't be known."""
    values = _values(3000)
    noise = np.random.default_rng(4).random(3000) < 0.05
    bad = (values["bars_a_word"] >= 0.7) ^ noise
    found = rules.learned(values, bad, np.ones(3000), np.arange(3000) % 3 > 0)
    assert found.rules and found.rules[0][0].statistic == "bars_a_word"
    fresh = _values(3000, seed=8)
    assert ((found.first(fresh, 3000) > 0) == (fresh["bars_a_word"] >= 0.7)).mean() > 0.95
    none = rules.learned(values, noise, np.ones(3000), np.arange(3000) % 3 > 0)
    assert none == rules.DecisionList() and none.first(values, 3000).sum() == 0


def test_expression_says_what_the_list_says(spark):
    random = np.random.default_rng(5)
    table = [tuple(int(n) for n in random.integers(0, 9, len(rules.COUNTS))) for _ in range(300)]
    counted = spark.createDataFrame(table, ", ".join(f"{name} bigint" for name in rules.COUNTS))
    some = rules.DecisionList((
        (rules.Condition("symbols_a_word", True, 1.5), rules.Condition("words", False, 4.0)),
        (rules.Condition("repeated_lines", True, 0.8),)))
    rows = counted.select(
        F.coalesce(some.column(), F.lit(0)).alias("rule"),
        *(rules.statistic(name).alias(name) for name in NAMES)).toPandas()
    want = some.first({name: rows[name].to_numpy() for name in NAMES}, len(rows))
    assert rows["rule"].tolist() == want.tolist() and set(want) == {0, 1, 2}
    assert counted.select(rules.DecisionList().column().alias("r")).filter("r IS NOT NULL").isEmpty()


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{name}.parquet") for name in ("documents", "labels"))
    rows = rules.judged(docs.select("doc_id", "text"), rules.fit(docs, labels)).select(
        "row.doc_id", "base_failed", "kept").join(labels, "doc_id")
    held = rows.filter("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 AND NOT base_failed").toPandas()
    assert len(held) > 500 and (held["kept"] == (held["quality"] == 1)).mean() > 0.98


def test_query_against_plain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = {row["doc_id"]: row for row in queries.op13_quality_rules(spark, sf).collect()}
    assert len(rows) == len(docs)
    for ident, text in docs:
        row, want = rows[ident], quality_counts(text)
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert tuple(row)[1:7] == (*want, failed)
        assert row["kept"] == (not failed and row["rule"] is None)


def test_odd_rows(spark):
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        *(T.StructField(name, T.IntegerType()) for name in ("n_words", "row", "rule", "a.b", "my col"))])
    texts = [None, "", "a b", "x " * 1_000_000, "a b", "\n".join(f"word{i} other{i}" for i in range(60))]
    docs = spark.createDataFrame([(None, text, 1, 2, 3, 4, 5) for text in texts], schema)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    empty = rules.fit(docs, labels)
    assert empty == rules.DecisionList()
    rows = rules.judged(docs, empty).collect()
    assert sorted((row["n_words"], row["n_repeat_words"], row["base_failed"], row["kept"]) for row in rows) == [
        (0, 0, True, False), (0, 0, True, False), (2, 0, True, False), (2, 0, True, False),
        (120, 0, False, True), (1_000_000, 1_000_000, True, False)]
    assert rows[0]["row"].asDict().keys() == set(docs.columns)
    assert rules.judged(docs.limit(0), empty).count() == 0
    one = spark.createDataFrame([(1, 1, 0), (None, 0, 0)], labels.schema)
    assert rules.fit(docs, one) == rules.DecisionList()


def test_sample_is_bounded_whatever_shares_an_id(spark):
    docs = spark.range(3000).selectExpr("CAST(1 AS BIGINT) AS doc_id", "concat('t', id % 500) AS text")
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id bigint, quality int, toxic int")
    rows = rules.samples.distinct_sample(docs, labels, "quality", 4, 2, {0: 10, 1: 10}).collect()
    assert len(rows) == 10 and abs(sum(row["weight"] for row in rows) - 3000) < 1500
