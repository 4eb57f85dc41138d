import itertools

import numpy as np

from gleanstream.llm import quality


def test_pairs_in_linear_time():
    rng = np.random.default_rng(1)
    machine = quality.Machine(0.3, rng.normal(size=quality.SIZE), rng.normal(size=(quality.SIZE, 8)))
    indices, values = rng.choice(quality.SIZE, 12, replace=False), rng.normal(size=12)
    plain = 0.3 + machine.weights[indices] @ values + sum(
        machine.factors[a] @ machine.factors[b] * x * y
        for (a, x), (b, y) in itertools.combinations(zip(indices, values), 2))
    assert abs(machine.margin(indices, values) - plain) < 1e-9


def test_features_of_odd_texts():
    rows = quality.features([None, "", "x" * 3_000_000, "a a a\n\nb"], [None, 0, -5, 3])
    assert len(rows) == 4
    for indices, values in rows:
        assert len(set(indices.tolist())) == len(indices) == len(values)
        assert indices.min() >= 0 and indices.max() < quality.SIZE and np.isfinite(values).all()
    assert (rows[0][0] != rows[1][0]).sum() == 1  # only the missing n_chars differs


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{name}.parquet") for name in ("documents", "labels"))
    rows = quality.quality(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (rows["predicted"] == rows["quality"]).mean() > 0.98


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None), (None, "b c", 3), (None, "b c", 3)], "doc_id bigint, text string, row int")
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = quality.quality(docs, empty).collect()
    assert len(rows) == 3 and all(0.4 < row["score"] < 0.6 for row in rows)
    one = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 0, 0)], empty.schema)
    assert quality.quality(docs, one).count() == 3
    assert quality.quality(docs.limit(0), one).count() == 0
