import numpy as np
import pytest

from gleanstream.llm import toxicity
from gleanstream.llm.toxicity import Model, folded, matched


@pytest.mark.parametrize("text", [
    "You idiot", "IDIOT!!", "an 1d10t here", "ïdiot", "іdіоt", "ｉｄｉｏｔ", "id\u00adiot", "idiot$$$",
    "what (idiots) are", "no-idiot", "an id!ot",
])
def test_folding_undoes_disguises(text):
    assert matched(folded(text), Model().automaton())[1] == 1


@pytest.mark.parametrize("text", [
    None, "", "1 2 3", "the trash can is full", "Trash-bin day", "a class clown", "bigidiot",
    "$$$ %%% !!!", "x" * 200_000, "a1" * 50_000,
])
def test_harmless(text):
    assert matched(folded(text), Model().automaton())[1] == 0


def test_exceptions_cover_only_themselves():
    assert matched(folded("trash can, idiot. trash talk"), Model().automaton())[1] == 2


def test_longest_entry_counts():
    model = Model({" ab": 1.0, " abc": 2.0, " abc ": 5.0}, ())
    assert matched(folded("abc abcd abx"), model.automaton()) == (8.0, 3)


def test_length_is_normalised():
    scores = Model().score(np.array([4.0, 4.0, 0.0, 0.0]), np.array([10, 10_000, 0, 10_000]))
    assert scores[0] > 0.7 > scores[1] > scores[2] == scores[3]


def test_held_out_accuracy(spark):
    """Whole small table; most of what is missed there is mislabelled or in rare languages."""
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{name}.parquet") for name in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    called, toxic = rows["predicted"] == 1, rows["toxic"] == 1
    assert (called & toxic).sum() >= 0.95 * called.sum()
    assert (called & toxic).sum() >= 0.8 * toxic.sum()


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 0.5, 1), (2, "", 0.5, 1), (2, "", 0.5, 1), (None, "moron idiot scum", None, None)],
        "doc_id bigint, text string, score double, label int")
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = toxicity.toxicity(docs, empty).collect()
    assert len(rows) == 4 and not any(row["held_out"] for row in rows if row["doc_id"] is None)
    assert [row["predicted"] for row in sorted(rows, key=lambda row: row["score"])] == [0, 0, 0, 1]
    some = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 1), (2, 0, None), (None, 1, 1), (7, 1, 1)], empty.schema)
    kept = toxicity.drop_toxic(docs, some)
    assert kept.columns == docs.columns and kept.filter("doc_id IS NOT NULL").count() == 3
    assert toxicity.drop_toxic(docs.limit(0), empty).count() == 0


def test_sample_keeps_texts_that_open_alike(spark):
    """Only whole folded texts are copies; the smallest id stays, with the weight of all."""
    header = "the same banner on every page of this site, longer than sixty-four characters: "
    rows = [(3, 1, 2.0, header + "One"), (2, 1, 3.0, header + "one!"), (4, 1, 2.0, header + "two"),
            (5, 0, 1.5, header + "one"), (6, 0, 1.0, None), (7, 0, 1.0, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, label int, weight double, text string")
    got = {tuple(row) for row in toxicity._distinct_texts(frame.repartition(3)).collect()}
    assert got == {(1, 5.0, header + "one!"), (1, 2.0, header + "two"), (0, 1.5, header + "one"),
                   (0, 2.0, None)}


def test_learns_from_a_site_whose_pages_open_alike(spark):
    header = "welcome to the daily board of our little town, read by all who live here. "
    rows = [(n, header + f"page {n} " + ("zorgle" if n % 2 else "flower")) for n in range(1, 121)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, 1, n % 2) for n, _ in rows],
                                   "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert any(pattern.startswith(" zorg") for pattern in model.weights)
    assert toxicity.fit(docs.repartition(5), labels) == model
