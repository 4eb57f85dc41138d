"""Order of pages by their links, against a walk in plain Python."""

import random

from pyspark.sql import functions as F

from gleanstream.operators.extract import page_budget
from gleanstream.operators.page_order import linked_captures, next_url, page_order


def places(spark, links):
    frame = spark.createDataFrame(links, "url string, next_url string")
    return {r["url"]: (r["head"], r["ordinal"], r["linked_by"], r["in_cycle"])
            for r in page_order(frame).collect()}


def walked(links):
    nexts = {}
    for url, after in links:
        if url is not None:
            nexts[url] = min([one for one in (nexts.get(url), after) if one is not None], default=None)
    before = {}
    for url, after in nexts.items():
        if after in nexts and after != url:
            before.setdefault(after, []).append(url)
    found = {url: (None, None, len(before.get(url, ())), True) for url in nexts}
    for head in nexts:
        if head not in before:
            url, ordinal = head, 0
            while True:
                found[url] = (head, ordinal, len(before.get(url, ())), False)
                after = nexts[url]
                if after not in nexts or after == url or min(before[after]) != url:
                    break
                url, ordinal = after, ordinal + 1
    return found


def test_chains_forks_cycles(spark):
    links = [
        ("a", "b"), ("b", "c"), ("c", None), ("c", None),  # a chain, one page seen twice
        ("p", "r"), ("q", "r"), ("r", "s"), ("s", "p"),  # a fork on r, and a link back
        ("x", "y"), ("y", "x"),  # a cycle
        ("self", "self"), ("away", "nowhere"), (None, "a"), ("", "a")]
    got = places(spark, links)
    assert got == walked(links)
    assert got["x"] == (None, None, 1, True) and got["self"] == ("self", 0, 0, False)
    assert got["c"] == ("", 3, 1, False)


def test_random_links(spark):
    dice = random.Random(5)
    names = [f"u{n}" for n in range(300)]
    links = [(name, dice.choice([None, *dice.choices(names, k=6)])) for name in names]
    links += [(f"v{n}", f"v{(n + 1) % 40}") for n in range(40)]
    assert places(spark, links) == walked(links)


def test_a_long_chain_takes_few_joins(spark, monkeypatch, tmp_path):
    from gleanstream.operators import page_order as module

    monkeypatch.setattr(module, "run_dir", lambda *_: str(tmp_path / "run"))
    links = spark.range(10_000).select(
        F.concat(F.lit("u"), "id").alias("url"), F.concat(F.lit("u"), F.col("id") + 1).alias("next_url"))
    order = page_order(links)
    assert order.where(F.col("ordinal") == F.substr("url", F.lit(2)).cast("bigint")).count() == 10_000
    assert len(list((tmp_path / "run").glob("round=*"))) <= 16


def test_empty(spark):
    assert places(spark, []) == {}


def test_budget_by_links(spark):
    link = "<p><a class='n' data-testid=\"pagination-page-next\" href='{}'>Next</a>"
    pages = [
        (1, "http://h/jobs/one?x=1", link.format("/jobs/two?a=1&amp;b=2")), (2, "http://h/jobs/two?a=1&b=2", link.format("?three")),
        (3, "http://h/jobs/two?three", link.format("four")), (4, "http://h/jobs/four", link.format("http://h/5")),
        (5, "http://h/5", None), (6, None, link.format("x")), (7, "http://h/loop", link.format("loop2")),
        (8, "http://h/loop2", link.format("//h/loop"))]
    captures = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    ordered = linked_captures(captures)
    assert {r["page_id"]: r["ordinal"] for r in ordered.collect()} == {
        1: 0, 2: 1, 3: 2, 4: 3, 5: 4, 6: None, 7: None, 8: None}
    kept = page_budget(ordered, F.col("ordinal"), 3)
    assert sorted(r["page_id"] for r in kept.collect()) == [1, 2, 3]
    got = captures.where("page_id = 5").select(next_url(F.col("html"), F.col("url")).alias("n")).first()["n"]
    assert got is None
