"""Hand-written listing pages, one per case."""

from collections.abc import Iterator

import pyarrow as pa
import pytest
from pyspark.errors import PythonException, SparkRuntimeException
from pyspark.sql import functions as F

from gleanstream.operators import extract
from gleanstream.operators.extract import LISTING_RULES, Rule
from gleanstream.schemas import EXTRACTED_FIELDS, LISTING

FIELDS = list(EXTRACTED_FIELDS)


def block(n, salary=True, location=True, extra_salary=False, details="<ul><li>first<li>second</ul>",
          title=True):
    snippet = f"<div data-testid='attribute_snippet_testid'>s{n}</div>" if salary else ""
    return (
        "<li class='card'>"
        "<div class='css-dekpa e37uo190 x'>"
        + (f"<h2><a><span>job {n}</span><span>more</span></a></h2>" if title else "<h2>none</h2>")
        + "</div><div class='company_location css-17fky0v e37uo190'><div>"
        f"<div><span>co {n}</span></div>" + (f"<div>loc {n}</div>" if location else "") + "</div></div>"
        "<div class='jobMetaDataGroup css-pj786l eu4oa1w0'>"
        f"<div>{snippet}</div>" + ("<div>x</div>" if extra_salary else "") + "</div>"
        f"<span data-testid='myJobsState'> <b>Posted</b> day {n}﻿ </span>"
        f"<div class='css-9446fg eu4oa1w0'>{details}</div></li>"
    )


def page(*blocks, next_link=True):
    link = "<a class=n data-testid='pagination-page-next' href='?2'>Next</a>" if next_link else ""
    return f"<html><body><ul class='css-zu9cdh eu4oa1w0'>{''.join(blocks)}</ul>{link}"


def captures(spark, *pages):
    return spark.createDataFrame(
        [(i, f"u{i}", html) for i, html in enumerate(pages)], "page_id bigint, url string, html string")


def lists(spark, html, rules=LISTING_RULES, **options):
    return extract.extract_lists(captures(spark, html), rules, **options).first().asDict()


def test_all_fields(spark):
    found = lists(spark, page(block(1), block(2)))
    assert found["Job"] == ["job 1", "job 2"]
    assert found["Company"] == ["co 1", "co 2"]
    assert found["Location"] == ["loc 1", "loc 2"]
    assert found["Deadline"] == ["day 1", "day 2"]
    assert found["JobDetails"] == ["first", "first"]


def test_every_inner_div_of_the_salary_group_counts(spark):
    """The snippet's own div is an entry too, so this list is longer than the titles."""
    found = lists(spark, page(block(1), block(2, salary=False), block(3, extra_salary=True)))
    assert found["Salary"] == [
        "s1", "Not disclosed", "Not disclosed", "s3", "Not disclosed", "Not disclosed"]


def test_details_fall_back_to_the_whole_block(spark):
    assert lists(spark, page(block(1, details="all <b>of</b> it")))["JobDetails"] == ["all of it"]


def test_details_are_found_outside_the_list(spark):
    html = page() + "<div class='css-9446fg eu4oa1w0'>aside</div>"
    assert lists(spark, html)["JobDetails"] == ["aside"]


def test_missing_location_is_null_or_an_error(spark):
    html = page(block(1), block(2, location=False))
    assert lists(spark, html)["Location"] == ["loc 1", None]
    with pytest.raises(PythonException, match="Location"):
        lists(spark, html, strict=True)


def test_page_without_list_or_without_text(spark):
    for html in ("<p>nothing", "", None):
        assert all(lists(spark, html)[name] == [] for name in FIELDS if name != "JobDetails")


def test_only_the_first_root_is_read(spark):
    assert lists(spark, page(block(1)) + page(block(2)))["Job"] == ["job 1"]


def test_rule_with_two_steps(spark):
    rule = Rule("x", "div", "body", (("p", 1), ("i", 0)), otherwise="none")
    html = "<body><div><p><i>a</i><p><i>b</i></div><div><p>c</div>"
    assert lists(spark, html, [rule])["x"] == ["b", "none"]


def rows_of(spark, html, **options):
    listings = extract.extract_listings(
        captures(spark, html), "kw", F.lit("2024-03-01 10:20:30").cast("timestamp_ntz"), **options)
    return [row.asDict() for row in listings.orderBy("page_id", "position").collect()]


def test_zip_pads_and_cuts(spark):
    html = page(block(1), block(2, salary=False), block(3)).replace("myJobsState", "other", 1)
    rows = rows_of(spark, html)
    assert [r["Job"] for r in rows] == ["job 1", "job 2", "job 3"]
    assert [r["Deadline"] for r in rows] == ["day 2", "day 3", None]
    assert [r["Salary"] for r in rows] == ["s1", "Not disclosed", "Not disclosed"]
    assert {r["Created"] for r in rows} == {"2024-03-01 10:20:30"}
    assert {r["SearchKeyWord"] for r in rows} == {"kw"}
    assert set(LISTING.names) <= set(rows[0])


def test_zip_strict_fails_on_a_short_list(spark):
    html = page(block(1), block(2)).replace("myJobsState", "other", 1)
    with pytest.raises(SparkRuntimeException, match="Deadline has fewer"):
        rows_of(spark, html, zip_mode="strict")
    assert len(rows_of(spark, page(block(1), block(2)), zip_mode="strict")) == 2
    with pytest.raises(ValueError):
        rows_of(spark, html, zip_mode="other")


def test_zip_by_block_keeps_fields_together(spark):
    html = page(block(1), block(2, salary=False, location=False), block(3))
    rows = rows_of(spark, html, zip_mode="block", block="li.card")
    assert [(r["Job"], r["Salary"], r["Location"]) for r in rows] == [
        ("job 1", "s1", "loc 1"), ("job 2", "Not disclosed", None), ("job 3", "s3", "loc 3")]
    with pytest.raises(ValueError):
        rows_of(spark, html, zip_mode="block")


@pytest.mark.parametrize("n, next_link, complete", [
    (15, True, True), (14, True, False), (14, False, True), (0, True, False), (16, True, True)])
def test_completeness(spark, n, next_link, complete):
    frame = captures(spark, page(*[block(i) for i in range(n)], next_link=next_link))
    frame = frame.withColumn("has_next", extract.has_next(F.col("html")))
    row = extract.page_completeness(extract.extract_lists(frame)).first()
    assert row["has_next"] is next_link
    assert row["complete"] is complete
    assert row["n_Job"] == n


def test_next_link_attribute_order(spark):
    for html, want in (
        ('<a data-testid="pagination-page-next">', True), ("<a x='y' data-testid='pagination-page-next'>", True),
        ("<a data-testid='pagination-page-prev'>", False), ("<b data-testid='pagination-page-next'>", False),
        ("<a>data-testid='pagination-page-next'", False),
    ):
        assert captures(spark, html).select(extract.has_next(F.col("html"))).first()[0] is want


def test_recaptures_keep_the_earliest(spark):
    rows = [("a", None, "2024-01-02 00:00:00"), ("a", None, "2024-01-01 00:00:00"),
            ("b", "x", "2024-01-03 00:00:00")]
    frame = spark.createDataFrame(rows, "Job string, Salary string, Created string")
    got = {tuple(r) for r in extract.drop_recaptures(frame).collect()}
    assert got == {("a", None, "2024-01-01 00:00:00"), ("b", "x", "2024-01-03 00:00:00")}


def test_recaptures_hash_and_odd_stamps(spark):
    rows = [("a", "soon"), ("a", "soon"), ("a", "2024-01-02 00:00:00"), ("a", "0001-01-01 00:00:00"), ("b", None)]
    frame = spark.createDataFrame(rows, "Job string, Created string")
    dropped = extract.drop_recaptures(frame)
    assert {tuple(r) for r in dropped.collect()} == {("a", "soon"), ("a", "0001-01-01 00:00:00"), ("b", None)}
    assert "SortAggregate" not in dropped._jdf.queryExecution().executedPlan().toString()


def test_completeness_of_an_empty_capture(spark):
    pages = spark.createDataFrame([(1, None), (2, "<p>")], "page_id int, html string").withColumn(
        "has_next", extract.has_next(F.col("html")))
    rows = extract.page_completeness(extract.extract_lists(pages)).collect()
    assert [(row["has_next"], row["complete"]) for row in rows] == [(False, False)] * 2


def test_page_budget_goes_by_ordinal(spark):
    frame = spark.createDataFrame([(3,), (0,), (2,), (1,)], "n int")
    assert sorted(r["n"] for r in extract.page_budget(frame, F.col("n"), 3).collect()) == [0, 1, 2]


def test_only_the_page_text_goes_to_python(spark):
    frame = extract.extract_listings(
        captures(spark, page(block(1))), "kw", F.lit("2024-03-01").cast("timestamp_ntz"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "read_pages(html#" in plan
    assert "Exchange" not in plan


def test_page_batches_end_by_their_bytes(spark):
    html = F.repeat(F.lit("<h1>x</h1>y"), 30_000)
    pages = spark.range(0, 40, numPartitions=1).select(F.col("id").alias("page_id"), html.alias("html"))
    found = extract.extract_lists(pages, [Rule("title", "h1")])
    assert [len(row["title"]) for row in found.collect()] == [30_000] * 40

    @F.arrow_udf("int")
    def together(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([len(batch)] * len(batch), pa.int32())

    assert max(row[0] for row in pages.select(together("html")).collect()) <= 15  # 4 MB of 13


def test_texts_of_pages_come_back_in_parts():
    pages = pa.array(["<h1>a</h1>", None, "<h1>b</h1>" + "x" * extract.PART_CHARS, "<h1>c</h1>"])
    made = pa.struct([("title", pa.list_(pa.string()))])
    parts = list(extract._in_parts(iter([pages, pages[:0]]), [Rule("title", "h1")], None, False, made))
    assert [len(part) for part in parts] == [3, 1]
    assert pa.concat_arrays(parts).to_pylist() == [{"title": one} for one in (["a"], [], ["b"], ["c"])]
