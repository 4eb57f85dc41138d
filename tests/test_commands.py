"""The whole way from pages to the snapshot, by the command line."""

import pytest
from pyspark.sql import functions as F

from gleanstream.__main__ import main
from gleanstream.plans import inputs
from gleanstream.plans.acquire import acquire
from gleanstream.schemas import POSTING_FIELDS
from gleanstream.sinks.snapshot import read_published, read_published_grid
from gleanstream.sources.captures import url_page_number
from gleanstream.sources.log import read_log


@pytest.fixture(scope="module")
def captures_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("captures") / "pages")
    pages = inputs.listing_pages(spark, "/root/testdata/sf0.001")
    pages.select(
        "page_id", F.concat(F.lit("http://x.example/?q=a&page="), "page_id").alias("url"), "html",
    ).write.parquet(path)
    return path


@pytest.mark.parametrize("kind", ["incremental", "full", "grid"])
def test_pages_to_snapshot(spark, captures_dir, tmp_path, capsys, kind):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    main(["acquire", "--captures", captures_dir, "--log", log, "--keyword", "Data Science",
          "--pages", "3", "--captured-at", "2024-01-01 00:00:00"])
    assert "|jobs-data|ok    |45      |NULL |" in capsys.readouterr().out
    main(["consume", "--log", log, "--store", store, "--until-drained", "--trace", "--snapshot", kind])
    if kind == "grid":
        rows = read_published_grid(spark, f"{store}/published", f"{store}/refreshes")
    else:
        rows = read_published(spark, f"{store}/published", f"{store}/refreshes")
    found = rows.collect()
    assert len(found) == 45
    assert {r["SearchWord"] for r in found} == {"Data Science"}
    assert {r["Created"] for r in found} == {"2024-01-01 00:00:00"}
    assert sorted(int(r["Job"].split()[1]) for r in found) == list(range(45))
    assert spark.read.parquet(f"{store}/trace").count() == 45
    main(["show", "--store", store] + (["--grid"] if kind == "grid" else []))
    main(["report", "--log", log])
    assert "Data Science" in capsys.readouterr().out


def test_documents_to_snapshot(spark, sf, tmp_path):
    from gleanstream.operators import clean

    store, source = str(tmp_path / "store"), str(tmp_path / "documents")
    documents = inputs.stored_documents(spark, sf)
    documents.select("document").write.text(source)
    want = clean.with_search_word(clean.guard_missing(clean.only_objects(documents)))
    for _ in range(2):
        main(["snapshot", "--documents", source, "--store", store])
        rows = read_published(spark, f"{store}/published", f"{store}/refreshes")
        assert rows.count() == want.count() > 0
        assert rows.drop("QueryAt").exceptAll(want).isEmpty()
    rejects = spark.read.parquet(f"{store}/rejects-documents")
    assert rejects.count() == 2 * clean.missing_field_rejects(clean.only_objects(documents)).count() > 0


def test_all_pages_unless_asked(spark, captures_dir, tmp_path):
    pages = spark.read.parquet(captures_dir)
    for name, budget, n in (("all", {}, 200), ("some", {"page_no": url_page_number(F.col("url")), "pages": 5}, 75)):
        acquire(pages, str(tmp_path / name), "k", F.lit("2024-01-01").cast("timestamp_ntz"), **budget)
        rows = read_log(spark, str(tmp_path / name)).select(F.get_json_object("value", "$.Job")).collect()
        assert sorted(int(r[0].split()[1]) for r in rows) == list(range(n))


def test_page_number(spark):
    urls = ["http://a/?page=12&x", "http://a/?q=1&page=3", "http://a/page=3", "http://a/?mypage=3",
            "http://a/?page=99999999999", "http://a/?page=" + "9" * 40, None]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in frame.select(url_page_number(F.col("url"))).collect()] == [12, 3, 0, 0, 99999999999, 2**63 - 1, 0]


def test_a_place_for_the_log_is_required(capsys):
    with pytest.raises(SystemExit):
        main(["consume", "--store", "x"])


def test_compact(spark, tmp_path, capsys):
    from gleanstream.sinks.collection import append_batch
    from gleanstream.sources.collection import read_collection

    store = str(tmp_path)
    rows = spark.createDataFrame([("a",)], "word string").select(*[F.col("word").alias(n) for n in POSTING_FIELDS])
    for number in range(3):
        append_batch(rows, f"{store}/postings", "s", number)
    main(["compact", "--store", store, "--keep", "0"])
    assert "'postings': 2" in capsys.readouterr().out
    assert read_collection(spark, f"{store}/postings").count() == 3


def test_pages_by_links(spark, tmp_path):
    source, log = str(tmp_path / "captures"), str(tmp_path / "log")
    pages = inputs.listing_pages(spark, "/root/testdata/sf0.001").where("page_id < 4").withColumn(
        "url", F.concat(F.lit("http://x.example/s"), "page_id")).withColumn(
        "html", F.replace("html", F.lit("?p"), F.concat(F.lit("/s"), F.col("page_id") + 1)))
    pages.select("page_id", "url", "html").write.parquet(source)
    main(["acquire", "--captures", source, "--log", log, "--keyword", "k", "--pages", "2", "--pages-by", "links"])
    rows = read_log(spark, log).select(F.get_json_object("value", "$.Job")).collect()
    assert sorted(int(r[0].split()[1]) for r in rows) == list(range(30))
