from collections import defaultdict

from pyspark.sql import functions as F

from gleanstream.llm import line_dedup


def plain(rows, min_sites, min_chars):
    sites = defaultdict(set)
    for _, site, text in rows:
        for line in (text or "").split("\n"):
            if len(line.strip(line_dedup.TRIMMED)) >= min_chars:
                sites[line.strip(line_dedup.TRIMMED)].add(site)
    gone = {line for line, own in sites.items() if len(own) >= min_sites}
    return sorted(((ident, None if text is None else "\n".join(
        line for line in text.split("\n") if line.strip(line_dedup.TRIMMED) not in gone))
        for ident, _, text in rows), key=str)


def rows():
    shared = "All rights reserved by all."
    out = [(i, f"s{i % 7}", f"own line number {i}\n  {shared}\t\n\nend {i}") for i in range(20)]
    out += [(100 + i, f"s{i}", "Seen on two sites only, twice") for i in range(2)] * 2
    out += [(200, None, "Null counts as a site"), (201, "a", "Null counts as a site"),
            (202, "", "Null counts as a site"), (300, "s1", None), (301, "s1", ""), (None, "s2", shared),
            (None, None, "x\n" + shared), (302, "s9", "w" * 200_000 + "\n" + shared)]
    return out


def result(df):
    return sorted(((row["row"]["doc_id"], row["clean"]) for row in df.collect()), key=str)


def test_against_plain(spark):
    docs = spark.createDataFrame(rows(), "doc_id bigint, source string, text string")
    for band in (0.0, 0.1, 0.9):  # by estimates alone, and by exact counts
        got = line_dedup.without_boilerplate(docs, min_sites=3, min_chars=16, band=band)
        assert result(got) == plain(rows(), 3, 16)
        assert got.agg(F.sum("n_removed")).first()[0] == sum(
            "All rights" in (text or "") for _, _, text in rows()) + 3


def test_near_lines_are_counted_exactly(spark):
    docs = spark.createDataFrame(rows(), "doc_id bigint, source string, text string")
    found = line_dedup.boilerplate(docs, min_sites=3, min_chars=16)
    assert sorted(row["exact"] for row in found.collect()) == [False, True]


def test_hot_line(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 500).alias("source"),
        F.concat(F.lit("the line that all have\nown text of this one "), F.col("id")).alias("text"))
    got = line_dedup.without_boilerplate(docs)
    assert got.filter("n_removed = 1 AND n_lines = 2").count() == 3000


def test_native_and_empty(spark):
    docs = spark.createDataFrame(rows(), "doc_id bigint, source string, text string")
    plan = line_dedup.without_boilerplate(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert line_dedup.without_boilerplate(docs.limit(0)).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a", "b" * 20, "x", 1)], "doc_id bigint, source string, text string, line string, ident int")
    row = line_dedup.without_boilerplate(docs).first()
    assert row["row"]["line"] == "x" and row["row"]["ident"] == 1 and row["clean"] == "b" * 20
