from pyspark.sql import functions as F

from gleanstream.llm import url_filter

URLS = {
    None: ("", "", None), "": ("", "", None), "no scheme": ("", "", None), "//x.org/": ("", "", None),
    "http://Example.ORG/es/x": ("example.org", "/es/x", "example.org/es/"),
    "http://a.example.org/en/12?q": ("a.example.org", "/en/12", "example.org/en/1"),
    "http://example.org/en/2": ("example.org", "/en/2", "org/"),
    "http://badexample.org/es/": ("badexample.org", "/es/", "org/"),
    "x://org": ("org", "", None), "x://org/": ("org", "/", "org/"),
    "http://a.com/fr/#f": ("a.com", "/fr/", "com/fr/"), "http://a.com/de/": ("a.com", "/de/", "com/de/"),
    "http://a.com/fr?/fr/": ("a.com", "/fr", None), "http://com/de/1": ("com", "/de/1", "com/de/"),
    "http://İ.com?x": ("İ.com", "", None), "a\nb://c.net:80/d\ne?f": ("c.net:80", "/d\ne", None),
    "http://x.com#/de/": ("x.com", "", None), "p://q://r/s": ("q:", "//r/s", None),
}


def test_hosts_paths_and_rules(spark):
    rows = list(enumerate(URLS)) + [(None, "http://a.b/c")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    outcomes = spark.createDataFrame([], "page_id bigint, bad boolean")
    got = url_filter.judged(pages, outcomes).collect()
    assert len(got) == len(rows)
    for row in got:
        if row["page_id"] is not None:
            assert (row["host"], row["path"], row["rule"]) == list(URLS.values())[row["page_id"]]
        blocked = row["rule"] in {"example.org/es/", "example.org/en/1", "com/de/"}
        assert row["verdict"] == ("block" if blocked else "allow")


def test_domains(spark):
    names = {"a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "x.y.net": ("y.net", "net"),
             "net": ("net", "net"), "": ("", ""), "co.uk": ("co.uk", "uk")}
    frame = spark.createDataFrame([(name,) for name in names], "host string")
    domain, suffix = url_filter.registered_domain(F.col("host"))
    assert {row[0]: (row[1], row[2]) for row in frame.select("host", domain, suffix).collect()} == names


def test_reputation_shrinks(spark):
    """Few outcomes follow their domain, many speak for themselves."""
    hosts = [("good.net", 200, 2), ("bad.net", 200, 120), ("new.bad.net", 1, 1), ("one.good.net", 1, 1),
             ("fine.bad.net", 300, 0)]
    pages, outcomes = [], []
    for host, known, bad in hosts:
        for at in range(known):
            pages.append((len(pages), f"http://{host}/"))
            outcomes.append((len(pages) - 1, at < bad))
    pages.append((-1, "http://unseen.xyz/"))
    outcomes += outcomes[:3] + [(None, True), (5, None)]
    got = url_filter.judged(
        spark.createDataFrame(pages, "page_id bigint, url string"),
        spark.createDataFrame(outcomes, "page_id bigint, bad boolean")).select(
        "host", "verdict", "reputation").distinct().collect()
    verdicts = {row["host"]: row["verdict"] for row in got}
    assert verdicts["bad.net"] == "block" and verdicts["good.net"] == verdicts["fine.bad.net"] == "allow"
    assert verdicts["one.good.net"] == verdicts["unseen.xyz"] == "allow"
    shares = {row["host"]: row["reputation"] for row in got}
    assert shares["good.net"] < shares["one.good.net"] < shares["new.bad.net"] < 1


def test_hot_host_and_empty(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(
        F.lit("http://"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")),
        F.lit(".io/")).alias("url"))
    outcomes = spark.range(3000).select(F.col("id").alias("page_id"), (F.col("id") % 3 == 0).alias("bad"))
    got = url_filter.judged(pages, outcomes)
    assert got.filter("host = 'hot.io' AND verdict = 'block'").count() == 1000
    assert got.count() == 3000 and url_filter.judged(pages.limit(0), outcomes.limit(0)).count() == 0
