"""Inputs of the registered queries, derived by Spark from the given tables.

The tables hold no job listings, so these jobs shape their rows into what the
operators take: log messages with the faults a decoder must survive, stored
documents, and result pages in the listing site's markup. Every row of a table
takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanstream.schemas import LISTINGS_PER_PAGE

# Pieces of SQL that the engines spell differently.
SPARK_WORDS = {
    "events": "{events}",
    "date": "date_format(ts, 'yyyy-MM-dd')",
    "stamp": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "k": "get_json_object(props, '$.k')",
}
DUCKDB_WORDS = {
    "events": "events",
    "date": "strftime(ts, '%Y-%m-%d')",
    "stamp": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "k": "json_extract_string(props, '$.k')",
}


def messages_sql(words: dict[str, str]) -> str:
    """Log messages from ``events``; one in eight or so is odd in some way."""
    return f"""
SELECT event_id, 'name' AS key,
  CASE event_id % 100
    WHEN 0 THEN 'Not found' WHEN 9 THEN '' WHEN 10 THEN NULL
    WHEN 5 THEN concat('{{', head, salary, tail)
    WHEN 6 THEN concat('[{{', head, salary, tail, '}}]')
    ELSE concat('{{', head, salary, tail, '}}') END AS value
FROM (SELECT event_id,
  concat('"SearchKeyWord":"', event_type, '","Job":"job-', CAST(user_id AS VARCHAR(20)),
    '","Company":"co-', CAST(user_id % 17 AS VARCHAR(20)), '"') AS head,
  CASE event_id % 100
    WHEN 1 THEN '' WHEN 2 THEN ',"Salary":null' WHEN 3 THEN ',"Salary":{{"x":1}}'
    WHEN 4 THEN ',"Salary":[1]' WHEN 7 THEN ',"Salary":1.5' WHEN 8 THEN ',"Salary":true'
    WHEN 11 THEN ',"Salary":"{{x"'
    ELSE concat(',"Salary":"s-', CAST(user_id AS VARCHAR(20)), '"') END AS salary,
  concat(',"Location":"loc-', CAST(event_id % 23 AS VARCHAR(20)), '","Deadline":"', {words["date"]},
    '","JobDetails":"k-', {words["k"]}, '","Created":"', {words["stamp"]}, '"') AS tail
  FROM {words["events"]}) AS pieces"""


def documents_sql(words: dict[str, str]) -> str:
    """Stored documents from ``events``: whole, partial, without a search word, or no object."""
    return f"""
SELECT event_id, CASE event_id % 50
    WHEN 0 THEN concat('[', body, ']') WHEN 1 THEN '"text"' WHEN 2 THEN concat('{{', body)
    ELSE body END AS document
FROM (SELECT event_id, concat('{{"_id":"', CAST(event_id AS VARCHAR(20)), '"',
  CASE WHEN event_id % 50 = 3 THEN '' ELSE concat(',"SearchWord":"', event_type, '"') END,
  CASE WHEN event_id % 50 IN (4, 6) THEN '' ELSE concat(',"Job":"job-', CAST(user_id AS VARCHAR(20)), '"') END,
  ',"Company":"co-', CAST(user_id % 17 AS VARCHAR(20)),
  CASE WHEN event_id % 50 = 5 THEN '","Salary":null' ELSE '","Salary":"s"' END,
  ',"Location":"loc-', CAST(event_id % 23 AS VARCHAR(20)), '","Deadline":"', {words["date"]},
  CASE WHEN event_id % 50 = 6 THEN '' ELSE concat('","JobsDetails":"k-', {words["k"]}) END,
  '","Created":"', {words["stamp"]}, '"}}') AS body
  FROM {words["events"]}) AS bodies"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _from_events(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    source = table(spark, sf_dir, "events")
    # braces that belong to the text are doubled for the parameter syntax
    text = sql.replace("{", "{{").replace("}", "}}").replace("{{events}}", "{events}")
    return spark.sql(text, events=source)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, messages_sql(SPARK_WORDS))


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, documents_sql(SPARK_WORDS))


# Listing rows whose free text is a whole conversation turn or document.
TURN_LISTINGS_SQL = """
SELECT conv_id, turn, role AS SearchKeyWord, concat('turn-', CAST(turn AS VARCHAR(20))) AS Job,
  concat('conv-', CAST(conv_id AS VARCHAR(20))) AS Company,
  CASE WHEN turn % 3 = 0 THEN NULL ELSE concat('s-', CAST(turn AS VARCHAR(20))) END AS Salary,
  CAST(NULL AS VARCHAR(20)) AS Location, '2024-01-31' AS Deadline, text AS JobDetails,
  '2024-01-01 00:00:00' AS Created
FROM {source}"""

DOCUMENT_POSTINGS_SQL = """
SELECT lang AS SearchWord, source AS Job, 'co' AS Company,
  CASE WHEN doc_id % 4 = 0 THEN '=1+2' ELSE 's' END AS Salary,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'loc' END AS Location,
  CASE WHEN doc_id % 4 = 0 THEN 'soon' ELSE '2024-02-01' END AS Deadline, text AS JobsDetails,
  concat('2024-01-01 00:00:', CASE WHEN doc_id % 60 < 10 THEN '0' ELSE '' END,
    CAST(doc_id % 60 AS VARCHAR(20))) AS Created
FROM {source}"""


# Every document is a page that links to the next id; some link to none, back, past one, or in a circle.
PAGE_LINKS_SQL = """
SELECT concat('u', CAST(doc_id AS VARCHAR(20))) AS url,
  CASE WHEN doc_id % 97 = 0 OR doc_id % 101 = 2 THEN NULL ELSE concat('u', CAST(
    CASE WHEN doc_id % 101 = 4 OR doc_id % 53 = 7 THEN doc_id - 1 WHEN doc_id % 31 = 5 THEN doc_id + 2
    ELSE doc_id + 1 END AS VARCHAR(20))) END AS next_url
FROM {source}"""


# Salaries and deadlines in the shapes that people type.
CELLS_SQL = """
SELECT doc_id, CASE doc_id % 12
    WHEN 0 THEN concat('$', n, '.50') WHEN 1 THEN concat(n, '%') WHEN 2 THEN concat('(', n, ')')
    WHEN 3 THEN concat('1,', right(concat('000', n), 3)) WHEN 4 THEN 'TRUE' WHEN 5 THEN concat(chr(39), n)
    WHEN 6 THEN '' WHEN 7 THEN NULL WHEN 8 THEN concat(n, ',5') WHEN 9 THEN concat(' -', n, 'e1 ')
    WHEN 10 THEN concat('=', n) ELSE concat(n, ' a year') END AS salary,
  CASE doc_id % 6
    WHEN 0 THEN concat('2024-02-', d) WHEN 1 THEN concat('2/', d, '/2024') WHEN 2 THEN concat('2024/2/', d)
    WHEN 3 THEN concat('2024-1-', d, ' 8:0', CAST(doc_id % 10 AS VARCHAR(20))) WHEN 4 THEN concat('soon ', d)
    ELSE concat('2024-12-', d, ' 23:59:5', CAST(doc_id % 10 AS VARCHAR(20))) END AS deadline
FROM (SELECT doc_id, CAST(n_chars AS VARCHAR(20)) AS n, CAST(1 + doc_id % 31 AS VARCHAR(20)) AS d
  FROM {source}) AS pieces"""


def typed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CELLS_SQL, source=table(spark, sf_dir, "documents"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PAGE_LINKS_SQL, source=table(spark, sf_dir, "documents"))


def turn_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TURN_LISTINGS_SQL, source=table(spark, sf_dir, "conversations"))


def document_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DOCUMENT_POSTINGS_SQL, source=table(spark, sf_dir, "documents"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages in the listing site's markup, fifteen documents to a page.

    Every third listing has its text in a list item, every fourth no salary;
    three of four pages have a next link.
    """
    def escaped(text):
        for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(plain), F.lit(entity))
        return text

    doc = F.col("doc_id")
    number = doc.cast("string")
    block = F.concat(
        F.lit('<li><div class="css-dekpa e37uo190"><h2 class="t"><a href="/v?id='), number,
        F.lit('"><span>Title '), number, F.lit("</span></a></h2></div>"),
        F.lit('<div class="company_location css-17fky0v e37uo190"><div><div><span>'),
        escaped(F.col("source")), F.lit("</span></div><div>"), escaped(F.col("lang")),
        F.lit("</div></div></div>"),
        F.lit('<div class="jobMetaDataGroup css-pj786l eu4oa1w0"><div>'),
        F.when(doc % 4 != 0, F.concat(
            F.lit('<div data-testid="attribute_snippet_testid">'), F.col("n_chars").cast("string"),
            F.lit(" a year</div>"))).otherwise(F.lit("&nbsp;")),
        F.lit('</div></div><div class="css-9446fg eu4oa1w0">'),
        F.when(doc % 3 == 0, F.concat(
            F.lit("<ul><li>"), escaped(F.col("text")), F.lit("<li>other</ul>")))
        .otherwise(F.concat(escaped(F.col("text")), F.lit("<p>end<br>"))),
        F.lit('</div><span data-testid="'),
        F.when(doc % 2 == 0, F.lit("myJobsState")).otherwise(F.lit("myJobsStateDate")),
        F.lit('"> <b>Posted</b> '), number, F.lit(" days ago\n</span>"),
    )
    return (
        table(spark, sf_dir, "documents")
        .select(F.expr(f"doc_id div {LISTINGS_PER_PAGE}").alias("page_id"), "doc_id", block.alias("block"))
        .groupBy("page_id")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "block"))).alias("blocks"))
        .select("page_id", F.concat(
            F.lit('<!DOCTYPE html><html><body><ul class="css-zu9cdh eu4oa1w0">'),
            F.array_join(F.col("blocks.block"), ""), F.lit("</ul>"),
            F.when(F.col("page_id") % 4 != 3,
                   F.lit('<a data-testid="pagination-page-next" href="?p">Next</a>'))
            .otherwise(F.lit("")),
            F.lit("</body>"),
        ).alias("html"))
    )

