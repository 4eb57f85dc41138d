"""One query per operator over the given tables, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanstream.functions import cells
from gleanstream.functions import text as tx
from gleanstream.functions.json_text import encode_object
from gleanstream.operators import clean, decode, encode, extract
from gleanstream.operators.extract import Rule
from gleanstream.operators.page_order import page_order
from gleanstream.plans import inputs
from gleanstream.plans.documents import documents_snapshot
from gleanstream.plans.inputs import DUCKDB_WORDS, documents_sql, messages_sql, table
from gleanstream.schemas import (
    MESSAGE_FIELDS, MESSAGE_TO_POSTING, NOT_ENCODABLE, POSTING_FIELDS,
)
from gleanstream.session import run_dir, ship_code
from gleanstream.sinks import collection as store
from gleanstream.sinks import compaction
from gleanstream.sinks import log as log_sink
from gleanstream.sinks import snapshot as snap
from gleanstream.sources.captures import url_page_number
from gleanstream.sources.collection import read_collection
from gleanstream.sources.log import read_log, stream_log
from gleanstream.streaming.consumer import ListingConsumer
from gleanstream.streaming.recaptures import drop_recaptures_in_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

QUERY_AT = "2024-02-01 12:00:00"
KEYWORD = "Data Science"


def registered(sql: str):
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLE[function.__name__] = sql.strip()
        return function
    return add


# ---------------------------------------------------------------- SQL counterparts

MESSAGES = f"messages AS ({messages_sql(DUCKDB_WORDS)})"


def _decoded_columns(names: dict[str, str], guard: str) -> str:
    return ",\n".join(
        f"""CASE WHEN {guard} THEN CASE json_type(j, '$.{old}') WHEN 'NULL' THEN 'null'
 WHEN 'OBJECT' THEN '' WHEN 'ARRAY' THEN '' ELSE json_extract_string(j, '$.{old}') END END AS "{new}" """
        for old, new in names.items())


def _keys(names, lacking: str = "AND") -> str:
    return f" {lacking} ".join(f"json_exists(j, '$.{name}')" for name in names)


DECODED = f"""{MESSAGES}, decoded AS (SELECT event_id, {_decoded_columns(MESSAGE_TO_POSTING, "ok")}
FROM (SELECT event_id, j, coalesce(json_type(j) = 'OBJECT' AND {_keys(MESSAGE_FIELDS)}, false) AS ok
 FROM (SELECT event_id, try_cast(value AS JSON) AS j FROM messages) AS parsed) AS checked)"""
POSTING_LIST = ", ".join(f'"{name}"' for name in POSTING_FIELDS)
TURNS = f"turns AS ({inputs.TURN_LISTINGS_SQL.format(source='conversations')})"
DOCS = f"docs AS ({inputs.DOCUMENT_POSTINGS_SQL.format(source='documents')})"
JSON_PAIRS = ", ".join(f"""'{name}', "{name}" """ for name in MESSAGE_FIELDS)
PUBLISHED_SQL = (
    f"WITH {DECODED} SELECT {POSTING_LIST}, '{QUERY_AT}' AS \"QueryAt\" "
    'FROM decoded WHERE "SearchWord" IS NOT NULL'
)


def _entities(text: str) -> str:
    """Character references that occur in ``pages``; the ampersand's comes last.

    These few are references by the HTML standard also where the semicolon is missing.
    """
    for entity, plain in (
        ("&copy", "©"), ("&middot", "·"), ("&quot", '"'), ("&lt", "<"), ("&gt", ">"),
        ("&amp", "&"),
    ):
        text = f"regexp_replace({text}, '{entity};?', '{plain}', 'g')"
    return text


def _first(tag: str) -> str:
    return f"regexp_extract(html, '<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>', 1, 's')"


def _all(tag: str) -> str:
    return f"regexp_extract_all(html, '<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>', 1, 's')"


# What listing_pages() put on its pages, read from the rows instead of the markup.
LISTED = """listed AS (
SELECT doc_id // 15 AS page_id,
  CAST(row_number() OVER (PARTITION BY doc_id // 15 ORDER BY doc_id) - 1 AS INTEGER) AS position,
  concat('Title ', doc_id) AS "Job", source AS "Company", lang AS "Location",
  concat(doc_id, ' days ago') AS "Deadline",
  CASE WHEN doc_id % 3 = 0 THEN text ELSE concat(text, 'end') END AS "JobDetails",
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes((doc_id // 15)::INTEGER),
    '%Y-%m-%d %H:%M:%S') AS "Created"
FROM documents),
salaries AS (
SELECT doc_id // 15 AS page_id, flatten(list(CASE WHEN doc_id % 4 <> 0
    THEN [concat(n_chars, ' a year'), 'Not disclosed'] ELSE ['Not disclosed'] END
  ORDER BY doc_id)) AS salary
FROM documents GROUP BY 1)"""


# ---------------------------------------------------------------- shared Spark inputs

def _captured_at():
    return F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(page_id))")


def _log(spark: SparkSession, sf_dir: str) -> str:
    """A log with one message per event."""
    path = run_dir(spark, "log")
    rows = inputs.messages(spark, sf_dir).withColumn("topic", F.lit("jobs-data"))
    log_sink.publish_to_log(rows, path)
    return path


def _publish_turns(spark: SparkSession, sf_dir: str, path: str) -> str:
    rows = encode.encode_messages(inputs.turn_listings(spark, sf_dir), keep=("conv_id", "turn"))
    return log_sink.publish_to_log(rows, path)


def _stream(spark: SparkSession, log: str) -> DataFrame:
    return stream_log(spark, log)


def _drain_to_table(source: DataFrame, path: str) -> None:
    query = source.writeStream.format("parquet").option(
        "checkpointLocation", f"{path}/checkpoint").option(
        "path", f"{path}/rows").trigger(availableNow=True).start()
    query.awaitTermination()


def _consumer(root: str, publisher=None) -> ListingConsumer:
    return ListingConsumer(
        postings_dir=f"{root}/postings", log_dir=f"{root}/refreshes",
        publisher=publisher or snap.IncrementalSnapshot(f"{root}/published"),
        checkpoint_dir=f"{root}/checkpoint", query_at=lambda: QUERY_AT,
    )


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_postings(inputs.messages(spark, sf_dir))


def _listing_lists(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    ship_code(spark)
    rules = [rule for rule in extract.LISTING_RULES if not fields or rule.field in fields]
    return extract.extract_lists(inputs.listing_pages(spark, sf_dir), rules)


# ---------------------------------------------------------------- sources

@registered(f"WITH {MESSAGES} SELECT key, value, 'jobs-data' AS topic FROM messages")
def stream_read(spark, sf_dir):
    path = run_dir(spark, "stream-read")
    _drain_to_table(_stream(spark, _log(spark, sf_dir)), path)
    return spark.read.parquet(f"{path}/rows").select("key", "value", "topic")


@registered("""SELECT (SELECT count(*) FROM events) + (SELECT count(*) FROM conversations) AS records,
CAST(2 AS BIGINT) AS publishes, (SELECT count(*) FROM events) + (SELECT count(*) FROM conversations) AS places""")
def stream_earliest(spark, sf_dir):
    """A stream that starts after two publishes still begins at the first record."""
    log, path = _log(spark, sf_dir), run_dir(spark, "stream-earliest")
    _publish_turns(spark, sf_dir, log)
    _drain_to_table(_stream(spark, log), path)
    return spark.read.parquet(f"{path}/rows").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("publish_id").alias("publishes"),
        F.count_distinct("place", "row").alias("places"))


@registered(f"""WITH {DECODED}, {TURNS} SELECT {POSTING_LIST} FROM decoded UNION ALL
SELECT "SearchKeyWord", "Job", "Company", coalesce("Salary", 'null'), coalesce("Location", 'null'),
"Deadline", "JobDetails", "Created" FROM turns""")
def stream_restart(spark, sf_dir):
    """Drain, publish more, restart on the same checkpoint: every record once."""
    log, root = _log(spark, sf_dir), run_dir(spark, "stream-restart")
    _consumer(root).start(_stream(spark, log), until_drained=True).awaitTermination()
    _publish_turns(spark, sf_dir, log)
    _consumer(root).start(_stream(spark, log), until_drained=True).awaitTermination()
    return read_collection(spark, f"{root}/postings").select(*POSTING_FIELDS)


@registered(f"WITH {MESSAGES} SELECT event_id, key, value FROM messages")
def log_decode_strings(spark, sf_dir):
    raw = inputs.messages(spark, sf_dir).select(
        "event_id", F.col("key").cast("binary"), F.col("value").cast("binary"))
    return decode.decode_log_strings(raw)


@registered(f"WITH {DECODED} SELECT {POSTING_LIST} FROM decoded")
def collection_scan(spark, sf_dir):
    path = run_dir(spark, "collection")
    store.append_batch(_postings(spark, sf_dir), path, "scan", 0)
    return read_collection(spark, path).select(*POSTING_FIELDS)


# ---------------------------------------------------------------- sinks

@registered(f"""WITH {TURNS} SELECT 'name' AS key, CAST(json_object({JSON_PAIRS}) AS VARCHAR) AS value,
'jobs-data' AS topic FROM turns""")
def publish_messages(spark, sf_dir):
    path = run_dir(spark, "log")
    _publish_turns(spark, sf_dir, path)
    return read_log(spark, path).select("key", "value", "topic")


@registered("""SELECT 'jobs-data' AS topic, 'ok' AS status, count(*) AS messages FROM events
UNION ALL SELECT 'jobs-data', 'ok', count(*) FROM conversations""")
def delivery_report(spark, sf_dir):
    """Two publishes to one log, each with what it delivered."""
    path = _log(spark, sf_dir)
    _publish_turns(spark, sf_dir, path)
    return log_sink.delivery_report(spark, path).select("topic", "status", "messages")


@registered(f"WITH {DECODED} SELECT {POSTING_LIST} FROM decoded")
def append_postings(spark, sf_dir):
    root = run_dir(spark, "append")
    _consumer(root).start(
        _stream(spark, _log(spark, sf_dir)), until_drained=True).awaitTermination()
    return read_collection(spark, f"{root}/postings").select(*POSTING_FIELDS)


@registered(PUBLISHED_SQL)
def publish_snapshot(spark, sf_dir):
    """Full rewrite of the snapshot, twice, so that the second replaces the first."""
    root = run_dir(spark, "publish")
    published, log = f"{root}/published", f"{root}/refreshes"
    records = store.append_batch(_postings(spark, sf_dir), f"{root}/postings", "s", 0)
    publisher, place = snap.FullSnapshot(published), None
    for batch_id, query_at in enumerate(("2024-01-01 00:00:00", QUERY_AT)):
        refresh = snap.Refresh("s", batch_id, query_at, last_place=place)
        place = publisher.publish(
            publisher.prepare(spark, f"{root}/postings", refresh), refresh)
        snap.write_refresh_log(spark, log, refresh, publisher.kind, records, place, None)
    return snap.read_published(spark, published, log)


# ---------------------------------------------------------------- extraction

@registered(f"SELECT page_id, {_first('h1')} AS title FROM pages")
def extract_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", tx.first_element(F.col("html"), "h1").alias("title"))


@registered(f"""WITH {LISTED} SELECT page_id, position, "Company" FROM listed""")
def extract_descendant(spark, sf_dir):
    return extract.zip_fields(_listing_lists(spark, sf_dir, "Company"), ["Company"])


@registered(f"SELECT page_id, {_all('a')}[2] AS second_link FROM pages")
def extract_nth(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.get(tx.all_elements(F.col("html"), "a"), F.lit(1)).alias("second_link"))


@registered("""SELECT doc_id, trim(concat(chr(160), chr(9), chr(32), text, chr(10), chr(8195), chr(65279)),
concat(chr(9), chr(10), chr(11), chr(12), chr(13), chr(32), chr(160), chr(5760), chr(8192), chr(8193),
chr(8194), chr(8195), chr(8196), chr(8197), chr(8198), chr(8199), chr(8200), chr(8201), chr(8202),
chr(8232), chr(8233), chr(8239), chr(8287), chr(12288), chr(65279))) AS text FROM documents""")
def trim_text(spark, sf_dir):
    """White space of every kind goes from both ends, and from nowhere else."""
    padded = F.concat(F.lit("\u00a0\t "), F.col("text"), F.lit("\n\u2003\ufeff"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.strip_space(padded).alias("text"))


@registered(f"""WITH {LISTED} SELECT page_id, position, "Deadline" FROM listed""")
def extract_own_text(spark, sf_dir):
    return extract.zip_fields(_listing_lists(spark, sf_dir, "Deadline"), ["Deadline"])


@registered(f"""SELECT page_id, coalesce(nullif({_first('h2')}, ''), {_first('h1')}) AS heading
FROM pages""")
def extract_fallback(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", tx.or_else(
        tx.first_element(html, "h2"), tx.first_element(html, "h1")).alias("heading"))


@registered(f"""WITH {LISTED} SELECT page_id, CAST(unnest(range(len(salary))) AS INTEGER) AS position,
unnest(salary) AS "Salary" FROM salaries""")
def default_value(spark, sf_dir):
    """The salary rule; every fourth listing discloses none."""
    return extract.zip_fields(_listing_lists(spark, sf_dir, "Salary"), ["Salary"])


@registered(f"""SELECT page_id, CAST(unnest(range(len(links))) AS INTEGER) AS position, unnest(links) AS link,
unnest(list_resize(ads, len(links))) AS ad
FROM (SELECT page_id, {_all('a')} AS links, {_all('div')} AS ads FROM pages) AS p""")
def zip_fields(spark, sf_dir):
    html = F.col("html")
    lists = table(spark, sf_dir, "pages").select(
        "page_id", tx.all_elements(html, "a").alias("link"), tx.all_elements(html, "div").alias("ad"))
    return extract.zip_fields(lists, ["link", "ad"])


@registered(f"""WITH {LISTED} SELECT page_id, position, '{KEYWORD}' AS "SearchKeyWord",
"Job", "Company", salary[position + 1] AS "Salary", "Location", "Deadline", "JobDetails", "Created"
FROM listed JOIN salaries USING (page_id)""")
def extract_listings(spark, sf_dir):
    """All rules of the listing site and the positional zip, whole texts included."""
    ship_code(spark)
    return extract.extract_listings(
        inputs.listing_pages(spark, sf_dir), KEYWORD, _captured_at())


PAGE_RULES = (
    Rule("title", "h1", "article"),
    Rule("link", "li a", "nav"),
    Rule("ad", "div.ad", text="own"),
    Rule("footer", "footer", "body", otherwise=""),
)


@registered(f"""SELECT page_id, CAST(unnest(range(len(links))) AS INTEGER) AS position, unnest(links) AS link,
unnest(list_resize([{_entities(_first('h1'))}], len(links))) AS title,
unnest(list_resize([{_entities(f"trim({_first('div')})")}], len(links))) AS ad,
unnest(list_resize([{_entities(_first('footer'))}], len(links))) AS footer
FROM (SELECT page_id, html, [{_entities('x')} FOR x IN {_all('a')}] AS links
 FROM pages) AS p""")
def extract_page_rules(spark, sf_dir):
    """The rule engine on real, badly nested pages."""
    ship_code(spark)
    lists = extract.extract_lists(table(spark, sf_dir, "pages").select("page_id", "html"), PAGE_RULES)
    return extract.zip_fields(lists, ["link", "title", "ad", "footer"])


@registered(f"""SELECT page_id, url, '{KEYWORD}' AS "SearchKeyWord" FROM pages""")
def tag_keyword(spark, sf_dir):
    return extract.tag_keyword(table(spark, sf_dir, "pages").select("page_id", "url"), KEYWORD)


@registered("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "Created" FROM events""")
def stamp_created(spark, sf_dir):
    return extract.stamp_created(
        table(spark, sf_dir, "events").select("event_id", "ts"), F.col("ts")).drop("ts")


@registered("""SELECT page_id, url FROM pages
WHERE coalesce(try_cast(regexp_extract(url, '[?&]page=(\\d+)', 1) AS HUGEINT), 0) < 2""")
def page_budget(spark, sf_dir):
    """The first two result pages of a search; the ordinal is part of the URL."""
    return extract.page_budget(
        table(spark, sf_dir, "pages").select("page_id", "url"), url_page_number(F.col("url")), 2)


@registered("""SELECT DISTINCT doc_id // 15 AS page_id, (doc_id // 15) % 4 <> 3 AND (doc_id // 15) % 5 <> 0
AS has_next FROM documents""")
def has_next(spark, sf_dir):
    return _some_unread(spark, sf_dir).select("page_id", extract.has_next(F.col("html")).alias("has_next"))


def _some_unread(spark, sf_dir):
    """Listing pages; every fifth capture has no text. The last page is a short one."""
    return inputs.listing_pages(spark, sf_dir).withColumn(
        "html", F.when(F.col("page_id") % 5 != 0, F.col("html")))


@registered(f"""WITH {LISTED}, read AS (SELECT page_id, page_id % 5 <> 0 AS there, page_id % 4 <> 3 AS linked,
 CASE WHEN page_id % 5 <> 0 THEN n ELSE 0 END AS n, CASE WHEN page_id % 5 <> 0 THEN len(salary) ELSE 0 END AS s
 FROM (SELECT page_id, CAST(count(*) AS INTEGER) AS n FROM listed GROUP BY 1) AS c JOIN salaries USING (page_id))
SELECT page_id, there AND linked AS has_next, n AS "n_Job", n AS "n_Company", CAST(s AS INTEGER) AS "n_Salary",
n AS "n_Location", n AS "n_Deadline", n AS "n_JobDetails", there AND (NOT linked OR n >= 15) AS complete
FROM read""")
def page_completeness(spark, sf_dir):
    ship_code(spark)
    pages = _some_unread(spark, sf_dir).withColumn("has_next", extract.has_next(F.col("html")))
    return extract.page_completeness(extract.extract_lists(pages))


@registered(f"""WITH {DOCS} SELECT "SearchWord", "Job", "Company", "Location", "JobsDetails",
min("Created") AS "Created" FROM docs GROUP BY ALL""")
def drop_recaptures(spark, sf_dir):
    rows = inputs.document_postings(spark, sf_dir).drop("Salary", "Deadline")
    return extract.drop_recaptures(rows)


@registered(f"""WITH {DOCS} SELECT DISTINCT "SearchWord", "Job", "Company", "Location",
"JobsDetails" FROM docs""")
def stream_recaptures(spark, sf_dir):
    """Every listing captured in three micro-batches, each time with other stamps: published once."""
    path = run_dir(spark, "stream-recaptures")
    rows = inputs.document_postings(spark, sf_dir).drop("Salary", "Deadline")
    for _ in range(3):
        rows.write.mode("append").parquet(f"{path}/captures")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/captures")
        _drain_to_table(drop_recaptures_in_stream(stream), path)
        rows = rows.withColumn("Created", F.lit("2030-01-01 00:00:00"))
    return spark.read.schema(rows.schema).parquet(f"{path}/rows").drop("Created")


@registered(f"""WITH RECURSIVE links AS ({inputs.PAGE_LINKS_SQL.format(source="documents")}),
before AS (SELECT l.next_url AS url, min(l.url) AS back, count(*) AS linked_by FROM links l
 JOIN links n ON n.url = l.next_url WHERE l.next_url <> l.url GROUP BY l.next_url),
nodes AS (SELECT links.url, back, coalesce(linked_by, 0) AS linked_by FROM links LEFT JOIN before USING (url)),
walk AS (SELECT url, url AS head, CAST(0 AS BIGINT) AS ordinal FROM nodes WHERE back IS NULL
 UNION ALL SELECT n.url, w.head, w.ordinal + 1 FROM walk w JOIN nodes n ON n.back = w.url)
SELECT url, head, ordinal, linked_by, ordinal IS NULL AS in_cycle FROM nodes LEFT JOIN walk USING (url)""")
def order_pages(spark, sf_dir):
    """Place of every page by its next links, with forks and cycles."""
    return page_order(inputs.page_links(spark, sf_dir))


# ---------------------------------------------------------------- encode

@registered("""SELECT doc_id, CAST(json_object('text', text, 'lang', lang, 'source',
CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END) AS VARCHAR) AS value FROM documents""")
def encode_json(spark, sf_dir):
    source = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    return table(spark, sf_dir, "documents").withColumn("source", source).select(
        "doc_id", encode_object(("text", "lang", "source")).alias("value"))


@registered(f"""WITH {DECODED} SELECT d.event_id AS event_id, coalesce(value, '{NOT_ENCODABLE}') AS value,
"SearchWord", "Created" FROM decoded AS d JOIN messages AS m ON d.event_id = m.event_id""")
def malformed_sentinel(spark, sf_dir):
    """The sentinel of what could not be encoded decodes to nulls, beside messages that are whole."""
    rows = inputs.messages(spark, sf_dir).withColumn(
        "value", encode.or_sentinel(F.nullif("value", F.lit(NOT_ENCODABLE))))
    decoded = decode.decode_postings(rows, keep=("event_id", "value"))
    return decoded.select("event_id", "value", "SearchWord", "Created")


@registered(f"""WITH {TURNS} SELECT count(*) AS messages, count(DISTINCT conv_id) AS keys,
CAST(0 AS BIGINT) AS split_keys, CAST(sum(length(CAST(json_object({JSON_PAIRS}) AS VARCHAR))) AS BIGINT) AS chars
FROM turns""")
def keyed_partitioning(spark, sf_dir):
    """Whole messages keyed by conversation and dealt to eight partitions: none splits a key."""
    rows = encode.encode_messages(inputs.turn_listings(spark, sf_dir), key=F.col("conv_id"))
    dealt = encode.deal_by_key(rows, 8).withColumn("place", F.spark_partition_id())
    by_key = dealt.groupBy("key", "partition", "place").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars")).groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("places"),
        F.bool_and(F.col("partition") == F.col("place")).alias("as_said"))
    return by_key.agg(F.sum("n").alias("messages"), F.count(F.lit(1)).alias("keys"),
                      F.count_if((F.col("places") > 1) | ~F.col("as_said")).alias("split_keys"),
                      F.sum("chars").alias("chars"))


# ---------------------------------------------------------------- decode

@registered(f"WITH {DECODED} SELECT event_id, {POSTING_LIST} FROM decoded")
def decode_postings(spark, sf_dir):
    return decode.decode_postings(inputs.messages(spark, sf_dir), keep=("event_id",))


@registered(f"""WITH {DECODED} SELECT count(*) AS records,
count(*) FILTER (WHERE "SearchWord" IS NULL AND "Created" IS NULL) AS malformed,
count(*) FILTER (WHERE "Salary" = 'null') AS null_salaries,
count(*) FILTER (WHERE "Salary" = '') AS empty_salaries FROM decoded""")
def decode_malformed(spark, sf_dir):
    """Malformed records travel as rows of nulls and are counted."""
    return _postings(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("SearchWord").isNull() & F.col("Created").isNull()).alias("malformed"),
        F.count_if(F.col("Salary") == "null").alias("null_salaries"),
        F.count_if(F.col("Salary") == "").alias("empty_salaries"))


@registered(f"""WITH {TURNS} SELECT "SearchKeyWord" AS "SearchWord", "Job", "Company", "Salary",
"Location", "Deadline", "JobDetails" AS "JobsDetails", "Created" FROM turns""")
def rename_fields(spark, sf_dir):
    return decode.rename_fields(inputs.turn_listings(spark, sf_dir))


@registered(f"WITH {MESSAGES} SELECT key, value, true AS placed FROM messages")
def record_trace(spark, sf_dir):
    trace = decode.record_trace(read_log(spark, _log(spark, sf_dir)))
    return trace.select(
        "key", "value", (F.col("place").contains("publish_id=") & (F.col("row") >= 0)).alias("placed"))


@registered("SELECT count(*) AS records FROM events")
def batch_count(spark, sf_dir):
    return decode.batch_count(_postings(spark, sf_dir))


# ---------------------------------------------------------------- clean

DOCUMENTS = f"docs AS ({documents_sql(DUCKDB_WORDS)})"
PARSED_DOCUMENTS = f"""{DOCUMENTS}, parsed AS (SELECT *, json_exists(j, '$.SearchWord') AS guarded,
{_keys(POSTING_FIELDS)} AS whole
FROM (SELECT event_id, document, try_cast(document AS JSON) AS j FROM docs) AS d
WHERE json_type(j) = 'OBJECT')"""


@registered(f"""WITH {DOCUMENTS} SELECT event_id, document FROM docs
WHERE json_type(try_cast(document AS JSON)) = 'OBJECT'""")
def only_objects(spark, sf_dir):
    return clean.only_objects(inputs.stored_documents(spark, sf_dir))


@registered(f"WITH {DECODED} SELECT {POSTING_LIST} FROM decoded")
def drop_id(spark, sf_dir):
    rows = decode.decode_postings(inputs.messages(spark, sf_dir), keep=("event_id",))
    return clean.drop_id(rows.withColumnRenamed("event_id", "_id"))


@registered(f"""WITH {PARSED_DOCUMENTS} SELECT event_id,
{_decoded_columns({n: n for n in POSTING_FIELDS}, "guarded")} FROM parsed WHERE NOT guarded OR whole""")
def guard_missing(spark, sf_dir):
    documents = clean.only_objects(inputs.stored_documents(spark, sf_dir))
    return clean.guard_missing(documents, keep=("event_id",))


@registered(f"""WITH {PARSED_DOCUMENTS} SELECT event_id, document, concat('document lacks: ',
concat_ws(',', {", ".join(f"CASE WHEN NOT json_exists(j, '$.{n}') THEN '{n}' END" for n in POSTING_FIELDS)}))
AS reason FROM parsed WHERE guarded AND NOT whole""")
def missing_field_rejects(spark, sf_dir):
    documents = clean.only_objects(inputs.stored_documents(spark, sf_dir))
    return clean.missing_field_rejects(documents, keep=("event_id",))


@registered(f"WITH {DECODED} SELECT {POSTING_LIST}, '{QUERY_AT}' AS \"QueryAt\" FROM decoded")
def stamp_query_at(spark, sf_dir):
    return clean.stamp_query_at(_postings(spark, sf_dir), QUERY_AT)


@registered(f'WITH {DECODED} SELECT {POSTING_LIST} FROM decoded WHERE "SearchWord" IS NOT NULL')
def filter_not_null(spark, sf_dir):
    return clean.with_search_word(_postings(spark, sf_dir))


@registered("SELECT DISTINCT text, lang, source FROM documents")
def dedup_rows(spark, sf_dir):
    return clean.dedup_rows(table(spark, sf_dir, "documents").select("text", "lang", "source"))


# ---------------------------------------------------------------- publish

@registered(f"""WITH {DOCS} SELECT "SearchWord", "Job", "Company",
CASE WHEN regexp_matches("Salary", '^[=+\\-@]') THEN concat('''', "Salary") ELSE "Salary" END AS "Salary",
"Location", "Deadline", CASE WHEN regexp_matches("JobsDetails", '^[=+\\-@]')
THEN concat('''', "JobsDetails") ELSE "JobsDetails" END AS "JobsDetails", "Created",
'{QUERY_AT}' AS "QueryAt" FROM docs""")
def grid_export(spark, sf_dir):
    path = run_dir(spark, "grid")
    rows = clean.snapshot(inputs.document_postings(spark, sf_dir), QUERY_AT)
    snap.grid_export(rows, path)
    return snap.read_grid(spark, path)


@registered(f"""WITH {DOCS} SELECT "SearchWord", "Job", "Company", "Salary", "Location",
try_strptime("Deadline", '%Y-%m-%d %H:%M:%S') AS "Created",
try_strptime("Created", '%Y-%m-%d %H:%M:%S') AS "QueryAt", "JobsDetails" FROM docs""")
def typed_snapshot(spark, sf_dir):
    """Stamps become timestamps; text that is no stamp becomes NULL."""
    rows = inputs.document_postings(spark, sf_dir).withColumnsRenamed(
        {"Created": "QueryAt", "Deadline": "Created"})
    return snap.typed_snapshot(rows)


# Written without the operator's patterns: digits with separators in threes, one day format at a time.
CELL_DIGITS = r"((\d{1,3}(,\d{3})+|\d+)(\.\d*)?|\.\d+)([eE][+-]?\d+)?"
CELLS = rf"""typed AS ({inputs.CELLS_SQL.format(source="documents")}),
parts AS (SELECT *, trim(salary) AS s, string_split(replace(split_part(deadline, ' ', 1), '/', '-'), '-') AS d,
 split_part(deadline, ' ', 2) AS t FROM typed),
cells AS (SELECT *, s LIKE '(%' AS minus, try_cast(regexp_replace(s, '[,$%() +]', '', 'g') AS DOUBLE) AS size,
 try_cast(concat(CASE WHEN length(d[1]) = 4 THEN concat(d[1], '-', lpad(d[2], 2, '0'), '-', lpad(d[3], 2, '0'))
  ELSE concat(d[3], '-', lpad(d[1], 2, '0'), '-', lpad(d[2], 2, '0')) END, ' ', CASE WHEN t = '' THEN '00:00:00'
  WHEN length(t) < 6 THEN concat(lpad(t, 5, '0'), ':00') ELSE t END) AS TIMESTAMP) AS moment FROM parts),
kinds AS (SELECT *, CASE WHEN coalesce(s, '') = '' THEN 'blank' WHEN s = 'TRUE' THEN 'boolean'
 WHEN regexp_full_match(s, '[+-]?{CELL_DIGITS}|\({CELL_DIGITS}\)') THEN 'number'
 WHEN regexp_full_match(s, '{CELL_DIGITS}%') THEN 'percent'
 WHEN regexp_full_match(s, '[$]{CELL_DIGITS}') THEN 'currency' ELSE 'text' END AS kind FROM cells)"""


@registered(f"""WITH {CELLS} SELECT doc_id, kind AS salary_kind,
CASE kind WHEN 'percent' THEN size / 100 WHEN 'number' THEN CASE WHEN minus THEN -size ELSE size END
 WHEN 'currency' THEN size END AS salary_number, CASE WHEN kind = 'boolean' THEN true END AS salary_flag,
CASE WHEN kind = 'text' THEN CASE WHEN ascii(s) = 39 THEN substr(s, 2) ELSE salary END END AS salary_text,
CASE WHEN moment IS NULL THEN 'text' WHEN t = '' THEN 'date' ELSE 'datetime' END AS deadline_kind,
moment AS deadline_moment FROM kinds""")
def typed_cells(spark, sf_dir):
    """Salaries and deadlines as a sheet would take them."""
    rows = cells.typed_cells(inputs.typed_texts(spark, sf_dir), ["salary", "deadline"])
    return rows.select(
        "doc_id", F.col("salary.kind").alias("salary_kind"), F.col("salary.number").alias("salary_number"),
        F.col("salary.flag").alias("salary_flag"), F.col("salary.text").alias("salary_text"),
        F.col("deadline.kind").alias("deadline_kind"), F.col("deadline.moment").alias("deadline_moment"))


# ---------------------------------------------------------------- end to end

@registered(PUBLISHED_SQL)
def stream_publish(spark, sf_dir):
    """Log to stream to collection to snapshot."""
    root = run_dir(spark, "stream-publish")
    consumer = _consumer(root)
    consumer.start(_stream(spark, _log(spark, sf_dir)), until_drained=True).awaitTermination()
    return snap.read_published(spark, f"{root}/published", f"{root}/refreshes")


@registered(f"""WITH {MESSAGES} SELECT key, value, CASE WHEN value IS NULL THEN 'no text'
WHEN json_type(j) = 'OBJECT' THEN concat('lacks: ', concat_ws(',', {", ".join(
    f"CASE WHEN NOT json_exists(j, '$.{n}') THEN '{n}' END" for n in MESSAGE_FIELDS)}))
ELSE 'not a JSON object' END AS reason
FROM (SELECT key, value, try_cast(value AS JSON) AS j FROM messages) AS parsed
WHERE NOT coalesce(json_type(j) = 'OBJECT' AND {_keys(MESSAGE_FIELDS)}, false)""")
def stream_rejects(spark, sf_dir):
    """What a running consumer could not decode, with the reasons; the same parse as the postings'."""
    root = run_dir(spark, "stream-rejects")
    consumer = _consumer(root)
    consumer.rejects_dir = f"{root}/rejects"
    consumer.start(_stream(spark, _log(spark, sf_dir)), until_drained=True).awaitTermination()
    return spark.read.schema("key string, value string, reason string").parquet(f"{root}/rejects").select(
        "key", "value", "reason")


@registered(f"""WITH {DECODED} SELECT count(*) AS records,
count(*) FILTER (WHERE "SearchWord" IS NULL) AS rejected FROM decoded""")
def stream_counts(spark, sf_dir):
    """Counts that a running consumer observes while it writes its batches, added up."""
    root = run_dir(spark, "stream-counts")
    consumer = _consumer(root)
    consumer.start(_stream(spark, _log(spark, sf_dir)), until_drained=True).awaitTermination()
    seen = list(consumer.counts.values())
    return spark.createDataFrame(
        [(one["records"], one["rejected"]) for one in seen], "records bigint, rejected bigint").agg(
        F.sum("records").alias("records"), F.sum("rejected").alias("rejected"))


@registered(f"""WITH {DECODED} SELECT {POSTING_LIST}, '{QUERY_AT}' AS "QueryAt" FROM decoded
WHERE "SearchWord" IS NOT NULL""")
def snapshot_catches_up(spark, sf_dir):
    """Two streams store half the messages each; the first's publish fails, the second's makes up for it."""
    root, rows = run_dir(spark, "catches-up"), inputs.messages(spark, sf_dir)

    class Down(snap.IncrementalSnapshot):
        def publish(self, rows, refresh):
            raise OSError("target is down")

    for stream, publisher, half in (("given-up", Down(f"{root}/published"), 0), ("next", None, 1)):
        job = _consumer(root, publisher)
        job.stream_id = stream
        job.process(rows.where(F.col("event_id") % 2 == half), 0)
    return snap.read_published(spark, f"{root}/published", f"{root}/refreshes")


@registered(f"""WITH {DECODED} SELECT {POSTING_LIST}, event_id % 4 AS batch_id FROM decoded""")
def compact_postings(spark, sf_dir):
    """Four batches, three of them merged and cleared away; a replay of a merged one adds nothing."""
    root = run_dir(spark, "compact")
    rows = decode.decode_postings(inputs.messages(spark, sf_dir), keep=("event_id",))
    for batch in (0, 1, 2, 3):
        store.append_batch(rows.where(F.col("event_id") % 4 == batch), root, "s", batch)
    compaction.compact(spark, root)
    compaction.clear_merged(spark, root, keep_seconds=0)
    store.append_batch(rows.where(F.col("event_id") % 4 == 1), root, "s", 1)
    return read_collection(spark, root).select(*POSTING_FIELDS, "batch_id")


@registered(f"""WITH {PARSED_DOCUMENTS} SELECT {", ".join(f'"{n}"' for n in POSTING_FIELDS)},
'{QUERY_AT}' AS "QueryAt" FROM (SELECT {_decoded_columns({n: n for n in POSTING_FIELDS}, "guarded")}
 FROM parsed WHERE guarded AND whole) AS kept WHERE "SearchWord" IS NOT NULL""")
def documents_to_snapshot(spark, sf_dir):
    """Stored JSON documents, cleaned, to the snapshot; what lacks a field goes to the rejects."""
    root = run_dir(spark, "documents")
    rows = documents_snapshot(inputs.stored_documents(spark, sf_dir), QUERY_AT, f"{root}/rejects")
    rows.write.parquet(f"{root}/snapshot")
    return spark.read.schema(rows.schema).parquet(f"{root}/snapshot")


@registered(f"""WITH {PARSED_DOCUMENTS} SELECT document, concat('document lacks: ',
concat_ws(',', {", ".join(f"CASE WHEN NOT json_exists(j, '$.{n}') THEN '{n}' END" for n in POSTING_FIELDS)}))
AS reason FROM parsed WHERE guarded AND NOT whole""")
def rejects(spark, sf_dir):
    """The rejects table that the same path writes."""
    path = f"{run_dir(spark, 'documents')}/rejects"
    documents_snapshot(inputs.stored_documents(spark, sf_dir), QUERY_AT, path)
    return spark.read.schema("document string, reason string").parquet(path)


@registered(f"""WITH {LISTED} SELECT '{KEYWORD}' AS "SearchWord", "Job", "Company",
salary[position + 1] AS "Salary", "Location", "Deadline", "JobDetails" AS "JobsDetails", "Created",
'{QUERY_AT}' AS "QueryAt" FROM listed JOIN salaries USING (page_id)""")
def pages_to_snapshot(spark, sf_dir):
    """Pages to messages to postings to snapshot as one lazy plan, without a log."""
    ship_code(spark)
    rows = extract.extract_listings(inputs.listing_pages(spark, sf_dir), KEYWORD, _captured_at())
    return clean.snapshot(decode.decode_postings(encode.encode_messages(rows)), QUERY_AT)

