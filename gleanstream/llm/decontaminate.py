"""Benchmark decontamination as a prefix-filtered set join.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is 13
consecutive words of an item, or a shorter item as a whole. A window is contained in a
document only if all its shingles are, so one necessary shingle is enough to find it: the
rarest, by counts over all documents. That prefix token of each window is joined with the
documents' tokens. The offset of the token in the window gives the only place where the
window can lie; the place must lie within the document (the positional and the length bound); and the
words there are compared with the window's, one by one.

One plan for any size of the benchmark, and one pass over the texts: a Bloom filter of the windows'
shingles, of bounded size, lets through the documents' tokens that may be among them, each with
the few words around it; only those are stored and joined. The filter decides what is
shuffled, never what comes out. Frequent tokens are joined by broadcast, see ``tables.attach``.

Null and empty texts have no words: a document without words has no hits, an item without words
has no windows. Items that repeat count by item_id; items without an id take no part. Every row
is judged on its own text; rows without a doc_id and rows that share one stay apart. A text of
any length is read whole. An empty table gives an empty result, an empty benchmark no hits. Columns
of the documents are let through by ``drop_contaminated``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import tables, words

WINDOW = 13
#: Words of a shingle; shorter windows are one shingle.
SHINGLE = 5
#: Item words whose windows are made in one task.
SLICE_WORDS = 200_000
#: Bits of the filter at most (16 MB), and bits it has for each key if they suffice.
FILTER_BITS, KEY_BITS = 2**27, 64


def _item_windows(texts: pa.Array) -> pa.Array:
    """Windows of items: their words and the hashes of their shingles."""
    rows = []
    for text in texts.to_pylist():
        own = words.split(text, words.ALPHANUMERIC)
        hashes = next(words.hashed_words([text], words.ALPHANUMERIC))[1]
        size = min(len(own), WINDOW)
        width = min(size, SHINGLE)
        tokens = words.run_hashes(hashes, max(width, 1)).view(np.int64)
        rows.append([
            {"words": [word.decode() for word in own[start:start + size]],
             "tokens": tokens[start:start + size - width + 1].tolist()}
            for start in range(len(own) - size + 1)] if own else [])
    one = pa.struct([("words", pa.list_(pa.string())), ("tokens", pa.list_(pa.int64()))])
    return pa.StructArray.from_arrays([pa.array(rows, pa.list_(one))], ["windows"])


def _windows(benchmark: DataFrame, item_text: str, item_id: str, slice_words: int) -> DataFrame:
    """A stored table (item_id, words, tokens), one row for each window of each item."""
    items = tables.stored(benchmark.select(
        F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("text")
    ).filter("item_id IS NOT NULL AND text IS NOT NULL").distinct(), "items")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    dealt = items.repartition(max(1, -(-int(size) // (6 * slice_words))))
    made = tables.with_result(
        dealt, _item_windows, "windows array<struct<words: array<string>, tokens: array<bigint>>>", "text")
    return tables.stored(made.select("item_id", F.explode("windows").alias("one")).select(
        "item_id", "one.words", "one.tokens").distinct(), "windows")


def _token_hits(filter_bytes, widths: list[int]):
    """Words of a text, and its tokens that pass the filter, each with the words around it."""
    before, after = WINDOW - 1, WINDOW

    def run(texts: pa.Array) -> pa.Array:
        rows = texts.to_pylist()
        counts, hits = [], []
        for first, hashes, bounds in words.hashed_words(rows, words.ALPHANUMERIC):
            found: list[list[tuple[int, int]]] = [[] for _ in bounds[1:]]
            for width in widths:
                tokens = words.run_hashes(hashes, width).view(np.int64)
                places = np.flatnonzero(tables.maybe_in(filter_bytes.value, tokens))
                owner = np.searchsorted(bounds, places, side="right") - 1
                inside = places + width <= bounds[owner + 1]  # a run must end in its own text
                for place, at in zip(places[inside].tolist(), owner[inside].tolist()):
                    found[at].append((place - int(bounds[at]), int(tokens[place])))
            for at, own in enumerate(found):
                counts.append(int(bounds[at + 1] - bounds[at]))
                text = [word.decode() for word in words.split(rows[first + at], words.ALPHANUMERIC)] if own else []
                hits.append([
                    {"at": place, "token": token, "low": max(place - before, 0),
                     "around": text[max(place - before, 0):place + after]} for place, token in own])
        one = pa.struct([("at", pa.int64()), ("token", pa.int64()), ("low", pa.int64()),
                         ("around", pa.list_(pa.string()))])
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(hits, pa.list_(one))], ["n_words", "hits"])
    return run


_HITS = ("n_words bigint, hits array<struct<at: bigint, token: bigint, low: bigint, "
         "around: array<string>>>")


def _judged(rows: DataFrame, benchmark: DataFrame, item_text: str, item_id: str,
            slice_words: int) -> DataFrame:
    """All columns of the table but ``text``, and the verdict on it; one row for each row."""
    spark = rows.sparkSession
    kept = [name for name in rows.columns if name != "text"]
    windows = _windows(benchmark, item_text, item_id, slice_words)
    tokens = tables.stored(windows.select(F.explode("tokens").alias("token")).distinct(), "item-tokens")
    bits = tables.filter_bits(tokens.count(), FILTER_BITS, KEY_BITS)
    filter_bytes = spark.sparkContext.broadcast(
        tables.filter_array(tables.member_filter(tokens, "token", bits), bits))
    widths = sorted(row[0] for row in windows.select(
        F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect())  # five at most
    found = tables.stored(tables.with_result(
        rows.withColumn("place", F.monotonically_increasing_id()),
        _token_hits(filter_bytes, widths), _HITS, "text").select(*kept, "place", "n_words", "hits"), "token-hits")
    hits = found.select("place", "n_words", F.explode("hits").alias("hit")).select(
        "place", "n_words", "hit.*")

    counts = tables.stored(hits.groupBy("token").agg(F.count("*").alias("n")), "token-counts")
    own = windows.select("words", F.posexplode("tokens").alias("offset", "token")).distinct()
    rarest = own.join(counts, "token").groupBy("words").agg(
        # all shingles of a window must occur
        F.min(F.struct("n", "token", "offset")).alias("rarest"), F.count("*").alias("met"),
    ).filter(F.col("met") == F.size("words") - F.least(F.size("words"), F.lit(SHINGLE)) + 1)
    # where a window may begin, seen from its token, and its size: a few pairs of small numbers
    prefixes = rarest.groupBy(F.col("rarest.token").alias("token")).agg(
        F.max("rarest.n").alias("n"),
        F.collect_set(F.struct(F.col("rarest.offset").alias("offset"), F.size("words").alias("size"))).alias("places"))
    prefixes = tables.stored(prefixes, "prefix-tokens")
    start = F.col("at") - F.col("one.offset")
    met = tables.attach(hits, prefixes, "token", "n").filter("places IS NOT NULL").select(
        "*", F.explode("places").alias("one")).filter(
        (start >= 0) & (start + F.col("one.size") <= F.col("n_words"))).select(
        "place", start.alias("start"), F.col("one.size").alias("size"),
        F.slice("around", (start - F.col("low") + 1).cast("int"), F.col("one.size")).alias("words"))
    met = tables.stored(met.distinct(), "candidates")

    # verified word by word: what is left has the words of a window
    owners = met.groupBy("words").agg(F.count("*").alias("n")).join(
        windows.groupBy("words").agg(F.collect_set("item_id").alias("owners")), "words")
    spans = tables.stored(tables.attach(met, tables.stored(owners, "met-windows"), "words", "n").filter(
        "owners IS NOT NULL").select("place", "start", "size", "owners"), "spans")
    items = spans.select("place", F.explode("owners").alias("item")).groupBy("place").agg(
        F.sort_array(F.collect_set("item")).alias("items"))
    # a document's spans are no more than its words
    covered = spans.groupBy("place", "start").agg(F.max("size").alias("size")).groupBy("place").agg(
        F.sort_array(F.collect_list(F.struct("start", "size"))).alias("spans")).select(
        "place", F.expr("""aggregate(spans, named_struct('hit', 0L, 'reach', 0L), (seen, one) ->
            named_struct('hit', seen.hit + greatest(0L, one.start + one.size - greatest(one.start, seen.reach)),
            'reach', greatest(seen.reach, one.start + one.size)), seen -> seen.hit)""").alias("n_hit"))
    verdicts = items.join(covered, "place")
    names = F.array_join(F.sort_array(F.transform("items", lambda one: one.cast("string"))), ",")
    return found.drop("hits").join(verdicts, "place", "left").drop("place").select(
        *kept, "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(names, F.lit("")), 256).alias("items_sha256"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id",
                  slice_words: int = SLICE_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, items, contaminated."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return _judged(rows, benchmark, item_text, item_id, slice_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                      doc_id: str = "doc_id", slice_words: int = SLICE_WORDS) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    A row goes by its text alone, so what has to go is known by the text's digest. A filter lets
    most documents stay where they are; only those that may have to go are shuffled.
    """
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    rows = docs.select(digest.alias("digest"), F.col(text).alias("text"))
    gone = tables.stored(_judged(rows, benchmark, "text", "item_id", slice_words).filter(
        "contaminated").select("digest").distinct(), "contaminated")
    marked = tables.marked_among(
        tables.packed(docs).withColumn("own", F.sha2(F.coalesce(F.col("row")[text], F.lit("")), 256)
        ).withColumn("key", F.xxhash64("own")), "key", gone.select(F.xxhash64("digest").alias("key")))
    rest = marked.filter("maybe").join(gone, F.col("own") == F.col("digest"), "left_anti")
    return marked.filter(~F.col("maybe")).select("row.*").unionByName(rest.select("row.*"))


ORACLE_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, w[s:s + least(len(w), 13) - 1] AS run
  FROM item_words, unnest(range(1, greatest(len(w) - 13 + 1, 1) + 1)) AS starts(s)
  WHERE len(w) > 0),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
doc_runs AS (
  SELECT doc_id, s, size, w[s:s + size - 1] AS run
  FROM doc_words, sizes, unnest(range(1, len(w) - size + 2)) AS starts(s)),
met AS (
  SELECT doc_id, s, doc_runs.size AS size, item_id
  FROM doc_runs JOIN windows ON doc_runs.size = windows.size AND doc_runs.run = windows.run),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM met, unnest(range(s, s + size)) AS places(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words AS d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""
