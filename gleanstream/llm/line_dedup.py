"""Line dedup: lines that many sites share are boilerplate and are removed.

Native: DataFrame functions only. Each distinct line (trimmed, of at least ``min_chars``
characters) gets a HyperLogLog sketch of the sites it occurs on; sketches merge by
aggregation, so a line that a third of all documents have costs each task one row. A line
well above or below the threshold is settled by its estimate. Lines within ``band`` of it
get exact distinct counts. Boilerplate lines then leave their documents.

Null texts have no lines and stay null; a null site counts as a site of its own. Blank lines
are never counted nor removed, and what stays keeps its order. A line repeated within one
site counts once. An empty table gives an empty result; all columns are let through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import tables

#: Distinct sites from which on a line is boilerplate, and the least length of such a line.
MIN_SITES, MIN_CHARS = 6, 16
#: Registers (log2) of a sketch: a standard error of 1.6 %; 10 % is six times that.
REGISTERS, BAND = 12, 0.1
# Fixed value: the white space that is trimmed off lines.
TRIMMED = " \t\r\x0b\x0c"


def _line_key(line: Column, min_chars: int) -> Column:
    """128 bits of the trimmed line, null for short ones."""
    trimmed = F.btrim(line, F.lit(TRIMMED))
    return F.when(F.length(trimmed) >= min_chars, F.unhex(F.md5(trimmed)))


def _occurrences(docs: DataFrame, text: str, site: str, min_chars: int) -> DataFrame:
    """(line, site) of every line that counts, from the packed documents."""
    lines = F.explode(F.array_distinct(F.transform(
        F.split(F.col(f"row.{text}"), "\n"), lambda one: _line_key(one, min_chars))))
    site_text = F.coalesce(F.concat(F.lit("="), F.col(f"row.{site}").cast("string")), F.lit("-"))
    return docs.select(site_text.alias("site"), lines.alias("line")).filter("line IS NOT NULL")


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source",
                min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, registers: int = REGISTERS,
                band: float = BAND) -> DataFrame:
    """(line, documents, exact): keys of the lines that at least ``min_sites`` sites have."""
    seen = _occurrences(tables.packed(docs), text, site, min_chars)
    spread = tables.stored(seen.groupBy("line").agg(
        F.count("*").alias("documents"), F.hll_sketch_agg("site", registers).alias("sketch")).select(
        "line", "documents", F.hll_sketch_estimate("sketch").alias("sites")).filter(
        F.col("sites") >= min_sites * (1 - band)), "line-spread")
    sure = F.col("sites") > min_sites * (1 + band)
    near = spread.filter(~sure).select("line", "documents")
    counted = tables.among(seen.withColumn("key", F.xxhash64("line")), "key", near.select(
        F.xxhash64("line").alias("key"))).select("line", "site").distinct()
    exact = counted.groupBy("line").agg(F.count("*").alias("sites")).filter(
        F.col("sites") >= min_sites).join(near, "line")
    return tables.stored(
        spread.filter(sure).select("line", "documents", F.lit(False).alias("exact")).unionByName(
            exact.select("line", "documents", F.lit(True).alias("exact"))), "boilerplate")


def without_boilerplate(docs: DataFrame, text: str = "text", site: str = "source",
                        min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS,
                        registers: int = REGISTERS, band: float = BAND) -> DataFrame:
    """``row`` (the document as given), clean, n_lines, n_removed.

    The most frequent lines, of which there can be no more than HOT_KEYS, go to all tasks and
    are taken out on the spot. For the others only hashes of lines are joined, and a
    document's text is shuffled only if it may lose one of those.
    """
    gone = boilerplate(docs, text, site, min_sites, min_chars, registers, band)
    total = gone.agg(F.sum("documents")).first()[0] or 0
    is_hot = F.col("documents") * tables.HOT_KEYS > total
    hot = [row[0] for row in gone.filter(is_hot).select(F.hex("line")).collect()]
    gone = gone.filter(~is_hot)
    rows = tables.packed(docs).withColumn("ident", F.xxhash64(F.to_json(F.struct(
        F.col(f"row.{text}").alias("text"), F.col(f"row.{site}").alias("site")))))
    lines = rows.select("ident", F.explode(F.array_distinct(F.transform(
        F.split(F.col(f"row.{text}"), "\n"), lambda one: _line_key(one, min_chars)))).alias("line"))
    maybe = tables.stored(tables.among(
        lines.filter("line IS NOT NULL").withColumn("key", F.xxhash64("line")), "key",
        gone.select(F.xxhash64("line").alias("key"))).select("ident", "line").distinct(), "maybe-lines")
    found = tables.attach(maybe, gone, "line", "documents").filter("exact IS NOT NULL")
    lost = tables.stored(found.groupBy("ident").agg(F.collect_set("line").alias("lost")), "lost-lines")

    marked = tables.marked_among(rows, "ident", lost.select("ident"))
    affected = marked.filter("maybe").join(lost, "ident", "left").select("row", "lost")
    untouched = marked.filter(~F.col("maybe")).select(
        "row", F.lit(None).cast("array<binary>").alias("lost"))
    all_lines = F.split(F.col(f"row.{text}"), "\n")
    common = F.filter(all_lines, lambda one: ~F.coalesce(
        F.hex(_line_key(one, min_chars)).isin(hot), F.lit(False))) if hot else all_lines
    kept = F.when(F.col("lost").isNull(), common).otherwise(F.filter(
        common, lambda one: ~F.coalesce(
            F.array_contains(F.col("lost"), _line_key(one, min_chars)), F.lit(False))))
    return affected.unionByName(untouched).select("row", all_lines.alias("_all"), kept.alias("_kept")).select(
        "row", F.array_join("_kept", "\n").alias("clean"),
        F.coalesce(F.array_size("_all"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.array_size("_all") - F.array_size("_kept"), F.lit(0)).cast("bigint").alias(
            "n_removed"))


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS trimmed FROM lines),
gone AS (
  SELECT trimmed FROM keyed WHERE length(trimmed) >= {MIN_CHARS}
  GROUP BY trimmed HAVING count(DISTINCT coalesce('=' || source, '')) >= {MIN_SITES}),
cleaned AS (
  SELECT doc_id, count(*) AS n_lines,
    count(*) FILTER (WHERE g.trimmed IS NOT NULL) AS n_removed,
    string_agg(line, chr(10) ORDER BY place) FILTER (WHERE g.trimmed IS NULL) AS clean
  FROM keyed LEFT JOIN gone AS g ON keyed.trimmed = g.trimmed GROUP BY doc_id)
SELECT d.doc_id AS doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(clean, '')) END AS clean_sha256
FROM documents AS d LEFT JOIN cleaned USING (doc_id)"""
