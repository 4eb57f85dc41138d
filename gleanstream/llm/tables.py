"""Shared pieces of the operators: stored tables, skew-safe joins, repeat filters."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from gleanstream.functions.once import computed_once
from gleanstream.session import run_dir, ship_code

#: A key that holds more than this share of all rows is joined by broadcast. Fewer than
#: HOT_KEYS keys can hold so much, so what is broadcast is bounded whatever the data are.
HOT_KEYS = 1000
#: Bytes of texts that a task works on at once; a longer text is a part of its own.
PART_BYTES = 1 << 21
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bits in one block of a repeat filter, as ``bitmap_construct_agg`` makes them (4 KiB).
BLOCK_BITS = 32768
#: Bits of a filter at most, 128 MiB. Beyond 2**26 rows it takes more and more other rows for
#: members, which costs their shuffle but changes no result.
FILTER_BITS = 2**30
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def prepare(spark: SparkSession) -> None:
    """What Python tasks need: this package, and record batches that stay small.

    The engine's default of 10,000 rows a batch is for short rows; with whole texts it costs
    each task, on both sides, some hundred MB. A session's own setting is left alone.
    """
    ship_code(spark)
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it: cuts lineage, survives lost executors."""
    path = run_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return to the system what Arrow and, where it is glibc, the C library hold for later use.

    An executor's workers live as long as it does, so what one stage took stays taken in all later ones.
    """
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 400) -> Iterator[pa.RecordBatch]:
    """Batches in small parts, so that a worker holds few decoded texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        give_back()


def packed(docs: DataFrame) -> DataFrame:
    """All columns as one struct, so that helper columns never clash with those of the input."""
    return docs.select(F.struct("*").alias("row"))


def parts_by_bytes(columns: Sequence[pa.Array], most: int = PART_BYTES) -> Iterator[list[pa.Array]]:
    """Parts of some arrays of equal length, cut so that each has few bytes, one row at least."""
    count = len(columns[0])
    sizes = np.zeros(count, np.int64)
    for column in columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = 0
    while start < count:
        fit = int(np.searchsorted(np.cumsum(sizes[start:start + 1000]), most, side="right"))
        yield [column.slice(start, max(fit, 1)) for column in columns]
        start += max(fit, 1)


def with_result(rows: DataFrame, function: Callable[..., pa.Array], result: str, *inputs: str | Column) -> DataFrame:
    """Add the fields of the struct that ``function`` makes of some columns, as Arrow arrays.

    ``result`` is the struct's schema. Only the inputs go to Python; other columns, whatever
    their names and types, stay in the JVM. It is computed once per row, whatever looks at it,
    in parts of few bytes, and a worker gives back its memory after each batch.
    """
    prepare(rows.sparkSession)
    schema = StructType.fromDDL(result)

    @F.arrow_udf(schema)
    def made(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for _, *columns in batches:  # a constant goes along, so that there always are several
            parts = [function(*part) for part in parts_by_bytes(columns)]
            yield pa.concat_arrays(parts) if parts else pa.array([], to_arrow_type(schema))
            del columns, parts
            give_back()

    return computed_once(rows, made(F.lit(0), *inputs), schema.names)


def attach(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """Left join with a table that has one row per key, whatever share of the rows a key has.

    ``count`` is the table's column with the number of rows of the key. Keys with more than
    1/HOT_KEYS of them are fewer than HOT_KEYS and are joined by broadcast, so their rows
    stay where they are; the other rows are shuffled. Keys must not be null. Both inputs are
    read twice; give stored tables or cheap scans.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    payload = [name for name in table.columns if name != key]
    is_hot = F.col(count) * HOT_KEYS > total
    hot = table.filter(is_hot).select(F.col(key), F.struct(*payload).alias("_hot"))
    marked = rows.join(F.broadcast(hot), key, "left")
    here = marked.filter(F.col("_hot").isNotNull()).select(
        *rows.columns, *(F.col("_hot")[name].alias(name) for name in payload))
    rest = marked.filter(F.col("_hot").isNull()).drop("_hot").join(
        table.filter(~is_hot), key, "left")
    return here.unionByName(rest.select(*rows.columns, *payload))


def filter_bits(rows: int, most: int, key_bits: int = 16) -> int:
    """Bits for a filter over so many rows: 16 a row, as a power of two of at most ``most``."""
    bits = BLOCK_BITS
    while bits < min(key_bits * rows, most):
        bits *= 2
    return bits


def _block(key: Column, blocks: int) -> Column:
    return F.shiftrightunsigned(key, 34).bitwiseAND(F.lit(blocks - 1))


def _positions(key: Column) -> tuple[Column, Column]:
    low = F.lit(BLOCK_BITS - 1)
    return key.bitwiseAND(low), F.shiftrightunsigned(key, 15).bitwiseAND(low)


def _bitmaps(hits: DataFrame) -> DataFrame:
    return hits.groupBy("block").agg(F.expr("bitmap_construct_agg(position)").alias("bitmap"))


def _spread(keys: DataFrame, key: str, bits: int) -> DataFrame:
    first, second = _positions(F.col(key))
    return keys.select(
        _block(F.col(key), bits // BLOCK_BITS).alias("block"),
        F.explode(F.array(first, second)).alias("position"))


def repeat_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Blocked Bloom filter of the 64-bit keys that may occur more than once.

    A bit is set where at least two rows meet, counted over all rows before one bit is
    written: counts are combined on the map side, so a frequent key sends one row a task.
    The table has at most bits / 8 bytes whatever the rows are.
    """
    met = _spread(keys, key, bits).groupBy("block", "position").count()
    return _bitmaps(met.filter("count > 1"))


def member_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Blocked Bloom filter of the 64-bit keys that occur at all."""
    return _bitmaps(_spread(keys, key, bits).distinct())


def with_maybe(rows: DataFrame, key: str, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Add ``maybe``: false only for keys that are surely not in the filter.

    The filter is broadcast; :func:`filter_bits` bounds its size.
    """
    def bit(position: Column) -> Column:
        byte = F.substring(F.col("_bits"), F.shiftright(position, 3).cast("int") + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"),
                        position.bitwiseAND(F.lit(7)).cast("int"))

    first, second = _positions(F.col(key))
    side = bitmaps.select(F.col("block").alias("_block"), F.col("bitmap").alias("_bits"))
    return (
        rows.withColumn("_block", _block(F.col(key), bits // BLOCK_BITS))
        .join(F.broadcast(side), "_block", "left")
        .withColumn("maybe", F.coalesce((bit(first) == 1) & (bit(second) == 1), F.lit(False)))
        .drop("_block", "_bits"))


def filter_array(bitmaps: DataFrame, bits: int) -> np.ndarray:
    """A filter as bytes on the driver, for tasks in Python; ``bits`` bounds its size."""
    found = np.zeros((bits // BLOCK_BITS, BLOCK_BITS // 8), np.uint8)
    for row in bitmaps.toLocalIterator():
        found[row["block"]] = np.frombuffer(row["bitmap"], np.uint8)
    return found.ravel()


def maybe_in(filter_bytes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which 64-bit keys may be in a filter, as :func:`with_maybe` says it."""
    keys = keys.view(np.uint64)
    base = ((keys >> np.uint64(34)) & np.uint64(len(filter_bytes) // (BLOCK_BITS // 8) - 1)) * np.uint64(BLOCK_BITS)
    found = np.ones(len(keys), dtype=bool)
    for shift in (0, 15):
        place = base + ((keys >> np.uint64(shift)) & np.uint64(BLOCK_BITS - 1))
        found &= (filter_bytes[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def without(docs: DataFrame, gone: DataFrame, doc_id: str) -> DataFrame:
    """The documents whose id is not among those of the one-column table ``gone``.

    All columns stay. A filter, bounded in size, lets most documents stay where they are;
    only those that may have to go are shuffled. Null ids stay.
    """
    gone = stored(gone.toDF("_gone").filter("_gone IS NOT NULL").distinct(), "gone")
    ident = F.col(f"row.{doc_id}").cast("bigint")
    marked = marked_among(packed(docs).withColumn("key", F.xxhash64(ident)), "key", gone.select(
        F.xxhash64("_gone").alias("key")))
    rest = marked.filter("maybe").join(gone, ident == F.col("_gone"), "left_anti")
    return marked.filter(~F.col("maybe")).select("row.*").unionByName(rest.select("row.*"))


def marked_among(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Add ``maybe``: whether a row's 64-bit key may be in the one-column table ``keys``."""
    keys = stored(keys.distinct(), "keys")
    bits = filter_bits(keys.count(), FILTER_BITS)
    return with_maybe(rows, key, stored(member_filter(keys, keys.columns[0], bits), "member-filter"), bits)


def among(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is in the table ``keys`` or, rarely, seems to be; nothing is shuffled."""
    return marked_among(rows, key, keys).filter("maybe").drop("maybe")
