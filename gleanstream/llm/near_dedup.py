"""MinHash near-dedup with odd sketches.

A document's set holds its distinct five-word shingles. Texts of the same words are one class
first, so that groups of copies never meet as pairs. MinHash samples of each class are folded into an
odd sketch (a parity bitmap) and hashed into bands. Documents that share a band are
candidates; the population count of two sketches' XOR estimates the similarity and throws
out the dissimilar, and what is left is confirmed on the full sets of the whole texts, word by
word.

Candidates are taken in two rounds, joining components after each: first every member of a
band bucket against the bucket's smallest document, and in one bucket of eight against
another drawn by hash; then all pairs of a bucket that still lie in different components,
compared block by block through their sketches. So a large group of near copies costs its
members a few times over, and no pair that shares a band is passed over.

In the second round the documents of the buckets that are left get sketches of many more
samples, for their pairs are mostly just dissimilar. With 32 bands of 6 samples a pair at
similarity 0.85 shares no band with probability 3e-7; its sketches throw it out with about
the same.

Nulls and texts without words have empty sets and are linked with nothing; null doc_ids are
never linked. Rows that share a doc_id are one document with the links of all its texts.
An empty table gives an empty result. Other columns are let through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import tables, words
from gleanstream.llm.components import connected_components

#: Words of a shingle.
SHINGLE = 5
#: Documents of a block, and partners that share one copy of a text.
BLOCK = 256
#: One bucket of so many has a second centre, in case the first is unlike the others.
DRAWN = 8
_SKETCH_SCHEMA = (
    "doc_id bigint, n_shingles bigint, set_key binary, sketch array<bigint>, bands array<bigint>")


@dataclass(frozen=True)
class Plan:
    """Parameters of one odd sketch, and of the bands for which its samples are used.

    ``percent`` is the least similarity, ``slack`` what an estimate may lack of it: five
    standard deviations of an estimate at that similarity, ``fine_slack`` the same for
    :meth:`finer`. The defaults are for similarity 0.85.
    """

    percent: int = 85
    samples: int = 192
    sketch_bits: int = 512
    slack: float = 0.16
    bands: int = 32
    fine_slack: float = 0.067

    @property
    def most_odd_bits(self) -> int:
        """XOR count at which the odd sketch estimate is ``slack`` below the threshold.

        Samples that differ toggle two bits, so with k samples and n bits the expected count
        is n/2 (1 - exp(-4k(1 - J)/n)).
        """
        apart = 1 - self.percent / 100 + self.slack
        full = 1 - np.exp(-4 * self.samples * apart / self.sketch_bits)
        return int(self.sketch_bits / 2 * full)

    def finer(self) -> Plan:
        """For the few documents whose buckets stay open: more samples, less slack."""
        return replace(self, samples=1024, sketch_bits=2048, slack=self.fine_slack)


def exact_sets(texts: list[str | None]) -> Iterator[frozenset]:
    """The set of each text as tuples of words, for what must not rest on hashes."""
    for text in texts:
        own = words.split(text, words.SPACED)
        if len(own) >= SHINGLE:
            yield frozenset(zip(*(own[step:] for step in range(SHINGLE))))
        else:
            yield frozenset([tuple(own)] if own else [])


def shingle_sets(texts: list[str | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Blocks of texts as (first text, distinct shingle hashes of each, sorted)."""
    for first, hashes, bounds in words.hashed_words(texts, words.SPACED):
        runs = words.run_hashes(hashes, SHINGLE)
        sets = []
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            if end - start >= SHINGLE:
                sets.append(np.unique(runs[start:end - SHINGLE + 1]))
            else:
                sets.append(words.run_hashes(hashes[start:end], max(int(end - start), 1)))
        yield first, sets


def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and masks of the hash functions, from a fixed rule."""
    seeds = words.mixed(np.arange(1, 2 * count + 1, dtype=np.uint64))
    return seeds[:count] | np.uint64(1), seeds[count:]


def minhashes(sets: list[np.ndarray], samples: int) -> np.ndarray:
    """One row of samples for each set; sets must not be empty."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *(len(one) for one in sets[:-1])])
    multipliers, masks = _constants(samples)
    found = np.empty((samples, len(sets)), dtype=np.uint64)
    scratch = np.empty_like(values)
    for i in range(samples):
        np.bitwise_xor(values, masks[i], out=scratch)
        np.multiply(scratch, multipliers[i], out=scratch)
        found[i] = np.minimum.reduceat(scratch, starts)
    return found.T


def odd_sketches(samples: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps of samples, as int64 words."""
    rows, count = samples.shape
    salted = words.mixed(samples + np.arange(count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    places = (salted % np.uint64(bits)).astype(np.int64) + np.arange(rows)[:, None] * bits
    odd = np.bincount(places.ravel(), minlength=rows * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(rows, bits), axis=1).view(np.int64)


def band_keys(samples: np.ndarray, plan: Plan) -> np.ndarray:
    rows = plan.samples // plan.bands
    grouped = samples.reshape(len(samples), plan.bands, rows)
    keys = np.tile(np.arange(1, plan.bands + 1, dtype=np.uint64), (len(samples), 1))
    for i in range(rows):
        keys = words.mixed(keys ^ grouped[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
    return keys.view(np.int64)


def _text_key(text: str | None) -> bytes:
    """Digest of the sequence of words: texts of one key have one set, beyond any doubt."""
    return sha256(b" ".join(words.split(text, words.SPACED))).digest()


def _sketched(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.slices(batches):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, sets in shingle_sets(texts):
                sizes = [len(one) for one in sets]
                full = [one for one in sets if len(one)]
                keys: list = [None] * len(sets)
                sketches, bands = list(keys), list(keys)
                if full:
                    samples = minhashes(full, plan.samples)
                    rows = zip(odd_sketches(samples, plan.sketch_bits), band_keys(samples, plan),
                               strict=True)
                    for place in np.flatnonzero(sizes):
                        keys[place] = _text_key(texts[first + place])
                        sketches[place], bands[place] = next(rows)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, len(sets)), pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()), pa.array(sketches, pa.list_(pa.int64())),
                    pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_key", "sketch", "bands"])
    return run


def _finely_sketched(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.slices(batches):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, sets in shingle_sets(texts):
                places = [first + place for place, one in enumerate(sets) if len(one)]
                full = [one for one in sets if len(one)]
                if full:
                    sketches = odd_sketches(minhashes(full, plan.samples), plan.sketch_bits)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(places)), pa.array([len(one) for one in full], pa.int64()),
                        pa.array(list(sketches), pa.list_(pa.int64()))],
                        ["rep", "n_shingles", "sketch"])
    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.slices(batches):
            lefts = exact_sets(batch.column("text_a").to_pylist())
            met: dict[str, frozenset] = {}  # the text that many pairs share
            keep = []
            for left, text in zip(lefts, batch.column("text_b").to_pylist(), strict=True):
                if text not in met:
                    met = {text: next(exact_sets([text]))}
                right = met[text]
                both = len(left & right)
                keep.append(both > 0 and 100 * both >= percent * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents that may be among the ids; a filter of bounded size, and no shuffle."""
    return tables.among(
        docs.withColumn("key", F.xxhash64("doc_id")), "key",
        ids.select(F.xxhash64("doc_id").alias("key"))).select("doc_id", "text")


def _confirmed(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar.

    Only texts that take part are shuffled. A text with many
    partners is sent once for every BLOCK of them, so no task gets all its pairs.
    """
    texts = _texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    degrees = tables.stored(pairs.groupBy("b").count(), "degrees")
    shares = F.ceil(F.col("count") / BLOCK).cast("int")
    dealt = tables.attach(pairs, degrees, "b", "count").select(
        "a", "b", F.pmod(F.xxhash64("a"), shares).cast("int").alias("share"))
    left = dealt.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    right = texts.join(degrees, F.col("doc_id") == F.col("b")).select(
        "b", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"),
        F.col("text").alias("text_b"))
    met = left.join(right, ["b", "share"]).select("a", "b", "text_a", "text_b")
    return met.mapInArrow(_similar(percent), "a bigint, b bigint").distinct()


def _could_be_similar(plan: Plan, sketch_a: Column, sketch_b: Column, n_a: Column, n_b: Column):
    odd = F.aggregate(
        F.zip_with(sketch_a, sketch_b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0),
        lambda total, one: total + one)
    return (100 * F.least(n_a, n_b) >= plan.percent * F.greatest(n_a, n_b)) & (
        odd <= plan.most_odd_bits)


def _sketch_filtered(pairs: DataFrame, sketches: DataFrame, plan: Plan) -> DataFrame:
    """Distinct pairs that sizes and odd sketches let pass."""
    pairs = tables.stored(pairs.distinct(), "pairs")
    side = sketches.select(
        F.col("rep").alias("b"), F.col("sketch").alias("sketch_b"), F.col("n_shingles").alias("n_b"))
    ends = tables.stored(pairs.groupBy("b").count().join(side, "b"), "pair-ends")
    left = sketches.select(F.col("rep").alias("a"), "sketch", "n_shingles")
    placed = tables.attach(pairs, ends, "b", "count").join(left, "a")
    return placed.filter(_could_be_similar(
        plan, F.col("sketch"), F.col("sketch_b"), F.col("n_shingles"), F.col("n_b"))
    ).select("a", "b")


def _star(members: DataFrame, drawn: bool) -> DataFrame:
    """Pairs of each bucket's members with its centre: the smallest, or one drawn by hash."""
    order = F.xxhash64("rep", "key") if drawn else F.col("rep")
    centres = tables.stored(members.groupBy("key").agg(
        F.count("*").alias("size"),
        F.min(F.struct(order.alias("order"), "rep"))["rep"].alias("centre")), "centres")
    joined = tables.attach(members.select("key", "rep"), centres, "key", "size")
    return joined.filter(F.col("rep") != F.col("centre")).select(
        F.greatest("rep", "centre").alias("a"), F.least("rep", "centre").alias("b"))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that lie in more than one component, with their labels."""
    placed = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("label", "rep").alias("label"))
    placed = tables.stored(placed, "labelled")
    mixed = placed.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    mixed = tables.stored(mixed, "buckets")
    return tables.attach(placed, mixed, "key", "size").filter("low < high").select(
        "key", "rep", "label", "size")


def _compared(plan: Plan):
    """Similar pairs of the groups (key, i, j), which come one after another."""
    columns = ("key", "i", "j", "own", "rep", "label", "n_shingles")

    def pairs_of(rows: dict[str, np.ndarray], keys: list) -> Iterator[tuple[int, int]]:
        left = np.flatnonzero(rows["own"] == rows["i"])
        right = np.flatnonzero(rows["own"] == rows["j"])
        low = np.minimum.outer(rows["n_shingles"][left], rows["n_shingles"][right])
        high = np.maximum.outer(rows["n_shingles"][left], rows["n_shingles"][right])
        maybe = (100 * low >= plan.percent * high) & (
            rows["label"][left][:, None] != rows["label"][right])
        at, to = np.nonzero(maybe)
        sketches = rows["sketch"]
        for start in range(0, len(at), 4096):
            a, b = left[at[start:start + 4096]], right[to[start:start + 4096]]
            odd = np.bitwise_count(sketches[a] ^ sketches[b]).sum(axis=1, dtype=np.int64)
            for x, y in zip(a[odd <= plan.most_odd_bits], b[odd <= plan.most_odd_bits], strict=True):
                # a pair counts in the first of the buckets that it shares
                if rows["rep"][y] < rows["rep"][x] and min(keys[x] & keys[y]) == rows["key"][0]:
                    yield int(rows["rep"][x]), int(rows["rep"][y])

    def both_ways(rows: dict[str, np.ndarray], keys: list) -> set[tuple[int, int]]:
        found = set(pairs_of(rows, keys))
        if rows["i"][0] != rows["j"][0]:
            found.update(pairs_of(rows | {"i": rows["j"], "j": rows["i"]}, keys))
        return found

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Whole groups; a group has two blocks at most, however many rows a bucket has."""
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            if not table.num_rows:
                continue
            marks = np.stack([table[name].to_numpy() for name in ("key", "i", "j")])
            starts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            cuts = [0, *starts.tolist()]
            for start, end in zip(cuts, cuts[1:]):
                yield table.slice(start, end - start)
            rest = table.slice(cuts[-1])
        if rest is not None and rest.num_rows:
            yield rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in groups(tables.slices(batches, 2000)):
            if group.num_rows > 1:
                rows = {name: group[name].to_numpy() for name in columns}
                flat = group["sketch"].combine_chunks().flatten().to_numpy()
                rows["sketch"] = flat.reshape(group.num_rows, -1).view(np.uint64)
                found += both_ways(rows, [set(one) for one in group["keys"].to_pylist()])
            if len(found) > 10_000:
                yield _pair_batch(found)
                found = []
        yield _pair_batch(found)
    return run


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = [[pair[side] for pair in pairs] for side in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()) for one in both], ["a", "b"])


def _blocks(members: DataFrame, sketches: DataFrame, plan: Plan) -> DataFrame:
    """Pairs of different components within a bucket that their sketches hold to be similar.

    A bucket is dealt into blocks, and each pair of blocks is compared on its own; only
    similar pairs come out, each in the first of the buckets that it shares.
    """
    count = F.ceil(F.col("size") / BLOCK).cast("int")
    keys = members.groupBy("rep").agg(F.collect_set("key").alias("keys"))  # one a band at most
    dealt = members.join(keys, "rep").join(sketches, "rep").select(
        "key", "keys", "rep", "label", "n_shingles", "sketch",
        F.pmod(F.xxhash64("rep"), count).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), count - 1)).alias("other"))
    met = dealt.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "rep", "label", "n_shingles", "sketch", "keys")
    ordered = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return tables.stored(
        ordered.mapInArrow(_compared(plan), "a bigint, b bigint").distinct(), "pairs")


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                plan: Plan = Plan()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    tables.prepare(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = tables.stored(docs.mapInArrow(_sketched(plan), _SKETCH_SCHEMA), "sketches")
    linkable = rows.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")

    classes = tables.stored(linkable.groupBy("set_key").agg(
        F.count("*").alias("size"), F.min("doc_id").alias("rep")), "classes")
    known = classes.select("set_key", "rep")
    reps = linkable.withColumnRenamed("doc_id", "rep").join(known, ["set_key", "rep"])
    sketches = tables.stored(
        reps.select("rep", "n_shingles", "sketch", "bands").dropDuplicates(["rep", "n_shingles", "sketch"]),
        "class-sketches")
    banded = sketches.select("rep", F.explode("bands").alias("key")).distinct()
    sketches = sketches.drop("bands")
    buckets = tables.stored(
        banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    members = tables.stored(
        tables.attach(banded, buckets, "key", "size").filter("size IS NOT NULL").select("key", "rep"),
        "bucket-members")

    # a document with several texts links their classes; there are few, if any
    several = linkable.groupBy("doc_id").agg(
        F.min("set_key").alias("low"), F.max("set_key").alias("high"), F.count("*").alias("size")).filter(
        "low < high").select("doc_id", "size")
    owned = tables.attach(linkable.select("doc_id", "set_key"), tables.stored(several, "several-texts"),
                          "doc_id", "size").filter("size IS NOT NULL").select("doc_id", "set_key").distinct()
    links = owned.join(known, "set_key").filter("doc_id <> rep").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")).join(
        known.select(F.col("rep").alias("a")), "a", "left_semi").distinct()
    drawn = members.filter(F.pmod(F.col("key"), F.lit(DRAWN)) == 0)
    near = _star(members, drawn=False).unionByName(_star(drawn, drawn=True))
    links = tables.stored(links.unionByName(_confirmed(docs, tables.stored(
        _sketch_filtered(near, sketches, plan), "candidates"), plan.percent)), "links")
    labels = connected_components(links)

    left_over = tables.stored(_open(members, labels), "open-members")
    if not left_over.isEmpty():
        fine = plan.finer()
        sketches = tables.stored(_texts(docs, left_over.select(
            F.col("rep").alias("doc_id"))).mapInArrow(
            _finely_sketched(fine), "rep bigint, n_shingles bigint, sketch array<bigint>"),
            "fine-sketches")
        pairs = _blocks(left_over, sketches, fine)
        if not pairs.isEmpty():
            links = tables.stored(
                links.unionByName(_confirmed(docs, pairs, plan.percent)), "links")
            labels = connected_components(links)

    placed = classes.join(labels, F.col("rep") == F.col("node"), "left").select(
        "set_key", "size", F.coalesce("label", "rep").alias("component_id"))
    placed = tables.stored(placed, "class-components")
    linked = tables.attach(linkable.select("doc_id", "n_shingles", "set_key"), placed, "set_key", "size")
    alone = rows.filter("set_key IS NULL OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n_shingles", "component_id").unionByName(alone).select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     plan: Plan = Plan()) -> DataFrame:
    """One document of each group, with all its columns; only what may go is shuffled."""
    verdicts = near_groups(docs, text, doc_id, plan)
    return tables.without(docs, verdicts.filter("NOT kept").select("doc_id"), doc_id)
