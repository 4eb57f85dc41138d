"""Cross-tokenizer alignment by diagonal run skipping.

A text, with a blank before it, is encoded by a byte-level BPE (A) and by a piece BPE (B). Offsets at
which a token of each ends cut both into groups that cover the same bytes. Where the tokens go
one to one, the ends of both lie on a diagonal: the same numbers at a constant shift of index. From a
common border on, growing slices of the two end arrays are compared at that shift and jumped over
while they are equal; a slice that is not equal is halved, and the last few tokens before the first
difference are compared one by one. The irregular group there is resolved token by token, which gives the next shift.

The links of a group are all its pairs of an A and a B token. Over the corpus, a pair of ids counts
the documents that hold it linked. A document keeps its distinct pairs, and how often it has each.
Pairs that make up more than 1/FREQUENT of all (document, pair) entries are fewer than FREQUENT: a table
of them of bounded size goes to all tasks. Entries of other pairs are shuffled to the counts; none of
those pairs has many.

Null and empty texts, and texts whose A or B bytes are not those of the blank and the text, have no
tokens: all numbers are zero, ``groups`` is null, and they count for no pair. Each row counts as a
document of its own, also rows that repeat or share an id. Ties for the highest count all are best.
Texts of any length are aligned whole, in memory linear in their tokens; a group of many tokens a
side is counted by distinct ids. An empty table gives an empty result. All other columns are let
through, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleanstream.llm import tables

#: Pairs with more than this share of all entries go to the tasks; there are fewer of them.
FREQUENT = 1 << 19
#: Group of more pairs than this are counted by distinct ids.
DENSE = 4096
#: Tokens that are compared at once at the begin of a diagonal run.
FIRST_SLICE = 8

# Fixed value: the pattern by which the byte-level tokenizer splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes.

    Printable Latin-1 characters stand for themselves, all others for characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


def joined(parts: pa.Array, numbers: np.ndarray) -> bytes:
    """Some of the binary ``parts`` in a row; Arrow lays them out side by side."""
    taken = parts.take(pa.array(numbers))
    _, offsets, data = taken.buffers()
    return data[:int(np.frombuffer(offsets, np.int64)[len(taken)])].to_pybytes() if len(taken) else b""


class BytePairs:
    """Tokenizer A: ids of a text, special tokens being plain text, and the bytes of each id."""

    def __init__(self, config: str):
        model = json.loads(config)["model"]
        alphabet = byte_alphabet()
        self.bytes = {token: number for token, number in (
            (bytes(alphabet[char] for char in token), number)
            for token, number in model["vocab"].items() if all(char in alphabet for char in token))}
        special = {one["id"] for one in json.loads(config)["added_tokens"]}
        self.bytes = {token: number for token, number in self.bytes.items() if number not in special}
        first = len(self.bytes) - len(model["merges"])
        for place, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if model["vocab"][left + right] != first + place:
                raise ValueError("the ids of the vocabulary are not in the order of its merges")
        self.size = max(model["vocab"].values()) + 1
        self.coder = tiktoken.Encoding(
            "a", pat_str=PATTERN, mergeable_ranks=self.bytes, special_tokens={})
        self.lengths = np.zeros(self.size, np.int64)
        for token, number in self.bytes.items():
            self.lengths[number] = len(token)

    def encode(self, text: str) -> np.ndarray:
        """Ids; the pattern covers every character, so bytes are lost only if their number falls."""
        return np.array(self.coder.encode_ordinary(text), np.int64)


class Pieces:
    """Tokenizer B: ids of a text, which it puts a blank before, and the bytes of each id."""

    def __init__(self, model: bytes):
        self.coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.coder.get_piece_size()
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if self.coder.is_byte(number)
            else piece.replace("▁", " ").encode()
            for number, piece in enumerate(map(self.coder.id_to_piece, range(self.size)))]
        self.lengths = np.array([len(one) for one in self.bytes], np.int64)
        self.pieces = pa.array(self.bytes, pa.large_binary())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.coder.encode(texts, num_threads=1)

    def decode(self, ids: np.ndarray) -> bytes:
        return joined(self.pieces, ids)


def cut(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B lie before the end of each group; both must end alike."""
    count = len(ends_a)
    ends_a, ends_b = [*ends_a, -1], [*ends_b, -2]  # no slice beyond the end is equal
    starts_a: list[int] = []  # of the runs of groups of one token a side; between two is one other group
    starts_b: list[int] = []
    runs: list[int] = []
    i = j = 0
    while True:
        starts_a.append(i)
        starts_b.append(j)
        start, probe = i, FIRST_SLICE
        while ends_a[i:i + probe] == ends_b[j:j + probe]:
            i, j, probe = i + probe, j + probe, 2 * probe
        while probe > FIRST_SLICE:
            probe //= 2
            if ends_a[i:i + probe] == ends_b[j:j + probe]:
                i, j = i + probe, j + probe
        a, b = ends_a[i], ends_b[j]
        while a == b:  # a few tokens before the first difference
            i, j = i + 1, j + 1
            a, b = ends_a[i], ends_b[j]
        runs.append(i - start)
        if i == count:
            break
        while a != b:
            if a < b:
                i += 1
                a = ends_a[i]
            else:
                j += 1
                b = ends_b[j]
        i, j = i + 1, j + 1
    lengths = np.array(runs, np.int64) + 1
    lengths[-1] -= 1
    ends = np.cumsum(lengths)
    within = np.arange(1, ends[-1] + 1) - np.repeat(ends - lengths, lengths)
    cuts = []
    for starts in (starts_a, starts_b):
        first = np.array(starts, np.int64)
        cut_at = np.repeat(first, lengths) + within
        cut_at[ends[:-1] - 1] = first[1:]
        cuts.append(cut_at)
    return cuts[0], cuts[1]


def linked_pairs(ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray,
                 base: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked pairs as a * base + b, in order, and how often each occurs."""
    first_a, first_b = np.append(0, cuts_a[:-1]), np.append(0, cuts_b[:-1])
    size_a, size_b = cuts_a - first_a, cuts_b - first_b
    pairs = size_a * size_b
    small = pairs <= DENSE
    many = pairs[small]
    group = np.repeat(np.flatnonzero(small), many)
    step = np.arange(len(group)) - np.repeat(np.cumsum(many) - many, many)
    codes = [ids_a[first_a[group] + step // size_b[group]] * base + ids_b[
        first_b[group] + step % size_b[group]]]
    times = [np.ones(len(group), np.int64)]
    for place in np.flatnonzero(~small).tolist():
        a, n = np.unique(ids_a[first_a[place]:cuts_a[place]], return_counts=True)
        b, m = np.unique(ids_b[first_b[place]:cuts_b[place]], return_counts=True)
        codes.append((a[:, None] * base + b).ravel())
        times.append((n[:, None] * m).ravel())
    found, which = np.unique(np.concatenate(codes), return_inverse=True)
    if len(times) == 1:
        return found, np.bincount(which, minlength=len(found))
    counts = np.zeros(len(found), np.int64)
    np.add.at(counts, which, np.concatenate(times))
    return found, counts


class Aligner:
    """Both tokenizers, and the text of each id within a group and at the end of its side."""

    def __init__(self, config: str, model: bytes):
        self.a, self.b = BytePairs(config), Pieces(model)
        self.texts = pa.array(
            [f"{number}{sign}".encode() for size, signs in ((self.a.size, ",|"), (self.b.size, ",;"))
             for sign in signs for number in range(size)], pa.large_binary())

    def listed(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = (np.zeros(len(one), dtype=bool) for one in (a, b))
        last_a[cuts_a - 1] = last_b[cuts_b - 1] = True
        # a token of A comes after the B tokens of earlier groups, one of B after all A tokens so far
        before = np.append(0, cuts_b[:-1])[np.cumsum(last_a) - last_a]
        after = cuts_a[np.cumsum(last_b) - last_b]
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before] = a + last_a * self.a.size
        order[np.arange(len(b)) + after] = 2 * self.a.size + b + last_b * self.b.size
        return joined(self.texts, order)[:-1].decode()

    def align(self, texts: list[str | None]) -> Iterator[tuple | None]:
        """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text that has tokens."""
        given = [text or "" for text in texts]
        for text, ids_b in zip(given, self.b.encode(given), strict=True):
            data = b" " + text.encode("utf-8")
            a = self.a.encode(" " + text)
            ends_a = np.cumsum(self.a.lengths[a])
            b = np.array(ids_b, np.int64)
            if not text or ends_a[-1] != len(data) or self.b.decode(b) != data:
                yield None
                continue
            cuts_a, cuts_b = cut(ends_a.tolist(), np.cumsum(self.b.lengths[b]).tolist())
            pairs, times = linked_pairs(a, b, cuts_a, cuts_b, self.b.size)
            yield (len(a), len(b), len(cuts_a), int(times.sum()),
                   self.listed(a, b, cuts_a, cuts_b), pairs, times)


_aligners: dict[str, Aligner] = {}


def _aligner(config: str, model: bytes) -> Aligner:
    """One aligner a worker process, kept from task to task."""
    key = hashlib.sha256(config.encode() + model).hexdigest()
    if key not in _aligners:
        _aligners[key] = Aligner(config, model)
    return _aligners[key]


_FIELDS = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
           "pairs array<bigint>, times array<bigint>")


def aligned(docs: DataFrame, config_path: str, model_path: str, text: str = "text") -> DataFrame:
    """``row`` (the document as given), n_a, n_b, n_groups, n_links, groups, pairs, times.

    ``groups`` is text, ``a1,a2|b1;a3|b2,b3``; ``pairs`` has a * (size of B's vocabulary) + b of each
    distinct linked pair, in order, and ``times`` how often it occurs. The driver reads the tokenizer
    files and broadcasts them (a few MB), so the executors need none.
    """
    with open(config_path, encoding="utf-8") as file:
        config = file.read()
    with open(model_path, "rb") as file:
        model = file.read()
    BytePairs(config)  # a vocabulary that does not fit is refused here
    files = docs.sparkSession.sparkContext.broadcast((config, model))

    def run(texts: pa.Array) -> pa.Array:
        rows = [one or (0, 0, 0, 0, None, [], [])
                for one in _aligner(*files.value).align(texts.to_pylist())]
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2
        names = [field.split()[0] for field in _FIELDS.split(", ")]
        return pa.StructArray.from_arrays(
            [pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)], names)

    return tables.with_result(tables.packed(docs), run, _FIELDS, F.col("row")[text])


def pair_counts(rows: DataFrame, base: int) -> DataFrame:
    """(pair, n, best): documents that hold the pair, and whether no other of its A id has more.

    Entries are added up before they are shuffled; an A id has no more pairs than B has ids.
    """
    counted = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    highest = F.max("n").over(W.partitionBy(F.expr(f"pair DIV {base}")))
    return counted.withColumn("best", F.col("n") == highest)


def _looked_up(frequent):
    """Sums over the frequent pairs, and the others as they are."""
    def run(pairs: pa.Array, times: pa.Array) -> pa.Array:
        known, counts, best = frequent.value
        bounds = pairs.offsets.to_numpy() - pairs.offsets[0].as_py()
        codes = pairs.flatten().to_numpy(zero_copy_only=False)
        n = times.flatten().to_numpy(zero_copy_only=False)
        at = np.searchsorted(known, codes)
        at[at == len(known)] = 0
        found = known[at] == codes if len(known) else np.zeros(len(codes), dtype=bool)
        owner = np.repeat(np.arange(len(pairs)), np.diff(bounds))
        sums = np.zeros(len(pairs), np.int64)
        bests = np.zeros(len(pairs), np.int64)
        if len(known):
            np.add.at(sums, owner[found], (n * counts[at])[found])
            np.add.at(bests, owner[found], (n * best[at])[found])
        rest = np.concatenate([[0], np.cumsum(~found)])[bounds].astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(rest, pa.int32()), pa.array(one[~found], pa.int64()))
                 for one in (codes, n)]
        return pa.StructArray.from_arrays(
            [pa.array(bests), pa.array(sums), *lists], ["_best", "_sum", "_rare", "_times"])
    return run


def with_corpus_counts(rows: DataFrame, base: int, frequent: int = FREQUENT) -> DataFrame:
    """Add n_best and count_sum to a table with ``pairs`` and ``times``, which go.

    ``base`` is the size of B's vocabulary. The table is stored, for it is used several times.
    """
    spark = rows.sparkSession
    others = [name for name in rows.columns if name not in ("pairs", "times")]
    rows = tables.stored(rows.select(
        F.struct(*others).alias("kept"), F.monotonically_increasing_id().alias("place"),
        "pairs", "times"), "aligned")
    counts = tables.stored(pair_counts(rows, base), "pair-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.filter(F.col("n") * frequent > total).toArrow().sort_by("pair")
    table = spark.sparkContext.broadcast((
        often["pair"].to_numpy(), often["n"].to_numpy(), often["best"].to_numpy().astype(np.int64)))
    scored = tables.stored(tables.with_result(
        rows, _looked_up(table), "_best bigint, _sum bigint, _rare array<bigint>, _times array<bigint>",
        "pairs", "times").drop("pairs", "times"), "aligned-scored")
    rare = scored.select("place", F.explode(F.arrays_zip("_rare", "_times")).alias("one")).select(
        "place", F.col("one._rare").alias("pair"), F.col("one._times").alias("times"))
    added = rare.join(counts, "pair").groupBy("place").agg(
        F.sum(F.col("times") * F.col("best").cast("bigint")).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    return scored.drop("_rare", "_times").join(added, "place", "left").select(
        *(F.col("kept")[name].alias(name) for name in others),
        (F.col("_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def token_alignment(docs: DataFrame, config_path: str, model_path: str) -> DataFrame:
    """One row per document: doc_id, the counts, n_best, count_sum and groups_sha256."""
    base = sentencepiece.SentencePieceProcessor(model_file=model_path).get_piece_size()
    rows = aligned(docs.select("doc_id", "text"), config_path, model_path).select(
        F.col("row.doc_id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce(F.sha2("groups", 256), F.lit("")).alias("groups_sha256"), "pairs", "times")
    return with_corpus_counts(rows, base).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
