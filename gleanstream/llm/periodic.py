r"""Periodic run detection by descending LCP.

Words are ``[^\x20\x09-\x0D]+``, compared exactly. A run is a stretch of at least
``max(6, 4 q)`` words with smallest period q that no neighbouring word extends.

Suffixes of a text are sorted, and those next to each other are united in the order of
decreasing common prefix (LCP), as Kruskal's method takes edges. Every class keeps the positions
of its suffixes in order. Where a union makes two positions neighbours whose distance is small
enough against the LCP, the words between them repeat: that is the seed of a run. No position
of the class lies between them, so their distance is the smallest period; the LCP is exact, so
the run ends where it says; and a seed counts only if the words before its two positions
differ, so each run is found once, at its start.

A run's seed has an LCP of at least 5, so only suffixes whose first five words
occur again in the same text are sorted and united; in ordinary text these are few.

Nulls and empty texts have no words and no runs. A text of any length is one block, worked on in
memory linear in its words. Repeated rows and ties are judged row by row; an empty table gives an
empty result; all columns of the input are let through as ``row``, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import exact_words, tables

#: A run is so many words long at least, and so many times its period.
LEAST_LENGTH, LEAST_PERIODS = 6, 4
#: The least LCP that the seed of any run can have: what is left of the run without one period.
LEAST_LCP = min(max(LEAST_LENGTH, LEAST_PERIODS * q) - q for q in range(1, LEAST_LENGTH + 1))
#: Positions in one part of an ordered set.
PART = 512

Run = tuple[int, int, int]
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Positions:
    """An ordered set of positions, in parts so that adding one moves few others."""

    def __init__(self, position: int):
        self.parts = [[position]]
        self.firsts = [position]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for part in self.parts:
            yield from part

    def add(self, position: int) -> tuple[int, int]:
        """Put in a new position; the ones before and after it, or -1."""
        at = max(bisect_right(self.firsts, position) - 1, 0)
        part = self.parts[at]
        place = bisect_right(part, position)
        before = part[place - 1] if place else -1
        if place < len(part):
            after = part[place]
        else:
            after = self.firsts[at + 1] if at + 1 < len(self.parts) else -1
        part.insert(place, position)
        self.firsts[at] = part[0]
        self.size += 1
        if len(part) > PART:
            self.parts.insert(at + 1, part[PART // 2:])
            self.firsts.insert(at + 1, part[PART // 2])
            del part[PART // 2:]
        return before, after


def _ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs."""
    return np.unique(first * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1]


def window_ranks(codes: np.ndarray, width: int) -> np.ndarray:
    """Dense ranks of the windows of so many codes that begin at each place, in their order.

    Beyond the end there are zeros, which no code is.
    """
    ranks = np.concatenate([codes + 1, np.zeros(width, np.int64)])
    size, count = 1, len(codes)
    while size < width:
        step = min(size, width - size)
        ranks[:count] = _ranked(ranks[:count], ranks[step:step + count]) + 1
        size += step
    return ranks[:count]


def sorted_suffixes(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose first ``width`` codes occur again, by suffix; and which share them with the
    place before.

    By prefix doubling among those that are not told apart yet.
    """
    count = len(codes)
    _, inverse, sizes = np.unique(
        window_ranks(codes, width), return_inverse=True, return_counts=True)
    ranks = np.zeros(count + 1, np.int64)  # suffixes before the own class; 0 beyond the end
    ranks[:count] = (np.cumsum(sizes) - sizes)[inverse] + 1
    repeated = np.flatnonzero(sizes[inverse] > 1)
    classes = ranks[repeated].copy()
    live, reach = repeated, width
    while len(live):
        key = ranks[live] * (count + 1) + ranks[np.minimum(live + reach, count)]
        order = np.argsort(key, kind="stable")
        live, key = live[order], key[order]
        index = np.arange(len(live))
        old = key // (count + 1)
        new_class = np.append(True, key[1:] != key[:-1])
        old_class = np.append(True, old[1:] != old[:-1])
        of_new = np.maximum.accumulate(np.where(new_class, index, 0))
        of_old = np.maximum.accumulate(np.where(old_class, index, 0))
        ranks[live] = old + of_new - of_old
        alone = new_class & np.append(new_class[1:], True)
        live, reach = live[~alone], 2 * reach
    order = np.argsort(ranks[repeated], kind="stable")
    classes = classes[order]
    return repeated[order], np.append(False, classes[1:] == classes[:-1])


def common_prefixes(codes: list[int], order: np.ndarray, shares: np.ndarray, width: int) -> list[
        tuple[int, int, int]]:
    """(LCP, place, the place before it in suffix order), for those that share ``width`` codes.

    In order of places the LCP falls by one at most from step to step, so all comparisons
    together are linear.
    """
    before = dict(zip(order[1:][shares[1:]].tolist(), order[:-1][shares[1:]].tolist()))
    found = []
    length, last, end = 0, -2, len(codes)
    for place in sorted(before):
        other = before[place]
        length = max(length - 1, width) if place == last + 1 else width
        stop = end - max(place, other)
        while length < stop and codes[place + length] == codes[other + length]:
            length += 1
        found.append((length, place, other))
        last = place
    return found


def seeds(codes: np.ndarray) -> list[Run]:
    """Runs (start, length, period) of a sequence of codes, in no order."""
    order, shares = sorted_suffixes(codes, LEAST_LCP)
    if not len(order):
        return []
    plain = codes.tolist()
    edges = common_prefixes(plain, order, shares, LEAST_LCP)
    edges.sort(reverse=True)
    parent = {place: place for place in order.tolist()}
    classes: dict[int, Positions] = {}
    found: list[Run] = []

    def root(place: int) -> int:
        while parent[place] != place:
            parent[place] = place = parent[parent[place]]
        return place

    def seed(low: int, high: int, lcp: int) -> None:
        period = high - low
        length = lcp + period
        if length >= max(LEAST_LENGTH, LEAST_PERIODS * period) and (
                not low or plain[low - 1] != plain[high - 1]):
            found.append((low, length, period))

    for lcp, place, other in edges:
        left, right = root(place), root(other)
        large = classes.get(left) or Positions(left)
        small = classes.pop(right, None) or Positions(right)
        if large.size < small.size:
            left, right, large, small = right, left, small, large
        parent[right] = left
        classes.pop(right, None)
        classes[left] = large
        joining = list(small)
        previous = -1
        for position, upcoming in zip(joining, [*joining[1:], -1]):
            low, high = large.add(position)
            # those that both come from the small class were neighbours before
            if low >= 0 and low != previous:
                seed(low, position, lcp)
            if high >= 0 and (upcoming < 0 or high < upcoming):
                seed(position, high, lcp)
            previous = position
    return found


def runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """Runs of each of some texts, given as words, by start and period.

    Codes of one text are not used in another, so their suffixes never meet.
    """
    parts, used = [], 0
    for words in texts:
        codes = exact_words.coded(words)
        parts.append(codes + used)
        used += int(codes.max(initial=-1)) + 1
    bounds = np.cumsum([0, *map(len, parts)])
    found: list[list[Run]] = [[] for _ in texts]
    for start, length, period in seeds(np.concatenate(parts)) if used else []:
        owner = int(np.searchsorted(bounds, start, side="right")) - 1
        found[owner].append((start - int(bounds[owner]), length, period))
    for own in found:
        own.sort(key=lambda run: (run[0], run[2]))
    return found


def collapsed(words: list[bytes], own: list[Run]) -> bytes:
    """The words without those that lie in a run beyond its first period, joined by blanks."""
    if own:
        keep = np.ones(len(words), dtype=bool)
        for start, length, period in own:
            keep[start + period:start + length] = False
        words = [words[place] for place in np.flatnonzero(keep)]
    return b" ".join(words)


def _found(texts: pa.Array) -> pa.Array:
    counts, lists, kept = [], [], []
    for block in exact_words.blocks(texts.cast(pa.binary()).to_pylist()):
        split = [exact_words.split(text) for text in block]
        for words, own in zip(split, runs(split), strict=True):
            counts.append(len(words))
            lists.append([{"start": start, "length": length, "period": period}
                          for start, length, period in own])
            kept.append(collapsed(words, own).decode("utf-8"))
    one = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    return pa.StructArray.from_arrays(
        [pa.array(counts, pa.int64()), pa.array(lists, pa.list_(one)), pa.array(kept, pa.string())],
        ["n_words", "runs", "collapsed"])


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the document as given), n_words, runs (by start, then period), collapsed.

    Only the text goes to Python, and nothing is shuffled.
    """
    return tables.with_result(
        tables.packed(docs), _found, f"n_words bigint, runs {RUNS}, collapsed string", F.col("row")[text])


def with_planted_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with ``text``'s words repeated in some of them, by the digits of their id.

    With h the CRC-32 of the decimal id and g = h div 10: where h mod 10 is 0, word i from
    a = g mod n on is word a + (i - a) mod p, with p = 1 + (n - a) div (3 + g mod 8). Such a text
    becomes its words joined by blanks; others, and those without id or words, stay as they are.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    plan = docs.withColumn("_words", F.when(h % 10 == 0, words)).withColumn(
        "_g", F.floor(h / 10)).withColumn("_a", F.when(
            F.size("_words") > 0, F.col("_g") % F.size("_words"))).withColumn(
        "_p", 1 + F.floor((F.size("_words") - F.col("_a")) / (3 + F.col("_g") % 8)))
    repeated = F.expr("array_join(transform(sequence(0, size(_words) - 1), i -> _words["
                      "CAST(if(i < _a, i, _a + (i - _a) % _p) AS INT)]), ' ')")
    return plan.withColumn(text, F.when(F.col("_a").isNotNull(), repeated).otherwise(
        F.col(text))).drop("_words", "_g", "_a", "_p")


def run_digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its longest run, and digests of all runs and of the kept words."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS back, "
                  "-r.period AS short)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, "
                    "'\\n')), '')")
    return with_runs(docs.select(doc_id, text), text).withColumn("best", best).select(
        F.col("row")[doc_id].alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.short")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
