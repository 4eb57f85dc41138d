"""Quality classifier: a factorisation machine over words, structure and metadata.

A document's features are its hashed words, weighted so that each document's word vector has
length one, and one feature for the bin of each structure statistic (symbols, capitals,
repetition, line shape and so on) and of the metadata column ``n_chars``. The machine adds a
weight for each feature and a low-rank interaction for each pair; the pairs are summed in
linear time as half of (sum v x)^2 - sum (v x)^2.

It is fitted by AdaGrad on a bounded sample of labelled documents outside the held-out fold;
the driver holds the sample's features only. Null and empty texts have no words and the bins
of an empty text; a null n_chars has a bin of its own, as has a table without the column.
Without labels of both kinds the score is 0.5 for all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import samples, tables, words

#: Labelled documents that the machine is fitted on, at most, by label.
SAMPLE = {0: 5000, 1: 7000}
WORD_BUCKETS, BINS, FACTORS = 1 << 14, 16, 8
EPOCHS, RATE, RIDGE = 6, 0.08, 2e-5

# What counts as a sign, by byte.
_SIGNS = np.zeros(256, dtype=bool)
_SIGNS[list(b"#$%&*+/<=>@[\\]^_`{|}~!")] = True
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[list(b".,;:?'\"()-")] = True

#: Statistics and the largest value that bins tell apart; all are at least zero.
STATISTICS = {
    "log_chars": 12.0, "log_words": 10.0, "word_length": 16.0, "capitals": 0.5, "digits": 0.3,
    "signs": 0.3, "punctuation": 0.2, "bars": 0.2, "exclamations": 0.2, "other_bytes": 0.5,
    "distinct_words": 1.0, "top_word": 0.5, "repeated_next": 0.5, "log_lines": 7.0,
    "repeated_lines": 1.0, "line_length": 600.0, "short_lines": 1.0, "addresses": 0.1,
    "log_metadata": 12.0,
}


def statistics(text: str, hashes: np.ndarray, n_chars: int | None) -> list[float]:
    """Values in the order of STATISTICS; a missing n_chars is -1."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    counts = np.bincount(data, minlength=256)
    size, total = max(len(data), 1), max(len(hashes), 1)
    letters = max(int(counts[0x41:0x5B].sum() + counts[0x61:0x7B].sum()), 1)
    lines = [line.strip() for line in text.split("\n")]
    lines = [line for line in lines if line]
    _, repeats = np.unique(hashes, return_counts=True)
    return [
        np.log1p(len(text)), np.log1p(len(hashes)), len(text) / total,
        counts[0x41:0x5B].sum() / letters, counts[0x30:0x3A].sum() / size,
        counts[_SIGNS].sum() / size, counts[_PLAIN].sum() / size, counts[0x7C] / size,
        counts[0x21] / size, counts[0x80:].sum() / size,
        len(repeats) / total, repeats.max(initial=0) / total,
        float((hashes[1:] == hashes[:-1]).sum()) / total, np.log1p(len(lines)),
        1 - len(set(lines)) / max(len(lines), 1), len(text) / max(len(lines), 1),
        sum(len(line) < 30 for line in lines) / max(len(lines), 1),
        (text.count("http") + text.count("www.") + text.count("@")) / total,
        -1.0 if n_chars is None or n_chars < 0 else np.log1p(n_chars),
    ]


_TOPS = np.array(list(STATISTICS.values()))
SIZE = WORD_BUCKETS + BINS * len(STATISTICS)


def features(texts: list[str | None], n_chars: list[int | None]) -> list[
        tuple[np.ndarray, np.ndarray]]:
    """Indices and values of each document's features."""
    found = []
    for first, hashes, bounds in words.hashed_words(texts, words.SPACED):
        for at in range(len(bounds) - 1):
            own = hashes[bounds[at]:bounds[at + 1]]
            stats = np.array(statistics(texts[first + at] or "", own, n_chars[first + at]))
            # square roots tell small values apart; bin 0 is for what is missing
            scaled = np.sqrt(np.clip(stats / _TOPS, 0, 1)) * (BINS - 2)
            bins = np.where(stats < 0, 0, 1 + scaled.astype(np.int64))
            buckets, counts = np.unique(own % np.uint64(WORD_BUCKETS), return_counts=True)
            values = np.sqrt(counts)
            values /= max(np.sqrt((values ** 2).sum()), 1e-9)
            found.append((
                np.concatenate([buckets.astype(np.int64),
                                WORD_BUCKETS + BINS * np.arange(len(STATISTICS)) + bins]),
                np.concatenate([values, np.full(len(STATISTICS), 0.5)])))
    return found


@dataclass
class Machine:
    constant: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, indices: np.ndarray, values: np.ndarray) -> float:
        scaled = self.factors[indices] * values[:, None]
        pairs = 0.5 * ((scaled.sum(axis=0) ** 2).sum() - (scaled ** 2).sum())
        return float(self.constant + self.weights[indices] @ values + pairs)

    def score(self, indices: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(indices, values), -35, 35))))


def trained(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray,
            weights: np.ndarray) -> Machine:
    """AdaGrad over the sample, in an order and from a start that are fixed."""
    random = np.random.default_rng(7)
    machine = Machine(0.0, np.zeros(SIZE), random.normal(0, 0.02, (SIZE, FACTORS)))
    if not len(rows) or len(set(labels.tolist())) < 2:
        return machine
    weights = weights / weights.mean()
    share = (weights * labels).sum() / weights.sum()
    machine.constant = float(np.log(share / (1 - share)))
    seen, seen_factors = np.full(SIZE, 1e-2), np.full((SIZE, FACTORS), 1e-2)
    for _ in range(EPOCHS):
        for place in random.permutation(len(rows)):
            indices, values = rows[place]
            error = weights[place] * (machine.score(indices, values) - labels[place])
            own = machine.factors[indices]
            scaled = own * values[:, None]
            slope = error * values + RIDGE * machine.weights[indices]
            slopes = error * values[:, None] * (scaled.sum(axis=0) - scaled) + RIDGE * own
            seen[indices] += slope ** 2
            seen_factors[indices] += slopes ** 2
            machine.weights[indices] -= RATE * slope / np.sqrt(seen[indices])
            machine.factors[indices] -= 0.5 * RATE * slopes / np.sqrt(seen_factors[indices])
            machine.constant -= 0.01 * error
    return machine


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tables.slices(batches):
        rows = features(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist())
        yield pa.RecordBatch.from_arrays([
            batch.column("label"), batch.column("weight"),
            pa.array([indices.astype(np.int32).tobytes() for indices, _ in rows], pa.binary()),
            pa.array([values.astype(np.float32).tobytes() for _, values in rows], pa.binary())],
            ["label", "weight", "indices", "values"])


def _with_size(docs: DataFrame) -> DataFrame:
    size = F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return docs.withColumn("n_chars", size)


def fit(docs: DataFrame, labels: DataFrame, most: dict[int, int] | None = None,
        modulus: int = 4, fold: int = 2) -> Machine:
    tables.prepare(docs.sparkSession)
    rows = samples.distinct_sample(
        _with_size(docs).select("doc_id", "text", "n_chars"), labels, "quality", modulus, fold,
        most or SAMPLE, ("text", "n_chars")).mapInArrow(
        _featured, "label int, weight double, indices binary, values binary")
    sample = [(row["indices"], row["values"], row["label"], row["weight"]) for row in rows.collect()]
    sample.sort()  # tasks end in any order
    return trained(
        [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32)) for i, v, _, _ in sample],
        np.array([label for *_, label, _ in sample], dtype=float),
        np.array([weight for *_, weight in sample]))


def scored(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``row`` (the document as given) and score; one pass, no shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(texts: pa.Array, sizes: pa.Array) -> pa.Array:
        scores = [model.value.score(*one) for one in features(texts.to_pylist(), sizes.to_pylist())]
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64())], ["score"])

    rows = tables.packed(docs)
    size = rows["row"]["n_chars"] if "n_chars" in docs.columns else F.lit(None)
    return tables.with_result(rows, run, "score double", rows["row"][text], size.cast("bigint"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    machine = fit(docs, labels)
    return scored(_with_size(docs).select("doc_id", "text", "n_chars"), machine).select(
        F.col("row.doc_id").alias("doc_id"), samples.held_out("row.doc_id", 4, 2).alias("held_out"),
        "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
