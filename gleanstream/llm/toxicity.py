"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding undoes disguises: compatibility forms, accents, look-alike letters of other scripts,
and digits or signs that stand for letters inside a word (signs around it are punctuation).
The lexicon has seed words and stems learned from labelled documents: beginnings of words (or
whole words) that are far likelier in toxic documents, chosen greedily so that each covers
documents the others do not.
Weights are log odds. One automaton finds all entries at word starts in a single pass; hits
inside an exception phrase do not count. The score is a logistic function of the summed
weights and of the summed weights per hundred words, so that length is normalised out.

Null and empty texts have no hits and get the score of a text without hits. Empty or missing
labels leave the seed words and a default calibration.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import samples, tables

#: Labelled documents that a model is fitted on, at most, by label.
SAMPLE = {0: 9000, 1: 3000}
#: Learned stems need this many toxic documents, and this share of them.
LEAST_DOCUMENTS, LEAST_SHARE = 5, 0.004
#: Least log odds of a learned stem, and the weight of a seed word.
LEAST_WEIGHT, SEED_WEIGHT = 2.3, 4.0
#: Distinct entries that a toxic document should be covered by.
COVER = 2
STEM_LENGTHS = range(3, 13)

# Common insults, and phrases in which such words are harmless.
SEEDS = (
    "bastard", "bitch", "clown", "disgusting", "dumbass", "garbage human", "idiot", "imbecile",
    "jackass", "loser", "lowlife", "moron", "pathetic", "retard", "scum", "scumbag", "stupid",
    "trash", "worthless",
)
EXCEPTIONS = (
    "class clown", "clown fish", "clown loach", "pond scum", "soap scum", "sore loser award",
    "trash bag", "trash bin", "trash can", "trash collection", "trash pickup", "worthless check",
)
# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "һ": "h", "н": "h", "і": "i",
    "ј": "j", "к": "k", "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r",
    "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "σ": "s", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
    "ß": "ss", "æ": "ae", "œ": "oe",
}
# Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
               "@": "a", "$": "s", "!": "i", "|": "l"}


def _fold_table() -> dict[int, str]:
    """Look-alikes, and accented Latin letters by their decomposition."""
    table = {ord(char): plain for char, plain in LOOKALIKES.items()}
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(code))
        if len(base) > 1 and base[0].isascii():
            table[code] = base[0]
    for code in (0xAD, *range(0x200B, 0x2010), *range(0x300, 0x370), 0x2060, 0xFEFF):
        table[code] = ""  # invisible characters and loose accents
    return table


_FOLD = _fold_table()
_SUBSTITUTE = str.maketrans(SUBSTITUTES)
_DISGUISED = re.compile(r"(?<![\w@$!|])[^\W\d]*+[0-9@$!|][\w@$!|]*+")
_LETTER = re.compile(r"[^\W\d_]")
_BETWEEN = re.compile(r"[\W_]+")


def _undisguised(match: re.Match) -> str:
    core = match.group().strip("@$!|")
    return (core.translate(_SUBSTITUTE) if _LETTER.search(core) else core) + " "


def folded(text: str | None) -> str:
    """Words in plain lower case, each between single blanks."""
    if not text:
        return " "
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii():
        text = text.translate(_FOLD)
    return f" {_BETWEEN.sub(' ', _DISGUISED.sub(_undisguised, text))} ".replace("  ", " ")


@dataclass(frozen=True)
class Model:
    """Weights by pattern: `` stem`` at a word start, `` word `` for a whole word."""

    weights: dict[str, float] = field(
        default_factory=lambda: {f" {seed}": SEED_WEIGHT for seed in SEEDS})
    exceptions: tuple[str, ...] = tuple(f" {phrase} " for phrase in EXCEPTIONS)
    #: Of a constant, log(1 + weights), log(1 + weights per 100 words).
    coefficients: tuple[float, float, float] = (-4.0, 1.5, 2.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for pattern in self.exceptions:
            found.add_word(pattern, (len(pattern), None))
        for pattern, weight in self.weights.items():
            found.add_word(pattern, (len(pattern), weight))
        found.make_automaton()
        return found

    def score(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        constant, by_total, by_density = self.coefficients
        dense = np.log1p(100 * total / np.maximum(words, 1))
        return 1 / (1 + np.exp(-(constant + by_total * np.log1p(total) + by_density * dense)))


def matched(text: str, automaton: ahocorasick.Automaton) -> tuple[float, int]:
    """Summed weight and number of hits of folded text; the longest entry at a place counts."""
    hits: dict[int, tuple[int, float]] = {}
    harmless: list[tuple[int, int]] = []
    for last, (length, weight) in automaton.iter(text):
        start = last - length + 1
        if weight is None:
            harmless.append((start, last))
        elif length > hits.get(start, (0, 0.0))[0]:
            hits[start] = (length, weight)
    total, count, at = 0.0, 0, 0
    for start in sorted(hits):
        while at < len(harmless) and harmless[at][1] <= start:
            at += 1
        if any(low <= start < high for low, high in harmless[at:at + 3]):
            continue
        total += hits[start][1]
        count += 1
    return total, count


def _stems(text: str) -> set[str]:
    """Beginnings of a folded text's words after a blank, and whole words between blanks."""
    found = set()
    for word in set(text.split()):
        found.add(f" {word} ")
        found.update(f" {word[:size]}" for size in STEM_LENGTHS if size <= len(word))
    return found


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tables.slices(batches):
        digests = [hashlib.sha256(folded(text).encode("utf-8", "surrogatepass")).digest()
                   for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(digests, pa.binary())], [*batch.schema.names, "digest"])


def _distinct_texts(rows: DataFrame) -> DataFrame:
    """label, weight and text of the sample, each folded text once for each label.

    Copies of one text would make its rare words look telling. The copy with the smallest id
    stays and has the weight of all.
    """
    return rows.select("doc_id", "label", "weight", "text").mapInArrow(
        _digested, "doc_id bigint, label int, weight double, text string, digest binary").groupBy(
        "digest", "label").agg(
        F.sum("weight").alias("weight"), F.min(F.struct("doc_id", "text")).alias("first")).select(
        "label", "weight", F.col("first.text").alias("text"))


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tables.slices(batches):
        texts = batch.column("text").to_pylist()
        for start in range(0, len(texts), 100):
            counts: Counter[str] = Counter()
            for text in texts[start:start + 100]:
                counts.update(_stems(folded(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())],
                ["stem", "documents"])


def _known_stems(known: list[str]):
    """The known stems that each document has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {stem: place for place, stem in enumerate(known)}
        for batch in tables.slices(batches):
            rows = [sorted(places[stem] for stem in _stems(folded(text)) & places.keys())
                    for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(rows, pa.list_(pa.int32()))], ["label", "stems"])
    return run


def _sums(weights: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = weights.automaton()
        for batch in tables.slices(batches):
            rows = [folded(text) for text in batch.column("text").to_pylist()]
            sums = [matched(row, automaton)[0] for row in rows]
            sizes = [row.count(" ") - 1 for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("weight"), pa.array(sums, pa.float64()),
                 pa.array(sizes, pa.int64())], ["label", "weight", "total", "words"])
    return run


def _covering(rows: list[np.ndarray], known: list[str], weights: np.ndarray,
              least: int) -> list[int]:
    """Stems that cover every toxic document COVER times if they can.

    The next is that with the largest product of newly covered documents and weight; of
    equals a beginning goes before a whole word, and the longer beginning first.
    """
    has = np.zeros((len(known), len(rows)), dtype=bool)
    for column, stems in enumerate(rows):
        has[stems, column] = True
    need = np.full(len(rows), COVER)
    rank = np.array([(not stem.endswith(" "), len(stem)) for stem in known], dtype=float)
    chosen: list[int] = []
    while len(chosen) < len(known):
        gain = has @ (need > 0).astype(np.float32)
        gain = np.where(gain >= least, gain * weights, 0)
        if not gain.any():
            break
        best = np.lexsort((rank[:, 1], rank[:, 0], np.round(gain, 3)))[-1]
        chosen.append(int(best))
        need -= has[best]
        # a stem that continues or begins the chosen one says the same
        word = known[best].strip()
        for place, stem in enumerate(known):
            if stem.strip().startswith(word) or word.startswith(stem.strip()):
                has[place] = False
    return chosen


def _logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Coefficients by Newton's method with a small ridge."""
    found = np.zeros(features.shape[1])
    ridge = np.diag([1e-3] + [1e-1] * (features.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ found, -30, 30)))
        gradient = features.T @ (weights * (labels - p)) - ridge @ found
        curve = (features * (weights * p * (1 - p))[:, None]).T @ features + ridge
        step = np.clip(np.linalg.solve(curve, gradient), -2, 2)
        found += step
        if np.abs(step).max() < 1e-8:
            break
    return found


def fit(docs: DataFrame, labels: DataFrame, most: dict[int, int] | None = None,
        modulus: int = 3, fold: int = 1) -> Model:
    """A model from a bounded sample of labelled documents outside the held-out fold.

    What reaches the driver is bounded by the sample: stems that enough of its toxic
    documents have, which documents have them, and two numbers a document.
    """
    tables.prepare(docs.sparkSession)
    rows = samples.labelled_sample(docs, labels, "toxic", modulus, fold, most or SAMPLE)
    rows = tables.stored(_distinct_texts(rows).repartition(12), "toxicity-sample")
    sizes = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model()
    least = max(LEAST_DOCUMENTS, math.ceil(LEAST_SHARE * toxic))
    counted = rows.filter("label = 1").select("text").mapInArrow(
        _stem_counts, "stem string, documents bigint").groupBy("stem").agg(
        F.sum("documents").alias("documents")).filter(F.col("documents") >= least)
    frequent = {row["stem"]: row["documents"] for row in counted.collect()}
    # what most toxic documents of a sample share with clean ones falls out by its odds
    known = sorted(frequent)
    held = rows.select("label", "text").mapInArrow(
        _known_stems(known), "label int, stems array<int>")
    cleanly = np.zeros(len(known))
    for row in held.filter("label = 0").select(F.explode("stems").alias("stem")).groupBy(
            "stem").count().collect():
        cleanly[row["stem"]] = row["count"]
    toxicly = np.array([frequent[stem] for stem in known], dtype=float)
    odds = np.log((toxicly + 0.5) / (toxic + 1)) - np.log((cleanly + 0.5) / (clean + 1))
    telling = [known[place] for place in np.flatnonzero(odds >= LEAST_WEIGHT)]
    weights = {stem: odds[known.index(stem)] for stem in telling}
    owned = [np.array(row["stems"], dtype=int) for row in rows.filter("label = 1").select(
        "label", "text").mapInArrow(_known_stems(telling), "label int, stems array<int>").collect()]
    chosen = _covering(owned, telling, np.array([weights[stem] for stem in telling]), least)
    model = Model(Model().weights | {telling[i]: float(weights[telling[i]]) for i in chosen})

    sums = rows.select("label", "weight", "text").mapInArrow(
        _sums(model), "label int, weight double, total double, words bigint").toPandas()
    sums = sums.sort_values(list(sums.columns))  # tasks end in any order
    total, words = sums["total"].to_numpy(), sums["words"].to_numpy()
    features = np.stack([
        np.ones(len(sums)), np.log1p(total), np.log1p(100 * total / np.maximum(words, 1))], axis=1)
    fitted = _logistic(features, sums["label"].to_numpy(), sums["weight"].to_numpy())
    return Model(model.weights, model.exceptions, tuple(map(float, fitted)))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row`` (the document as given), score, n_hits and density; one pass, no shuffle."""
    held: list = []  # the automaton, made once a task

    def run(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(model.automaton())
        rows = [folded(one) for one in texts.to_pylist()]
        hits = [matched(row, held[0]) for row in rows]
        totals = np.array([total for total, _ in hits], dtype=float)
        words = np.array([max(row.count(" ") - 1, 0) for row in rows], dtype=float)
        return pa.StructArray.from_arrays(
            [pa.array(model.score(totals, words), pa.float64()),
             pa.array([count for _, count in hits], pa.int64()),
             pa.array(100 * totals / np.maximum(words, 1), pa.float64())],
            ["score", "n_hits", "density"])

    rows = tables.packed(docs)
    return tables.with_result(rows, run, "score double, n_hits bigint, density double", rows["row"][text])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_hits, density."""
    model = fit(docs, labels)
    return scored(docs.select("doc_id", "text"), model).select(
        F.col("row.doc_id").alias("doc_id"), samples.held_out("row.doc_id", 3, 1).alias("held_out"),
        "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_hits", "density")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    model = fit(docs, labels)
    return scored(docs, model).filter(F.col("score") < threshold).select("row.*")
