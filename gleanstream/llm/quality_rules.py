r"""Quality rules: a learned decision list over statistics of a text.

Words are ``[^\x20\x09-\x0D]+``, compared exactly. A text's counts (words, characters of words,
symbols, repeated lines, words in repeated three-word windows and some more) are taken in one
pass over the whole text; ratios of them are Spark expressions.

The list is learned by sequential covering from a bounded sample of labelled documents. A rule is
a conjunction of thresholds on statistics that says "low quality". It is grown condition by
condition, each the one with the best information gain (as FOIL takes them) on one part of the
sample, then pruned from its end as long as that does not make it worse on the other part. It
is kept if it is right often enough there; the documents that it covers are taken out, and the next rule is
grown on the rest, so that the rules apply in order. The list comes out as an ordered Spark
expression, ``CASE WHEN .. THEN number of the rule ..``, and as text.

Null and empty texts have zero counts and fail the base rule, as all texts of fewer than 50 words
do. Without labels of both kinds the list is empty and only the base rule speaks. A text of any
length is counted whole, in memory linear in it. Repeated rows are judged alike, each on its own;
a whole text counts once a label in learning; ties between conditions go to the first
statistic, then to the smaller threshold. An empty table gives an empty result. All columns of
the input are let through as ``row``, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import exact_words, samples, tables

#: Words of a window that may be repeated.
WINDOW = 3
#: Labelled documents that the list is learned from, at most, by label.
SAMPLE = {0: 4000, 1: 6000}
#: Share of the sample that rules are grown on; the rest is for pruning them.
GROWN = 2 / 3
#: Rules and conditions of a rule, at most; thresholds that are tried for a statistic.
RULES, CONDITIONS, THRESHOLDS = 24, 4, 64
#: A rule must cover so many bad documents it was grown on, and be right so often on the others.
LEAST_COVERED, LEAST_PRECISION = 5, 0.8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_distinct_words", "n_capitals", "n_digits", "n_stops", "n_top_word", "n_bars")
# The characters that count as symbols, and those that end a sentence.
SYMBOLS, STOPS = b"#*$%&|<>", b".!?"

_BLANKS = [0x20, *range(0x09, 0x0E)]
_ASCII_CLASSES = {
    "n_symbols": list(SYMBOLS), "n_capitals": list(range(0x41, 0x5B)),
    "n_digits": list(range(0x30, 0x3A)), "n_stops": list(STOPS), "n_bars": [0x7C],
}
_BLANK = re.compile(rb"[\x20\x09-\x0d]*")


def repeated_words(codes: np.ndarray, width: int = WINDOW) -> int:
    """Words that lie in a window which the sequence has twice or more."""
    count = len(codes) - width + 1
    if count < 2:
        return 0
    ranks = codes[:count]
    for step in range(1, width):
        ranks = np.unique(ranks * len(codes) + codes[step:step + count], return_inverse=True)[1]
    again = np.bincount(ranks)[ranks] > 1
    inside = np.zeros(len(codes), dtype=bool)
    for step in range(width):
        inside[step:step + count] |= again
    return int(inside.sum())


def counts(text: bytes) -> tuple[int, ...]:
    """The values of COUNTS."""
    data = np.frombuffer(text, np.uint8)
    by_byte = np.bincount(data, minlength=256)
    # code points: all bytes but those that continue a character
    characters = int(by_byte.sum() - by_byte[0x80:0xC0].sum() - by_byte[_BLANKS].sum())
    words = exact_words.split(text)
    codes = exact_words.coded(words)
    lines = [line for line in text.split(b"\n") if not _BLANK.fullmatch(line)]
    shares = {name: int(by_byte[chars].sum()) for name, chars in _ASCII_CLASSES.items()}
    by_word = np.bincount(codes)
    return (
        len(words), characters, shares["n_symbols"], len(lines) - len(set(lines)),
        repeated_words(codes), len(lines), len(by_word), shares["n_capitals"], shares["n_digits"],
        shares["n_stops"], int(by_word.max(initial=0)), shares["n_bars"])


def _counted(texts: pa.Array) -> pa.Array:
    rows = [counts(text or b"") for text in texts.cast(pa.binary()).to_pylist()]
    columns = zip(*rows, strict=True) if rows else [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(one, pa.int64()) for one in columns], list(COUNTS))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the document as given) and COUNTS; only the text goes to Python, no shuffle."""
    fields = ", ".join(f"{name} bigint" for name in COUNTS)
    return tables.with_result(tables.packed(docs), _counted, fields, F.col("row")[text])


def base_failed() -> Column:
    """Too short, or too repetitive; on COUNTS."""
    words = F.col("n_words")
    return (words < 50) | (100 * F.col("n_repeat_words") > 50 * words)


#: Statistics that rules look at, as (dividend, divisor) of COUNTS; a divisor of 0 counts as 1.
STATISTICS = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols_a_word": ("n_symbols", "n_words"),
    "bars_a_word": ("n_bars", "n_words"),
    "stops_a_word": ("n_stops", "n_words"),
    "capitals_a_character": ("n_capitals", "word_chars"),
    "digits_a_character": ("n_digits", "word_chars"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "distinct_words": ("n_distinct_words", "n_words"),
    "top_word": ("n_top_word", "n_words"),
    "words_a_line": ("n_words", "n_lines"),
}


def statistic(name: str) -> Column:
    above, below = STATISTICS[name]
    if below is None:
        return F.col(above).cast("double")
    return F.col(above) / F.greatest(F.col(below), F.lit(1))


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = statistic(self.statistic)
        return value >= self.threshold if self.at_least else value <= self.threshold

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        value = values[self.statistic]
        return value >= self.threshold if self.at_least else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], size: int) -> np.ndarray:
    held = np.ones(size, dtype=bool)
    for condition in rule:
        held &= condition.holds(values)
    return held


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first that holds says that a text is of low quality."""

    rules: tuple[Rule, ...] = ()

    def column(self) -> Column:
        """Number of the first rule that holds, from 1, or NULL; on COUNTS."""
        found = None
        for number, rule in enumerate(self.rules, 1):
            holds = rule[0].column()
            for condition in rule[1:]:
                holds &= condition.column()
            found = F.when(holds, number) if found is None else found.when(holds, number)
        return F.lit(None).cast("int") if found is None else found

    def first(self, values: dict[str, np.ndarray], size: int) -> np.ndarray:
        """The same over arrays; 0 where none holds."""
        found = np.zeros(size, dtype=int)
        for number, rule in enumerate(self.rules, 1):
            found[(found == 0) & _covers(rule, values, size)] = number
        return found

    def __str__(self) -> str:
        lines = [f"{number}. low if " + " and ".join(map(str, rule))
                 for number, rule in enumerate(self.rules, 1)]
        return "\n".join([*lines, f"{len(lines) + 1}. else good"])


def _thresholds(values: np.ndarray) -> np.ndarray:
    """Middles between neighbouring values; of many, those at even shares of the documents."""
    distinct = np.unique(values)
    if len(distinct) > THRESHOLDS:
        distinct = np.unique(np.quantile(values, np.linspace(0, 1, THRESHOLDS + 1), method="nearest"))
    return (distinct[1:] + distinct[:-1]) / 2


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray, weights: np.ndarray,
                    least: int) -> tuple[float, Condition | None]:
    """The condition with the greatest gain among the documents given, and the gain."""
    all_bad, total = (weights * bad).sum(), weights.sum()
    before = np.log2(all_bad / total)
    best: tuple[float, Condition | None] = (1e-9, None)
    for name, value in values.items():
        order = np.argsort(value, kind="stable")
        sums = np.concatenate([[0], np.cumsum(weights[order])])
        bads = np.concatenate([[0], np.cumsum((weights * bad)[order])])
        numbers = np.concatenate([[0], np.cumsum(bad[order])])
        for threshold in _thresholds(value):
            at = np.searchsorted(value[order], threshold)
            for at_least, size, hit, number in (
                    (False, sums[at], bads[at], numbers[at]),
                    (True, sums[-1] - sums[at], bads[-1] - bads[at], numbers[-1] - numbers[at])):
                if number >= least:
                    gain = hit * (np.log2(hit / size) - before)
                    if gain > best[0] * (1 + 1e-9):
                        best = gain, Condition(name, at_least, float(threshold))
    return best


def _grown(values: dict[str, np.ndarray], bad: np.ndarray, weights: np.ndarray, least: int) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < CONDITIONS and not bad[inside].all():
        _, condition = _best_condition(
            {name: value[inside] for name, value in values.items()}, bad[inside], weights[inside], least)
        if condition is None:
            break
        rule += (condition,)
        inside &= condition.holds(values)
    return rule


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray, weights: np.ndarray) -> float:
    """(bad - good) / covered, as RIPPER prunes; -1 where nothing is covered."""
    held = _covers(rule, values, len(bad))
    total = weights[held].sum()
    return float((2 * (weights * bad)[held].sum() - total) / total) if total else -1.0


def learned(values: dict[str, np.ndarray], bad: np.ndarray, weights: np.ndarray,
            growing: np.ndarray) -> DecisionList:
    """Sequential covering over arrays; ``growing`` marks the documents that rules are grown on."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)

    def part(chosen: np.ndarray):
        return {name: value[chosen] for name, value in values.items()}, bad[chosen], weights[chosen]

    while len(rules) < RULES:
        grow, check = left & growing, left & ~growing
        if bad[grow].sum() < LEAST_COVERED or bad[grow].all():
            break
        rule = _grown(*part(grow), LEAST_COVERED)
        others = part(check)
        while len(rule) > 1 and _worth(rule[:-1], *others) >= _worth(rule, *others):
            rule = rule[:-1]
        # precision p is a worth of 2 p - 1
        if not rule or _worth(rule, *others) < 2 * LEAST_PRECISION - 1:
            break
        rules.append(rule)
        left &= ~_covers(rule, values, len(bad))
    return DecisionList(tuple(rules))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", most: dict[int, int] | None = None,
        modulus: int = 4, fold: int = 2) -> DecisionList:
    """A list from labelled documents that the base rule lets pass, none of the held-out fold.

    The driver gets the statistics of the sample: a dozen numbers for each document, of which
    ``most`` bounds the number.
    """
    rows = samples.distinct_sample(
        docs.select("doc_id", F.col(text).alias("text")), labels, "quality", modulus, fold, most or SAMPLE)
    found = with_counts(rows).filter(~base_failed()).select(
        F.col("row.label").alias("label"), F.col("row.weight").alias("weight"),
        F.col("row.digest").alias("digest"), *(statistic(name).alias(name) for name in STATISTICS))
    table = found.toPandas().sort_values(["digest", "label"])
    bad = (table["label"] == 0).to_numpy()
    if not bad.any() or bad.all():
        return DecisionList()
    shares = np.array([int(digest[:8], 16) / 2**32 for digest in table["digest"]])
    return learned({name: table[name].to_numpy() for name in STATISTICS}, bad,
                   table["weight"].to_numpy(), shares < GROWN)


def judged(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """``row`` (the document as given), COUNTS, base_failed, rule and kept; one pass, no shuffle.

    ``rule`` is the number of the rule that a text which the base rule lets pass is dropped by.
    """
    return with_counts(docs, text).withColumn("base_failed", base_failed()).withColumn(
        "rule", F.when(~F.col("base_failed"), rules.column())).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept and rule."""
    docs = docs.select("doc_id", "text")
    return judged(docs, fit(docs, labels)).select(
        F.col("row.doc_id").alias("doc_id"), *COUNTS[:5], "base_failed", "kept", "rule")
