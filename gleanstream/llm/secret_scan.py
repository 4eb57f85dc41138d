r"""Secret scan: fixed patterns, and windows of high entropy in candidate strings.

Patterns give the base spans: assignments to telling names, access keys, and long runs of
hexadecimal digits. Besides, every run of 20 or more characters of ``[A-Za-z0-9+/_=-]`` is a
candidate. A window slides over it; counts of its characters, and the sum of n log2 n over
them, are kept up incrementally, so each step costs the same whatever the window's length.
The character class of the window sets the entropy that it must reach. Windows that do are joined
to spans of kind ``entropy``, unless a base span overlaps, or the allow-list speaks for the window: it
is a number, or words and paths, or it overlaps a UUID or a placeholder. Base spans always stay.

Null and empty texts have no spans. A text or candidate of any length is scanned whole. Repeated
rows are scanned alike, each on its own; an empty table gives an empty result; all columns of
the input are let through as ``row``, whatever their names.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from gleanstream.llm import tables

# The base patterns, in the order in which their kinds are listed.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")
LEAST_SECRET, LEAST_ACCESS = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Bits that a window's entropy must reach, by the class of all its characters; the first that fits.
CLASSES = (
    ("hexadecimal", re.compile(r"[0-9A-Fa-f]"), 3.2),
    ("lower case and digits", re.compile(r"[a-z0-9]"), 3.9),
    ("upper case and digits", re.compile(r"[A-Z0-9]"), 3.9),
    ("mixed", re.compile(r"."), 4.0),
)
# What looks random and is not secret. A window all of whose characters are of one of
# these classes is a number, or words and paths; spans of the others silence what overlaps them.
PLAIN = (re.compile(r"[0-9]"), re.compile(r"[A-Za-z/_=-]"))
ALLOWED = re.compile(
    r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
    r"|example|placeholder|changeme|your_|x{4,}|abcdefghij|0123456789", re.IGNORECASE)


@functools.cache
def _classes(char: str) -> tuple[int, ...]:
    """Which of PLAIN and CLASSES a character is in, as numbers of 0 and 1."""
    return tuple(int(bool(one.match(char))) for one in (*PLAIN, *(shape for _, shape, _ in CLASSES)))


def thresholds(candidate: str, width: int = WINDOW) -> list[float]:
    """Bits that each window must reach, by its last character; infinite where it is allowed.

    Counts by class are kept up incrementally, like those of the entropy.
    """
    counts = [0] * (len(PLAIN) + len(CLASSES))
    bits = [least for _, _, least in CLASSES]
    found = [math.inf] * len(candidate)
    for end, char in enumerate(candidate):
        for at, one in enumerate(_classes(char)):
            counts[at] += one
        if end >= width:
            for at, one in enumerate(_classes(candidate[end - width])):
                counts[at] -= one
        if end >= width - 1 and not any(one == width for one in counts[:len(PLAIN)]):
            found[end] = next(least for one, least in zip(counts[len(PLAIN):], bits) if one == width)
    for match in ALLOWED.finditer(candidate):
        for end in range(match.start(), min(match.end() + width - 1, len(candidate))):
            found[end] = math.inf
    return found


def dense_windows(candidate: str, least: float | list[float], width: int = WINDOW) -> list[tuple[int, int]]:
    """Spans of the windows whose entropy is at least so many bits, joined where they overlap.

    ``least`` is one number, or that of each window, by its last character.
    Entropy is log2 w - (sum of n log2 n) / w; a step changes two terms of the sum.
    """
    # one more than a window holds, for the moment before its first character goes
    terms = [0.0, *(n * math.log2(n) for n in range(1, width + 2))]
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    bits = least if isinstance(least, list) else [least] * len(candidate)
    for end, char in enumerate(candidate, 1):
        n = counts.get(char, 0)
        total += terms[n + 1] - terms[n]
        counts[char] = n + 1
        if end > width:
            gone = candidate[end - width - 1]
            n = counts[gone]
            total += terms[n - 1] - terms[n]
            counts[gone] = n - 1
        if end >= width and math.log2(width) - total / width >= bits[end - 1] - 1e-9:
            if spans and spans[-1][1] >= end - width:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((end - width, end))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= LEAST_SECRET]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def entropy_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Dense windows of candidates that no base span overlaps."""
    taken = sorted((start, end) for start, _, end in base)
    reach = list(itertools.accumulate((end for _, end in taken), max))
    found = []
    for match in CANDIDATE.finditer(text):
        for low, high in dense_windows(match.group(), thresholds(match.group())):
            low, high = low + match.start(), high + match.start()
            before = bisect.bisect_left(taken, (high,))  # base spans that begin before the end
            if not before or reach[before - 1] <= low:
                found.append((low, 3, high))
    return found


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _scan(texts: pa.Array) -> pa.Array:
    counts: list[list[int]] = [[], [], [], []]
    digests, lists = [], []
    for text in texts.to_pylist():
        base = base_spans(text or "")
        spans = base + entropy_spans(text or "", base)
        for kind in range(4):
            counts[kind].append(sum(one[1] == kind for one in spans))
        digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
        lists.append(_listed(spans))
    return pa.StructArray.from_arrays(
        [*(pa.array(one, pa.int64()) for one in counts), pa.array(digests, pa.string()),
         pa.array(lists, pa.string())],
        ["n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"])


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the document as given), counts by kind, base_sha256, spans; no shuffle."""
    rows = tables.packed(docs)
    return tables.with_result(
        rows, _scan, "n_assign bigint, n_access bigint, n_hex bigint, n_entropy bigint, "
        "base_sha256 string, spans string", rows["row"][text])
