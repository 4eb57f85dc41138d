"""Words of texts, and 64-bit hashes of them, for many texts at once.

Words are byte classes in UTF-8, so a text is split by a table of bytes. A word's hash is a
BLAKE2 digest, for which no two words are known to collide; still, what must be exact compares
the words themselves and takes the hashes as a filter only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np

#: Bytes of text that are worked on at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = 0xD1342543DE82EF95


def _table(separators: Sequence[int]) -> bytes:
    """Lower-cases A-Z and makes every separator a blank."""
    table = bytearray(range(256))
    table[0x41:0x5B] = range(0x61, 0x7B)
    for byte in separators:
        table[byte] = 0x20
    return bytes(table)


#: Words ``[^\x20\x09-\x0D]+`` of texts whose A-Z are lower-cased.
SPACED = _table([0x20, *range(0x09, 0x0E)])
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of texts whose A-Z are lower-cased.
ALPHANUMERIC = _table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd multiplier modulo 2**64, and their inverses."""
    global _powers, _inverses
    if len(_powers) < size:
        inverse = np.uint64(pow(int(_P), -1, 2**64))
        size = max(size, BLOCK_BYTES + 4096)
        _powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, _P)]))
        _inverses = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, inverse)]))
    return _powers, _inverses


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def split(text: str | None, table: bytes) -> list[bytes]:
    """The words of a text, as bytes."""
    return text.encode("utf-8", "surrogatepass").translate(table).split() if text else []


class _Hashes(dict):
    """Hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return value


def _prefix_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    powers, inverses = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[:len(raw)], out=sums[1:])
    return sums, inverses


def hashed_words(
    texts: Sequence[str | None], table: bytes
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of texts as (first text, word hashes, offsets of each text's words in them)."""
    first = size = 0
    lists: list[list[bytes]] = []
    for place, text in enumerate(texts):
        if lists and size + len(text or "") > BLOCK_BYTES:
            yield first, *_hashed(lists)
            first, size, lists = place, 0, []
        lists.append(split(text, table))
        size += len(text or "")
    if lists:
        yield first, *_hashed(lists)


def _hashed(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    known = _Hashes()
    bounds = np.cumsum([0, *map(len, lists)])
    hashes = np.fromiter(
        (known[word] for words in lists for word in words), np.uint64, int(bounds[-1]))
    return hashes, bounds


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words; empty where there are fewer."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = words[:count].copy()
    for step in range(1, width):
        total *= np.uint64(_Q)
        total += words[step:step + count]
    return mixed(total + np.uint64(width))


def rolling_hashes(data: bytes, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive bytes."""
    count = len(data) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums, inverses = _prefix_sums(np.frombuffer(data, dtype=np.uint8))
    return mixed((sums[width:] - sums[:-width]) * inverses[:count])
