import random

import brute
import numpy as np
import pytest

from gleanstream.llm import words


def texts(seed, count=60):
    rng = random.Random(seed)
    chars = "aAbZ09é😀 \t\n\x0b\x1c\x85.,-_ "
    return [None, "", " ", "one"] + [
        "".join(rng.choice(chars) for _ in range(rng.randrange(40))) for _ in range(count)]


@pytest.mark.parametrize("block", [1 << 20, 16])
@pytest.mark.parametrize("mask,plain", [
    (words.SPACED, brute.spaced_words), (words.ALPHANUMERIC, brute.plain_words)])
def test_hashes_stand_for_words(monkeypatch, block, mask, plain):
    monkeypatch.setattr(words, "BLOCK_BYTES", block)
    rows = texts(1)
    by_word, by_hash, seen = {}, {}, 0
    for first, hashes, bounds in words.hashed_words(rows, mask):
        for at in range(len(bounds) - 1):
            own = hashes[bounds[at]:bounds[at + 1]].tolist()
            want = plain(rows[first + at])
            assert len(own) == len(want)
            for word, value in zip(want, own):
                assert by_word.setdefault(word, value) == value
                assert by_hash.setdefault(value, word) == word
            seen += 1
    assert seen == len(rows)


def test_runs_and_rolling_hashes():
    base = np.arange(50, dtype=np.uint64)
    runs = words.run_hashes(words.mixed(base % np.uint64(10)), 5)
    assert len(runs) == 46 and len(set(runs.tolist())) == 10
    assert len(words.run_hashes(base[:3], 5)) == 0
    data = b"abcdefghij" * 4
    rolled = words.rolling_hashes(data, 10)
    assert len(rolled) == 31 and len(set(rolled.tolist())) == 10
