"""Words of texts as exact small numbers: equal words have equal codes, others never."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes of text that are worked on at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def blocks(texts: Sequence[bytes | None], most: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """Consecutive texts, as many as come to so many bytes; null counts as empty."""
    block: list[bytes] = []
    size = 0
    for text in texts:
        data = text or b""
        if block and size + len(data) > most:
            yield block
            block, size = [], 0
        block.append(data)
        size += len(data)
    if block:
        yield block


def split(text: bytes) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+``: without arguments bytes are split at just these characters."""
    return text.split()


def coded(words: Sequence[bytes]) -> np.ndarray:
    """A number for each word, by first occurrence."""
    codes: dict[bytes, int] = {}
    return np.fromiter((codes.setdefault(word, len(codes)) for word in words), np.int64, len(words))
