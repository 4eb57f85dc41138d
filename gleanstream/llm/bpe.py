"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text puts chunk borders where the content says so, so that
a passage has the same chunks in every document it occurs in. Chunks are encoded as they are, borders in
words or even in letters included, and a chunk that a worker has met is not encoded again.

A border can cut a word, and then the tokens on both sides are wrong. Such a join is repaired by
encoding a window of the text around it again: the words that the border may have changed, and
a whole word more on each side. The window agrees if it begins with the tokens that the left chunk
has for the first of its words, and ends with those that the right chunk has for the last; then what lies between takes the
place of the tokens at the join. If it does not agree, or a chunk has no word left to compare, the
window grows, over further chunks if need be, up to the ends of the text. Windows met before are
not encoded again either.

Within a chunk, words between blanks are remembered, lower-cased and without the signs that end them:
at blanks, and between a letter and such signs, the tokenizer always splits. The coder is for tokenizers
that drop white space and case; it tries this out and refuses others. What is new of a block is
encoded as one text, which is cut by the bytes that the tokens stand for. Chunks, words and windows
are known by their bytes, not by hashes.

Nulls count as empty; empty texts have no tokens and decode to an empty text. A text of any length is
encoded whole, in memory linear in it. Repeated rows are encoded alike, each on its own; an empty
table gives an empty result. All columns are let through as ``row``, whatever their names; nothing is
shuffled.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import struct
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from gleanstream.llm import tables, words

#: Bytes that the rolling hash looks at, and the mean distance of borders (a power of two).
ROLL, CHUNK = 24, 512
#: Bytes of text that are cut and encoded at once.
BLOCK_BYTES = 1 << 19
#: Words or windows that are encoded as one text at most.
PIECE = 2_000
#: Entries that a worker keeps: chunks, windows, and words of each of two generations.
CHUNKS_KEPT, WINDOWS_KEPT, WORDS_KEPT = 5_000, 20_000, 100_000


#: Where the tokenizer always splits, and bytes that continue a letter.
_BLANK = np.isin(np.arange(256), list(b" \n\t\r\x0b\x0c"))
_CONTINUES = (np.arange(256) & 0xC0) == 0x80
#: Signs that end a word. No quotes (they join letters that follow), no signs of special tokens.
_ENDED = re.compile(rb"[.,;:!?$%*&#](?<=[0-9A-Za-z].)")


#: Texts in ASCII and the small letters of Latin-1: normal forms and lower case leave their bytes as many.
_STEADY = re.compile(rb"(?:[\x00-\x7F]|\xC3[\x9F-\xBF])*").fullmatch


def content_borders(data: bytes) -> np.ndarray:
    """Where the content says that chunks end, at the mean CHUNK bytes apart; also within words.

    A border within a letter moves to the letter's start, since text is made of letters.
    """
    hashes = words.rolling_hashes(data, ROLL)
    borders = np.flatnonzero(hashes & np.uint64(CHUNK - 1) == 0) + ROLL
    raw = np.append(np.frombuffer(data, np.uint8), 0)
    for _ in range(3):  # a letter has four bytes at most
        borders = borders - _CONTINUES[raw[borders]]
    borders = np.unique(borders)
    return borders[(borders > 0) & (borders < len(data))]


def word_parts(text: bytes) -> list[bytes]:
    """The words of some text; signs behind a letter or digit are apart from it, with what follows them."""
    return _ENDED.sub(rb" \g<0>", text).split()


class Chunk:
    """A chunk's words and their ids, and whether its ends may lie within a word."""

    __slots__ = ("words", "ids", "open_left", "open_right")

    def __init__(self, data: bytes, found: list[bytes], ids: list[bytes]):
        self.words, self.ids = found, ids
        self.open_left = not _BLANK[data[0]]
        self.open_right = not _BLANK[data[-1]]


class Coder:
    """Encodes and decodes, remembering chunks, words and windows."""

    def __init__(self, config: str):
        self.tokenizer = Tokenizer.from_str(config)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [one.content.lower().encode()
                        for one in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks: dict[bytes, Chunk] = {}
        self.windows: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.met = self.reused = self.repaired = self.widened = 0
        # without a decoder, the library decodes ids to their tokens with blanks between
        self.tokens = None if self.tokenizer.decoder else list(
            map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size())))
        if self.tokens and None in self.tokens:
            self.tokens = None  # ids with gaps
        # the bytes of text that each token stands for
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.sizes = np.array(list(map(len, map(str.removesuffix, self.tokens, repeat(suffix))))) if self.tokens else None
        for blank in " \n\t\r\x0b\x0c":
            parts = [self._ids(text) for text in (f"A b's.,{blank}{blank}C9?", "a", "b's", ".,", "c9", "?", blank)]
            if parts[0] != sum(parts[1:], []):
                raise ValueError("the tokenizer keeps white space or case, so texts can't be cut at blanks")

    def _folded(self, data: bytes) -> bytes:
        """Lower case, unless that could make a special token of what is none."""
        low = data.lower()
        return data if any(token in low for token in self.special) else low

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _packed(self, texts: list[bytes]) -> list[bytes]:
        """Ids of some texts, each encoded on its own."""
        coded = self.tokenizer.encode_batch_fast(
            [text.decode("utf-8") for text in texts], add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in [one.ids for one in coded]]

    def _together(self, texts: list[bytes]) -> list[bytes]:
        """Ids of some words, or words with blanks between, each as if encoded on its own.

        Those of letters that have as many bytes in any form are encoded as one text and cut by the bytes
        that tokens stand for; a text for each would have much more to it. Where the bytes don't fit,
        each is encoded on its own.
        """
        if len(texts) > PIECE:
            return list(chain.from_iterable(
                self._together(texts[start:start + PIECE]) for start in range(0, len(texts), PIECE)))
        plain = list(filter(_STEADY, texts)) if self.sizes is not None else []
        if len(plain) < 2:
            return self._packed(texts)
        coded = self.tokenizer.encode_batch_fast([b" ".join(plain).decode()], add_special_tokens=False)
        ids = np.array(coded[0].ids, "<u4")
        ends = np.cumsum([len(text) - text.count(b" ") for text in plain])
        reached = np.cumsum(self.sizes[ids])
        stops = np.searchsorted(reached, ends) + 1
        if len(ids) != stops[-1] or (reached[stops - 1] != ends).any():
            return self._packed(texts)
        raw = ids.tobytes()
        cut = [raw[start:stop] for start, stop in pairwise([0, *(4 * stops).tolist()])]
        if len(plain) < len(texts):
            known = dict(zip(plain, cut, strict=True))
            rest = [text for text in texts if text not in known]
            known.update(zip(rest, self._packed(rest), strict=True))
            cut = list(map(known.__getitem__, texts))
        return cut

    def _know(self, met: set[bytes]) -> dict[bytes, bytes]:
        """The ids of some words, those that are new being encoded."""
        known, older = self.words, self.older
        unknown = met.difference(known)
        new = unknown.difference(older)
        known.update([(word, older[word]) for word in unknown - new])
        known.update(zip(new, self._together(list(new)), strict=True))
        return dict(zip(met, map(known.__getitem__, met), strict=True))

    def _chunks(self, texts: list[bytes]) -> list[list[Chunk]]:
        """The chunks of each text, those that are new being encoded."""
        if len(self.chunks) > CHUNKS_KEPT:
            self.chunks = {}
        cut = []
        fresh: dict[bytes, list[bytes]] = {}
        folded = [self._folded(data) for data in texts]
        ends = np.cumsum([len(data) + 1 for data in folded]).tolist()
        borders = content_borders(b"\n".join(folded))  # of all texts at once
        for data, end in zip(folded, ends, strict=True):
            first = end - len(data) - 1
            low, high = np.searchsorted(borders, (first + 1, end - 1)).tolist()
            inner = (borders[low:high] - first).tolist()
            own = [data[start:stop] for start, stop in pairwise([0, *inner, len(data)])] if data else []
            cut.append(own)
            self.met += len(own)
            for chunk in own:
                if chunk in self.chunks or chunk in fresh:
                    self.reused += 1
                else:
                    fresh[chunk] = word_parts(chunk)
        if len(self.words) > WORDS_KEPT:
            self.words, self.older = {}, self.words
        # each word is looked up once in all that are known, and then in this small table
        known = self._know(set(chain.from_iterable(fresh.values())))
        for chunk, found in fresh.items():
            self.chunks[chunk] = Chunk(chunk, found, list(map(known.__getitem__, found)))
        return [[self.chunks[chunk] for chunk in own] for own in cut]

    def _foresee(self, texts: list[list[Chunk]]) -> None:
        """Encode at once the windows that most joins of some texts look at first."""
        if len(self.windows) > WINDOWS_KEPT:
            self.windows = {}
        windows = set()
        for chunks in texts:
            for left, right in pairwise(chunks):
                # the word before the last is as it is, if it is not in a join itself
                if left.open_right and right.open_left and len(left.words) > 2:
                    windows.add(b" ".join([left.words[-2], left.words[-1] + right.words[0], *right.words[1:2]]))
        new = [window for window in windows if window not in self.windows]
        self.windows.update(zip(new, self._together(new), strict=True))

    def _encode_window(self, window: bytes) -> bytes:
        ids = self.windows.get(window)
        if ids is None:
            if len(self.windows) > WINDOWS_KEPT:
                self.windows = {}
            ids = self.windows[window] = self._packed([window])[0]
        return ids

    def _join(self, found: list[bytes], ids: list[bytes], chunk: Chunk) -> None:
        """Put a chunk behind the words so far, repairing the join between them.

        ``found`` and ``ids`` are the words of the text so far, right but for the last; the chunk's
        first word goes on with it. The last word stays open to the next join in turn.
        """
        left = 2  # the word at the join, and one to compare
        while True:
            start = max(len(found) - left, 0)
            right = chunk.words[1:2]
            window = b" ".join([*found[start:-1], found[-1] + chunk.words[0], *right])
            got = self._encode_window(window)
            # at the ends of the text, and of a chunk without another word, is nothing to compare
            head = ids[start] if start < len(found) - 1 else b""
            tail = chunk.ids[1] if right else b""
            if got.startswith(head) and got.endswith(tail) and len(got) >= len(head) + len(tail):
                break
            if not start:
                head, tail = b"", tail if got.endswith(tail) else b""
                break
            self.widened += 1
            left *= 2
        self.repaired += 1
        middle = got[len(head):len(got) - len(tail)]
        keep = start + 1 if head else start
        joint = found[-1] + chunk.words[0]
        del found[keep:], ids[keep:]
        # the words between those that agree have their tokens together
        found.append(joint)
        ids.append(middle)
        found += chunk.words[1:]
        ids += chunk.ids[1:]

    def _joined(self, chunks: list[Chunk]) -> bytes:
        found: list[bytes] = []
        ids: list[bytes] = []
        is_open = False
        for chunk in chunks:
            if not chunk.words:  # blanks alone
                is_open = False
                continue
            if is_open and chunk.open_left:
                self._join(found, ids, chunk)
            else:
                found += chunk.words
                ids += chunk.ids
            is_open = chunk.open_right
        return b"".join(ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        collecting = gc.isenabled()
        gc.disable()  # nothing here is in cycles, and looking for them takes an eighth of the time
        try:
            return self._encoded(texts)
        finally:
            if collecting:
                gc.enable()

    def _encoded(self, texts: list[str | None]) -> list[bytes]:
        found: list[bytes] = []
        block: list[bytes] = []
        size = 0
        for text in [*texts, None]:
            data = text.encode("utf-8") if text else b""
            if block and (size + len(data) > BLOCK_BYTES or len(found) + len(block) == len(texts)):
                chunks = self._chunks(block)
                self._foresee(chunks)
                found += map(self._joined, chunks)
                block, size = [], 0
            block.append(data)
            size += len(data)
        return found

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        if self.tokens:
            return " ".join(map(self.tokens.__getitem__, numbers))
        return self.tokenizer.decode(numbers, skip_special_tokens=False)


_coders: dict[str, Coder] = {}


def _coder(config: str) -> Coder:
    """One coder a worker process, kept from task to task."""
    key = hashlib.sha256(config.encode()).hexdigest()
    if key not in _coders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        _coders[key] = Coder(config)
        tables.give_back()  # half of what reading the vocabulary took
    return _coders[key]


_FIELDS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encoded(docs: DataFrame, vocabulary: str, text: str = "text", with_ids: bool = True,
            with_decoded: bool | None = None) -> DataFrame:
    """``row`` (the document as given), n_tokens, ids_sha256, decoded_sha256, ids, decoded.

    ``vocabulary`` is a tokenizer file that the driver reads; its text is broadcast, so the
    executors need no such file. Only the text goes to Python. Without ``with_ids`` only the digests
    come back, without ``with_decoded`` (by default as ``with_ids``) no decoded text does.
    """
    with_decoded = with_ids if with_decoded is None else with_decoded
    with open(vocabulary, encoding="utf-8") as file:
        config = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(texts: pa.Array) -> pa.Array:
        coder = _coder(config.value)
        coded = coder.encode(texts.to_pylist())
        decoded = [coder.decode(ids) for ids in coded]
        columns = [
            pa.array([len(ids) // 4 for ids in coded], pa.int64()),
            pa.array([hashlib.sha256(ids).hexdigest() for ids in coded], pa.string()),
            pa.array([hashlib.sha256(one.encode()).hexdigest() for one in decoded], pa.string())]
        names = ["n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            bounds = np.cumsum([0, *(len(ids) // 4 for ids in coded)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(
                pa.array(bounds), pa.array(np.frombuffer(b"".join(coded), "<i4"))))
            names.append("ids")
        if with_decoded:
            columns.append(pa.array(decoded, pa.string()))
            names.append("decoded")
        return pa.StructArray.from_arrays(columns, names)

    fields = _FIELDS + ", ids array<int>" * with_ids + ", decoded string" * with_decoded
    rows = tables.packed(docs)
    return tables.with_result(rows, run, fields, rows["row"][text])
