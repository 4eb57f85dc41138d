import random

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gleanstream.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\t ", "a", "It's  they'RE x", "<|endoftext|> a<|startoftext|>b", "<|endof text|>",
    "é ́ a b　c", "İSTANBUL ẞ ﬁ", "x" * 5000, "ab " * 3000, "1234 5 6,7!?...", "\x0b\x0c\x1c\x85",
    "日本語のテキスト 中文", "😀😀 👩‍👩‍👧", "한국어 한국",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def result(df):
    return {row["row"]["doc_id"]: (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"])
            for row in df.collect()}


def test_equal_to_the_library(spark, sf, tokenizer):
    texts = ODD + [row["text"] for row in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = {ident: brute.encoding(tokenizer, text) for ident, text in enumerate(texts)}
    assert result(bpe.encoded(docs, PATH, with_ids=False)) == want
    full = bpe.encoded(docs, PATH)
    for row in full.filter("row.doc_id < 40").collect():
        ids = tokenizer.encode(texts[row["row"]["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids"] == ids
        assert row["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)


def test_small_chunks_and_forgetting(monkeypatch, tokenizer):
    monkeypatch.setattr(bpe, "CHUNK", 8)
    monkeypatch.setattr(bpe, "WORDS_KEPT", 50)
    monkeypatch.setattr(bpe, "CHUNKS_KEPT", 20)
    rng = random.Random(4)
    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    for _ in range(40):
        texts = ["".join(rng.choice("ab'sé😀 \n\t́ <|>1") for _ in range(rng.randrange(300)))
                 for _ in range(5)]
        for text, ids in zip(texts, coder.encode(texts)):
            assert (len(ids) // 4,) == brute.encoding(tokenizer, text)[:1]
            assert ids == b"".join(
                i.to_bytes(4, "little") for i in tokenizer.encode(text, add_special_tokens=False).ids)


def test_passages_share_chunks():
    passage = " ".join(f"word{i * i % 1009}" for i in range(400))
    config = open(PATH, encoding="utf-8").read()
    coder = bpe.Coder(config)
    coder.encode(["Start here. " + passage])
    met, reused = coder.met, coder.reused
    coder.encode(["Another, longer beginning of it all: " + passage + " and an end."])
    assert coder.reused - reused >= 0.7 * (coder.met - met)


def test_borders_and_words_are_the_text(monkeypatch):
    """Borders lie in words too, never in letters; a word's parts are the word."""
    monkeypatch.setattr(bpe, "CHUNK", 16)
    rng = random.Random(1)
    inside = 0
    for _ in range(50):
        text = "".join(rng.choice("abc dé漢😀.,!'<\n") for _ in range(rng.randrange(4000)))
        data = text.encode()
        borders = bpe.content_borders(data).tolist()
        assert borders == sorted(set(borders)) and all(0 < one < len(data) for one in borders)
        assert "".join(data[a:b].decode() for a, b in zip([0, *borders], [*borders, len(data)])) == text
        inside += sum(data[one - 1:one + 1].isalpha() for one in borders)
        assert all(b"".join(bpe.word_parts(word)) == word for word in data.split())
    assert inside > 100


@pytest.mark.parametrize("text, border", [
    ("the international house", 9),  # in a word
    ("a café au lait", 5),  # in a letter of two bytes: moved to its start
    ("one, 'two' it's... 3", 14),  # between a letter and what goes with it
    ("end...more signs", 5), ("<|endoftext|> x", 6), ("supercalifragilistic", 7), ("a bc", 3),
])
def test_joins_are_repaired(monkeypatch, tokenizer, text, border):
    monkeypatch.setattr(bpe, "content_borders", lambda data: np.array([border] if border < len(data) else []))
    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    if not text.encode()[:border].decode("utf-8", "ignore").encode() == text.encode()[:border]:
        border -= 1
    got = np.frombuffer(coder.encode([text])[0], "<u4").tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids
    apart = [id for half in (text.encode()[:border], text.encode()[border:])
             for id in tokenizer.encode(half.decode(), add_special_tokens=False).ids]
    assert coder.repaired == 1 and apart != got


def test_words_that_hashes_confuse(tokenizer):
    """Thue-Morse words and their complements, in one block."""
    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    for size in (1024, 4096):
        signs = [bin(place).count("1") % 2 for place in range(size)]
        texts = ["".join("ab"[one ^ flip] for one in signs) for flip in (0, 1)]
        for text, ids in zip(texts, coder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_windows_are_encoded_together(monkeypatch, tokenizer):
    """A block of text costs few calls of the tokenizer, however many joins it has."""
    monkeypatch.setattr(bpe, "CHUNK", 64)
    rng = random.Random(5)
    text = " ".join(f"word{rng.randrange(10**6)}, it's" for _ in range(3000))
    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    calls = []
    packed = coder._packed
    monkeypatch.setattr(coder, "_packed", lambda texts: calls.append(len(texts)) or packed(texts))
    got = coder.encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert coder.repaired > 100 and len(calls) < coder.repaired / 3


def test_decodes_as_the_library(tokenizer):
    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    ids = np.random.default_rng(1).permutation(tokenizer.get_vocab_size()).astype("<u4")
    for some in (ids, ids[:1], ids[:0]):
        assert coder.decode(some.tobytes()) == tokenizer.decode(some.tolist(), skip_special_tokens=False)


def test_very_long_text(tokenizer):
    rng = random.Random(2)
    texts = [" ".join(f"Word{rng.randrange(10**6)}," for _ in range(100_000)), "x9" * 200_000]
    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    for text, ids in zip(texts, coder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_case_of_special_tokens(tokenizer):
    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    for text in ("<|ENDOFTEXT|> A", "<|endofTEXT|>", "x<|endoftext|>Y", "A<|EndOfText|>b " * 40):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == tokenizer.encode(
            text, add_special_tokens=False).ids


def test_refuses_other_tokenizers():
    config = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    with pytest.raises(ValueError):
        bpe.Coder(config)


def test_empty_and_other_columns(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, n_tokens int")
    assert bpe.encoded(docs, PATH).count() == 0
    docs = spark.createDataFrame([(None, "a b", 3), (None, "a b", 3)], docs.schema)
    rows = bpe.encoded(docs, PATH).collect()
    assert [(row["row"]["n_tokens"], row["n_tokens"]) for row in rows] == [(3, 2), (3, 2)]


def test_new_words_are_encoded_together(monkeypatch, tokenizer):
    """Words that are met for the first time cost one call for a block, and are cut where each ends."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdeéßx'-<|>/w7.,") for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    text = " ".join([*words, "<|endoftext|>", "a<|endoftext|>b", "</w>", "a</w>", "é\u0301", "É", "İ", "\u212b"])
    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    alone = []
    packed = coder._packed
    monkeypatch.setattr(coder, "_packed", lambda texts: alone.extend(texts) or packed(texts))
    assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == tokenizer.encode(
        text, add_special_tokens=False).ids
    assert len(alone) < 100


def test_bytes_that_do_not_fit_are_encoded_one_by_one(monkeypatch, tokenizer):
    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    coder.sizes = coder.sizes + 1  # as if tokens stood for other bytes
    text = "some words, and é more of them"
    assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == tokenizer.encode(
        text, add_special_tokens=False).ids


def test_little_is_encoded_at_once_and_kept(tokenizer):
    """Workers live on in later stages, so neither texts for the library nor what is kept may be large."""
    class Watched:
        longest = 0

        def encode_batch_fast(self, texts, **options):
            self.longest = max(self.longest, *(text.count(" ") for text in texts))
            return tokenizer.encode_batch_fast(texts, **options)

    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    coder.tokenizer = watched = Watched()
    for start in range(0, 400_000, 40_000):
        text = " ".join(f"w{number}" for number in range(start, start + 40_000))
        got = coder.encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert 0 < watched.longest <= 4 * bpe.PIECE <= 8000
    assert len(coder.words) + len(coder.older) <= 320_000
