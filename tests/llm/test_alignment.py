import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import alignments
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from gleanstream.llm import alignment, queries

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def aligner():
    with open(A, encoding="utf-8") as config, open(B, "rb") as model:
        return alignment.Aligner(config.read(), model.read())


@pytest.fixture(scope="module")
def plain():
    """The libraries' own encoders, and the bytes of their ids."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    alphabet = alignment.byte_alphabet()
    second = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(number):
        text = second.id_to_piece(number)
        return bytes([int(text[3:5], 16)]) if second.is_byte(number) else text.replace("▁", " ").encode()

    return (lambda text: first.encode(text, add_special_tokens=False).ids,
            lambda text: second.encode(text, num_threads=1),
            lambda number: bytes(alphabet[char] for char in first.id_to_token(number)), piece)


def odd_texts():
    random.seed(6)
    signs = "abc'stll  \n\té߀١²Ⅷ漢字🙂́\x00\x85　 ﬁ.,|<0x"
    return [None, "", " ", "<|endoftext|> x", "<s> </s> <unk> <0x41>", "▁ x", "\r\n", "ﬁ", *(
        "".join(random.choices(signs, k=random.randint(1, 40))) for _ in range(400))]


def test_byte_pairs_are_the_librarys(aligner, plain):
    assert alignment.PATTERN == public_tokenizers.PATTERN
    for text in odd_texts()[1:]:
        assert aligner.a.encode(text).tolist() == plain[0](text), repr(text)


def test_cuts_of_all_kinds():
    random.seed(1)
    for _ in range(2000):
        size = random.randint(1, 60)
        ends = [sorted({*random.sample(range(1, size + 1), random.randint(0, size)), size}) for _ in "ab"]
        if random.random() < 0.3:
            ends[1] = ends[0]
        common = sorted(set(ends[0]) & set(ends[1]))
        cuts = alignment.cut(*ends)
        assert [ends[0][i - 1] for i in cuts[0]] == common == [ends[1][j - 1] for j in cuts[1]]


@pytest.mark.parametrize("first", [1, 3, 8])
def test_cuts_of_long_runs(monkeypatch, first):
    """Runs shorter and longer than the first slice, irregular groups at the begin and end or nowhere."""
    monkeypatch.setattr(alignment, "FIRST_SLICE", first)
    for length in (*range(1, 20), 1000, 1024, 1025):
        run = list(range(3, 3 + length))
        end = run[-1] + 3
        for extra in ([], [end]):
            for ends in ((run + extra, run + extra), ([1, *run, *extra], [2, *run, *extra]),
                         ([*run, run[-1] + 1, end], [*run, run[-1] + 2, end]), ([1, *run], [2, *run])):
                common = sorted(set(ends[0]) & set(ends[1]))
                cuts = alignment.cut(*ends)
                assert [ends[0][i - 1] for i in cuts[0]] == common == [ends[1][j - 1] for j in cuts[1]]


def test_joined_parts():
    parts = alignment.pa.array([b"a", b"", "é".encode(), b"xyz"], alignment.pa.large_binary())
    assert alignment.joined(parts, np.array([3, 1, 2, 0, 3])) == "xyzéaxyz".encode()
    assert alignment.joined(parts, np.array([1])) == alignment.joined(parts, np.array([], np.int64)) == b""


def test_large_groups_are_counted_by_ids():
    a, b = np.arange(300) % 7, np.arange(200) % 5
    pairs, times = alignment.linked_pairs(a, b, np.array([1, 300]), np.array([1, 200]), 10)
    want = {}
    for x, y in [(0, 0), *((x, y) for x in a[1:].tolist() for y in b[1:].tolist())]:
        want[10 * x + y] = want.get(10 * x + y, 0) + 1
    assert dict(zip(pairs.tolist(), times.tolist())) == want and pairs.tolist() == sorted(want)


@pytest.mark.parametrize("frequent", [1, 40, 1 << 19])
def test_odd_rows_against_plain(spark, plain, frequent):
    """Whatever share of the pairs is frequent, the counts are the same."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        *(T.StructField(name, T.IntegerType()) for name in ("n_a", "row", "place", "a.b", "my col"))])
    texts = odd_texts() + ["the end of the day"] * 5 + ["é" * 3000]
    docs = spark.createDataFrame([(n % 7 or None, text, 1, 2, 3, 4, n) for n, text in enumerate(texts)], schema)
    rows = alignment.aligned(docs, A, B).select(
        F.col("row")["my col"].alias("n"), "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times")
    got = alignment.with_corpus_counts(rows, 32000, frequent).collect()
    want = alignments(texts, *plain)
    for row in got:
        assert tuple(row[name] for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")) == \
            want[row["n"]][:6], repr(texts[row["n"]])
        assert (row["groups"] or "") == want[row["n"]][6]
    assert len(got) == len(texts) and sum(one[0] == 0 for one in want) >= 3
    empty = alignment.aligned(docs.limit(0), A, B).select("pairs", "times", "n_a")
    assert alignment.with_corpus_counts(empty, 32000).count() == 0


def test_very_long_text(aligner, plain):
    text = " ".join(f"word{i % 977} 漢{i}" for i in range(60_000))
    row = next(aligner.align([text]))
    a, b = plain[0](" " + text), plain[1](text)
    assert row[:2] == (len(a), len(b)) and row[3] == sum(row[6])
    assert row[4].count(";") == row[2] - 1


def test_query_against_plain(spark, sf, plain):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = alignments([text for _, text in docs], *plain)
    rows = {row["doc_id"]: row for row in queries.op11_token_alignment(spark, sf).collect()}
    assert len(rows) == len(docs)
    for (ident, _), one in zip(docs, want, strict=True):
        digest = hashlib.sha256(one[6].encode()).hexdigest() if one[6] else ""
        assert tuple(rows[ident])[1:] == (*one[:6], digest)
