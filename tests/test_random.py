"""Random inputs against plain models."""

import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from gleanstream.operators.decode import decode_postings
from gleanstream.operators.encode import encode_messages
from gleanstream.operators.page_tree import PageTree
from gleanstream.schemas import LISTING, MESSAGE_FIELDS, PUBLISHED
from gleanstream.sinks.snapshot import grid_export, read_grid

CHARS = "ab\"\\/{}[]:,' \t\n\r\x00\x1f\x7f é€😀 ﻿=+-@<>&"


def random_text(rng):
    return "".join(rng.choice(CHARS) for _ in range(rng.randrange(8)))


def random_value(rng, depth=0):
    kind = rng.randrange(10)
    if kind < 5:
        return random_text(rng)
    if kind == 5:
        return None
    if kind == 6:
        return rng.choice([True, False])
    if kind == 7:
        return rng.choice([0, -1, 7, 10**12, 10**25])
    if depth > 1:
        return []
    if kind == 8:
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {random_text(rng): random_value(rng, depth + 1) for _ in range(rng.randrange(3))}


def random_record(rng):
    fields = {name: random_value(rng) if rng.random() < 0.3 else random_text(rng)
              for name in MESSAGE_FIELDS}
    if rng.random() < 0.1:
        del fields[rng.choice(MESSAGE_FIELDS)]
    for _ in range(rng.randrange(3)):
        fields[random_text(rng)] = random_value(rng)
    names = list(fields)
    rng.shuffle(names)
    text = json.dumps({n: fields[n] for n in names}, ensure_ascii=rng.random() < 0.5)
    fault = rng.random()
    if fault < 0.05:
        return text[:rng.randrange(len(text))]
    if fault < 0.1:
        return rng.choice(["[%s]", "%s trailing", " %s ", "x%s", "%s}"]) % text
    return text


def as_text(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (dict, list)):
        return ""
    return str(value)


def model(text):
    """First JSON value of the text; eight nulls unless an object with all keys."""
    try:
        found, _ = json.JSONDecoder().raw_decode(text.lstrip(" "))
    except ValueError:
        return [None] * 8
    if not isinstance(found, dict) or any(name not in found for name in MESSAGE_FIELDS):
        return [None] * 8
    return [as_text(found[name]) for name in MESSAGE_FIELDS]


def test_decode_equals_model(spark):
    rng = random.Random(7)
    records = [(i, random_record(rng)) for i in range(5000)]
    frame = spark.createDataFrame(records, "id int, value string")
    got = {row[0]: list(row)[1:] for row in decode_postings(frame, keep=("id",)).collect()}
    wrong = [(text, got[i], model(text)) for i, text in records if got[i] != model(text)]
    assert not wrong, wrong[0]
    assert sum(row[0] is None for row in got.values()) > 200


def random_rows(rng, n, width):
    return [tuple(None if rng.random() < 0.1 else random_text(rng) for _ in range(width))
            for _ in range(n)]


def test_encode_decode_round_trip(spark):
    rows = random_rows(random.Random(8), 2000, 8)
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)],
                                  "id int, " + ", ".join(f"{n} string" for n in LISTING.names))
    decoded = decode_postings(encode_messages(frame, keep=("id",)), keep=("id",), null_text="null")
    assert {row[0]: tuple(row)[1:] for row in decoded.collect()} == dict(enumerate(rows))


def test_grid_round_trip(spark, tmp_path):
    rows = random_rows(random.Random(9), 500, 9)
    frame = spark.createDataFrame([(str(i), *row[1:]) for i, row in enumerate(rows)], PUBLISHED)
    grid_export(frame, str(tmp_path / "grid"), escape_formulas=False)
    back = read_grid(spark, str(tmp_path / "grid"))
    assert {row[0]: tuple(row)[1:] for row in back.collect()} == {
        str(i): tuple(cell or None for cell in row[1:]) for i, row in enumerate(rows)}


def test_formula_guard_touches_nothing_else(spark, tmp_path):
    rows = [("=1", "+1", "-1", "@a", "a=1", "'=1", "x", None, " =1")]
    grid_export(spark.createDataFrame(rows, PUBLISHED), str(tmp_path / "g"))
    back = tuple(read_grid(spark, str(tmp_path / "g")).first())
    assert back == ("'=1", "'+1", "'-1", "'@a", "a=1", "'=1", "x", None, " =1")


MARKUP = st.lists(st.one_of(
    st.sampled_from(["<p>", "</p>", "<div class='a b'>", "</div>", "<li>", "<ul>", "</ul>", "<b>",
                     "</b>", "<br>", "<script>", "</script>", "<!--", "-->", "<", ">", "</", "'", '"',
                     "<a href=\"", "&amp;", "&", "<td>", "<tr>", "<table>", "</table>", "<title>"]),
    st.text(max_size=3)), max_size=40).map("".join)


@settings(max_examples=400, deadline=None)
@given(MARKUP)
def test_any_markup_gives_a_tree(html):
    page = PageTree(html)
    count = len(page.tags)
    for node in range(1, count):
        parent = page.parent[node]
        assert 0 <= parent < node < page.end[node] <= page.end[parent]
        assert page.full_text(node) in page.full_text(parent)
    assert page.end[0] == count
    for node in page.select("div.a"):
        assert page.attrs(node)["class"].split() == ["a", "b"]
