"""The page tree against browser behaviour, and against the stdlib tokenizer on real pages."""

import random
import time
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from gleanstream.operators.extract import LISTING_RULES, _page_lists
from gleanstream.operators.page_tree import PageTree, parse_selector


def texts(html, selector):
    page = PageTree(html)
    return [page.full_text(node) for node in page.select(selector)]


@pytest.mark.parametrize("html, selector, want", [
    ("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>", "li", ["abc", "b", "c", "d"]),
    ("<p>one<p>two<div>x</div>", "p", ["one", "two"]),
    ("<b>x<div>y</b>z</div>", "div", ["yz"]),
    ("<div/><span>q</span>", "div span", ["q"]),
    ("<div>a<br>b<img src=x>c</div>d", "div", ["abc"]),
    ("<div>a</i></p>b</div>", "div", ["ab"]),
    ("<DIV Class='A'>x</Div >y", "div.A", ["x"]),
    ("<script>if(a<b){'</p>'}</script><p>k", "p", ["k"]),
    ("<script>a&amp;b</script>", "script", ["a&amp;b"]),
    ("<title>a&lt;<b></title>", "title", ["a<<b>"]),
    ("<p>a &lt; b &copy; &unknown; &#233;", "p", ["a < b © &unknown; é"]),
    ("<p>a < b <3</p>", "p", ["a < b <3"]),
    ("<p>x&amp</p>&copy", "p", ["x&"]),
    ("<p>a<!-- <p>no --><!-->b", "p", ["ab"]),
    ("<p>a\r\nb\rc", "p", ["a\nb\nc"]),
    ("<p>x<a href='y", "p", ["x"]),
    ('<a title="<p>">t</a>', "p", []),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "td", ["1", "2", "3"]),
])
def test_structure(html, selector, want):
    assert texts(html, selector) == want


@pytest.mark.parametrize("selector, want", [
    ("div.a.b", ["1"]), ("div.a", ["1", "2"]), (".b", ["1", "3"]), ("span[data-x='q']", ["4"]),
    ("span[data-x=q], .b", ["1", "3", "4"]), ("section .b", ["3"]), ("div span", []),
])
def test_selectors(selector, want):
    html = ('<div class="a b">1</div><div class="x a">2</div>'
            '<section><p class="b">3</p></section><span data-x="q">4</span>')
    assert texts(html, selector) == want


def test_selector_scope_counts_itself_but_nothing_above():
    page = PageTree("<div id=o><section><p><span>x</span></p></section></div>")
    section, = page.select("section")
    assert page.select("section span", section) and not page.select("div span", section)


def test_own_text_leaves_out_children():
    page = PageTree("<span>a<b>no</b>c</span>")
    assert page.own_text(page.select("span")[0]) == "ac"


def test_first_of_repeated_attributes():
    page = PageTree("<a X='1' x=2 y>t</a>")
    assert page.attrs(1) == {"x": "1", "y": ""}


@pytest.mark.parametrize("html", ["", "<", "</", "<a", "<a b='", "<!--", "<!", "</>", "\0", "<p" * 50])
def test_any_text_is_a_page(html):
    PageTree(html)


def test_unsupported_selector():
    for selector in ("a > b", "", "p:first-child"):
        with pytest.raises(ValueError):
            parse_selector(selector)


def test_deep_nesting_is_not_quadratic():
    page = PageTree("<b>" * 50_000 + "</i>" * 50_000 + "x")
    assert page.full_text(1) == "x"


class _Stdlib(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.text = [], []

    def handle_starttag(self, tag, attrs):
        self.tags.append((tag, {name: value or "" for name, value in attrs}))

    def handle_data(self, data):
        self.text.append(data)


def test_same_tags_and_text_as_the_stdlib(sf):
    for html in pq.read_table(f"{sf}/pages.parquet")["html"].to_pylist():
        other = _Stdlib()
        other.feed(html)
        other.close()
        page = PageTree(html)
        got = [(page.tags[i], page.attrs(i)) for i in range(1, len(page.tags))]
        assert got == other.tags
        assert page.full_text(0) == "".join(other.text)


@pytest.mark.parametrize("attributes", ["", ' class="jobMetaDataGroup css-pj786l eu4oa1w0"',
                                        ' class="company_location css-17fky0v e37uo190"'])
def test_matching_does_not_grow_with_depth(attributes):
    """All listing rules on 50,000 unclosed elements; climbing from each would take hours."""
    html = '<ul class="css-zu9cdh eu4oa1w0"><li>' + f"<div{attributes}>" * 50_000
    began = time.perf_counter()
    lists = _page_lists(html, LISTING_RULES, None, False)
    assert time.perf_counter() - began < 5
    assert len(lists["Salary"]) == (49_999 if "jobMeta" in attributes else 0)


def test_scoped_paths_against_climbing():
    rng = random.Random(3)

    def climbed(page, path, node, scope):
        if not page._fits(node, path[-1]):
            return False
        at, left = node, len(path) - 1
        while left and at != scope:
            at = page.parent[at]
            if page._fits(at, path[left - 1]):
                left -= 1
        return not left

    for _ in range(60):
        page = PageTree("".join(rng.choice(["<a>", "<b class=x>", "<i>", "</a>", "</b>", "<b>", "t"])
                                for _ in range(60)))
        for selector in ("a", "a b", "b.x b", "a i b", ".x a", "a b,i b"):
            for scope in range(len(page.tags)):
                want = [node for node in range(scope + 1, page.end[scope]) if any(
                    climbed(page, path, node, scope) for path in parse_selector(selector))]
                assert page.select(selector, scope) == want
                assert page.nth(selector, scope, 1) == (want[1] if len(want) > 1 else None)
