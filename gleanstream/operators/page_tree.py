"""A tolerant page tree and the few CSS selectors the extraction rules use.

Runs inside Arrow tasks, one page at a time. Real pages are rarely well-formed, so
nothing here ever fails on markup. Most of a page is never asked for, so the tree
only notes where attributes and texts are, and decodes them on demand.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from itertools import islice

# Fixed values of the HTML standard: elements without content, and elements
# whose start tag ends an open element of the given names.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK_TAGS = frozenset(
    "address article aside blockquote body details div dl fieldset figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table td th tr ul".split()
)
ENDED_BY_START = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    **{tag: ("p",) for tag in (
        "address article aside blockquote details div dl fieldset figure footer form "
        "h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
    )},
}
# An open element is not ended from inside one of these.
SCOPE_TAGS = frozenset("html body table td th ul ol dl div article section nav".split())

# Elements whose content is text only; character references count in the second kind.
RAW_TAGS = frozenset(("script", "style"))
TEXT_TAGS = RAW_TAGS | {"title", "textarea"}

# One step over markup. A tag always matches, up to the end of the page if need be,
# so no position is scanned twice.
_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))
    | <[!?][^>]*+(?:>|\Z)
    | </(?:>|[^a-zA-Z>][^>]*+(?:>|\Z))
    | <(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)
      (?P<attrs>(?:[\s/]++
        | [^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+|(?=>)))?
      )*+)
      (?P<done>>|\Z)""",
    re.DOTALL | re.VERBOSE,
)
_ATTRIBUTE = re.compile(
    r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>"'][^\s>]*)|))?"""
)
_TEXT_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in TEXT_TAGS}

_COMPOUND = re.compile(r"(?P<tag>[\w-]+)?(?P<rest>(?:\.[\w-]+|\[[^\]]+\])*)")
_PART = re.compile(r"\.([\w-]+)|\[([\w-]+)=['\"]?([^'\"\]]*)['\"]?\]")


class PageTree:
    """Elements in document order, so the inside of an element is one index range."""

    def __init__(self, html: str):
        if "\r" in html:
            html = html.replace("\r\n", "\n").replace("\r", "\n")
        self.html = html
        self.tags = ["#page"]
        self.parent = [-1]
        self.end = [0]
        self.first_text = [0]
        self.last_text = [0]
        self.by_tag: dict[str, list[int]] = {}
        self._texts: list[tuple[int, int, int]] = []
        self._attr_text = [""]
        self._attrs: dict[int, dict[str, str]] = {}
        self._paths: dict[tuple, tuple[list[int], list[int]]] = {}
        self._owned: dict[int, list[tuple[int, int, int]]] | None = None
        self._open = [0]
        self._open_tags = {"#page": 1}
        self._read()
        self._pop_through(0)

    def _read(self) -> None:
        html, at = self.html, 0
        while (token := _TOKEN.search(html, at)) is not None:
            start = token.start()
            if start > at:
                self._texts.append((self._open[-1], at, start))
            at = token.end()
            tag = token["tag"]
            if tag is None or not token["done"]:
                continue
            tag = tag.lower()
            if token["close"]:
                self._end_tag(tag)
                continue
            self._start_tag(tag, token["attrs"])
            if tag in TEXT_TAGS:
                stop = _TEXT_END[tag].search(html, at)
                stop = stop.start() if stop else len(html)
                if stop > at:
                    self._texts.append((self._open[-1], at, stop))
                at = stop
        if at < len(html):
            self._texts.append((self._open[-1], at, len(html)))

    def _pop_through(self, depth: int) -> None:
        while len(self._open) > depth:
            node = self._open.pop()
            self._open_tags[self.tags[node]] -= 1
            self.end[node] = len(self.tags)
            self.last_text[node] = len(self._texts)

    def _none_open(self, tags) -> bool:
        for tag in tags:
            if self._open_tags.get(tag):
                return False
        return True

    def _start_tag(self, tag: str, attr_text: str) -> None:
        ended = ENDED_BY_START.get(tag, ())
        if not self._none_open(ended):
            for depth in range(len(self._open) - 1, 0, -1):
                name = self.tags[self._open[depth]]
                if name in ended:
                    self._pop_through(depth)
                    break
                if name in SCOPE_TAGS:
                    break
        node = len(self.tags)
        self.tags.append(tag)
        self._attr_text.append(attr_text)
        self.parent.append(self._open[-1])
        self.end.append(node + 1)
        self.first_text.append(len(self._texts))
        self.last_text.append(len(self._texts))
        self.by_tag.setdefault(tag, []).append(node)
        if tag not in VOID_TAGS:
            self._open.append(node)
            self._open_tags[tag] = self._open_tags.get(tag, 0) + 1

    def _end_tag(self, tag: str) -> None:
        if not self._open_tags.get(tag):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            name = self.tags[self._open[depth]]
            if name == tag:
                self._pop_through(depth)
                return
            if name in BLOCK_TAGS and tag not in BLOCK_TAGS:
                return

    def attrs(self, node: int) -> dict[str, str]:
        """Attributes by lower-case name; the first of a repeated one counts."""
        found = self._attrs.get(node)
        if found is None:
            found = self._attrs[node] = {}
            for name, *values in _ATTRIBUTE.findall(self._attr_text[node]):
                found.setdefault(name.lower(), unescape("".join(values)))
        return found

    def _text(self, owner: int, start: int, stop: int) -> str:
        text = self.html[start:stop]
        return text if "&" not in text or self.tags[owner] in RAW_TAGS else unescape(text)

    def _inside(self, node: int) -> list[tuple[int, int, int]]:
        return self._texts[self.first_text[node]:self.last_text[node]]

    def full_text(self, node: int) -> str:
        return "".join([self._text(*part) for part in self._inside(node)])

    def own_text(self, node: int) -> str:
        if self._owned is None:
            self._owned = {}
            for part in self._texts:
                self._owned.setdefault(part[0], []).append(part)
        return "".join([self._text(*part) for part in self._owned.get(node, ())])

    def _fits(self, node: int, compound) -> bool:
        tag, classes, wanted = compound
        if tag and self.tags[node] != tag:
            return False
        if not classes and not wanted:
            return True
        attrs = self.attrs(node)
        if classes and not classes.issubset(attrs.get("class", "").split()):
            return False
        return all(attrs.get(name) == value for name, value in wanted)

    def _nearest(self, node: int, compound, known: dict[int, int]) -> int:
        """The nearest element above ``node`` that fits; -1 if none. ``known`` saves the way."""
        trail = []
        at = self.parent[node]
        while at >= 0 and at not in known:
            if self._fits(at, compound):
                known[at] = at
                break
            trail.append(at)
            at = self.parent[at]
        found = known[at] if at >= 0 else -1
        for passed in trail:
            known[passed] = found
        return found

    def _path_matches(self, path) -> tuple[list[int], list[int]]:
        """Elements that a path leads to on the whole page, and where each path starts at the latest.

        Of all ways to match an element's ancestors, the one that takes the nearest each
        time starts deepest, so an element matches inside a scope if that start lies in it.
        """
        found = self._paths.get(path)
        if found is None:
            tag = path[-1][0]
            nodes, starts = [], []
            known: list[dict[int, int]] = [{} for _ in path]
            for node in self.by_tag.get(tag, []) if tag else range(1, len(self.tags)):
                if not self._fits(node, path[-1]):
                    continue
                at = node
                for part in range(len(path) - 2, -1, -1):
                    at = self._nearest(at, path[part], known[part])
                    if at < 0:
                        break
                if at >= 0:
                    nodes.append(node)
                    starts.append(at)
            found = self._paths[path] = nodes, starts
        return found

    def _path_select(self, path, scope: int) -> Iterator[int]:
        nodes, starts = self._path_matches(path)
        for at in range(bisect_left(nodes, scope + 1), bisect_left(nodes, self.end[scope])):
            if starts[at] >= scope:
                yield nodes[at]

    def select(self, selector: str, scope: int = 0) -> list[int]:
        """Matching elements inside ``scope``, in document order.

        Ancestors named by the selector are looked for up to ``scope`` itself.
        """
        paths = parse_selector(selector)
        if len(paths) == 1:
            return list(self._path_select(paths[0], scope))
        return sorted({node for path in paths for node in self._path_select(path, scope)})

    def nth(self, selector: str, scope: int, number: int) -> int | None:
        """The match of that number from 0, without looking for the ones after it."""
        paths = parse_selector(selector)
        found = self._path_select(paths[0], scope) if len(paths) == 1 else self.select(selector, scope)
        return next(islice(found, number, None), None)


@lru_cache(maxsize=1024)
def parse_selector(selector: str):
    """``"div.a span[x='y'], b"`` to alternatives of descendant paths."""
    alternatives = []
    for one in selector.split(","):
        path = []
        for word in one.split():
            shape = _COMPOUND.fullmatch(word)
            if not shape:
                raise ValueError(f"unsupported selector: {word!r}")
            parts = _PART.findall(shape["rest"] or "")
            path.append((
                shape["tag"],
                frozenset(cls for cls, _, _ in parts if cls),
                tuple((name, value) for _, name, value in parts if name),
            ))
        if not path:
            raise ValueError(f"empty selector in {selector!r}")
        alternatives.append(tuple(path))
    return tuple(alternatives)
