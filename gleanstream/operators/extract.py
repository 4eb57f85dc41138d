"""Captured pages to listing rows.

Each field is described by a rule. One Arrow UDF evaluates all rules in a single
parse of the page and returns one list per field; the other columns of the page
never leave the JVM. Everything after that is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanstream.functions.once import computed_once
from gleanstream.functions.text import TRIM_CHARS, stamp
from gleanstream.operators.page_tree import PageTree
from gleanstream.schemas import (
    EXTRACTED_FIELDS, LISTINGS_PER_PAGE, MESSAGE_FIELDS, NO_SALARY,
)
from gleanstream.session import bound_batches

#: Characters of pages whose texts a task gives back at once; a longer page goes on its own.
PART_CHARS = 1 << 20


@dataclass(frozen=True)
class Rule:
    """How one field is found on a page.

    ``root``      element to look in; the first match, or the page if None
    ``items``     every match inside the root is one entry of the list
    ``path``      from the item on: (selector, n) picks the n-th match, step by step
    ``text``      ``full``: all text inside; ``own``: the element's own text, trimmed
    ``otherwise`` text to use if the path leads nowhere
    ``or_item``   if the path leads nowhere, take the whole item
    """

    field: str
    items: str
    root: str | None = None
    path: tuple[tuple[str, int], ...] = ()
    text: str = "full"
    otherwise: str | None = None
    or_item: bool = False


# --- fixed values: where the listing site keeps each field, and its next link ---
_LIST = "ul.css-zu9cdh.eu4oa1w0"
LISTING_RULES = (
    Rule("Job", "div.css-dekpa.e37uo190", _LIST, (("h2 a span", 0),)),
    Rule("Company", "div.company_location", _LIST, (("div div span", 0),)),
    Rule("Salary", "div.jobMetaDataGroup.css-pj786l.eu4oa1w0 div", _LIST,
         (("div[data-testid='attribute_snippet_testid']", 0),), otherwise=NO_SALARY),
    Rule("Location", "div.company_location.css-17fky0v.e37uo190", _LIST, (("div", 0), ("div", 1))),
    Rule("Deadline",
         "span[data-testid='myJobsStateDate'],span[data-testid='myJobsState']", _LIST, text="own"),
    Rule("JobDetails", "div.css-9446fg.eu4oa1w0", None, (("ul li", 0),), or_item=True),
)
NEXT_LINK = r"<a\b[^>]*\bdata-testid=['\"]pagination-page-next['\"]"
# --- end of fixed values ---


def _item_text(page: PageTree, item: int, rule: Rule, strict: bool) -> str | None:
    node = item
    for selector, nth in rule.path:
        found = page.nth(selector, node, nth)
        if found is None:
            if rule.or_item:
                node = item
                break
            if rule.otherwise is None and strict:
                raise ValueError(f"{rule.field}: {selector!r} has no match number {nth}")
            return rule.otherwise
        node = found
    return page.own_text(node).strip(TRIM_CHARS) if rule.text == "own" else page.full_text(node)


def _page_lists(html: str | None, rules: Sequence[Rule], block: str | None, strict: bool) -> dict:
    page = PageTree(html or "")
    if block:
        lists = {rule.field: [] for rule in rules}
        for node in page.select(block):
            for rule in rules:
                items = page.select(rule.items, node)
                lists[rule.field].append(
                    _item_text(page, items[0], rule, strict) if items else rule.otherwise
                )
        return lists
    lists = {}
    for rule in rules:
        scope = page.select(rule.root)[:1] if rule.root else [0]
        lists[rule.field] = [
            _item_text(page, item, rule, strict)
            for node in scope for item in page.select(rule.items, node)
        ]
    return lists


def _in_parts(
    batches: Iterator[pa.Array], rules: Sequence[Rule], block: str | None, strict: bool, made: pa.DataType,
) -> Iterator[pa.Array]:
    """The lists of all pages, given back every PART_CHARS of their text."""
    for pages in batches:
        lists, size = [], 0
        for page in pages:
            text = page.as_py()
            lists.append(_page_lists(text, rules, block, strict))
            size += len(text or "")
            if size >= PART_CHARS:
                yield pa.array(lists, made)
                lists, size = [], 0
        if lists:
            yield pa.array(lists, made)
        del pages, lists
        pa.default_memory_pool().release_unused()


def field_lists(
    html: Column, rules: Sequence[Rule] = LISTING_RULES,
    block: str | None = None, strict: bool = False,
) -> Column:
    """Struct with one list of texts per rule.

    With ``block`` every field is read inside its own listing block, so lists
    cannot drift apart. ``strict`` fails the job on an entry that has no text.
    """
    lists = T.ArrayType(T.StringType())
    result = T.StructType([T.StructField(rule.field, lists) for rule in rules])
    arrow = pa.struct([(rule.field, pa.list_(pa.string())) for rule in rules])
    rules = tuple(rules)

    @F.arrow_udf(result)
    def read_pages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _in_parts(batches, rules, block, strict, arrow)

    return read_pages(html)


def extract_lists(
    captures: DataFrame, rules: Sequence[Rule] = LISTING_RULES, html: str = "html",
    block: str | None = None, strict: bool = False,
) -> DataFrame:
    """Replace the page text by one list column per field."""
    bound_batches(captures.sparkSession)
    others = [name for name in captures.columns if name != html]
    fields = [rule.field for rule in rules]
    lists = field_lists(F.col(html), rules, block, strict)
    return computed_once(captures, lists, fields).select(*others, *fields)


def zip_fields(
    pages: DataFrame, fields: Sequence[str] = EXTRACTED_FIELDS, mode: str = "pad",
    position: str = "position",
) -> DataFrame:
    """Lists to rows by position; the first field's list sets how many.

    A longer list is cut. A shorter one gives NULLs (``pad``) or ends the job
    (``strict``).
    """
    if mode not in ("pad", "strict"):
        raise ValueError("mode must be 'pad' or 'strict'")
    lead, *rest = fields
    others = [name for name in pages.columns if name not in fields]
    rows = pages.select(*others, *rest, F.posexplode(lead).alias(position, lead))
    at = F.col(position)
    cells = [F.get(name, at) if mode == "pad" else F.element_at(name, at + 1) for name in rest]
    if mode == "strict":
        cells = [
            F.when(at < F.size(name), cell).otherwise(
                F.raise_error(F.lit(f"{name} has fewer entries than {lead}")).cast("string"))
            for name, cell in zip(rest, cells, strict=True)
        ]
    return rows.select(
        *others, position, lead,
        *[cell.alias(name) for name, cell in zip(rest, cells, strict=True)],
    )


def tag_keyword(rows: DataFrame, keyword: str | Column) -> DataFrame:
    value = F.lit(keyword) if isinstance(keyword, str) else keyword
    return rows.withColumn("SearchKeyWord", value)


def stamp_created(rows: DataFrame, captured_at: Column) -> DataFrame:
    """Capture time as text; one moment for all rows of a page."""
    return rows.withColumn("Created", stamp(captured_at))


def page_budget(captures: DataFrame, page_no: Column, pages: int) -> DataFrame:
    """The first ``pages`` result pages of a search, by their own ordinal from 0."""
    return captures.where(page_no < pages)


def has_next(html: Column, pattern: str = NEXT_LINK) -> Column:
    """Whether a page has a link to the next; a page without text has none."""
    return F.coalesce(html.rlike(pattern), F.lit(False))


def page_completeness(
    pages: DataFrame, fields: Sequence[str] = EXTRACTED_FIELDS,
    expected: int = LISTINGS_PER_PAGE, next_page: str = "has_next",
) -> DataFrame:
    """List sizes per page, and whether the page was read in full.

    The last page may be short; any other needs ``expected`` entries in every list. A
    page without any entry was not read, whether it was the last or not.
    """
    others = [name for name in pages.columns if name not in fields]
    sizes = [F.size(name).alias(f"n_{name}") for name in fields]
    counted = pages.select(*others, *sizes)
    fewest = F.least(*[F.col(f"n_{name}") for name in fields])
    most = F.greatest(*[F.col(f"n_{name}") for name in fields])
    more = F.coalesce(next_page, F.lit(False))
    return counted.withColumn("complete", (most > 0) & (~more | (fewest >= expected)))


def drop_recaptures(listings: DataFrame, created: str = "Created") -> DataFrame:
    """Listings seen again on a page captured twice: the earliest capture stays.

    All other columns must be equal, so leave out those that tell captures apart. Stamps
    are compared as numbers, which hash aggregation can hold. Text that is no stamp is not
    older or newer than any: it stays, once.
    """
    same = [name for name in listings.columns if name != created]
    stamped = F.col(created).rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")
    number = F.when(stamped, F.translate(created, "-: ", "").cast("bigint"))
    earliest = F.regexp_replace(
        F.lpad(F.col("_earliest").cast("string"), 14, "0"),
        r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)", "$1-$2-$3 $4:$5:$6")
    return (
        listings.withColumn("_other", F.when(~stamped, F.col(created)))
        .groupBy(*same, "_other").agg(F.min(number).alias("_earliest"))
        .withColumn(created, F.coalesce("_other", earliest)).select(*listings.columns)
    )


def extract_listings(
    captures: DataFrame, keyword: str | Column, captured_at: Column,
    rules: Sequence[Rule] = LISTING_RULES, keep: tuple[str, ...] = ("page_id",),
    zip_mode: str = "pad", block: str | None = None, strict: bool = False,
) -> DataFrame:
    """Captures to listing rows: ``keep``, ``position`` and the eight message fields.

    ``zip_mode='block'`` reads per listing block instead of zipping page lists.
    """
    if zip_mode == "block" and not block:
        raise ValueError("zip_mode='block' needs a block selector")
    stamped = stamp_created(captures, captured_at).withColumn(
        "SearchKeyWord", F.lit(keyword) if isinstance(keyword, str) else keyword)
    lists = extract_lists(
        stamped.select(*keep, "SearchKeyWord", "Created", "html"), rules,
        block=block if zip_mode == "block" else None, strict=strict,
    )
    rows = zip_fields(lists, [r.field for r in rules], "pad" if zip_mode == "block" else zip_mode)
    return rows.select(*keep, "position", *MESSAGE_FIELDS)
