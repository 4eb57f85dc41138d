"""What a cell's text means when it is typed into a sheet, as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIGITS = r"(?:(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?"
_NUMBER = rf"[+-]?{_DIGITS}|\({_DIGITS}\)"
_PERCENT = rf"[+-]?{_DIGITS} ?%|\({_DIGITS} ?%\)"
_CURRENCY = rf"[+-]?[$€£] ?{_DIGITS}|[$€£] ?[+-]{_DIGITS}|\([$€£] ?{_DIGITS}\)"
_DATE = r"(?:(\d{4})([-/])(\d{1,2})\2(\d{1,2})|(\d{1,2})/(\d{1,2})/(\d{4}))"
_TIME = r"(\d{1,2}:\d\d)(:\d\d)?"
_MOMENT = rf"^{_DATE}(?: {_TIME})?\z"
_NUMERIC = ("number", "percent", "currency")


def _is(text: Column, pattern: str) -> Column:
    return text.rlike(rf"^(?:{pattern})\z")


def _moment(text: Column) -> Column:
    """Year first with ``-`` or ``/``, or month, day and year with ``/``; NULL if there is no such day."""
    part = [F.lit(None)] + [F.nullif(F.regexp_extract(text, _MOMENT, n), F.lit("")) for n in range(1, 10)]
    day = F.concat_ws("-", F.coalesce(part[1], part[7]), F.coalesce(part[3], part[5]), F.coalesce(part[4], part[6]))
    time = F.concat(F.coalesce(part[8], F.lit("00:00")), F.coalesce(part[9], F.lit(":00")))
    return F.when(text.rlike(_MOMENT), F.concat(day, F.lit(" "), time).try_cast("timestamp_ntz"))


def typed_cell(cell: Column) -> Column:
    """A cell as ``struct<kind, number, flag, moment, text>``; the field of its kind is set.

    Kinds: ``blank`` (NULL, empty, only blanks), ``boolean`` (true or false in either case), ``number`` (with or
    without thousands separators, an exponent; brackets for minus), ``percent`` (its number is the
    hundredth part), ``currency`` ($, € or £ before the digits), ``date`` and ``datetime`` (both as
    ``moment``), and ``text``: anything else, as it is. A leading apostrophe makes a cell text and is taken
    away. Separators in the wrong places, days that do not exist and numbers that a double cannot
    hold are text. A formula is text too: it is never computed.
    """
    trimmed = F.btrim(cell)
    quoted = trimmed.startswith("'")
    bare = F.regexp_replace(trimmed, r"[,$€£%() +]", "")
    size = bare.try_cast("double")
    size = F.when(trimmed.startswith("("), -size).otherwise(size)
    whole = F.abs(size) < float("inf")
    moment = _moment(trimmed)
    kind = (
        F.when(F.coalesce(trimmed, F.lit("")) == "", "blank")
        .when(quoted, "text")
        .when(F.lower(trimmed).isin("true", "false"), "boolean")
        .when(_is(trimmed, _NUMBER) & whole, "number")
        .when(_is(trimmed, _PERCENT) & whole, "percent")
        .when(_is(trimmed, _CURRENCY) & whole, "currency")
        .when(moment.isNotNull(), F.when(trimmed.contains(":"), "datetime").otherwise("date"))
        .otherwise("text"))
    return F.struct(
        kind.alias("kind"),
        F.when(kind == "percent", size / 100).when(kind.isin(*_NUMERIC), size).alias("number"),
        F.when(kind == "boolean", F.lower(trimmed) == "true").alias("flag"),
        F.when(kind.isin("date", "datetime"), moment).alias("moment"),
        F.when(kind == "text", F.when(quoted, F.substr(trimmed, F.lit(2))).otherwise(cell)).alias("text"))


def typed_cells(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as typed cells; the others stay."""
    return rows.withColumns({name: typed_cell(F.col(name)) for name in columns})


def column_kinds(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, kind, n_cells`` (not blank): the one kind that all cells of a column share.

    Dates and datetimes together are ``datetime``; numbers, percents and amounts together are
    ``number``; other mixtures are ``text``; a column without cells is ``blank``. One pass; a few
    counts a task are shuffled.
    """
    kinds = ("boolean", "number", "percent", "currency", "date", "datetime", "text")
    found = rows.select(*[typed_cell(F.col(name))["kind"].alias(f"k{n}") for n, name in enumerate(columns)])
    counts = found.agg(*[
        F.count_if(F.col(f"k{n}") == kind).alias(f"k{n}_{kind}") for n in range(len(columns)) for kind in kinds])
    one = F.array(*[
        F.struct(F.lit(name).alias("column"), *[F.col(f"k{n}_{kind}").alias(kind) for kind in kinds])
        for n, name in enumerate(columns)])
    each = counts.select(F.inline(one))

    def total(names):
        return reduce(lambda a, b: a + b, [F.col(name) for name in names])

    cells = total(kinds)
    shared = F.when(cells == 0, "blank")
    for kind in kinds:
        shared = shared.when(F.col(kind) == cells, kind)
    shared = shared.when(total(_NUMERIC) == cells, "number").when(total(("date", "datetime")) == cells, "datetime")
    return each.select("column", shared.otherwise("text").alias("kind"), cells.alias("n_cells"))
