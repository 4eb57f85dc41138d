"""Cells as a sheet takes them when they are typed."""

from datetime import datetime

from pyspark.sql import functions as F

from gleanstream.functions.cells import column_kinds, typed_cell, typed_cells

CASES = {
    None: ("blank", None), "": ("blank", None), "  ": ("blank", None),
    "TRUE": ("boolean", True), "false": ("boolean", False), "yes": ("text", "yes"),
    "12": ("number", 12.0), " -1,234.50 ": ("number", -1234.5), "+7": ("number", 7.0), ".5": ("number", 0.5),
    "1.": ("number", 1.0), "1e3": ("number", 1000.0), "(1,200)": ("number", -1200.0), "007": ("number", 7.0),
    "1,23": ("text", "1,23"), "1,2345": ("text", "1,2345"), "1 2": ("text", "1 2"), "1e999": ("text", "1e999"),
    "--1": ("text", "--1"), "(-1)": ("text", "(-1)"), "e3": ("text", "e3"), "NaN": ("text", "NaN"), "Infinity": ("text", "Infinity"),
    "12%": ("percent", 0.12), "(5 %)": ("percent", -0.05), "%": ("text", "%"),
    "$1,234.50": ("currency", 1234.5), "-$3": ("currency", -3.0), "€ -4": ("currency", -4.0), "(£5)": ("currency", -5.0),
    "-$-3": ("text", "-$-3"), "$": ("text", "$"), "$80,000 a year": ("text", "$80,000 a year"),
    "2024-02-09": ("date", datetime(2024, 2, 9)), "2024/2/9": ("date", datetime(2024, 2, 9)),
    "2/9/2024": ("date", datetime(2024, 2, 9)), "2024-02-30": ("text", "2024-02-30"), "2024-2/9": ("text", "2024-2/9"),
    "13/1/2024": ("text", "13/1/2024"), "2024-02-09 8:05": ("datetime", datetime(2024, 2, 9, 8, 5)),
    "2024-02-09 23:59:58": ("datetime", datetime(2024, 2, 9, 23, 59, 58)), "2024-02-09 24:00": ("text", "2024-02-09 24:00"),
    "'007": ("text", "007"), "'": ("text", ""), "=1+2": ("text", "=1+2"), "x" * 100_000: ("text", "x" * 100_000),
    "1\n2": ("text", "1\n2"), "12\n": ("text", "12\n"),
}


def test_kinds_and_values(spark):
    rows = spark.createDataFrame([(text,) for text in CASES], "cell string")
    got = {}
    for row in rows.select("cell", typed_cell(F.col("cell")).alias("typed")).collect():
        typed = row["typed"]
        values = [typed[name] for name in ("number", "flag", "moment", "text") if typed[name] is not None]
        assert len(values) == (typed["kind"] != "blank")
        got[row["cell"]] = (typed["kind"], values[0] if values else None)
    assert got == CASES


def test_columns(spark):
    rows = spark.createDataFrame(
        [("1", "2024-01-01", "1", None, "k"), ("$2", "2024-01-01 10:00", "x", "", None), (None, None, "TRUE", " ", "k")],
        "a string, b string, c string, d string, e string")
    got = {r["column"]: (r["kind"], r["n_cells"]) for r in column_kinds(rows, rows.columns).collect()}
    assert got == {"a": ("number", 2), "b": ("datetime", 2), "c": ("text", 3), "d": ("blank", 0), "e": ("text", 2)}
    typed = typed_cells(rows, ["a"])
    assert typed.columns == rows.columns and typed.schema["b"].dataType.simpleString() == "string"
    assert {r["kind"] for r in column_kinds(rows.limit(0), rows.columns).collect()} == {"blank"}
    assert "Python" not in typed._jdf.queryExecution().toString()


def test_snapshot_with_typed_salaries(spark):
    from gleanstream.schemas import PUBLISHED
    from gleanstream.sinks.snapshot import typed_snapshot

    row = {name: "x" for name in PUBLISHED.names} | {"Salary": "$1,000", "Created": "2024-01-01 00:00:00"}
    typed = typed_snapshot(spark.createDataFrame([tuple(row.values())], PUBLISHED), ["Salary"]).first()
    assert (typed["Salary"]["kind"], typed["Salary"]["number"], typed["Job"]) == ("currency", 1000.0, "x")
    assert typed["Created"] == datetime(2024, 1, 1) and typed["QueryAt"] is None
