"""JSON text <-> string columns, with the reference decoder's rules for odd values.

The decoder is shaped for the common case. One ``from_json`` into a struct of
strings parses a record once and is all that a well-formed record needs. Only a
record with a missing field, or with a value that could be rendered JSON rather
than a string, is looked at again through a variant, which knows each value's type.

Conditions are written as SQL text: a decode mentions each field a dozen times,
and one parsed expression costs the driver far less than its parts put together
call by call, which a ten-second micro-batch would notice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.functions.once import computed_once

# Limits of the parser are lifted; nesting of more than 1,000 levels stays beyond it.
_STRICT_JSON = {
    "allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
    "maxStringLen": "2147483647", "maxNumLen": "2147483647",
}
NESTING_LIMIT = 1000
_REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"
_NULL_TEXT = {"literal": "'null'", "null": "CAST(NULL AS STRING)"}


def encode_object(fields: Sequence[str]) -> Column:
    """JSON object text of the named columns; null values are written as ``null``."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def is_object(text: Column) -> Column:
    """True for the text of a JSON object, false for all else (NULL included).

    The quick check refuses very long values, so what it refuses is parsed as a whole.
    """
    root = F.schema_of_variant(F.from_json(text, "variant", _STRICT_JSON))
    return F.json_object_keys(text).isNotNull() | F.coalesce(
        F.startswith(root, F.lit("OBJECT")), F.lit(False))


def parse_object(df: DataFrame, text: str, fields: Sequence[str]) -> DataFrame:
    """Add what :func:`field_text` and :func:`field_present` look at.

    A repeated key counts with its last value, here and in the variant; the session
    is told so unless it has its own setting.
    """
    conf = df.sparkSession.conf
    if conf.get(_REPEATED_KEYS, None) is None:
        conf.set(_REPEATED_KEYS, "true")
    schema = ", ".join(f"`{name}` string" for name in fields)
    values = F.from_json(F.col(text), schema, _STRICT_JSON)
    parsed = computed_once(df, values, [f"_value_{name}" for name in fields])

    odd = " OR ".join(
        f"_value_{name} IS NULL OR " + " OR ".join(
            f"startswith(_value_{name}, '{mark}')" for mark in '{["')
        for name in fields)
    # text that does not parse counts as an object without keys
    variants = F.from_json(
        F.col(text), ", ".join(f"`{name}` variant" for name in fields), _STRICT_JSON)
    none = F.struct(*[F.lit(None).cast("variant").alias(name) for name in fields])
    parsed = computed_once(
        parsed, F.struct(F.when(F.expr(odd), F.coalesce(variants, none)).alias("_variant")), ["_variant"])

    kinds = ", ".join(f"schema_of_variant(_variant.`{name}`)" for name in fields)
    return computed_once(
        parsed, F.expr(f"CASE WHEN _variant IS NOT NULL THEN struct({kinds}) END"),
        [f"_kind_{name}" for name in fields])


def field_present(name: str) -> Column:
    """Whether the key exists in the object, with any value, null included."""
    return F.expr(f"_variant IS NULL OR _kind_{name} IS NOT NULL")


def all_present(fields: Sequence[str]) -> Column:
    present = " AND ".join(f"_kind_{name} IS NOT NULL" for name in fields)
    return F.expr(f"_variant IS NULL OR ({present})")


def field_text(name: str, null_text: str = "literal") -> Column:
    """Text of one value: containers are empty, JSON null is ``"null"`` or SQL NULL.

    A number beyond double range is rendered by the parser inside quotes, which go.
    """
    if null_text not in _NULL_TEXT:
        raise ValueError(f"null_text must be one of {tuple(_NULL_TEXT)}")
    return F.expr(f"""CASE WHEN _kind_{name} IS NULL THEN _value_{name}
        WHEN _kind_{name} = 'VOID' THEN {_NULL_TEXT[null_text]}
        WHEN startswith(_kind_{name}, 'OBJECT') OR startswith(_kind_{name}, 'ARRAY') THEN ''
        WHEN _kind_{name} = 'DOUBLE' THEN translate(_value_{name}, '"', '')
        ELSE _value_{name} END""")
