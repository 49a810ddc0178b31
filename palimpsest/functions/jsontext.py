"""JSON text in string columns: literals that were quoted once too often, and text of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX, _HIGH, _LOW = "[0-9a-fA-F]", "[dD][89abAB]", "[dD][c-fC-F]"
_UNIT = rf"u(?!{_HIGH})(?!{_LOW}){_HEX}{{4}}|u{_HIGH}{_HEX}{{2}}\\u{_LOW}{_HEX}{{2}}"
_LITERAL = rf'([^"\\\x00-\x1f]|\\(["\\/bfnrt]|{_UNIT}))*'
#: A whole JSON string literal, blanks around it allowed; try_parse_json alone would let trailing text pass, and a lone surrogate cannot be decoded.
QUOTED = rf'^[ \t\r\n]*"{_LITERAL}"[ \t\r\n]*\z'
QUOTED_TIGHT = rf'^"{_LITERAL}"\z'
NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"


def is_quoted(text: Column, tight: bool = False) -> Column:
    """Whether a string holds one JSON string literal; null counts as no."""
    return F.coalesce(text.rlike(QUOTED_TIGHT if tight else QUOTED), F.lit(False))


def unquoted(text: Column) -> Column:
    """The literal's value; meant for rows where ``is_quoted`` holds."""
    return F.variant_get(F.try_parse_json(text), "$", "string")


def repaired(text: Column) -> Column:
    return F.when(is_quoted(text), unquoted(text)).otherwise(text)


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value; null counts as no.

    The parser lets text behind a value pass, so the value is parsed inside an array and inside an object: only a
    whole value stands both tests.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"a":'), text, F.lit("}")))
    one = F.schema_of_variant(listed).startswith("ARRAY") & F.try_variant_get(listed, "$[0]", "variant").isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.coalesce(one & named.isNotNull() & ~text.rlike(r"^\s*\z"), F.lit(False))


def json_or_quoted(text: Column) -> Column:
    """Text for a JSON column: a JSON value stays, other text becomes a JSON string."""
    listed = F.to_json(F.array(text))
    return F.when(text.isNull() | is_json(text), text).otherwise(listed.substr(F.lit(2), F.char_length(listed) - 2))


def double_text(x: Column) -> Column:
    """The shortest text of a double as JSON and Python write it: 10000000000.0, 1e+16, 1e-05."""
    size = F.abs(x)
    java = x.cast("string")
    plain = F.concat(F.regexp_replace(x.cast("decimal(38,20)").cast("string"), r"0+$", ""), F.lit(""))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.regexp_extract(java, r"^(.*)E", 1), r"\.0$", "")
    power = F.regexp_extract(java, r"E(-?\d+)$", 1)
    sign = F.when(power.startswith("-"), "-").otherwise("+")
    exponent = F.lpad(F.regexp_replace(power, "-", ""), 2, "0")
    exponent = F.when(F.char_length(F.regexp_replace(power, "-", "")) > 2, F.regexp_replace(power, "-", "")).otherwise(exponent)
    scientific = F.concat(mantissa, F.lit("e"), sign, exponent)
    odd = F.when(F.isnan(x), "nan").when(x > 0, "inf").otherwise("-inf")
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(x) | (size == float("inf")), odd)
        .when((size >= 1e16) | ((size > 0) & (size < 1e-4)), scientific)
        .when(java.contains("E"), plain)
        .otherwise(java)
    )
