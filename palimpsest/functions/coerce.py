"""The lenient converter: stored values to another kind after a schema drift."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, StringType, StructType

from palimpsest.functions.jsontext import NUMERIC, double_text

# The words that read as true and false.
TRUE_WORDS, FALSE_WORDS = ("true", "t", "1", "yes"), ("false", "f", "0", "no")
_RANGE = {"int64": (-(2**63), 2**63 - 1, "bigint"), "int8": (-128, 127, "tinyint")}
_ODD = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*\z"


def _text_to_double(s: Column) -> Column:
    trimmed = F.trim(F.regexp_replace(s, r"^\s+|\s+\z", ""))
    word = F.lower(F.regexp_replace(trimmed, r"^\+", ""))
    odd = F.when(word.endswith("nan"), float("nan")).when(word.startswith("-"), float("-inf")).otherwise(float("inf"))
    return F.when(s.rlike(NUMERIC), trimmed.try_cast("double")).when(s.rlike(_ODD), odd)


def _double_to_int(d: Column, kind: str) -> Column:
    low, high, sql = _RANGE[kind]
    whole = F.when(d < 0, F.ceil(d)).otherwise(F.floor(d))
    # 2**63 is a double; it and all above is out of range.
    inside = (d > float(low) - 1) & (d < float(high) + 1) if kind == "int8" else (d >= float(low)) & (d < 2.0**63)
    return F.when(inside & ~F.isnan(d), whole.try_cast(sql))


def coerced(value: Column, have: DataType, kind: str, element: str | None = None) -> Column:
    """``value``, a column of type ``have``, as ``kind``; what cannot be read as it becomes null.

    Text to int reads digits exactly and cuts other numbers towards zero; a bool is never a number.
    """
    text, boolean = isinstance(have, StringType), isinstance(have, BooleanType)
    real = isinstance(have, DoubleType | FloatType)
    box = isinstance(have, ArrayType | StructType)
    none = F.lit(None)
    if kind in ("string", "json"):
        if text:
            return value
        if box:
            return F.to_json(value)
        if boolean:
            return F.when(value, "True").when(~value, "False")
        return double_text(value.cast("double")) if real else value.cast("string")
    if kind in _RANGE:
        sql = _RANGE[kind][2]
        if boolean or box:
            return none.cast(sql)
        if text:
            digits = F.when(value.rlike(r"^\s*[+-]?\d+\s*\z"), F.regexp_replace(F.regexp_replace(value, r"\s", ""), r"^\+", ""))
            return F.when(digits.isNotNull(), digits.try_cast(sql)).otherwise(_double_to_int(_text_to_double(value), kind))
        return _double_to_int(value.cast("double"), kind) if real else value.try_cast(sql)
    if kind == "float64":
        if boolean or box:
            return none.cast("double")
        return _text_to_double(value) if text else value.cast("double")
    if kind == "bool":
        if boolean:
            return value
        if box:
            return none.cast("boolean")
        if text:
            word = F.lower(F.regexp_replace(value, r"^\s+|\s+\z", ""))
            return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
        return F.when(value == 1, True).when(value == 0, False)
    if kind == "array":
        from palimpsest.plans.schema import ColumnSpec

        sql = ColumnSpec("x", "array", element=element).data_type().simpleString()
        return value.cast(sql) if isinstance(have, ArrayType) else none.cast(sql)
    raise ValueError(f"unknown kind: {kind}")
