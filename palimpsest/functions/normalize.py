"""The strict converter: a field of a document's JSON text to a column of its table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.plans.schema import ColumnSpec


def field_path(name: str) -> str:
    """The JSON path of a top-level field."""
    if "'" in name or "\\" in name:
        raise ValueError(f"field name cannot be put in a path: {name!r}")
    return f"$['{name}']"


def ascii_json(text: Column) -> Column:
    """JSON text with characters beyond ASCII escaped, as ``json.dumps`` writes them (UTF-16 units)."""
    unit = lambda code: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    def one(c: Column) -> Column:
        # UTF-32 bytes of the character give its code point, which Spark's ascii() gives for the first unit only.
        code = F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10).cast("long")
        high = unit(F.lit(0xD800) + F.shiftright(code - 0x10000, 10))
        low = unit(F.lit(0xDC00) + (code - 0x10000).bitwiseAND(F.lit(0x3FF)))
        return F.when(code < 0x80, c).when(code < 0x10000, unit(code)).otherwise(F.concat(high, low))

    escaped = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c == "", c).otherwise(one(c))), "")
    return F.when(text.rlike(r"[^\x00-\x7f]"), escaped).otherwise(text)


def normalized(doc: Column, spec: ColumnSpec, name: str | None = None, ascii_only: bool = True) -> Column:
    """Field ``name`` (the column's own name if None) of JSON text ``doc`` as ``spec.kind``.

    Strict: no text is read as a number, no number as a bool; what does not fit is null. Strings stay as they are;
    objects and arrays in text kinds are compact JSON. Numbers keep the text that JSON writers of doubles use.
    """
    path = field_path(name or spec.name)
    value = F.try_variant_get(F.try_parse_json(doc), path, "variant")
    kind = F.schema_of_variant(value)
    raw = F.get_json_object(doc, path)
    text, boolean = kind == "STRING", kind == "BOOLEAN"
    box = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    if spec.kind in ("string", "json"):
        flag = F.try_variant_get(value, "$", "boolean")
        yes, no = ("True", "False") if spec.kind == "string" else ("true", "false")
        out = F.when(text, F.try_variant_get(value, "$", "string"))
        out = out.when(box, ascii_json(raw) if ascii_only else raw)
        return out.when(boolean, F.when(flag, yes).otherwise(no)).when(number, raw)
    if spec.kind in ("int64", "int8"):
        sql = "bigint" if spec.kind == "int64" else "tinyint"
        real = F.try_variant_get(value, "$", "double")
        whole = F.when(kind == "BIGINT", F.try_variant_get(value, "$", "bigint"))
        whole = whole.when(number & (real == F.floor(real)) & (F.abs(real) < 2.0**63), real.try_cast("bigint"))
        return whole.try_cast(sql)
    if spec.kind == "float64":
        return F.when(number, F.try_variant_get(value, "$", "double"))
    if spec.kind == "bool":
        return F.when(boolean, F.try_variant_get(value, "$", "boolean"))
    if spec.kind == "array":
        return F.when(kind.startswith("ARRAY"), F.from_json(raw, spec.data_type()))
    raise ValueError(f"unknown kind: {spec.kind}")


def document_columns(doc: Column, specs: list[ColumnSpec], ascii_only: bool = True) -> list[Column]:
    return [normalized(doc, s, ascii_only=ascii_only).alias(s.name) for s in specs]
