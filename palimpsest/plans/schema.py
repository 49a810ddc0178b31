"""Kinds of columns, and their inference from JSON schemas of documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql.types import ArrayType, BooleanType, ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

JsonSchema = dict[str, Any]

_TYPES: dict[str, DataType] = {"string": StringType(), "json": StringType(), "bool": BooleanType(), "int64": LongType(), "int8": ByteType(), "float64": DoubleType()}
_WHOLE: tuple[type[DataType], ...] = (ByteType, ShortType, IntegerType, LongType)
_REAL: tuple[type[DataType], ...] = (FloatType, DoubleType)
#: The column that holds the end cursor of the page that a version came with.
CURSOR = "_cursor"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: str
    required: bool = False
    element: str | None = None

    def data_type(self) -> DataType:
        if self.kind == "array":
            return ArrayType(_TYPES[self.element or "string"], True)
        if self.kind not in _TYPES:
            raise ValueError(f"unknown kind: {self.kind}")
        return _TYPES[self.kind]

    def field(self) -> StructField:
        return StructField(self.name, self.data_type(), not self.required)


#: System columns in their order.
SYSTEM = (
    ColumnSpec("_id", "string", True),
    ColumnSpec("_creationTime", "float64"),
    ColumnSpec("_table", "string"),
    ColumnSpec("_ts", "int64", True),
    ColumnSpec("_deleted", "bool", True),
    ColumnSpec(CURSOR, "string"),
    ColumnSpec("__status", "int8", True),
    ColumnSpec("__status_id", "string", True),
    ColumnSpec("__id_ts", "string", True),
)
RESERVED = frozenset(s.name for s in SYSTEM) | {"_current"}


def struct_of(specs: list[ColumnSpec]) -> StructType:
    return StructType([s.field() for s in specs])


# -- validators as JSON schema


def _fields(validator: JsonSchema) -> JsonSchema | None:
    """An object by its ``properties``, or by a ``value`` of field descriptions, which are required unless they say otherwise."""
    if isinstance(given := validator.get("properties"), dict):
        fields, required = {k: expanded(v) for k, v in given.items()}, list(validator.get("required", []))
    elif isinstance(told := validator.get("value"), dict):
        plain = {k: v if isinstance(v, dict) else {"fieldType": v} for k, v in told.items()}
        optional = {k for k, v in plain.items() if v.get("optional")}
        fields = {k: expanded(v.get("fieldType", v)) for k, v in plain.items()}
        fields |= {k: {"anyOf": [{"type": "null"}, fields[k]]} for k in optional}
        required = sorted(set(plain) - optional)
    else:
        return None
    return {"type": "object", "properties": dict(sorted(fields.items()))} | ({"required": required} if required else {})


def _items(validator: JsonSchema) -> JsonSchema:
    items = validator.get("items", validator.get("value"))
    return {"type": "array"} if items is None else {"type": "array", "items": expanded(items)}


def _same(validator: JsonSchema) -> JsonSchema:
    return {k: v for k, v in validator.items() if k == "type" or k.startswith("x-")}


def _always(**schema: Any) -> Callable[[JsonSchema], JsonSchema]:
    note = schema.pop("note")
    return lambda _: {**schema, "x-note": note}


#: How each type of validator reads as JSON schema; None leaves it as it is.
_FORMS: dict[str, Callable[[JsonSchema], JsonSchema | None]] = {
    "union": lambda v: {"anyOf": [expanded(x) for x in v["value"]]} if isinstance(v.get("value"), list) else None,
    "array": _items,
    "object": _fields,
    "literal": lambda v: {"const": v.get("value")},
    "id": _always(type="string", note="id"),
    "bytes": _always(type="string", note="bytes"),
    "bigint": _always(type="integer", note="int64"),
    "any": _always(note="any"),
    "record": _always(type="object", note="record"),
    **dict.fromkeys(("number", "boolean", "string", "null"), _same),
}


def expanded(validator: Any) -> Any:
    """A validator description as plain JSON schema, nested ones included."""
    kind = validator.get("type") if isinstance(validator, dict) else None
    found = _FORMS[kind](validator) if isinstance(kind, str) and kind in _FORMS else None
    return validator if found is None else found


# -- kinds

#: A kind with its elements' kind; null stands among the alternatives of a schema like any other.
_Found = tuple[str, str | None]
_NULL: _Found = ("null", None)
#: Each kind holds the values of those before it; what holds arrays beside others is JSON.
_ORDER = ("bool", "int64", "float64", "string", "array", "json")
_SCALARS = {"string": "string", "boolean": "bool", "integer": "int64", "number": "float64", "object": "json", "null": "null"}
_CONSTANTS: dict[type, str] = {bool: "bool", int: "int64", float: "float64"}


def _found(schema: JsonSchema, inside: bool) -> list[_Found]:
    """The kind of each alternative of a schema; ``inside`` a union, null counts as an alternative of its own only."""
    members = schema.get("anyOf") or schema.get("oneOf")
    if isinstance(members, list):
        return [x for m in members if isinstance(m, dict) for x in _found(m, True)]
    kind = schema.get("type")
    if isinstance(kind, list):
        others = [k for k in kind if k != "null"]
        if len(others) != 1 or len(others) == len(kind):
            return [("string", None)]
        return _found({**schema, "type": others[0]}, True) + ([] if inside else [_NULL])
    if {"any", "record"}.intersection(v for k, v in schema.items() if k.startswith("x-") and isinstance(v, str)):
        return [("json", None)]
    if "const" in schema:
        return [(_CONSTANTS.get(type(schema["const"]), "string"), None)]
    if kind == "array":
        items = schema.get("items")
        inner, null, _ = infer_kind(items) if isinstance(items, dict) and items else ("json", False, None)
        return [("json", None) if null or inner in ("json", "array") else ("array", inner)]
    return [("json" if kind is None else _SCALARS.get(kind, "string") if isinstance(kind, str) else "string", None)]


def infer_kind(schema: JsonSchema) -> tuple[str, bool, str | None]:
    """Kind, whether null is allowed, and the elements' kind of an array; of several alternatives the least kind that holds all."""
    found = _found(schema, False)
    rest = [x for x in found if x != _NULL]
    if not rest:
        return "string", True, None
    if len(rest) == 1:
        return rest[0][0], len(found) > 1, rest[0][1]
    joined = max((kind for kind, _ in rest), key=_ORDER.index)
    return "json" if joined == "array" else joined, len(rest) < len(found), None


def table_specs(schema: JsonSchema) -> list[ColumnSpec]:
    """The columns of a table: the system's, then the document's fields by name, all of which may be null."""
    plain = expanded(schema)
    fields = plain.get("properties") if isinstance(plain, dict) else None
    out = list(SYSTEM)
    for name in sorted(fields or {}):
        if name not in RESERVED and isinstance(fields[name], dict):
            kind, _, element = infer_kind(expanded(fields[name]))
            out.append(ColumnSpec(name, kind, False, element))
    return out


def compatible(have: DataType, want: DataType) -> bool:
    """Whether stored values can stay as they are: same type, or both whole, or both real."""
    return have == want or any(isinstance(have, f) and isinstance(want, f) for f in (_WHOLE, _REAL))


def widens(have: DataType, want: DataType) -> bool:
    """Whether ``want`` holds more than ``have`` within one family of numbers."""
    for family in (_WHOLE, _REAL):
        if isinstance(have, family) and isinstance(want, family):
            return family.index(type(have)) < family.index(type(want))
    return False


def signature(schema: StructType) -> tuple:
    """What two schemas must share to count as equal."""
    return tuple((f.name, f.dataType.simpleString(), f.nullable, tuple(sorted((f.metadata or {}).items()))) for f in schema)
