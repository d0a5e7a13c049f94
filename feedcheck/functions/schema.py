"""Feed schemas: Avro-JSON text to a list of typed fields."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

# Logical type names whose text is converted to epoch milliseconds.
DATE_LOGICAL_TYPES = ("date", "time-millis", "time-micros", "timestamp-millis", "timestamp-micros")

_SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


class SchemaMissing(ValueError):
    """No schema text was given."""


class SchemaUnparsable(ValueError):
    """The schema text is not a usable record schema."""


@dataclass(frozen=True)
class FeedField:
    name: str
    type: str = "string"
    nullable: bool = False
    doc: str | None = None
    logical: str | None = None

    @property
    def is_date(self) -> bool:
        return self.logical in DATE_LOGICAL_TYPES

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.type]


@dataclass(frozen=True)
class FeedSchema:
    name: str
    fields: tuple[FeedField, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def to_struct(self) -> T.StructType:
        """Spark schema; ``doc`` and ``logicalType`` travel as field metadata."""
        out = []
        for f in self.fields:
            meta = {k: v for k, v in (("doc", f.doc), ("logicalType", f.logical)) if v is not None}
            out.append(T.StructField(f.name, f.spark_type, f.nullable, meta))
        return T.StructType(out)


def _field_type(spec, name: str) -> tuple[str, bool]:
    nullable = False
    if isinstance(spec, list):
        kinds = [s for s in spec if s != "null"]
        nullable = len(kinds) < len(spec)
        if len(kinds) != 1:
            raise SchemaUnparsable(f"field {name}: union of several types is not supported in delimited text")
        spec = kinds[0]
    if isinstance(spec, dict):
        spec = spec.get("type")
    if spec not in _SPARK_TYPES:
        raise SchemaUnparsable(f"field {name}: type {spec!r} is not supported in delimited text")
    return spec, nullable


def schema_from_avro_json(text: str | None) -> FeedSchema:
    if text is None or not text.strip():
        raise SchemaMissing("schema text is missing")
    try:
        doc = json.loads(text)
    except json.JSONDecodeError as e:
        raise SchemaUnparsable(f"schema text is not JSON: {e}") from None
    if not isinstance(doc, dict) or doc.get("type") != "record" or not isinstance(doc.get("fields"), list):
        raise SchemaUnparsable("schema text is not a record schema")
    fields = []
    for f in doc["fields"]:
        if not isinstance(f, dict) or not f.get("name") or "type" not in f:
            raise SchemaUnparsable(f"bad field: {f!r}")
        kind, nullable = _field_type(f["type"], f["name"])
        # The logical type counts only as a property of the field itself.
        fields.append(FeedField(f["name"], kind, nullable, f.get("doc"), f.get("logicalType")))
    if len({f.name for f in fields}) != len(fields):
        raise SchemaUnparsable("duplicate field name")
    return FeedSchema(doc.get("name", "record"), tuple(fields))


def schema_from_header(names: list[str]) -> FeedSchema:
    """Schema of a file that names its own columns: every field is an optional string."""
    return FeedSchema("header", tuple(FeedField(n, "string", True) for n in names))


def schema_from_struct(st: T.StructType) -> FeedSchema:
    """Schema of an inferred or declared Spark frame."""
    by_type = {type(v): k for k, v in _SPARK_TYPES.items()}
    return FeedSchema(
        "struct",
        tuple(FeedField(f.name, by_type.get(type(f.dataType), "string"), f.nullable) for f in st.fields),
    )
