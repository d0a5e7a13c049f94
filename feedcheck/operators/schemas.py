"""Schemas as rows: one row per set of schema texts, with all that the checks of a record need to know of it.

The texts are parsed by the tasks that hold them, and a file's row takes its schema along. What a plan grows with
is the positions of the fields and the types and date patterns met there, whatever the number of schemas.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions.schema import DATE_LOGICAL_TYPES, FeedField, FeedSchema, SchemaMissing, SchemaUnparsable, schema_from_avro_json
from ..session import materialise
from .metadata import DATE_FIELDS
from .validate import cell_name, picks

SCHEMAS = ("table_schema", "insert_table_schema", "header_schema")
# Places in a written line that are no position of the record.
NULL_PLACE, FILE_ID_PLACE, RECORD_ID_PLACE = -1, -2, -3

_FIELD = "struct<name:string,type:string,nullable:boolean,doc:string,logical:string>"
_DESCRIBED = (
    f"struct<code:string,header_code:string,names:array<string>,read:array<{_FIELD}>,header:array<{_FIELD}>,"
    "picks:map<string,array<bigint>>,cells:array<string>,places:array<int>,id_places:array<int>>"
)


@dataclass(frozen=True)
class Group:
    """The schemas of a set of texts, or the code of what is wrong with them."""

    texts: tuple
    read: FeedSchema | None = None
    write: FeedSchema | None = None
    header: FeedSchema | None = None
    header_code: str | None = None
    code: str | None = None


def parse_group(texts: tuple, profile: str) -> Group:
    code = codes.PROFILES[profile]
    read = write = header = header_code = None
    try:
        read = schema_from_avro_json(texts[0])
        if texts[1] is None:
            return Group(texts, read=read, code=code["null_pointer"])
        write = read if texts[1] == texts[0] else schema_from_avro_json(texts[1] or "{")
    except SchemaMissing:
        return Group(texts, code=code["schema_missing"])
    except SchemaUnparsable:
        return Group(texts, read=read, code=code["schema_unparsable"])
    try:
        header = schema_from_avro_json(texts[2])
    except SchemaMissing:
        header_code = code["null_pointer"]
    except SchemaUnparsable:
        header_code = code["schema_unparsable"]
    return Group(texts, read, write, header, header_code)


def places(read: FeedSchema, write: FeedSchema, ids: bool) -> list[int]:
    """Places of a written line's values: write-schema fields by name, an absent one empty,
    then every field that the write schema does not name."""
    given = {"file_id": FILE_ID_PLACE, "record_id": RECORD_ID_PLACE} if ids else {}
    given.update({f.name: i for i, f in enumerate(read.fields)})
    return [given.get(n, NULL_PLACE) for n in write.names] + [p for n, p in given.items() if n not in write.names]


def _described(group: Group) -> str:
    def rows(schema: FeedSchema | None):
        return None if schema is None else [vars(f) for f in schema.fields]

    out = {"code": group.code, "header_code": group.header_code}
    if group.code is None:
        cells = [cell_name(i, f) for i, f in enumerate(group.read.fields)]
        out.update(names=group.read.names, read=rows(group.read), header=rows(group.header), picks=picks(group.read.fields), cells=cells)
        out.update(places=places(group.read, group.write, False), id_places=places(group.read, group.write, True))
    return json.dumps(out)


def schema_table(texts: DataFrame, profile: str) -> DataFrame:
    """``texts`` (columns SCHEMAS) made distinct, with ``schema_group`` and the struct ``schema``; written out."""

    @F.pandas_udf("string")
    def described(table: pd.Series, insert: pd.Series, header: pd.Series) -> pd.Series:
        rows = ([None if x is None else str(x) for x in row] for row in zip(table, insert, header))
        return pd.Series([_described(parse_group(tuple(row), profile)) for row in rows], dtype=object)

    own = texts.select(*SCHEMAS).distinct().withColumn("described", described(*SCHEMAS))
    return materialise(own.select(*SCHEMAS, F.xxhash64(*SCHEMAS).alias("schema_group"), F.from_json("described", _DESCRIBED).alias("schema")), "schemas")


def distinct_cells(table: DataFrame) -> list[tuple[int, FeedField]]:
    """Positions with the kinds of fields that any schema has there; names are left out. This is what the plan
    grows with, so it passes through the driver."""
    # The pattern of a field that is no date does nothing.
    date = F.coalesce(F.col("f.logical").isin(*DATE_LOGICAL_TYPES), F.lit(False))
    kinds = table.select(F.posexplode("schema.read").alias("i", "f")).select(
        "i", "f.type", "f.nullable", F.when(date, F.col("f.doc")).alias("doc"), F.when(date, F.lit(DATE_LOGICAL_TYPES[0])).alias("logical")
    )
    rows = sorted(kinds.distinct().collect(), key=lambda r: (r.i, r.type, r.nullable, r.logical or "", r.doc is None, r.doc or ""))
    return [(r.i, FeedField("", r.type, r.nullable, r.doc, r.logical)) for r in rows]


def metadata_patterns(table: DataFrame, part: str) -> list[str]:
    """Date patterns of the known metadata fields of any schema, of the ``read`` or the ``header`` ones."""
    found = table.select(F.explode(f"schema.{part}").alias("f")).filter(F.lower("f.name").isin(*DATE_FIELDS) & (F.col("f.doc") != ""))
    return sorted(r.doc for r in found.select("f.doc").distinct().collect())


def line_by_places(values: Column, own_places: Column, file_id: Column, record_id: Column, null: Column, sep: str) -> Column:
    """A written line from rendered values by position."""

    def at(p):
        value = F.when(p == FILE_ID_PLACE, file_id).when(p == RECORD_ID_PLACE, record_id).when(p == NULL_PLACE, null)
        return value.otherwise(F.get(values, p))

    return F.array_join(F.transform(own_places, at), sep)
