"""Schemas: retyping blob columns, splitting off partition columns, catalog type names."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# The types a strict catalog takes.
STRICT_TYPES = (
    T.StringType,
    T.DoubleType,
    T.IntegerType,
    T.FloatType,
    T.TimestampType,
    T.BooleanType,
    T.BinaryType,
    T.DecimalType,
    T.LongType,
)


def with_binary_columns(schema: T.StructType, names: list[str]) -> T.StructType:
    """``schema`` with the named columns binary and not nullable; unknown names are ignored."""
    return T.StructType(
        [
            T.StructField(field.name, T.BinaryType(), nullable=False)
            if field.name in names
            else field
            for field in schema.fields
        ]
    )


def schema_to_json(schema: T.StructType) -> str:
    return schema.json()


def schema_from_json(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def split_schema(
    schema: T.StructType, keys: list[str]
) -> tuple[list[T.StructField], list[T.StructField]]:
    """Data fields in schema order and partition fields in the order of ``keys``."""
    unknown = [key for key in keys if key not in schema.names]
    if unknown:
        raise ValueError(f"no such columns to partition by: {', '.join(unknown)}")
    data = [field for field in schema.fields if field.name not in keys]
    return data, [schema[key] for key in keys]


def catalog_type(field: T.StructField, strict_types: bool = False) -> str:
    """The catalog's name for the field's type.

    ``strict_types`` admits only string, double, int, float, timestamp, boolean, binary, decimal
    and bigint; otherwise Spark's catalog decides.
    """
    if strict_types and not isinstance(field.dataType, STRICT_TYPES):
        raise TypeError(f"a strict catalog has no type for {field.name}: {field.dataType}")
    return type_name(field.dataType)


def type_name(kind: T.DataType) -> str:
    """A type as the catalog reads it, with the names of nested fields quoted."""
    if isinstance(kind, T.StructType):
        fields = ", ".join(f"{quoted(f.name)}: {type_name(f.dataType)}" for f in kind.fields)
        return f"struct<{fields}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{type_name(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{type_name(kind.keyType)}, {type_name(kind.valueType)}>"
    return kind.simpleString()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
