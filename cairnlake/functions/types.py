"""Canonical types of columns, as recorded with each version of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Metadata key that marks a binary or struct column as geometry.
GEOMETRY = "geometry"
#: Spark type to canonical name and the logical spelling that goes with it.
SIMPLE = {
    T.StringType: ("STRING", "string"), T.ByteType: ("INTEGER", "int8"), T.ShortType: ("INTEGER", "int16"), T.IntegerType: ("INTEGER", "int32"),
    T.LongType: ("INTEGER", "int64"), T.FloatType: ("FLOAT", "float"), T.DoubleType: ("FLOAT", "double"), T.BooleanType: ("BOOLEAN", "bool"),
    T.TimestampType: ("TIMESTAMP", "timestamp[us]"), T.TimestampNTZType: ("TIMESTAMP", "timestamp[us]"), T.DateType: ("DATE", "date32[day]"),
    T.BinaryType: ("BINARY", "binary"), T.NullType: ("UNKNOWN", "null"),
}


def logical(t: T.DataType) -> str:
    """The spelling of a type in column schemas."""
    if isinstance(t, T.DecimalType):
        return f"decimal128({t.precision}, {t.scale})"
    if isinstance(t, T.ArrayType):
        return f"list<element: {logical(t.elementType)}>"
    if isinstance(t, T.MapType):
        return f"map<{logical(t.keyType)}, {logical(t.valueType)}>"
    if isinstance(t, T.StructType):
        return "struct<" + ", ".join(f"{f.name}: {logical(f.dataType)}" for f in t.fields) + ">"
    if isinstance(t, (T.VarcharType, T.CharType)):
        return "string"
    return SIMPLE[type(t)][1] if type(t) in SIMPLE else t.simpleString()


def canonical(t: T.DataType, geometry: bool = False) -> str:
    """One of the fourteen canonical names; binary and struct columns count as geometry when said so."""
    if geometry and isinstance(t, (T.BinaryType, T.StructType)):
        return "GEOMETRY"
    for kind, name in ((T.DecimalType, "DECIMAL"), (T.ArrayType, "ARRAY"), (T.StructType, "STRUCT"), (T.MapType, "MAP"), ((T.VarcharType, T.CharType), "STRING")):
        if isinstance(t, kind):
            return name
    if type(t).__name__ == "TimeType":
        return "TIME"
    if type(t).__name__ in ("GeometryType", "GeographyType"):
        return "GEOMETRY"
    return SIMPLE[type(t)][0] if type(t) in SIMPLE else "UNKNOWN"


def column_schema(df: DataFrame, geometry: tuple[str, ...] = (), titles: dict[str, str] | None = None) -> list[tuple]:
    """(name, title, description, type_name, logical_type, nullable) of every column.

    Geometry columns are those named, those whose metadata says so, and no others: a binary column that is merely called
    geometry stays binary.
    """
    titles = titles or {}
    return [
        (f.name, titles.get(f.name, f.name), "", canonical(f.dataType, f.name in geometry or bool(f.metadata.get(GEOMETRY) or f.metadata.get("geo"))), logical(f.dataType), f.nullable)
        for f in df.schema.fields
    ]


COLUMN_SCHEMA = "name string, title string, description string, type_name string, logical_type string, nullable boolean"


def column_schema_frame(df: DataFrame, **how) -> DataFrame:
    """``column_schema`` as a table."""
    return df.sparkSession.createDataFrame(column_schema(df, **how), COLUMN_SCHEMA)


def six_words(kind: str) -> str:
    """A vector driver's field type in the six words by which files are compared; others as they are, lower-cased."""
    t = kind.replace(" ", "").lower()
    for word, marks in (("integer", ("integer",)), ("real", ("real", "float")), ("string", ("string", "text")), ("datetime", ("datetime", "timestamp")), ("date", ("date",)), ("time", ("time",))):
        if any(m in t for m in marks):
            return word
    return t
