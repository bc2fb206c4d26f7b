"""Golden values of header names and types."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from cairnlake.functions import headers as h
from cairnlake.functions.types import canonical, column_schema, logical, six_words

GOLDEN = [
    (["First Name", "Last Name", "Age"], ["first_name", "last_name", "age"]),
    (["Name (Primary)", "Age-Years", "Email.Address"], ["name_primary", "age_years", "email_address"]),
    (["First  Name", "Last___Name"], ["first_name", "last_name"]),
    (["_Name", "Name_", "__Name__"], ["name", "name_1", "name_2"]),
    (["Name", "", "Age"], ["name", "col_1", "age"]),
    (["Name", "Name", "Name", "Name"], ["name", "name_1", "name_2", "name_3"]),
    (["b" * 100], ["b" * 63]),
    (["123Column", "4th Item"], ["_123column", "_4th_item"]),
    (["", "", ""], ["col_0", "col_1", "col_2"]),
]


@pytest.mark.parametrize("given_, want", GOLDEN)
def test_names(given_, want):
    mapping, names = h.normalize(given_)
    assert names == want and mapping[given_[0]] == names[len(given_) - 1 - given_[::-1].index(given_[0])]


def test_words():
    assert h.normalize(["The Name", "A Description", "An Item"], stop_words=["the", "a", "an"])[1] == ["name", "description", "item"]
    assert h.normalize(["St Name", "Qty Items"], expansions={"st": "street", "qty": "quantity"})[1] == ["street_name", "quantity_items"]
    assert h.normalize(["Customer Identifier"], short_forms={"customer": "cust", "identifier": "id"})[1] == ["cust_id"]
    assert h.unrepeated("user_id_user") == "user_id"
    assert [h.without_inner_vowels(w) for w in ("revenue", "service", "identification", "first_name", "id")] == ["rvne", "srvce", "idntfctn", "frst_nme", "id"]


def test_usual_short_forms():
    mapping, names = h.shortened(["Total Quantity", "Amount (Maximum)", "Geometry Reference", "Quantities", "The Description"], ["the"])
    assert names == ["total_qty", "amt_max", "geom_ref", "quantities", "desc"] and mapping["Total Quantity"] == "total_qty"


@given(st.lists(st.text(max_size=80), max_size=12))
def test_names_are_different_identifiers(headers):
    names = h.normalize(headers)[1]
    assert len(set(names)) == len(headers) and all(len(n) <= 63 and n.isidentifier() and n == n.lower() for n in names)


def test_long_repeats():
    names = h.normalize(["b" * 65] * 15)[1]
    assert len(set(names)) == 15 and max(map(len, names)) <= 63


@pytest.mark.parametrize("kind, name, spelling", [
    (T.StringType(), "STRING", "string"), (T.LongType(), "INTEGER", "int64"), (T.ByteType(), "INTEGER", "int8"), (T.FloatType(), "FLOAT", "float"), (T.DoubleType(), "FLOAT", "double"),
    (T.BooleanType(), "BOOLEAN", "bool"), (T.TimestampType(), "TIMESTAMP", "timestamp[us]"), (T.DateType(), "DATE", "date32[day]"), (T.DecimalType(10, 2), "DECIMAL", "decimal128(10, 2)"),
    (T.BinaryType(), "BINARY", "binary"), (T.ArrayType(T.IntegerType()), "ARRAY", "list<element: int32>"), (T.StructType([T.StructField("a", T.LongType())]), "STRUCT", "struct<a: int64>"),
    (T.MapType(T.StringType(), T.IntegerType()), "MAP", "map<string, int32>"), (T.NullType(), "UNKNOWN", "null"), (T.DayTimeIntervalType(), "UNKNOWN", "interval day to second"),
])
def test_types(kind, name, spelling):
    assert (canonical(kind), logical(kind)) == (name, spelling)


def test_column_schema(spark):
    df = spark.createDataFrame([], T.StructType([T.StructField("geometry", T.BinaryType()), T.StructField("geom", T.BinaryType(), True, {"geometry": True}), T.StructField("n", T.IntegerType(), False)]))
    assert [(r[0], r[3], r[5]) for r in column_schema(df)] == [("geometry", "BINARY", True), ("geom", "GEOMETRY", True), ("n", "INTEGER", False)]
    assert column_schema(df, geometry=("geometry",))[0][3] == "GEOMETRY"


def test_six_words():
    assert [six_words(x) for x in ("Integer64", "Real", "String", "Date", "Date Time", "Time", "Binary")] == ["integer", "real", "string", "date", "datetime", "time", "binary"]
