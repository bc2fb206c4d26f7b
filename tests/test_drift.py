"""Schema drift: every kind of change, long chains, files as one table."""

from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairnlake.operators.drift import ODD, canonical_type, cast_value, consistent_rows, formats_by_run, last_names, records_of, schema_changes, successions, typed_table, versions

COLUMN = "struct<title:string,description:string,type_name:string,logical_type:string,nullable:boolean>"
ASSET = f"asset_id string, dataset_id string, version int, run_id string, metadata struct<column_schema:map<string,{COLUMN}>>, created_at timestamp"


def col(title, kind=None, logical=None):
    return (title, "", kind, logical, True)


def asset(dataset, version, run, **columns):
    return (f"{dataset}{version}", dataset, version, run, (columns,), dt(2024, 1, 1))


@pytest.fixture(scope="module")
def data(spark):
    a = [
        asset("d", 1, "r1", key=col("Key", "STRING"), gone=col("Gone", "DATE"), old_name=col("The Name!", "integer"), same=col("Same", None, "int16"), w=col("W", "FLOAT")),
        asset("d", 3, "r3", key=col("Key", "String"), new_name=col("the name", "STRING"), same=col("Same", "INTEGER", "int64"), come=col("Come"), w=col("Other", "FLOAT")),
        asset("d", 4, "r4", key=col("Key", None, "large_string"), last_name=col("THE NAME", "STRING"), same=col("Same", "FLOAT"), w=col("Other", "FLOAT")),
        asset("e", 1, "r1", a=col("---"), b=col("Twin"), c=col("twin")),
        asset("e", 2, "r5", x=col("***"), y=col("TWIN"), z=col("t w i n")),
        ("n1", "n", 1, None, (None,), None), ("n2", "n", 2, None, (None,), None), ("x", None, 1, "r1", (None,), None), ("y", "d", None, "r1", (None,), None),
    ]
    assets = spark.createDataFrame([*a, a[0], a[1]], ASSET).withColumns({"before": F.lit(1), "fingerprint": F.lit("clash")})
    runs = spark.createDataFrame([("r1", "b1"), ("r3", "b3"), ("r3", "b3"), ("r4", None), ("r5", "b5"), (None, "b1")], "run_id string, batch_id string")
    manifests = spark.createDataFrame([("b1", [("p", " CSV ")]), ("b1", [("p", " CSV ")]), ("b3", [("p", "tab"), ("q", "TSV")]), ("b5", []), (None, None)], "batch_id string, files array<struct<path:string,format:string>>")
    names = spark.createDataFrame([("csv", "CSV"), ("tab", "TSV"), ("tsv", "TSV")], "alias string, canonical string")
    return assets, formats_by_run(runs, manifests, names), names


def test_changes(data):
    assets, formats, _ = data
    rows = [tuple(r) for r in schema_changes(versions(assets), successions(assets, formats)).collect()]
    want = {
        ("d", 3, "renamed", "old_name", "new_name"), ("d", 3, "retyped", "old_name", "new_name"), ("d", 3, "removed", "gone", ""), ("d", 3, "added", "", "come"), ("d", 3, "format", "CSV", "TSV"),
        ("d", 4, "renamed", "new_name", "last_name"), ("d", 4, "removed", "come", ""), ("d", 4, "retyped", "same", "same"),
        ("e", 2, "removed", "a", ""), ("e", 2, "added", "", "x"), ("e", 2, "renamed", "b", "y"), ("e", 2, "renamed", "c", "z"),
    }
    assert len(rows) == len(set(rows)) and set(rows) == want


@pytest.mark.parametrize("bucket", [1, 2, 3, 100])
def test_versions_in_buckets(spark, bucket):
    have = [1, 2, 5, 6, 7, 40, 41, 90]
    assets = spark.createDataFrame([asset("d", v, None) for v in have], ASSET)
    got = {(r.version, r.before) for r in successions(assets, bucket=bucket).collect()}
    assert got == set(zip(have[1:], have[:-1]))


def test_types(spark):
    pairs = {"int16": "INTEGER", "uint8": "INTEGER", "double": "FLOAT", "halffloat": "FLOAT", "large_string": "STRING", "bool": "BOOLEAN", "timestamp[us]": "TIMESTAMP", "date32[day]": "DATE", "time64[ns]": "TIME", "decimal128(10, 2)": "DECIMAL", "binary": "BINARY", "geometry": "GEOMETRY", "list<item: int32>": "ARRAY", "struct<a: int64>": "STRUCT", "map<string, int32>": "MAP", "null": "UNKNOWN", None: "UNKNOWN"}
    rows = spark.createDataFrame([(k, v) for k, v in pairs.items()], "l string, want string").select("want", canonical_type(F.lit(None).cast("string"), F.col("l")).alias("got")).collect()
    assert all(r.want == r.got for r in rows)


def test_long_chain_of_names(spark):
    n = 37
    assets = spark.createDataFrame([asset("d", v, None, **{f"c{v}": col("Title"), "k": col("K")}) for v in range(1, n + 1)], ASSET)
    one = versions(assets)
    got = {(r.version, r.name): r.last_name for r in last_names(one, schema_changes(one, successions(assets))).collect()}
    assert got == {**{(v, f"c{v}"): f"c{n}" for v in range(1, n + 1)}, **{(v, "k"): "k" for v in range(1, n + 1)}}


def test_files_as_one_table(spark, data):
    assets, formats, names = data
    one = versions(assets)
    files = spark.createDataFrame([
        (1, "d", 1, "CSV", "Key;The Name!;same\n 007 ;12;NA\n;x;3"), (1, "d", 1, "CSV", "Key;The Name!;same\n 007 ;12;NA\n;x;3"), (2, "d", 3, "tab", 'key\tnew_name\n"a"\tb'), (3, "d", 4, "jsonl", '{"key": "k", "same": 1.5, "odd": "o"}\n\n'),
        (4, "d", 4, "csv", None), (5, "d", 4, "csv", ""), (6, None, 1, "csv", "a\n1"),
    ], "file_id long, dataset_id string, version int, format string, payload string")
    rows = consistent_rows(files, one, schema_changes(one, successions(assets, formats)), names.unionByName(spark.createDataFrame([("jsonl", "JSONL")], names.schema))).where("dataset_id is not null").collect()
    got = {(r.file_id, r.row_no, r.column_name): (r.type_name, r.value) for r in rows}
    assert len(got) == len(rows)
    assert got[1, 0, "key"] == ("STRING", "007") and got[1, 0, "last_name"] == ("STRING", "12") and got[1, 0, "same"] == ("FLOAT", None)
    assert got[1, 1, "key"] == ("STRING", None) and got[1, 1, "last_name"] == ("STRING", "x") and got[1, 1, "same"] == ("FLOAT", "3")
    assert got[1, 0, "w"] == ("FLOAT", None) and got[2, 0, "key"] == ("STRING", "a") and got[2, 0, "last_name"] == ("STRING", "b")
    assert got[3, 0, "same"] == ("FLOAT", "1.5") and got[3, 0, "odd"] == ("STRING", "o") and got[3, 0, "last_name"] == ("STRING", None)
    assert {k[0] for k in got} == {1, 2, 3}


def test_layouts():
    """Quotes, line breaks within them, JSON lists, what is no record."""
    assert records_of('a,b\n"x, ""y""\nz",2\n\n3', "CSV") == [[("a", 'x, "y"\nz'), ("b", "2")], [("a", "3")]]
    assert records_of("a;b\r1;2;3\r", None) == [[("a", "1"), ("b", "2"), (ODD, "3")]]
    assert records_of("", "CSV") == records_of(" \n", "TSV") == records_of("", "JSONL") == []
    one = [("a", "1.50"), ("n", "12345678901234567890"), ("b", "true"), ("c", None), ("d", '{"x": [1, "é"]}')]
    text = '{"a": 1.50, "n": 12345678901234567890, "b": true, "c": null, "d": {"x": [1, "é"]}}'
    assert records_of(text, "JSON") == records_of(f"[{text}]", "JSONL") == records_of(f"[\n{text}\n]", "JSON") == [one]
    assert records_of(text + "\nno {\n[1]", "JSONL") == [one, [(ODD, "no {")], [(ODD, "[1]")]]
    assert records_of("a\n" + "x" * 300_000, "CSV") == [[("a", "x" * 300_000)]]


@pytest.mark.parametrize("zone", ["UTC", "Australia/Sydney"])
def test_values(spark, zone):
    """Numbers of any length, times whatever the session's zone, and what is of no type."""
    want = [
        ("INTEGER", "9223372036854775807", "9223372036854775807"), ("INTEGER", "+1000000000000000000", "1000000000000000000"), ("INTEGER", "-0007", "-7"), ("INTEGER", "-00", "0"), ("INTEGER", "9" * 60, "9" * 60),
        ("INTEGER", "1.0", None), ("FLOAT", "1e5", "1e5"), ("FLOAT", "1.2.3", None), ("BOOLEAN", "TRUE", "true"), ("DATE", "2024-02-30", None), ("DATE", "2024-02-29T10:00:00Z", "2024-02-29"), ("TIMESTAMP", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z"),
        ("TIMESTAMP", "2024-01-01T00:00:00+02:00", "2023-12-31T22:00:00Z"), ("TIMESTAMP", "2024-01-01 05:00:00.25", "2024-01-01T05:00:00.25Z"), ("TIMESTAMP", "2024-01-01", "2024-01-01T00:00:00Z"), ("TIMESTAMP", "8811", None),
        ("STRING", " 007 ", "007"), ("STRING", "NA", None), ("GEOMETRY", "POINT (1 2)", "POINT (1 2)"),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = spark.createDataFrame(want, "kind string, v string, want string").select("kind", "v", "want", cast_value(F.col("v"), F.col("kind")).alias("got")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in got if r.got != r.want] == []


def test_columns_of_one_title(spark):
    """Two columns with one title take that title's labels in order; what is of no type stays beside its cell; a typed table."""
    a = spark.createDataFrame([asset("d", 1, None, a1=col("Twin", "INTEGER"), a2=col("twin", "TIMESTAMP"))], ASSET)
    files = spark.createDataFrame([(1, "d", 1, "csv", "TWIN,Twin,Twin\n1,2024-01-01T00:00:00Z,y\nx,2,\n9223372036854775808,,")], "file_id long, dataset_id string, version int, format string, payload string")
    one = versions(a)
    rows = consistent_rows(files, one, schema_changes(one, successions(a)), spark.createDataFrame([("csv", "CSV")], "alias string, canonical string"))
    got = {(r.row_no, r.column_name): (r.value, r.unfit) for r in rows.collect()}
    assert got == {
        (0, "a1"): ("1", None), (0, "a2"): ("2024-01-01T00:00:00Z", None), (0, "Twin_1"): ("y", None), (1, "a1"): (None, "x"), (1, "a2"): (None, "2"), (1, "Twin_1"): (None, None),
        (2, "a1"): ("9223372036854775808", None), (2, "a2"): (None, None), (2, "Twin_1"): (None, None),
    }
    wide = typed_table(rows, [("a1", "INTEGER"), ("a2", "TIMESTAMP"), ("Twin_1", "STRING")])
    assert wide.dtypes[3:] == [("a1", "decimal(38,0)"), ("a2", "timestamp_ntz"), ("Twin_1", "string")]
    assert [tuple(r)[3:] for r in wide.orderBy("row_no").collect()] == [(1, dt(2024, 1, 1), "y"), (None, None, None), (9223372036854775808, None, None)]


@pytest.mark.parametrize("bucket", [1, 3])
def test_names_across_buckets(spark, bucket):
    """The next event of a column is found in later buckets too; a name that comes again is another column."""
    n = 12
    assets = spark.createDataFrame([asset("d", v, None, **({f"c{v}": col("Title"), "k": col("K")} if v != 7 else {f"c{v}": col("Title")})) for v in range(1, n + 1)], ASSET)
    one = versions(assets)
    changes = schema_changes(one, successions(assets))
    got = {(r.version, r.name): r.last_name for r in last_names(one, changes, bucket).collect()}
    assert got == {**{(v, f"c{v}"): f"c{n}" for v in range(1, n + 1)}, **{(v, "k"): "k" for v in range(1, n + 1) if v != 7}}


def test_empty(spark, data):
    assets, formats, names = data
    none = assets.limit(0)
    assert schema_changes(versions(none), successions(none, formats.limit(0))).count() == 0
