"""Files to lake to join, and manifests as a stream."""

import hashlib
import json
import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime as dt

import pyarrow.parquet as pq
import pytest
from compare import DATA
from pyspark.sql import functions as F

from cairnlake.functions.geometry import box, point, z_order
from cairnlake.operators.manifests import json_schema
from cairnlake.plans import lakeside
from cairnlake.plans.pipelines import Lake, clustered, ingest_tabular, ingest_vector, join_datasets, recipe, run_recipe
from cairnlake.sinks import lake as sink
from cairnlake.sources import files
from cairnlake.streaming import manifests as stream

META = {"title": "t", "description": "", "keywords": ["k"], "source": "s", "license": "l", "attribution": ""}
SQUARE = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]


def feature(key, ring, **more):
    return {"type": "Feature", "properties": {"Parcel": key, **more}, "geometry": {"type": "Polygon", "coordinates": [ring]}}


@pytest.fixture()
def landing(tmp_path):
    (tmp_path / "a.csv").write_text("Parcel ID,First Name,Note\n 01 ,Ann,NA\nB,Bob,NA\n", encoding="utf-8")
    (tmp_path / "one.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature("01", SQUARE, n=1), feature("C", [[x + 5, y] for x, y in SQUARE], n=2.5)]}))
    (tmp_path / "two.geojson").write_text("\n".join(json.dumps(feature(k, SQUARE, n=3.5)) for k in "DE"))
    return tmp_path


def test_csv(spark, landing):
    df, mapping = files.read_csv(spark, str(landing / "a.csv"), "Parcel ID")
    assert mapping == {"Parcel ID": "parcel_id", "First Name": "first_name", "Note": "note"}
    assert [tuple(r) for r in df.collect()] == [("01", "Ann", None), ("B", "Bob", None)]
    with pytest.raises(ValueError):
        files.read_csv(spark, str(landing / "a.csv"), "nope")


def test_csv_types(spark, tmp_path):
    """NA is no value among numbers and a value among texts; types are those of all rows."""
    (tmp_path / "t.csv").write_text('id,iso,n,d,t,b,x,z,q\n1,NA,5,2024-01-31,2024-01-31T10:00:00,true,1,2024-01-31 10:00:00Z,"a ""b""\nc"\n2,AU,NA,,nan,FALSE,2.5,2024-01-31T10:00:00+02:00,\n3,NZ,7,2024-02-01,2024-02-01 11:00,null,1e3,,007\n', encoding="utf-8")
    df, _ = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert [t for _, t in df.dtypes] == ["bigint", "string", "bigint", "date", "timestamp_ntz", "boolean", "double", "timestamp", "string"]
    rows = [tuple(r) for r in df.select("id", "iso", "n", "b", "x", "q").collect()]
    assert rows == [(1, "NA", 5, True, 1.0, 'a "b"\nc'), (2, "AU", None, False, 2.5, ""), (3, "NZ", 7, None, 1000.0, "007")]
    big = tmp_path / "big.csv"
    big.write_text("a,b\n9223372036854775807,9223372036854775808\n01,1\n")
    df, _ = files.read_csv(spark, str(big), "a")
    assert df.dtypes == [("a", "string"), ("b", "double")] and [r.a for r in df.collect()] == ["9223372036854775807", "01"]
    big.write_text("a,A,\n1,2,3\n")
    assert [tuple(r) for r in files.read_csv(spark, str(big))[0].select("a", "a_1", "col_2").collect()] == [(1, 2, 3)]
    for text in ("", "a,b\n1\n", "a,b\n1,2,3\n"):
        big.write_text(text)
        with pytest.raises(ValueError):
            files.read_csv(spark, str(big))
    big.write_text("a,b\n")
    assert files.read_csv(spark, str(big))[0].count() == 0


def test_geojson_types(spark, tmp_path):
    """Types are those of the JSON, whatever the texts look like."""
    props = [{"code": "0123", "v": "1.2.3", "n": 1234567890123456789, "h": 12345678901234567890123, "m": 1, "s": 1, "b": True, "o": {"k": [1]}, "e": None}, {"code": "7", "v": "2", "n": 3, "h": 1, "m": 2.5, "s": "1", "b": None, "o": [2]}]
    (tmp_path / "p.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": p, "geometry": None} for p in props]}))
    df = files.read_geojson(spark, str(tmp_path / "p.geojson"))
    assert df.drop("geom").dtypes == [("code", "string"), ("v", "string"), ("n", "bigint"), ("h", "decimal(38,0)"), ("m", "double"), ("s", "string"), ("b", "boolean"), ("o", "string")]
    rows = [tuple(r) for r in df.drop("geom").collect()]
    assert rows == [("0123", "1.2.3", 1234567890123456789, 12345678901234567890123, 1.0, "1", True, '{"k":[1]}'), ("7", "2", 3, 1, 2.5, "1", None, "[2]")]


def test_versions_of_writers_at_once(spark, tmp_path):
    """Several writers of one dataset get different numbers and never mix their rows."""
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda _: sink.make_once(spark, str(tmp_path / "lock" / "x")), range(8))) == 1
        got = list(pool.map(lambda i: sink.write_version(spark.range(i + 1), str(tmp_path / "lake"), "d"), range(4)))
    assert sorted(g["version"] for g in got) == [1, 2, 3, 4]
    assert sorted(spark.read.parquet(g["path"]).count() for g in got) == [1, 2, 3, 4]
    assert sink.write_version(spark.range(1), str(tmp_path / "lake"), "d")["version"] == 5


def test_hash_of_one_file_is_that_of_its_bytes(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "a"))
    (part,) = (tmp_path / "a").glob("*.parquet")
    assert sink.content_hash(spark, str(tmp_path / "a")) == "sha256:" + hashlib.sha256(part.read_bytes()).hexdigest()


def test_landing_zone(spark, tmp_path):
    root = str(tmp_path)
    assert sink.create_folder(spark, root, "batch_1") and not sink.create_folder(spark, root, "batch_1")
    assert sink.put_file(spark, root, "batch_1/a.csv", b"a\n1") and not sink.put_file(spark, root, "batch_1/a.csv", b"b") and sink.get_file(spark, root, "batch_1/a.csv") == b"a\n1"
    assert sink.put_file(spark, root, "batch_1/a.csv", b"b", overwrite=True) and sink.get_file(spark, root, "batch_1/a.csv") == b"b"
    assert not sink.delete_folder(spark, root, "batch_1") and sink.delete_file(spark, root, "batch_1/a.csv") and not sink.delete_file(spark, root, "batch_1/a.csv")
    for key in ("manifests/a.json", "archive/x", "../x", "", "a//b"):
        with pytest.raises(ValueError):
            sink.put_file(spark, root, key, b"")
    with pytest.raises(FileNotFoundError):
        sink.get_file(spark, root, "nope")


def test_files_and_manifests_with_audit(spark, tmp_path):
    lake, landing = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    assert lake.upload(landing, "b/a.csv", b"x", "ann") and not lake.upload(landing, "b/a.csv", b"y", "ann") and lake.delete_upload(landing, "b/a.csv", "bob")
    (tmp_path / "landing" / "manifests").mkdir()
    (tmp_path / "landing" / "manifests" / "b1.json").write_text("{}")
    lake.delete_manifest(landing, "b1", "ann")
    for missing in ("b1", "../b1"):
        with pytest.raises(FileNotFoundError):
            lake.delete_manifest(landing, missing, "ann")
    sink.put_file(spark, lake.root, "d/v1/f.bin", b"123")
    assert lake.download("d/v1/f.bin", "cy") == b"123"
    assert {(r.username, r.action, r.resource_type, r.resource_id) for r in lake.activity.collect()} == {("ann", "upload_file", "file", "b/a.csv"), ("bob", "delete_file", "file", "b/a.csv"), ("ann", "delete_manifest", "manifest", "b1"), ("cy", "download_asset", "asset", "d/v1/f.bin")}
    with pytest.raises(ValueError):
        lake.log("ann", "dance", "file", "x")


def test_migrations(spark, tmp_path):
    lake, done = Lake(spark, str(tmp_path)), []

    def broken(_):
        raise RuntimeError("no")

    steps = {"002": lambda _: done.append("002"), "001": lambda _: done.append("001"), "003": broken}
    with pytest.raises(RuntimeError, match="no"):
        lake.migrate(steps)
    assert done == ["001", "002"] and lake.migrate({**steps, "003": lambda _: done.append("003")}) == ["003"] and lake.migrate(steps) == []


def test_one_asset_a_key(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.range(3)
    written = sink.write_version(df, lake.root, "d")
    lake.record(written, "r", "tabular", df, META)
    with pytest.raises(ValueError, match="already"):
        lake.record(written, "r", "tabular", df, META)


def test_schema_of_manifests():
    schema = json_schema("tabular")
    assert schema["x-asset-type"] == "tabular" and schema["required"] == ["batch_id", "uploader", "intent", "files", "metadata"] and not schema["additionalProperties"]
    meta = schema["properties"]["metadata"]
    assert set(meta["properties"]) == {"title", "description", "keywords", "source", "license", "attribution", "project", "tags", "join_config"} and "keywords" not in meta["required"]
    assert schema["properties"]["files"]["items"]["properties"]["type"]["enum"] == ["raster", "vector", "tabular"] and json.loads(json.dumps(schema)) == schema
    with pytest.raises(ValueError):
        json_schema("x")


def test_rows_that_lie_together_are_together(spark):
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate((x, y) for x in range(-160, 170, 40) for y in range(-80, 90, 20))]
    df = spark.createDataFrame([*rows, (999, None, None)], "id int, x double, y double").select("id", point(F.col("x"), F.col("y")).alias("geom"))
    assert df.select(z_order(F.col("geom")).alias("z")).where("z is not null").distinct().count() == len(rows)

    def spread(d):
        each = d.where("id < 999").withColumn("p", F.spark_partition_id()).withColumn("b", box("geom")).groupBy("p").agg((F.max("b.maxx") - F.min("b.minx")).alias("w"), (F.max("b.maxy") - F.min("b.miny")).alias("h")).collect()
        return len(each), sum(r.w * r.h for r in each)

    parts, area = spread(clustered(files=4)(df.repartition(3)))
    assert parts == 4 and area < 0.6 * spread(df.repartition(4))[1]



def test_geojson(spark, landing):
    one, two = (files.read_geojson(spark, str(landing / f"{k}.geojson")) for k in ("one", "two"))
    assert one.dtypes == [("Parcel", "string"), ("n", "double"), ("geom", "binary")]
    assert files.union_files([one, two]).count() == 4 and files.vector_schema(one)["geometry_type"] == "POLYGON"
    with pytest.raises(ValueError, match="only on one side: n"):
        files.union_files([one, two.drop("n")])
    assert files.incompatibilities([{"fields": {"a": "date"}, "geometry_type": "Point"}, {"fields": {"a": "datetime"}, "geometry_type": "Line"}]) == ["file 2: a is datetime instead of date", "file 2: Line instead of Point"]


def test_ogr_schema():
    layer = {"name": "data", "fields": [{"name": "id", "type": "Integer"}, {"name": "name", "type": "String"}], "geometryFields": [{"type": "Point"}]}
    assert files.ogr_schema(json.dumps({"layers": [layer]})) == {"fields": {"id": "integer", "name": "string"}, "geometry_type": "Point"}
    for bad in ([], [layer, layer], [{**layer, "geometryFields": []}]):
        with pytest.raises(ValueError):
            files.ogr_schema(json.dumps({"layers": bad}))


def test_pipelines(spark, landing):
    lake = Lake(spark, str(landing / "lake"))
    tags = lambda d: {**META, "tags": {"dataset_id": d}}
    config = {"spatial_dataset_id": "s", "tabular_dataset_id": "t", "left_key": "parcel_id", "right_key": "Parcel", "how": "left"}
    table = {"intent": "ingest_tabular", "files": [{"path": str(landing / "a.csv")}], "metadata": {**tags(" t "), "join_config": {**config, "left_key": "Parcel ID"}}}
    shapes = {"intent": "ingest_vector", "files": [{"path": str(landing / f"{k}.geojson")} for k in ("one", "two")], "metadata": tags("s")}
    a, b = ingest_tabular(lake, table, "r1"), ingest_vector(lake, shapes, "r2")
    assert (a["s3_key"], b["s3_key"], b["row_count"]) == ("t/v1/data.parquet", "s/v1/data.parquet", 4)
    assert ingest_vector(lake, shapes, "r3")["version"] == 2
    j = join_datasets(lake, {"intent": "join_datasets", "files": [], "metadata": {**tags("j"), "join_config": config}}, "r4")
    assert j["row_count"] == 2 and j["content_hash"].startswith("sha256:")
    asset = lake.assets.where("kind = 'joined'").first()
    assert tuple(asset.bounds) == (0, 0, 2, 2) and asset.metadata.geometry_type == "POLYGON" and asset.crs == "EPSG:4326"
    assert asset.metadata.column_schema["geom"].type_name == "GEOMETRY" and asset.metadata.column_schema["parcel_id"].type_name == "STRING"
    assert {(r.parameters["role"], r.target_asset_id) for r in lake.lineage.collect()} == {("spatial", j["asset_id"]), ("tabular", j["asset_id"])}
    assert sink.footer_faults(sink.footer_of(j["path"]), ["geom"]) == []
    for wrong in ({**config, "left_key": "nope"}, {**config, "spatial_dataset_id": "x"}, {**config, "spatial_dataset_id": "t"}, {**config, "spatial_version": 9}):
        with pytest.raises(ValueError):
            join_datasets(lake, {"intent": "join_datasets", "files": [], "metadata": {**META, "join_config": wrong}}, "r5")
    with pytest.raises(ValueError):
        ingest_tabular(lake, {**table, "files": table["files"] * 2}, "r6")


def test_footers(spark, tmp_path):
    df = spark.range(10).select("id", F.lit(b"\x01").alias("geom"))
    sink.with_footer(df.repartition(3), str(tmp_path / "a"), sink.geo_metadata(kind="POINT"))
    sink.with_footer(df.limit(0), str(tmp_path / "b"), sink.geo_metadata())
    assert spark.read.parquet(str(tmp_path / "a")).count() == 10 and spark.read.parquet(str(tmp_path / "b")).count() == 0
    assert sink.footer_of(str(tmp_path / "a"))["columns"]["geom"]["geometry_types"] == ["Point"]
    df.write.parquet(str(tmp_path / "c"))
    assert sink.footer_faults(sink.footer_of(str(tmp_path / "c")), ["geom"]) == ["no geo metadata"]
    assert sink.footer_faults({"version": "1", "primary_column": "g", "columns": {}}, ["geom"]) == ["g isn't a column", "g isn't described"]
    assert pq.read_schema(next((tmp_path / "a").glob("*.parquet"))).names == ["id", "geom"]


def test_fingerprint(spark):
    df = spark.range(100).withColumn("b", F.col("id").cast("string"))
    a, b, other = (sink.fingerprint(d).first() for d in (df, df.repartition(7).select("b", "id"), df.limit(99)))
    assert a == b and a.fingerprint != other.fingerprint


def test_recipes(spark):
    assert len(recipe("ingest_vector")) == len(recipe("unknown")) == 3 and recipe("x") is not recipe("x")
    df = spark.createDataFrame([(1, b"\x01", 2)], "a int, geom binary, b int")
    assert run_recipe(df, recipe("ingest_building_footprints")).columns == ["a", "b", "geom"]
    with pytest.raises(ValueError):
        recipe("ingest_vector", "EPSG:31370")[0](df)


def put(folder, name, **m):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps({"batch_id": name, "uploader": "u", "intent": "ingest_tabular", "files": [{"path": "s3://landing/a.csv", "type": "tabular", "format": "CSV"}], "metadata": META, **m}))


def test_manifest_stream(spark, tmp_path):
    landing = tmp_path / "manifests"
    put(landing, "a.json")
    put(landing / "deep", "b.json", intent="ingest_vector")
    (landing / "c.json").write_text("{broken")
    (landing / "d.txt").write_text("other")
    args = (spark, str(landing), str(tmp_path / "out"), str(tmp_path / "check"))
    for turn in range(3):
        if turn == 1:
            put(landing, "e.json", intent="custom", files=[{"path": "s3://landing/a.json", "type": "vector", "format": "GeoJSON"}])
        stream.manifest_stream(*args, archive=str(tmp_path / "archive")).awaitTermination()
    requests = {r.run_key.split(":")[1]: r.lane for r in spark.read.parquet(str(tmp_path / "out/requests")).collect()}
    dead = {r.manifest_key.rsplit("/", 1)[1]: r.faults for r in spark.read.parquet(str(tmp_path / "out/dead_letters")).collect()}
    assert requests == {"a.json": "tabular", "e.json": "ingest"}
    assert dead == {"b.json": ["tabular file in another intent"], "c.json": ["not a manifest"]}
    assert {p.name for p in (tmp_path / "archive").iterdir() if p.suffix == ".json"} == {"a.json", "b.json", "c.json", "e.json"}
    assert [p.name for p in landing.rglob("*.json")] == []
    assert files.list_objects(spark, str(tmp_path), "archive/").count() == 0 and files.list_objects(spark, str(tmp_path), "archive", archive=True).count() >= 4
    assert files.object_exists(spark, str(landing)) and not files.object_exists(spark, str(landing / "x"))


def test_manifest_stream_of_lines(spark, tmp_path):
    landing, line = tmp_path / "in", lambda **m: json.dumps({"uploader": "u", "intent": "ingest_tabular", "files": [{"path": "s3://landing/a.csv", "type": "tabular", "format": "CSV"}], "metadata": META, **m})
    landing.mkdir()
    (landing / "a.jsonl").write_text("\n".join([line(batch_id="1"), "{broken", "", line(batch_id="2", uploader="\n"), line(batch_id="1"), "{other", line(batch_id="3", intent="ingest_vector")]))
    (landing / "b.jsonl").write_text(line(batch_id="4") + "\n{broken\n")
    args = (spark, str(landing), str(tmp_path / "out"), str(tmp_path / "check"))
    for _ in range(2):
        stream.manifest_stream(*args, archive=str(tmp_path / "archive"), lines=True).awaitTermination()
    assert sorted(r.run_key.split(":")[1] for r in spark.read.parquet(str(tmp_path / "out/requests")).collect()) == ["1", "2", "4"]
    dead = spark.read.parquet(str(tmp_path / "out/dead_letters")).collect()
    assert sorted((r.manifest_key.rsplit("/", 1)[1].split("#")[0], r.raw[:7]) for r in dead) == sorted([("a.jsonl", "{broken"), ("a.jsonl", "{other"), ("a.jsonl", line(batch_id="3")[:7]), ("b.jsonl", "{broken")])
    assert {p.name for p in (tmp_path / "archive").glob("*.jsonl")} == {"a.jsonl", "b.jsonl"} and not list(landing.glob("*.jsonl"))
    with pytest.raises(ValueError):
        stream.manifest_stream(*args, archive=str(tmp_path / "archive"), lanes={"ingest"}, lines=True)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_streamed_requests_makes_no_file_a_manifest(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lakeside, "_folder", lambda _: str(tmp_path))
    rows = lakeside.streamed_requests(spark, DATA).count()
    files_ = [p for p in (tmp_path / "in").iterdir() if p.suffix in (".json", ".jsonl")]
    assert rows > 100 and sum(len(p.read_text().splitlines()) for p in files_) == spark.read.parquet(f"{DATA}/manifests.parquet").select("batch_id").distinct().count()
    assert len(files_) <= 16


def test_run_events(spark, tmp_path):
    rows = [("r1", "ingest_job", "STARTED", {"batch_id": "b"}, None, 1), ("r1", "ingest_job", "FAILURE", {"batch_id": "b", "operator": "o"}, "boom", 2), ("r2", "other", "STARTED", {}, None, 1), ("r3", "ingest_job", "SUCCESS", {}, None, 1), ("r4", "join_asset_job", "STARTED", {}, None, 1)]
    df = spark.createDataFrame([(*r[:5], dt(2024, 1, 1, r[5])) for r in rows], "run_id string, job_name string, event string, tags map<string,string>, error_message string, at timestamp")
    for _ in range(2):
        stream.run_events(df, str(tmp_path))
    audit = {(r.resource_id, r.action): r.details for r in spark.read.parquet(f"{tmp_path}/activity").collect()}
    assert set(audit) == {("r1", "run_started"), ("r1", "run_failure"), ("r4", "run_started")} and audit["r1", "run_failure"]["error_message"] == "boom"
    assert {(r.run_id, r.status) for r in spark.read.parquet(f"{tmp_path}/status").collect()} == {("r1", "running"), ("r1", "failure")}


def test_cursors():
    assert stream.read_cursor(None) == [] == stream.read_cursor("  ") and stream.read_cursor("a, b,,a") == ["a", "b"]
    text = stream.write_cursor([str(i) for i in range(600)])
    assert stream.read_cursor(text) == [str(i) for i in range(100, 600)]
    assert stream.merge_keys(["a", "b"], ["a", "c"]) == ["b", "a", "c"] and stream.merge_keys(["a", "b"], ["a", "c"], False) == ["a", "b", "c"]


def test_folders(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "full").mkdir()
    (tmp_path / "full/x").write_text("x")
    assert sink.delete_folder(spark, str(tmp_path), "empty") and not sink.delete_folder(spark, str(tmp_path), "full")
    with pytest.raises(ValueError):
        sink.delete_folder(spark, str(tmp_path), "archive")
    assert sink.move(spark, str(tmp_path / "full/x"), str(tmp_path / "to/x")) and not sink.move(spark, str(tmp_path / "full/x"), str(tmp_path / "to/x"))
