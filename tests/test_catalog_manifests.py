"""Catalog queries, names, manifests and their rules."""

import json
import random
from datetime import datetime, timedelta
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairnlake.functions import names as n
from cairnlake.operators import catalog as c
from cairnlake.operators import manifests as m

HASH = "sha256:" + "a" * 64


@pytest.mark.parametrize("make, pairs", [
    (n.object_path, {"s3://bucket/a/b.csv": "s3://bucket/a/b.csv", " bucket/k ": "s3://bucket/k", "ab/k": None, "Bucket/k": None, "bucket": None, "bucket/": None, "-bucket/k": None, "": None, None: None}),
    (n.object_key, {"s3://b/x/y": "x/y", "x/y": "x/y"}),
    (n.virtual_path, {"s3://b/x": "/vsis3/b/x", "x": "x"}),
    (n.lake_key, {" a/b ": "a/b", "/a": None, "a/": None, " ": None}),
    (n.content_hash, {f" {HASH.upper()} ": HASH, "sha256:xyz": None, "md5:" + "a" * 64: None}),
    (n.crs, {"epsg:28354": "EPSG:28354", "EPSG:4326": "EPSG:4326", "INVALID:123": None, "4326": None, "": None, "  ": None, 'GEOGCS["WGS 84"]': 'GEOGCS["WGS 84"]', "GEOGCS[[": None, "+proj=utm +zone=55": "+proj=utm +zone=55", "+proj=utm": None, None: None}),
    (n.schema_of_run, {"abc12345-def6-7890-abcd-ef1234567890": "proc_abc12345_def6_7890_abcd_ef1234567890", "abc": None}),
    (n.run_of_schema, {"proc_abc12345_def6_7890_abcd_ef1234567890": "abc12345-def6-7890-abcd-ef1234567890", "proc_x": None, "other": None}),
    (n.file_format, {"a.GPKG": "GPKG", "a/b.tif": "GTiff", "a": "GeoJSON", "a.xyz": "GeoJSON"}),
    (n.content_type, {"a.parquet": "application/vnd.apache.parquet", "a.bin": "application/octet-stream"}),
    (n.batch_base, {"b_v2": "b", "b": "b", "b_v": "b_v"}),
    (n.rerun_number, {"b_v12": 12, "b": 1}),
    (n.endpoint, {"https://minio:9000/": ("minio:9000", True), "minio:9000": ("minio:9000", False)}),
    (n.database_of, {"mongodb://u:p@h:27017/spatial?x=1": "spatial", "mongodb://h:1": None}),
    (n.first_forwarded, {"1.2.3.4, 5.6.7.8": "1.2.3.4", "": None}),
    (n.folder_name, {"a-B_1": "a-B_1", "a b": None, "": None}),
    (n.short_title, {"x" * 51: "x" * 50 + "...", "x" * 50: "x" * 50}),
    (n.bounds_of_box, {"BOX(1 2,3 4.5)": (1.0, 2.0, 3.0, 4.5), "nope": None}),
    (n.bucket_and_key, {"s3://b/k/l": ("b", "k/l"), "b/k": None}),
])
def test_names(spark, make, pairs):
    rows = spark.createDataFrame([(k,) for k in pairs], "s string").select("s", make(F.col("s")).alias("o")).collect()
    assert {r.s: tuple(r.o) if isinstance(r.o, tuple) else r.o for r in rows} == pairs


def test_tags_and_keywords(spark):
    tags = [({"testing": " Yes ", "source": "s", "dataset_id": " d "},), ({"testing": "0.0", "ingestion_source": "i", "source": "s"},), ({"testing": "3"},), ({"testing": "maybe", "source": "", "dataset_id": " "},), (None,)]
    df = spark.createDataFrame(tags, "t map<string,string>").select(n.testing(F.col("t")), n.source_of(F.col("t")), n.dataset_of(F.col("t")))
    assert [tuple(r) for r in df.collect()] == [("true", "s", "d"), ("false", "i", None), ("true", "unknown", None), (None, "unknown", None), (None, "unknown", None)]
    words = spark.createDataFrame([(["  test  ", "test", "  ", "", "unique", "UNIQUE", None],), (None,)], "k array<string>")
    assert [r[0] for r in words.select(n.keywords(F.col("k"))).collect()] == [["test", "unique", "UNIQUE"], None]
    ids = spark.range(50).select(n.new_id("batch").alias("i")).collect()
    assert len({r.i for r in ids}) == 50 and all(len(r.i) == 18 for r in ids)


@pytest.fixture(scope="module")
def assets(spark):
    day = lambda d: dt(2024, 1, d)
    rows = [("a1", "d", 1, "spatial", HASH, day(1), ["Climate change", "water"]), ("a2", "d", 2, "spatial", "h", day(2), ["climate"]), ("a3", "t", 1, "tabular", "h", day(3), ["water rights", None]), ("a4", "j", 1, "joined", "h", None, None)]
    df = spark.createDataFrame(rows, "asset_id string, dataset_id string, version int, kind string, content_hash string, created_at timestamp, keywords array<string>")
    return df.withColumns({"metadata": F.struct(F.lit("T" * 60).alias("title"), "keywords"), "s3_key": F.lit("k"), "format": F.lit("parquet")}).drop("keywords")


def test_lists_and_versions(assets):
    ids = lambda d: [r.asset_id for r in d.collect()]
    assert ids(c.list_assets(assets)) == ["a3", "a2", "a1", "a4"] and ids(c.list_assets(assets, "spatial", 1)) == ["a2"]
    assert ids(c.get_asset(assets, "d")) == ["a2"] and ids(c.get_asset(assets, "d", 1)) == ["a1"] and ids(c.get_asset(assets, "x")) == []
    assert c.next_version(assets, "d") == 3 and c.next_version(assets, "new") == 1
    assert [r.version for r in c.versions_of(assets, "d").collect()] == [2, 1] and sorted(ids(c.latest(assets))) == ["a2", "a3", "a4"]
    assert c.content_exists(assets, HASH) and not c.content_exists(assets, "none")
    assert c.next_pages(50, 50, 0) == (50, None) and c.next_pages(10, 50, 20) == (None, 0)


@pytest.mark.parametrize("text, kind, want", [("climate water", None, ["a1", "a2", "a3"]), ('"climate change"', None, ["a1"]), ("climate -water", None, ["a2"]), ("water", "tabular", ["a3"]), ('"change water"', None, []), ("nothing", None, [])])
def test_search(assets, text, kind, want):
    assert [r.asset_id for r in c.search_assets(assets, text, kind).collect()] == want


def test_reruns(spark):
    df = spark.createDataFrame([("b",), ("b_v2",), ("b_v9",), ("bx_v50",), ("b.c",)], "batch_id string")
    assert [c.next_rerun(df, b) for b in ("b", "b_v2", "new", "b.c")] == [10, 10, 2, 2]


def test_lineage(spark, assets):
    edges = spark.createDataFrame([("a1", "a4", "spatial_join"), ("a3", "a4", "spatial_join"), ("gone", "a4", "spatial_join")], "source_asset_id string, target_asset_id string, transformation string")
    focal = assets.where("asset_id = 'a4'")
    assert {r.asset_id for r in c.parents(edges, assets, focal).collect()} == {"a1", "a3"} and c.children(edges, assets, focal).count() == 0
    nodes, lines = c.lineage_graph(edges, assets, focal)
    assert {(r.id, r.is_root, r.title) for r in nodes.collect()} == {("a4", True, "T" * 50 + "..."), ("a1", False, "T" * 50 + "..."), ("a3", False, "T" * 50 + "...")}
    assert {r.id for r in lines.collect()} == {"edge_a1_a4", "edge_a3_a4"}


def test_states_and_links(spark):
    t = lambda h: dt(2024, 1, 1, h)
    events = spark.createDataFrame([("r", "running", None, t(1)), ("r", "failure", "boom", t(2)), ("s", "running", "", t(1))], "run string, status string, error_message string, at timestamp")
    rows = {r.run: (r.status, r.completed_at, r.error_message) for r in c.current_state(events, "run").collect()}
    assert rows == {"r": ("failure", t(2), "boom"), "s": ("running", None, None)}
    runs = spark.createDataFrame([("r", ["a"]), ("s", None)], "run_id string, asset_ids array<string>")
    links = spark.createDataFrame([("r", "b"), ("r", "a"), ("s", "c")], "run_id string, asset_id string")
    assert {r.run_id: r.asset_ids for r in c.link_assets(runs, links).collect()} == {"r": ["a", "b"], "s": ["c"]}
    assert c.absent(links, links.where("asset_id = 'b'"), "run_id").count() == 1


META = {"title": "t", "description": "", "source": "s", "license": "l", "attribution": ""}
FILE = {"path": "s3://landing/a.csv", "type": "tabular", "format": "CSV"}
JOIN = {"spatial_dataset_id": "s", "tabular_dataset_id": "t", "left_key": "k"}


def manifest(intent="ingest_tabular", files=(FILE,), meta=META, **more):
    return {"batch_id": "b", "uploader": "u", "intent": intent, "files": list(files), "metadata": meta, **more}


@pytest.mark.parametrize("given, wrong", [
    (manifest(), []),
    (manifest("ingest_vector", [{**FILE, "type": "vector"}]), []),
    (manifest("join_datasets", [], {**META, "join_config": JOIN}), []),
    (manifest("ingest_vector"), ["tabular file in another intent"]),
    (manifest(files=[{**FILE, "type": "vector"}]), ["non-tabular file in ingest_tabular"]),
    (manifest(files=[]), ["no files"]),
    (manifest(files=[FILE, {**FILE, "path": "landing/a.csv"}]), ["duplicate paths"]),
    (manifest("join_datasets", [FILE], {**META, "join_config": JOIN}), ["files in join_datasets"]),
    (manifest("join_datasets", []), ["no join_config in join_datasets"]),
    (manifest("join_datasets", [], {**META, "join_config": {**JOIN, "how": "cross", "spatial_version": 0}}), ["version below 1", "unknown join type"]),
    (manifest("join_datasets", [], {**META, "join_config": {"spatial_dataset_id": "s", "left_key": "k"}}), ["missing join_config.tabular_dataset_id"]),
    (manifest(extra=1), ["unknown key"]),
    (manifest(meta={**META, "x": 1}), ["unknown key in metadata"]),
    (manifest(files=[{**FILE, "x": 1}]), ["unknown key in files"]),
    (manifest(meta={**META, "tags": {"a": {"b": 1}}}), ["nested tag"]),
    (manifest(meta={**META, "tags": {"a": 1, "b": True, "c": "x", "d": 1.5}}), []),
    (manifest(meta={k: v for k, v in META.items() if k != "license"}), ["missing metadata.license"]),
    (manifest(files=[{**FILE, "path": "x"}]), ["invalid path"]),
    (manifest(files=[{**FILE, "type": "pdf"}]), ["unknown file type"]),
    ("{not json", ["not a manifest"]),
])
def test_rules(spark, given, wrong):
    text = given if isinstance(given, str) else json.dumps(given)
    row = m.parse(spark.createDataFrame([(text,)], "raw string"), "raw").select(m.faults(F.col("manifest"), F.col("keys")).alias("f")).first()
    assert row.f == wrong


def test_requests(spark):
    rows = [manifest(meta={**META, "tags": {"dataset_id": " d1 ", "testing": "yes"}}), manifest("ingest_road_network", [{**FILE, "type": "vector"}]), manifest()]
    df = m.parse(spark.createDataFrame([(json.dumps(r), "manifests/x.json") for r in rows], "raw string, manifest_key string"), "raw")
    got = {r.run_key: (r.lane, r.tags.get("testing"), r.tags["manifest_archive_key"]) for r in m.run_requests(df).collect()}
    assert got["tabular_asset:b:d1"] == ("tabular", "true", "archive/manifests/x.json") and got["ingest:b"][0] == "ingest" and len(got) == 3
    assert m.enabled_lanes(None) == {"ingest"} == m.enabled_lanes("x, y")


def test_form(spark):
    df = spark.createDataFrame([(" t ", "", "a, ,b", "3", "x", "", "k", "")], "title string, project string, keywords string, spatial_version string, tabular_version string, how string, left_key string, right_key string")
    assert m.form_to_manifest(df).first().asDict() == {"title": "t", "project": None, "keywords": ["a", "b"], "spatial_version": 3, "tabular_version": None, "how": "left", "left_key": "k", "right_key": "k"}


@pytest.mark.parametrize("bucket", [1, 50, 10**9])
def test_version_at_a_time(spark, bucket):
    """The greatest version that was there at a time, over buckets of any length, against brute force."""
    rnd = random.Random(3)
    times = [datetime(2024, 1, 1) + timedelta(seconds=rnd.randrange(600)) for _ in range(60)]
    have = [(f"d{rnd.randrange(2)}", rnd.randrange(1, 40), f"a{i}", t) for i, t in enumerate(times)] + [("d0", 99, "never", None)]
    wanted = [(f"d{rnd.randrange(3)}", i, datetime(2024, 1, 1) + timedelta(seconds=rnd.randrange(-5, 620))) for i in range(40)] + [("d0", 40, times[0])]
    df = c.versions_at(spark.createDataFrame(wanted, "k string, i int, at timestamp_ntz"), spark.createDataFrame(have, "k string, version int, source_asset_id string, created_at timestamp_ntz"), ["k"], "at", bucket=bucket)
    got = {r.i: tuple(r.it) if r.it else None for r in df.collect()}
    assert got == {i: max(((v, a) for k, v, a, t in have if k == key and t is not None and t <= at), default=None) for key, i, at in wanted}
