"""The three pipelines: tables, vector features, and their join, from files to a version in the lake and rows in the catalog."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions.geometry import simplify, transform, with_geometry, z_order
from cairnlake.functions.types import column_schema
from cairnlake.operators import catalog
from cairnlake.operators.keyjoin import join_stats, key_join
from cairnlake.sinks import lake as sink
from cairnlake.sources.containers import read_gpkg, read_shapefile
from cairnlake.sources.files import read_csv, read_geojson, union_files

Step = Callable[[DataFrame], DataFrame]
ASSET = "asset_id string, s3_key string, dataset_id string, version int, content_hash string, run_id string, kind string, format string, crs string, bounds struct<minx:double,miny:double,maxx:double,maxy:double>, metadata struct<title:string,description:string,keywords:array<string>,source:string,license:string,attribution:string,tags:map<string,string>,header_mapping:map<string,string>,column_schema:map<string,struct<title:string,description:string,type_name:string,logical_type:string,nullable:boolean>>,geometry_type:string>, created_at timestamp, updated_at timestamp"
ACTIVITY = "logged_at timestamp, username string, action string, resource_type string, resource_id string, details map<string,string>"
MIGRATION = "version string, applied_at timestamp, duration_ms long"
LINEAGE = "source_asset_id string, target_asset_id string, run_id string, transformation string, parameters map<string,string>, created_at timestamp"


def normalize_crs(source: str, target: str = "EPSG:4326", geom: str = "geom") -> Step:
    return lambda df: with_geometry(df, geom, transform(F.col(geom), source, target))


def simplified(tolerance: float, geom: str = "geom") -> Step:
    return lambda df: with_geometry(df, geom, simplify(F.col(geom), tolerance))


def clustered(geom: str = "geom", files: int | None = None) -> Step:
    """In place of an index: rows sorted along a curve through the middles of their extents, so what lies together is
    together in files and row groups, and readers can skip those whose statistics lie elsewhere. Null extents come last."""

    def step(df: DataFrame) -> DataFrame:
        along = df.withColumn("__along", z_order(F.col(geom)))
        spread = along.repartitionByRange(files, "__along") if files else along.repartitionByRange("__along")
        return spread.sortWithinPartitions(F.col("__along").asc_nulls_last()).drop("__along")

    return step


#: Recipes by intent; others take the first. Tolerances in degrees.
TOLERANCES = {"ingest_vector": 0.0001, "ingest_road_network": 0.0001, "ingest_building_footprints": 0.001}


def recipe(intent: str, crs: str = "EPSG:4326", geom: str = "geom") -> list[Step]:
    """Fresh steps for an intent."""
    return [normalize_crs(crs, geom=geom), simplified(TOLERANCES.get(intent, TOLERANCES["ingest_vector"]), geom), clustered(geom)]


def run_recipe(df: DataFrame, steps: list[Step]) -> DataFrame:
    """One lazy plan of all steps."""
    return reduce(DataFrame.transform, steps, df)


@dataclass
class Lake:
    """The lake's folder and its catalog tables beside it."""

    spark: SparkSession
    root: str

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/catalog/{name}"
        fs, p = sink._fs(self.spark, path)
        return self.spark.read.schema(schema).parquet(path) if fs.exists(p) else self.spark.createDataFrame([], schema)

    @property
    def assets(self) -> DataFrame:
        return self._table("assets", ASSET)

    @property
    def lineage(self) -> DataFrame:
        return self._table("lineage", LINEAGE)

    def record(self, written: dict, run_id: str, kind: str, df: DataFrame, metadata: dict, crs: str | None = None, stats: dict | None = None, mapping: dict | None = None) -> dict:
        """Append the asset of a version that was written, checked by the rules of its kind."""
        stats = stats or {}
        titles = {v: k for k, v in (mapping or {}).items()}
        geometry = ("geom",) if kind != "tabular" else ()
        schema = {n: (t, d, a, b, c) for n, t, d, a, b, c in column_schema(df, geometry, titles)}
        box = tuple(stats[k] for k in ("minx", "miny", "maxx", "maxy")) if stats.get("minx") is not None else None
        known = [metadata.get(k) for k in ("title", "description", "keywords", "source", "license", "attribution", "tags")]
        asset_id = uuid.uuid4().hex[:24]
        row = (asset_id, written["s3_key"], written["dataset_id"], written["version"], written["content_hash"], run_id, kind, "parquet" if kind == "tabular" else "geoparquet", crs, box,
               (*known, mapping, schema, stats.get("geometry_type")), None, None)
        frame = self.spark.createDataFrame([row], ASSET).withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})
        if wrong := [r.fault for r in catalog.asset_faults(frame).collect()]:
            raise ValueError("; ".join(wrong))
        if not self.assets.where(F.col("s3_key") == written["s3_key"]).limit(1).isEmpty():
            raise ValueError(f"there is an asset of {written['s3_key']} already")
        sink.append(frame, f"{self.root}/catalog/assets")
        return written | {"asset_id": asset_id, "run_id": run_id}


    def log(self, username: str, action: str, resource_type: str, resource_id: str, **details: str) -> None:
        """Append an entry to the activity log; ValueError for actions and resources that aren't known."""
        if action not in catalog.ACTIONS or resource_type not in catalog.RESOURCES:
            raise ValueError(f"unknown action or resource: {action}, {resource_type}")
        row = self.spark.createDataFrame([(username, action, resource_type, resource_id, details)], ACTIVITY.replace("logged_at timestamp, ", ""))
        sink.append(row.select(F.current_timestamp().alias("logged_at"), "*"), f"{self.root}/catalog/activity")

    @property
    def activity(self) -> DataFrame:
        return self._table("activity", ACTIVITY)

    def upload(self, landing: str, key: str, content: bytes, username: str, overwrite: bool = False) -> bool:
        """A file put into the landing zone, and logged; False where one is there already."""
        done = sink.put_file(self.spark, landing, key, content, overwrite)
        if done:
            self.log(username, "upload_file", "file", key, size=str(len(content)))
        return done

    def download(self, key: str, username: str) -> bytes:
        """The bytes of an asset's file, logged; FileNotFoundError where there is none."""
        content = sink.get_file(self.spark, self.root, key)
        self.log(username, "download_asset", "asset", key, size=str(len(content)))
        return content

    def delete_upload(self, landing: str, key: str, username: str) -> bool:
        """A file removed from the landing zone, and logged."""
        done = sink.delete_file(self.spark, landing, key)
        if done:
            self.log(username, "delete_file", "file", key)
        return done

    def delete_manifest(self, landing: str, batch: str, username: str) -> None:
        """The manifest of a batch removed before it is taken up, and logged; FileNotFoundError where there is none."""
        key = f"manifests/{batch}.json"
        if "/" in batch or not sink.remove(self.spark, f"{landing}/{key}"):
            raise FileNotFoundError(key)
        self.log(username, "delete_manifest", "manifest", batch, manifest_key=key)

    def migrate(self, migrations: dict[str, Callable[[Lake], None]]) -> list[str]:
        """Run the migrations that weren't applied yet, in order of version, and record each; the versions that were run.

        One that fails isn't recorded, stops those after it and is tried again the next time. Only one of several runners
        at once applies a version.
        """
        path, ran = f"{self.root}/catalog/migrations", []
        discovered = self.spark.createDataFrame([(v,) for v in migrations], "version string")
        for r in catalog.pending(discovered, self._table("migrations", MIGRATION)).collect():  # a row per migration
            claim = f"{self.root}/catalog/.claims/{r.version}"
            if not sink.make_once(self.spark, claim):
                raise RuntimeError(f"migration {r.version} is under way or was broken off: {claim}")
            began = time.monotonic()
            try:
                migrations[r.version](self)
                took = int((time.monotonic() - began) * 1000)
                sink.append(self.spark.createDataFrame([(r.version, took)], "version string, duration_ms long").select("version", F.current_timestamp().alias("applied_at"), "duration_ms"), path)
            finally:
                sink.remove(self.spark, claim)
            ran.append(r.version)
        return ran


def dataset_id(manifest: dict) -> str:
    """The dataset a manifest's tags name, or a new one."""
    said = str((manifest["metadata"].get("tags") or {}).get("dataset_id") or "").strip()
    return said or f"dataset_{uuid.uuid4().hex[:12]}"


def ingest_tabular(lake: Lake, manifest: dict, run_id: str) -> dict:
    """One CSV file under normalized names, its join key as clean text, as the next version of its dataset."""
    if len(manifest["files"]) != 1:
        raise ValueError("a tabular manifest names one file")
    key = ((manifest["metadata"].get("join_config") or {}).get("left_key")) or None
    df, mapping = read_csv(lake.spark, manifest["files"][0]["path"], key)
    meta = dict(manifest["metadata"])
    if key:
        meta["tags"] = {**(meta.get("tags") or {}), "join_key_clean": mapping.get(key, key)}
    return lake.record(sink.write_version(df, lake.root, dataset_id(manifest)), run_id, "tabular", df, meta, mapping=mapping)


#: Readers of vector files by format, and by extension where a manifest names no format.
VECTOR = {"geojson": read_geojson, "gpkg": read_gpkg, "geopackage": read_gpkg, "shp": read_shapefile, "shapefile": read_shapefile, "esri shapefile": read_shapefile}
EXTENSIONS = {"geojson": "geojson", "json": "geojson", "geojsonl": "geojson", "gpkg": "gpkg", "zip": "shp"}


def read_vector(spark: SparkSession, file: dict) -> DataFrame:
    """The features of one file of a manifest; ValueError where its format is not known or it holds none."""
    path = file["path"]
    said = str(file.get("format") or "").strip().lower()
    kind = said or EXTENSIONS.get(path.rpartition("/")[2].rpartition(".")[2].lower())
    if kind not in VECTOR:
        raise ValueError(f"unknown vector format of {path}: {said or 'none named'}")
    df = VECTOR[kind](spark, path)
    if df.isEmpty():
        raise ValueError(f"no features in {path}")
    return df


def ingest_vector(lake: Lake, manifest: dict, run_id: str, crs: str = "EPSG:4326") -> dict:
    """Vector files of one schema, reprojected and simplified by the intent's recipe, as the next version of their dataset."""
    df = union_files([read_vector(lake.spark, f) for f in manifest["files"]])
    out = run_recipe(df, recipe(manifest["intent"], crs))
    return _spatial(lake, out, dataset_id(manifest), run_id, "spatial", manifest["metadata"])


def _spatial(lake: Lake, df: DataFrame, dataset: str, run_id: str, kind: str, metadata: dict, geo: dict | None = None) -> dict:
    written = sink.write_version(df, lake.root, dataset, geo or sink.geo_metadata())
    back = lake.spark.read.parquet(written["path"])
    stats = join_stats(back).first().asDict()
    return lake.record(written, run_id, kind, back, metadata, "EPSG:4326", stats) | {"row_count": stats["row_count"]}


def join_datasets(lake: Lake, manifest: dict, run_id: str) -> dict:
    """The tabular rows of a join manifest with the geometry of its features, as the next version, with lineage to both."""
    config = manifest["metadata"]["join_config"]
    inputs = {}
    for kind in ("spatial", "tabular"):
        dataset, version = config[f"{kind}_dataset_id"], config.get(f"{kind}_version")
        row = catalog.get_asset(lake.assets, dataset, version).first()
        if row is None:
            raise ValueError(f"{kind} dataset not found: {dataset} ({version or 'latest'})")
        if row.kind != kind:
            raise ValueError(f"{dataset} is {row.kind} and not {kind}")
        inputs[kind] = row
    frames = {k: lake.spark.read.parquet(f"{lake.root}/{r.s3_key}") for k, r in inputs.items()}
    how, left, right = config.get("how") or "left", config["left_key"], config.get("right_key") or config["left_key"]
    joined = key_join(frames["tabular"], frames["spatial"], left, right, how, hot=True)
    geo = sink.footer_of(f"{lake.root}/{inputs['spatial'].s3_key}")
    if wrong := sink.footer_faults(geo, joined.columns):
        raise ValueError("; ".join(wrong))
    out = _spatial(lake, joined, dataset_id(manifest), run_id, "joined", manifest["metadata"], geo)
    edges = [(inputs[k].asset_id, out["asset_id"], run_id, "spatial_join", {"role": k, n: key, "how": how}) for k, n, key in (("spatial", "right_key", right), ("tabular", "left_key", left))]
    frame = lake.spark.createDataFrame(edges, LINEAGE.rsplit(", ", 1)[0]).withColumn("created_at", F.current_timestamp())
    sink.append(frame, f"{lake.root}/catalog/lineage")
    return out
