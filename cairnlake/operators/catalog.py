"""Queries on the catalog: assets, manifests, runs, lineage and activity.

Lists take only the filters given, sort by time with the record's id as tie-break, and page by limit and offset; rows with
null times come last. All are one plan that ends in a top-k.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnlake.functions.names import batch_base, short_title

#: Fixed values.
ACTIONS = ("create_manifest", "rerun_manifest", "delete_manifest", "upload_file", "delete_file", "download_asset", "run_started", "run_success", "run_failure", "run_canceled")
RESOURCES = ("manifest", "file", "asset", "run")
STATUSES = ("running", "success", "failure", "canceled")


def where_given(df: DataFrame, **values) -> DataFrame:
    """Equality filters on the columns for which a value is given."""
    return reduce(lambda d, kv: d.where(F.col(kv[0]) == F.lit(kv[1])), ((k, v) for k, v in values.items() if v is not None), df)


def page(df: DataFrame, newest: str, tie: str, limit: int, offset: int = 0, once: bool = False) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` from the newest on.

    With ``once`` rows that are repeated count once: their places are found among times and ids alone, and only the rows of
    the page (``limit`` at most, so their ids can be sent) are fetched whole.
    """
    if once:
        top = page(df.select(newest, tie).distinct(), newest, tie, limit, offset).withColumnRenamed(newest, "__at")
        own = df.join(F.broadcast(top), tie).where(F.col(newest).eqNullSafe(F.col("__at"))).select(*df.columns).dropDuplicates([tie])
        return own.orderBy(F.desc_nulls_last(newest), F.asc(tie))
    out = df.orderBy(F.desc_nulls_last(newest), F.asc(tie))
    return (out.offset(offset) if offset else out).limit(limit)


def next_pages(count: int, limit: int, offset: int) -> tuple[int | None, int | None]:
    """Offsets of the next page, if this one is full, and of the one before, if there is one."""
    return (offset + limit if count == limit else None), (max(0, offset - limit) if offset > 0 else None)


def list_manifests(manifests: DataFrame, status: str | None = None, limit: int = 50) -> DataFrame:
    """Newest manifests with how many files they name."""
    top = page(where_given(manifests, status=status), "ingested_at", "batch_id", limit, once=True)
    return top.select("batch_id", "uploader", "intent", "status", F.coalesce("metadata.project", F.lit("")).alias("project"), F.coalesce(F.size("files"), F.lit(0)).alias("file_count"), "ingested_at", "completed_at")


def list_assets(assets: DataFrame, kind: str | None = None, limit: int = 50) -> DataFrame:
    """Newest assets."""
    return page(where_given(assets, kind=kind), "created_at", "asset_id", limit, once=True).select("asset_id", "dataset_id", "version", "kind", "format", F.col("metadata.title").alias("title"), "created_at")


def list_activity(logs: DataFrame, limit: int = 50, offset: int = 0, **values) -> DataFrame:
    """Newest entries of the activity log, by user, action, resource type or id."""
    return page(where_given(logs, **values), "logged_at", "log_id", limit, offset, once=True)


def list_runs(runs: DataFrame, status: str | None = None, limit: int = 25) -> DataFrame:
    """Newest runs."""
    return page(where_given(runs, status=status), "started_at", "run_id", limit, once=True)


def latest(assets: DataFrame, *keys: str) -> DataFrame:
    """The last version of every dataset, combined before the shuffle rather than sorted in a window."""
    keys = keys or ("dataset_id",)
    rest = [c for c in assets.columns if c not in (*keys, "version")]
    best = assets.groupBy(*keys).agg(F.max_by(F.struct("version", *rest), F.struct("version", "asset_id")).alias("best"))
    return best.select(*keys, "best.*").select(*assets.columns)


def versions_of(assets: DataFrame, dataset: str) -> DataFrame:
    """A dataset's versions, last first."""
    return assets.where(F.col("dataset_id") == F.lit(dataset)).select("version", "s3_key", "created_at", "content_hash").orderBy(F.desc("version"), "s3_key")


def get_asset(assets: DataFrame, dataset: str, version: int | None = None) -> DataFrame:
    """The row of a pinned version, or of the last one."""
    own = where_given(assets, dataset_id=dataset, version=version)
    return own.orderBy(F.desc("version"), "asset_id").limit(1)


def next_version(assets: DataFrame, dataset: str) -> int:
    """The number after a dataset's last version, 1 for the first."""
    return where_given(assets, dataset_id=dataset).agg(F.coalesce(F.max("version"), F.lit(0)) + 1).first()[0]


def next_versions(assets: DataFrame) -> DataFrame:
    """dataset_id, next_version of every dataset."""
    return assets.groupBy("dataset_id").agg((F.max("version") + 1).alias("next_version"))


def next_rerun(manifests: DataFrame, batch: str) -> int:
    """The number of the next run of a batch: 2 after the first, else one more than the highest so far."""
    base = re.sub(r"_v\d+$", "", batch)
    own = manifests.where(F.col("batch_id").rlike("^" + re.escape(base) + r"(_v\d+)?$"))
    number = F.regexp_extract("batch_id", r"_v(\d+)$", 1)
    return own.agg(F.greatest(F.coalesce(F.max(number.try_cast("int")), F.lit(1)), F.lit(1)) + 1).first()[0]


def next_reruns(manifests: DataFrame) -> DataFrame:
    """base, next_run of every batch."""
    number = F.regexp_extract("batch_id", r"_v(\d+)$", 1).try_cast("int")
    return manifests.groupBy(batch_base(F.col("batch_id")).alias("base")).agg((F.greatest(F.coalesce(F.max(number), F.lit(1)), F.lit(1)) + 1).alias("next_run"))


def content_exists(assets: DataFrame, content_hash: str) -> bool:
    """Whether an asset of the same content is there."""
    return not assets.where(F.col("content_hash") == F.lit(content_hash)).limit(1).isEmpty()


# --- lineage ------------------------------------------------------------------------------------------------------


#: Seconds of one bucket in the search for the version that was there at a time.
BUCKET = 3_600


def versions_at(wanted: DataFrame, have: DataFrame, keys: list[str], at: str, of: str = "created_at", bucket: int = BUCKET) -> DataFrame:
    """``wanted`` with ``it``: the greatest (version, source_asset_id) among the rows of ``have`` with the same keys whose time
    ``of`` isn't after ``at``; null where there are none.

    An as-of join: both are laid along time and the maximum so far is carried on, within buckets of time and from bucket to
    bucket, so the work is that of the rows and no task holds all versions of a dataset.
    """
    second = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (bucket * 1_000_000))
    none = F.lit(None).cast("struct<version:int,source_asset_id:string>")
    rest = [c for c in wanted.columns if c not in keys]
    left = have.where(F.col(of).isNotNull()).select(*keys, F.col(of).alias("__at"), F.lit(0).alias("__kind"), F.struct(F.col("version").cast("int").alias("version"), "source_asset_id").alias("__it"), F.lit(None).cast(wanted.select(F.struct(*rest)).schema[0].dataType).alias("__row"))
    right = wanted.select(*keys, F.col(at).alias("__at"), F.lit(1).alias("__kind"), none.alias("__it"), F.struct(*rest).alias("__row"))
    line = left.unionByName(right).withColumn("__bucket", second("__at"))
    within = Window.partitionBy(*keys, "__bucket").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = line.groupBy(*keys, "__bucket").agg(F.max("__it").alias("__most")).withColumn("__carried", F.max("__most").over(before)).drop("__most")
    met = line.withColumn("__near", F.max("__it").over(within)).where("__kind = 1")
    met = met.join(carried, [*keys, "__bucket"], "left")
    return met.select(*keys, "__row.*", F.greatest("__near", "__carried").alias("it"))


def lineage_edges(assets: DataFrame, runs: DataFrame, manifests: DataFrame) -> DataFrame:
    """source_asset_id, target_asset_id, transformation, role: joined assets to the assets that their manifest names.

    Pinned versions by number (an equi-join), others by the last version that was there when the manifest came (as-of).
    """
    joined = assets.where("kind = 'joined'").select("asset_id", "run_id").distinct()
    config = manifests.where("metadata.join_config is not null").select("batch_id", "ingested_at", "metadata.join_config.*").dropDuplicates(["batch_id"])
    named = joined.join(runs.select("run_id", "batch_id").distinct(), "run_id").join(config, "batch_id")
    sides = F.array(*[F.struct(F.lit(k).alias("role"), F.lower(F.trim(f"{k}_dataset_id")).alias("dataset_id"), F.col(f"{k}_version").alias("pinned")) for k in ("spatial", "tabular")])
    wanted = named.select(F.col("asset_id").alias("target_asset_id"), "ingested_at", F.inline(sides)).where("dataset_id is not null")
    have = assets.select(F.col("asset_id").alias("source_asset_id"), "dataset_id", "version", F.col("kind").alias("role"), "created_at")
    pinned = wanted.where("pinned is not null").select("target_asset_id", "dataset_id", "role", F.col("pinned").alias("version"))
    by_number = pinned.join(have.select("dataset_id", "role", "version", "source_asset_id").distinct(), ["dataset_id", "role", "version"])
    by_time = versions_at(wanted.where("pinned is null and ingested_at is not null").select("dataset_id", "role", "target_asset_id", "ingested_at"), have, ["dataset_id", "role"], "ingested_at")
    met = by_number.select("target_asset_id", "role", F.struct(F.col("version").cast("int").alias("version"), "source_asset_id").alias("it")).unionByName(by_time.where("it is not null").select("target_asset_id", "role", "it"))
    best = met.groupBy("target_asset_id", "role").agg(F.max("it").alias("it"))
    return best.select("it.source_asset_id", "target_asset_id", F.lit("spatial_join").alias("transformation"), "role")


def parents(edges: DataFrame, assets: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """target_asset_id with the rows of the assets it came from; edges to assets that are gone are skipped."""
    own = edges if of is None else edges.join(of.select(F.col("asset_id").alias("target_asset_id")), "target_asset_id", "left_semi")
    return own.alias("e").join(assets.alias("a"), F.expr("e.source_asset_id = a.asset_id")).select("e.target_asset_id", "e.transformation", "a.*")


def children(edges: DataFrame, assets: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """source_asset_id with the rows of the assets made from it."""
    own = edges if of is None else edges.join(of.select(F.col("asset_id").alias("source_asset_id")), "source_asset_id", "left_semi")
    return own.alias("e").join(assets.alias("a"), F.expr("e.target_asset_id = a.asset_id")).select("e.source_asset_id", "e.transformation", "a.*")


def lineage_graph(edges: DataFrame, assets: DataFrame, focal: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges one step around the focal assets; each node once, focal ones as roots."""

    def nodes(df: DataFrame, root: bool) -> DataFrame:
        return df.select(F.col("asset_id").alias("id"), "dataset_id", short_title(F.coalesce("metadata.title", "dataset_id")).alias("title"), "kind", "version", F.lit(root).alias("is_root"))

    up, down = parents(edges, assets, focal), children(edges, assets, focal)
    every = nodes(focal, True).unionByName(nodes(up, False)).unionByName(nodes(down, False))
    first = every.groupBy("id").agg(F.max_by(F.struct("dataset_id", "title", "kind", "version", "is_root"), "is_root").alias("n")).select("id", "n.*")
    lines = up.select(F.col("asset_id").alias("source"), F.col("target_asset_id").alias("target"), "transformation").unionByName(
        down.select(F.col("source_asset_id").alias("source"), F.col("asset_id").alias("target"), "transformation")
    )
    return first, lines.distinct().select(F.concat_ws("_", F.lit("edge"), "source", "target").alias("id"), "source", "target", "transformation")


# --- keyword search -----------------------------------------------------------------------------------------------


def parse_search(text: str) -> tuple[list[str], list[str], list[str]]:
    """Terms (any), phrases (all) and exclusions (none) of a search text."""
    phrases = [p.lower() for p in re.findall(r'"([^"]+)"', text)]
    rest = re.sub(r'"[^"]*"', " ", text).lower().split()
    return [w for w in rest if not w.startswith("-")], phrases, [w[1:] for w in rest if w.startswith("-") and len(w) > 1]


def tokens(c: Column) -> Column:
    """Words of text in lower case."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def search_assets(assets: DataFrame, text: str, kind: str | None = None, limit: int = 20) -> DataFrame:
    """Assets by their keywords: any term, all phrases, no exclusion; by how many terms and phrases match.

    Words are compared as they are, without stemming.
    """
    terms, phrases, out = parse_search(text)
    words = F.flatten(F.transform(F.coalesce("metadata.keywords", F.array().cast("array<string>")), lambda k: tokens(F.coalesce(k, F.lit("")))))
    whole = F.concat_ws("\n", F.transform("metadata.keywords", lambda k: F.concat(F.lit(" "), F.array_join(tokens(F.coalesce(k, F.lit(""))), " "), F.lit(" "))))
    has = lambda w: F.array_contains("__words", w)
    said = lambda p: F.col("__whole").contains(" " + " ".join(re.findall(r"[^\W_]+", p)) + " ")
    hits = [has(w).cast("int") for w in terms] + [said(p).cast("int") for p in phrases]
    found = where_given(assets, kind=kind).withColumns({"__words": words, "__whole": whole}).withColumn("score", sum(hits, F.lit(0)))
    found = reduce(lambda d, c: d.where(c), [said(p) for p in phrases] + [~has(w) for w in out], found.where("score > 0"))
    return found.drop("__words", "__whole").orderBy(F.desc("score"), "asset_id").limit(limit)


# --- writes -------------------------------------------------------------------------------------------------------


def absent(new: DataFrame, there: DataFrame, *keys: str) -> DataFrame:
    """New rows whose key isn't there yet, one per key: insert if absent."""
    return new.dropDuplicates(list(keys)).join(there.select(*keys).distinct(), list(keys), "left_anti")


def first_of(logs: DataFrame, *keys: str, by: str = "logged_at", tie: str = "log_id") -> DataFrame:
    """The first entry per key: an append that is repeated counts once."""
    rest = [c for c in logs.columns if c not in keys]
    return logs.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(by, tie)).alias("it")).select(*keys, "it.*").select(*logs.columns)


def current_state(events: DataFrame, key: str, at: str = "at") -> DataFrame:
    """Status events (key, status, error_message, at) folded to the current row per key.

    completed_at is the time of the last success for manifests' sake and of any end for runs; the error is the last one said.
    """
    ended = F.col("status").isin("success", "failure", "canceled")
    return events.groupBy(key).agg(
        F.max_by("status", F.struct(at, "status")).alias("status"), F.max(at).alias("updated_at"), F.max(F.when(ended, F.col(at))).alias("completed_at"),
        F.max_by("error_message", F.when(F.coalesce("error_message", F.lit("")) != "", F.col(at))).alias("error_message"),
    )


def link_assets(runs: DataFrame, links: DataFrame) -> DataFrame:
    """runs with the assets of ``links`` (run_id, asset_id) added to asset_ids, each once."""
    more = links.groupBy("run_id").agg(F.collect_set("asset_id").alias("__more"))
    none = F.array().cast("array<string>")
    both = F.array_union(F.coalesce("asset_ids", none), F.array_sort(F.coalesce("__more", none)))
    return runs.join(more, "run_id", "left").withColumn("asset_ids", both).drop("__more")


def asset_faults(assets: DataFrame) -> DataFrame:
    """asset_id, fault of every asset that breaks a rule of its kind."""
    spatial = F.col("kind").isin("spatial", "joined")
    b = F.col("bounds")
    rules = {
        "kind is unknown": ~F.coalesce(F.col("kind").isin("spatial", "tabular", "joined"), F.lit(False)),
        "a tabular asset has a crs": (F.col("kind") == "tabular") & F.col("crs").isNotNull(),
        "a tabular asset has bounds": (F.col("kind") == "tabular") & b.isNotNull(),
        "a spatial asset has no crs": spatial & F.col("crs").isNull(),
        "a spatial asset has no geometry type": spatial & F.col("metadata.geometry_type").isNull(),
        "there is no column schema": F.col("metadata.column_schema").isNull(),
        "the version is below 1": F.coalesce(F.col("version"), F.lit(0)) < 1,
        "bounds are reversed": (b["minx"] > b["maxx"]) | (b["miny"] > b["maxy"]),
    }
    faults = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]), lambda f: f.isNotNull())
    return assets.select("asset_id", F.explode(faults).alias("fault")).distinct()


# --- other engines' run records, migrations, keys ------------------------------------------------------------------


def run_rows(runs: DataFrame) -> DataFrame:
    """Runs as an orchestrator reports them (tags as key-value pairs, times in epoch seconds) as catalog rows."""
    tags = F.map_from_entries(F.coalesce("tags", F.array().cast("array<struct<key:string,value:string>>")))
    return runs.withColumns({"tags": tags, "started_at": F.timestamp_seconds("start_time"), "completed_at": F.timestamp_seconds("end_time")}).withColumn("batch_id", F.try_element_at("tags", F.lit("batch_id"))).drop("start_time", "end_time")


def event_rows(events: DataFrame) -> DataFrame:
    """Events with times in epoch milliseconds as timestamps."""
    return events.withColumn("at", F.timestamp_millis(F.col("timestamp").cast("long"))).drop("timestamp")


def pending(discovered: DataFrame, applied: DataFrame, version: str = "version") -> DataFrame:
    """Migrations that are there and not applied, in order."""
    return discovered.join(applied.select(version).distinct(), version, "left_anti").orderBy(version)


def last_keys(keys: DataFrame, key: str = "key", seq: str = "seq", most: int = 500) -> DataFrame:
    """The ``most`` keys seen last, each once: a top-k, not a window over everything."""
    return keys.groupBy(key).agg(F.max(seq).alias(seq)).orderBy(F.desc(seq), key).limit(most)


def primitive_tags(tags: Column) -> Column:
    """Tags without nested values, of a map from JSON."""
    return F.map_filter(tags, lambda _, v: v.isNotNull() & ~v.rlike(r"(?s)^\s*[\[{]"))
