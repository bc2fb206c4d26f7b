"""Schemas that drift between versions and files: every change, and all files as one consistent table.

Method: each version of a dataset has a fingerprint of its columns. Where it differs from that of the version before,
the migration between the two is laid down as steps (renamed, removed, added, retyped). A file is read under the schema
of its own version and each of its columns is routed through the chain of later renames to its last name; values are cast
to the last type, and columns that came later are filled with null.

The version before is found among the versions' numbers alone, in buckets, so that a dataset with very many versions is
spread over many tasks; schemas are joined by (dataset, version). Chains of renames are followed by pointer doubling.

Defined results: rows without dataset or version take no part; of rows with the same dataset and version the last created
counts; a null schema has no columns; titles without letters or digits match nothing; among equal titles the k-th gone
column meets the k-th that comes; empty inputs give an empty result; other columns play no part.
"""

from __future__ import annotations

import csv
import io
import json
from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce
from itertools import count

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnlake.lineage import cut_lineage

#: Versions of one bucket in the search for the version before.
BUCKET = 1_024
CHANGE = "dataset_id string, version int, change string, old_name string, new_name string"

#: Canonical type names by the spelling of the logical type they are implied by (patterns, first match counts).
IMPLIED = (
    (r"^(large_)?(string|utf8)", "STRING"),
    (r"^u?int(8|16|32|64)?$", "INTEGER"),
    (r"^(half_?float|float(16|32|64)?|double)$", "FLOAT"),
    (r"^bool(ean)?$", "BOOLEAN"),
    (r"^timestamp", "TIMESTAMP"),
    (r"^date(32|64)?", "DATE"),
    (r"^time(32|64)", "TIME"),
    (r"^decimal", "DECIMAL"),
    (r"^(large_|fixed_size_)?binary", "BINARY"),
    (r"^(geometry|geoarrow|wkb)", "GEOMETRY"),
    (r"^(large_|fixed_size_)?list", "ARRAY"),
    (r"^struct", "STRUCT"),
    (r"^map", "MAP"),
)


def canonical_type(type_name: Column, logical_type: Column) -> Column:
    """type_name in upper case, or where it is null or blank what the logical type implies, else UNKNOWN."""
    said = F.nullif(F.upper(F.trim(type_name)), F.lit(""))
    logical = F.lower(F.trim(logical_type))
    implied = reduce(lambda w, p: w.when(logical.rlike(p[0]), F.lit(p[1])), IMPLIED[1:], F.when(logical.rlike(IMPLIED[0][0]), F.lit(IMPLIED[0][1])))
    return F.coalesce(said, implied, F.lit("UNKNOWN"))


def columns_of(schema: Column) -> Column:
    """A column_schema map as an array of (name, title, type), ordered by name; ``title`` has only letters and digits."""
    return F.array_sort(
        F.transform(
            F.coalesce(F.map_entries(schema), F.array()),
            lambda e: F.struct(
                e["key"].alias("name"),
                F.regexp_replace(F.lower(F.coalesce(e["value"]["title"], F.lit(""))), r"[^\p{L}\p{N}]", "").alias("title"),
                canonical_type(e["value"]["type_name"], e["value"]["logical_type"]).alias("type"),
            ),
        )
    )


def _rows(assets: DataFrame) -> DataFrame:
    order = F.struct("created_at", "asset_id").alias("order")
    return assets.where("dataset_id is not null and version is not null").select("dataset_id", F.col("version").cast("int").alias("version"), "run_id", columns_of(F.col("metadata.column_schema")).alias("columns"), order)


def versions(assets: DataFrame) -> DataFrame:
    """dataset_id, version, columns, fingerprint: one row per version."""
    one = _rows(assets).groupBy("dataset_id", "version").agg(F.max_by("columns", "order").alias("columns"))
    return one.withColumn("fingerprint", F.xxhash64("columns"))


def successions(assets: DataFrame, formats: DataFrame | None = None, bucket: int = BUCKET) -> DataFrame:
    """dataset_id, version, before, format, old_format: each version with the one before it among those that are there.

    Works on the versions' numbers and formats (``formats``: run_id, format) alone, without their schemas.
    """
    keys = _rows(assets).groupBy("dataset_id", "version").agg(F.max_by("run_id", "order").alias("run_id"))
    keys = keys.withColumn("format", F.lit(None).cast("string")) if formats is None else keys.join(formats, "run_id", "left")
    keys = keys.select("dataset_id", F.floor(F.col("version") / bucket).alias("bucket"), F.struct("version", "format").alias("it"))
    last = keys.groupBy("dataset_id", "bucket").agg(F.max("it").alias("last"))
    last = last.withColumn("carried", F.lag("last").over(Window.partitionBy("dataset_id").orderBy("bucket"))).drop("last")
    within = keys.withColumn("near", F.lag("it").over(Window.partitionBy("dataset_id", "bucket").orderBy("it")))
    met = within.join(last, ["dataset_id", "bucket"]).withColumn("was", F.coalesce("near", "carried")).where("was is not null")
    return met.select("dataset_id", "it.version", "it.format", F.col("was.version").alias("before"), F.col("was.format").alias("old_format"))


def formats_by_run(runs: DataFrame, manifests: DataFrame, names: DataFrame) -> DataFrame:
    """run_id, format: the canonical formats of the files of the manifest behind a run; several are joined by commas."""
    said = manifests.select("batch_id", F.explode("files.format").alias("said")).select("batch_id", F.lower(F.trim("said")).alias("alias")).distinct()
    by_batch = said.join(names, "alias").groupBy("batch_id").agg(F.array_join(F.array_sort(F.collect_set("canonical")), ",").alias("format"))
    return runs.where("run_id is not null").select("run_id", "batch_id").distinct().join(by_batch, "batch_id").groupBy("run_id").agg(F.min("format").alias("format"))


def _numbered(columns: Column) -> Column:
    """Columns with their place among those of the same title."""
    return F.transform(columns, lambda c, i: F.struct(c["name"].alias("name"), c["title"].alias("title"), c["type"].alias("type"), F.size(F.filter(F.slice(columns, 1, i), lambda d: d["title"] == c["title"])).alias("nth")))


def migration(old: Column, new: Column) -> Column:
    """The steps from one version's columns to the next: array of (change, old_name, new_name)."""
    old_names, new_names = old["name"], new["name"]
    gone_names, come_names = F.array_except(old_names, new_names), F.array_except(new_names, old_names)
    gone = _numbered(F.filter(old, lambda c: F.array_contains(gone_names, c["name"])))
    come = _numbered(F.filter(new, lambda c: F.array_contains(come_names, c["name"])))

    def same(a: Column, b: Column) -> Column:
        return (a["title"] == b["title"]) & (a["title"] != "") & (a["nth"] == b["nth"])

    def step(change: str, a: Column, b: Column) -> Column:
        return F.struct(F.lit(change).alias("change"), a.alias("old_name"), b.alias("new_name"))

    moved = F.flatten(F.transform(gone, lambda g: F.transform(F.filter(come, lambda c: same(g, c)), lambda c: F.struct(g["name"].alias("a"), c["name"].alias("b"), g["type"].alias("ta"), c["type"].alias("tb")))))
    typed = lambda cs: F.transform(cs, lambda c: F.struct(c["name"].alias("name"), c["type"].alias("type")))
    other = F.filter(F.array_except(typed(old), typed(new)), lambda c: ~F.array_contains(gone_names, c["name"]))
    return F.concat(
        F.transform(moved, lambda m: step("renamed", m["a"], m["b"])),
        F.transform(F.filter(moved, lambda m: m["ta"] != m["tb"]), lambda m: step("retyped", m["a"], m["b"])),
        F.transform(other, lambda c: step("retyped", c["name"], c["name"])),
        F.transform(F.filter(gone, lambda g: ~F.exists(come, lambda c: same(g, c))), lambda g: step("removed", g["name"], F.lit(""))),
        F.transform(F.filter(come, lambda c: ~F.exists(gone, lambda g: same(g, c))), lambda c: step("added", F.lit(""), c["name"])),
    )


def schema_changes(one: DataFrame, order: DataFrame) -> DataFrame:
    """CHANGE rows of every two versions that follow one another: ``versions`` in the order of ``successions``."""
    old = one.select("dataset_id", F.col("version").alias("before"), F.col("columns").alias("old"), F.col("fingerprint").alias("old_print"))
    met = one.join(order, ["dataset_id", "version"]).join(old, ["dataset_id", "before"])
    differ = (F.col("fingerprint") != F.col("old_print")) | (F.col("columns") != F.col("old"))
    met = met.where(differ | (F.col("format") != F.col("old_format")))
    of_columns = F.when(differ, migration(F.col("old"), F.col("columns")))
    of_format = F.when(F.col("format") != F.col("old_format"), F.array(F.struct(F.lit("format").alias("change"), F.col("old_format").alias("old_name"), F.col("format").alias("new_name"))))
    none = F.array().cast("array<struct<change:string,old_name:string,new_name:string>>")
    return met.select("dataset_id", "version", F.inline(F.concat(F.coalesce(of_columns, none), F.coalesce(of_format, none))))


def last_names(one: DataFrame, changes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """dataset_id, version, name, last_name: what each column of each version is called in the end.

    A column's next event is its first rename or removal in a later version, looked for within a bucket of versions and else
    among the first events of the buckets after it, so that no task holds all versions of a dataset. Renames lead on to the
    event after them; doubling follows a chain of any length in as many rounds as its length has binary digits.
    """
    leave = changes.where("change in ('renamed', 'removed')").select("dataset_id", F.col("old_name").alias("name"), F.col("version").alias("at"), F.when(F.col("change") == "renamed", F.col("new_name")).alias("to"))
    here = one.select("dataset_id", F.col("version").alias("at"), F.explode("columns.name").alias("name"))
    # at one version a column's leaving (0) comes before what is there under its name (1)
    line = leave.select("dataset_id", "name", "at", F.lit(0).alias("kind"), F.struct("at", "to").alias("leaves")).unionByName(
        here.select("dataset_id", "name", "at", F.lit(1).alias("kind"), F.lit(None).cast("struct<at:int,to:string>").alias("leaves"))
    ).withColumn("bucket", F.floor(F.col("at") / bucket))
    # what comes next is what came last in reverse order, where the frame only grows
    ahead = Window.partitionBy("dataset_id", "name", "bucket").orderBy(F.desc("at"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("dataset_id", "name").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    heads = line.groupBy("dataset_id", "name", "bucket").agg(F.min("leaves").alias("head")).withColumn("carried", F.last("head", ignorenulls=True).over(later)).drop("head")
    seen = line.withColumn("near", F.last("leaves", ignorenulls=True).over(ahead)).where("kind = 1").join(heads, ["dataset_id", "name", "bucket"]).withColumn("next", F.coalesce("near", "carried"))
    node = seen.select("dataset_id", "at", "name", F.coalesce(F.when(F.col("next.to").isNotNull(), F.col("next.at")), F.col("at")).alias("to_at"), F.coalesce("next.to", "name").alias("to_name"))
    node = cut_lineage(node)
    while True:  # every hop leads to a later version, so chains end
        hop = node.where("at <> to_at").select("dataset_id", F.col("at").alias("to_at"), F.col("name").alias("to_name"), F.col("to_at").alias("end_at"), F.col("to_name").alias("end_name"))
        if hop.isEmpty():
            break
        moved = node.join(hop, ["dataset_id", "to_at", "to_name"], "left")
        node = cut_lineage(moved.select("dataset_id", "at", "name", F.coalesce("end_at", "to_at").alias("to_at"), F.coalesce("end_name", "to_name").alias("to_name"), F.col("end_at").isNotNull().alias("hopped")))
        if node.where("hopped").isEmpty():
            break
        node = node.drop("hopped")
    return node.select("dataset_id", F.col("at").alias("version"), "name", F.col("to_name").alias("last_name"))


#: What counts as no value in a file.
BLANK = ("", "NA")
#: Label of what a file holds that is no record of its format.
ODD = "_unparsed"
_OTHER = regex.compile(r"[^\p{L}\p{N}]")
_SEPARATORS = "\t;|,"


class _Record(list):
    """The (key, value) pairs of a JSON record, repeated keys too."""


class _Number(str):
    """A JSON number as it is written."""


def _json_text(value: object) -> str:
    if isinstance(value, _Record):
        return "{" + ", ".join(f"{json.dumps(k, ensure_ascii=False)}: {_json_text(v)}" for k, v in value) + "}"
    if isinstance(value, list):
        return "[" + ", ".join(map(_json_text, value)) + "]"
    return str(value) if isinstance(value, _Number) else json.dumps(value, ensure_ascii=False)


def _said(value: object) -> str | None:
    """A JSON value as a cell: text and numbers as they are written, lists and records as JSON."""
    return None if value is None else str(value) if isinstance(value, str) else _json_text(value)


_load = partial(json.loads, parse_float=_Number, parse_int=_Number, parse_constant=_Number, object_pairs_hook=_Record)


def _json_records(payload: str) -> list[list[tuple[str, str | None]]]:
    """The records of a JSON text: one record, a list of them, or one a line."""
    try:
        found = _load(payload)
        whole = found if isinstance(found, list) and not isinstance(found, _Record) else [found]
    except (ValueError, RecursionError):
        whole = []
        for line in filter(str.strip, payload.splitlines()):
            try:
                whole.append(_load(line))
            except (ValueError, RecursionError):
                whole.append(line)
    return [[(k, _said(v)) for k, v in r] if isinstance(r, _Record) else [(ODD, _said(r))] for r in whole]


def _csv_records(payload: str) -> list[list[tuple[str, str | None]]]:
    """The records of a separated text under its first line; quoted values may hold separators, quotes and line breaks."""
    csv.field_size_limit(max(len(payload), 1 << 17))
    head = next(filter(str.strip, payload.splitlines()), "")
    separator = next((s for s in _SEPARATORS if s in head), ",")
    lines = (r for r in csv.reader(io.StringIO(payload, newline=""), delimiter=separator, skipinitialspace=True) if any(map(str.strip, r)))
    labels = [c.strip() for c in next(lines, [])]
    return [[*zip(labels, r), *[(ODD, v) for v in r[len(labels) :]]] for r in lines]


def records_of(payload: str, canonical: str | None) -> list[list[tuple[str, str | None]]]:
    """The records of a file's text as (label, value) in order."""
    return _json_records(payload) if canonical in ("JSONL", "JSON") else _csv_records(payload)


def file_cells(files: DataFrame, names: DataFrame) -> DataFrame:
    """dataset_id, version, file_id, row_no, label, title, nth, value of every cell of every file, whatever its layout.

    JSON by its keys; else the first line is the header, and the separator is the one of tab, semicolon, bar and comma that
    it holds. ``nth`` numbers a record's labels of one title; of equal labels the later ones get the suffixes _1, _2 and so
    on. What is no record, and values beyond the header, come under the label ODD. Repeated files count once; null payloads have no cells.
    """
    kind = files.select("dataset_id", "version", "file_id", "payload", F.lower(F.trim("format")).alias("alias")).where("payload is not null").distinct().join(names, "alias", "left")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (payload, canonical) in enumerate(zip(b.column("payload").to_pylist(), b.column("canonical").to_pylist())):
                out = []
                for row, record in enumerate(records_of(payload, canonical)):
                    seen: Counter = Counter()
                    labels: set[str] = set()
                    for label, value in record:
                        title = _OTHER.sub("", label.lower())
                        own = label if label not in labels else next(o for k in count(1) if (o := f"{label}_{k}") not in labels)
                        labels.add(own)
                        out.append((row, own, title, seen[title], value))
                        seen[title] += 1
                cells = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string()))]
                own = b.slice(i, 1).select(["dataset_id", "version", "file_id"]).take(pa.array([0] * len(out), pa.int32()))
                yield pa.record_batch([*own.columns, *cells], [*own.schema.names, "row_no", "label", "title", "nth", "value"])

    keys = ", ".join(f"{c} {kind.schema[c].dataType.simpleString()}" for c in ("dataset_id", "version", "file_id"))
    return kind.select("dataset_id", "version", "file_id", "payload", "canonical").mapInArrow(parsed, f"{keys}, row_no int, label string, title string, nth int, value string")


def cast_value(value: Column, kind: Column) -> Column:
    """A cell's text as its type writes it; null where it is blank or isn't of the type. Times are UTC unless they say else."""
    text = F.when(~F.trim(value).isin(*BLANK), F.trim(value))
    whole = F.regexp_replace(F.regexp_replace(text, r"^\+", ""), r"^(-?)0+(?=[0-9])", "$1")
    day = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]|$)"), text)
    zoned = F.when(day.rlike(r"[T ].*(Z|[+-]\d{2}:?\d{2})$"), day)
    utc = F.coalesce(F.expr("timestamp_ntz '1970-01-01'") + F.make_dt_interval(secs=F.unix_micros(zoned.try_cast("timestamp")).cast("decimal(20,0)") / 1_000_000), day.try_cast("timestamp_ntz"))
    return (
        F.when(kind == "INTEGER", F.when(text.rlike(r"^[+-]?[0-9]+$"), F.when(whole == "-0", F.lit("0")).otherwise(whole)))
        .when(kind.isin("FLOAT", "DECIMAL"), F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text))
        .when(kind == "BOOLEAN", F.when(F.lower(text).isin("true", "false"), F.lower(text)))
        .when(kind == "DATE", F.substring(day, 1, 10).try_cast("date").cast("string"))
        .when(kind == "TIMESTAMP", F.concat(F.replace(utc.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z")))
        .otherwise(text)
    )


def last_schema(one: DataFrame) -> DataFrame:
    """dataset_id, last_name, last_type of the columns of every dataset's last version."""
    return one.groupBy("dataset_id").agg(F.max_by("columns", "version").alias("columns")).select("dataset_id", F.inline("columns")).select("dataset_id", F.col("name").alias("last_name"), F.col("type").alias("last_type"))


def consistent_rows(files: DataFrame, one: DataFrame, changes: DataFrame, names: DataFrame) -> DataFrame:
    """dataset_id, file_id, version, row_no, column_name, type_name, value, unfit: all files under the last schema of their dataset.

    A file's label is a column's name or its title; of columns with one title the k-th by name is the k-th label of it.
    Columns removed later keep the name and type they had in the end. Columns of the last schema that a file lacks come out
    with a null value. What isn't of the type is no value and stays, as it was written, in ``unfit``.
    """
    schema = one.select("dataset_id", "version", F.inline(_numbered(F.col("columns")))).withColumnRenamed("type", "own_type")
    route = schema.join(last_names(one, changes), ["dataset_id", "version", "name"])
    last = last_schema(one)
    routed = cut_lineage(route.join(last, ["dataset_id", "last_name"], "left").withColumn("type_name", F.coalesce("last_type", "own_type")))
    cells = cut_lineage(file_cells(files, names))
    by_name = cells.join(routed.select("dataset_id", "version", F.col("name").alias("label"), F.col("last_name").alias("n1"), F.col("type_name").alias("t1")), ["dataset_id", "version", "label"], "left")
    titled = routed.where("title <> ''").select("dataset_id", "version", "title", "nth", F.col("last_name").alias("n2"), F.col("type_name").alias("t2"))
    met = by_name.join(titled, ["dataset_id", "version", "title", "nth"], "left")
    kind = F.coalesce("t1", "t2", F.lit("STRING"))
    filled = met.select("dataset_id", "file_id", "version", "row_no", F.coalesce("n1", "n2", "label").alias("column_name"), kind.alias("type_name"), cast_value(F.col("value"), kind).alias("value"), F.col("value").alias("said"))
    said = F.when(F.col("value").isNull() & ~F.trim("said").isin(*BLANK), F.col("said"))
    filled = filled.withColumn("unfit", said).drop("said")
    rows = cells.select("dataset_id", "file_id", "version", "row_no").distinct()
    absent = rows.join(last, "dataset_id").select(*rows.columns, F.col("last_name").alias("column_name"), F.col("last_type").alias("type_name"))
    absent = absent.join(filled, [*rows.columns, "column_name"], "left_anti").withColumns({"value": F.lit(None).cast("string"), "unfit": F.lit(None).cast("string")})
    return filled.unionByName(absent)


#: Spark types of the canonical ones; others stay text.
TYPED = {"INTEGER": "decimal(38,0)", "FLOAT": "double", "DECIMAL": "decimal(38,10)", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def typed_table(rows: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """file_id, version, row_no and ``columns`` (name, canonical type) as typed columns, of one dataset's ``consistent_rows``.

    What a type cannot hold is null here and stays in ``rows``.
    """
    wide = rows.groupBy("file_id", "version", "row_no").agg(*[F.max(F.when(F.col("column_name") == n, F.col("value"))).alias(n) for n, _ in columns])
    text = lambda n, t: F.regexp_replace(F.col(f"`{n}`"), "Z$", "") if t == "TIMESTAMP" else F.col(f"`{n}`")
    return wide.select("file_id", "version", "row_no", *[text(n, t).try_cast(TYPED.get(t, "string")).alias(n) for n, t in columns])
