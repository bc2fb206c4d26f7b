"""Problem 5 on the catalog tables: schemas and formats that drift, and raw files as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.lineage import cut_lineage
from cairnlake.operators.drift import consistent_rows, formats_by_run, schema_changes, successions, versions
from cairnlake.skew import broadcast_if_small
from cairnlake.sources.tables import table


def _changes(spark: SparkSession, d: str) -> DataFrame:
    assets = table(spark, d, "assets")
    formats = formats_by_run(table(spark, d, "runs"), table(spark, d, "manifests"), table(spark, d, "format_names"))
    return schema_changes(versions(assets), successions(assets, formats))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Every change from one version of a dataset to the next."""
    return _changes(spark, d)


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Changes by kind, and in how many datasets."""
    return p5_found(spark, d).groupBy("change").agg(F.count(F.lit(1)).alias("changes"), F.countDistinct("dataset_id").alias("datasets"))


def p5_table(spark: SparkSession, d: str) -> DataFrame:
    """All raw files as one table under the last schema of their dataset, a row per cell. Only schemas of datasets that have
    files are followed, and each is worked out once."""
    files = table(spark, d, "raw_files")
    with_files, _ = broadcast_if_small(files.select("dataset_id").distinct())
    assets = table(spark, d, "assets").join(with_files, "dataset_id", "left_semi")
    one = cut_lineage(versions(assets))
    changes = cut_lineage(schema_changes(one, successions(assets)))
    return consistent_rows(files, one, changes, table(spark, d, "format_names"))


_TITLE = r"regexp_replace(lower(e.value.title), '[^\p{L}\p{N}]', '', 'g')"
_TYPE = """coalesce(upper(e.value.type_name), CASE
           WHEN e.value.logical_type LIKE '%string%' THEN 'STRING' WHEN e.value.logical_type LIKE 'int%' OR e.value.logical_type LIKE 'uint%' THEN 'INTEGER'
           WHEN e.value.logical_type IN ('float', 'double') THEN 'FLOAT' WHEN e.value.logical_type LIKE 'bool%' THEN 'BOOLEAN'
           WHEN e.value.logical_type LIKE 'timestamp%' THEN 'TIMESTAMP' WHEN e.value.logical_type LIKE 'date%' THEN 'DATE'
           WHEN e.value.logical_type LIKE 'decimal%' THEN 'DECIMAL' WHEN e.value.logical_type LIKE 'geometry%' THEN 'GEOMETRY' ELSE 'UNKNOWN' END)"""
_FOUND = r"""
WITH one AS (
  SELECT dataset_id, version, arg_max(run_id, (created_at, asset_id)) AS run_id, arg_max(metadata.column_schema, (created_at, asset_id)) AS cs FROM assets GROUP BY ALL
), fmt AS (
  SELECT r.run_id, min(f.format) AS format FROM runs r JOIN (
    SELECT batch_id, string_agg(DISTINCT canonical, ',' ORDER BY canonical) AS format
    FROM (SELECT batch_id, lower(trim(unnest(files).format)) AS alias FROM manifests) JOIN format_names USING (alias) GROUP BY batch_id) f USING (batch_id)
  GROUP BY r.run_id
), v AS (
  SELECT dataset_id, version, cs, format, lag(version) OVER w AS before, lag(cs) OVER w AS old_cs, lag(format) OVER w AS old_format
  FROM one LEFT JOIN fmt USING (run_id) WINDOW w AS (PARTITION BY dataset_id ORDER BY version)
), pairs AS (SELECT * FROM v WHERE before IS NOT NULL),
cols AS (
  SELECT dataset_id, version, side, e.key AS name, {title} AS title, {type} AS type
  FROM (SELECT dataset_id, version, 'new' AS side, unnest(map_entries(cs)) AS e FROM pairs
        UNION ALL SELECT dataset_id, version, 'old', unnest(map_entries(old_cs)) FROM pairs)
), o AS (SELECT * FROM cols WHERE side = 'old'), n AS (SELECT * FROM cols WHERE side = 'new'),
gone AS (SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.dataset_id = o.dataset_id AND n.version = o.version AND n.name = o.name)),
come AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE n.dataset_id = o.dataset_id AND n.version = o.version AND n.name = o.name)),
moved AS (
  SELECT coalesce(g.dataset_id, c.dataset_id) AS dataset_id, coalesce(g.version, c.version) AS version, g.name AS a, c.name AS b, g.type AS ta, c.type AS tb
  FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, version, title ORDER BY name) AS k FROM gone) g
  FULL JOIN (SELECT *, row_number() OVER (PARTITION BY dataset_id, version, title ORDER BY name) AS k FROM come) c
  ON g.dataset_id = c.dataset_id AND g.version = c.version AND g.title = c.title AND g.k = c.k AND g.title <> ''
), changes AS (
  SELECT dataset_id, version, CASE WHEN b IS NULL THEN 'removed' WHEN a IS NULL THEN 'added' ELSE 'renamed' END AS change, coalesce(a, '') AS old_name, coalesce(b, '') AS new_name FROM moved
  UNION ALL SELECT dataset_id, version, 'retyped', a, b FROM moved WHERE ta <> tb
  UNION ALL SELECT n.dataset_id, n.version, 'retyped', n.name, n.name FROM n JOIN o ON n.dataset_id = o.dataset_id AND n.version = o.version AND n.name = o.name WHERE n.type <> o.type
  UNION ALL SELECT dataset_id, version, 'format', old_format, format FROM pairs WHERE format <> old_format
)
""".replace("{title}", _TITLE).replace("{type}", _TYPE)
_TABLE = r""", sch AS (
  SELECT dataset_id, version, name, title, type, row_number() OVER (PARTITION BY dataset_id, version, title ORDER BY name) - 1 AS nth
  FROM (SELECT dataset_id, version, e.key AS name, {title} AS title, {type} AS type FROM (SELECT dataset_id, version, unnest(map_entries(cs)) AS e FROM one))
), leave AS (
  SELECT dataset_id, old_name AS name, version AS at_v, CASE WHEN change = 'renamed' THEN new_name END AS to_name FROM changes WHERE change IN ('renamed', 'removed')
), nxt AS (
  SELECT s.dataset_id, s.version, s.name, min({'at_v': l.at_v, 'to_name': l.to_name}).at_v AS at_v, min({'at_v': l.at_v, 'to_name': l.to_name}).to_name AS to_name
  FROM sch s JOIN leave l ON s.dataset_id = l.dataset_id AND s.name = l.name AND s.version < l.at_v GROUP BY s.dataset_id, s.version, s.name
), route(dataset_id, version, name, at_v, cur) AS (
  SELECT dataset_id, version, name, version, name FROM sch
  UNION ALL SELECT r.dataset_id, r.version, r.name, n.at_v, n.to_name FROM route r JOIN nxt n ON n.dataset_id = r.dataset_id AND n.version = r.at_v AND n.name = r.cur WHERE n.to_name IS NOT NULL
), ends AS (SELECT dataset_id, version, name, arg_max(cur, at_v) AS last_name FROM route GROUP BY ALL),
newest AS (SELECT dataset_id, max(version) AS version FROM one GROUP BY dataset_id),
last AS (SELECT s.dataset_id, s.name AS last_name, s.type AS last_type FROM sch s JOIN newest USING (dataset_id, version)),
routed AS (SELECT s.*, e.last_name, coalesce(l.last_type, s.type) AS type_name FROM sch s JOIN ends e USING (dataset_id, version, name) LEFT JOIN last l ON l.dataset_id = s.dataset_id AND l.last_name = e.last_name),
f AS (
  SELECT DISTINCT dataset_id, version, file_id, canonical, list_filter(string_split_regex(payload, '\r\n|\n|\r'), lambda x: trim(x) <> '') AS lines
  FROM raw_files LEFT JOIN format_names ON alias = lower(trim(format)) WHERE payload IS NOT NULL
), j AS (SELECT dataset_id, version, file_id, generate_subscripts(lines, 1) - 1 AS row_no, unnest(lines) AS line FROM f WHERE canonical = 'JSONL'),
jk AS (SELECT * EXCLUDE (line), line, unnest(json_keys(line)) AS label FROM j),
sep AS (SELECT *, CASE WHEN contains(lines[1], chr(9)) THEN chr(9) WHEN contains(lines[1], ';') THEN ';' WHEN contains(lines[1], '|') THEN '|' ELSE ',' END AS s FROM f WHERE coalesce(canonical, '') <> 'JSONL'),
c AS (SELECT dataset_id, version, file_id, string_split(lines[1], s) AS labels, s, generate_subscripts(lines[2:], 1) - 1 AS row_no, unnest(lines[2:]) AS line FROM sep),
ck AS (SELECT dataset_id, version, file_id, row_no, unnest(list_zip(labels, string_split(line, s))) AS z FROM c),
cells AS (
  SELECT *, regexp_replace(lower(label), '[^\p{L}\p{N}]', '', 'g') AS title FROM (
    SELECT dataset_id, version, file_id, row_no, label, json_extract_string(line, '$."' || label || '"') AS value FROM jk
    UNION ALL SELECT dataset_id, version, file_id, row_no, trim(z[1]), z[2] FROM ck)
), met AS (
  SELECT c.dataset_id, c.file_id, c.version, c.row_no, coalesce(a.last_name, b.last_name, c.label) AS column_name, coalesce(a.type_name, b.type_name, 'STRING') AS type_name, c.value AS said,
         CASE WHEN trim(c.value) NOT IN ('', 'NA') THEN trim(c.value) END AS t
  FROM cells c LEFT JOIN routed a ON a.dataset_id = c.dataset_id AND a.version = c.version AND a.name = c.label
  LEFT JOIN routed b ON b.dataset_id = c.dataset_id AND b.version = c.version AND b.title = c.title AND b.nth = 0 AND b.title <> ''
), filled AS (
  SELECT *, CASE type_name WHEN 'INTEGER' THEN CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') THEN regexp_replace(t, '^(-?)[+]?0*([0-9])', '\1\2') END
    WHEN 'FLOAT' THEN CASE WHEN try_cast(t AS DOUBLE) IS NOT NULL THEN t END WHEN 'DECIMAL' THEN CASE WHEN try_cast(t AS DOUBLE) IS NOT NULL THEN t END
    WHEN 'BOOLEAN' THEN CASE WHEN lower(t) IN ('true', 'false') THEN lower(t) END
    WHEN 'DATE' THEN CASE WHEN regexp_matches(t, '^\d{4}-\d{2}-\d{2}([T ]|$)') THEN try_cast(try_cast(left(t, 10) AS DATE) AS VARCHAR) END
    WHEN 'TIMESTAMP' THEN CASE WHEN regexp_matches(t, '^\d{4}-\d{2}-\d{2}([T ]|$)') THEN strftime(try_cast(rtrim(t, 'Z') AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') END
    ELSE t END AS value FROM met
), rows_ AS (SELECT DISTINCT dataset_id, file_id, version, row_no FROM cells)
SELECT dataset_id, file_id, version, row_no::INT AS row_no, column_name, type_name, value, CASE WHEN value IS NULL AND trim(said) NOT IN ('', 'NA') THEN said END AS unfit FROM filled
UNION ALL SELECT r.dataset_id, r.file_id, r.version, r.row_no::INT, l.last_name, l.last_type, NULL, NULL FROM rows_ r JOIN last l USING (dataset_id)
WHERE NOT EXISTS (SELECT 1 FROM filled x WHERE x.dataset_id = r.dataset_id AND x.file_id = r.file_id AND x.version = r.version AND x.row_no = r.row_no AND x.column_name = l.last_name)
""".replace("{title}", _TITLE).replace("{type}", _TYPE)

QUERIES = {"p5_found": p5_found, "p5_report": p5_report, "p5_table": p5_table}
SQL = {
    "p5_found": _FOUND + "SELECT * FROM changes",
    "p5_table": _FOUND.replace("WITH one", "WITH RECURSIVE one", 1) + _TABLE,
    "p5_report": _FOUND + "SELECT change, count(*) AS changes, count(DISTINCT dataset_id) AS datasets FROM changes GROUP BY change",
}
