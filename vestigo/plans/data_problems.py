"""Queries of the general data problems: regular series, skewed keys, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestigo.operators import nested_tables, regular_series, skewed_counts
from vestigo.registry import Registry
from vestigo.sources.tables import relation_key, spread, table

REGISTRY = Registry()
METRIC_RELATION = "ocsf_ext_livefire_system_metric"
SERIES = ["source_id", "metric"]


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "typed_events").where(relation_key("relation_name") == METRIC_RELATION)
    return regular_series.metric_readings(events, table(spark, folder, "occurrences"))


_READINGS_SQL = r"""
WITH parsed AS (
  SELECT DISTINCT event_id, typed_event_json::JSON AS j FROM typed_events
  WHERE lower(trim(relation_name)) = 'ocsf_ext_livefire_system_metric'
    AND CASE WHEN json_valid(typed_event_json) THEN json_type(typed_event_json::JSON) = 'OBJECT' ELSE FALSE END),
fields AS (
  SELECT event_id, j->>'$.header.source_id' AS source_id, j->>'$.metric' AS metric,
    json_type(j, '$.value_milli') AS vt, j->>'$.value_milli' AS vs, json_type(j, '$.header.time') AS tt, j->>'$.header.time' AS ts
  FROM parsed WHERE json_type(j, '$.header.source_id') = 'VARCHAR' AND json_type(j, '$.metric') = 'VARCHAR'),
times AS (SELECT event_id, min(event_time) AS first_at FROM occurrences WHERE event_time IS NOT NULL GROUP BY 1),
readings AS (
  SELECT DISTINCT event_id, source_id, metric, try_cast(vs AS BIGINT) AS value,
    coalesce(epoch_us(first_at) // 1000,
      CASE WHEN tt IN ('UBIGINT','BIGINT') AND ts::DOUBLE >= 0 THEN
        CASE WHEN ts::DOUBLE >= 1e17 THEN ts::HUGEINT // 1000000 WHEN ts::DOUBLE >= 1e14 THEN ts::HUGEINT // 1000
             WHEN ts::DOUBLE >= 1e11 THEN ts::HUGEINT ELSE ts::HUGEINT * 1000 END
      WHEN tt = 'VARCHAR' AND regexp_matches(ts, '^\d{4}-\d\d-\d\dT.*(Z|[+-]\d\d:\d\d)$') THEN epoch_us(try_cast(ts AS TIMESTAMPTZ)) // 1000 END)::BIGINT AS time_ms
  FROM fields LEFT JOIN times USING (event_id)
  WHERE (vt IN ('UBIGINT','BIGINT')) OR (vt = 'VARCHAR' AND regexp_matches(vs, '^-?[0-9]+$'))),
cells AS (
  SELECT source_id, metric, time_ms - ((time_ms % 300000) + 300000) % 300000 AS w, count(*) AS n, sum(value) AS value_sum
  FROM readings WHERE time_ms IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2, 3),
gaps AS (
  SELECT source_id, metric, w, lead(w) OVER (PARTITION BY source_id, metric ORDER BY w) AS nxt FROM cells),
missing AS (
  SELECT source_id, metric, unnest(range(w + 300000, nxt, 300000)) AS window_start_ms FROM gaps WHERE nxt > w + 300000)
"""


@REGISTRY.query("p4_found", _READINGS_SQL + "SELECT source_id, metric, window_start_ms FROM missing")
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    cells = regular_series.window_cells(_readings(spark, folder), SERIES, "time_ms", "value")
    return regular_series.missing_windows(cells, SERIES).select(*SERIES, "window_start_ms")


@REGISTRY.query(
    "p4_series_summary",
    _READINGS_SQL + """, held AS (SELECT source_id, metric, count(*) AS held_windows, sum(n)::BIGINT AS readings, min(w) AS first_window_ms, max(w) AS last_window_ms FROM cells GROUP BY 1, 2),
    lost AS (SELECT source_id, metric, count(*) AS missing_windows FROM missing GROUP BY 1, 2)
    SELECT source_id, metric, held_windows, coalesce(missing_windows, 0) AS missing_windows, readings, first_window_ms, last_window_ms
    FROM held LEFT JOIN lost USING (source_id, metric)""",
)
def p4_series_summary(spark: SparkSession, folder: str) -> DataFrame:
    full = regular_series.regular_series(_readings(spark, folder), SERIES, "time_ms", "value")
    return full.groupBy(*SERIES).agg(
        F.count_if(~F.col("is_missing")).alias("held_windows"),
        F.count_if("is_missing").alias("missing_windows"),
        F.sum("n_readings").alias("readings"),
        F.min("window_start_ms").alias("first_window_ms"),
        F.max("window_start_ms").alias("last_window_ms"),
    )


def _ledgers(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [table(spark, folder, t).select(relation_key("relation_name").alias("relation_name"), "event_id") for t in ("occurrences", "base_occurrences")]


_CELLS_SQL = """
WITH l AS (SELECT lower(trim(relation_name)) AS relation_name, event_id, count(*) AS n FROM occurrences WHERE relation_name IS NOT NULL AND event_id IS NOT NULL GROUP BY 1, 2),
r AS (SELECT lower(trim(relation_name)) AS relation_name, event_id, count(*) AS n FROM base_occurrences WHERE relation_name IS NOT NULL AND event_id IS NOT NULL GROUP BY 1, 2),
c AS (SELECT relation_name, event_id, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right FROM l FULL JOIN r USING (relation_name, event_id))
"""


@REGISTRY.query("p5_found", _CELLS_SQL + "SELECT relation_name, event_id FROM c WHERE (n_left = 0) != (n_right = 0)")
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return skewed_counts.one_sided(*_ledgers(spark, folder), "relation_name", "event_id")


@REGISTRY.query(
    "p5_relation_ledger",
    _CELLS_SQL + """SELECT relation_name, count(*) AS members, sum(n_left)::BIGINT AS left_rows, sum(n_right)::BIGINT AS right_rows,
    count(*) FILTER (n_left > 0 AND n_right > 0) AS both_members, count(*) FILTER (n_right = 0) AS left_only_members, count(*) FILTER (n_left = 0) AS right_only_members
    FROM c GROUP BY 1""",
)
def p5_relation_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return skewed_counts.ledger_comparison(*_ledgers(spark, folder), "relation_name", "event_id")


@REGISTRY.query(
    "p5_relation_counts",
    "SELECT lower(trim(relation_name)) AS relation_name, count(*) AS n_rows, sum(length(exact_attributes_json))::BIGINT AS json_chars FROM occurrences WHERE relation_name IS NOT NULL GROUP BY 1",
)
def p5_relation_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "occurrences").select(relation_key("relation_name").alias("relation_name"), F.length("exact_attributes_json").alias("json_chars"))
    return skewed_counts.dense_key_counts(rows, "relation_name", ["json_chars"])


_TREE_SQL = r"""
WITH doc AS (SELECT DISTINCT event_id, typed_event_json AS j FROM typed_events WHERE json_valid(typed_event_json) AND event_id IS NOT NULL),
node AS (SELECT d.event_id, t.fullkey, t.key, t.type, t.value FROM doc d, json_tree(d.j) t),
ent AS (SELECT event_id, substr(fullkey, 1, length(fullkey) - length('.entity_id')) AS base, value->>'$' AS entity_id FROM node WHERE key = 'entity_id' AND type = 'VARCHAR' AND fullkey LIKE '%.entity_id' AND value->>'$' != ''),
role AS (SELECT event_id, substr(fullkey, 1, length(fullkey) - length('.role')) AS base, value->>'$' AS role FROM node WHERE key = 'role' AND type = 'VARCHAR' AND fullkey LIKE '%.role' AND value->>'$' != ''),
part AS (SELECT DISTINCT event_id, entity_id, coalesce(role, regexp_extract(regexp_replace(base, '(\[\d+\])+$', ''), '([^.]+)$', 1)) AS role FROM ent LEFT JOIN role USING (event_id, base))
"""


@REGISTRY.query("p6_found", _TREE_SQL + "SELECT event_id, entity_id, role FROM part ANTI JOIN participants USING (event_id, entity_id, role)")
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return nested_tables.missing_participants(spread(table(spark, folder, "typed_events")), table(spark, folder, "participants"))


@REGISTRY.query("p6_table_rows")
def p6_table_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = spread(table(spark, folder, "typed_events"))
    rows = nested_tables.shred(events, nested_tables.schema_graph(events))
    return rows.groupBy("table_name").agg(
        F.count("*").alias("n_rows"), F.sum(F.size("cells").cast("long")).alias("n_cells"), F.count_if(F.col("parent_row_no").isNotNull()).alias("n_child_rows")
    )


_LINKS_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS d, typed_event_json AS j FROM typed_events WHERE json_valid(typed_event_json)),
obj AS (SELECT d, regexp_replace(fullkey, '(\[\d+\])+$', '') AS s, fullkey LIKE '%]' AND regexp_replace(fullkey, '(\[\d+\])+$', '') != '$' AS many FROM doc, json_tree(j) t WHERE t.type = 'OBJECT'),
el AS (SELECT d, many, CASE WHEN s = '$' THEN '$' ELSE regexp_extract(s, '([^.]+)$', 1) END AS name,
  CASE WHEN s = '$' THEN NULL ELSE regexp_extract(regexp_replace(regexp_replace(s, '\.[^.]+$', ''), '(\[\d+\])+$', ''), '([^.]+)$', 1) END AS parent FROM obj),
tab AS (SELECT name FROM el GROUP BY 1 HAVING name = '$' OR bool_or(many) OR count(DISTINCT parent) > 1)
SELECT name AS table_name, count(*) AS n_rows, count(parent) AS n_child_rows, 0::BIGINT AS orphans FROM el JOIN tab USING (name) GROUP BY 1
"""


@REGISTRY.query("p6_links", _LINKS_SQL)
def p6_links(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table, those with a parent, and references to rows of it that aren't there.

    Each row leaves a mark for itself and one for its parent, so the events are
    cut up once and marks of one row meet in a sum.
    """
    events = spread(table(spark, folder, "typed_events"))
    rows = nested_tables.shred(events, nested_tables.schema_graph(events))
    child = F.col("parent_row_no").isNotNull().cast("long")
    zero = F.lit(0).cast("long")
    own = F.struct(F.col("table_name").alias("t"), F.col("row_no").alias("r"), F.lit(1).cast("long").alias("own"), child.alias("child"), zero.alias("refs"))
    up = F.struct(F.col("parent_table").alias("t"), F.col("parent_row_no").alias("r"), zero.alias("own"), zero.alias("child"), child.alias("refs"))
    marks = rows.select("event_id", F.explode(F.array(own, up)).alias("m")).select("event_id", "m.*").where("t is not null")
    met = marks.groupBy("event_id", "t", "r").agg(F.sum("own").alias("own"), F.sum("child").alias("child"), F.sum("refs").alias("refs"))
    return met.groupBy(F.col("t").alias("table_name")).agg(F.sum("own").alias("n_rows"), F.sum("child").alias("n_child_rows"), F.sum(F.when(F.col("own") == 0, F.col("refs")).otherwise(0)).alias("orphans"))


@REGISTRY.query("p6_event_table")
def p6_event_table(spark: SparkSession, folder: str) -> DataFrame:
    events = spread(table(spark, folder, "typed_events"))
    graph = nested_tables.schema_graph(events)
    columns = ["semantic_class", "metric", "value_milli", "ocsf/status", "ocsf/time", "header/source_id"]
    rows = nested_tables.shred(events, graph, carry={nested_tables.ROOT: columns})
    return nested_tables.flat_table(rows, graph, nested_tables.ROOT, columns, carried=True)


@REGISTRY.query("p6_rows")
def p6_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all tables with their links; cells as one JSON object, JSON pointer to typed text (see ``shred``)."""
    events = spread(table(spark, folder, "typed_events"))
    rows = nested_tables.shred(events, nested_tables.schema_graph(events))
    return rows.withColumn("cells", F.to_json("cells"))
