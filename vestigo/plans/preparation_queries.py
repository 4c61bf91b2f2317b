"""Named queries of event projection, text functions, accounting, samples and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestigo.functions import text as tx
from vestigo.functions.projection import KINDS, METRIC
from vestigo.operators import sampling
from vestigo.plans import prepare
from vestigo.registry import Registry
from vestigo.sources.snapshots import with_position
from vestigo.sources.tables import relation_key, spread, table

REGISTRY = Registry()


def _projected(spark: SparkSession, folder: str, *parts: str, commands: bool = False) -> DataFrame:
    return prepare.project_events(spread(table(spark, folder, "typed_events")), parts, commands)


@REGISTRY.query("event_projection")
def event_projection(spark: SparkSession, folder: str) -> DataFrame:
    return _projected(spark, folder, "text", "time", "attributes")


@REGISTRY.query("prepared_documents")
def prepared_documents(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.group_documents(_projected(spark, folder, "text"))


@REGISTRY.query("prepared_occurrences")
def prepared_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.occurrence_rows(_projected(spark, folder, "text", "time", "attributes"))


@REGISTRY.query("command_projection")
def command_projection(spark: SparkSession, folder: str) -> DataFrame:
    return _projected(spark, folder, "text", "time", commands=True).select("event_id", "relation_name", "document_id", "semantic_text", "event_time", "disposition_reason")


_OK = "json_valid(typed_event_json) AND json_type(CASE WHEN json_valid(typed_event_json) THEN typed_event_json ELSE 'null' END::JSON) = 'OBJECT'"
_KNOWN = ", ".join(f"'{r}'" for r in KINDS)
_REASON = f"""CASE WHEN typed_event_json IS NULL OR NOT ({_OK}) THEN 'typed_event_unavailable' WHEN relation_name IS NULL OR lower(trim(relation_name)) NOT IN ({_KNOWN}) THEN 'unknown_typed_relation'
  WHEN lower(trim(relation_name)) = '{METRIC}' THEN 'awaits_deterministic_window_derivation' ELSE 'projected_by_generic_typed_field_policy' END"""


@REGISTRY.query(
    "projection_coverage",
    f"""SELECT CASE WHEN reason = 'projected_by_generic_typed_field_policy' THEN 'direct_semantic_document' ELSE 'structured_only_occurrence' END AS disposition, reason AS disposition_reason, count(*) AS n_rows
    FROM (SELECT {_REASON} AS reason FROM typed_events) GROUP BY 1, 2""",
)
def projection_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.coverage(_projected(spark, folder))


@REGISTRY.query(
    "census",
    f"""SELECT coalesce(lower(trim(relation_name)), '') AS relation_name, count(*) AS source_rows, count(*) FILTER (reason = 'projected_by_generic_typed_field_policy') AS semantic_rows,
    count(*) FILTER (reason != 'projected_by_generic_typed_field_policy') AS structured_only_rows FROM (SELECT relation_name, {_REASON} AS reason FROM typed_events) GROUP BY 1""",
)
def census(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.census(_projected(spark, folder), documents=False)


@REGISTRY.query("prepared_closure", f"SELECT count(*) AS grouped_events, 0::BIGINT AS variants, 0::BIGINT AS unnamed FROM (SELECT {_REASON} AS reason FROM typed_events) WHERE reason = 'projected_by_generic_typed_field_policy'")
def prepared_closure(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' occurrences add up to the direct events, no identity has two texts, and each has a text."""
    d = prepared_documents(spark, folder)
    return d.agg(F.sum("occurrence_count").alias("grouped_events"), F.count_if(F.col("variants") > 1).alias("variants"), F.count_if(F.col("semantic_text").isNull()).alias("unnamed"))


@REGISTRY.query("census_documents")
def census_documents(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.census(_projected(spark, folder, "text"))


@REGISTRY.query(
    "time_availability",
    rf"""WITH d AS (SELECT row_number() OVER () AS i, {_OK} AS ok, typed_event_json AS j FROM typed_events),
    n AS (SELECT i, t.type, t.value, regexp_replace(t.fullkey, '\[\d+\]', '', 'g') AS path, regexp_extract(regexp_replace(t.fullkey, '(\[\d+\])+$', ''), '([^.]+)$', 1) AS name FROM d, json_tree(d.j) t WHERE d.ok AND t.fullkey != '$'
      AND (t.type NOT IN ('OBJECT', 'ARRAY') OR t.value::VARCHAR IN ('{{}}', '[]'))),
    k AS (SELECT *, list_position(['time', 'event_time', 'timestamp', 'observed_time', 'start_time'], trim(regexp_replace(lower(regexp_replace(name, '([a-z0-9])([A-Z])', '\1_\2', 'g')), '[^a-z0-9]+', '_', 'g'), '_')) AS place,
      length(path) - length(replace(path, '.', '')) AS depth FROM n),
    b AS (SELECT i, arg_min(type, (place, depth, path)) AS type, arg_min(value->>'$', (place, depth, path)) AS v FROM k WHERE place > 0 GROUP BY 1),
    r AS (SELECT CASE WHEN type IS NULL THEN 'missing' WHEN type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'available' WHEN type = 'VARCHAR' AND try_cast(trim(v) AS DOUBLE) IS NOT NULL THEN 'available'
      WHEN type = 'VARCHAR' AND regexp_matches(trim(v), '(Z|[+-]\d\d:\d\d)$') AND try_cast(trim(v) AS TIMESTAMPTZ) IS NOT NULL THEN 'available' ELSE 'present_unparsed' END AS time_availability FROM d LEFT JOIN b USING (i))
    SELECT time_availability, count(*) AS n_rows FROM r GROUP BY 1""",
)
def time_availability(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.time_accounting(_projected(spark, folder, "time"))


@REGISTRY.query(
    "timestamp_accounting",
    """SELECT lower(trim(relation_name)) AS relation_name, count(*) AS n_rows, count(*) FILTER (event_time IS NULL) AS missing, count(*) FILTER (event_time < TIMESTAMPTZ '2000-01-01 00:00:00+00') AS before_2000,
    count(*) FILTER (event_time > ingested_at) AS after_ingest FROM occurrences GROUP BY 1""",
)
def timestamp_accounting(spark: SparkSession, folder: str) -> DataFrame:
    at = F.col("event_time")
    return table(spark, folder, "occurrences").groupBy(relation_key("relation_name").alias("relation_name")).agg(
        F.count("*").alias("n_rows"),
        F.count_if(at.isNull()).alias("missing"),
        F.count_if(at < F.lit("2000-01-01 00:00:00").cast("timestamp")).alias("before_2000"),
        F.count_if(at > F.col("ingested_at")).alias("after_ingest"),
    )


@REGISTRY.query("source_rows", "SELECT event_id, 'base_occurrences.parquet' AS source_file, row_number() OVER () - 1 AS source_row FROM base_occurrences")
def source_rows(spark: SparkSession, folder: str) -> DataFrame:
    return with_position(table(spark, folder, "base_occurrences")).select("event_id", "source_file", "source_row")


@REGISTRY.query(
    "sanitize_text",
    r"""WITH t AS (SELECT doc_id, regexp_replace(text, '[\x00\r\n]', ' ', 'g') AS t FROM documents WHERE text IS NOT NULL),
    a AS (SELECT doc_id, regexp_replace(t, '(?i)(password|passwd|pwd|secret|token|api[-_]?key|access[-_]?key|authorization|cookie|private[-_]?key)(\s*(?:=|:)\s*|\s+)("[^"]*"|''[^'']*''|[^\s,;]+)', '\1\2<redacted:secret>', 'g') AS t FROM t),
    b AS (SELECT doc_id, regexp_replace(t, '(?i)\bbearer\s+[A-Za-z0-9._~+/=-]+', 'Bearer <redacted:secret>', 'g') AS t FROM a),
    c AS (SELECT doc_id, regexp_replace(t, '\b(?:AKIA|ASIA)[A-Z0-9]{16}\b', '<redacted:cloud-credential>', 'g') AS t FROM b),
    d AS (SELECT doc_id, regexp_replace(t, '(?i)\barn:[a-z0-9-]+:[^\s,;]+', '<redacted:cloud-identifier>', 'g') AS t FROM c)
    SELECT doc_id, md5(t) AS secrets_md5 FROM d""",
)
def sanitize_text(spark: SparkSession, folder: str) -> DataFrame:
    """Credentials and cloud names in every text: the rules that don't look around, which the SQL engine's patterns can't. All rules: sanitized_full."""
    t = F.regexp_replace("text", r"[\x00\r\n]", " ")
    for pattern, to in tx.REDACTIONS[:4]:
        t = F.regexp_replace(t, pattern, to)
    return table(spark, folder, "documents").where(F.col("text").isNotNull()).select("doc_id", F.md5(t).alias("secrets_md5"))


@REGISTRY.query("sanitized_full")
def sanitized_full(spark: SparkSession, folder: str) -> DataFrame:
    """The whole redacted text of every document, by all rules."""
    return table(spark, folder, "documents").select("doc_id", tx.sanitize(F.col("text"), None).alias("clean"), tx.holds_credential(F.col("text")).alias("credential"))


@REGISTRY.query(
    "key_normalize",
    r"""WITH k AS (SELECT DISTINCT unnest(json_keys(typed_event_json)) AS k FROM typed_events WHERE json_valid(typed_event_json) AND json_type(typed_event_json::JSON) = 'OBJECT')
    SELECT k AS key, trim(regexp_replace(lower(regexp_replace(k, '([a-z0-9])([A-Z])', '\1_\2', 'g')), '[^a-z0-9]+', '_', 'g'), '_') AS name FROM k""",
)
def key_normalize(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "typed_events").select(F.explode(F.json_object_keys("typed_event_json")).alias("key")).distinct()
    return keys.select("key", tx.key_name(F.col("key")).alias("name"))


@REGISTRY.query(
    "magnitude_bucket",
    "SELECT event_id, CASE WHEN v = 0 THEN 'zero' ELSE (CASE WHEN v < 0 THEN 'negative-' ELSE '' END) || '1e' || (length(abs(v)::VARCHAR) - 1) END AS bucket FROM (SELECT event_id, round(value * 1000)::BIGINT - 50000 AS v FROM events)",
)
def magnitude_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", tx.magnitude_bucket(F.round(F.col("value") * 1000).cast("long") - 50_000).alias("bucket"))


@REGISTRY.query(
    "port_bucket",
    "SELECT event_id, CASE WHEN p NOT BETWEEN 0 AND 65535 THEN '<port:invalid>' WHEN p < 1024 THEN '<port:privileged:' || p || '>' WHEN p < 49152 THEN '<port:registered>' ELSE '<port:dynamic>' END AS bucket FROM (SELECT event_id, event_id * 37 % 70000 AS p FROM events)",
)
def port_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", tx.port_bucket(F.col("event_id") * 37 % 70_000).alias("bucket"))


@REGISTRY.query(
    "power_bucket",
    "SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN n_chars <= 0 THEN '0' ELSE (1::BIGINT << (length(bin(n_chars)) - 1)) || '-' || ((2::BIGINT << (length(bin(n_chars)) - 1)) - 1) END AS bucket FROM documents WHERE n_chars IS NOT NULL) GROUP BY 1",
)
def power_bucket(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where("n_chars is not null")
    return rows.groupBy(tx.power_bucket(F.col("n_chars")).alias("bucket")).agg(F.count("*").alias("n"))


@REGISTRY.query(
    "epoch_normalize",
    """WITH e AS (SELECT event_id, epoch_us(ts) AS us FROM events), v AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN us // 1000000 WHEN 1 THEN us // 1000 WHEN 2 THEN us ELSE us * 1000 END AS v FROM e)
    SELECT event_id, round(CASE WHEN abs(v) >= 1e17 THEN v / 1e9 WHEN abs(v) >= 1e14 THEN v / 1e6 WHEN abs(v) >= 1e11 THEN v / 1e3 ELSE v::DOUBLE END, 3) AS seconds FROM v""",
)
def epoch_normalize(spark: SparkSession, folder: str) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    v = F.expr("CASE event_id % 4 WHEN 0 THEN us div 1000000 WHEN 1 THEN us div 1000 WHEN 2 THEN us ELSE us * 1000 END")
    return table(spark, folder, "events").withColumn("us", us).select("event_id", F.round(tx.epoch_seconds(v), 3).alias("seconds"))


@REGISTRY.query("hash_min_sample", "SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('sample' || chr(0) || doc_id), doc_id)::INT AS position FROM documents QUALIFY position <= 5")
def hash_min_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.hash_min(table(spark, folder, "documents"), "source", "doc_id", 5).select("doc_id", "source", "position")


@REGISTRY.query(
    "stratified_sample",
    """WITH c AS (SELECT doc_type, count(*) AS n, sum(count(*)) OVER () AS whole FROM documents WHERE doc_type IS NOT NULL GROUP BY 1),
    e AS (SELECT doc_type, n, least(100, whole) * n / whole::DOUBLE AS exact FROM c), f AS (SELECT *, least(n, greatest(1, floor(exact)))::BIGINT AS base FROM e),
    q AS (SELECT doc_type, base + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, doc_type) <= 100 - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM f),
    r AS (SELECT doc_id, doc_type, row_number() OVER (PARTITION BY doc_type ORDER BY sha256('pilot' || chr(0) || doc_id), doc_id)::INT AS position FROM documents)
    SELECT doc_id, doc_type, position FROM r JOIN q USING (doc_type) WHERE position <= quota""",
)
def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified(table(spark, folder, "documents"), "doc_type", "doc_id", 100).select("doc_id", "doc_type", "position")


@REGISTRY.query(
    "nested_selection",
    """WITH t AS (SELECT doc_id, doc_type, row_number() OVER (PARTITION BY doc_type ORDER BY sha256('nested' || chr(0) || doc_id), doc_id) AS turn FROM documents),
    p AS (SELECT *, row_number() OVER (ORDER BY turn, doc_type) AS place FROM t)
    SELECT doc_id, doc_type, CASE WHEN place <= 20 THEN 20 WHEN place <= 80 THEN 80 ELSE 200 END::INT AS level FROM p WHERE place <= 200""",
)
def nested_selection(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.nested_sizes(table(spark, folder, "documents"), ["doc_type"], "doc_id", [20, 80, 200])


_LEN = "SELECT doc_id, doc_type, length(text) AS n FROM documents WHERE text IS NOT NULL"


@REGISTRY.query(
    "length_strata",
    f"""WITH l AS ({_LEN}), s AS (SELECT list_sort(list(n)) AS a FROM l), b AS (SELECT a[floor((len(a) - 1) * 0.5)::INT + 1] AS b1, a[floor((len(a) - 1) * 0.9)::INT + 1] AS b2, a[floor((len(a) - 1) * 0.95)::INT + 1] AS b3,
      a[floor((len(a) - 1) * 0.99)::INT + 1] AS b4, a[-1] AS top FROM s)
    SELECT stratum, count(*) AS n FROM (SELECT CASE WHEN n = top THEN 5 WHEN n <= b1 THEN 0 WHEN n <= b2 THEN 1 WHEN n <= b3 THEN 2 WHEN n <= b4 THEN 3 ELSE 4 END::INT AS stratum FROM l, b) GROUP BY 1""",
)
def length_strata(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", F.length("text").alias("n"))
    return sampling.length_strata(rows, "n").groupBy("stratum").agg(F.count("*").alias("n"))


@REGISTRY.query(
    "token_stats",
    f"WITH l AS ({_LEN}) SELECT doc_type, count(*) AS n, sum(n)::BIGINT AS total, min(n)::INT AS low, quantile_disc(n, 0.5)::INT AS p50, quantile_disc(n, 0.9)::INT AS p90, quantile_disc(n, 0.95)::INT AS p95, quantile_disc(n, 0.99)::INT AS p99, max(n)::INT AS high FROM l GROUP BY 1",
)
def token_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where("text is not null").select("doc_type", F.length("text").alias("n"))
    return sampling.percentiles_nearest(rows, "n", by=["doc_type"])


@REGISTRY.query(
    "latency_summary",
    "WITH l AS (SELECT event_type, round(value, 3) AS v FROM events WHERE value IS NOT NULL) SELECT event_type, count(*) AS n, round(sum(v), 3) AS total, min(v) AS low, quantile_disc(v, 0.5) AS p50, quantile_disc(v, 0.95) AS p95, max(v) AS high FROM l GROUP BY 1",
)
def latency_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_type", F.round("value", 3).alias("v"))
    return sampling.percentiles_nearest(rows, "v", (0.5, 0.95), ["event_type"]).withColumn("total", F.round("total", 3))


@REGISTRY.query(
    "length_buckets",
    f"WITH l AS ({_LEN}) SELECT CASE WHEN n <= 128 THEN '0-128' WHEN n <= 256 THEN '129-256' WHEN n <= 512 THEN '257-512' WHEN n <= 1024 THEN '513-1024' ELSE '>1024' END AS bucket, count(*) AS items, sum(n)::BIGINT AS tokens FROM l GROUP BY 1",
)
def length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.length_buckets(table(spark, folder, "documents").select(F.length("text").alias("n")), "n")


@REGISTRY.query(
    "token_packing",
    f"""WITH RECURSIVE l AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, coalesce(length(text), 0)::BIGINT AS n FROM documents),
    w AS (SELECT r, doc_id, n, 0::BIGINT AS task, 1::BIGINT AS items, n AS total FROM l WHERE r = 1
      UNION ALL SELECT l.r, l.doc_id, l.n, CASE WHEN w.total + l.n > 20000 OR w.items >= 64 THEN w.task + 1 ELSE w.task END, CASE WHEN w.total + l.n > 20000 OR w.items >= 64 THEN 1 ELSE w.items + 1 END,
        CASE WHEN w.total + l.n > 20000 OR w.items >= 64 THEN l.n ELSE w.total + l.n END FROM w JOIN l ON l.r = w.r + 1)
    SELECT task, min(doc_id) AS first, max(doc_id) AS last, count(*) AS items, sum(n)::BIGINT AS tokens FROM w GROUP BY 1""",
)
def token_packing(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", F.length("text").alias("n"))
    return sampling.greedy_ranges(rows, "doc_id", "n", 20_000, 64)


@REGISTRY.query("ordinal_assignment", "SELECT document_id, row_number() OVER (ORDER BY document_id) - 1 AS ordinal FROM (SELECT DISTINCT document_id FROM documents WHERE document_id IS NOT NULL)")
def ordinal_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.dense_ordinals(table(spark, folder, "documents"), "document_id")
