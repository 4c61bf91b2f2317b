"""Named queries of the derived documents and a few small evidence functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestigo.functions import evidence
from vestigo.plans import derivations
from vestigo.registry import Registry
from vestigo.sources.tables import relation_key, table

REGISTRY = Registry()


def _admitted(spark: SparkSession, folder: str) -> DataFrame:
    return derivations.admitted(table(spark, folder, "typed_events"), table(spark, folder, "participants"))


@REGISTRY.query(
    "metric_documents_content",
    r"""WITH one AS (SELECT event_id, min(lower(trim(relation_name))) AS r, min(typed_event_json) AS j FROM typed_events WHERE event_id IS NOT NULL GROUP BY 1),
    v AS (SELECT event_id, CASE WHEN json_valid(j) AND json_type(CASE WHEN json_valid(j) THEN j ELSE 'null' END::JSON) = 'OBJECT' THEN j::JSON END AS v FROM one WHERE r = 'ocsf_ext_livefire_system_metric'),
    t AS (SELECT *, coalesce(v->>'$.header.time', v->>'$.ocsf.time', v->>'$.time', v->>'$.event_time') AS raw, json_type(v, '$.value_milli') AS k, v->>'$.value_milli' AS x FROM v WHERE v IS NOT NULL),
    m AS (SELECT *, CASE WHEN regexp_matches(raw, '^\s*\d{1,17}\s*$') THEN trim(raw)::BIGINT WHEN regexp_matches(raw, '^\s*\d{4}-\d\d-\d\dT.*(Z|[+-]\d\d:\d\d)\s*$') THEN epoch_ms(try_cast(trim(raw) AS TIMESTAMPTZ)) END AS ms,
      CASE WHEN k IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN trunc(x::DOUBLE)::BIGINT WHEN k = 'BOOLEAN' THEN (x = 'true')::BIGINT WHEN regexp_matches(x, '^\s*[+-]?\d+\s*$') THEN trim(x)::BIGINT END AS value FROM t)
    SELECT v->>'$.metric' AS metric, v->>'$.unit' AS unit, ms // 300000 * 300000 AS window_start_ms, count(*) AS n, min(value) AS value_min, max(value) AS value_max, sum(value)::VARCHAR AS value_sum
    FROM m WHERE ms >= 0 AND value IS NOT NULL AND event_id IN (SELECT event_id FROM participants WHERE entity_id IS NOT NULL AND role IS NOT NULL) GROUP BY 1, 2, 3""",
)
def metric_documents_content(spark: SparkSession, folder: str) -> DataFrame:
    """The metric documents' numbers, added up over source types and scopes."""
    d = derived_metric_documents(spark, folder)
    total = F.sum(F.col("value_sum").cast("decimal(38,0)")).cast("string")
    return d.groupBy("metric", "unit", "window_start_ms").agg(F.sum("n").alias("n"), F.min("value_min").alias("value_min"), F.max("value_max").alias("value_max"), total.alias("value_sum"))


@REGISTRY.query("derived_metric_documents")
def derived_metric_documents(spark: SparkSession, folder: str) -> DataFrame:
    return derivations.metric_documents(_admitted(spark, folder))


@REGISTRY.query("derived_network_documents")
def derived_network_documents(spark: SparkSession, folder: str) -> DataFrame:
    return derivations.network_documents(_admitted(spark, folder))


@REGISTRY.query("derived_transition_documents")
def derived_transition_documents(spark: SparkSession, folder: str) -> DataFrame:
    return derivations.transition_documents(_admitted(spark, folder))


@REGISTRY.query(
    "derived_entity_documents",
    """WITH rel AS (SELECT event_id, min(lower(trim(relation_name))) AS relation_name FROM typed_events WHERE event_id IS NOT NULL GROUP BY 1),
    p AS (SELECT DISTINCT event_id, entity_id, coalesce(role, '') AS role FROM participants WHERE event_id IS NOT NULL AND entity_id IS NOT NULL),
    j AS (SELECT p.*, relation_name FROM p LEFT JOIN rel USING (event_id)),
    t AS (SELECT entity_id, count(*) AS participations, count(DISTINCT relation_name) AS n_relations, count(DISTINCT role) AS n_roles FROM j GROUP BY 1),
    m AS (SELECT entity_id, role AS main_role FROM (SELECT entity_id, role, row_number() OVER (PARTITION BY entity_id ORDER BY count(*) DESC, role) AS r FROM j GROUP BY 1, 2) WHERE r = 1)
    SELECT 'sha256:' || sha256('entity_rollup' || chr(0) || entity_id) AS document_id, 'entity_rollup' AS document_kind, 'kind: entity | entity: '
      || CASE WHEN kind IN ('account', 'application', 'credential', 'datastore', 'device', 'file', 'identity', 'network_endpoint', 'process', 'resource', 'service', 'session') THEN replace(kind, '_', ' ') ELSE '<redacted:entity-kind>' END
      || ' | main role: ' || CASE WHEN main_role IN ('actor', 'device', 'object', 'observer', 'owner', 'principal', 'recipient', 'resource', 'sender', 'source', 'subject', 'target') THEN replace(main_role, '_', ' ') ELSE '<redacted:participant-role>' END
      || ' | relations: ' || n_relations || ' | participations: 1e' || (length(participations::VARCHAR) - 1) AS semantic_text,
    entity_id, kind, participations, n_relations, n_roles, main_role FROM entities JOIN t USING (entity_id) JOIN m USING (entity_id)""",
)
def derived_entity_documents(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "typed_events").select("event_id", relation_key("relation_name").alias("relation_name"))
    return derivations.entity_documents(table(spark, folder, "entities"), table(spark, folder, "participants"), events)


@REGISTRY.query(
    "derivation_coverage",
    r"""WITH one AS (SELECT event_id, min(lower(trim(relation_name))) AS r, min(typed_event_json) AS j FROM typed_events WHERE event_id IS NOT NULL GROUP BY 1),
    v AS (SELECT event_id, r, CASE WHEN json_valid(j) AND json_type(CASE WHEN json_valid(j) THEN j ELSE 'null' END::JSON) = 'OBJECT' THEN j::JSON END AS v FROM one),
    t AS (SELECT *, coalesce(v->>'$.header.time', v->>'$.ocsf.time', v->>'$.time', v->>'$.event_time') AS raw FROM v),
    f AS (SELECT *, CASE WHEN r = 'ocsf_ext_livefire_system_metric' THEN 'metric_window' WHEN r IN ('ocsf_network_activity', 'ocsf_dns_activity', 'ocsf_http_activity') THEN 'network_window'
        WHEN r IN ('ocsf_cloud_resources_inventory_info', 'ocsf_ext_livefire_configuration_snapshot', 'ocsf_inventory_info', 'ocsf_user_inventory') THEN 'state_transition' END AS family,
      CASE WHEN regexp_matches(raw, '^\s*\d{1,17}\s*$') THEN TRUE WHEN regexp_matches(raw, '^\s*\d{4}-\d\d-\d\dT.*(Z|[+-]\d\d:\d\d)\s*$') THEN coalesce(epoch_ms(try_cast(trim(raw) AS TIMESTAMPTZ)) >= 0, FALSE) ELSE FALSE END AS timed,
      event_id IN (SELECT event_id FROM participants WHERE entity_id IS NOT NULL AND event_id IS NOT NULL AND role IS NOT NULL) AS scoped FROM t)
    SELECT family, CASE WHEN v IS NULL THEN 'typed_event_unavailable' WHEN raw IS NULL THEN 'missing_time' WHEN NOT timed THEN 'invalid_time' WHEN NOT scoped THEN 'missing_canonical_scope'
      WHEN family = 'metric_window' AND NOT coalesce(json_type(v, '$.value_milli') IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN') OR json_type(v, '$.value_milli') = 'VARCHAR' AND regexp_matches(v->>'$.value_milli', '^\s*[+-]?\d+\s*$'), FALSE) THEN 'missing_value'
      WHEN family = 'state_transition' AND coalesce(v->>'$.state', v->>'$.status', v->>'$.status_code', v->>'$.rcode', v->>'$.response.status_code', v->>'$.ocsf.status') IS NULL THEN 'missing_value' ELSE 'eligible' END AS reason, count(*) AS n
    FROM f WHERE family IS NOT NULL GROUP BY 1, 2""",
)
def derivation_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return derivations.coverage(_admitted(spark, folder))


@REGISTRY.query("iso_millis", "SELECT event_id, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS at FROM events")
def iso_millis(spark: SparkSession, folder: str) -> DataFrame:
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    return table(spark, folder, "events").select("event_id", evidence.iso_millis(ms).alias("at"))


@REGISTRY.query(
    "state_category",
    """WITH s AS (SELECT DISTINCT typed_event_json->>'$.ocsf.status' AS status FROM typed_events WHERE json_valid(typed_event_json)), w AS (SELECT status, replace(trim(regexp_replace(lower(status), '[-\\s]+', ' ', 'g')), ' ', '_') AS word FROM s)
    SELECT status, CASE WHEN status IS NULL THEN 'null-state' WHEN word IN ("""
    + ", ".join(f"'{s}'" for s in evidence.STATES)
    + ") THEN word ELSE 'string-state' END AS category FROM w",
)
def state_category(spark: SparkSession, folder: str) -> DataFrame:
    v = F.try_parse_json("typed_event_json")
    rows = table(spark, folder, "typed_events").where(v.isNotNull()).select(F.try_variant_get(v, "$.ocsf.status", "string").alias("status")).distinct()
    return rows.select("status", evidence.state_category(F.col("status"), F.lit("string")).alias("category"))


@REGISTRY.query("raw_log_scan", "SELECT doc_id, text FROM documents WHERE doc_type = 'rawlog' AND text LIKE '%=%' AND text LIKE '%e%'")
def raw_log_scan(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where("doc_type = 'rawlog' AND text LIKE '%=%' AND text LIKE '%e%'").select("doc_id", "text").orderBy("doc_id")


@REGISTRY.query(
    "ledger_diff",
    """WITH a AS (SELECT occurrence_id, min(event_id) AS e FROM occurrences WHERE occurrence_id IS NOT NULL GROUP BY 1), b AS (SELECT occurrence_id, min(event_id) AS f FROM base_occurrences WHERE occurrence_id IS NOT NULL GROUP BY 1)
    SELECT count(*) FILTER (e = f) AS same, count(*) FILTER (e != f) AS changed, count(*) FILTER (f IS NULL) AS left_only, count(*) FILTER (e IS NULL) AS right_only FROM a FULL JOIN b USING (occurrence_id)""",
)
def ledger_diff(spark: SparkSession, folder: str) -> DataFrame:
    one = lambda t: table(spark, folder, t).where("occurrence_id is not null").groupBy("occurrence_id").agg(F.min("event_id").alias("event_id"))
    return derivations.frame_diff(one("occurrences"), one("base_occurrences"), ["occurrence_id"])


@REGISTRY.query(
    "coverage_rates",
    """SELECT score_kind, count(*) AS n_rows, round(avg(pointer_resolved::INT), 6) AS resolved, round(avg(filter_compliant::INT), 6) AS compliant, round(count(rank) / count(*), 6) AS ranked,
    round(count(*) FILTER (distance_millionths BETWEEN 0 AND 2000000) / count(*), 6) AS scored FROM candidate_rankings GROUP BY 1""",
)
def coverage_rates(spark: SparkSession, folder: str) -> DataFrame:
    n = F.count("*")
    return table(spark, folder, "candidate_rankings").groupBy("score_kind").agg(
        n.alias("n_rows"),
        F.round(F.avg(F.col("pointer_resolved").cast("int")), 6).alias("resolved"),
        F.round(F.avg(F.col("filter_compliant").cast("int")), 6).alias("compliant"),
        F.round(F.count("rank") / n, 6).alias("ranked"),
        F.round(F.count_if(F.col("distance_millionths").between(0, 2_000_000)) / n, 6).alias("scored"),
    )
