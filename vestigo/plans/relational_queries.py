"""Named queries of the windowed derivations, entity and ledger audits, and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestigo.operators import audit, derive
from vestigo.registry import Registry
from vestigo.sources.tables import relation_key, table

REGISTRY = Registry()
US = "epoch_us(ts)"
MS = "(epoch_us(ts) // 1000)"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return e.withColumns({"ms": F.floor(F.col("us") / 1000).cast("long"), "value_milli": F.round(F.col("value") * 1000).cast("long")})


@REGISTRY.query(
    "metric_window",
    f"""SELECT event_type, user_id, {MS} // 300000 * 300000 AS window_start_ms, count(*) AS n, min(v) AS value_min, max(v) AS value_max, sum(v)::VARCHAR AS value_sum
    FROM (SELECT *, round(value * 1000)::BIGINT AS v FROM events) WHERE v IS NOT NULL GROUP BY ALL""",
)
def metric_window(spark: SparkSession, folder: str) -> DataFrame:
    return derive.metric_windows(_events(spark, folder), ["event_type", "user_id"], "ms", "value_milli")


@REGISTRY.query(
    "network_window",
    f"""WITH e AS (SELECT user_id, {MS} // 300000 * 300000 AS window_start_ms, event_type, CASE WHEN event_type != 'error' THEN round(value * 1000)::BIGINT END AS value_milli, (props->>'$.k')::BIGINT AS k FROM events),
    o AS (SELECT user_id, window_start_ms, event_type, count(*) AS n FROM e GROUP BY ALL),
    h AS (SELECT user_id, window_start_ms, string_agg(event_type || '=' || n, ';' ORDER BY event_type || '=' || n) AS outcomes FROM o GROUP BY ALL),
    a AS (SELECT user_id, window_start_ms, count(*) AS n_events, count(value_milli) AS value_milli_observed, count(*) - count(value_milli) AS value_milli_missing, min(value_milli) AS value_milli_min,
      max(value_milli) AS value_milli_max, sum(value_milli)::BIGINT AS value_milli_sum, count(k) AS k_observed, count(*) - count(k) AS k_missing, min(k) AS k_min, max(k) AS k_max, sum(k)::BIGINT AS k_sum FROM e GROUP BY ALL)
    SELECT * FROM a JOIN h USING (user_id, window_start_ms)""",
)
def network_window(spark: SparkSession, folder: str) -> DataFrame:
    e = _events(spark, folder)
    e = e.withColumns({"value_milli": F.when(F.col("event_type") != "error", F.col("value_milli")), "k": F.get_json_object("props", "$.k").cast("long")})
    return derive.measure_windows(e, ["user_id"], "ms", ["value_milli", "k"], "event_type")


TRANSITIONS = f"""WITH g AS (SELECT user_id, {US} // 3600000000 AS hour, min(event_type) AS low, max(event_type) AS high, min(event_id) AS event FROM events GROUP BY 1, 2),
p AS (SELECT *, low = high AS one, row_number() OVER w = 1 AS first, lag(CASE WHEN low = high THEN low END) OVER w AS previous_state FROM g WINDOW w AS (PARTITION BY user_id ORDER BY hour)),
r AS (SELECT user_id, hour, event, CASE WHEN one THEN low END AS state, previous_state, CASE WHEN NOT one THEN 'ambiguous' WHEN first THEN 'initial' WHEN previous_state IS NULL THEN 'no_predecessor'
  WHEN previous_state = low THEN 'unchanged' ELSE 'transition' END AS outcome FROM p) """


@REGISTRY.query("state_transitions", TRANSITIONS + "SELECT * FROM r")
def state_transitions(spark: SparkSession, folder: str) -> DataFrame:
    e = _events(spark, folder).withColumn("hour", F.floor(F.col("us") / 3_600_000_000).cast("long"))
    return derive.state_transitions(e, ["user_id"], "hour", "event_type", "event_id", shard=24)


@REGISTRY.query("transition_outcomes", TRANSITIONS + "SELECT outcome, count(*) AS n FROM r GROUP BY 1")
def transition_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return state_transitions(spark, folder).groupBy("outcome").agg(F.count("*").alias("n"))


@REGISTRY.query(
    "entity_rollup",
    """WITH rel AS (SELECT event_id, min(lower(trim(relation_name))) AS relation_name FROM typed_events WHERE event_id IS NOT NULL GROUP BY 1),
    p AS (SELECT DISTINCT event_id, entity_id, coalesce(role, '') AS role FROM participants WHERE event_id IS NOT NULL AND entity_id IS NOT NULL),
    j AS (SELECT p.*, relation_name FROM p LEFT JOIN rel USING (event_id)),
    t AS (SELECT entity_id, count(*) AS participations, count(DISTINCT relation_name) AS n_relations, count(DISTINCT role) AS n_roles FROM j GROUP BY 1),
    m AS (SELECT entity_id, role AS main_role FROM (SELECT entity_id, role, row_number() OVER (PARTITION BY entity_id ORDER BY count(*) DESC, role) AS r FROM j GROUP BY 1, 2) WHERE r = 1)
    SELECT entity_id, kind, coalesce(participations, 0) AS participations, coalesce(n_relations, 0) AS n_relations, coalesce(n_roles, 0) AS n_roles, main_role FROM entities LEFT JOIN t USING (entity_id) LEFT JOIN m USING (entity_id)""",
)
def entity_rollup(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "typed_events").select("event_id", relation_key("relation_name").alias("relation_name"))
    return derive.entity_rollup(table(spark, folder, "entities"), table(spark, folder, "participants"), events)


@REGISTRY.query(
    "scope_list",
    """SELECT event_id, string_agg(s, ',' ORDER BY s) AS scopes FROM (SELECT DISTINCT event_id, role || ':' || entity_id AS s FROM participants WHERE event_id IS NOT NULL AND entity_id IS NOT NULL AND role IS NOT NULL) GROUP BY 1""",
)
def scope_list(spark: SparkSession, folder: str) -> DataFrame:
    return derive.scope_lists(table(spark, folder, "participants"))


@REGISTRY.query("orphan_entities", "SELECT DISTINCT entity_id FROM entities ANTI JOIN participants USING (entity_id)")
def orphan_entities(spark: SparkSession, folder: str) -> DataFrame:
    return audit.orphans(table(spark, folder, "entities"), table(spark, folder, "participants"), "entity_id")


@REGISTRY.query("orphan_base_events", "SELECT DISTINCT event_id FROM base_occurrences ANTI JOIN participants USING (event_id) WHERE event_id IS NOT NULL")
def orphan_base_events(spark: SparkSession, folder: str) -> DataFrame:
    return audit.orphans(table(spark, folder, "base_occurrences"), table(spark, folder, "participants"), "event_id")


@REGISTRY.query(
    "closure_audit",
    """WITH a AS (SELECT DISTINCT document_id FROM documents WHERE document_id IS NOT NULL), b AS (SELECT DISTINCT document_id AS other FROM vectors WHERE document_id IS NOT NULL)
    SELECT count(*) FILTER (document_id IS NOT NULL AND other IS NOT NULL) AS matched, count(*) FILTER (other IS NULL) AS left_only, count(*) FILTER (document_id IS NULL) AS right_only FROM a FULL JOIN b ON document_id = other""",
)
def closure_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.closure(table(spark, folder, "documents"), table(spark, folder, "vectors"), "document_id")


@REGISTRY.query(
    "dangling_references",
    """SELECT 'occurrences.document_id' AS reference, count(DISTINCT document_id) AS dangling FROM occurrences ANTI JOIN documents USING (document_id) WHERE document_id IS NOT NULL
    UNION ALL SELECT 'rankings.command_id', count(DISTINCT command_id) FROM candidate_rankings WHERE command_id IS NOT NULL AND command_id NOT IN (SELECT document_id FROM documents WHERE document_id IS NOT NULL)
    UNION ALL SELECT 'participants.entity_id', count(DISTINCT entity_id) FROM participants ANTI JOIN entities USING (entity_id) WHERE entity_id IS NOT NULL
    UNION ALL SELECT 'participants.event_id', count(DISTINCT event_id) FROM participants ANTI JOIN typed_events USING (event_id) WHERE event_id IS NOT NULL
    UNION ALL SELECT 'vectors.document_id', count(DISTINCT document_id) FROM vectors ANTI JOIN documents USING (document_id) WHERE document_id IS NOT NULL""",
)
def dangling_references(spark: SparkSession, folder: str) -> DataFrame:
    t = lambda n: table(spark, folder, n)
    return audit.dangling(
        {
            "occurrences.document_id": (t("occurrences"), t("documents"), "document_id"),
            "rankings.command_id": (t("candidate_rankings"), t("documents").withColumnRenamed("document_id", "command_id"), "command_id"),
            "participants.entity_id": (t("participants"), t("entities"), "entity_id"),
            "participants.event_id": (t("participants"), t("typed_events"), "event_id"),
            "vectors.document_id": (t("vectors"), t("documents"), "document_id"),
        }
    )


@REGISTRY.query("repeated_occurrences", "SELECT occurrence_id, count(*) AS n FROM occurrences GROUP BY 1 HAVING count(*) > 1")
def repeated_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    return audit.repeated_keys(table(spark, folder, "occurrences"), ["occurrence_id"])


@REGISTRY.query(
    "delivery_conflicts",
    """WITH g AS (SELECT occurrence_id, count(*) AS n, count(DISTINCT (coalesce(document_id, ''), coalesce(relation_name, ''), coalesce(event_time::VARCHAR, ''), exact_attributes_json)) AS v FROM occurrences WHERE occurrence_id IS NOT NULL GROUP BY 1)
    SELECT count(*) AS keys, count(*) FILTER (n > 1) AS repeated, count(*) FILTER (v > 1) AS conflicting FROM g""",
)
def delivery_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "occurrences").withColumns({"d": F.coalesce("document_id", F.lit("")), "r": F.coalesce("relation_name", F.lit("")), "t": F.coalesce(F.unix_micros("event_time"), F.lit(-1))})
    return audit.payload_conflicts(rows, "occurrence_id", ["d", "r", "t", "exact_attributes_json"])


@REGISTRY.query("union_by_name", "SELECT event_id, occurrence_id, relation_name, batch_no FROM occurrences UNION ALL SELECT event_id, occurrence_id, relation_name, NULL FROM base_occurrences")
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    return audit.union_by_name(table(spark, folder, "occurrences").select("event_id", "occurrence_id", "relation_name", "batch_no"), table(spark, folder, "base_occurrences"))


@REGISTRY.query(
    "set_overlap",
    """WITH a AS (SELECT DISTINCT event_id FROM occurrences), b AS (SELECT DISTINCT event_id FROM base_occurrences)
    SELECT (SELECT count(*) FROM (FROM a INTERSECT FROM b)) AS shared, (SELECT count(*) FROM (FROM a EXCEPT FROM b)) AS left_only, (SELECT count(*) FROM (FROM b EXCEPT FROM a)) AS right_only""",
)
def set_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return audit.set_sizes(table(spark, folder, "occurrences").select("event_id"), table(spark, folder, "base_occurrences").select("event_id"))


@REGISTRY.query(
    "prior_history",
    f"SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type ORDER BY {US} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM events",
)
def prior_history(spark: SparkSession, folder: str) -> DataFrame:
    return derive.strict_history(_events(spark, folder), ["user_id", "event_type"], "us").select("event_id", "prior")


@REGISTRY.query(
    "prior_history_7d",
    f"SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type ORDER BY {US} RANGE BETWEEN 604800000000 PRECEDING AND 1 PRECEDING) AS prior FROM events",
)
def prior_history_7d(spark: SparkSession, folder: str) -> DataFrame:
    return derive.strict_history(_events(spark, folder), ["user_id", "event_type"], "us", 7 * 86_400_000_000).select("event_id", "prior")


@REGISTRY.query(
    "interval_union",
    f"""WITH i AS (SELECT user_id, {MS} AS s, {MS} + 1800000 AS e FROM events),
    m AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
    n AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m),
    u AS (SELECT user_id, island, min(s) AS s, max(e) AS e FROM n GROUP BY 1, 2)
    SELECT user_id, count(*) AS islands, sum(e - s)::BIGINT AS covered FROM u GROUP BY 1""",
)
def interval_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events(spark, folder).select("user_id", F.col("ms").alias("s"), (F.col("ms") + 1_800_000).alias("e"))
    return derive.interval_union(rows, ["user_id"], "s", "e")


@REGISTRY.query(
    "document_groups",
    r"""SELECT sha256(lower(trim(regexp_replace(text, '[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')))) AS content_sha256,
    count(*) AS occurrence_count, min(document_id) AS representative FROM documents WHERE text IS NOT NULL GROUP BY 1""",
)
def document_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every text that is not null, whatever its script; white space is Unicode's White_Space, case is Unicode's."""
    rows = table(spark, folder, "documents").where(F.col("text").isNotNull())
    key = F.sha2(F.lower(F.trim(F.regexp_replace("text", r"(?U)\s+", " "))), 256)
    return rows.groupBy(key.alias("content_sha256")).agg(F.count("*").alias("occurrence_count"), F.min("document_id").alias("representative"))


@REGISTRY.query(
    "relation_overlap",
    "SELECT lower(trim(relation_name)) AS relation_name, count(DISTINCT snapshot_sha256) AS snapshots, count(DISTINCT mapping_sha256) AS mappings, count(*) AS n_rows FROM occurrences WHERE relation_name IS NOT NULL GROUP BY 1",
)
def relation_overlap(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "occurrences").where("relation_name is not null")
    return o.groupBy(relation_key("relation_name").alias("relation_name")).agg(F.countDistinct("snapshot_sha256").alias("snapshots"), F.countDistinct("mapping_sha256").alias("mappings"), F.count("*").alias("n_rows"))


@REGISTRY.query("tpch_segment_revenue", """SELECT c_mktsegment, count(DISTINCT o_orderkey) AS orders, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def tpch_segment_revenue(spark: SparkSession, folder: str) -> DataFrame:
    c, o, line = (table(spark, folder, t) for t in ("customer", "orders", "lineitem"))
    per_order = line.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    joined = o.join(per_order, F.col("o_orderkey") == F.col("l_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.countDistinct("o_orderkey").alias("orders"), F.round(F.sum("r"), 2).alias("revenue"))
