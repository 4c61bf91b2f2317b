"""Derived documents over typed events: metric and network windows, state transitions, entities.

Each event takes part or is counted under the reason why it doesn't. Every
derived document names its members by a digest of their set.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vestigo.functions.evidence import ENTITY_KINDS, PARTICIPANT_ROLES, closed_term, iso_millis, set_digest, state_category
from vestigo.functions.jsons import REFUSED, json_reader
from vestigo.functions.projection import METRIC, STATE
from vestigo.functions.text import magnitude_bucket
from vestigo.operators import derive
from vestigo.sources.tables import relation_key

# Where the fields of an event may stand, in order of precedence.
TIME = ("$.header.time", "$.ocsf.time", "$.time", "$.event_time")
SOURCE_TYPE = ("$.header.metadata.type", "$.ocsf.metadata.type", "$.metadata.type")
OPERATION = ("$.action", "$.method", "$.query_type", "$.activity_name", "$.ocsf.activity_name")
PROTOCOL = ("$.protocol", "$.protocol_stack", "$.transport", "$.ocsf.protocol_name", "$.ocsf.app_name")
OUTCOME = ("$.status", "$.status_code", "$.rcode", "$.response.status_code", "$.ocsf.status")
MEASURES = {
    "bytes": ("$.bytes", "$.traffic.bytes", "$.ocsf.traffic.bytes"),
    "bytes_in": ("$.bytes_in", "$.traffic.bytes_in", "$.ocsf.traffic.bytes_in"),
    "bytes_out": ("$.bytes_out", "$.traffic.bytes_out", "$.ocsf.traffic.bytes_out"),
    "packets": ("$.packets", "$.traffic.packets", "$.ocsf.traffic.packets"),
    "packets_in": ("$.packets_in", "$.traffic.packets_in", "$.ocsf.traffic.packets_in"),
    "packets_out": ("$.packets_out", "$.traffic.packets_out", "$.ocsf.traffic.packets_out"),
    "duration_millis": ("$.duration_millis", "$.duration", "$.ocsf.duration"),
}
NETWORK = ("ocsf_network_activity", "ocsf_dns_activity", "ocsf_http_activity")


def _first(v: Column, paths: tuple[str, ...], kind: str = "string") -> Column:
    return F.coalesce(*[F.try_variant_get(v, p, kind) for p in paths])


def strict_ms(text: Column) -> Column:
    """Whole numbers not below 0 are milliseconds as they stand; texts need a zone; all else is null."""
    zoned = text.rlike(r"^\s*\d{4}-\d\d-\d\dT.*(Z|[+-]\d\d:\d\d)\s*$")
    ms = F.when(text.rlike(r"^\s*\d{1,17}\s*$"), F.trim(text).cast("long")).when(zoned, F.unix_millis(F.try_to_timestamp(F.trim(text))))
    return F.when(ms >= 0, ms)


def admitted(events: DataFrame, participants: DataFrame) -> DataFrame:
    """One row per event with its parsed JSON, strict time and scope. Of repeated events the smallest text counts."""
    one = events.where("event_id is not null").groupBy("event_id").agg(F.min(relation_key("relation_name")).alias("relation_name"), F.min("typed_event_json").alias("_j"))
    v = F.try_parse_json("_j")
    parsed = one.withColumn("v", F.when(F.schema_of_variant(v).startswith("OBJECT"), v))
    raw = _first(F.col("v"), TIME)
    return parsed.select("event_id", "relation_name", "v", raw.alias("raw_time"), strict_ms(raw).alias("ms")).join(derive.scope_lists(participants), "event_id", "left")


def reason(row_kind: Column) -> Column:
    """Why an event can't take part, or null."""
    return (
        F.when(F.col("v").isNull(), "typed_event_unavailable")
        .when(F.col("raw_time").isNull(), "missing_time")
        .when(F.col("ms").isNull(), "invalid_time")
        .when(F.col("scopes").isNull(), "missing_canonical_scope")
        .when(row_kind.isNull(), "missing_value")
    )


def coverage(rows: DataFrame) -> DataFrame:
    """(family, reason, n): every event of a family's relations once."""
    r = F.col("relation_name")
    family = F.when(r == METRIC, "metric_window").when(r.isin(list(NETWORK)), "network_window").when(r.isin(STATE), "state_transition")
    value = F.when(r == METRIC, F.try_variant_get("v", "$.value_milli", "long").cast("string")).when(r.isin(STATE), _first(F.col("v"), ("$.state", *OUTCOME))).otherwise("")
    return rows.where(family.isNotNull()).groupBy(family.alias("family"), F.coalesce(reason(value), F.lit("eligible")).alias("reason")).agg(F.count("*").alias("n"))


def _document(df: DataFrame, family: str, keys: list[str], text: Column) -> DataFrame:
    identity = F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("\x00", F.lit(family), *[F.coalesce(F.col(k).cast("string"), F.lit("\x01")) for k in keys]), 256))
    return df.select(identity.alias("document_id"), F.lit(family).alias("document_kind"), text.alias("semantic_text"), *keys, *[c for c in df.columns if c not in keys])


def metric_documents(rows: DataFrame) -> DataFrame:
    """Five-minute windows of a metric, unit, source type and scope: exact count, extremes and sum (as text), magnitudes in the words."""
    v = F.col("v")
    m = rows.where((F.col("relation_name") == METRIC) & v.isNotNull() & F.col("ms").isNotNull() & F.col("scopes").isNotNull())
    m = m.select("event_id", "ms", "scopes", _first(v, SOURCE_TYPE).alias("source_type"), F.try_variant_get(v, "$.metric", "string").alias("metric"), F.try_variant_get(v, "$.unit", "string").alias("unit"), F.try_variant_get(v, "$.value_milli", "long").alias("x"))
    m = m.where("x is not null").withColumn("window_start_ms", derive.window_start(F.col("ms")))
    keys = ["source_type", "metric", "unit", "scopes", "window_start_ms"]
    agg = m.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min("x").alias("value_min"), F.max("x").alias("value_max"), F.sum(F.col("x").cast("decimal(38,0)")).cast("string").alias("value_sum"), set_digest(F.col("event_id")).alias("membership_sha256")
    )
    text = F.concat_ws(
        " | ", F.lit("kind: metric window"), F.concat(F.lit("metric: "), F.coalesce("metric", F.lit("absent"))), F.concat(F.lit("unit: "), F.coalesce("unit", F.lit("absent"))),
        F.concat(F.lit("window: "), iso_millis(F.col("window_start_ms"))), F.concat(F.lit("samples: "), F.col("n").cast("string")),
        F.concat(F.lit("range: "), magnitude_bucket(F.col("value_min")), F.lit(" to "), magnitude_bucket(F.col("value_max"))),
    )
    return _document(agg, "metric_window", keys, text)


def network_documents(rows: DataFrame) -> DataFrame:
    """Five-minute windows of an operation and protocol within a relation and scope, seven measures and the outcome histogram."""
    v = F.col("v")
    n = rows.where(F.col("relation_name").isin(list(NETWORK)) & v.isNotNull() & F.col("ms").isNotNull() & F.col("scopes").isNotNull())
    n = n.select(
        "event_id", "relation_name", "ms", "scopes",
        *[F.coalesce(_first(v, p), F.lit("absent")).alias(k) for k, p in (("operation", OPERATION), ("protocol", PROTOCOL), ("outcome", OUTCOME))],
        *[_first(v, p, "long").alias(k) for k, p in MEASURES.items()],
    )
    keys = ["relation_name", "operation", "protocol", "scopes"]
    agg = derive.measure_windows(n, keys, "ms", list(MEASURES), "outcome")
    digest = n.withColumn("window_start_ms", derive.window_start(F.col("ms"))).groupBy(*keys, "window_start_ms").agg(set_digest(F.col("event_id")).alias("membership_sha256"))
    both = agg.join(digest, [*keys, "window_start_ms"])
    text = F.concat_ws(
        " | ", F.lit("kind: network window"), F.concat(F.lit("relation: "), F.col("relation_name")), F.concat(F.lit("operation: "), F.col("operation")),
        F.concat(F.lit("protocol: "), F.col("protocol")), F.concat(F.lit("outcomes: "), F.col("outcomes")), F.concat(F.lit("bytes observed: "), F.col("bytes_observed").cast("string")),
    )
    return _document(both, "network_window", [*keys, "window_start_ms"], text)


def transition_documents(rows: DataFrame) -> DataFrame:
    """Changes of state of a scope within a state relation; the state is ``state`` or the status."""
    v = F.col("v")
    s = rows.where(F.col("relation_name").isin(STATE) & v.isNotNull() & F.col("ms").isNotNull() & F.col("scopes").isNotNull())
    s = s.select("event_id", "relation_name", "scopes", "ms", _first(v, ("$.state", *OUTCOME)).alias("state"))
    moves = derive.state_transitions(s, ["relation_name", "scopes"], "ms", "state", "event_id", 86_400_000).where("outcome = 'transition'")
    known = F.lit("string")
    text = F.concat_ws(
        " | ", F.lit("kind: state transition"), F.concat(F.lit("relation: "), F.col("relation_name")), F.concat(F.lit("from: "), state_category(F.col("previous_state"), known)), F.concat(F.lit("to: "), state_category(F.col("state"), known))
    )
    return _document(moves, "state_transition", ["relation_name", "scopes", "ms"], text)


def entity_documents(entities: DataFrame, participants: DataFrame, events: DataFrame) -> DataFrame:
    """One document per entity that takes part in anything; kinds and roles only in closed terms."""
    rolled = derive.entity_rollup(entities, participants, events).where("participations > 0")
    text = F.concat_ws(
        " | ", F.lit("kind: entity"), F.concat(F.lit("entity: "), closed_term(F.col("kind"), ENTITY_KINDS, "entity-kind")), F.concat(F.lit("main role: "), closed_term(F.col("main_role"), PARTICIPANT_ROLES, "participant-role")),
        F.concat(F.lit("relations: "), F.col("n_relations").cast("string")), F.concat(F.lit("participations: "), magnitude_bucket(F.col("participations"))),
    )
    return _document(rolled, "entity_rollup", ["entity_id"], text)


# Where a state holds what changes without its meaning changing.
VOLATILE_STATE_POINTERS = (
    "/header/time", "/header/event_id", "/header/metadata/uid", "/ocsf/time", "/ocsf/metadata/uid", "/time", "/event_time", "/event_id", "/record_uid",
    "/native_event_uid", "/support_ref", "/ingest_time", "/ingestion_time",
)
CONFIGURATION = "ocsf_ext_livefire_configuration_snapshot"


def state_signatures(events: DataFrame) -> DataFrame:
    """(event_id, relation_name, signature, problem): a digest of what a state says, without its volatile fields.

    Of a configuration snapshot only ``state`` counts, and its absence is a
    problem; of other state relations the whole object. Objects compare
    without regard to the order of their keys, lists by their order. Texts
    that aren't an object give 'typed_event_unavailable'.
    """
    volatile = [p[1:].split("/") for p in VOLATILE_STATE_POINTERS]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = json_reader()
        for b in batches:
            out: list[list] = [[], [], [], []]
            for event, relation, text in zip(*[b.column(i).to_pylist() for i in range(3)]):
                state, problem = read(text), None
                if state is REFUSED or not isinstance(state, dict):
                    state, problem = None, "typed_event_unavailable"
                elif relation == CONFIGURATION:
                    state = state.get("state")
                    problem = "missing_state" if state is None else None
                else:
                    for path in volatile:
                        at = state
                        for key in path[:-1]:
                            at = at.get(key) if isinstance(at, dict) else None
                        if isinstance(at, dict):
                            at.pop(path[-1], None)
                said = None if problem else hashlib.sha256(json.dumps(state, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode("utf-8", "surrogatepass")).hexdigest()
                for column, v in zip(out, (event, relation, said, problem)):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in out], ["event_id", "relation_name", "signature", "problem"])

    r = relation_key("relation_name")
    rows = events.where(r.isin(STATE)).select("event_id", r.alias("relation_name"), "typed_event_json")
    return rows.mapInArrow(work, "event_id string, relation_name string, signature string, problem string")


def frame_diff(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(same, changed, left_only, right_only) rows of two frames of the same columns, by key and a hash of the rest; keys must be unique."""
    rest = [c for c in left.columns if c not in keys]
    side = lambda d, n: d.select(*keys, F.xxhash64(*rest).alias(n))
    both = side(left, "_a").join(side(right, "_b"), keys, "full_outer")
    a, b = F.col("_a"), F.col("_b")
    return both.agg(F.count_if(a == b).alias("same"), F.count_if(a != b).alias("changed"), F.count_if(b.isNull()).alias("left_only"), F.count_if(a.isNull()).alias("right_only"))
