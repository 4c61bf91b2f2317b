"""Typed event relations in their two layouts, provenance of rows, and admission checks."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = "event_id STRING, typed_event_json STRING, support_ref STRING"
PREFIX = "event."

# Flattened columns that hold JSON text, not a value; by whole name, or by last name below some objects.
OPEN_COLUMNS = [
    "event.authorization_grants", "event.header", "event.semantics", "event.state_transitions",
    "event.workload_endpoints",
]
OPEN_PARENTS = [
    "event.ocsf.", "event.databucket.", "event.resource_details.", "event.process.", "event.src_endpoint.",
    "event.dst_endpoint.",
]
OPEN_NAMES = [
    "agent_list", "ancestry", "anomaly_analyses", "answers", "attacks", "auth_factors", "authorizations",
    "cis_controls", "containers", "data", "data_classifications", "discovery_details", "edges",
    "endpoint_connections", "enrichments", "environment_variables", "evidences", "extension_list", "extensions",
    "files", "fingerprints", "gpu_info_list", "groups", "hashes", "http_cookies", "http_headers",
    "ja4_fingerprint_list", "kb_article_list", "kill_chain", "loggers", "malware", "manager", "metrics",
    "network_interfaces", "nodes", "observables", "osint", "packet_list", "parameters", "parent_process", "policies",
    "programmatic_credentials", "proxy_endpoint", "related_analytics", "related_events", "resources", "sans",
    "scim_group_schema", "scim_user_schema", "signatures", "software_components", "tags", "tickets",
    "tls_extension_list", "traits", "transformation_info_list", "unmapped", "urls", "vulnerabilities", "xattributes",
]


def holds_json(column: str) -> bool:
    """Whether a flattened column holds an open object or a list of objects as JSON text."""
    return column in OPEN_COLUMNS or column.rsplit(".", 1)[-1] in OPEN_NAMES and column.startswith(tuple(OPEN_PARENTS))


def read_relation(spark: SparkSession, path: str, relation: str, columns: list[str] | None = None) -> DataFrame:
    """One relation file, tagged with its name; an unknown column is an error, others aren't scanned."""
    df = spark.read.schema(EVENT_SCHEMA).parquet(path) if columns is None else spark.read.parquet(path)
    if columns is not None:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"no column {missing[0]} in {relation}")
        df = df.select(*columns)
    return df.withColumn("relation_name", F.lit(relation))


def read_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """All relations of a folder, one Parquet file or folder each, under one schema."""
    out = None
    for p in sorted(Path(folder).glob("*.parquet")):
        one = read_relation(spark, str(p), p.name.removesuffix(".parquet"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], EVENT_SCHEMA + ", relation_name STRING")
    return out


def with_position(df: DataFrame) -> DataFrame:
    """Each row with its file and its place in it."""
    return df.select("*", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("source_file"), F.col("_metadata.row_index").alias("source_row"))


def _tree(columns: list[str]) -> dict:
    root: dict = {}
    for name in columns:
        at, parts = root, name.removeprefix(PREFIX).split(".")
        for p in parts[:-1]:
            at = at.setdefault(p, {})
            if not isinstance(at, dict):
                raise ValueError(f"{name} lies below a value")
        if parts[-1] in at:
            raise ValueError(f"{name} stands for a value and an object")
        at[parts[-1]] = name
    return root


def reassemble(df: DataFrame) -> DataFrame:
    """(event_id, typed_event_json, support_ref) from the flattened layout.

    Columns event.a.b become nested objects; null values are left out, as are
    objects that hold none, unless ``empty_object_paths`` lists them. Columns
    of open objects (``holds_json``) hold JSON text and are put in as it stands.
    """
    names = [f.name for f in df.schema.fields if f.name.startswith(PREFIX)]

    def quoted(name: str) -> Column:
        return F.col("`" + name.replace("`", "``") + "`")

    empty = F.coalesce(F.from_json("empty_object_paths", "array<string>"), F.array()) if "empty_object_paths" in df.columns else F.array()

    def text(node: dict | str, path: str) -> Column:
        if isinstance(node, str):
            if holds_json(node):
                return quoted(node)
            held = F.to_json(F.struct(quoted(node).alias("v")), {"ignoreNullFields": "false"})
            return F.when(quoted(node).isNotNull(), F.substr(held, F.lit(6), F.length(held) - 6))
        parts = []
        for k in sorted(node):
            inner = text(node[k], f"{path}.{k}" if path else k)
            parts.append(F.when(inner.isNotNull(), F.concat(F.to_json(F.array(F.lit(k))).substr(F.lit(2), F.lit(len(k) + 2)), F.lit(":"), inner)))
        body = F.concat_ws(",", *parts)
        kept = F.array_contains(empty.cast("array<string>"), path) if path else F.lit(True)
        return F.when((body != "") | kept, F.concat(F.lit("{"), body, F.lit("}")))

    return df.select("event_id", text(_tree(names), "").alias("typed_event_json"), "support_ref")


def admit(df: DataFrame, schema: str, expected_rows: int | None = None) -> DataFrame:
    """The frame if its columns are those of ``schema`` and, if given, its row count is right."""
    want = {f.name: f.dataType for f in T._parse_datatype_string(schema).fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    if want != have:
        raise ValueError(f"schema differs: {sorted(set(want.items()) ^ set(have.items()), key=str)[:2]}")
    if expected_rows is not None and df.count() != expected_rows:
        raise ValueError("row count differs")
    return df
