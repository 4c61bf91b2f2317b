"""From typed events to searchable documents with an occurrence ledger."""

from __future__ import annotations

import json as codec
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestigo.functions.jsons import REFUSED, json_reader
from vestigo.functions.commands import COMMAND_REASON, command_event
from vestigo.functions.projection import DIRECT, OUTPUT, PARTS, projector
from vestigo.sources.tables import relation_key

_ARROW = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
_FIELDS = [tuple(c.split(" ")) for c in OUTPUT.split(", ")]


def project_events(events: DataFrame, parts: Iterable[str] = PARTS, commands: bool = False, make: Callable[..., Callable] = projector) -> DataFrame:
    """One row of ``projection.OUTPUT`` per event row, in Arrow batches; no row is ever lost.

    ``parts`` says what is worked out ('text', 'time', 'attributes'); the
    columns of the others are empty. ``commands``: project only what an event
    ran, called or executed; events without any command don't come out.
    ``make`` is the projector's factory, so another projector can be plugged in.
    """
    parts = frozenset(parts)
    reason_at = [n for n, _ in _FIELDS].index("disposition_reason")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project, read = make(parts), json_reader()
        for b in batches:
            rows = []
            for event_id, relation, text in zip(*[b.column(i).to_pylist() for i in range(3)]):
                if not commands:
                    rows.append(project(relation, event_id, text))
                    continue
                event = read(text)
                focus = command_event(relation, event) if event is not REFUSED and isinstance(event, dict) else None
                if focus is not None:
                    row = list(project(relation, event_id, codec.dumps(focus)))
                    if row[reason_at - 1] == DIRECT:
                        row[reason_at] = COMMAND_REASON
                    rows.append(row)
            cols = list(zip(*rows)) if rows else [()] * len(_FIELDS)
            yield pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, (_, k) in zip(cols, _FIELDS)], [n for n, _ in _FIELDS])

    return events.select("event_id", relation_key("relation_name").alias("relation_name"), "typed_event_json").mapInArrow(work, OUTPUT)


def group_documents(projected: DataFrame) -> DataFrame:
    """Equal content is one document: its occurrences are counted, its relations collected (a bounded set), the smallest one is primary.

    Content is grouped by its hash with partial sums; ``variants`` above 1
    would mean two texts under one identity.
    """
    rows = projected.where("document_id is not null")
    return rows.groupBy("document_id").agg(
        F.min("document_kind").alias("document_kind"),
        F.min("relation_name").alias("primary_relation"),
        F.array_join(F.array_sort(F.collect_set("relation_name")), ",").alias("relations"),
        F.min("semantic_text").alias("semantic_text"),
        F.count("*").alias("occurrence_count"),
        F.when(F.min("semantic_text") == F.max("semantic_text"), 1).otherwise(2).alias("variants"),
    )


def occurrence_rows(projected: DataFrame, snapshot: str = "", mapping: str = "") -> DataFrame:
    """The ledger: one row per event row with the document it supports (null if structured only)."""
    key = F.concat(F.lit("occ-"), F.sha2(F.concat_ws("\x00", F.lit(snapshot), "relation_name", "event_id"), 256))
    return projected.select(key.alias("occurrence_id"), "event_id", "document_id", "relation_name", "event_time", "exact_attributes_json", F.lit(snapshot).alias("snapshot_sha256"), F.lit(mapping).alias("mapping_sha256"))


def census(projected: DataFrame, documents: bool = True) -> DataFrame:
    """Per relation: rows, direct and structured-only rows (they add up to the rows), and distinct documents unless they aren't wanted."""
    direct = F.col("disposition") == DIRECT
    name = F.coalesce("relation_name", F.lit("")).alias("relation_name")
    counts = {"source_rows": F.count("*"), "semantic_rows": F.count_if(direct), "structured_only_rows": F.count_if(~direct)}
    if not documents:
        return projected.groupBy(name).agg(*[c.alias(n) for n, c in counts.items()])
    # equal documents are counted in each split before their rows move
    per = projected.groupBy(name, "document_id").agg(*[c.alias(n) for n, c in counts.items()])
    return per.groupBy("relation_name").agg(*[F.sum(n).alias(n) for n in counts], F.count("document_id").alias("documents"))


def coverage(projected: DataFrame) -> DataFrame:
    return projected.groupBy("disposition", "disposition_reason").agg(F.count("*").alias("n_rows"))


def time_accounting(projected: DataFrame) -> DataFrame:
    return projected.groupBy("time_availability").agg(F.count("*").alias("n_rows"))
