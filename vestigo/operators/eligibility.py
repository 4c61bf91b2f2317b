"""Occurrence-first filtering and the bounded lists of occurrences behind a hit."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vestigo.sources.tables import relation_key

MAX_RELATIONS, MAX_TOP, HIT_OCCURRENCES = 256, 100, 50

ATTRIBUTES = "array<struct<namespace:string,path:string,value:string>>"


@dataclass(frozen=True)
class OccurrenceFilter:
    """Relations, a half-open time range, snapshots, documents to leave out, entities that take part, and numeric fields by their path.

    Null times fail any time range. ``entities`` needs the participants;
    ``uids`` maps a path of an exact attribute, such as /activity_id, to the
    values one of which it must have.
    """

    relations: tuple[str, ...] = ()
    start: str | None = None
    end: str | None = None
    snapshots: tuple[str, ...] = ()
    exclude: tuple[str, ...] = field(default=())
    entities: tuple[str, ...] = ()
    uids: tuple[tuple[str, tuple[int, ...]], ...] = ()

    def check(self, top_n: int = 1) -> None:
        if not 1 <= top_n <= MAX_TOP:
            raise ValueError("top_n must be within 1..100")
        if len(self.relations) > MAX_RELATIONS:
            raise ValueError("too many relations")
        if self.start and self.end and not self.start < self.end:
            raise ValueError("the time range is empty")

    def condition(self) -> Column:
        ok = F.col("document_id").isNotNull()
        if self.relations:
            ok = ok & relation_key("relation_name").isin(list(self.relations))
        if self.start:
            ok = ok & (F.col("event_time") >= F.lit(self.start).cast("timestamp"))
        if self.end:
            ok = ok & (F.col("event_time") < F.lit(self.end).cast("timestamp"))
        if self.snapshots:
            ok = ok & F.col("snapshot_sha256").isin(list(self.snapshots))
        if self.exclude:
            ok = ok & ~F.col("document_id").isin(list(self.exclude))
        for path, values in self.uids:
            held = lambda a: (a["path"] == path) & a["value"].try_cast("long").isin([int(v) for v in values])  # noqa: E731, B023
            ok = ok & F.coalesce(F.exists(attributes(None), held), F.lit(False))
        return F.coalesce(ok, F.lit(False))


def eligible_occurrences(occurrences: DataFrame, wanted: OccurrenceFilter, participants: DataFrame | None = None) -> DataFrame:
    """Occurrences that pass; with ``entities`` those of events in which one of them takes part, by a semi join."""
    wanted.check()
    rows = occurrences.where(wanted.condition())
    if wanted.entities:
        if participants is None:
            raise ValueError("a filter by entity needs the participants")
        rows = rows.join(participants.where(F.col("entity_id").isin(list(wanted.entities))).select("event_id"), "event_id", "left_semi")
    return rows


def eligible_documents(occurrences: DataFrame, wanted: OccurrenceFilter, participants: DataFrame | None = None) -> DataFrame:
    """Documents with at least one occurrence that passes."""
    return eligible_occurrences(occurrences, wanted, participants).select("document_id").distinct()


def bounded_occurrences(occurrences: DataFrame, key: str = "document_id", order: str = "occurrence_id", most: int = HIT_OCCURRENCES) -> DataFrame:
    """The first ``most`` occurrences of each key, with the full count and whether the list is complete. Repeated rows count once.

    Counting is a partial aggregate and the list a limited window, so a key
    with a tenth of all rows never gathers more than ``most`` of them per split.
    """
    rows = occurrences.where(F.col(key).isNotNull()).select(key, order).distinct()
    counts = rows.groupBy(key).agg(F.count("*").alias("eligible"))
    w = Window.partitionBy(key).orderBy(order)
    first = rows.withColumn("position", F.row_number().over(w)).where(F.col("position") <= most)
    return first.join(counts, key).withColumn("exhausted", F.col("eligible") <= most)


def attributes(occurrences: DataFrame | None, column: str = "exact_attributes_json") -> Column:
    """The exact attributes as an array of (namespace, path, value as JSON text); null where they can't be read."""
    return F.from_json(F.col(column), ATTRIBUTES)


def attribute_predicate(path: str, op: str, value: float | str, column: str = "exact_attributes_json") -> Column:
    """Whether some attribute of that path compares so; numbers compare with numbers, texts with texts.

    'not_eq' asks for an attribute with another value, not for the absence of
    this one.
    """
    compare = {
        "eq": lambda a, b: a == b, "not_eq": lambda a, b: a != b, "lt": lambda a, b: a < b, "lte": lambda a, b: a <= b, "gt": lambda a, b: a > b, "gte": lambda a, b: a >= b,
    }[op]
    typed = (lambda v: v.try_cast("double")) if isinstance(value, (int, float)) else (lambda v: v)
    found = F.exists(F.from_json(F.col(column), ATTRIBUTES), lambda a: (a["path"] == path) & F.coalesce(compare(typed(a["value"]), F.lit(value)), F.lit(False)))
    return F.coalesce(found, F.lit(False))


def literal_match(text: Column, any_of: list[str] = (), all_of: list[str] = (), none_of: list[str] = ()) -> Column:
    """Case-insensitive substring rules over one text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    ok = F.lit(True)
    if any_of:
        hit = F.lit(False)
        for t in any_of:
            hit = hit | low.contains(t.lower())
        ok = ok & hit
    for t in all_of:
        ok = ok & low.contains(t.lower())
    for t in none_of:
        ok = ok & ~low.contains(t.lower())
    return ok
