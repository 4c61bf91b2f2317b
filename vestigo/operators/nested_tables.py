"""Nested JSON records as related flat tables, by shared inlining.

First pass: the schema graph. Each split reports its edges (element, field);
an element is named by the field its object stands in, directly or through
arrays. Elements that are the root, repeated or shared by several parents get
a table of their own; all others are singletons and are inlined into the row
of their nearest ancestor with a table. A recursive element is reached from
outside and from within, so on every cycle at least one element is shared.

Second pass: every event becomes rows of these tables. A row knows its event,
its own number in it, its parent's table and number, the field it stands in
and its place in the array. Cells are keyed by JSON pointer within the row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vestigo.functions.jsons import REFUSED, json_reader
from vestigo.session import cut_lineage

ROOT = "$"
#: Edges of the schema graph that the driver reads. A larger graph stays on the cluster, and every event gets the names it needs from it by a join.
DRIVER_EDGES = 20_000
#: Cell columns that a flat table shows at most unless they are named; the others stay together in other_cells.
FLAT_COLUMNS = 2_000

ROW_SCHEMA = (
    "event_id string, table_name string, row_no int, parent_table string, parent_row_no int, "
    "field string, place string, cells map<string,string>"
)


@dataclass(frozen=True)
class SchemaGraph:
    """``edges`` has (parent, field, kind, splits), ``elements`` (name, is_table); of a small graph ``known`` has the elements and ``cells`` the scalar columns, most common first."""

    edges: DataFrame
    elements: DataFrame
    known: dict[str, bool] | None
    cells: dict[str, list[str]] | None

    def is_table(self, names: set[str]) -> dict[str, bool]:
        """Those of the names that are elements, and whether they have a table."""
        if self.known is not None:
            return {n: self.known[n] for n in names if n in self.known}
        return {r[0]: r[1] for r in self.elements.where(F.col("name").isin(sorted(names))).collect()} if names else {}

    def crosses(self, pointer: str, unknown: bool = True) -> bool:
        """Whether a JSON pointer within a row leads through an element that isn't inlined in it; ``unknown``: what an element counts as that no event has."""
        through = set(_parts(pointer)[:-1])
        kinds = self.is_table(through)
        return any(kinds.get(p, unknown) for p in through)

    def columns(self, name: str, most: int = FLAT_COLUMNS) -> list[str]:
        """The scalar columns seen at an element itself, in order of name; of more than ``most`` the most common ones."""
        if self.cells is not None:
            return sorted(self.cells.get(name, [])[:most])
        seen = self.edges.where((F.col("parent") == name) & F.col("kind").isin("cell", "list")).groupBy("field").agg(F.sum("splits").alias("n"))
        return sorted(r[0] for r in seen.orderBy(F.desc("n"), "field").limit(most).collect())


def _parts(pointer: str) -> list[str]:
    return [p.replace("~1", "/").replace("~0", "~") for p in pointer.split("/")]


def schema_edges(events: DataFrame, json: str = "typed_event_json") -> DataFrame:
    """(parent, field, kind, splits): kind is 'one' or 'many' for objects, 'cell' for scalars and 'list' for arrays of scalars."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = json_reader()
        seen: set[tuple[str, str, str]] = set()
        for b in batches:
            for text in b.column(0).to_pylist():
                o = read(text)
                if o is REFUSED:
                    continue
                todo: list[tuple[object, str]] = [(o, ROOT)]
                while todo:
                    node, name = todo.pop()
                    if type(node) is not dict:
                        if type(node) is list:
                            todo.extend((x, name) for x in node)
                        continue
                    for k, v in node.items():
                        if type(v) is dict:
                            seen.add((name, k, "one"))
                            todo.append((v, k))
                        elif type(v) is list:
                            flat, at = [v], 0
                            while at < len(flat):
                                for x in flat[at]:
                                    if type(x) is list:
                                        flat.append(x)
                                    elif type(x) is dict:
                                        seen.add((name, k, "many"))
                                        todo.append((x, k))
                                    else:
                                        seen.add((name, k, "list"))
                                at += 1
                        else:
                            seen.add((name, k, "cell"))
        rows = list(zip(*seen)) if seen else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(list(r), pa.string()) for r in rows], ["parent", "field", "kind"])

    return events.select(json).mapInArrow(scan, "parent string, field string, kind string").groupBy("parent", "field", "kind").agg(F.count("*").alias("splits"))


def schema_graph(events: DataFrame, json: str = "typed_event_json", limit: int = DRIVER_EDGES) -> SchemaGraph:
    """The graph of all events, whatever its size; one with more than ``limit`` edges is written to the shared folder and stays there."""
    edges = schema_edges(events, json)
    few = edges.limit(limit + 1).collect()
    whole = len(few) <= limit
    if whole:
        edges = edges.sparkSession.createDataFrame(few, edges.schema)
    else:
        edges = cut_lineage(edges)
    objects = edges.where(F.col("kind").isin("one", "many"))
    # repeated, or below two different parents
    kinds = objects.groupBy(F.col("field").alias("name")).agg((F.bool_or(F.col("kind") == "many") | (F.min("parent") != F.max("parent"))).alias("is_table"))
    elements = kinds.where(F.col("name") != ROOT).unionByName(edges.sparkSession.range(1).select(F.lit(ROOT).alias("name"), F.lit(True).alias("is_table")))
    if not whole:
        return SchemaGraph(edges, elements, None, None)
    above: dict[str, set[str]] = {}
    many: set[str] = {ROOT}
    cells: dict[str, dict[str, int]] = {}
    for e in few:
        if e.kind in ("one", "many"):
            above.setdefault(e.field, set()).add(e.parent)
            if e.kind == "many":
                many.add(e.field)
        else:
            held = cells.setdefault(e.parent, {})
            held[e.field] = held.get(e.field, 0) + e.splits
    known = {n: len(parents) > 1 or n in many for n, parents in above.items()} | {ROOT: True}
    return SchemaGraph(edges, elements, known, {p: sorted(held, key=lambda f: (-held[f], f)) for p, held in cells.items()})


def _with_singletons(events: DataFrame, graph: SchemaGraph, json: str) -> DataFrame:
    """(event_id, json, singletons): with each text the names in it that are inlined, found by a join with the elements."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = json_reader()
        for b in batches:
            keys, out = [], []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                o = read(text)
                todo, seen = [] if o is REFUSED else [o], set()
                while todo:
                    node = todo.pop()
                    if type(node) is dict:
                        seen.update(k for k, v in node.items() if type(v) is dict)
                        todo.extend(node.values())
                    elif type(node) is list:
                        todo.extend(node)
                keys.extend([key] * len(seen))
                out.extend(seen)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(out, pa.string())], ["_h", "name"])

    keyed = events.select("event_id", json, F.sha2(json, 256).alias("_h"))
    singles = graph.elements.where("not is_table").select("name")
    # equal texts have equal names; a text's names are joined once for each split that holds it
    held = keyed.select("_h", json).mapInArrow(names, "_h string, name string").distinct().join(singles, "name").groupBy("_h").agg(F.collect_list("name").alias("singletons"))
    return keyed.join(held, "_h", "left").select("event_id", json, "singletons")


def shred(events: DataFrame, graph: SchemaGraph, json: str = "typed_event_json", only: list[str] | None = None, carry: dict[str, list[str]] | None = None) -> DataFrame:
    """All rows of all tables, in the columns of ``ROW_SCHEMA``.

    A cell is one letter for its JSON type (s text, n number, b boolean, z
    null, l array as JSON, without the objects in it) and the value. ``only`` names the leaf
    fields that are wanted; rows without any of them aren't sent on. ``carry``
    names JSON pointers whose cells the rows of a table shall hold even if they
    lead through objects with a table of their own. Texts
    that aren't one JSON value as a whole give no rows; an array as the whole
    text gives a root row for each object in it. Repeated events give equal
    rows.
    """
    import json as codec

    inlined = None if graph.known is None else frozenset(n for n, table in graph.known.items() if not table)
    wanted = None if only is None else frozenset(only)
    carried = {t: [(c, _parts(c)) for c in paths if graph.crosses(c)] for t, paths in (carry or {}).items()}
    names = [c.split(" ")[0] for c in ROW_SCHEMA.split(", ")]

    def cell(v: object) -> str:
        if type(v) is str:
            return "s" + v
        if v is None:
            return "z"
        if v is True or v is False:
            return "btrue" if v else "bfalse"
        return "n" + codec.dumps(v)

    def list_text(v: list) -> str | None:
        """A list's scalars as JSON, with the lists they stand in and without objects, which have rows; None if it holds objects only."""
        out, held, objects = ["["], False, False
        stack, first = [iter(v)], [True]
        while stack:
            for x in stack[-1]:
                if type(x) is dict:
                    objects = True
                    continue
                if not first[-1]:
                    out.append(", ")
                first[-1] = False
                if type(x) is list:
                    out.append("[")
                    stack.append(iter(x))
                    first.append(True)
                    break
                held = True
                out.append(codec.dumps(x))
            else:
                out.append("]")
                stack.pop()
                first.pop()
        return "".join(out) if held or not objects else None

    def pointer(k: str) -> str:
        return k.replace("~", "~0").replace("/", "~1") if "~" in k or "/" in k else k

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = json_reader()
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            keys: list[str] = []
            items: list[str] = []
            offsets = [0]
            own = b.column(2).to_pylist() if inlined is None else [None] * b.num_rows
            for event, text, names_in in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), own):
                o = read(text)
                if o is REFUSED:
                    continue
                number, singles = 0, inlined if inlined is not None else frozenset(names_in or ())
                # node, the field it stands in, place, parent table, parent number
                rows: list[tuple] = [(o, ROOT, "", None, None)]
                while rows:
                    node, name, place, above, above_no = rows.pop()
                    if type(node) is list:
                        rows.extend((x, name, f"{place}.{i}" if place else str(i), above, above_no) for i, x in reversed(list(enumerate(node))) if type(x) in (dict, list))
                        continue
                    if type(node) is not dict:
                        continue
                    mine, number = number, number + 1
                    before = len(keys)
                    inline: list[tuple[dict, str]] = [(node, "")]
                    while inline:
                        obj, prefix = inline.pop()
                        for k, v in obj.items():
                            kind = type(v)
                            if kind is dict:
                                if k in singles:
                                    inline.append((v, prefix + pointer(k) + "/"))
                                else:
                                    rows.append((v, k, "", name, mine))
                            elif kind is list:
                                if any(type(x) in (dict, list) for x in v):
                                    rows.append((v, k, "", name, mine))
                                if (wanted is None or k in wanted) and (said := list_text(v)) is not None:
                                    keys.append(prefix + pointer(k))
                                    items.append("l" + said)
                            elif wanted is None or k in wanted:
                                keys.append(prefix + pointer(k))
                                items.append(cell(v))
                    for path, parts in carried.get(name, ()):
                        v: object = node
                        for k in parts:
                            if type(v) is not dict or k not in v:
                                break
                            v = v[k]
                        else:
                            if type(v) is list and (said := list_text(v)) is not None:
                                keys.append(path)
                                items.append("l" + said)
                            elif type(v) not in (dict, list):
                                keys.append(path)
                                items.append(cell(v))
                    if wanted is not None and len(keys) == before:
                        continue
                    for col, v in zip(out, (event, name, mine, above, above_no, name, place)):
                        col.append(v)
                    offsets.append(len(keys))
            kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string())
            cells = pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys, pa.string()), pa.array(items, pa.string()))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(out, kinds)], cells], names)

    source = events.select("event_id", json) if inlined is not None else _with_singletons(events, graph, json)
    return source.mapInArrow(work, ROW_SCHEMA)


def flat_table(rows: DataFrame, graph: SchemaGraph, name: str, columns: list[str] | None = None, carried: bool = False) -> DataFrame:
    """One table: links and a text column for each cell; JSON pointers name the columns, with '.' for '/'.

    Without ``columns`` those of the graph, and ``other_cells`` with the cells
    of the row that these don't show, as in ``shred``. A column that leads
    through objects with a table of their own isn't in these rows: that is an
    error unless the rows were shredded with it in ``carry`` (``carried``).
    """
    wanted = columns if columns is not None else graph.columns(name)
    if columns is not None and not carried:
        away = [c for c in columns if graph.crosses(c, unknown=False)]
        if away:
            raise ValueError(f"columns {away} aren't inlined in table {name}: shred with carry")
    cell = lambda c: F.when(F.col("cells")[c].startswith("z"), None).otherwise(F.substr(F.col("cells")[c], F.lit(2)))
    links = ["event_id", "row_no", "parent_table", "parent_row_no", "field", "place"]
    rest = [F.map_filter("cells", lambda k, _: ~k.isin(wanted)).alias("other_cells")] if columns is None else []
    return rows.where(F.col("table_name") == name).select(*links, *[cell(c).alias(c.replace("/", ".")) for c in wanted], *rest)


def participations(rows: DataFrame) -> DataFrame:
    """(event_id, row_no, entity_id, role): every object with a non-empty text ``entity_id``, in whichever table or inlined prefix.

    The role is the object's own ``role``; if that is absent, null or empty,
    the field the object stands in.
    """
    last = lambda p: F.replace(F.replace(F.element_at(F.split(p, "/"), -1), F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~"))
    ids = F.filter(F.map_keys("cells"), lambda k: (k == "entity_id") | k.endswith("/entity_id"))
    each = rows.select("event_id", "row_no", "field", "cells", F.explode(ids).alias("_k"))
    prefix = F.substr(F.col("_k"), F.lit(1), F.length("_k") - F.lit(len("entity_id")))
    own: Column = F.col("cells")[F.concat(prefix, F.lit("role"))]
    stands = F.when(prefix == "", F.col("field")).otherwise(last(F.substr(F.col("_k"), F.lit(1), F.length("_k") - F.lit(len("/entity_id")))))
    entity = F.col("cells")[F.col("_k")]
    return each.select(
        "event_id",
        "row_no",
        F.when(entity.startswith("s"), F.substr(entity, F.lit(2))).alias("entity_id"),
        F.when(own.isNull() | own.startswith("z") | (own == "s"), stands).otherwise(F.substr(own, F.lit(2))).alias("role"),
    ).where("entity_id is not null and entity_id != ''")


def missing_participants(events: DataFrame, participants: DataFrame, json: str = "typed_event_json") -> DataFrame:
    """(event_id, entity_id, role) that the events hold and ``participants`` doesn't, each once.

    Compared exactly. Rows of ``participants`` with a null part match nothing;
    events without event_id give nothing.
    """
    known = events.where(F.col("event_id").isNotNull())
    held = participations(shred(known, schema_graph(known, json), json, only=["entity_id", "role"])).select("event_id", "entity_id", "role").distinct()
    key = ["event_id", "entity_id", "role"]
    return held.join(participants.select(*key), key, "left_anti")
