"""Regular series, skewed keys and nested records on small, dirty inputs."""

import json
from collections import Counter, defaultdict
from datetime import UTC, datetime

from hypothesis import given, settings
from hypothesis import strategies as st

from vestigo.functions.jsons import REFUSED, _read_deep, json_reader
from vestigo.operators import nested_tables as nt
from vestigo.operators import regular_series as rs
from vestigo.operators import skewed_counts as sc

VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**20), 10**20) | st.floats(allow_nan=False, allow_infinity=False) | st.text(),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(max_size=5), inner, max_size=4),
    max_leaves=20,
)


@given(VALUES, st.sampled_from([None, 1]))
@settings(max_examples=200, deadline=None)
def test_deep_reader_equals_json(value, indent):
    text = json.dumps(value, indent=indent)
    assert _read_deep(text) == json.loads(text)


def test_json_reader_is_strict():
    read = json_reader()
    for bad in (None, "", "{", '{"a":1} x', "NaN", '{"a":NaN}', "[1,]", '{"a" 1}', "﻿{}"):
        assert read(bad) is REFUSED
    assert read('{"a":1,"a":2}') == {"a": 2}
    deep = "[" * 200_000 + "]" * 200_000
    assert read(deep) is not REFUSED
    assert read(deep[:-1]) is REFUSED


def test_epoch_and_values():
    ms = 1_772_323_200_000
    for v in (ms, ms * 1000, ms * 1_000_000, ms // 1000, "2026-03-01T00:00:00Z", "2026-03-01T02:00:00.000+02:00"):
        assert rs.epoch_ms(v) == ms
    for v in (-1, "soon", "", None, True, "2026-03-01T00:00:00", [1], {}):
        assert rs.epoch_ms(v) is None
    assert [rs.metric_value(v) for v in (5, "5", "-5", "--5", "", "5.0", 5.5, True, None, [5], 2**70, "٣")] == [5, 5, -5] + [None] * 9


def test_regular_series_by_brute_force(spark):
    step = 300_000
    rows = [("a", "m", t, t % 7) for t in (0, 1, 299_999, 300_000, 1_500_000, 400 * step, 401 * step + 5, 5_000 * step)]
    rows += [("b", "m", -1, 3), ("b", "m", 900_000, 4), ("c", "m", 10, 1), (None, "m", 5, 5), ("d", "m", None, 5), ("d", "m", 7, None)]
    df = spark.createDataFrame(rows, "source_id string, metric string, t long, v long").withColumnRenamed("t", "time_ms")
    got = {(r.source_id, r.window_start_ms) for r in rs.missing_windows(rs.window_cells(df, ["source_id", "metric"], "time_ms", "v"), ["source_id", "metric"]).collect()}
    held = defaultdict(set)
    for s, m, t, v in rows:
        if s is not None and t is not None and v is not None:
            held[s].add(t // step * step)
    want = {(s, w) for s, ws in held.items() for w in range(min(ws), max(ws), step) if w not in ws}
    assert got == want
    full = rs.regular_series(df, ["source_id", "metric"], "time_ms", "v").where("source_id = 'a'").orderBy("window_start_ms").collect()
    assert len(full) == 5_001 and full[0].n_readings == 3
    carried = None
    for r in full:
        if not r.is_missing:
            carried = r.carried_value
        assert r.carried_value == carried
    assert rs.regular_series(df.limit(0), ["source_id", "metric"], "time_ms", "v").count() == 0


def test_metric_readings_choose_time(spark):
    def event(i, head, **more):
        return (i, json.dumps({"header": head, "metric": "m", **more}), "x")

    events = spark.createDataFrame(
        [
            event("1", {"source_id": "s", "time": 5}, value_milli=1),
            event("2", {"source_id": "s", "time": 5}, value_milli="2"),
            event("2", {"time": 5, "source_id": "s"}, value_milli="2"),
            event("3", {"source_id": "s"}, value_milli=3),
            event("4", {"source_id": None, "time": 5}, value_milli=3),
            event("5", {"source_id": "s", "time": 5}, value_milli=1.5),
            ("6", None, "x"), ("7", '{"header":', "x"), (None, json.dumps({"header": {"source_id": "s", "time": 9}, "metric": "m", "value_milli": 9}), "x"),
        ],
        "event_id string, typed_event_json string, time_ms string",
    )
    at = datetime(2026, 3, 1, tzinfo=UTC)
    times = spark.createDataFrame([("2", at, 1), ("2", None, 2), ("3", None, 1)], "event_id string, event_time timestamp, value int")
    got = sorted((r.event_id or "", r.time_ms, r.value) for r in rs.metric_readings(events, times).collect())
    assert got == [("", 9_000, 9), ("1", 5_000, 1), ("2", 1_772_323_200_000, 2)]


def test_gaps_of_any_length_are_walked_in_steps(spark, monkeypatch):
    monkeypatch.setattr(rs, "STEP_SHARDS", 3)
    cells = rs.window_cells(spark.createDataFrame([("s", 0, 1), ("s", 300_000 * 5_000, 2)], "s string, t long, v long"), ["s"], "t", "v")
    got = sorted(r.window_start_ms for r in rs.missing_windows(cells, ["s"], shard_windows=20).collect())
    assert got == [300_000 * i for i in range(1, 5_000)]
    monkeypatch.undo()
    far = rs.window_cells(spark.createDataFrame([("s", 0, 1), ("s", 10**18, 2)], "s string, t long, v long"), ["s"], "t", "v")
    assert len(rs.missing_windows(far, ["s"]).take(5)) == 5  # listed as they are asked for


def _ledger(spark, rows):
    return spark.createDataFrame(rows, "relation string, event string, n_left int, k int")


def test_ledgers_by_brute_force(spark):
    a = [("hot", f"e{i % 50}", 1, 1) for i in range(400)] + [("x", "e1", 0, 0), (None, "e1", 0, 0), ("x", None, 0, 0), ("", "", 0, 0)]
    b = [("hot", f"e{i}", 1, 1) for i in range(25, 75)] + [("y", "e1", 0, 0), ("x", "e1", 0, 0), ("x", "e1", 0, 0)]
    left, right = _ledger(spark, a), _ledger(spark, b)
    ca, cb = (Counter((r, e) for r, e, *_ in rows if r is not None and e is not None) for rows in (a, b))
    for limit in (sc.DICTIONARY_KEYS, 1):
        got = {(r.relation, r.event): (r.n_left, r.n_right) for r in sc.ledger_cells(left, right, "relation", "event", 3, limit=limit).collect()}
        assert got == {k: (ca[k], cb[k]) for k in ca | cb}
    only = {(r.relation, r.event) for r in sc.one_sided(left, right, "relation", "event").collect()}
    assert only == set(ca) ^ set(cb)
    empty = left.limit(0)
    assert sc.one_sided(empty, empty, "relation", "event").count() == 0
    assert {tuple(r) for r in sc.one_sided(left, empty, "relation", "event").collect()} == set(ca)
    cmp = {r.relation: r for r in sc.ledger_comparison(left, right, "relation", "event").collect()}
    assert (cmp["hot"].left_rows, cmp["hot"].right_rows, cmp["hot"].both_members) == (400, 50, 25)


def test_ledger_blocks_are_streamed(spark, monkeypatch):
    """Members whose rows fill many batches, one of them with very many keys."""
    monkeypatch.setattr(sc, "HELD_ROWS", 1_000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        left = spark.range(30_000).selectExpr("cast(id as string) k", "if(id % 10 < 9, 'hot', cast(id as string)) m")
        right = spark.range(500).selectExpr("cast(id % 5 as string) k", "cast(id % 7 as string) m")
        cells = sc.ledger_cells(left, right, "k", "m", 2, limit=10).collect()
        got = {(r.k, r.m): (r.n_left, r.n_right) for r in cells}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = Counter((str(i), "hot" if i % 10 < 9 else str(i)) for i in range(30_000)), Counter((str(i % 5), str(i % 7)) for i in range(500))
    assert got == {c: (want[0][c], want[1][c]) for c in want[0] | want[1]} and len(cells) == len(got)


def test_dense_counts(spark):
    rows = [("a", 1), ("a", None), ("b", 5), (None, 7)] * 30
    df = spark.createDataFrame(rows, "key string, v int").repartition(5)
    assert {tuple(r) for r in sc.dense_key_counts(df, "key", ["v"]).collect()} == {("a", 60, 30), ("b", 30, 150)}
    wide = spark.createDataFrame([(f"k{i % 500}", i) for i in range(2_000)], "key string, v int")
    for limit in (sc.DICTIONARY_KEYS, 7):  # one dictionary for all splits, and small ones in each split
        found = sc.dense_key_counts(wide, "key", ["v"], limit=limit).collect()
        assert {r.key: (r.n_rows, r.v) for r in found} == {f"k{j}": (4, sum(range(j, 2_000, 500))) for j in range(500)} and len(found) == 500
    assert sc.dense_key_counts(df.limit(0), "key", ["v"]).count() == 0


def _participations(text):
    o, out = json_reader()(text), set()

    def walk(node, field):
        if isinstance(node, dict):
            e, r = node.get("entity_id"), node.get("role")
            if isinstance(e, str) and e:
                out.add((e, field if r is None or r == "" else r if isinstance(r, str) else json.dumps(r)))
            for k, v in node.items():
                walk(v, k)
        elif isinstance(node, list):
            for x in node:
                walk(x, field)

    if o is not REFUSED:
        walk(o, "$")
    return out


EVENTS = [
    {"a": {"b": {"entity_id": "e1"}}},
    {"list": [[{"entity_id": "e2", "role": "r"}], [{"entity_id": "e2"}, 5]], "a": {"entity_id": 7}},
    {"self": {"entity_id": "e3", "self": {"entity_id": "e4", "role": ""}}},
    {"x/y": {"entity_id": "e5"}, "x~1": {"entity_id": "e6", "role": None}, "a.b": {"entity_id": "e7", "role": "z"}},
    {"a": [1, 2, {"k": {"entity_id": "e8"}}], "t": '{"entity_id":"no"}', "entity_id": "root", "role": "self"},
    {"p": {"only": {"deep": {"er": {"entity_id": "e9", "role": 5}}}}},
    [],
    5,
]


def test_nested_tables_lose_nothing(spark):
    texts = [json.dumps(e) for e in EVENTS] + [None, "", "{", '{"a":{"entity_id":"cut"}', "null"]
    df = spark.createDataFrame([(str(i), t, 1) for i, t in enumerate(texts)] * 2, "event_id string, typed_event_json string, row_no int")
    want = {(str(i), *p) for i, t in enumerate(texts) for p in _participations(t)}
    whole = None
    for limit in (nt.DRIVER_EDGES, 3):  # a graph on the driver and one on the cluster
        graph = nt.schema_graph(df, limit=limit)
        assert (graph.known is None) == (limit == 3)
        assert {r.name: r.is_table for r in graph.elements.collect()} == nt.schema_graph(df).known
        assert all(graph.columns(n) == nt.schema_graph(df).columns(n) for n in ("$", "self", "deep"))
        rows = nt.shred(df, graph)
        got = {(r.event_id, r.entity_id, r.role) for r in nt.participations(rows).collect()}
        assert got == want
        links = rows.collect()
        whole = whole or sorted(map(str, links))
        assert sorted(map(str, links)) == whole
        known = {(r.event_id, r.row_no) for r in links}
        assert all(r.parent_row_no is None or (r.event_id, r.parent_row_no) in known for r in links)
    assert nt.schema_graph(df).is_table({"self", "list", "p", "none"}) == {"self": True, "list": True, "p": False}
    held = spark.createDataFrame([(e, i, r, None) for e, i, r in sorted(want)[1:]] + [("0", None, "b", None)], "event_id string, entity_id string, role string, support_ref string")
    assert {tuple(r) for r in nt.missing_participants(df, held).collect()} == {sorted(want)[0]}
    assert nt.missing_participants(df.limit(0), held).count() == 0


def test_lists_in_lists_keep_their_scalars(spark):
    deep = "[" * 3_000 + "7" + "]" * 3_000
    texts = ['{"a": [[1, 2], [], [{"b": 3}, "x"]], "c": [[]], "d": [{"e": 1}], "f": []}', '{"g": %s}' % deep]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "event_id string, typed_event_json string")
    rows = {(r.event_id, r.table_name): r.cells for r in nt.shred(df, nt.schema_graph(df)).collect()}
    assert rows["0", "$"] == {"a": 'l[[1, 2], [], ["x"]]', "c": "l[[]]", "f": "l[]"} and rows["0", "a"] == {"b": "n3"} and rows["0", "d"] == {"e": "n1"}
    assert rows["1", "$"] == {"g": "l" + deep}


def test_flat_table_values(spark):
    df = spark.createDataFrame([("1", json.dumps({"u": {"v": 1, "w": [1, 2]}, "n": None, "s": "x"}))], "event_id string, typed_event_json string")
    graph = nt.schema_graph(df)
    row = nt.flat_table(nt.shred(df, graph), graph, nt.ROOT, ["u/v", "u/w", "n", "s"]).first()
    assert (row["u.v"], row["u.w"], row["n"], row["s"]) == ("1", "[1, 2]", None, "x")


def test_document_groups_of_all_scripts(spark, tmp_path):
    import hashlib

    from vestigo.plans.relational_queries import REGISTRY

    texts = ["A  b", "a\tb ", "a\u00a0B", "“Quoted”", "“quoted”\n", "ÄÖ x", "äö  X", "早く 来て", "早く\u3000来て", "ΌΣΟΣ", "όσος", "İx", "", " ", None]
    docs = [(f"d{k:02d}", t) for k, t in enumerate(texts)]
    spark.createDataFrame(docs, "document_id string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want: dict[str, list[str]] = {}
    for d, t in docs:
        if t is not None:
            want.setdefault(hashlib.sha256(" ".join(t.split()).lower().encode()).hexdigest(), []).append(d)
    got = REGISTRY.fns["document_groups"](spark, str(tmp_path)).collect()
    assert {r.content_sha256: (r.occurrence_count, r.representative) for r in got} == {k: (len(v), min(v)) for k, v in want.items()}
    assert len(got) == len(want) == 7


def test_flat_cells_through_child_tables(spark, tmp_path):
    """One event that holds 'header' in an array and 'ocsf' under a second parent makes both tables; the others keep their cells."""
    import pytest

    from vestigo.plans.data_problems import REGISTRY

    texts = ['{"ocsf": {"status": "ok", "time": 5}, "header": {"source_id": "s1"}, "metric": "m"}', '{"header": [{"source_id": "s2"}], "x": {"ocsf": {"status": "no"}}}']
    events = [(f"e{k}", t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(events, "event_id string, typed_event_json string")
    df.write.parquet(f"{tmp_path}/typed_events.parquet")
    rows = {r.event_id: r.asDict() for r in REGISTRY.fns["p6_event_table"](spark, str(tmp_path)).collect()}
    assert [rows["e0"][c] for c in ("ocsf.status", "ocsf.time", "header.source_id", "metric")] == ["ok", "5", "s1", "m"]
    assert [rows["e1"][c] for c in ("ocsf.status", "ocsf.time", "header.source_id", "metric")] == [None] * 4
    graph = nt.schema_graph(df)
    assert graph.is_table({"header", "ocsf"}) == {"header": True, "ocsf": True}
    with pytest.raises(ValueError, match="ocsf/status"):
        nt.flat_table(nt.shred(df, graph), graph, nt.ROOT, ["metric", "ocsf/status"])
    got = [(r.event_id, r.table_name, r.parent_table, r.parent_row_no, r.field, r.place, json.loads(r.cells)) for r in REGISTRY.fns["p6_rows"](spark, str(tmp_path)).collect()]
    assert ("e0", "ocsf", "$", 0, "ocsf", "", {"status": "sok", "time": "n5"}) in got
    assert ("e1", "header", "$", 0, "header", "0", {"source_id": "ss2"}) in got and len(got) == 6
    with pytest.raises(ValueError, match="ocsf/status"):
        nt.flat_table(nt.shred(df, graph), nt.schema_graph(df, limit=1), nt.ROOT, ["metric", "ocsf/status"])
    few = nt.schema_graph(df, limit=1)
    assert few.known is None and few.columns("ocsf") == ["status", "time"] and few.columns("ocsf", 1) == ["status"]
