"""Closed filters, receipts, state signatures, relationships and paired intervals, by hand."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from vestigo.operators import audit, dense, eligibility, evaluate, ranking, sampling
from vestigo.plans import derivations


def test_closed_filters(spark):
    attrs = lambda **kv: json.dumps([{"namespace": "n", "path": f"/{k}", "value": v} for k, v in kv.items()])
    rows = [("o1", "e1", "d1", attrs(activity_id=1)), ("o2", "e2", "d2", attrs(activity_id="2")), ("o3", "e3", "d3", attrs(other=1)), ("o4", "e1", None, attrs(activity_id=1)), ("o5", "e4", "d5", None), ("o6", None, "d6", "{")]
    occ = spark.createDataFrame(rows, "occurrence_id string, event_id string, document_id string, exact_attributes_json string")
    part = spark.createDataFrame([("e1", "x"), ("e1", "x"), ("e3", "x"), ("e4", "y"), (None, "x"), ("e2", None)], "event_id string, entity_id string")
    ids = lambda w: sorted(r[0] for r in eligibility.eligible_documents(occ, w, part).collect())
    assert ids(eligibility.OccurrenceFilter(entities=("x",))) == ["d1", "d3"]
    assert ids(eligibility.OccurrenceFilter(uids=(("/activity_id", (1, 2)),))) == ["d1", "d2"]
    assert ids(eligibility.OccurrenceFilter(entities=("x", "y"), uids=(("/activity_id", (1,)),))) == ["d1"]
    with pytest.raises(ValueError):
        eligibility.eligible_documents(occ, eligibility.OccurrenceFilter(entities=("x",)))


def test_receipts_and_admission(spark):
    rows = [("r", "a", "1"), ("r", "b", None), ("s", "a", ""), (None, "c", "x")]
    df = spark.createDataFrame(rows, "part string, k string, v string")
    mine = audit.receipts(df, F.col("part"), ["k", "v"])
    assert audit.admission(mine, audit.receipts(df.repartition(3), F.col("part"), ["k", "v"])).count() == 0
    other = spark.createDataFrame([("r", "a", "1"), ("r", "b", ""), ("t", "a", ""), (None, "c", "x"), (None, "c", "x")], df.schema)
    got = {r.part: r.problem for r in audit.admission(mine, audit.receipts(other, F.col("part"), ["k", "v"])).collect()}
    assert got == {"r": "content differs", "s": "not expected", "t": "missing", None: "row count differs"}
    assert audit.receipts(df.limit(0), F.col("part"), ["k"]).count() == 0


def test_state_signatures(spark):
    state, config = "ocsf_inventory_info", derivations.CONFIGURATION
    events = [
        ("1", state, '{"a": [1, {"b": null}], "time": 5, "ocsf": {"time": 1, "x": 2}}'), ("2", state + " ", '{"ocsf": {"x": 2}, "event_id": "q", "a": [1, {"b": null}]}'), ("3", state, '{"ocsf": {"x": 2}, "a": [{"b": null}, 1]}'),
        ("4", config, '{"state": {"on": true}, "n": 1}'), ("5", config, '{"state": {"on": true}, "n": 2}'), ("6", config, '{"n": 2}'), ("7", state, "[1]"), ("8", state, None), ("9", "ocsf_dns_activity", "{}"), ("10", state, '{"header": 5, "ocsf": []}'),
    ]
    got = {r.event_id: (r.signature, r.problem) for r in derivations.state_signatures(spark.createDataFrame(events, "event_id string, relation_name string, typed_event_json string")).collect()}
    assert got["1"] == got["2"] != got["3"] and got["4"] == got["5"] and "9" not in got and got["10"][0]
    assert [got[k][1] for k in ("1", "6", "7", "8")] == [None, "missing_state", "typed_event_unavailable", "typed_event_unavailable"]


def test_relationship_ends(spark):
    ends = spark.createDataFrame([("a", "b"), ("a", None), ("z", "b"), (None, None)], "source_entity_id string, target_entity_id string")
    entities = spark.createDataFrame([("a", "user"), ("b", "file")], "entity_id string, kind string")
    got = {(r.source_entity_id, r.target_entity_id): (r.source_kind, r.target_kind, r.dangling) for r in audit.resolved_ends(ends, entities).collect()}
    assert got == {("a", "b"): ("user", "file", False), ("a", None): ("user", None, False), ("z", "b"): (None, "file", True), (None, None): (None, None, False)}


def test_paired_bootstrap(spark):
    left = spark.createDataFrame([(f"k{i}", f"c{i % 20}", float(i % 7)) for i in range(200)] + [("only", "c", 1.0), ("k0x", "c", None)], "k string, c string, v double")
    right = left.select("k", (F.col("v") + F.lit(0.5)).alias("v"))
    one = evaluate.paired_bootstrap(left, right, "k", "v", "c").first()
    assert np.isclose([one.mean, one.low, one.high], 0.5).all() and one.clusters == 21
    assert evaluate.paired_bootstrap(left.limit(0), right, "k", "v", "c").count() == 0


def test_running_totals_by_ranges(spark):
    df = spark.createDataFrame([(i % 37, i, float(i % 5)) for i in range(400)] + [(None, 400, 1.0)], "s int, i int, w double").repartition(5)
    order = [F.col("s"), F.col("i")]
    for ranges in (1, 2, 9):
        got = {r.i: r.t for r in ranking.running_total(df, order, F.col("w"), "t", ranges).collect()}
        want, total = {}, 0.0
        for r in sorted(df.collect(), key=lambda r: (r.s is not None, r.s or 0, r.i)):
            total += r.w
            want[r.i] = total
        assert got == want
    assert ranking.running_total(df.limit(0), order, F.col("w"), "t", 4).count() == 0


@pytest.mark.parametrize("max_items", [1, 4, 50])
def test_greedy_ranges_in_chunks_equal_one_walk(spark, max_items):
    rng = np.random.default_rng(max_items)
    sizes = [int(x) for x in rng.choice([0, 0, 1, 3, 9, 40, 120], 700)]
    df = spark.createDataFrame([(i, n if n != 3 else None) for i, n in enumerate(sizes)] + [(None, 5)], "k long, n long").repartition(5)
    want, task = [], None
    for i, n in enumerate(0 if n == 3 else n for n in sizes):
        if task is None or task[3] + n > 100 or task[2] >= max_items:
            want.append(task := [i, i, 0, 0])
        task[1], task[2], task[3] = i, task[2] + 1, task[3] + n
    for chunk in (10, 150, 10_000):
        got = sampling.greedy_ranges(df, "k", "n", 100, max_items, chunk_items=chunk).orderBy("task").collect()
        assert [(r.task, r.first, r.last, r["items"], r.tokens) for r in got] == [(i, *t) for i, t in enumerate(want)]
    assert sampling.greedy_ranges(df.limit(0), "k", "n", 100, max_items).count() == 0


@pytest.mark.parametrize("scope", ["all", "same", "other"])
def test_exact_neighbours_in_blocks(spark, scope):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 4)).round(1)
    rows = [(f"v{i:02d}", int(i % 3), [float(v) for v in x[i]], 1.0) for i in range(90)] + [("lonely", 9, [1.0] * 4, 1.0), ("none", 1, None, 1.0), ("nolabel", None, [1.0] * 4, 1.0)]
    df = spark.createDataFrame(rows, "id string, label int, v array<double>, similarity double")
    held = [r for r in rows if r[1] is not None and r[2] is not None]
    want = {}
    for a in held:
        best = sorted((-round(float(np.dot(a[2], b[2])), 9), b[0]) for b in held if b[0] != a[0] and (scope == "all" or (a[1] == b[1]) == (scope == "same")))
        want[a[0]] = [(b, -s) for s, b in best[:5]]
    for size in (13, 1_000):
        got = {}
        for r in sorted(dense.exact_neighbours(df, "id", "v", "label", 5, scope, size).collect(), key=lambda r: r["rank"]):
            got.setdefault(r.id, []).append((r.neighbour, r.similarity))
        assert got == {k: v for k, v in want.items() if v}
    assert dense.exact_neighbours(df.limit(0), "id", "v", "label", 5, scope).count() == 0
