"""Derived documents and the small evidence functions."""

import json
import math

import pytest
from pyspark.sql import functions as F

from vestigo.functions import evidence
from vestigo.plans import derivations


def _event(i, relation, **body):
    return (f"e{i}", relation, json.dumps(body), "s")


METRIC = "ocsf_ext_livefire_system_metric"


@pytest.fixture(scope="module")
def rows(spark):
    metric = dict(metric="cpu", unit="percent")
    events = [_event(i, METRIC, header={"time": t}, value_milli=v, **metric) for i, (t, v) in enumerate([(299_000, 1), (299_999, 3), (300_000, 5), ("1970-01-01T00:05:01Z", 7), (-5, 1), ("soon", 1), (None, 1), (5, None)])]
    states = ["off", "off", "on", "on"]
    events += [_event(20 + i, "ocsf_inventory_info", time=100 * i, status=s) for i, s in enumerate(states)]
    events += [_event(30 + i, "OCSF_DNS_ACTIVITY", time=1_000 * i, query_type="A", bytes=b, rcode=o) for i, (b, o) in enumerate([(10, "ok"), (None, "ok"), (30, "bad")])]
    events += [("e50", METRIC, "{", "s"), ("e51", "ocsf_dns_activity", "[1]", "s"), ("e52", "ocsf_dns_activity", json.dumps({"time": 5}), "s"), events[0]]
    people = [(e, "ent1", "actor", "s") for e, *_ in events if e != "e52"] + [("e0", "ent1", "actor", "s"), (None, "ent1", "x", "s"), ("e0", None, "x", "s")]
    return derivations.admitted(
        spark.createDataFrame(events, "event_id string, relation_name string, typed_event_json string, support_ref string"),
        spark.createDataFrame(people, "event_id string, entity_id string, role string, support_ref string"),
    ).cache()


def test_metric_windows(rows):
    got = {r.window_start_ms: (r.n, r.value_min, r.value_max, r.value_sum) for r in derivations.metric_documents(rows).collect()}
    assert got == {0: (2, 1, 3, "4"), 300_000: (2, 5, 7, "12")}
    ids = [r.document_id for r in derivations.metric_documents(rows).collect()]
    assert len(set(ids)) == 2 and all(i.startswith("sha256:") for i in ids)


def test_network_windows_keep_missing_apart(rows):
    (r,) = derivations.network_documents(rows).collect()
    assert (r.n_events, r.bytes_observed, r.bytes_missing, r.bytes_sum, r.outcomes) == (3, 2, 1, 40, "bad=1;ok=2")


def test_transitions_and_coverage(rows):
    (r,) = derivations.transition_documents(rows).collect()
    assert (r.ms, r.previous_state, r.state) == (200, "off", "on") and "from: string-state" in r.semantic_text
    cov = {(r.family, r.reason): r.n for r in derivations.coverage(rows).collect()}
    assert cov["metric_window", "eligible"] == 4 and cov["metric_window", "invalid_time"] == 2 and cov["metric_window", "missing_time"] == 1
    assert cov["metric_window", "missing_value"] == 1 and cov["network_window", "missing_canonical_scope"] == 1 and sum(cov.values()) == 8 + 4 + 3 + 3


def test_set_digest_is_order_free(spark):
    df = spark.createDataFrame([(f"m{i}",) for i in range(100)], "m string")
    a = df.repartition(1).agg(evidence.set_digest(F.col("m"))).first()[0]
    assert a == df.repartition(9).orderBy(F.desc("m")).agg(evidence.set_digest(F.col("m"))).first()[0]
    assert a != df.where("m != 'm7'").agg(evidence.set_digest(F.col("m"))).first()[0]


def test_templates_and_vectors():
    assert evidence.fill_template("Do: {how}\n{query}", how="{query}", query="q") == "Do: {query}\nq"
    for bad in ("{query}{query}", "none", "{query}{other}"):
        with pytest.raises(ValueError):
            evidence.fill_template(bad, query="q")
    v = evidence.test_vector("k")
    assert v == evidence.test_vector("k") != evidence.test_vector("j")
    assert sum(x != 0 for x in v) == 16 and math.isclose(sum(x * x for x in v), 1)


def test_state_categories(spark):
    rows = [("In-Active", "string"), ("Running", "string"), ("secret name", "string"), ("true", "boolean"), ("-1200", "number"), ("1.5", "number"), ("[]", "list"), (None, "string")]
    df = spark.createDataFrame(rows, "t string, k string")
    got = [r[0] for r in df.select(evidence.state_category(F.col("t"), F.col("k"))).collect()]
    assert got == ["string-state", "running", "string-state", "true", "numeric-negative-1e3", "numeric-state", "list-state", "null-state"]


def test_frame_diff(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (4, "q")], "k int, v string")
    assert derivations.frame_diff(a, b, ["k"]).first()[:] == (1, 1, 1, 1)
