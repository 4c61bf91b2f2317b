"""Core operators against brute force, hand-computed values and metamorphic rules."""

import base64
import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vestigo.functions import text as tx
from vestigo.functions.field_classes import classify, snake
from vestigo.functions.commands import command_event, decoded_script
from vestigo.functions.projection import projector, time_text
from vestigo.operators import audit, dense, derive, eligibility, evaluate, geometry, lexical, ranking, sampling
from vestigo.plans import prepare, search
from vestigo.sources import sinks, snapshots
from vestigo.streaming import windows


def one(spark, expr, *values):
    cols = ", ".join(f"c{i} string" for i in range(len(values)))
    return spark.createDataFrame([values], cols).select(expr(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


def test_tokenizers(spark):
    t = "FooBarBaz9Q_x aB-cD éFoo HTTPServer İX x9Y"
    assert one(spark, tx.tokens_camel, t) == ["foo", "bar", "baz9q_x", "a", "b", "c", "d", "foo", "httpserver", "x", "x9y"]
    assert one(spark, tx.tokens_plain, "aB-cD HTTPServer ,,") == ["ab", "cd", "httpserver"]
    assert one(spark, tx.tokens_camel_digit, "x9Y") == ["x9", "y"]
    assert one(spark, tx.tokens_camel, "") == [] and one(spark, tx.tokens_camel, "!!") == []
    for kind in lexical.TOKENIZERS:
        assert lexical.tokenize_query(t, kind) == one(spark, lexical.TOKENIZERS[kind], t)


def test_text_functions(spark):
    assert one(spark, tx.key_name, "hostIdentifier-X") == "host_identifier_x" == snake("hostIdentifier-X")
    assert one(spark, tx.path_tokens, "ocsf.srcEndpoint[3].ip_addr") == sorted({"ocsf", "src_endpoint", "src", "endpoint", "ip_addr", "ip", "addr"})
    clean = one(spark, tx.sanitize, "password=abc\nmail a.b@c.example from 10.0.0.1 id " + "a" * 32)
    assert clean == "password=<redacted:secret> mail <redacted:email-address> from <redacted:ip-address> id <redacted:long-identifier>"
    assert one(spark, tx.sanitize, "version 1.2.3.4.5") == "version 1.2.3.4.5"
    assert len(one(spark, tx.sanitize, "y " * 500)) == 240
    wide = base64.b64encode("Get-Item x".encode("utf-16-le")).decode()
    assert one(spark, tx.decode_script, f"powershell -enc {wide}") == "Get-Item x"
    plain = base64.b64encode("echo plain text".encode()).decode()
    assert one(spark, tx.decode_script, f"x -EncodedCommand '{plain}'") == "echo plain text"
    assert one(spark, tx.decode_script, "x") is None
    assert spark.range(1).select(tx.power_bucket(F.lit(9)), tx.power_bucket(F.lit(0)), tx.magnitude_bucket(F.lit(-1234))).first()[:] == ("8-15", "0", "negative-1e3")


def test_field_classes():
    assert classify("ocsf.api_key").secret and classify("a.client_secret").secret and not classify("a.key").secret
    assert classify("user.name").identifier and classify("x.src_ip").identifier and not classify("class_uid").identifier
    assert classify("status").role == "outcome" and classify("api.operation").role == "action" and classify("file.path").role == "target"
    assert classify("calendarTime").time and classify("unmapped.$token/3").positional and classify("metadata.product.name").noise


def test_projection_rules():
    project = projector()
    event = {"ocsf": {"status": "Denied", "time": 1772323200000, "src_endpoint": {"port": 443}, "bytes": 1500}, "user": "bob", "pass": None, "password": "x", "unmapped": {"status": "other"}}
    row = project("ocsf_network_activity", "e1", json.dumps(event))
    text = row[4]
    assert "status=Denied" in text and "other" not in text and "bob" not in text and "user=<redacted:user>" in text
    assert "password=<redacted:secret>" in text and "<port:privileged:443>" in text and "<quantity:1e3>" in text
    assert row[9:11] == ("2026-03-01T00:00:00.000Z", "available") and row[11] == "direct_semantic_document"
    again = project("ocsf_network_activity", "e2", json.dumps({**event, "ocsf": {**event["ocsf"], "time": 5}}))
    assert again[3] == row[3] != project("ocsf_dns_activity", "e1", json.dumps(event))[3]
    reasons = [project(r, "e", t)[12] for r, t in (("ocsf_dns_activity", "{"), ("ocsf_dns_activity", "[]"), ("ocsf_dns_activity", None), ("nope", "{}"), (None, "{}"), ("ocsf_ext_livefire_system_metric", "{}"))]
    assert reasons == ["typed_event_unavailable"] * 3 + ["unknown_typed_relation"] * 2 + ["awaits_deterministic_window_derivation"]
    wide = project("ocsf_dns_activity", "e", json.dumps({f"k{i}": list(range(40)) for i in range(200)}))
    assert wide[14] <= 256 and wide[16] and len(wide[4]) <= 3072
    assert time_text(" 1772323200 ")[0] == "2026-03-01T00:00:00.000Z" and time_text("soon") == ("soon", "present_unparsed")


def test_row_and_column_sanitizers_agree(spark):
    from vestigo.functions.projection import sanitizer

    texts = ["", "x", "AKIA" + "A1" * 8, "a" * 32, "token abc", "a.b@c.example", "10.1.2.3", "Bearer abc.def", "x\n\ty", "aa:bb:cc:dd:ee:ff", "long " * 80, "arn:aws:s3:::b,c", "abcdefgh.abcdefgh.abcdefgh"]
    clean = sanitizer()
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tx.sanitize(F.col("t"))).collect()]
    assert got == [clean(t) for t in texts] and "<redacted:cloud-credential>" in got


def test_whole_texts_are_sanitized(spark, tmp_path):
    """All rules over whole texts of any script, against the rules of Python's own engine."""
    import re

    from vestigo.plans.preparation_queries import REGISTRY

    secrets = ["josé@mail.example", "10.1.2.3", "aa:bb:cc:dd:ee:ff", "AKIA" + "A1" * 8, "a" * 32, "Bearer abc.def", "password: x1", "arn:aws:s3:::b", "abcdefgh.abcdefgh.abcdefgh", "123e4567-e89b-12d3-a456-426614174000"]
    texts = [f"{filler * 60} {s}，{s}\u00a0 {s} ende" for filler in ("plain ", "“größer” ", "早く来て ") for s in secrets] + ["", None, "é10.1.2.3", "ébearer abc"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def clean(t):
        t = re.sub(r"[\0\r\n]", " ", t)
        for pattern, to in tx.REDACTIONS:
            t = re.sub(pattern, re.sub(r"\$(\d)", r"\\\1", to), t)
        return " ".join(t.split())

    got = {r.doc_id: r.clean for r in REGISTRY.fns["sanitized_full"](spark, str(tmp_path)).collect()}
    assert got == {k: None if t is None else clean(t) for k, t in enumerate(texts)}
    assert max(len(t) for t in got.values() if t) > 400 and not any("josé@" in t for t in got.values() if t)


def test_command_event():
    assert command_event("ocsf_process_activity", {"ocsf": {"process": {"cmd_line": "ls"}}})["source_kind"] == "typed_process_command"
    sysmon = {"ocsf": {"unmapped": {"E/Data/@Name": ["Image", "commandline"], "E/Data/#text": ["x", "whoami"]}}}
    assert command_event("ocsf_process_activity", sysmon)["command"] == "whoami"
    assert command_event("ocsf_process_activity", {"ocsf": {"unmapped": {"$token/10": "c", "$token/2": "b", "$token/1": "a"}}})["command"] == "a b c"
    assert command_event("ocsf_event_log_activity", {"event_id": "4104", "ocsf": {"message": "m"}})["script"] == "m"
    assert command_event("ocsf_api_activity", {"operation": "Put", "ocsf": {"status": "ok"}})["status"] == "ok"
    assert command_event("ocsf_dns_activity", {}) is None and command_event("ocsf_process_activity", {}) is None and command_event(None, {}) is None
    assert command_event("ocsf_event_log_activity", {"event_id": "4105", "ocsf": {"message": "m"}}) is None
    whole = {"operation": "Put", "service": 3, "time": 7, "ocsf": {"time": 9, "api": {"operation": "Get", "service": {"name": "s3"}}, "unmapped": {"requestParameters": {"a": 1}}}}
    assert command_event("ocsf_api_activity", whole) == {"action": "Put", "source_kind": "normalized_api_operation", "service": "s3", "request_parameters": {"a": 1}, "time": 9}
    assert command_event("ocsf_api_activity", whole | {"operation": None}) is None


def test_encoded_commands_are_decoded():
    import base64

    coded = lambda b: base64.b64encode(b).decode()
    text = f"powershell -EncodedCommand '{coded('Get-Item é'.encode('utf-16-le'))}'"
    assert decoded_script(text) == "Get-Item é"
    assert command_event("ocsf_process_activity", {"command_line": text})["decoded_script"] == "Get-Item é"
    assert decoded_script(f"x -enc {coded(b'whoami /a')}") == "whoami /a"  # an odd number of bytes
    assert decoded_script("x -enc AAAA") is None and decoded_script("x -enc !!!!!!!!!") is None and decoded_script("plain") is None
    assert decoded_script(f"x -enc {coded(bytes([0xff, 0xfe, 0xff]) * 3)}") is None
    assert "decoded_script" not in command_event("ocsf_process_activity", {"command_line": "ls -l"})


def test_prepare_closes(spark):
    rows = [("1", "OCSF_DNS_ACTIVITY ", '{"status":"a"}'), ("2", "ocsf_dns_activity", '{"status":"a","time":5}'), ("3", "x", "{}"), ("4", None, "{}"), (None, "ocsf_dns_activity", None), ("5", "ocsf_api_activity", '{"operation":"Get"}')]
    events = spark.createDataFrame(rows, "event_id string, relation_name string, typed_event_json string")
    p = prepare.project_events(events)
    docs = prepare.group_documents(p).collect()
    assert sorted((d.occurrence_count, d.variants) for d in docs) == [(1, 1), (2, 1)]
    census = prepare.census(p).collect()
    assert all(c.source_rows == c.semantic_rows + c.structured_only_rows for c in census) and sum(c.source_rows for c in census) == len(rows)
    assert prepare.occurrence_rows(p).count() == len(rows)
    assert [r.relation_name for r in prepare.project_events(events, commands=True).collect()] == ["ocsf_api_activity"]
    assert prepare.project_events(events.limit(0)).count() == 0


def _series(seed, n=600, spread=50):
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "hot", "b", None]), rng.randrange(spread), rng.choice(["on", "off", "idle", None]), f"e{i:04d}") for i in range(n)]


@pytest.mark.parametrize("shard", [1, 7, 1_000])
def test_transitions_by_brute_force(spark, shard):
    rows = _series(1)
    df = spark.createDataFrame(rows, "s string, t long, state string, event string").repartition(3)
    got = {(r.s, r.t): (r.event, r.state, r.previous_state, r.outcome) for r in derive.state_transitions(df, ["s"], "t", "state", "event", shard).collect()}
    want = {}
    for key in ("hot", "b"):
        before, first = None, True
        for t in sorted({t for s, t, x, _ in rows if s == key and x}):
            group = [(e, x) for s, u, x, e in rows if s == key and u == t and x]
            states = {x for _, x in group}
            state = states.pop() if len(states) == 1 else None
            outcome = "ambiguous" if state is None else "initial" if first else "no_predecessor" if before is None else "unchanged" if before == state else "transition"
            want[key, t] = (min(e for e, _ in group), state, before, outcome)
            before, first = state, False
    assert got == want


@pytest.mark.parametrize("back", [None, 6])
@pytest.mark.parametrize("shard", [3, 1_000])
def test_history_by_brute_force(spark, back, shard):
    rows = [r for r in _series(2, 400) if r[0]]
    df = spark.createDataFrame(rows, "s string, t long, state string, event string")
    got = {r.event: r.prior for r in derive.strict_history(df, ["s"], "t", back, shard).collect()}
    low = lambda t: -1e9 if back is None else t - back
    assert got == {e: sum(1 for s2, t2, *_ in rows if s2 == s and low(t) <= t2 < t) for s, t, _, e in rows}


@pytest.mark.parametrize("shard", [5, 10_000])
def test_interval_union_by_brute_force(spark, shard):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), s, s + rng.randrange(-2, 9)) for s in (rng.randrange(300) for _ in range(80))] + [("n", None, 5), ("t", 0, 5), ("t", 5, 9), ("t", 20, 21)]
    got = {r.k: (r.islands, r.covered) for r in derive.interval_union(spark.createDataFrame(rows, "k string, s long, e long"), ["k"], "s", "e", shard).collect()}
    want = {}
    for k in "abt":
        inside = {x for q, s, e in rows if q == k and s is not None for x in range(s, e)}
        want[k] = (sum(1 for x in inside if x - 1 not in inside), len(inside))
    assert got == want


def test_global_rank_equals_one_task(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(i, float(rng.randrange(20))) for i in range(500)], "id long, score double").repartition(6)
    a = {r.id: r.rank for r in ranking.with_rank(df, "id").collect()}
    b = {r.id: r.rank for r in ranking.with_rank(df, "id", one_task_bytes=0).collect()}
    assert a == b and sorted(a.values()) == list(range(1, 501))


def test_bm25_engines_agree(spark):
    rows = [(i, " ".join(random.Random(i).choice(["red", "Green", "blueSky", "x9Y", "", "ünder"]) for _ in range(i % 17))) for i in range(80)] + [(900, None), (901, "")]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        scan = {r.doc_id: round(r.score, 9) for r in lexical.bm25_scan(df, "red sky red").collect()}
        post = {r.doc_id: round(r.score, 9) for r in lexical.bm25_postings(lexical.postings(df, "doc_id", "text"), lexical.document_lengths(df, "doc_id", "text"), "red sky red").collect()}
        assert scan == post and all(s > 0 for s in scan.values())
        batch = {r.doc_id: r.score for r in lexical.bm25_batch(df, [(1, "red sky"), (2, "nothing"), (3, "")], n=100).collect()}
        assert batch == {d: round(s, 6) for d, s in scan.items()}
    assert lexical.bm25_scan(df.limit(0), "red").count() == 0
    assert lexical.bm25_scan(df, "red", keep_zero=True).count() == len(rows)


def test_search_modes_and_filters(spark):
    docs = spark.createDataFrame([("a", "red fox"), ("b", "red hen"), ("c", "blue fox")], "document_id string, text string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.8, 0.6]), ("c", [0.0, 1.0])], "document_id string, vector array<float>")
    occ = spark.createDataFrame(
        [("o1", "a", "R1", datetime(2026, 3, 1)), ("o2", "b", " r1", None), ("o3", "c", "r2", datetime(2026, 3, 2)), ("o4", None, "r1", datetime(2026, 3, 1))],
        "occurrence_id string, document_id string, relation_name string, event_time timestamp",
    )
    ids = lambda df: [r.document_id for r in df.orderBy("rank").collect()]
    assert ids(search.search(docs, None, "lexical", "red fox")) == ["a", "b", "c"]
    assert ids(search.search(docs, None, "dense", query_vector=[0.0, 1.0], vectors=vectors)) == ["c", "b", "a"]
    fused = search.search(docs, None, "fused", "red", [0.0, 1.0], vectors).orderBy("rank").collect()
    assert [r.document_id for r in fused] == ["a", "b", "c"] and fused[0].score == round(1 / 61 + 1 / 63, 6)
    timed = eligibility.OccurrenceFilter(relations=("r1",), start="2026-03-01 00:00:00", end="2026-03-02 00:00:00")
    assert ids(search.search(docs, occ, "lexical", "red fox", wanted=timed)) == ["a"]
    assert ids(search.search(docs, None, "lexical", "red fox", exclude=["a"])) == ["b", "c"]
    assert ids(search.similar(vectors, "a", 2)) == ["b", "c"]
    with pytest.raises(KeyError):
        search.similar(vectors, "zz")
    with pytest.raises(ValueError):
        search.search(docs, None, "other", "x")
    with pytest.raises(ValueError):
        eligibility.OccurrenceFilter(start="2", end="1").check()
    many = spark.createDataFrame([("a", f"o{i:03d}") for i in range(51)] + [("b", "o1"), ("b", "o1")], "document_id string, occurrence_id string")
    got = eligibility.bounded_occurrences(many).groupBy("document_id", "eligible", "exhausted").count().orderBy("document_id").collect()
    assert [tuple(r) for r in got] == [("a", 51, False, 50), ("b", 1, True, 1)]
    plan = spark.createDataFrame([("q", "m", "t"), ("q", "m", "t"), ("p", "m", "t"), ("p", "n", "u")], "query_id string, mode string, query string")
    assert {tuple(r) for r in search.check_plan(plan).collect()} == {("q", "repeated"), ("p", "text differs")}


def test_measures_by_hand(spark):
    ranking_rows = spark.createDataFrame([("q", "a", 1), ("q", "b", 2), ("q", "c", 3)], "q string, d string, rank int")
    judged = spark.createDataFrame([("q", "a", 0), ("q", "b", 3), ("q", "z", 2), ("r", "a", 1)], "q string, d string, grade int")
    rows = {r.q: r for r in evaluate.retrieval_metrics(ranking_rows, judged, "q", "d", relevant=2).collect()}
    ideal = 7 / math.log2(2) + 3 / math.log2(3)
    assert rows["q"].ndcg_5 == round(7 / math.log2(3) / ideal, 6) and rows["q"].recall_5 == 0.5 and rows["q"].reciprocal_rank == 0.5
    assert rows["r"].ndcg_5 == 0 and rows["r"].recall_5 is None and rows["r"].reciprocal_rank == 0
    vals = spark.createDataFrame([(f"c{i % 5}", float(i)) for i in range(50)], "c string, v double")
    ci = evaluate.bootstrap(vals, "c", "v", 200).first()
    assert ci.low <= ci.mean == 24.5 <= ci.high and ci.clusters == 5
    assert evaluate.macro(spark.createDataFrame([("a", "x", 1.0), ("a", "y", 0.0), ("a", "y", 0.0), ("b", "z", 1.0)], "c string, f string, v double"), ["c", "f"], "v").first().v == 0.75
    assert [r.passed for r in evaluate.gates(spark.createDataFrame([(0.5, None)], "a double, b double"), {"a": 0.5, "b": 0.1}).collect()] == [True, False]


def test_samples_and_plans(spark):
    assert sampling.largest_remainder({"a": 10, "b": 10, "c": 1}, 10) == {"a": 5, "b": 4, "c": 1} or sum(sampling.largest_remainder({"a": 10, "b": 10, "c": 1}, 10).values()) == 10
    assert sampling.largest_remainder({"a": 2, "b": 3}, 99) == {"a": 2, "b": 3} and sampling.largest_remainder({}, 5) == {}
    assert sampling.round_robin({("r", 0): 1, ("r", 1): 5, ("s", 0): 2}, 6) == {("r", 0): 1, ("r", 1): 3, ("s", 0): 2}
    df = spark.createDataFrame([(i, f"s{i % 3}", i % 50) for i in range(300)], "id long, s string, n int")
    whole = {r.id: r.level for r in sampling.nested_sizes(df, ["s"], "id", [5, 20, 60]).collect()}
    again = {r.id: r.level for r in sampling.nested_sizes(df.repartition(7), ["s"], "id", [5, 20, 60]).collect()}
    assert whole == again and len(whole) == 60 and sum(v == 5 for v in whole.values()) == 5
    assert sampling.stratified(df, "s", "id", 30).groupBy("s").count().collect() and sampling.stratified(df, "s", "id", 30).count() == 30
    tasks = sampling.greedy_ranges(df, "id", "n", 100, 7).orderBy("task").collect()
    assert sum(t.items for t in tasks) == 300 and all(t.items <= 7 and (t.tokens <= 100 or t.items == 1) for t in tasks)
    assert all(a.last < b.first for a, b in zip(tasks, tasks[1:]))
    assert sampling.percentile_floor(df, "n", (0.0, 0.5, 1.0)) == [0, 24, 49]
    assert {r.ordinal for r in sampling.dense_ordinals(df, "id").collect()} == set(range(300))
    assert sampling.nearest_rank([3, 1, 2], 0.5) == 2.0


def test_geometry(spark):
    rng = random.Random(5)
    rows = [(i, i % 2, [rng.gauss(0, 1) + 3 * (i % 2), rng.gauss(0, 1), 1.0]) for i in range(60)]
    rows = [(i, lab, [x / math.sqrt(sum(y * y for y in v)) for x in v]) for i, lab, v in rows]
    df = spark.createDataFrame(rows, "id long, label int, v array<float>")
    whole = dense.exact_neighbours(df, "id", "v", "label", 5).collect()
    blocks = dense.exact_neighbours(df.repartition(4), "id", "v", "label", 5, block_rows=13).collect()
    assert {tuple(r) for r in whole} == {tuple(r) for r in blocks} and len(whole) == 300
    assert all(r.label == r.neighbour_label for r in dense.exact_neighbours(df, "id", "v", "label", 3, "same").collect())
    pcs = geometry.principal_components(df, "id", "v", 2).toPandas()
    assert abs(pcs.pc1.mean()) < 1e-4 and pcs.pc1.var() >= pcs.pc2.var()
    lof = geometry.local_outlier_factor(dense.exact_neighbours(df, "id", "v", "label", 10), "id").toPandas()
    assert len(lof) == 60 and 0.5 < lof.lof.median() < 1.5
    tied = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 5.0)], "id long, x double")
    assert {r.id: r.percentile for r in geometry.average_rank_percentile(tied, "id", "x").collect()} == {1: 50.0, 2: 50.0, 3: 100.0}
    assert geometry.principal_components(df.limit(0), "id", "v").count() == 0


def test_audits(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), (None, 1)], "k string, v int")
    b = spark.createDataFrame([("y", 1), ("z", 1)], "k string, v int")
    assert audit.closure(a, b, "k").first()[:] == (1, 1, 1)
    assert [r.k for r in audit.orphans(a, b, "k").collect()] == ["x"]
    assert audit.payload_conflicts(a, "k", ["v"]).first()[:] == (2, 1, 1)
    assert audit.set_sizes(a.select("k"), b.select("k")).first()[:] == (1, 2, 1)
    assert audit.union_by_name(a, b.select("k")).where("v is null").count() == 2


def test_layouts_and_sinks(spark, tmp_path):
    flat = spark.createDataFrame(
        [("e1", "s", '["a.empty"]', 5, None, "t\"x", '{"k":[1]}'), ("e2", "s", None, None, None, None, None)],
        "event_id string, support_ref string, empty_object_paths string, `event.a.b` long, `event.a.c` string, `event.d` string, `event.ocsf.unmapped` string",
    )
    got = [json.loads(r.typed_event_json) for r in snapshots.reassemble(flat).orderBy("event_id").collect()]
    assert got == [{"a": {"b": 5}, "d": 't"x', "ocsf": {"unmapped": {"k": [1]}}}, {}]
    assert snapshots.holds_json("event.header") and not snapshots.holds_json("event.unmapped") and not snapshots.holds_json("event.ocsf.status")
    with pytest.raises(ValueError):
        snapshots._tree(["event.a", "event.a.b"])
    events = spark.createDataFrame([("e1", "{}", "s")], snapshots.EVENT_SCHEMA)
    events.write.parquet(str(tmp_path / "snap" / "rel_a.parquet"))
    events.write.parquet(str(tmp_path / "snap" / "rel_b.parquet"))
    snap = snapshots.read_snapshot(spark, str(tmp_path / "snap"))
    assert sorted(r.relation_name for r in snap.collect()) == ["rel_a", "rel_b"]
    assert snapshots.admit(events, snapshots.EVENT_SCHEMA, 1) is events
    with pytest.raises(ValueError):
        snapshots.admit(events, snapshots.EVENT_SCHEMA, 2)
    with pytest.raises(ValueError):
        snapshots.read_relation(spark, str(tmp_path / "snap" / "rel_a.parquet"), "rel_a", ["nope"])
    assert snapshots.with_position(spark.read.parquet(str(tmp_path / "snap" / "rel_a.parquet"))).first().source_row == 0
    docs = spark.createDataFrame([("a", "red fox"), ("b", "red hen"), ("c", None)], "document_id string, text string")
    sinks.write_documents(docs, str(tmp_path / "docs"))
    with pytest.raises(Exception):
        sinks.write_documents(docs, str(tmp_path / "docs"))
    sinks.write_occurrences(docs.withColumn("relation_name", F.lit("r")), str(tmp_path / "occ"))
    assert spark.read.parquet(str(tmp_path / "occ")).count() == 3
    sinks.write_json_lines(docs, str(tmp_path / "lines"))
    assert sinks.read_json_lines(spark, str(tmp_path / "lines"), "document_id string, text string").count() == 3
    cache = spark.createDataFrame([], "text_sha256 string, vector array<float>")

    def embed(frames):
        for f in frames:
            f["vector"] = [[float(len(t))] for t in f["text"]]
            yield f[["text_sha256", "vector"]]

    assert sorted(r.vector[0] for r in sinks.cached_embeddings(docs, cache, embed).collect()) == [7.0, 7.0]


def test_stream_equals_batch(spark, tmp_path):
    start = datetime(2026, 3, 1)
    rows = [("k", start + timedelta(seconds=70 * i), i) for i in range(60)] + [("k", start + timedelta(days=1), 0)]
    spark.createDataFrame(rows, "key string, at timestamp, v long").repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("key string, at timestamp, v long").parquet(str(tmp_path / "in"))
    windows.append_to(windows.metric_stream(stream, ["key"], "at", "v"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = {r.window_start_ms: (r.n, r.value_sum) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = spark.read.parquet(str(tmp_path / "in")).withColumn("ms", F.unix_millis("at"))
    want = {r.window_start_ms: (r.n, int(r.value_sum)) for r in derive.metric_windows(batch, ["key"], "ms", "v").collect()}
    assert got == {w: v for w, v in want.items() if w < 1772409600000} and got


def test_xml_fields(spark):
    xml = "<Event xmlns='urn:x'><EventData><Data Name='Image'>a.exe</Data><Data Name='CommandLine'>run it</Data><Data Name='Empty'/></EventData></Event>"
    assert one(spark, lambda c: tx.xml_field(c, "CommandLine"), xml) == "run it"
    assert one(spark, lambda c: tx.xml_field(c, "Other"), xml) is None
    with pytest.raises(ValueError):
        tx.xml_field(F.lit(""), "a'b")


def test_covers_owners_and_pilots(spark):
    want = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    made = spark.createDataFrame([("a",), ("a",), ("d",), (None,)], "k string")
    assert audit.exact_cover(want, made, "k").first()[:] == (2, 1, 1)
    held = spark.createDataFrame([("r1", "x"), ("r1", "y"), ("r2", "x"), ("r3", "x"), ("r3", "y"), ("r1", "x")], "r string, o string")
    assert {tuple(r) for r in audit.shared_owners(held, "r", "o", ["r3"]).collect()} == {("r1", 2)}
    rows = spark.createDataFrame([(i, "big" if i < 50 else "small") for i in range(58)], "id long, rel string")
    got = {r["rel"]: r["count"] for r in sampling.pilot(rows, "rel", "id", census=8, sample=20).groupBy("rel").count().collect()}
    assert got == {"big": 20, "small": 8}


def test_stored_query_vectors_and_envelopes(spark):
    stored = spark.createDataFrame([("q", "dense", 5, [1.0]), ("q", "dense", 9, [2.0]), ("p", None, 5, [3.0]), ("p", None, 5, [3.0])], "query string, mode string, top_n int, v array<float>")
    assert dense.query_vector(stored, {"query": "q", "mode": "dense", "top_n": 9}, "v") == [2.0]
    for surface in ({"query": "q", "mode": "dense"}, {"query": "z"}, {"query": "p", "mode": None, "top_n": 5}):
        with pytest.raises(KeyError):
            dense.query_vector(stored, surface, "v")
    hits = spark.createDataFrame([("a",)], "document_id string")
    assert search.envelope(hits, hits.union(hits), 1).first()[:] == (1, 2, False, "pointer")
    assert search.envelope(hits.limit(0), hits.limit(0), 1).first()[:] == (0, 0, True, "miss")


def test_canonical_lines(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"a":1,"b":"é"}\n{"a":{"x":[1,2]}}\n')
    (tmp_path / "bad.json").write_text('{"b":1,"a":2}\n')
    assert sinks.read_canonical_lines(spark, str(tmp_path / "good.json")).count() == 2
    with pytest.raises(Exception):
        sinks.read_canonical_lines(spark, str(tmp_path / "bad.json")).collect()
