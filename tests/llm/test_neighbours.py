"""Graph search: recall against brute force, dirty vectors, copies, groups of equal vectors."""

import numpy as np
from pyspark.sql import functions as F

from vestigo.llm import hnsw
from vestigo.llm import neighbours as nb
from vestigo.llm.neighbours import _decode, _encode, draw_map, most_similar, mutual_pairs

SCHEMA = "vector_ordinal long, document_id string, vector array<float>, similarity string"


def _clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(12, d))[rng.integers(0, 12, n)] + 1.2 * rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _recall(found, true):
    return np.mean([len({i for i in a if i >= 0} & set(b)) / len(b) for a, b in zip(found, true)])


def test_graph_recall_and_flat_levels():
    both = _clustered(5_300, 32, 1)
    x, q = both[:5_000], both[5_000:]
    g = hnsw.build(x, np.random.default_rng(2).random(len(x)))
    assert len(g.sizes) == 3 and g.sizes[0] == 5_000 > g.sizes[1] > g.sizes[2]
    assert all(a.dtype == np.int32 and a.shape == (n, hnsw.WIDTH) and a.max() < n for a, n in zip(g.links, g.sizes))
    ids, sims = hnsw.search(g, q, 10, beam=96)
    assert _recall(ids, np.argsort(-(q @ x.T), axis=1)[:, :10]) > 0.9
    assert (np.diff(sims, axis=1) <= 1e-6).all() and all(len(set(r)) == 10 for r in ids)
    node = np.empty(len(x), np.int64)
    node[g.order] = np.arange(len(x))
    ids, _ = hnsw.search(g, x[:500], 11, beam=64, own=node[:500])
    true = np.argsort(-(x[:500] @ x.T), axis=1)[:, :11]
    assert (true[:, 0] == np.arange(500)).all() and _recall(ids, true) > 0.93


def test_small_graphs():
    for n in (0, 1, 2, 5):
        x = _clustered(n, 8, 4) if n else np.zeros((0, 8), np.float32)
        g = hnsw.build(x, np.full(n, 0.5))
        ids, _ = hnsw.search(g, _clustered(4, 8, 5), 3)
        assert ids.shape == (4, 3) and all(len({i for i in r if i >= 0}) == min(n, 3) for r in ids)


def test_fixed_point_error():
    import pyarrow as pa

    x = _clustered(500, 96, 6)
    y = _decode(pa.chunked_array([_encode(x)]), 96)
    assert np.abs((x * y).sum(axis=1) - 1).max() < 1e-5


def test_most_similar_by_brute_force(spark):
    x = _clustered(1_500, 16, 7).astype(np.float64)
    x[700:706] = x[3]  # equal vectors
    x[800] = x[4] * 5  # another length, same direction
    rows = [(i, f"d{i:04d}", [float(v) for v in x[i]], "clash") for i in range(len(x))]
    rows += [(2_000, "null", None, ""), (2_001, "short", [1.0], ""), (2_002, "zero", [0.0] * 16, ""), (2_003, "nan", [float("nan")] * 16, ""), (2_004, None, [1.0] * 16, ""), (2_005, "inf", [float("inf")] + [1.0] * 15, "")]
    rows += [rows[9], rows[9]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = most_similar(df, dimensions=16).collect()
    got = {}
    for r in found:
        got.setdefault(r.document_id_a, {})[r.document_id_b] = r.position
    f32 = x.astype(np.float32).astype(np.float64)
    u = f32 / np.linalg.norm(f32, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -9)
    hits = sum(len({f"d{j:04d}" for j in np.argsort(-s[i], kind="stable")[:10]} & set(got[f"d{i:04d}"])) for i in range(len(x)))
    assert hits / (10 * len(x)) > 0.93
    assert set(got) == {f"d{i:04d}" for i in range(len(x))} and all(sorted(p.values()) == list(range(1, 11)) for p in got.values())
    assert {f"d{i:04d}" for i in range(700, 706)} <= set(got["d0003"])
    few = most_similar(df, dimensions=16, queries=F.col("vector_ordinal") % 100 == 0).collect()
    assert {r.document_id_a for r in few} == {f"d{i:04d}" for i in range(0, 1_500, 100)}
    pairs = {tuple(r) for r in mutual_pairs(most_similar(df, dimensions=16, min_similarity=0.9)).collect()}
    want = {(f"d{a:04d}", f"d{b:04d}") for a, b in zip(*np.nonzero(s >= 0.9)) if a < b}
    assert len(want - pairs) <= 0.02 * len(want) and not pairs - want
    assert most_similar(df.limit(0), dimensions=16).count() == 0


def test_a_third_of_all_rows_share_a_vector(spark):
    x = _clustered(400, 16, 8)
    rows = [(i, f"c{i:03d}", [float(v) for v in x[0]], "") for i in range(200)] + [(500 + i, f"d{i:03d}", [float(v) for v in x[i]], "") for i in range(1, 400)]
    found = most_similar(spark.createDataFrame(rows, SCHEMA), dimensions=16).where("document_id_a like 'c%'").collect()
    got = {}
    for r in found:
        got.setdefault(r.document_id_a, []).append((r.position, r.document_id_b))
    assert len(got) == 200
    for k, v in got.items():
        assert [b for _, b in sorted(v)] == [f"c{i:03d}" for i in range(12) if f"c{i:03d}" != k][:10]


def _lattice(n, seed):
    """20 plain clusters and one that holds 30 % of the vectors, on surfaces of 12 dimensions in 48."""
    rng = np.random.default_rng(seed)
    at = np.where(rng.random(n) < 0.3, 0, rng.integers(1, 21, n))
    basis = rng.normal(size=(21, 12, 48)) / 7
    x = rng.normal(size=(21, 48))[at] + np.einsum("ni,nij->nj", rng.normal(size=(n, 12)), basis[at]) + 0.02 * rng.normal(size=(n, 48))
    return x / np.linalg.norm(x, axis=1, keepdims=True), at


def test_recall_when_few_shards_are_asked(spark):
    """12,000 vectors, 30 % of them in one cluster, about 20 shards, of which a query asks 6."""
    x, at = _lattice(12_000, 9)
    plan = draw_map(x[::2].astype(np.float32), np.ones(6_000, bool), len(x), home=700, probes=6)
    held = np.bincount(np.argmax(x @ plan.centroids.T, axis=1), minlength=len(plan.centroids))
    assert len(held) >= 16 and plan.probes == 6 and held.max() <= 1.7 * 700
    df = spark.createDataFrame([(i, f"d{i:05d}", [float(v) for v in x[i]], "") for i in range(len(x))], SCHEMA)
    found = most_similar(df, dimensions=48, queries=F.col("vector_ordinal") % 20 == 0, home=700, probes=6).collect()
    measured = nb.recall(spark.createDataFrame(found), df, dimensions=48, queries=1_000).first()
    assert (measured.queries, measured.neighbours) == (600, 6_000) and measured.recall >= 0.9
    got = {}
    for r in found:
        got.setdefault(int(r.document_id_a[1:]), set()).add(int(r.document_id_b[1:]))
    assert set(got) == set(range(0, 12_000, 20)) and all(len(v) == 10 for v in got.values())
    s = x[::20] @ x.T
    s[np.arange(len(s)), np.arange(0, 12_000, 20)] = -9
    true = np.argsort(-s, axis=1)[:, :10]
    for rows in (np.arange(600), np.flatnonzero(at[::20] == 0)):  # all queries, and those of the crowded cluster
        assert len(rows) > 100 and _recall([got[20 * i] for i in rows], true[rows]) >= 0.9
    assert abs(measured.recall - _recall([got[20 * i] for i in range(600)], true)) < 0.002


def test_parts_and_copies_change_nothing_but_the_layout(spark, monkeypatch):
    """Territories in parts that are all asked, and shards in several copies: each pair once, recall as before."""
    x, _ = _lattice(3_000, 10)
    df = spark.createDataFrame([(i, f"d{i:05d}", [float(v) for v in x[i]], "") for i in range(len(x))], SCHEMA)
    monkeypatch.setattr(nb, "MAX_TERRITORIES", 2)
    monkeypatch.setattr(nb, "MAX_HOME", 400)
    monkeypatch.setattr(nb, "ASKED", 1)
    found = most_similar(df, dimensions=48, home=300, probes=3).collect()
    pairs = {(r.document_id_a, r.document_id_b) for r in found}
    assert len(pairs) == len(found) == 30_000
    s = x @ x.T - 9 * np.eye(len(x))
    true = {(f"d{i:05d}", f"d{j:05d}") for i, row in enumerate(np.argsort(-s, axis=1)[:, :10]) for j in row}
    assert len(true & pairs) >= 0.9 * len(true)
