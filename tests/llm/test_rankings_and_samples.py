"""Top items per group and the growth-stable sample."""

import random

from vestigo.llm.stable_sample import merge_weights, stable_sample
from vestigo.llm.top_items import top_items

SCHEMA = "g string, i string, s long, low boolean, _g int, _c string"


def _brute(rows, n):
    best = {}
    for g, i, s, low, *_ in rows:
        if g is not None and i is not None and s is not None:
            c = s if low else -s
            best[g, i] = min(c, best.get((g, i), c))
    out = set()
    for g in {g for g, _ in best}:
        ranked = sorted((c, i) for (x, i), c in best.items() if x == g)[:n]
        out |= {(g, i, c, p + 1) for p, (c, i) in enumerate(ranked)}
    return out


def test_top_items_hot_and_cold(spark):
    rng = random.Random(1)
    rows = [("hot", f"i{rng.randrange(900)}", rng.randrange(5), True, 1, "x") for _ in range(2_000)]
    rows += [("tied", f"t{k:04d}", 7, False, 1, "x") for k in range(700)]
    rows += [(f"g{rng.randrange(60)}", f"i{k}", rng.randrange(100), False, None, None) for k in range(500)]
    rows += [(None, "i", 1, True, 0, ""), ("g1", None, 1, True, 0, ""), ("g1", "i", None, True, 0, ""), ("one", "", 3, True, 0, "")]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        for hot in (50, 10**6):
            got = {tuple(r) for r in top_items(df, "g", "i", "s", 10, "low", hot_items=hot).collect()}
            assert got == _brute(rows, 10)
    assert top_items(df.limit(0), "g", "i", "s").count() == 0


def _records(spark, rows):
    return spark.createDataFrame(rows, "id string, w double, b int, weight string")


def test_sample_is_stable_and_grows(spark):
    rows = [(f"r{k % 3000}", 0.5 + (k % 7) / 4, k % 5, "extra") for k in range(4_000)] + [(None, 1.0, 0, ""), ("", 1.0, 0, ""), ("n", None, 0, ""), ("m", -1.0, 0, ""), ("q", float("nan"), 0, "")]
    pick = lambda rs, parts=3: {r.id: (r.weight, r.first_order) for r in stable_sample(_records(spark, rs).repartition(parts), "id", 0.2, "w", "b").collect()}
    full = pick(rows)
    assert full == pick(rows[::-1], 11)
    shares = len(full) / 3_000
    assert 0.2 < shares < 0.35
    before = set()
    for b in range(5):
        now = set(pick([r for r in rows if r[2] <= b]))
        assert before <= now
        before = now
    assert all(f is not None for _, f in full.values())
    heavy = {r.id for r in stable_sample(_records(spark, [(f"z{k}", 10.0, 0, "") for k in range(50)]), "id", 0.1, "w").collect()}
    assert len(heavy) == 50
    assert stable_sample(_records(spark, rows).limit(0), "id", 0.5).count() == 0


def test_running_weights(spark):
    a, b = _records(spark, [("x", 1.0, 0, ""), ("y", 3.0, 0, "")]), _records(spark, [("x", 2.0, 0, ""), ("y", 1.0, 0, ""), (None, 9.0, 0, "")])
    assert {tuple(r) for r in merge_weights(a, b, "id", "w").collect()} == {("x", 2.0), ("y", 3.0)}
