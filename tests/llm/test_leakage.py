"""Leaked passages: brute force over exact runs, and edited copies."""

import random

from vestigo.llm import leakage
from vestigo.llm.leakage import align, align_scores, leaked_items, longest_run, ngrams, word_normaliser
import numpy as np


def test_words_are_normalised():
    words = word_normaliser()
    assert words("Ｆｏｏ so­ft ﬁne​-X_y ²") == ["foo", "soft", "fine", "x", "y", "2"]
    assert words("ABC_def,9") == ["abc", "def", "9"] and words("") == []


def _plain_align(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_plain():
    rng = random.Random(3)
    for _ in range(60):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(0, 25))] for _ in range(2))
        score, equal, a0, a1, b0, b1 = align(np.array(a, np.int32), np.array(b, np.int32))
        assert score == _plain_align(a, b) == _plain_align(a[a0:a1], b[b0:b1]) and equal <= min(a1 - a0, b1 - b0)
    far = np.array([9] * 50_000 + [1, 2, 3, 8, 4, 5] + [9] * 10, np.int32)
    assert align(np.array([1, 2, 3, 4, 5], np.int32), far) == (9, 5, 0, 5, 50_000, 50_006)


def test_longest_run():
    run = lambda a, b: longest_run(np.array([ord(c) for c in a], np.int32), np.array([ord(c) for c in b], np.int32))
    assert run("abcdx", "zabcd") == 4 and run("", "a") == 0 and run("a", "") == 0 and run("aaa", "aaaaa") == 3 and run("abab", "xababab") == 4


def test_exact_runs_by_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 60)))) for k in range(30)] + [(90, None), (91, ""), (92, "one"), (3, None)]
    docs = []
    for k in range(200):
        body = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))]
        if k % 3 == 0:
            w = items[rng.randrange(30)][1].split(" ")
            n = rng.randrange(8, 20)
            s = rng.randrange(max(1, len(w) - n))
            body[rng.randrange(len(body) + 1) : 0] = [x.upper() + rng.choice(["", ",", ".\n"]) for x in w[s : s + n]]
        docs.append((k, " ".join(body), "clash"))
    docs += [(500, None, ""), (501, "", ""), (None, "w1 w2", ""), docs[0], (502, "w1 " * 20_000, "")]
    words = word_normaliser()
    want = set()
    for d, t, _ in docs:
        grams = set(ngrams(words(t or ""), 12))
        want |= {(d, i) for i, x in items if x and grams & set(ngrams(words(x), 12))}
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    for limit in (200_000, 100):
        monkeypatch.setattr(leakage, "SLICE_CHARS", 64_000_000 if limit > 100 else 1_500)
        found = leaked_items(frame, tests, pass_ngrams=limit).collect()
        assert {(r.doc_id, r.item_id) for r in found if r.run_words >= 12} == {p for p in want if p[0] is not None}
        assert len(found) == len({(r.doc_id, r.item_id) for r in found})
    assert leaked_items(frame.limit(0), tests).count() == 0
    assert leaked_items(frame, tests.limit(0)).count() == 0


def test_scores_of_many_texts_equal_plain():
    rng = random.Random(5)
    for _ in range(20):
        a, *texts = ([rng.randrange(6) for _ in range(rng.randrange(1, 25))] for _ in range(9))
        got = align_scores(np.array(a, np.int32), [np.array(t, np.int32) for t in texts])
        assert got.tolist() == [_plain_align(a, t) for t in texts]


def test_all_passages_by_brute_force(spark):
    """One whole copy, many partial ones that make the seeds around them common, and copies edited at every third or fifth word."""
    rng = random.Random(6)
    item = [f"i{k}" for k in range(30)]
    other = [f"i{rng.randrange(30)}" for _ in range(25)]
    noise = lambda n: [f"x{rng.randrange(1000)}" for _ in range(n)]
    bodies = [noise(9) + item + noise(7)]
    for _ in range(120):
        n, s = rng.randrange(6, 12), rng.randrange(20)
        bodies.append(noise(rng.randrange(8)) + item[s : s + n] + noise(rng.randrange(8)))
    for step in (2, 3, 4, 5):
        for s in range(step):
            bodies.append([f"y{k}" if k % step == s else w for k, w in enumerate(item)])
            bodies.append([w for k, w in enumerate(item) if k % step != s])
            bodies.append([x for k, w in enumerate(item) for x in ([w, "z"] if k % step == s else [w])])
    docs = [(k, " ".join(b)) for k, b in enumerate(bodies)]
    tests = {7: item, 8: other, 9: item[:7]}
    want = set()
    for d, b in enumerate(bodies):
        for i, w in tests.items():
            if (score := _plain_align(w, b)) >= 16:
                want.add((d, i, score))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for limit in (200_000, 20):
        found = leaked_items(frame, spark.createDataFrame([(i, " ".join(w)) for i, w in tests.items()], "item_id long, text string"), pass_ngrams=limit).collect()
        assert sorted((r.doc_id, r.item_id, r.score) for r in found) == sorted(want)


def test_edited_copy_is_found(spark):
    item = "the quiet harbor master counted seven green lanterns before the storm took the last ferry north to the islands"
    copy = "yesterday the quiet harbor master counted eight green lanterns before the big storm took the last ferry north"
    df = spark.createDataFrame([(1, copy), (2, "nothing of the kind stands in here at all")], "doc_id long, text string")
    found = leaked_items(df, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1, 7)] and found[0].run_words < 12 and found[0].equal_words >= 13


def test_edited_copies_of_the_items_are_found(spark, folder):
    """Copies of every item with one word in 3, 4, 5 or 6 changed, between other words."""
    words = word_normaliser()
    items = spark.read.parquet(f"{folder}/eval_items.parquet").select("item_id", "text")
    docs = []
    for item, text in items.collect():
        for step in (3, 4, 5, 6):
            body = [f"changed{item}" if k % step == step - 1 else w for k, w in enumerate(words(text))]
            docs.append((item * 10 + step, " ".join(["before", "it", *body, "and", "after"])))
    found = {(r.doc_id, r.item_id) for r in leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    for step in (3, 4, 5, 6):
        asked = [(d, d // 10) for d, _ in docs if d % 10 == step]
        assert sum(x in found for x in asked) >= 0.95 * len(asked)
