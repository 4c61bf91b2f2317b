"""Held-out test items that leaked into a corpus.

Pairs are scored by Smith-Waterman alignment over words, which also bridges
words that were changed, dropped or added. A passage of a given score needn't
hold any long run, so no n-gram seed meets all of them: a pair is left out only
if a bound on its score shows that it can't reach the score asked for, and the
rest is aligned many documents at a time.

Where only runs of window length are asked for, seeds do: every window of an
item's words is represented by its rarest word n-gram, so a passage of window
length always holds a seed while common n-grams aren't looked up. Corpus texts
are scanned once for the items' n-grams; pairs with a seed are aligned.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in a seed, and words in the windows that must be represented by a seed.
SEED_WORDS = 5
WINDOW_WORDS = 12
#: Alignment scores of an equal word, a changed word and a gap.
MATCH, CHANGE, GAP = 2, -1, -1
#: Item n-grams that one pass broadcasts (about 100 bytes each); more items go in further passes.
PASS_NGRAMS = 200_000
#: Characters of items that the driver reads at a time.
SLICE_CHARS = 64_000_000
#: Words of documents that are bounded and aligned together, items in one table of bounds, and cells of one bound matrix.
GROUP_WORDS, TABLE_ITEMS, BOUND_CELLS = 30_000, 256, 4_000_000

_PLAIN = re.compile(r"[a-z0-9]+")
_WORDS = re.compile(r"[^\W_]+")


def word_normaliser() -> object:
    """A function text -> words: NFKC, without format characters (Cf), lower case; runs of letters and digits."""

    def words(text: str) -> list[str]:
        if text.isascii():
            return _PLAIN.findall(text.lower())
        text = unicodedata.normalize("NFKC", text)
        hidden = {ord(c): None for c in set(text) if unicodedata.category(c) == "Cf"}
        return _letters((text.translate(hidden) if hidden else text).lower())

    return words


def _letters(text: str) -> list[str]:
    """Runs of letters (L*) and digits (Nd, Nl, No); marks separate, as everything else does."""
    return _WORDS.findall(text)


def ngrams(words: list[str], n: int) -> list[str]:
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, int, int]:
    """Best local alignment of two coded word sequences: (score, equal words, a_start, a_end, b_start, b_end).

    Row by row; the gap along a row is a running maximum, so numpy does each
    row at once. A first pass keeps one row and finds where the best alignment
    ends; it can't reach further back than three times the length of ``a``, as
    each gap in ``a`` is paid for by half an equal word, so the second pass
    holds all rows of that stretch only.
    """
    best, _, end = _rows(a, b, None)
    if not best:
        return 0, 0, 0, 0, 0, 0
    first = max(0, end - 3 * len(a))
    h = np.zeros((len(a) + 1, end - first + 1), np.int32)
    _rows(a, b[first:end], h)
    i, j = np.unravel_index(int(h.argmax()), h.shape)
    score, end_a, end_b, equal = int(h[i, j]), int(i), int(j), 0
    b = b[first:end]
    while i and j and h[i, j] > 0:
        same = b[j - 1] == a[i - 1]
        if h[i, j] == h[i - 1, j - 1] + (MATCH if same else CHANGE):
            equal += int(same)
            i, j = i - 1, j - 1
        elif h[i, j] == h[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, equal, int(i), end_a, int(j) + first, end_b + first


def _rows(a: np.ndarray, b: np.ndarray, keep: np.ndarray | None) -> tuple[int, int, int]:
    """(best score, its row, its column) of the alignment table, the first of equal ones; all rows go to ``keep``."""
    n = len(b)
    row, best, at = np.zeros(n + 1, np.int32), 0, (0, 0)
    ramp = np.arange(1, n + 1, dtype=np.int32) * -GAP
    for i in range(1, len(a) + 1 if n else 0):
        up = np.maximum(row[:-1] + np.where(b == a[i - 1], MATCH, CHANGE), row[1:] + GAP)
        np.maximum(up, 0, out=up)
        row = np.concatenate([[0], np.maximum.accumulate(up + ramp) - ramp]).astype(np.int32)
        if keep is not None:
            keep[i] = row
        j = int(row.argmax())
        if row[j] > best:
            best, at = int(row[j]), (i, j)
    return best, *at


def align_scores(a: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """The score of ``align(a, t)`` for every text t; the texts, none of them empty, stand behind each other.

    Each text is preceded by a cell that is held at 0, and the ramp of the
    running maximum jumps there by more than any score, so that nothing
    crosses over from the text before.
    """
    starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    n = int(starts[-1]) + len(texts[-1]) + 1
    x = np.full(n, -2, np.int32)
    for s, t in zip(starts, texts):
        x[s + 1 : s + 1 + len(t)] = t
    ramp = np.full(n, -GAP, np.int64)
    ramp[starts] += MATCH * len(a) + 1
    np.cumsum(ramp, out=ramp)
    if ramp[-1] < 2**30:
        ramp = ramp.astype(np.int32)
    h, best, up = (np.zeros(n, ramp.dtype) for _ in range(3))
    for word in a:
        np.multiply(x[1:] == word, MATCH - CHANGE, out=up[1:], casting="unsafe")
        up[1:] += h[:-1] + CHANGE
        h += GAP
        np.maximum(up, h, out=up)
        np.maximum(up, 0, out=up)
        up[starts] = 0
        up += ramp
        np.maximum.accumulate(up, out=h)
        h -= ramp
        np.maximum(best, h, out=best)
    return np.maximum.reduceat(best, starts)


class Bounds:
    """For a coded text, the items with which it can reach a score at all.

    Two bounds. A word of the item is equal to one word of the text at most, so
    equal words are no more than both have in common, repetitions counted. And
    each word of the text's part is equal to a word of the item or costs a
    change or a gap, so no score exceeds the best sum of a stretch of the text
    in which words of the item count MATCH and others the smaller cost.
    """

    def __init__(self, items: list[np.ndarray], n_words: int) -> None:
        self.tables = []
        for s in range(0, len(items), TABLE_ITEMS):
            part = items[s : s + TABLE_ITEMS]
            held = np.unique(np.concatenate(part))
            local = np.full(n_words + 1, len(held), np.int32)  # the last code stands for words of no item
            local[held] = np.arange(len(held))
            often = np.zeros((len(held) + 1, len(part)), np.uint16)
            for k, codes in enumerate(part):
                word, n = np.unique(local[codes], return_counts=True)
                often[word, k] = np.minimum(n, 65_535)
            self.tables.append((s, local, often))

    def items(self, text: np.ndarray, score: int) -> list[int]:
        out: list[int] = []
        word, n = np.unique(text, return_counts=True)
        n = np.minimum(n, 65_535).astype(np.uint16)[:, None]
        for first, local, often in self.tables:
            common = np.minimum(often[local[word]], n).sum(axis=0, dtype=np.int64)
            hopeful = np.flatnonzero(MATCH * common >= score)
            step = max(1, BOUND_CELLS // max(1, len(text)))
            codes = local[text] if len(hopeful) else None
            for s in range(0, len(hopeful), step):
                some = hopeful[s : s + step]
                total = np.cumsum(np.where(often[codes[:, None], some] > 0, MATCH, max(CHANGE, GAP)), axis=0, dtype=np.int32)
                low = np.minimum(np.minimum.accumulate(total, axis=0), 0)
                total[1:] -= low[:-1]
                out.extend((some[total.max(axis=0) >= score] + first).tolist())
        return out


def longest_run(a: np.ndarray, b: np.ndarray) -> int:
    """Most consecutive codes that two sequences share; one number per place of ``b`` is held."""
    run, best = np.zeros(len(b) + 1, np.int32), 0
    for code in a if len(b) else ():
        at = np.flatnonzero(b == code)
        here = run[at] + 1
        run[:] = 0
        if len(at):
            run[at + 1] = here
            best = max(best, int(here.max()))
    return best


def leaked_items(
    documents: DataFrame,
    items: DataFrame,
    document: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
    seed_words: int = SEED_WORDS,
    window_words: int = WINDOW_WORDS,
    min_score: int = 16,
    pass_ngrams: int = PASS_NGRAMS,
    every_passage: bool = True,
) -> DataFrame:
    """(document, item, score, equal_words, run_words) of every leaked passage with alignment score ``min_score`` or more.

    ``score`` and ``equal_words`` are of the best local alignment, ``run_words``
    is the longest shared run of consecutive words. Texts are taken whole.
    ``items`` is a stated set; the driver reads it in slices of bounded size, and
    its words are broadcast in passes of bounded size. Null and empty texts match nothing; repeated
    documents or items count once.

    Without ``every_passage`` only pairs with a seed are aligned: every pair
    that shares ``window_words`` consecutive words comes out if min_score is at
    most twice that number, others may be missing. Items shorter than a seed
    are then represented by their whole text.
    """
    words = word_normaliser()
    kinds = dict(documents.dtypes)[document], dict(items.dtypes)[item]
    held = items.select(F.col(item).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    slices = max(1, math.ceil((held.agg(F.sum(F.length("t"))).first()[0] or 0) / SLICE_CHARS))
    blocks: list[list[tuple[object, list[str]]]] = [[]]
    for n in range(slices):
        used = 0
        part = held if slices == 1 else held.where(F.pmod(F.xxhash64("i"), F.lit(slices)) == n)
        for k, w in ((k, words(t)) for k, t in sorted({(r[0], r[1]) for r in part.collect()})):
            if blocks[-1] and (used + len(w) > pass_ngrams or not used):
                blocks.append([])
                used = 0
            used += len(w)
            if w:
                blocks[-1].append((k, w))
    docs = documents.select(F.col(document).alias("d"), F.col(text).alias("t")).where("d is not null and t is not null and t != ''")
    if every_passage:
        found = [_every_pass(docs, block, kinds, max(1, min_score)) for block in blocks if block]
    else:
        found = [_pass(docs, block, kinds, seed_words, window_words, min_score) for block in blocks if block]
    out = found[0] if found else docs.sparkSession.createDataFrame([], _found_schema(kinds))
    for more in found[1:]:
        out = out.unionByName(more)
    best = out.groupBy("d", "i").agg(F.max("score").alias("score"), F.max("equal_words").alias("equal_words"), F.max("run_words").alias("run_words"))
    return best.select(F.col("d").alias(document), F.col("i").alias(item), "score", "equal_words", "run_words")


def _every_pass(docs: DataFrame, tests: list[tuple[object, list[str]]], kinds: tuple[str, str], min_score: int) -> DataFrame:
    """All pairs that reach ``min_score``, by bounds and alignment."""
    shipped = docs.sparkSession.sparkContext.broadcast([(k, w) for k, w in tests if MATCH * len(w) >= min_score])
    types = _found_types(kinds)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, items = word_normaliser(), shipped.value
        codes: dict[str, int] = {}
        coded = [np.array([codes.setdefault(x, len(codes)) for x in w], np.int32) for _, w in items]
        bounds = Bounds(coded, len(codes)) if items else None

        def scored(group: list[tuple[object, np.ndarray]]) -> list[tuple]:
            hopeful: dict[int, list[int]] = {}
            for at, (_, text) in enumerate(group):
                for k in bounds.items(text, min_score):
                    hopeful.setdefault(k, []).append(at)
            rows = []
            for k, places in hopeful.items():
                key, _ = items[k]
                points = align_scores(coded[k], [group[at][1] for at in places])
                for at in (places[p] for p in np.flatnonzero(points >= min_score)):
                    d, text = group[at]
                    # the item's rows against the whole text
                    best, equal, *_ = align(coded[k], text)
                    rows.append((d, key, best, equal, longest_run(coded[k], text)))
            return rows

        group, used = [], 0
        for b in batches if items else ():
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words(t)
                text = np.array([codes.get(x, len(codes)) for x in w], np.int32)
                if MATCH * np.count_nonzero(text < len(codes)) < min_score:
                    continue
                group.append((d, text))
                used += len(text)
                if used >= GROUP_WORDS:
                    yield from _typed(scored(group), types)
                    group, used = [], 0
        if group:
            yield from _typed(scored(group), types)

    return docs.mapInArrow(pairs, _found_schema(kinds))


def _pass(docs: DataFrame, tests: list[tuple[object, list[str]]], kinds: tuple[str, str], n: int, window: int, min_score: int) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    grams: dict[str, int] = {}
    for _, w in tests:
        for g in ngrams(w, min(n, len(w))):
            grams.setdefault(g, len(grams))
    book = sc.broadcast(grams)
    lengths = sorted({len(g.split(" ")) for g in grams})

    def scan(hits: object, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Passes on what ``hits`` makes of each document that holds an item n-gram."""
        words, known = word_normaliser(), book.value
        heads = {g.split(" ", 1)[0] for g in known}
        for b in batches:
            rows: list[tuple] = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words(t)
                at = [i for i, x in enumerate(w) if x in heads]
                got = {g for i in at for k in lengths for g in (known.get(" ".join(w[i : i + k])),) if g is not None}
                if got:
                    rows.extend(hits(d, w, got))
            yield from _batches(rows)

    # pass 1: in how many documents each item n-gram stands, summed per split before the shuffle
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(grams), np.int64)
        for b in scan(lambda d, w, got: [(g,) for g in got], batches):
            np.add.at(total, b.column(0).to_numpy(), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["g", "n"])

    found = docs.mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    frequency = dict(found.collect())  # at most one row per item n-gram
    # seeds: in every window of an item, its rarest n-gram of those that the corpus holds
    seeds: dict[int, list[int]] = {}
    for k, (_, w) in enumerate(tests):
        ids = [grams[g] for g in ngrams(w, min(n, len(w)))]
        span = max(1, min(window, len(w)) - min(n, len(w)) + 1)
        for s in range(max(1, len(ids) - span + 1)):
            part = [g for g in ids[s : s + span] if frequency.get(g)]
            if part:
                owners = seeds.setdefault(min(part, key=lambda g: (frequency[g], g)), [])
                if k not in owners:
                    owners.append(k)
    shipped = sc.broadcast((seeds, tests))

    def score(d: object, w: list[str], got: set[int]) -> list[tuple]:
        lead, items = shipped.value
        out = []
        codes: dict[str, int] = {}
        text = None
        for k in sorted({k for g in got for k in lead.get(g, ())}):
            key, item = items[k]
            if text is None:
                text = np.array([codes.setdefault(x, len(codes)) for x in w], np.int32)
            mine = np.array([codes.setdefault(x, len(codes)) for x in item], np.int32)
            # the item's rows against the whole text
            points, equal, a0, a1, b0, b1 = align(mine, text)
            if points >= min_score:
                out.append((d, key, points, equal, longest_run(mine, text)))
        return out

    types = _found_types(kinds)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in scan(score, batches):
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns, types)], schema=types)

    return docs.mapInArrow(pairs, _found_schema(kinds))


def _found_schema(kinds: tuple[str, str]) -> str:
    return f"d {kinds[0]}, i {kinds[1]}, score int, equal_words int, run_words int"


def _found_types(kinds: tuple[str, str]) -> pa.Schema:
    return pa.schema([("d", _arrow(kinds[0])), ("i", _arrow(kinds[1])), ("score", pa.int32()), ("equal_words", pa.int32()), ("run_words", pa.int32())])


def _typed(rows: list[tuple], types: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in _batches(rows):
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns, types)], schema=types)


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [str(i) for i in range(len(rows[0]))])
