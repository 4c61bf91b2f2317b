"""Deterministic samples, strata, quotas, and run statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vestigo.operators.ranking import global_rank, running_total


#: Items of a chunk that one task cuts into ranges.
CHUNK_ITEMS = 200_000


def priority(seed: str, *parts: Column) -> Column:
    """SHA-256 of the seed and the parts, NUL-separated; small comes first."""
    return F.sha2(F.concat_ws("\x00", F.lit(seed), *[p.cast("string") for p in parts]), 256)


def hash_min(rows: DataFrame, group: str, identifier: str, most: int, seed: str = "sample") -> DataFrame:
    """The ``most`` rows of smallest priority in each group; a limited window keeps no more than that per split."""
    r = rows.withColumn("priority", priority(seed, F.col(identifier)))
    w = Window.partitionBy(group).orderBy("priority", identifier)
    return r.withColumn("position", F.row_number().over(w)).where(F.col("position") <= most)


def min_k(rows: DataFrame, identifier: str, k: int, seed: str = "sample") -> DataFrame:
    """The ``k`` rows of smallest priority of all, with their ``ordinal`` 1..k; each split passes on k rows at most. Null identifiers don't take part."""
    few = rows.where(F.col(identifier).isNotNull()).withColumn("_p", priority(seed, F.col(identifier))).orderBy("_p", identifier).limit(k)
    return few.withColumn("ordinal", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_p", identifier))).drop("_p")


def largest_remainder(counts: dict[str, int], total: int) -> dict[str, int]:
    """Quotas in proportion to counts: floors, at least 1 each, the rest by largest remainder, then name; never above a count."""
    counts = {k: n for k, n in counts.items() if n > 0}
    whole = sum(counts.values())
    total = min(total, whole)
    if not counts:
        return {}
    exact = {k: total * n / whole for k, n in counts.items()}
    quota = {k: min(n, max(1, math.floor(exact[k]))) for k, n in counts.items()}
    order = sorted(counts, key=lambda k: (-(exact[k] - math.floor(exact[k])), k))
    while (gap := total - sum(quota.values())) != 0:
        step = 1 if gap > 0 else -1
        can = [k for k in (order if gap > 0 else reversed(order)) if (quota[k] < counts[k] if step > 0 else quota[k] > 1)]
        if not can:
            break
        for k in can[: abs(gap)]:
            quota[k] += step
    return quota


def stratified(rows: DataFrame, strata: str, identifier: str, total: int, seed: str = "pilot") -> DataFrame:
    """A proportional sample: quotas by largest remainder over the strata (a small set of labels), rows by priority."""
    counts = {r[0]: r[1] for r in rows.where(F.col(strata).isNotNull()).groupBy(strata).count().collect()}  # one row per stratum
    quota = largest_remainder(counts, total)
    if not quota:
        return rows.limit(0).withColumn("position", F.lit(0))
    book = rows.sparkSession.createDataFrame(sorted(quota.items()), f"{strata} string, quota int")
    return hash_min(rows, strata, identifier, max(quota.values()), seed).join(F.broadcast(book), strata).where("position <= quota").drop("quota", "priority")


def nested_sizes(rows: DataFrame, strata: list[str], identifier: str, sizes: list[int], seed: str = "nested") -> DataFrame:
    """(identifier, stratum keys, level): each row's smallest sample size that holds it; smaller samples lie within larger ones.

    Strata are filled in turn: the first row of each stratum, then the second
    of each, and so on, so every prefix of this order is a sample of its own.
    """
    r = rows.withColumn("_p", priority(seed, F.col(identifier)))
    turn = r.withColumn("_turn", F.row_number().over(Window.partitionBy(*strata).orderBy("_p", identifier))).where(F.col("_turn") <= max(sizes))
    place = F.row_number().over(Window.orderBy("_turn", *strata))
    few = turn.orderBy("_turn", *strata).limit(max(sizes)).withColumn("_place", place)
    level: Column = F.lit(None).cast("int")
    for s in sorted(sizes, reverse=True):
        level = F.when(F.col("_place") <= s, s).otherwise(level)
    return few.select(identifier, *strata, level.alias("level"))


def percentiles_nearest(rows: DataFrame, value: str, shares: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99), by: list[str] | None = None) -> DataFrame:
    """n, total, min, nearest-rank percentiles (value at rank ceil(p n)) and max.

    Values are counted before they are ranked, so the window runs over distinct
    values only.
    """
    by = by or []
    cells = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*(by or [F.lit(0)]))
    run = cells.withColumns({"_run": F.sum("_c").over(w.orderBy("_v")), "_n": F.sum("_c").over(w)})
    picks = [F.min(F.when(F.col("_run") >= F.ceil(F.lit(p) * F.col("_n")), F.col("_v"))).alias(f"p{round(p * 100)}") for p in shares]
    return run.groupBy(*by).agg(F.sum("_c").alias("n"), F.sum(F.col("_v") * F.col("_c")).alias("total"), F.min("_v").alias("low"), *picks, F.max("_v").alias("high"))


def percentile_floor(rows: DataFrame, value: str, shares: tuple[float, ...]) -> list:
    """Values at the places floor((n - 1) p) of the sorted values; from a counted table on the cluster, a few numbers come back."""
    cells = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    run = running_total(cells, [F.col("_v")], F.col("_c"), "_run").crossJoin(F.broadcast(cells.agg(F.sum("_c").alias("_n"))))  # one row
    got = run.agg(*[F.min(F.when(F.col("_run") > F.floor((F.col("_n") - 1) * F.lit(p)), F.col("_v"))) for p in shares]).first()
    return list(got)


def length_strata(rows: DataFrame, value: str, shares: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """Each row with ``stratum`` 0..len(shares)+1: by percentile bounds, the maximum in a stratum of its own."""
    bounds = percentile_floor(rows, value, (*shares, 1.0))
    if bounds[-1] is None:
        return rows.withColumn("stratum", F.lit(None).cast("int"))
    stratum = F.when(F.col(value) == bounds[-1], len(shares) + 1)
    for i, b in enumerate(bounds[:-1]):
        stratum = stratum.when(F.col(value) <= b, i)
    return rows.withColumn("stratum", F.when(F.col(value).isNotNull(), stratum.otherwise(len(shares))))


def length_buckets(rows: DataFrame, tokens: str, edges: tuple[int, ...] = (128, 256, 512, 1024)) -> DataFrame:
    """(bucket, items, tokens) in fixed token ranges."""
    label: Column = F.lit(f">{edges[-1]}")
    for low, high in reversed(list(zip((0, *edges), edges))):
        label = F.when(F.col(tokens) <= high, f"{low + 1}-{high}" if low else f"0-{high}").otherwise(label)
    return rows.where(F.col(tokens).isNotNull()).groupBy(label.alias("bucket")).agg(F.count("*").alias("items"), F.sum(tokens).alias("tokens"))


def _chain(before: np.ndarray, at: int, max_tokens: int, max_items: int) -> list[int]:
    """Starts of the greedy tasks from item ``at`` on; ``before`` are the running sums, with a leading 0."""
    n, starts = len(before) - 1, []
    while at < n:
        starts.append(at)
        at = max(at + 1, min(at + max_items, int(np.searchsorted(before, before[at] + max_tokens, "right")) - 1))
    return starts


def greedy_ranges(rows: DataFrame, order: str, tokens: str, max_tokens: int, max_items: int, chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """(task, first, last, items, tokens): consecutive items, in order, until a task would pass either limit; an item above the limit is a task of its own.

    Null orders don't take part, null sizes count 0, equal orders follow each
    other by size. Where a task ends depends on everything before it, but of a
    chunk of items only on how many of its first ones the task before it still
    takes: at most ``max_items``, and no more than fit ``max_tokens``. So each
    chunk works out what it would leave over for every such number, these few
    numbers are chained up, and then all chunks are cut at once.
    """
    kind = dict(rows.dtypes)[order]
    slim = rows.select(F.col(order).alias("k"), F.coalesce(F.col(tokens), F.lit(0)).cast("long").alias("n")).where("k is not null")
    size = max(chunk_items, 2 * max_items)
    placed = global_rank(slim, [F.col("k"), F.col("n")]).withColumn("chunk", F.floor((F.col("rank") - 1) / F.lit(size)).cast("long"))
    many = slim.count() > size

    def sums(t: pa.Table) -> tuple[pa.Table, np.ndarray]:
        t = t.sort_by("rank")
        return t, np.concatenate([[0], np.cumsum(t.column("n").to_numpy())])

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each number of items already taken: tasks begun, and the items and tokens of the last one; with the sum of these first items."""
        t, before = sums(pa.Table.from_batches(list(batches)))
        out = []
        for taken in range(min(max_items, len(before) - 1) + 1):
            if before[taken] > max_tokens and taken:
                break
            starts = _chain(before, taken, max_tokens, max_items)
            last = starts[-1] if starts else None
            out.append((t.column("chunk")[0].as_py(), taken, int(before[taken]), len(starts), len(before) - 1 - last if starts else 0, int(before[-1] - before[last]) if starts else 0))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["chunk", "taken", "sum", "begun", "items", "tokens"])

    entry: dict[int, tuple[int, int]] = {}
    if many:
        left: dict[int, dict[int, tuple]] = {}
        found = placed.groupBy("chunk").applyInArrow(summary, "chunk long, taken long, sum long, begun long, items long, tokens long")
        for r in found.collect():  # max_items + 1 rows per chunk at most
            left.setdefault(r.chunk, {})[r.taken] = (r["sum"], r.begun, r["items"], r.tokens)
        task, items, held = 0, 0, 0
        for chunk in sorted(left):
            taken = max((k for k, v in left[chunk].items() if task and items + k <= max_items and held + v[0] <= max_tokens), default=0)
            entry[chunk] = (taken, task)
            first, begun, last_items, last_tokens = left[chunk][taken]
            task += begun
            items, held = (last_items, last_tokens) if begun else (items + taken, held + first)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, before = sums(pa.Table.from_batches(list(batches)))
        taken, task = entry.get(t.column("chunk")[0].as_py(), (0, 0))
        starts = np.array(([0] if taken else []) + _chain(before, taken, max_tokens, max_items), np.int64)
        ends = np.append(starts[1:], len(before) - 1)
        number = np.arange(len(starts)) + task - (1 if taken else 0)
        keys = t.column("k")
        yield pa.RecordBatch.from_arrays(
            [pa.array(number), keys.take(pa.array(starts)).combine_chunks(), keys.take(pa.array(ends - 1)).combine_chunks(), pa.array(ends - starts), pa.array(before[ends] - before[starts])], ["task", "first", "last", "items", "tokens"]
        )

    parts = placed.groupBy("chunk").applyInArrow(cut, f"task long, first {kind}, last {kind}, items long, tokens long")
    if not many:
        return parts
    # a task that runs across the end of a chunk has a part in each
    return parts.groupBy("task").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("items").alias("items"), F.sum("tokens").alias("tokens"))


def dense_ordinals(rows: DataFrame, key: str) -> DataFrame:
    """Each distinct key with its place 0..n-1 in key order, by ``ranking.global_rank``."""
    keys = rows.where(F.col(key).isNotNull()).select(key).distinct()
    return global_rank(keys, [F.col(key)]).select(key, (F.col("rank") - 1).cast("long").alias("ordinal"))


def round_robin(capacity: dict[tuple[str, int], int], total: int) -> dict[tuple[str, int], int]:
    """Quotas per (relation, stratum): in each pass every relation gives one to its least filled stratum that has room."""
    quota = {k: 0 for k in capacity}
    relations = sorted({r for r, _ in capacity})
    left = total
    while left > 0:
        before = left
        for r in relations:
            open_cells = [(quota[c], c[1], c) for c in capacity if c[0] == r and quota[c] < capacity[c]]
            if open_cells and left:
                quota[min(open_cells)[2]] += 1
                left -= 1
        if left == before:
            break
    return quota


def nearest_rank(values: list[float], share: float) -> float | None:
    ordered = np.sort(np.asarray(values, float))
    return float(ordered[math.ceil(share * len(ordered)) - 1]) if len(ordered) else None


def pilot(rows: DataFrame, relation: str, identifier: str, census: int = 1000, sample: int = 2000, seed: str = "pilot") -> DataFrame:
    """Small relations whole, of others the ``sample`` rows of smallest priority."""
    sizes = rows.where(F.col(relation).isNotNull()).groupBy(relation).agg(F.count("*").alias("_n"))
    kept = hash_min(rows, relation, identifier, max(census, sample), seed)
    return kept.join(sizes, relation).where((F.col("_n") <= census) | (F.col("position") <= sample)).drop("_n", "priority")
