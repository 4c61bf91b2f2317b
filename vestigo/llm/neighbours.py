"""The most similar vectors of every vector.

Vectors are spread over territory shards of bounded size (nearest of a few
trained centroids; crowded territories are split, and what can't be split is
cut into hash parts); every shard builds one small-world graph and searches it
for its own vectors and for the queries whose answers may lie in it; the
shards' answers are merged. Only routed copies of vectors move, as 16-bit
fixed-point numbers, and no task sees more than one shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vestigo.llm import hnsw
from vestigo.session import cut_lineage

#: Vectors of a shard. Beyond MAX_TERRITORIES shards grow up to MAX_HOME, and beyond that territories are cut into parts that are all asked.
HOME, MAX_HOME, MAX_TERRITORIES = 4_096, 65_536, 2_048
#: Vectors that the territories are trained on, for each territory; every vector is indexed.
TRAINING_PER_TERRITORY, TRAINING_LEAST = 64, 4_096
KMEANS_ROUNDS = 10
#: A territory with more than this times the mean share of the training vectors is split.
CROWDED = 1.5
#: Queries from elsewhere that one copy of a shard answers, in shard sizes; with more of them the shard has several copies.
ASKED = 8
#: Shards asked per query at most, the beam, links of a node, and the beam of its insertion: in general, and where only very similar vectors count, which stand out in a graph.
OPEN_PROBES, OPEN_BEAM, OPEN_WIDTH, OPEN_INSERT = 40, 192, 24, 32
NEAR_PROBES, NEAR_BEAM, NEAR_WIDTH, NEAR_INSERT, NEAR_SIMILARITY = 10, 16, 24, 20, 0.85
#: With a least similarity, territories this many standard deviations away aren't asked.
NEAR_DEVIATIONS = 2.0


def usable(vector: Column, dimensions: int) -> Column:
    """Not null, of the right length, all components finite and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def train_centroids(x: np.ndarray, shards: int, rounds: int = KMEANS_ROUNDS) -> np.ndarray:
    """Unit centroids by spherical k-means over unit vectors; the same for the same input."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), min(shards, len(x)), replace=False)].copy()
    for _ in range(rounds):
        home = np.argmax(x @ c.T, axis=1)
        order = np.argsort(home, kind="stable")
        held, first = np.unique(home[order], return_index=True)
        total = x[rng.choice(len(x), len(c))]  # of centroids that lost all their vectors
        total[held] = np.add.reduceat(x[order], first, axis=0)
        c = total / np.maximum(np.linalg.norm(total, axis=1), 1e-12)[:, None]
    return c.astype(np.float32)


@dataclass
class Map:
    """Territories, how many parts and copies each has, and how far from a home centroid others are asked."""

    centroids: np.ndarray
    parts: np.ndarray
    copies: np.ndarray
    first: np.ndarray
    reach: np.ndarray | None
    probes: int
    shards: int

    def near(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector: territories, home first and then by falling similarity, and which of them are asked."""
        s = x @ self.centroids.T
        to = np.argsort(-s, axis=1, kind="stable")[:, : self.probes]
        asked = np.ones(to.shape, bool)
        if self.reach is not None:
            got = np.take_along_axis(s, to, 1)
            asked = got[:, :1] - got <= self.reach[to[:, :1], to]
        return to, asked


def draw_map(sample: np.ndarray, asks: np.ndarray, n: int, min_similarity: float = -1.0, home: int = HOME, probes: int = OPEN_PROBES) -> Map:
    """Territories for ``n`` vectors, from a sample of distinct unit vectors, of which ``asks`` are queries.

    A vector y of similarity s to x is s x + sqrt(1 - s^2) u with a unit vector
    u across x. How much u favours another centroid over the home centroid has
    about the deviation |difference| / sqrt(effective dimensions), so with a
    least similarity only territories within a few deviations are asked.
    """
    size = int(min(MAX_HOME, max(home, n / MAX_TERRITORIES)))
    wanted = max(1, min(MAX_TERRITORIES, round(n / size), len(sample)))
    c = train_centroids(sample, wanted)
    while wanted > 1:
        at = np.argmax(sample @ c.T, axis=1)
        share = np.bincount(at, minlength=len(c)) / len(sample)
        crowded = np.flatnonzero((share > CROWDED / wanted) & (share * len(sample) >= 4))
        if not len(crowded) or len(c) >= 2 * MAX_TERRITORIES:
            break
        halves = [train_centroids(sample[at == t], 2) for t in crowded]
        c = np.concatenate([np.delete(c, crowded, axis=0), *halves])
    s = sample @ c.T
    at = np.argmax(s, axis=1)
    expected = np.bincount(at, minlength=len(c)) / max(1, len(sample)) * n
    parts = np.maximum(1, np.ceil(expected / (2 * MAX_HOME if size == MAX_HOME else 4 * size))).astype(np.int64)
    near = min_similarity >= NEAR_SIMILARITY
    reach = None
    if near:
        spread = np.linalg.eigvalsh(np.cov(sample.T)) if len(sample) > 1 else np.ones(1)
        effective = max(1.0, float(spread.sum() ** 2 / max(1e-12, (spread**2).sum())))
        apart = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))
        reach = NEAR_DEVIATIONS * math.sqrt(1 - min_similarity**2) / min_similarity * apart / math.sqrt(effective)
    m = Map(c, parts, np.ones(len(c), np.int64), np.zeros(len(c), np.int64), reach, min(len(c), NEAR_PROBES if near else probes), 0)
    to, asked = m.near(sample)
    load = np.bincount(to[:, 1:][asked[:, 1:] & asks[:, None]], minlength=len(c)) / max(1, len(sample)) * n
    m.copies = np.maximum(1, np.ceil(load / (ASKED * size))).astype(np.int64)
    m.first = np.cumsum(m.parts * m.copies) - m.parts * m.copies
    m.shards = int((m.parts * m.copies).sum())
    return m


def _unit(column: pa.Array, dimensions: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    flat /= np.abs(flat).max(axis=1, keepdims=True)
    return (flat / np.linalg.norm(flat, axis=1, keepdims=True)).astype(np.float32)


def _encode(x: np.ndarray) -> pa.Array:
    """Each unit vector as a scale and 16-bit steps; dot products keep an error of about 1e-6."""
    scale = (np.abs(x).max(axis=1, keepdims=True, initial=0) / 32767).astype(np.float32)
    steps = np.rint(x / scale).astype(np.int16)
    raw = np.concatenate([scale.view(np.uint8), steps.view(np.uint8).reshape(len(x), -1)], axis=1)
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(raw.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))])


def _decode(column: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 4 + 2 * dimensions)
    x = np.ascontiguousarray(raw[:, 4:]).view(np.int16).astype(np.float32) * np.ascontiguousarray(raw[:, :4]).view(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def nearest_keys(keyed: DataFrame, dimensions: int, n: int, k: int, min_similarity: float, home: int = HOME, probes: int = OPEN_PROBES) -> DataFrame:
    """(a1, a2, b1, b2, similarity): for every distinct query vector the k most similar other distinct vectors found.

    ``keyed`` has k1, k2 (two hashes of the vector), q (is it a query) and v
    (usable vectors). Equal vectors are one node and one query.
    """
    empty = "a1 long, a2 int, b1 long, b2 int, similarity float"
    training = max(TRAINING_LEAST, TRAINING_PER_TERRITORY * min(MAX_TERRITORIES, math.ceil(n / home)))
    share = min(1.0, training / max(1, n))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A split's vectors, each once: a vector that a third of all rows share reaches the driver at most once per split."""
        seen: set[int] = set()
        for b in batches:
            new = [i for i, k in enumerate(b.column(0).to_pylist()) if not (k in seen or seen.add(k))]
            if new:
                yield b.take(pa.array(new))

    # the smallest of uniform hashes: copies of a drawn vector can't crowd out others, whatever the number of splits
    drawn = keyed.where(F.pmod(F.col("k1"), F.lit(1_000_003)) < int(share * 1_000_003) + 1).select("k1", "v", "q")
    picked = drawn.mapInArrow(once, drawn.schema).toArrow().sort_by("k1")
    first = np.diff(picked.column("k1").to_numpy(), prepend=np.iinfo(np.int64).min) != 0 if picked.num_rows else []
    picked = picked.filter(pa.array(first, pa.bool_()))
    if not picked.num_rows:
        return keyed.sparkSession.createDataFrame([], empty)
    asks = picked.column("q").to_numpy(zero_copy_only=False).astype(bool)
    plan = draw_map(_unit(picked.column("v").combine_chunks(), dimensions), asks, n, min_similarity, home, probes)
    beam, width, insert = (NEAR_BEAM, NEAR_WIDTH, NEAR_INSERT) if plan.reach is not None else (OPEN_BEAM, OPEN_WIDTH, OPEN_INSERT)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            k1, k2, q = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            # a vector that stands in the batch more than once is sent once; as a query if any of its rows is one
            order = np.lexsort((~q, k2, k1))
            k1, k2, q = k1[order], k2[order], q[order]
            first = np.ones(len(k1), bool)
            first[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            x = _unit(b.column(3).take(pa.array(order[first])), dimensions)
            k1, k2, q = k1[first], k2[first], q[first]
            to, asked = plan.near(x)
            mine = (k2.astype(np.int64) & 0x7FFFFFFF, (k1 >> 8) & 0x7FFFFFFF)
            rows, shard, home_ = [], [], []
            t = to[:, 0]
            part = mine[0] % plan.parts[t]
            copy = mine[1] % plan.copies[t]
            for c in range(int(plan.copies[t].max())):  # every copy of its shard holds a vector, one of them answers it
                r = np.flatnonzero(plan.copies[t] > c)
                rows.append(r), shard.append(plan.first[t[r]] + part[r] * plan.copies[t[r]] + c), home_.append(np.where(copy[r] == c, 1, 2))
            r, c = np.nonzero(asked & q[:, None])
            t = to[r, c]
            for p in range(int(plan.parts[t].max()) if len(t) else 0):
                keep = (plan.parts[t] > p) & ((c > 0) | (part[r] != p))
                rows.append(r[keep]), home_.append(np.zeros(int(keep.sum()), np.int64))
                shard.append(plan.first[t[keep]] + p * plan.copies[t[keep]] + mine[1][r[keep]] % plan.copies[t[keep]])
            row = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(shard), pa.int32()), pa.array(np.concatenate(home_), pa.int8()), pa.array(q[row]), pa.array(k1[row]), pa.array(k2[row], pa.int32()), _encode(x[row])],
                ["shard", "home", "q", "k1", "k2", "v"],
            )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One shard: home 1 is a vector of the shard that is answered here, 2 one that is answered in another copy, 0 a query from elsewhere."""
        t = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if t is None:
            return
        inside = pa.compute.greater(t.column("home"), 0)
        t = t.append_column("inside", inside).sort_by([("inside", "descending"), ("k1", "ascending"), ("k2", "ascending"), ("home", "ascending"), ("q", "descending")])
        inside, home, q, k1, k2 = (t.column(c).to_numpy() for c in ("inside", "home", "q", "k1", "k2"))
        first = np.ones(len(k1), bool)
        first[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (inside[1:] != inside[:-1])
        t = t.filter(pa.array(first))
        inside, home, q, k1, k2 = inside[first], home[first], q[first], k1[first], k2[first]
        x = _decode(t.column("v"), dimensions)
        own = int(inside.sum())
        if not own:
            return
        graph = hnsw.build(x[:own], ((k2[:own].astype(np.int64) & 0xFFFFFFFF) + 0.5) / 2.0**32, insert, width)
        node = np.empty(own, np.int64)
        node[graph.order] = np.arange(own)
        mine, asked = np.flatnonzero(q[:own] & (home[:own] == 1)), np.flatnonzero(~inside)
        for who, start in ((mine, node[mine]), (asked, None)):
            ids, sims = hnsw.search(graph, x[who], k + 1, beam, start)
            a = np.repeat(who, ids.shape[1])
            b, s = ids.ravel(), sims.ravel()
            keep = (b >= 0) & (s >= min_similarity)
            a, b, s = a[keep], b[keep], s[keep]
            keep = (k1[a] != k1[b]) | (k2[a] != k2[b])
            a, b, s = a[keep], b[keep], s[keep]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (k1[a], k2[a], k1[b], k2[b], s)], ["a1", "a2", "b1", "b2", "similarity"])

    routed = keyed.select("k1", "k2", "q", "v").mapInArrow(route, "shard int, home byte, q boolean, k1 long, k2 int, v binary")
    # one shard a task; a vector lies in one shard and its copies, and a query asks one copy, so no pair comes out twice
    found = routed.repartitionById(plan.shards, F.col("shard")).mapInArrow(solve, empty)
    rank = F.row_number().over(Window.partitionBy("a1", "a2").orderBy(F.desc("similarity"), "b1", "b2"))
    return found.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def most_similar(
    vectors: DataFrame,
    identifier: str = "document_id",
    vector: str = "vector",
    dimensions: int = 96,
    k: int = 10,
    min_similarity: float = -1.0,
    queries: Column | None = None,
    home: int = HOME,
    probes: int = OPEN_PROBES,
) -> DataFrame:
    """(identifier_a, identifier_b, similarity, position): the k most similar others of every query row's identifier.

    Cosine similarity over usable vectors (see ``usable``); at equal
    similarity the smaller identifier comes first. ``queries`` says which rows
    are queries, all if not given; every usable row can be an answer. Pairs
    below ``min_similarity`` are left out, which doesn't change the positions
    of the others. ``home`` is the wanted size of a shard, ``probes`` how many
    shards a query asks where no high ``min_similarity`` tells which matter.
    Repeated rows count once; rows with a null identifier don't. Identifiers with the same vector are one node of the graph, so a
    vector that a third of all rows share costs what one row costs.
    """
    v = F.col(vector)
    flag = F.lit(True) if queries is None else F.coalesce(queries, F.lit(False))
    keyed = vectors.where(F.col(identifier).isNotNull() & usable(v, dimensions)).select(
        F.xxhash64(v).alias("k1"), F.hash(v).alias("k2"), flag.alias("q"), F.col(identifier).alias("id"), v.alias("v")
    )
    near = nearest_keys(keyed.select("k1", "k2", "q", "v"), dimensions, vectors.count(), k, min_similarity, home, probes)
    members = keyed.groupBy("k1", "k2", "id").agg(F.max("q").alias("q"))
    # only the first k + 1 identifiers of equal vectors can be among anyone's k best
    lead = members.withColumn("_r", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("id"))).where(F.col("_r") <= k + 1).select("k1", "k2", F.col("id").alias("other"))
    copies = members.where("q").join(lead, ["k1", "k2"]).select("id", "other", F.lit(1.0).cast("float").alias("similarity"))
    asks = members.where("q").select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), "id")
    gives = lead.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), "other")
    pairs = near.join(gives, ["b1", "b2"]).join(asks, ["a1", "a2"]).select("id", "other", "similarity")
    each = copies.unionByName(pairs).where("id != other").groupBy("id", "other").agg(F.max("similarity").alias("similarity"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other"))
    return each.withColumn("position", rank).where(F.col("position") <= k).select(
        F.col("id").alias(f"{identifier}_a"), F.col("other").alias(f"{identifier}_b"), "similarity", "position"
    )


def mutual_pairs(found: DataFrame, identifier: str = "document_id") -> DataFrame:
    """Each pair of ``most_similar`` once, the smaller identifier first."""
    a, b = F.col(f"{identifier}_a"), F.col(f"{identifier}_b")
    return found.select(F.least(a, b).alias(f"{identifier}_a"), F.greatest(a, b).alias(f"{identifier}_b")).distinct()


def recall(found: DataFrame, vectors: DataFrame, identifier: str = "document_id", vector: str = "vector", dimensions: int = 96, k: int = 10, queries: int = 500) -> DataFrame:
    """(queries, neighbours, hits, recall) of ``most_similar`` results against brute force, for ``queries`` of the asked identifiers drawn by hash.

    A neighbour is a hit if it is as similar as the true k-th one, but for the
    rounding of the fixed-point copies. The drawn vectors, a bounded set, go
    past all rows; each split keeps k candidates per query.
    """
    a, b = f"{identifier}_a", f"{identifier}_b"
    found = cut_lineage(found)  # read twice, searched once
    v = F.col(vector)
    rows = vectors.where(F.col(identifier).isNotNull() & usable(v, dimensions)).select(F.col(identifier).alias("id"), v.alias("v"))
    drawn = found.select(F.col(a).alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(queries)
    first = rows.join(F.broadcast(drawn), "id").groupBy("id").agg(F.min("v").alias("v")).orderBy("id").toArrow()
    names = first.column("id").to_pylist()
    asked = _unit(first.column("v").combine_chunks(), dimensions) if names else np.zeros((0, dimensions), np.float32)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if names else ():
            if not batch.num_rows:
                continue
            s = asked @ _unit(batch.column(1), dimensions).T
            ids = np.array(batch.column(0).to_pylist(), object)
            s[np.array(names, object)[:, None] == ids[None, :]] = -2
            keep = min(4 * k, s.shape[1])  # rows of an identifier may repeat
            top = np.argpartition(-s, keep - 1, axis=1)[:, :keep]
            q = np.repeat(np.arange(len(names)), keep)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(names, object)[q].tolist()), pa.array(ids[top.ravel()].tolist()), pa.array(np.take_along_axis(s, top, 1).ravel(), pa.float32())], ["a", "b", "s"])

    kind = dict(rows.dtypes)["id"]
    true = rows.mapInArrow(scan, f"a {kind}, b {kind}, s float").where("s > -2").groupBy("a", "b").agg(F.max("s").alias("s"))
    ranked = true.withColumn("_r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))).where(F.col("_r") <= k)
    bound = ranked.groupBy("a").agg(F.min("s").alias("bound"), F.count("*").alias("n"))
    got = found.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col("similarity").alias("s")).join(F.broadcast(drawn.withColumnRenamed("id", "a")), "a")
    each = bound.join(got, "a", "left").groupBy("a", "n").agg(F.least(F.col("n"), F.count_if(F.col("s") >= F.col("bound") - 1e-4)).alias("hits"))
    return each.agg(F.count("*").alias("queries"), F.sum("n").alias("neighbours"), F.sum("hits").alias("hits")).withColumn("recall", F.round(F.col("hits") / F.col("neighbours"), 4))
