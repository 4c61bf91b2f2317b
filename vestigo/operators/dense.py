"""Exact dense search and vector measures, JVM-side for one query, in numpy blocks for many."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Vectors in a block of an exact search.
BLOCK_ROWS = 1_024


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def constant(vector: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])


def distance_millionths(similarity: Column) -> Column:
    """Cosine distance in millionths, rounded half to even, within 0..2,000,000."""
    return F.least(F.greatest(F.rint((F.lit(1.0) - similarity) * 1e6), F.lit(0.0)), F.lit(2e6)).cast("long")


def score_against(vectors: DataFrame, query: list[float], identifier: str, vector: str, exclude: list | None = None) -> DataFrame:
    """(identifier, score): every vector's dot product with one query; excluded identifiers are removed before any ranking."""
    rows = vectors if not exclude else vectors.where(~F.col(identifier).isin(exclude))
    return rows.select(identifier, dot(F.col(vector), constant(query)).alias("score"))


def vector_of(vectors: DataFrame, key: object, identifier: str, vector: str) -> list[float]:
    """The vector of one identifier; an error if it is missing."""
    got = vectors.where(F.col(identifier) == key).select(vector).take(1)
    if not got:
        raise KeyError(f"no vector for {key}")
    return list(got[0][0])


def query_vector(vectors: DataFrame, surface: dict[str, object], vector: str) -> list[float]:
    """The one vector stored under a request's full surface (its text, mode, limit and so on); none or several are an error."""
    rows = vectors
    for k, v in surface.items():
        rows = rows.where(F.col(k).eqNullSafe(F.lit(v)))
    got = rows.select(vector).take(2)
    if len(got) != 1:
        raise KeyError(f"{'no' if not got else 'more than one'} stored vector for this request")
    return list(got[0][0])


def norm_audit(vectors: DataFrame, vector: str, tolerance: float = 1e-4) -> DataFrame:
    n = norm(F.col(vector))
    return vectors.agg(
        F.count("*").alias("n_vectors"), F.count_if(F.abs(n - 1) > tolerance).alias("off_norm"), F.round(F.min(n), 6).alias("min_norm"), F.round(F.max(n), 6).alias("max_norm")
    )


def prefix_unit(vector: Column, dimensions: int) -> Column:
    """The first components of a vector, brought back to length 1, as floats."""
    head = F.slice(vector, 1, dimensions)
    return F.transform(head, lambda x: (x.cast("double") / norm(head)).cast("float"))


def duplicate_vectors(vectors: DataFrame, vector: str) -> DataFrame:
    """(copies, groups): how many vectors stand how often; by a hash of the vector, so only hashes are shuffled."""
    return vectors.where(F.col(vector).isNotNull()).groupBy(F.xxhash64(vector).alias("_h")).agg(F.count("*").alias("copies")).groupBy("copies").agg(F.count("*").alias("groups"))


def exact_neighbours(
    vectors: DataFrame, identifier: str, vector: str, label: str | None, k: int, scope: str = "all", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(identifier, label, neighbour, neighbour_label, similarity, rank): exact k nearest others of every vector.

    ``scope``: 'all', only vectors of the 'same' label, or only of 'other'
    labels. Vectors are cut into hash blocks, within each label for 'same';
    every pair of blocks is one product in a task of its own, which keeps k
    candidates per vector. Null vectors and labels don't take part; equal
    similarities go by identifier. Work is quadratic in a label, or in all:
    meant for labelled evaluation sets.
    """
    lab = F.col(label) if label else F.lit(0)
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(identifier).alias("i"), lab.alias("l"), F.col(vector).alias("v")).where("l is not null")
    kinds = dict(rows.dtypes)
    out_schema = f"{identifier} {kinds['i']}, label {kinds['l']}, neighbour {kinds['i']}, neighbour_label {kinds['l']}, similarity double"
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(block_rows))).cast("int")
    if scope == "same":
        sized = rows.join(rows.groupBy("l").agg(F.count("*").alias("_n")), "l").withColumn("g", F.col("l").cast("string"))
    else:
        sized = rows.crossJoin(F.broadcast(rows.agg(F.count("*").alias("_n")))).withColumn("g", F.lit(""))  # one row
    held = sized.select("g", "i", "l", "v", blocks.alias("b")).withColumn("own", F.pmod(F.xxhash64("i"), "b").cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("b") - 1))
    asks = held.select("g", F.col("own").alias("x"), others.alias("y"), F.lit(True).alias("asks"), "i", "l", "v")
    gives = held.select("g", others.alias("x"), F.col("own").alias("y"), F.lit(False).alias("asks"), "i", "l", "v")

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).sort_by("i")
        asked = t.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        sides = []
        for side in (asked, ~asked):
            p = t.filter(pa.array(side))
            sides.append((np.array(p.column("i").to_pylist(), object), p.column("l").to_numpy(zero_copy_only=False), p.column("v").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(p.num_rows, -1)))
        (qi, ql, q), (ti, tl, m) = sides
        for lo in range(0, len(qi) if len(ti) else 0, 256):
            s = np.round(q[lo : lo + 256] @ m.T, 9)
            same = ql[lo : lo + 256, None] == tl[None, :]
            s[qi[lo : lo + 256, None] == ti[None, :]] = -np.inf
            if scope == "other":
                s[same] = -np.inf
            order = np.argsort(-s, axis=1, kind="stable")[:, :k]
            got = np.take_along_axis(s, order, 1)
            row, col = np.nonzero(np.isfinite(got))
            if not len(row):
                continue
            at = order[row, col]
            yield pa.RecordBatch.from_arrays([pa.array(list(qi[lo + row])), pa.array(ql[lo + row]), pa.array(list(ti[at])), pa.array(tl[at]), pa.array(got[row, col])], [identifier, "label", "neighbour", "neighbour_label", "similarity"])

    found = asks.unionByName(gives).groupBy("g", "x", "y").applyInArrow(product, out_schema)
    rank = F.row_number().over(Window.partitionBy(identifier).orderBy(F.desc("similarity"), "neighbour"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)
