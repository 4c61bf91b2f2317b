"""Diagnostics of an embedding: isolation, confusion, centroids, weightings, outliers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vestigo.operators.dense import constant, dot
from vestigo.operators.ranking import running_total


def mean_vector(vectors: DataFrame, vector: str) -> tuple[int, np.ndarray | None]:
    """Count and mean vector; each split adds its vectors up, so one array per split travels."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b in batches:
            x = b.column(0).drop_null()
            if len(x):
                m = x.flatten().to_numpy().astype(np.float64).reshape(len(x), -1)
                total = m.sum(axis=0) if total is None else total + m.sum(axis=0)
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.float64()))], ["n", "s"])

    got = vectors.select(vector).mapInArrow(add, "n long, s array<double>").collect()  # one row per split
    n = sum(r[0] for r in got)
    return n, (np.sum([r[1] for r in got], axis=0) / n if n else None)


def centroid_distances(vectors: DataFrame, identifier: str, vector: str) -> DataFrame:
    """(identifier, distance): 1 - cosine to the normalised mean of unit vectors."""
    n, mean = mean_vector(vectors, vector)
    if not n:
        return vectors.select(identifier, F.lit(None).cast("double").alias("distance")).limit(0)
    mean = mean / max(float(np.linalg.norm(mean)), 1e-300)
    return vectors.where(F.col(vector).isNotNull()).select(identifier, F.round(1 - dot(F.col(vector), constant(mean.tolist())), 6).alias("distance"))


def robust_isolation(rows: DataFrame, group: str, identifier: str, value: str) -> DataFrame:
    """0.6745 (x - median) / MAD within each group; null, with status 'zero_mad', where the MAD is 0."""
    median = rows.groupBy(group).agg(F.percentile(value, 0.5).alias("median"))
    off = rows.join(median, group).withColumn("_d", F.abs(F.col(value) - F.col("median")))
    mad = off.groupBy(group).agg(F.percentile("_d", 0.5).alias("mad"))
    z = F.when(F.col("mad") > 0, F.lit(0.6745) * (F.col(value) - F.col("median")) / F.col("mad"))
    return off.join(mad, group).select(group, identifier, F.round(value, 6).alias(value), F.round(z, 4).alias("isolation"), F.when(F.col("mad") > 0, "scored").otherwise("zero_mad").alias("status"))


def relation_summary(neighbours: DataFrame, identifier: str, k: int) -> DataFrame:
    """(label, documents, effective_k, mean, median, p90 and p99 isolation, reciprocal rate) from each one's k nearest of its own label.

    Isolation is the mean distance to the neighbours; a link is reciprocal if
    the neighbour has it too.
    """
    links = neighbours.select("label", F.col(identifier).alias("_a"), F.col("neighbour").alias("_b"), (1 - F.col("similarity")).alias("_d"))
    back = links.select(F.col("_a").alias("_b"), F.col("_b").alias("_a"), F.lit(1).alias("_back"))
    each = links.join(back, ["_a", "_b"], "left").groupBy("label", "_a").agg(F.avg("_d").alias("_i"), F.count("_back").alias("_r"), F.count("*").alias("_k"))
    stats = {"mean_isolation": F.avg("_i"), "median_isolation": F.percentile("_i", 0.5), "p90_isolation": F.percentile("_i", 0.9), "p99_isolation": F.percentile("_i", 0.99), "reciprocal_rate": F.avg(F.col("_r") / F.col("_k"))}
    return each.groupBy("label").agg(F.count("*").alias("documents"), F.max("_k").alias("effective_k"), *[F.round(c, 6).alias(n) for n, c in stats.items()])


def confusion(neighbours: DataFrame) -> DataFrame:
    """(label, neighbour_label, n, share) over nearest neighbours."""
    cells = neighbours.groupBy("label", "neighbour_label").agg(F.count("*").alias("n"))
    return cells.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("label")), 6))


def weighted_means(rows: DataFrame, group: str, value: str, weights: dict[str, str]) -> DataFrame:
    """The weighted mean under every weighting, per group and over all (``scope``), in one pass with GROUPING SETS."""
    named = ", ".join(f"round(sum({value} * ({w})) / sum({w}), 6) AS {name}" for name, w in weights.items())
    view = rows.sparkSession
    return view.sql(
        f"SELECT coalesce({group}, -1) AS {group}, CASE WHEN grouping({group}) = 1 THEN 'all' ELSE 'group' END AS scope, count(*) AS n, {named} FROM {{rows}} GROUP BY GROUPING SETS (({group}), ())",
        rows=rows,
    )


def average_rank_percentile(rows: DataFrame, identifier: str, value: str) -> DataFrame:
    """Average rank among ties, as a percentage of n; ranks come from counted distinct values."""
    v = F.round(F.col(value), 6)
    cells = rows.where(F.col(value).isNotNull()).groupBy(v.alias("_v")).agg(F.count("*").alias("_c"))
    run = running_total(cells, [F.col("_v")], F.col("_c"), "_to").crossJoin(F.broadcast(cells.agg(F.sum("_c").alias("_n"))))  # one row
    share = (F.col("_to") - (F.col("_c") - 1) / 2) / F.col("_n") * 100
    return rows.select(identifier, v.alias("_v")).join(run, "_v").select(identifier, F.round(share, 6).alias("percentile"))


def local_outlier_factor(neighbours: DataFrame, identifier: str) -> DataFrame:
    """LOF from a table of k nearest neighbours (identifier, neighbour, similarity, rank); distance is 1 - similarity."""
    d = F.greatest(1 - F.col("similarity"), F.lit(1e-12))
    rows = neighbours.select(F.col(identifier).alias("a"), F.col("neighbour").alias("b"), d.alias("d"))
    reach_of = rows.groupBy(F.col("a").alias("b")).agg(F.max("d").alias("kd"))
    density = rows.join(reach_of, "b").groupBy("a").agg((1 / F.avg(F.greatest("d", "kd"))).alias("lrd"))
    other = density.select(F.col("a").alias("b"), F.col("lrd").alias("lrd_b"))
    return rows.join(other, "b").groupBy("a").agg(F.avg("lrd_b").alias("m")).join(density, "a").select(F.col("a").alias(identifier), F.round(F.col("m") / F.col("lrd"), 4).alias("lof"))


def principal_components(vectors: DataFrame, identifier: str, vector: str, components: int = 2) -> DataFrame:
    """(identifier, pc1, pc2, ...): projections on the leading components; each component's largest loading is positive.

    Splits add up second moments (d x d numbers each); only these reach the driver.
    """
    n, mean = mean_vector(vectors, vector)
    if not n:
        return vectors.select(identifier).limit(0)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = b.column(0).drop_null()
            if len(x):
                m = x.flatten().to_numpy().astype(np.float64).reshape(len(x), -1) - mean
                total = m.T @ m if total is None else total + m.T @ m
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["s"])

    got = vectors.select(vector).mapInArrow(moments, "s array<double>").collect()
    second = np.sum([r[0] for r in got], axis=0).reshape(len(mean), -1)
    _, axes = np.linalg.eigh(second)
    axes = axes[:, ::-1][:, :components]
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    shift = mean @ axes
    cols = [F.round(dot(F.col(vector), constant(axes[:, i].tolist())) - float(shift[i]), 6).alias(f"pc{i + 1}") for i in range(axes.shape[1])]
    return vectors.where(F.col(vector).isNotNull()).select(identifier, *cols)
