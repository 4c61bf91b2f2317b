"""Relevance measures over ranked lists, hard negatives, intervals, gates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUTOFFS = (5, 10, 20)


def _gain(grade: Column) -> Column:
    return F.pow(F.lit(2.0), grade.cast("double")) - 1.0


def _discount(rank: Column) -> Column:
    return F.log2(rank.cast("double") + 1.0)


def retrieval_metrics(ranking: DataFrame, judgements: DataFrame, query: str, item: str, relevant: int = 1, cutoffs: tuple[int, ...] = CUTOFFS) -> DataFrame:
    """Per query of ``judgements``: nDCG and recall at each cut-off, and the reciprocal rank of the first relevant item.

    ``ranking``: (query, item, rank); ``judgements``: (query, item, grade).
    Gain 2^grade - 1, discount log2(rank + 1). Unjudged items have grade 0; a
    query without a ranking scores 0; one without any relevant item has null
    recall.
    """
    top = ranking.where(F.col("rank") <= max(cutoffs)).select(query, item, "rank")
    judged = top.join(judgements.select(query, item, "grade"), [query, item], "left").withColumn("grade", F.coalesce("grade", F.lit(0)))
    ideal = judgements.where("grade > 0").withColumn("_r", F.row_number().over(Window.partitionBy(query).orderBy(F.desc("grade"), item)))
    got = judged.groupBy(query).agg(
        *[F.sum(F.when(F.col("rank") <= k, _gain(F.col("grade")) / _discount(F.col("rank"))).otherwise(0.0)).alias(f"dcg{k}") for k in cutoffs],
        *[F.count_if((F.col("rank") <= k) & (F.col("grade") >= relevant)).alias(f"hit{k}") for k in cutoffs],
        F.min(F.when(F.col("grade") >= relevant, F.col("rank"))).alias("first"),
    )
    best = ideal.groupBy(query).agg(
        *[F.sum(F.when(F.col("_r") <= k, _gain(F.col("grade")) / _discount(F.col("_r"))).otherwise(0.0)).alias(f"ideal{k}") for k in cutoffs],
        F.count_if(F.col("grade") >= relevant).alias("relevant"),
    )
    rows = judgements.select(query).distinct().join(got, query, "left").join(best, query, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.select(
        query,
        *[F.round(F.coalesce(F.try_divide(zero(f"dcg{k}").cast("double"), F.col(f"ideal{k}")), F.lit(0.0)), 6).alias(f"ndcg_{k}") for k in cutoffs],
        *[F.round(F.try_divide(zero(f"hit{k}").cast("double"), F.col("relevant").cast("double")), 6).alias(f"recall_{k}") for k in cutoffs],
        F.round(F.coalesce(F.lit(1.0) / F.col("first"), F.lit(0.0)), 6).alias("reciprocal_rank"),
    )


def first_of_group(ranking: DataFrame, query: str, group: str) -> DataFrame:
    """The ranking with ``first_hit``: only the best-ranked item of each evidence group counts; a null group is a group of its own item."""
    w = Window.partitionBy(query, group).orderBy("rank")
    return ranking.withColumn("first_hit", F.col(group).isNull() | (F.row_number().over(w) == 1))


def grouped_judgements(ranking: DataFrame, judgements: DataFrame, query: str, item: str, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranking and judgements for group-wise measures: later items of a group get grade 0, and the ideal list holds one best item per group.

    ``groups``: (item, group). Feed both to ``retrieval_metrics``.
    """
    r = first_of_group(ranking.join(groups, item, "left"), query, "group")
    kept = r.where("first_hit").select(query, item, "rank")
    tagged = judgements.join(groups, item, "left")
    w = Window.partitionBy(query, F.coalesce(F.col("group"), F.col(item).cast("string"))).orderBy(F.desc("grade"), item)
    one = tagged.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    # the kept item stands for its group, with the group's best grade
    stand = kept.join(groups, item, "left").select(query, F.col(item).alias("_kept"), F.coalesce(F.col("group"), F.col(item).cast("string")).alias("_g"))
    moved = one.withColumn("_g", F.coalesce(F.col("group"), F.col(item).cast("string"))).join(stand, [query, "_g"], "left")
    return kept, moved.select(query, F.coalesce("_kept", item).alias(item), "grade")


def hard_negatives(ranking: DataFrame, triplets: DataFrame, query: str, positive: str, negative: str, item: str) -> DataFrame:
    """Over triplets: coverage (both ranked), accuracy (positive first) and the median score margin of the covered."""
    side = lambda who: ranking.select(query, F.col(item).alias(who), F.col("rank").alias(f"_r_{who}"), F.col("score").alias(f"_s_{who}"))
    rows = triplets.join(side(positive), [query, positive], "left").join(side(negative), [query, negative], "left")
    both = F.col(f"_r_{positive}").isNotNull() & F.col(f"_r_{negative}").isNotNull()
    margin = F.when(both, F.col(f"_s_{positive}") - F.col(f"_s_{negative}"))
    return rows.agg(
        F.count("*").alias("triplets"), F.count_if(both).alias("covered"), F.count_if(both & (F.col(f"_r_{positive}") < F.col(f"_r_{negative}"))).alias("ordered"), F.round(F.percentile(margin, 0.5), 6).alias("median_margin")
    )


def macro(rows: DataFrame, levels: list[str], value: str) -> DataFrame:
    """Mean of means: from the innermost level of ``levels`` outwards; one row."""
    at = rows
    for k in range(len(levels), 0, -1):
        at = at.groupBy(*levels[:k]).agg(F.avg(value).alias(value))
    return at.agg(F.round(F.avg(value), 6).alias(value), F.count("*").alias("groups"))


def bootstrap(rows: DataFrame, cluster: str, value: str, rounds: int = 1000, seed: int = 7, share: float = 0.95) -> DataFrame:
    """(mean, low, high): percentile interval of the mean under resampling of clusters.

    A cluster counts by its number of rows and its sum; these sums, one pair
    per cluster of an evaluation suite, are resampled in numpy.
    """
    cells = rows.where(F.col(value).isNotNull()).groupBy(cluster).agg(F.sum(value).alias("s"), F.count("*").alias("n"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).sort_by([("c", "ascending")])
        s, n = t.column("s").to_numpy().astype(float), t.column("n").to_numpy().astype(float)
        rng = np.random.default_rng(seed)
        means = np.empty(rounds)
        for i in range(rounds):
            pick = rng.integers(0, len(s), len(s))
            means[i] = s[pick].sum() / n[pick].sum()
        low, high = np.quantile(means, [(1 - share) / 2, (1 + share) / 2])
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (s.sum() / n.sum(), low, high, len(s))], ["mean", "low", "high", "clusters"])

    one = cells.select(F.lit(1).alias("g"), F.col(cluster).cast("string").alias("c"), F.col("s").cast("double").alias("s"), "n")
    return one.groupBy("g").applyInArrow(draw, "mean double, low double, high double, clusters long")


def paired_deltas(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(key, delta) where both sides have a value."""
    a, b = left.select(key, F.col(value).alias("_a")), right.select(key, F.col(value).alias("_b"))
    return a.join(b, key).where("_a is not null and _b is not null").select(key, F.round(F.col("_b") - F.col("_a"), 6).alias("delta"))


def paired_bootstrap(left: DataFrame, right: DataFrame, key: str, value: str, cluster: str, rounds: int = 1000, seed: int = 7, share: float = 0.95) -> DataFrame:
    """(mean, low, high, clusters) of right minus left over the keys that both have, resampled by cluster."""
    a, b = left.select(key, cluster, F.col(value).alias("_a")), right.select(key, F.col(value).alias("_b"))
    both = a.join(b, key).where("_a is not null and _b is not null").withColumn("_d", F.col("_b") - F.col("_a"))
    return bootstrap(both, cluster, "_d", rounds, seed, share)


def gates(values: DataFrame, limits: dict[str, float]) -> DataFrame:
    """(gate, value, threshold, passed) for columns of a one-row frame that must reach their thresholds; null fails."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("gate"), F.col(k).cast("double").alias("value"), F.lit(float(t)).alias("threshold")) for k, t in limits.items()]))
    return values.select(each.alias("_g")).select("_g.*").withColumn("passed", F.coalesce(F.col("value") >= F.col("threshold"), F.lit(False)))
