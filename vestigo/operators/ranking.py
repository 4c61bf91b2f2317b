"""Ranked lists: fusion, comparison, overlap, merging over datasets, pools."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from vestigo.session import shuffle_width

FUSION_K = 60


#: Estimated bytes of a list up to which one task ranks it.
ONE_TASK_BYTES = 256 << 20
#: Rows that the bounds of a rank's ranges are drawn from, for each range.
BOUND_ROWS = 50


def with_rank(scored: DataFrame, identifier: str, score: str = "score", partition: list[str] | None = None, descending: bool = True, one_task_bytes: int = ONE_TASK_BYTES) -> DataFrame:
    """Rank 1..n by score, then identifier, on scores rounded to 6 places; null scores last.

    A whole list that the optimizer estimates to be large is ranked range by
    range, see ``global_rank``; both ways give the same ranks.
    """
    s = scored.withColumn(score, F.round(score, 6))
    if partition:
        order = [F.desc(score) if descending else F.asc_nulls_last(score), F.asc(identifier)]
        return s.withColumn("rank", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
    value = F.col(score).cast("double")
    return global_rank(s, [value.isNull(), -value if descending else value, F.col(identifier)], one_task_bytes=one_task_bytes)


def global_rank(rows: DataFrame, order: list[Column], ranges: int | None = None, one_task_bytes: int = ONE_TASK_BYTES) -> DataFrame:
    """``rank`` 1..n over all rows by the ascending ``order``, without gathering a large list in one task."""
    return running_total(rows, order, F.lit(1).cast("long"), "rank", ranges, one_task_bytes)


def running_total(rows: DataFrame, order: list[Column], weight: Column, name: str, ranges: int | None = None, one_task_bytes: int = ONE_TASK_BYTES) -> DataFrame:
    """Each row with the sum of ``weight`` over all rows up to it by the ascending ``order``, which must tell all rows apart.

    Bounds come from rows drawn by a hash of the order itself, so they are the
    same whenever they are computed; a row's range is the number of bounds
    before it, ranges are added up, and each starts from those before it.
    Nothing needs to be kept between these steps.
    """
    keyed = rows.withColumn("_key", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    if ranges is None:
        size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        # an unknown size is given as a number beyond any table
        ranges = 1 if size <= one_task_bytes else max(shuffle_width(rows.sparkSession), size // max(1, one_task_bytes) if size < 1 << 55 else 1)
    if ranges <= 1:
        return keyed.withColumn(name, F.sum(weight).over(Window.partitionBy(F.lit(0)).orderBy("_key").rowsBetween(Window.unboundedPreceding, 0))).drop("_key")
    ranges = min(ranges, 10_000)
    drawn = keyed.select("_key", F.xxhash64("_key").alias("_h")).orderBy("_h").limit(ranges * BOUND_ROWS).orderBy("_key").collect()
    kind = keyed.schema["_key"].dataType
    at = sorted({i * len(drawn) // ranges for i in range(1, ranges)}) if drawn else []
    bounds = rows.sparkSession.createDataFrame([([drawn[i][0] for i in at],)], StructType([StructField("_bounds", ArrayType(kind))]))
    placed = keyed.crossJoin(F.broadcast(bounds)).withColumn("_range", F.size(F.filter("_bounds", lambda b: b < F.col("_key")))).drop("_bounds")
    sums = placed.groupBy("_range").agg(F.sum(weight).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sums.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.sum(weight).over(Window.partitionBy("_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("_own", own).join(F.broadcast(starts), "_range").withColumn(name, F.col("_own") + F.col("_start")).drop("_key", "_range", "_own", "_start")


def reciprocal_fusion(lists: list[DataFrame], identifier: str, k: int = FUSION_K) -> DataFrame:
    """(identifier, score): the sum over full ranked lists of 1 / (k + rank)."""
    parts = [r.select(identifier, (F.lit(1.0) / (F.lit(k) + F.col("rank"))).alias("_part")) for r in lists]
    return reduce(DataFrame.unionByName, parts).groupBy(identifier).agg(F.sum("_part").alias("score"))


def merge_datasets(ranked: DataFrame, dataset: str, identifier: str, n: int, k: int = FUSION_K) -> DataFrame:
    """The catalogue's merge: each dataset's own ranks, scored 1 / (k + rank); ties by dataset, then identifier. Equal identifiers of two datasets stay two hits."""
    merged = ranked.withColumn("fused", F.round(F.lit(1.0) / (F.lit(k) + F.col("rank")), 6))
    top = merged.orderBy(F.desc("fused"), dataset, identifier).limit(n)
    w = Window.orderBy(F.desc("fused"), dataset, identifier)
    return top.withColumn("merged_rank", F.row_number().over(w))


def compare_rankings(left: DataFrame, right: DataFrame, identifier: str, cutoffs: tuple[int, ...] = (1, 5, 10, 20)) -> DataFrame:
    """One row per cut-off: shared, left-only, right-only, overlap, Jaccard and the mean rank change of the shared."""
    most = max(cutoffs)
    heads = [d.where(F.col("rank") <= most).select(identifier, F.col("rank").alias(n)) for d, n in ((left, "lr"), (right, "rr"))]
    both = heads[0].join(heads[1], identifier, "full_outer")
    marks = F.explode(F.array(*[F.lit(c) for c in cutoffs])).alias("k")
    inside = both.select("*", marks)
    a, b = F.coalesce(F.col("lr") <= F.col("k"), F.lit(False)), F.coalesce(F.col("rr") <= F.col("k"), F.lit(False))
    n = inside.groupBy("k").agg(
        F.count_if(a & b).alias("shared"),
        F.count_if(a & ~b).alias("left_only"),
        F.count_if(~a & b).alias("right_only"),
        F.round(F.avg(F.when(a & b, F.abs(F.col("lr") - F.col("rr")).cast("double"))), 6).alias("mean_rank_change"),
    )
    return n.withColumns(
        {"overlap": F.round(F.col("shared") / F.col("k"), 6), "jaccard": F.round(F.try_divide(F.col("shared"), F.col("shared") + F.col("left_only") + F.col("right_only")), 6)}
    )


def list_overlap(a: Column, b: Column) -> Column:
    """Shared elements over all elements of two arrays."""
    return F.round(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), 6)


def pool(lists: dict[str, DataFrame], identifier: str) -> DataFrame:
    """(identifier, modes, best_rank): each candidate of several lists once, with where it came from."""
    parts = [r.select(identifier, F.lit(name).alias("mode"), "rank") for name, r in lists.items()]
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy(identifier).agg(F.array_join(F.array_sort(F.collect_set("mode")), ",").alias("modes"), F.min("rank").alias("best_rank"))


def rank_audit(rankings: DataFrame, query: str, item: str) -> DataFrame:
    """Per query: rows, distinct items, listed-twice items, rows without a rank, and whether ranks are 1..n."""
    g = rankings.groupBy(query).agg(
        F.count("*").alias("n_rows"), F.countDistinct(item).alias("items"), F.count_if(F.col("rank").isNull()).alias("no_rank"),
        F.countDistinct("rank").alias("ranks"), F.max("rank").cast("long").alias("top_rank"), F.min("rank").cast("long").alias("low_rank"),
    )
    contiguous = (F.col("no_rank") == 0) & (F.col("low_rank") == 1) & (F.col("top_rank") == F.col("n_rows")) & (F.col("ranks") == F.col("n_rows"))
    return g.select(query, "n_rows", "items", "no_rank", contiguous.alias("contiguous"))
