"""The N best items of every group, with a fixed order among equal scores.

Hot-cold split: exact counts find the groups that hold many rows. Their items
are cut into salted score ranges; other groups have one range and one salt. One
pass over the table ranks both: a window per range keeps its N best, which
Spark limits to N rows before the shuffle, and a last window joins the ranges
of the hot groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A group with more rows than this is hot.
HOT_ITEMS = 500
#: Score ranges of a hot group, and salts within a range (equal scores can fill one range).
RANGES, SALTS = 16, 8
#: Bound on hot groups, hence on what is broadcast: the threshold rises with the input so that no more can exist.
MAX_HOT = 10_000


def costs(rows: DataFrame, group: str, item: str, score: str, low_is_better: str) -> DataFrame:
    """(_g, _i, _c): group, item and a cost of which small is good; ``low_is_better`` is an SQL predicate. Rows with a null in any of the three are left out."""
    cost = F.when(F.expr(low_is_better), F.col(score)).otherwise(-F.col(score))
    slim = rows.select(F.col(group).alias("_g"), F.col(item).alias("_i"), cost.alias("_c"))
    return slim.where("_g is not null and _i is not null and _c is not null")


def best_per_item(cost_rows: DataFrame) -> DataFrame:
    """One row per (_g, _i) with its best cost. Grouping by the pair pre-aggregates in each split and can't be skewed by a large group."""
    return cost_rows.groupBy("_g", "_i").agg(F.min("_c").alias("_c"))


def top_items(
    rows: DataFrame,
    group: str,
    item: str,
    score: str,
    n: int = 10,
    low_is_better: str = "true",
    hot_items: int = HOT_ITEMS,
) -> DataFrame:
    """(group, item, cost, position): the ``n`` best items of each group.

    An item listed more than once for a group counts once, with its best
    score; ``cost`` is that score, negated where high is better. Among equal
    scores the smaller item (byte order) comes first. Groups with fewer than
    ``n`` items come out whole. Null groups, items and scores don't take part;
    an empty input gives an empty result. Other columns of ``rows``, whatever
    their names, aren't read.
    """
    slim = costs(rows, group, item, score, low_is_better)

    def ranked(df: DataFrame, *keys: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy("_c", "_i")
        return df.withColumn("_r", F.row_number().over(w)).where(f"_r <= {int(n)}")

    # exact counts; at most total / bound <= MAX_HOT groups are hot, each with RANGES - 1 cut points
    counts = slim.groupBy("_g").agg(F.count("*").alias("_n"))
    bound = counts.agg(F.greatest(F.lit(hot_items), F.floor(F.sum("_n") / MAX_HOT)).alias("_bound"))
    hot = counts.join(F.broadcast(bound), F.col("_n") > F.col("_bound")).select("_g")
    cuts = slim.join(F.broadcast(hot), "_g", "left_semi").groupBy("_g").agg(F.percentile_approx("_c", [k / RANGES for k in range(1, RANGES)], 1000).alias("_cuts"))
    placed = best_per_item(slim).join(F.broadcast(cuts), "_g", "left").select(
        "_g", "_i", "_c",
        F.coalesce(F.size(F.filter("_cuts", lambda x: x < F.col("_c"))), F.lit(0)).alias("_range"),
        F.when(F.col("_cuts").isNull(), 0).otherwise(F.pmod(F.xxhash64("_i"), F.lit(SALTS))).alias("_salt"),
    )
    out = ranked(ranked(placed, "_g", "_range", "_salt").select("_g", "_i", "_c"), "_g")
    return out.select(F.col("_g").alias(group), F.col("_i").alias(item), F.col("_c").alias("cost"), F.col("_r").alias("position"))
