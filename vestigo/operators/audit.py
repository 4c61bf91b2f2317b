"""Closure checks: what should match, what doesn't, and how often."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys of ``left`` that ``right`` lacks."""
    return left.where(F.col(key).isNotNull()).select(key).distinct().join(right.select(key), key, "left_anti")


def closure(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(matched, left_only, right_only) over distinct keys; presence marks are summed, so no side has to be hashed whole."""
    both = left.select(key, F.lit(1).alias("_s")).unionByName(right.select(key, F.lit(2).alias("_s"))).where(F.col(key).isNotNull())
    seen = both.groupBy(key).agg(F.bit_or("_s").alias("_s"))
    return seen.agg(F.count_if(F.col("_s") == 3).alias("matched"), F.count_if(F.col("_s") == 1).alias("left_only"), F.count_if(F.col("_s") == 2).alias("right_only"))


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of keys that stand more than once."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def dangling(tables: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """(reference, dangling): for each named foreign key the number of distinct values without a target."""
    parts = [orphans(a, b, k).agg(F.lit(name).alias("reference"), F.count("*").alias("dangling")) for name, (a, b, k) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def set_sizes(left: DataFrame, right: DataFrame) -> DataFrame:
    """(shared, left_only, right_only) of two one-column sets, by INTERSECT and EXCEPT."""
    count = lambda d, n: d.agg(F.count("*").alias(n))
    return count(left.intersect(right), "shared").crossJoin(count(left.subtract(right), "left_only")).crossJoin(count(right.subtract(left), "right_only"))


def payload_conflicts(rows: DataFrame, key: str, payload: list[str]) -> DataFrame:
    """(keys, repeated, conflicting): keys listed again, and those whose payloads then differ; equal payloads are found by hash."""
    g = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"), F.min(F.xxhash64(*payload)).alias("_a"), F.max(F.xxhash64(*payload)).alias("_b"))
    return g.agg(F.count("*").alias("keys"), F.count_if(F.col("_n") > 1).alias("repeated"), F.count_if(F.col("_a") != F.col("_b")).alias("conflicting"))


def exact_cover(wanted: DataFrame, made: DataFrame, key: str) -> DataFrame:
    """(missing, extra, repeated): keys that were to be made once and weren't, that nobody wanted, and that were made more than once."""
    both = wanted.select(key, F.lit(1).alias("_w"), F.lit(0).alias("_m")).unionByName(made.select(key, F.lit(0).alias("_w"), F.lit(1).alias("_m"))).where(F.col(key).isNotNull())
    n = both.groupBy(key).agg(F.max("_w").alias("_w"), F.sum("_m").alias("_m"))
    return n.agg(
        F.count_if((F.col("_w") == 1) & (F.col("_m") == 0)).alias("missing"), F.count_if((F.col("_w") == 0) & (F.col("_m") > 0)).alias("extra"), F.count_if(F.col("_m") > 1).alias("repeated")
    )


def shared_owners(rows: DataFrame, owned: str, owner: str, allowed: list[str] = ()) -> DataFrame:
    """(owned, owners): what more than one owner holds and isn't allowed to be shared."""
    g = rows.where(F.col(owned).isNotNull()).select(owned, owner).distinct().groupBy(owned).agg(F.count("*").alias("owners")).where("owners > 1")
    return g.where(~F.col(owned).isin(list(allowed))) if allowed else g


def resolved_ends(relationships: DataFrame, entities: DataFrame, source: str = "source_entity_id", target: str = "target_entity_id", key: str = "entity_id") -> DataFrame:
    """Each relationship with the kinds of both its ends; an end without an entity has a null kind and is said to dangle."""
    ends = [entities.select(F.col(key).alias(c), F.col("kind").alias(f"{n}_kind")) for c, n in ((source, "source"), (target, "target"))]
    both = relationships.join(ends[0], source, "left").join(ends[1], target, "left")
    lost = (F.col(source).isNotNull() & F.col("source_kind").isNull()) | (F.col(target).isNotNull() & F.col("target_kind").isNull())
    return both.withColumn("dangling", lost)


def row_point(*columns: str) -> Column:
    """52 uniform bits of a row's values; null and the empty text differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.conv(F.substring(F.sha2(F.concat_ws("\x00", *parts), 256), 1, 13), 16, 10).cast("decimal(38,0)")


def receipts(rows: DataFrame, by: Column, columns: list[str]) -> DataFrame:
    """(part, n_rows, content): what each part of a snapshot holds, whatever its files and order; ``content`` adds up the rows' hashes."""
    return rows.groupBy(by.alias("part")).agg(F.count("*").alias("n_rows"), F.sum(row_point(*columns)).cast("string").alias("content"))


def admission(found: DataFrame, expected: DataFrame) -> DataFrame:
    """(part, problem) where two receipts differ; an empty result admits the snapshot."""
    a, b = (d.select("part", F.struct("n_rows", "content").alias(n)) for d, n in ((found, "_a"), (expected, "_b")))
    both = a.join(b, a["part"].eqNullSafe(b["part"]), "full_outer").select(F.coalesce(a["part"], b["part"]).alias("part"), "_a", "_b")
    problem = (
        F.when(F.col("_b").isNull(), "not expected").when(F.col("_a").isNull(), "missing")
        .when(F.col("_a.n_rows") != F.col("_b.n_rows"), "row count differs").when(F.col("_a.content") != F.col("_b.content"), "content differs")
    )
    return both.select("part", problem.alias("problem")).where("problem is not null")
