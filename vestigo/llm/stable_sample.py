"""A sample that reruns, layouts and growth don't change.

Consistent weighted Poisson sampling: an identifier's hash, read as a number
in [0, 1), is held against weight x constant. The weight that counts is the
largest one seen so far, so with later deliveries the threshold of an
identifier can only rise and no chosen record is ever lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashes are the first 13 hex digits (52 bits) of SHA-256.
HASH_SPAN = 1 << 52


def hash_point(identifier: Column, seed: str) -> Column:
    """52 uniform bits of an identifier, as a long; the same on every engine with SHA-256."""
    text = F.concat(F.lit(seed), F.lit(":"), identifier.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def stable_sample(
    rows: DataFrame,
    identifier: str,
    constant: float,
    weight: Column | str | None = None,
    order: str | None = None,
    seed: str = "s1",
) -> DataFrame:
    """(identifier, weight, first_order, deliveries) of the chosen records.

    ``constant`` is the inclusion probability of weight 1; it must not change
    while the data grow. A record is chosen if its hash is below
    running-maximum weight x constant, so its probability is min(1, weight x
    constant). Several rows of an identifier are one record. ``weight`` (1 if
    not given) may differ between deliveries; null, negative and NaN weights
    count as 0. ``order`` is a delivery number; ``first_order`` is the first
    delivery by which the record was chosen (null if none is given).
    ``deliveries`` counts the rows that alone suffice to choose it.

    Rows that don't suffice are dropped before the shuffle: a record's maximum
    suffices if and only if one of its rows does, so only the sample moves.
    Null identifiers don't take part. Extra columns aren't read.
    """
    w = F.lit(1.0) if weight is None else (F.col(weight) if isinstance(weight, str) else weight).cast("double")
    o = F.lit(None).cast("int") if order is None else F.col(order)
    slim = rows.select(F.col(identifier).alias("_id"), w.alias("_w"), o.alias("_o")).where("_id is not null")
    usable = F.when(F.col("_w").isNull() | F.isnan("_w") | (F.col("_w") < 0), F.lit(0.0)).otherwise(F.col("_w"))
    limit = F.least(usable * F.lit(float(constant) * HASH_SPAN), F.lit(float(HASH_SPAN)))
    chosen = slim.withColumn("_w", usable).where(hash_point(F.col("_id"), seed) < limit)
    return chosen.groupBy(F.col("_id").alias(identifier)).agg(
        F.max("_w").alias("weight"), F.min("_o").alias("first_order"), F.count("*").alias("deliveries")
    )


def merge_weights(state: DataFrame, delivery: DataFrame, identifier: str, weight: str = "weight") -> DataFrame:
    """The stored running-maximum weights after one more delivery.

    Both frames hold (identifier, weight). Null identifiers and null weights
    don't take part; the result has one row per identifier.
    """
    both = state.select(identifier, weight).unionByName(delivery.select(identifier, weight))
    return both.where(F.col(identifier).isNotNull() & F.col(weight).isNotNull()).groupBy(identifier).agg(F.max(weight).alias(weight))
