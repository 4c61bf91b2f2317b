"""Items of varying length into containers of fixed capacity.

Best-fit decreasing: longest pieces first, each into the open container that
it fills most tightly. A segment tree over remaining capacities finds that
container in a logarithmic number of steps. Shards of the corpus are packed
independently; the few containers that a shard leaves half empty are packed
again together, until one shard holds them all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vestigo.session import cut_lineage

CAPACITY = 1024
#: Pieces that one task packs; about 2 MB of sizes and ids.
SHARD_PIECES = 25_000


def regex_token_count(text: Column) -> Column:
    """Tokens of a text: runs of ASCII letters, digits and underscores, and every other code point but blank, tab, LF and CR. Null for null."""
    runs = F.regexp_replace(text, r"[A-Za-z0-9_]+", "w")
    return F.length(F.translate(runs, " \t\n\r", "")).cast("long")


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each piece; sizes are in falling order and at most ``capacity``.

    The tree's leaves are remaining capacities 0..capacity; a node counts the
    open containers below it. The tightest container for a piece is the first
    occupied leaf at or after its size.
    """
    width = 1 << max(1, math.ceil(math.log2(capacity + 1)))
    tree = [0] * (2 * width)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), np.int64)
    opened = 0
    for n, size in enumerate(sizes.tolist()):
        node = width + size
        if not tree[node]:
            # up to the first right sibling that holds a container, then down to its leftmost
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node > 1:
                node += 1
                while node < width:
                    node <<= 1
                    if not tree[node]:
                        node += 1
        if node > 1:
            left = node - width
            box = stacks[left].pop()
            while node:
                tree[node] -= 1
                node >>= 1
        else:
            box, left = opened, capacity
            opened += 1
        out[n] = box
        left -= size
        if left:
            stacks[left].append(box)
            node = width + left
            while node:
                tree[node] += 1
                node >>= 1
    return out


def pieces_of(sizes: DataFrame, identifier: str, tokens: str, capacity: int = CAPACITY) -> DataFrame:
    """(identifier, piece_no, start_token, n_tokens): an item that fits is one piece; only longer ones are split, into full pieces and a rest."""
    n = F.col("_n")
    last = F.greatest(F.ceil(n / F.lit(capacity)).cast("long") - 1, F.lit(0).cast("long"))
    each = sizes.select(F.col(identifier).alias("_id"), F.col(tokens).cast("long").alias("_n")).where("_id is not null and _n > 0")
    each = each.groupBy("_id").agg(F.max("_n").alias("_n"))
    each = each.select("_id", "_n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_p"))
    start = F.col("_p") * capacity
    return each.select(F.col("_id").alias(identifier), F.col("_p").alias("piece_no"), start.alias("start_token"), F.least(n - start, F.lit(capacity)).cast("long").alias("n_tokens"))


def pack(sizes: DataFrame, identifier: str, tokens: str, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(identifier, piece_no, start_token, n_tokens, container) with every container within ``capacity``.

    Repeated rows of an identifier are one item of the largest size given.
    Items with a null identifier, with null or no tokens need no container and
    don't come out. Only items longer than the capacity are split; their full
    pieces have a container each and take no part in the search, so a shard
    never packs more pieces than it has items. Shards are hash shares of the
    identifiers: the result doesn't depend on the layout of the input. Other
    columns aren't read.
    """
    cut = pieces_of(sizes, identifier, tokens, capacity)
    kind = dict(cut.dtypes)[identifier]
    shards = max(1, math.ceil(sizes.count() / shard_pieces))
    if shards > 1:
        cut = cut_lineage(cut)  # sizes are worked out once, for the full pieces and for the others
    whole = cut.where(F.col("n_tokens") == capacity).withColumn("container", F.concat_ws("-", F.lit("f"), F.col(identifier).cast("string"), "piece_no"))
    named = cut.where(F.col("n_tokens") < capacity).select(
        F.pmod(F.xxhash64(F.col(identifier).cast("string")), F.lit(shards)).alias("shard"), F.col(identifier).alias("id"), "piece_no", "start_token", "n_tokens"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        t = t.sort_by([("n_tokens", "descending"), ("id", "ascending"), ("piece_no", "ascending")])
        box = best_fit(t.column("n_tokens").to_numpy(), capacity)
        fill = np.bincount(box, weights=t.column("n_tokens").to_numpy(), minlength=1).astype(np.int64)
        t = t.append_column("box", pa.array(box)).append_column("fill", pa.array(fill[box]))
        yield from t.to_batches(max_chunksize=50_000)

    fields = f"shard long, id {kind}, piece_no long, start_token long, n_tokens long"
    packed = named.groupBy("shard").applyInArrow(work, f"{fields}, box long, fill long")
    if shards == 1:
        full = packed.select("*", F.concat_ws("-", "shard", "box").alias("container"))
    else:
        packed = cut_lineage(packed)  # what is packed again depends on the whole result, which is kept for both
        # best fit leaves at most one container per shard that is no more than half full
        loose = F.col("fill") * 2 <= capacity
        rest = packed.where(loose).select(F.concat_ws("-", "shard", "box").alias("key"), "fill").distinct()
        again = pack(rest, "key", "fill", capacity, shard_pieces).select("key", F.concat(F.lit("r"), "container").alias("again"))
        full = packed.withColumn("key", F.concat_ws("-", "shard", "box")).join(F.broadcast(again) if shards <= 100_000 else again, "key", "left")
        full = full.withColumn("container", F.coalesce("again", "key"))
    return full.select(F.col("id").alias(identifier), "piece_no", "start_token", "n_tokens", "container").unionByName(whole)


def oversize(sizes: DataFrame, identifier: str, tokens: str, capacity: int = CAPACITY) -> DataFrame:
    """Identifiers of the items that no container can hold whole."""
    return sizes.where(F.col(tokens) > capacity).select(identifier)
