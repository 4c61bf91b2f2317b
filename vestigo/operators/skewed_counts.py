"""Per-key counts and ledger comparisons when a few keys hold most records.

Keys are dictionary-encoded, every input split adds its rows into dense numpy
accumulators, and blocks of these arrays are summed by a distributed
reduction. No task ever works on "one key": splits are equal shares of the
input, blocks are hash shares of the member space, so a key that holds a third
of all rows costs each task the same as any other key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestigo.session import shuffle_width

#: Keys that the driver encodes for all splits. Of more keys every split keeps dictionaries of its own, of this many keys at a time.
DICTIONARY_KEYS = 100_000
#: Bytes of ledger rows in a block, before they are counted.
BLOCK_BYTES = 64 << 20
#: Partial counts of one member that are held before they are added up.
HELD_ROWS = 100_000


def key_dictionary(keys: DataFrame, limit: int = DICTIONARY_KEYS) -> list[str] | None:
    """Sorted distinct keys of a one-column frame, or None when there are more than ``limit``.

    Distinct is pre-aggregated in each split; the driver gets at most limit + 1 keys.
    """
    name = keys.columns[0]
    got = [r[0] for r in keys.where(F.col(name).isNotNull()).distinct().limit(limit + 1).collect()]
    return None if len(got) > limit else sorted(got)


def dense_key_counts(rows: DataFrame, key: str, measures: list[str] | None = None, dictionary: list[str] | None = None, limit: int = DICTIONARY_KEYS) -> DataFrame:
    """(key, n_rows, one sum per integer measure) with one ``bincount`` per input split.

    Rows with a null key form no group. Null measures add 0. Each split emits
    one row per key it holds, so the final sum moves splits x keys numbers at
    most, whatever the skew. Columns of other names are left out of the scan.
    ``dictionary``: the sorted distinct keys, where they are known already.
    With more than ``limit`` keys each split encodes the keys it meets, and
    hands over its arrays whenever it has met that many.
    """
    measures = measures or []
    slim = rows.select(F.col(key).alias("k"), *[F.col(m).cast("long").alias(f"m{i}") for i, m in enumerate(measures)])
    words = dictionary or key_dictionary(slim.select("k"), limit)
    sums = [F.sum(f"m{i}").alias(m) for i, m in enumerate(measures)]
    names = [f"m{i}" for i in range(len(measures))]
    schema = "n long" + "".join(f", {m} long" for m in names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per key of a split: (code or key, rows, sums)."""
        fixed = None if words is None else pa.array(words, pa.string())
        book: dict[str, int] = {}
        acc = np.zeros((1 + len(measures), len(words) if words is not None else limit), np.int64)

        def arrays() -> pa.RecordBatch:
            held = np.flatnonzero(acc[0])
            shown = pa.array(held, pa.int32()) if fixed is not None else pa.array(list(book), pa.string()).take(pa.array(held))
            return pa.RecordBatch.from_arrays([shown, *[pa.array(a[held]) for a in acc]], ["k", "n", *names])

        for b in batches:
            if fixed is not None:
                code = pc.index_in(b.column(0), value_set=fixed)
                at = code.fill_null(-1).to_numpy(zero_copy_only=False)
            else:
                local = b.column(0).dictionary_encode()
                if len(book) + len(local.dictionary) > acc.shape[1]:
                    yield arrays()
                    book.clear()
                    acc = np.zeros((len(acc), max(limit, len(local.dictionary))), np.int64)
                place = np.array([book.setdefault(w, len(book)) for w in local.dictionary.to_pylist()] + [-1], np.int64)
                at = place[local.indices.fill_null(len(place) - 1).to_numpy(zero_copy_only=False)]
            keep = at >= 0
            acc[0] += np.bincount(at[keep], minlength=acc.shape[1])
            for i in range(len(measures)):
                v = b.column(1 + i).fill_null(0).to_numpy(zero_copy_only=False)[keep]
                np.add.at(acc[1 + i], at[keep], v)
        yield arrays()

    if words is None:
        return slim.mapInArrow(add, f"k string, {schema}").groupBy(F.col("k").alias(key)).agg(F.sum("n").alias("n_rows"), *sums)
    total = slim.mapInArrow(add, f"k int, {schema}").groupBy("k").agg(F.sum("n").alias("n_rows"), *sums)
    return _with_words(total, words, key).select(key, "n_rows", *measures)


def _with_words(coded: DataFrame, words: list[str], key: str) -> DataFrame:
    """The key of each code ``k``; the dictionary has at most DICTIONARY_KEYS entries."""
    if 0 < len(words) <= 200:
        return coded.withColumn(key, F.element_at(F.array(*[F.lit(w) for w in words]), F.col("k") + 1))
    book = coded.sparkSession.createDataFrame(pd.DataFrame({"k": np.arange(len(words), dtype="int32"), key: pd.Series(words, dtype="object")}), f"k int, {key} string")
    return coded.join(F.broadcast(book), "k")


def ledger_cells(left: DataFrame, right: DataFrame, key: str, member: str, blocks: int | None = None, dictionary: list[str] | None = None, limit: int = DICTIONARY_KEYS) -> DataFrame:
    """Every distinct (key, member) of two ledgers with its row counts (n_left, n_right).

    Rows with a null key or a null member are ignored. Step 1, in each input
    split: keys become dictionary codes and equal (code, member) rows are
    counted by ``bincount``. Step 2: members are spread over hash blocks, as
    many as the ledgers' size asks for. Step 3, in each block: the rows come
    sorted by the member's hash and are taken batch by batch; members get local
    dictionary codes and the partial counts are scatter-added into one dense
    array per ledger. Only a batch and the last member's rows are held.
    """
    sides = [d.select(F.col(key).alias("k"), F.col(member).cast("string").alias("m"), F.lit(i).alias("side")) for i, d in enumerate((left, right))]
    rows = sides[0].unionByName(sides[1]).where("k is not null and m is not null")
    words = dictionary or key_dictionary(rows.select("k"), limit)
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # an unknown size is given as a number beyond any table
    blocks = blocks or max(shuffle_width(rows.sparkSession), size // BLOCK_BYTES if size < 1 << 55 else 0)
    coded = words is not None and len(words) > 0

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = pa.array(words, pa.string()) if coded else None
        for b in batches:
            if not b.num_rows:
                continue
            if coded:
                code = pc.index_in(b.column(0), value_set=book).to_numpy(zero_copy_only=False).astype(np.int64)
                local = None
            else:
                enc = b.column(0).dictionary_encode()
                code, local = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), enc.dictionary
            member_enc = b.column(1).dictionary_encode()
            mem = member_enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            side = b.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            span = len(member_enc.dictionary)
            cell, at = np.unique((code * span + mem) * 2 + side, return_inverse=True)
            n = np.bincount(at, minlength=len(cell))
            pair = cell // 2
            keys = pa.array(pair // span, pa.int32()) if coded else local.take(pa.array(pair // span))
            yield pa.RecordBatch.from_arrays([keys, member_enc.dictionary.take(pa.array(pair % span)), pa.array(cell % 2, pa.int8()), pa.array(n, pa.int64())], ["k", "m", "side", "n"])

    kind = "int" if coded else "string"
    parts = rows.mapInArrow(partial, f"k {kind}, m string, side byte, n long").withColumn("h", F.xxhash64("m"))
    sorted_parts = parts.repartition(blocks, "h").sortWithinPartitions("h")

    def add_up(t: pa.Table) -> pa.RecordBatch:
        keys, members = t.column("k").combine_chunks().dictionary_encode(), t.column("m").combine_chunks().dictionary_encode()
        span = len(members.dictionary)
        pair = keys.indices.to_numpy(zero_copy_only=False).astype(np.int64) * span + members.indices.to_numpy(zero_copy_only=False)
        cells, at = np.unique(pair, return_inverse=True)
        acc = np.zeros((2, len(cells)), np.int64)
        np.add.at(acc, (t.column("side").to_numpy(), at), t.column("n").to_numpy())
        return pa.RecordBatch.from_arrays([keys.dictionary.take(pa.array(cells // span)), members.dictionary.take(pa.array(cells % span)), pa.array(acc[0]), pa.array(acc[1])], ["k", "m", "n_left", "n_right"])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.RecordBatch] = []  # rows of the last hash, which may go on
        limit = HELD_ROWS
        for b in batches:
            if not b.num_rows:
                continue
            h = b.column(4).to_numpy()
            if open_ and open_[-1].column(4)[-1].as_py() != h[0]:
                yield add_up(pa.Table.from_batches(open_))
                open_ = []
            cut = int(np.searchsorted(h, h[-1]))
            if cut:
                yield add_up(pa.Table.from_batches([*open_, b.slice(0, cut)]))
                open_ = []
            open_.append(b.slice(cut))
            if sum(x.num_rows for x in open_) > limit:  # one member with very many partial counts
                t = add_up(pa.Table.from_batches(open_))
                n = t.num_rows
                again = [pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(np.full(n, i), pa.int8()), t.column(2 + i), pa.array(np.full(n, h[-1]))], schema=b.schema) for i in (0, 1)]
                open_, limit = again, max(HELD_ROWS, 4 * n)
        if open_:
            yield add_up(pa.Table.from_batches(open_))

    cells = sorted_parts.mapInArrow(reduce, f"k {kind}, m string, n_left long, n_right long").withColumnRenamed("m", member)
    if coded:
        return _with_words(cells, words, key).select(key, member, "n_left", "n_right")
    return cells.select(F.col("k").alias(key), member, "n_left", "n_right")


def one_sided(left: DataFrame, right: DataFrame, key: str, member: str) -> DataFrame:
    """(key, member) that stand in exactly one of two ledgers; repeated rows count once."""
    return ledger_cells(left, right, key, member).where("(n_left = 0) != (n_right = 0)").select(key, member)


def ledger_comparison(left: DataFrame, right: DataFrame, key: str, member: str) -> DataFrame:
    """Per key: rows and distinct members of each ledger, members of both, of the left and of the right only."""
    words = key_dictionary(left.select(key).unionByName(right.select(key)))
    cells = ledger_cells(left, right, key, member, dictionary=words)
    flags = cells.select(
        key,
        F.col("n_left").alias("left_rows"),
        F.col("n_right").alias("right_rows"),
        *[F.expr(e).cast("long").alias(n) for n, e in (("both_members", "n_left > 0 and n_right > 0"), ("left_only_members", "n_right = 0"), ("right_only_members", "n_left = 0"))],
    )
    return dense_key_counts(flags, key, ["left_rows", "right_rows", "both_members", "left_only_members", "right_only_members"], words).withColumnRenamed("n_rows", "members")
