"""Lexical ranking (BM25, k1 = 1.2, b = 0.75) in its three scopes, and the tables behind it.

Without an index documents are scored by counting just the query's terms in
each token array: one scan for the statistics, of which one row per split is
shuffled, and one for the scores. ``sources.index`` has the written form that
answers without the texts. Query batches score blocks of documents against all queries at once
and pass on only each split's best per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vestigo.functions.text import TOKENIZERS

K1, B = 1.2, 0.75


def tokenize_query(text: str, tokenizer: str = "camel") -> list[str]:
    """A query's tokens, by the same rules as the column functions."""
    import re

    humps = {"camel": r"([a-z])(?=[A-Z])", "camel_digit": r"([a-z0-9])(?=[A-Z])"}.get(tokenizer)
    if humps:
        text = re.sub(humps, r"\1 ", text)
    return [t.lower() for t in re.findall(r"[A-Za-z0-9_]+", text)]


def document_tokens(documents: DataFrame, identifier: str, text: str, tokenizer: str = "camel") -> DataFrame:
    """(identifier, tokens); null texts have no tokens."""
    return documents.select(identifier, TOKENIZERS[tokenizer](F.coalesce(F.col(text), F.lit(""))).alias("tokens"))


def document_lengths(documents: DataFrame, identifier: str, text: str, tokenizer: str = "camel") -> DataFrame:
    return document_tokens(documents, identifier, text, tokenizer).select(identifier, F.size("tokens").cast("long").alias("doc_len"))


def postings(documents: DataFrame, identifier: str, text: str, tokenizer: str = "camel") -> DataFrame:
    """(term, identifier, tf): the inverted index."""
    each = document_tokens(documents, identifier, text, tokenizer).select(identifier, F.explode("tokens").alias("term"))
    return each.groupBy("term", identifier).agg(F.count("*").alias("tf"))


def term_stats(documents: DataFrame, identifier: str, text: str, tokenizer: str = "camel") -> DataFrame:
    """(term, df, cf): documents and occurrences of each term. Tokens are made distinct within a document before they are shuffled."""
    return postings(documents, identifier, text, tokenizer).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def counted_terms(documents: DataFrame, keep: list[Column], text: str, terms: list[str], tokenizer: str) -> DataFrame:
    """``keep`` with ``_len``, the number of tokens, and ``_f0``, ``_f1``, ...: how often each term stands.

    Tokens that aren't query terms are dropped in one pass over the array.
    """
    tokens = TOKENIZERS[tokenizer](F.coalesce(F.col(text), F.lit("")))
    hits = F.filter("_t", lambda x: x.isin(terms)) if terms else F.array()
    rows = documents.select(*keep, tokens.alias("_t")).select(*[F.col(c) for c in _names(documents, keep)], F.size("_t").alias("_len"), hits.alias("_h"))
    count = lambda t: F.size("_h") - F.size(F.array_remove("_h", t))
    names = _names(documents, keep)
    return rows.select(*names, "_len", *[count(t).alias(f"_f{i}") for i, t in enumerate(terms)])


def _names(documents: DataFrame, keep: list[Column]) -> list[str]:
    return documents.select(*keep).columns


def corpus_stats(rows: DataFrame, n_terms: int) -> DataFrame:
    """One row (_n, _avg, _d0, _d1, ...): documents, mean length (at least 1) and document frequencies."""
    return rows.agg(F.count("*").alias("_n"), F.greatest(F.avg("_len"), F.lit(1.0)).alias("_avg"), *[F.count_if(F.col(f"_f{i}") > 0).alias(f"_d{i}") for i in range(n_terms)])


def term_scores(weights: list[float]) -> Column:
    """The BM25 sum over columns of ``counted_terms`` and ``corpus_stats``."""
    score: Column = F.lit(0.0)
    for i, w in enumerate(weights):
        tf = F.col(f"_f{i}")
        part = F.lit(float(w)) * _idf(F.col("_n"), F.col(f"_d{i}")) * (tf * (K1 + 1)) / (tf + K1 * (1 - B + B * F.col("_len") / F.col("_avg")))
        score = score + F.when(tf > 0, part).otherwise(0.0)
    return score


def _idf(n: Column, df: Column) -> Column:
    return F.ln((n - df + F.lit(0.5)) / (df + F.lit(0.5)) + F.lit(1.0))


def bm25_scan(
    documents: DataFrame,
    query: str,
    identifier: str = "doc_id",
    text: str = "text",
    tokenizer: str = "camel",
    eligible: Column | None = None,
    scope: str = "corpus",
    repeat_terms: bool = False,
    keep_zero: bool = False,
) -> DataFrame:
    """(identifier, score) of every eligible document.

    ``scope``: N, document frequencies and mean length over the whole
    'corpus', or over the 'eligible' documents only. ``repeat_terms``: a term
    standing twice in the query counts twice. ``keep_zero``: documents
    without any term keep a score of 0, else they don't come out.
    """
    terms = tokenize_query(query, tokenizer)
    weights = {t: terms.count(t) if repeat_terms else 1 for t in sorted(set(terms))}
    ok = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    base = documents if scope == "corpus" else documents.where(ok)
    held = F.lit(True) if eligible is None or scope != "corpus" else ok
    rows = counted_terms(base, [F.col(identifier), held.alias("_ok")], text, list(weights), tokenizer)
    out = rows.where("_ok").crossJoin(F.broadcast(corpus_stats(rows, len(weights)))).select(identifier, term_scores(list(weights.values())).alias("score"))
    return out if keep_zero else out.where("score > 0")


def bm25_postings(index: DataFrame, lengths: DataFrame, query: str, identifier: str = "doc_id", tokenizer: str = "camel") -> DataFrame:
    """(identifier, score) from an inverted index and document lengths; equal to ``bm25_scan`` over the corpus."""
    terms = sorted(set(tokenize_query(query, tokenizer)))
    stats = lengths.agg(F.count("*").alias("_n"), F.greatest(F.avg("doc_len"), F.lit(1.0)).alias("_avg"))
    hits = index.where(F.col("term").isin(terms))
    df = hits.groupBy("term").agg(F.count("*").alias("_df"))  # at most one row per query term
    joined = hits.join(F.broadcast(df), "term").join(lengths, identifier).crossJoin(F.broadcast(stats))
    part = _idf(F.col("_n"), F.col("_df")) * (F.col("tf") * (K1 + 1)) / (F.col("tf") + K1 * (1 - B + B * F.col("doc_len") / F.col("_avg")))
    return joined.groupBy(identifier).agg(F.sum(part).alias("score"))


def ranked_top(scored: DataFrame, identifier: str, n: int, score: str = "score", partition: list[str] | None = None) -> DataFrame:
    """The n best by score (rounded to 6 places), then by identifier, with rank 1..n, for each partition if one is given."""
    s = scored.withColumn(score, F.round(score, 6))
    if not partition:
        s = s.orderBy(F.desc(score), identifier).limit(n)
    w = Window.partitionBy(*(partition or [F.lit(0)])).orderBy(F.desc(score), identifier)
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def bm25_batch(documents: DataFrame, queries: list[tuple[object, str]], n: int = 10, identifier: str = "doc_id", text: str = "text", tokenizer: str = "camel") -> DataFrame:
    """(query_id, identifier, score, rank) of every query's n best documents.

    ``queries`` is a stated set on the driver. Each split keeps n candidates
    per query, so the shuffle holds splits x queries x n rows at most.
    """
    asked = [(k, sorted(set(tokenize_query(q, tokenizer)))) for k, q in queries]
    terms = sorted({t for _, ts in asked for t in ts})
    place = {t: i for i, t in enumerate(terms)}
    kinds = dict(documents.dtypes)[identifier], "bigint" if all(isinstance(k, int) for k, _ in asked) else "string"
    toks = document_tokens(documents, identifier, text, tokenizer)
    spark = documents.sparkSession
    out_schema = f"query_id {kinds[1]}, {identifier} {kinds[0]}, score double"
    if not terms:
        return spark.createDataFrame([], out_schema + ", rank int")
    book = spark.sparkContext.broadcast(place)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_tokens = np.zeros(len(terms), np.int64), 0, 0
        for b in batches:
            lists = b.column(1)
            n_docs += b.num_rows
            flat = lists.flatten().to_pylist()
            n_tokens += len(flat)
            owner = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            known = book.value
            code = np.fromiter((known.get(t, -1) for t in flat), np.int64, len(flat))
            pair = np.unique(owner[code >= 0] * len(terms) + code[code >= 0])
            df += np.bincount(pair % len(terms), minlength=len(terms))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(df[at], [n_docs, n_tokens]))], ["k", "v"])

    got = dict(toks.mapInArrow(count, "k long, v long").groupBy("k").agg(F.sum("v")).collect())  # one row per query term, and two
    n_docs, n_tokens = got.pop(-1, 0), got.pop(-2, 0)
    if not n_docs:
        return spark.createDataFrame([], out_schema + ", rank int")
    mean = max(1.0, n_tokens / n_docs)
    idf = np.array([np.log((n_docs - got.get(i, 0) + 0.5) / (got.get(i, 0) + 0.5) + 1.0) for i in range(len(terms))])
    shipped = spark.sparkContext.broadcast([(k, np.array([place[t] for t in ts], np.int64)) for k, ts in asked])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        for b in batches:
            ids = np.array(b.column(0).to_pylist(), object)
            lists = b.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_pylist()
            known = book.value
            code = np.fromiter((known.get(t, -1) for t in flat), np.int64, len(flat))
            owner = np.repeat(np.arange(b.num_rows), sizes)[code >= 0]
            for lo in range(0, b.num_rows, 256):
                part = (owner >= lo) & (owner < lo + 256)
                rows = min(256, b.num_rows - lo)
                tf = np.bincount((owner[part] - lo) * len(terms) + code[code >= 0][part], minlength=rows * len(terms)).reshape(rows, -1).astype(np.float64)
                norm = K1 * (1 - B + B * sizes[lo : lo + 256] / mean)
                w = idf * (tf * (K1 + 1)) / (tf + norm[:, None])
                for j, (_, cols) in enumerate(shipped.value):
                    s = np.round(w[:, cols].sum(axis=1), 6)
                    hit = np.flatnonzero(s > 0)
                    held = best.setdefault(j, [])
                    held.extend(zip(-s[hit], ids[lo : lo + 256][hit]))
                    if len(held) > 20 * n + 512:
                        held.sort()
                        del held[n:]
        out = [(shipped.value[j][0], d, -s) for j, held in best.items() for s, d in sorted(held)[:n]]
        if out:
            q, d, s = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(d), pa.array(s, pa.float64())], ["query_id", identifier, "score"])

    found = toks.mapInArrow(score, out_schema)
    return ranked_top(found, identifier, n, partition=["query_id"])

