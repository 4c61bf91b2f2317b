"""Search over prepared documents: lexical, dense and fused, with occurrence-first filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vestigo.operators import dense, lexical, ranking
from vestigo.sources.index import Index
from vestigo.operators.eligibility import HIT_OCCURRENCES, OccurrenceFilter, bounded_occurrences, eligible_documents

MODES = ("lexical", "dense", "fused")


def search(
    documents: DataFrame | Index,
    occurrences: DataFrame | None,
    mode: str,
    query: str | None = None,
    query_vector: list[float] | None = None,
    vectors: DataFrame | None = None,
    wanted: OccurrenceFilter | None = None,
    exclude: Sequence[str] = (),
    top_n: int = 10,
) -> DataFrame:
    """(document_id, score, rank) of the best documents, of a written index or, in one scan, of a frame with document_id and text.

    Statistics come from the whole corpus; a filter decides by occurrences
    which documents are eligible; excluded documents are removed before the
    cut. Fused search ranks the full lexical and dense lists and adds
    1 / (60 + rank).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    (wanted or OccurrenceFilter()).check(top_n)
    allowed = None if wanted is None or occurrences is None else eligible_documents(occurrences, wanted)

    def narrowed(scored: DataFrame) -> DataFrame:
        if exclude:
            scored = scored.where(~F.col("document_id").isin(list(exclude)))
        return scored if allowed is None else scored.join(allowed, "document_id", "left_semi")

    lists = []
    if mode in ("lexical", "fused"):
        lists.append(narrowed(documents.scores(query or "", "document_id") if isinstance(documents, Index) else lexical.bm25_scan(documents, query or "", "document_id")))
    if mode in ("dense", "fused"):
        lists.append(narrowed(dense.score_against(vectors, query_vector, "document_id", "vector")))
    scored = lists[0] if mode != "fused" else ranking.reciprocal_fusion([ranking.with_rank(s, "document_id") for s in lists], "document_id")
    return lexical.ranked_top(scored, "document_id", top_n)


def similar(vectors: DataFrame, seed: str, top_n: int = 10, include_seed: bool = False, allowed: DataFrame | None = None) -> DataFrame:
    """The documents nearest to one document; a missing seed is an error."""
    q = dense.vector_of(vectors, seed, "document_id", "vector")
    scored = dense.score_against(vectors, q, "document_id", "vector", exclude=None if include_seed else [seed])
    if allowed is not None:
        scored = scored.join(allowed, "document_id", "left_semi")
    return lexical.ranked_top(scored, "document_id", top_n)


def hydrate(hits: DataFrame, occurrences: DataFrame, wanted: OccurrenceFilter | None = None, most: int = HIT_OCCURRENCES) -> DataFrame:
    """Each hit with its first occurrences that pass the filter, the full number of these, and whether the list is complete.

    Hits are at most a hundred rows, so they are broadcast and the ledger is
    scanned once.
    """
    rows = occurrences if wanted is None else occurrences.where(wanted.condition())
    few = rows.join(F.broadcast(hits.select("document_id")), "document_id", "left_semi")
    return hits.join(bounded_occurrences(few, most=most), "document_id", "left")


def catalogue_search(index: Index, query: str, identifier: str = "document_id", per_dataset: int = 10, top_n: int = 20) -> DataFrame:
    """The same lexical query on every dataset of an index that is kept by dataset, each with its own statistics; merged by each dataset's ranks."""
    scored = index.scores(query, identifier).withColumnRenamed(index.by, "dataset")
    return ranking.merge_datasets(lexical.ranked_top(scored, identifier, per_dataset, partition=["dataset"]), "dataset", identifier, top_n)


def catalogue_modes(lists: dict[str, DataFrame], dataset: str, identifier: str, per_dataset: int = 10, top_n: int = 20) -> DataFrame:
    """Dense, lexical and fused catalogue search at once: (mode, dataset, identifier, rank, fused, merged_rank).

    ``lists`` has scored documents (dataset, identifier, score) by mode
    'lexical' and 'dense'. Each dataset ranks its own; 'fused' adds
    1 / (60 + rank) of both whole lists within a dataset. Datasets are merged by
    1 / (60 + rank), ties by dataset, then identifier.
    """
    ranked = {m: ranking.with_rank(s, identifier, partition=[dataset]) for m, s in lists.items()}
    parts = [(F.lit(1.0) / (F.lit(ranking.FUSION_K) + F.col("rank"))).alias("part")]
    both = reduce(DataFrame.unionByName, [r.select(dataset, identifier, *parts) for r in ranked.values()])
    fused = both.groupBy(dataset, identifier).agg(F.sum("part").alias("score"))
    ranked["fused"] = lexical.ranked_top(fused, identifier, per_dataset, partition=[dataset])
    rows = reduce(DataFrame.unionByName, [r.where(F.col("rank") <= per_dataset).select(F.lit(m).alias("mode"), dataset, identifier, "rank") for m, r in ranked.items()])
    scored = rows.withColumn("fused", F.round(F.lit(1.0) / (F.lit(ranking.FUSION_K) + F.col("rank")), 6))
    place = F.row_number().over(Window.partitionBy("mode").orderBy(F.desc("fused"), dataset, identifier))
    return scored.withColumn("merged_rank", place).where(F.col("merged_rank") <= top_n)


def catalogue_similar(vectors: DataFrame, seed: object, dataset: str, identifier: str, vector: str, per_dataset: int = 10, top_n: int = 20) -> DataFrame:
    """The nearest documents to a seed in every dataset, the seed left out, merged by each dataset's ranks."""
    q = dense.vector_of(vectors, seed, identifier, vector)
    scored = vectors.where(F.col(identifier) != seed).select(dataset, identifier, dense.dot(F.col(vector), dense.constant(q)).alias("score"))
    return ranking.merge_datasets(lexical.ranked_top(scored, identifier, per_dataset, partition=[dataset]), dataset, identifier, top_n)


def catalogue_batch(index: Index, queries: list[tuple[object, str]], identifier: str = "document_id", per_dataset: int = 10, top_n: int = 20) -> DataFrame:
    """Every query (a stated set) on every dataset of an index kept by dataset, merged per query: (query_id, dataset, identifier, rank, merged_rank)."""
    scored = index.batch_scores(queries, identifier).withColumnRenamed(index.by, "dataset")
    ranked = lexical.ranked_top(scored, identifier, per_dataset, partition=["query_id", "dataset"])
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("rank", "dataset", identifier))
    return ranked.withColumn("merged_rank", place).where(F.col("merged_rank") <= top_n).select("query_id", "dataset", identifier, "rank", "merged_rank")


def page_after(ranked: DataFrame, identifier: str, size: int, after: tuple[float, object] | None = None, score: str = "score") -> DataFrame:
    """Keyset paging of scored rows: the ``size`` next ones behind a (score, identifier) already seen, best first.

    No offset is counted, so a late page costs what the first one costs.
    """
    rows = ranked.withColumn(score, F.round(score, 6))
    if after is not None:
        s, i = F.lit(float(after[0])), F.lit(after[1])
        rows = rows.where((F.col(score) < s) | (F.col(score) == s) & (F.col(identifier) > i))
    return rows.orderBy(F.desc(score), identifier).limit(size)


def check_plan(plan: DataFrame) -> DataFrame:
    """(query_id, mode) that a batch plan lists more than once, and queries whose text differs between modes."""
    twice = plan.groupBy("query_id", "mode").count().where("count > 1").select("query_id", F.lit("repeated").alias("problem"))
    mixed = plan.groupBy("query_id").agg(F.countDistinct("query").alias("n")).where("n > 1").select("query_id", F.lit("text differs").alias("problem"))
    return twice.unionByName(mixed)


def envelope(hits: DataFrame, scored: DataFrame, top_n: int) -> DataFrame:
    """One row about a result: returned and eligible hits, whether all were returned, and 'pointer' or 'miss'."""
    counts = hits.agg(F.count("*").alias("returned")).crossJoin(scored.agg(F.count("*").alias("eligible")))
    return counts.select("returned", "eligible", (F.col("eligible") <= top_n).alias("exhausted"), F.when(F.col("returned") > 0, "pointer").otherwise("miss").alias("disposition"))
