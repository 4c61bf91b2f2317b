"""Named queries of lexical, dense and fused retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestigo.operators import dense, eligibility, lexical, ranking
from vestigo.plans import search
from vestigo.registry import Registry
from vestigo.sources.index import Index, index_of
from vestigo.sources.tables import spread, table

REGISTRY = Registry()
QUERY = "denied network activity after the renewed lease on tundra-core"
SEED = 7

TOKENS = {
    "camel": r"regexp_replace(coalesce(text, ''), '([a-z])([A-Z])', '\1 \2', 'g')",
    "plain": "coalesce(text, '')",
    "camel_digit": r"regexp_replace(coalesce(text, ''), '([a-z0-9])([A-Z])', '\1 \2', 'g')",
}


def tokens_sql(kind: str) -> str:
    return f"list_filter(string_split(lower(regexp_replace({TOKENS[kind]}, '[^A-Za-z0-9_]+', ' ', 'g')), ' '), lambda x: x != '')"


def bm25_sql(query: str, kind: str = "camel", where: str = "", scope_all: bool = True, repeat: bool = False, ident: str = "doc_id", by: str = "") -> str:
    """CTEs up to ``scored(ident, score)`` with positive scores; ``by`` groups the statistics."""
    terms = lexical.tokenize_query(query, kind)
    rows = ", ".join(f"('{t}', {terms.count(t) if repeat else 1})" for t in sorted(set(terms)))
    late = f"WHERE {where}" if where and scope_all else ""
    early = f"WHERE {where}" if where and not scope_all else ""
    part = f"PARTITION BY {by}" if by else ""
    extra = f", {by}" if by else ""
    return f"""
    WITH t AS (SELECT *, {tokens_sql(kind)} AS toks FROM documents {early}),
    l AS (SELECT *, count(*) OVER ({part}) AS n, greatest(avg(len(toks)) OVER ({part}), 1) AS a FROM t),
    q(term, w) AS (VALUES {rows}),
    f AS (SELECT l.*, q.w, q.term, len(list_filter(toks, lambda x: x = q.term)) AS tf FROM l, q),
    d AS (SELECT *, count(*) FILTER (tf > 0) OVER (PARTITION BY term{extra}) AS df FROM f),
    scored AS (SELECT {ident}{extra}, sum(CASE WHEN tf > 0 THEN w * ln((n - df + 0.5) / (df + 0.5) + 1) * (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * len(toks) / a)) ELSE 0 END) AS score
      FROM d {late} GROUP BY {ident}{extra})"""


TOP20 = "SELECT doc_id, round(score, 6) AS score, row_number() OVER (ORDER BY round(score, 6) DESC, doc_id)::INT AS rank FROM scored WHERE score > 0 QUALIFY rank <= 20"


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "document_id", "text", "lang", "source"))


def index(spark: SparkSession, folder: str, tokenizer: str = "camel", by: str | None = None) -> Index:
    """The written index of the documents; the first query after a change of the table builds it."""
    keep = ("document_id", "lang")
    return index_of(docs(spark, folder), [f"{folder}/documents.parquet"], "doc_id", tokenizer=tokenizer, keep=keep, by=by)


@REGISTRY.query("bm25_scan_topk", bm25_sql(QUERY) + TOP20)
def bm25_scan_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Without an index, in one scan of the texts."""
    return lexical.ranked_top(lexical.bm25_scan(docs(spark, folder), QUERY), "doc_id", 20)


@REGISTRY.query("bm25_topk", bm25_sql(QUERY) + TOP20)
def bm25_topk(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_top(index(spark, folder).scores(QUERY, "doc_id"), "doc_id", 20)


@REGISTRY.query("bm25_postings_topk", bm25_sql(QUERY) + TOP20)
def bm25_postings_topk(spark: SparkSession, folder: str) -> DataFrame:
    """From posting rows and lengths, joined by document: the form for postings that don't carry the length."""
    found = index(spark, folder)
    lengths = found.table("lengths").withColumnRenamed("_id", "doc_id").select("doc_id", "doc_len")
    hits = found.of_terms("postings", sorted(set(lexical.tokenize_query(QUERY)))).withColumnRenamed("_id", "doc_id").select("doc_id", "term", "tf")
    return lexical.ranked_top(lexical.bm25_postings(hits, lengths, QUERY), "doc_id", 20)


@REGISTRY.query("bm25_filtered", bm25_sql(QUERY, where="lang = 'en'") + TOP20)
def bm25_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_top(index(spark, folder).scores(QUERY, "doc_id", where=F.col("lang") == "en"), "doc_id", 20)


@REGISTRY.query(
    "bm25_eligible_stats",
    bm25_sql(QUERY + " lease", "plain", "lang = 'en'", scope_all=False, repeat=True)
    + "SELECT doc_id, round_even(round(score, 9) * 1e6, 0)::BIGINT AS score_millionths, row_number() OVER (ORDER BY round_even(round(score, 9) * 1e6, 0) DESC, doc_id)::INT AS rank FROM scored WHERE score > 0 QUALIFY rank <= 20",
)
def bm25_eligible_stats(spark: SparkSession, folder: str) -> DataFrame:
    scored = index(spark, folder, "plain").scores(QUERY + " lease", "doc_id", where=F.col("lang") == "en", scope="eligible", repeat_terms=True)
    whole = scored.withColumn("score", F.rint(F.round("score", 9) * 1e6))
    return lexical.ranked_top(whole, "doc_id", 20).select("doc_id", F.col("score").cast("long").alias("score_millionths"), "rank")


@REGISTRY.query("bm25_keep_zero", bm25_sql(QUERY, "camel_digit", repeat=True) + "SELECT doc_id, round(score, 6) AS score FROM scored")
def bm25_keep_zero(spark: SparkSession, folder: str) -> DataFrame:
    scored = index(spark, folder, "camel_digit").scores(QUERY, "doc_id", repeat_terms=True, keep_zero=True)
    return scored.select("doc_id", F.round("score", 6).alias("score"))


@REGISTRY.query(
    "bm25_batch",
    f"""WITH t AS (SELECT doc_id, {tokens_sql('camel')} AS toks FROM documents),
    s AS (SELECT count(*) AS n, greatest(avg(len(toks)), 1) AS a FROM t),
    q AS (SELECT DISTINCT item_id AS query_id, unnest({tokens_sql('camel')}) AS term FROM eval_items),
    f AS (SELECT doc_id, len(toks) AS dl, term, count(*) AS tf FROM (SELECT doc_id, toks, unnest(toks) AS term FROM t) GROUP BY ALL),
    d AS (SELECT term, count(*) AS df FROM f GROUP BY term),
    scored AS (SELECT query_id, doc_id, round(sum(ln((n - df + 0.5) / (df + 0.5) + 1) * (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * dl / a))), 6) AS score
      FROM q JOIN f USING (term) JOIN d USING (term), s GROUP BY 1, 2)
    SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored QUALIFY rank <= 10""",
)
def bm25_batch(spark: SparkSession, folder: str) -> DataFrame:
    asked = [(r[0], r[1]) for r in table(spark, folder, "eval_items").select("item_id", "text").where("text is not null").collect()]
    return lexical.bm25_batch(docs(spark, folder), asked)


@REGISTRY.query("term_stats", f"WITH p AS (SELECT doc_id, unnest({tokens_sql('camel')}) AS term FROM documents) SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM p GROUP BY 1")
def term_stats(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.term_stats(docs(spark, folder), "doc_id", "text")


@REGISTRY.query("doc_lengths", f"SELECT doc_id, len({tokens_sql('camel')})::BIGINT AS doc_len FROM documents")
def doc_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.document_lengths(docs(spark, folder), "doc_id", "text")


@REGISTRY.query("postings_tf", f"WITH p AS (SELECT doc_id, unnest({tokens_sql('camel')}) AS term FROM documents) SELECT term, doc_id, count(*) AS tf FROM p WHERE term IN ('lease', 'denied', 'network') GROUP BY ALL")
def postings_tf(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.postings(docs(spark, folder), "doc_id", "text").where(F.col("term").isin("lease", "denied", "network"))


@REGISTRY.query("tokenize_counts", "SELECT doc_id, " + ", ".join(f"len({tokens_sql(k)})::INT AS {k}" for k in TOKENS) + " FROM documents")
def tokenize_counts(spark: SparkSession, folder: str) -> DataFrame:
    t = F.coalesce(F.col("text"), F.lit(""))
    return docs(spark, folder).select("doc_id", *[F.size(f(t)).alias(k) for k, f in lexical.TOKENIZERS.items()])


DENSE = f"""WITH q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = {SEED}),
scored AS (SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], qv), 6) AS score FROM embeddings, q)"""


def _emb(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings")


def _seed(spark: SparkSession, folder: str) -> list[float]:
    return dense.vector_of(_emb(spark, folder), SEED, "vec_id", "embedding")


@REGISTRY.query("dense_topk", DENSE + "SELECT vec_id, score, row_number() OVER (ORDER BY score DESC, vec_id)::INT AS rank FROM scored QUALIFY rank <= 20")
def dense_topk(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_top(dense.score_against(_emb(spark, folder), _seed(spark, folder), "vec_id", "embedding"), "vec_id", 20)


@REGISTRY.query("similar_excluding_seed", DENSE + f"SELECT vec_id, score, row_number() OVER (ORDER BY score DESC, vec_id)::INT AS rank FROM scored WHERE vec_id != {SEED} QUALIFY rank <= 10")
def similar_excluding_seed(spark: SparkSession, folder: str) -> DataFrame:
    v = _emb(spark, folder).select(F.col("vec_id").alias("document_id"), F.col("embedding").alias("vector"))
    return search.similar(v, SEED).withColumnRenamed("document_id", "vec_id")


@REGISTRY.query("similar_including_seed", DENSE + "SELECT vec_id, score, row_number() OVER (ORDER BY score DESC, vec_id)::INT AS rank FROM scored QUALIFY rank <= 10")
def similar_including_seed(spark: SparkSession, folder: str) -> DataFrame:
    v = _emb(spark, folder).select(F.col("vec_id").alias("document_id"), F.col("embedding").alias("vector"))
    return search.similar(v, SEED, include_seed=True).withColumnRenamed("document_id", "vec_id")


@REGISTRY.query("dense_distance_millionths", DENSE + "SELECT vec_id, least(greatest(round_even((1 - score) * 1e6, 0), 0), 2000000)::BIGINT AS distance_millionths FROM scored")
def dense_distance_millionths(spark: SparkSession, folder: str) -> DataFrame:
    scored = dense.score_against(_emb(spark, folder), _seed(spark, folder), "vec_id", "embedding")
    return scored.select("vec_id", dense.distance_millionths(F.round("score", 6)).alias("distance_millionths"))


@REGISTRY.query(
    "norm_audit",
    """WITH n AS (SELECT sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings)
    SELECT count(*) AS n_vectors, count(*) FILTER (abs(n - 1) > 1e-4) AS off_norm, round(min(n), 6) AS min_norm, round(max(n), 6) AS max_norm FROM n""",
)
def norm_audit(spark: SparkSession, folder: str) -> DataFrame:
    return dense.norm_audit(_emb(spark, folder), "embedding")


@REGISTRY.query(
    "prefix_l2_overlap",
    f"""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, embedding[1:16]::DOUBLE[] AS h FROM embeddings),
    p AS (SELECT vec_id, v, list_transform(h, lambda x: (x / sqrt(list_dot_product(h, h)))::FLOAT::DOUBLE) AS u FROM e),
    q AS (SELECT v AS qv, u AS qu FROM p WHERE vec_id = {SEED}),
    a AS (SELECT vec_id FROM p, q ORDER BY round(list_dot_product(v, qv), 6) DESC, vec_id LIMIT 20),
    b AS (SELECT vec_id FROM p, q ORDER BY round(list_dot_product(u, qu), 6) DESC, vec_id LIMIT 20),
    n AS (SELECT (SELECT count(*) FROM a JOIN b USING (vec_id)) AS shared)
    SELECT shared, round(shared / (40.0::DOUBLE - shared), 6) AS jaccard FROM n""",
)
def prefix_l2_overlap(spark: SparkSession, folder: str) -> DataFrame:
    e = _emb(spark, folder)
    short = e.select("vec_id", dense.prefix_unit(F.col("embedding"), 16).alias("embedding"))
    lists = []
    for v in (e, short):
        top = lexical.ranked_top(dense.score_against(v, dense.vector_of(v, SEED, "vec_id", "embedding"), "vec_id", "embedding"), "vec_id", 20)
        lists.append(top.agg(F.collect_list("vec_id").alias("ids")))
    both = lists[0].select(F.col("ids").alias("a")).crossJoin(lists[1].select(F.col("ids").alias("b")))  # one row each
    return both.select(F.size(F.array_intersect("a", "b")).cast("long").alias("shared"), ranking.list_overlap(F.col("a"), F.col("b")).alias("jaccard"))


RANKS = (
    bm25_sql(QUERY)
    + f""", lx AS (SELECT doc_id AS id, row_number() OVER (ORDER BY round(score, 6) DESC, doc_id) AS rank FROM scored WHERE score > 0),
    qq AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = {SEED}),
    dn AS (SELECT vec_id AS id, row_number() OVER (ORDER BY round(list_dot_product(embedding::DOUBLE[], qv), 6) DESC, vec_id) AS rank FROM embeddings, qq)
    """
)


def _lists(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    lex = index(spark, folder).scores(QUERY, "id")
    den = dense.score_against(_emb(spark, folder), _seed(spark, folder), "vec_id", "embedding").withColumnRenamed("vec_id", "id")
    return {"lexical": ranking.with_rank(lex, "id"), "dense": ranking.with_rank(den, "id")}


@REGISTRY.query(
    "rrf_fused",
    RANKS + """, fu AS (SELECT id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT * FROM lx UNION ALL SELECT * FROM dn) GROUP BY id)
    SELECT id, score, row_number() OVER (ORDER BY score DESC, id)::INT AS rank FROM fu QUALIFY rank <= 20""",
)
def rrf_fused(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_top(ranking.reciprocal_fusion(list(_lists(spark, folder).values()), "id"), "id", 20)


@REGISTRY.query(
    "mode_comparison",
    RANKS + """, b AS (SELECT id, lx.rank AS lr, dn.rank AS rr FROM lx FULL JOIN dn USING (id)), k AS (SELECT unnest([1, 5, 10, 20]) AS k),
    c AS (SELECT k, count(*) FILTER (lr <= k AND rr <= k) AS shared, count(*) FILTER (lr <= k AND coalesce(rr > k, TRUE)) AS left_only,
      count(*) FILTER (rr <= k AND coalesce(lr > k, TRUE)) AS right_only, round(avg(abs(lr - rr)) FILTER (lr <= k AND rr <= k), 6) AS mean_rank_change FROM b, k GROUP BY k)
    SELECT k, shared, left_only, right_only, mean_rank_change, round(shared / k::DOUBLE, 6) AS overlap, round(shared / nullif(shared + left_only + right_only, 0)::DOUBLE, 6) AS jaccard FROM c""",
)
def mode_comparison(spark: SparkSession, folder: str) -> DataFrame:
    lists = _lists(spark, folder)
    return ranking.compare_rankings(lists["lexical"], lists["dense"], "id")


@REGISTRY.query(
    "review_pool",
    RANKS + """SELECT id, string_agg(mode, ',' ORDER BY mode) AS modes, min(rank)::BIGINT AS best_rank FROM
    (SELECT id, 'lexical' AS mode, rank FROM lx WHERE rank <= 20 UNION ALL SELECT id, 'dense', rank FROM dn WHERE rank <= 20) GROUP BY id""",
)
def review_pool(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.pool({k: v.where("rank <= 20") for k, v in _lists(spark, folder).items()}, "id")


@REGISTRY.query(
    "catalogue_merge",
    bm25_sql(QUERY, by="source") + """, r AS (SELECT doc_id, source AS dataset, round(score, 6) AS score, row_number() OVER (PARTITION BY source ORDER BY round(score, 6) DESC, doc_id)::INT AS rank
      FROM scored WHERE score > 0 QUALIFY rank <= 10)
    SELECT *, round(1.0::DOUBLE / (60 + rank), 6) AS fused, row_number() OVER (ORDER BY round(1.0::DOUBLE / (60 + rank), 6) DESC, dataset, doc_id)::INT AS merged_rank FROM r QUALIFY merged_rank <= 20""",
)
def catalogue_merge(spark: SparkSession, folder: str) -> DataFrame:
    return search.catalogue_search(index(spark, folder, by="source"), QUERY, "doc_id")


WANTED = eligibility.OccurrenceFilter(relations=("ocsf_dns_activity", "ocsf_process_activity"), start="2026-03-05 00:00:00", end="2026-03-20 00:00:00")
WANTED_SQL = "document_id IS NOT NULL AND lower(trim(relation_name)) IN ('ocsf_dns_activity', 'ocsf_process_activity') AND event_time >= TIMESTAMPTZ '2026-03-05 00:00:00+00' AND event_time < TIMESTAMPTZ '2026-03-20 00:00:00+00'"


@REGISTRY.query("eligible_documents", f"SELECT DISTINCT document_id FROM occurrences WHERE {WANTED_SQL}")
def eligible_documents(spark: SparkSession, folder: str) -> DataFrame:
    return eligibility.eligible_documents(table(spark, folder, "occurrences"), WANTED)


FILTERED = (
    bm25_sql("network activity denied status", ident="document_id")
    + f", el AS (SELECT DISTINCT document_id FROM occurrences WHERE {WANTED_SQL}), hits AS (SELECT document_id, round(score, 6) AS score, row_number() OVER (ORDER BY round(score, 6) DESC, document_id)::INT AS rank FROM scored SEMI JOIN el USING (document_id) WHERE score > 0 QUALIFY rank <= 10) "
)


@REGISTRY.query("filtered_search", FILTERED + "SELECT * FROM hits")
def filtered_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(index(spark, folder), table(spark, folder, "occurrences"), "lexical", "network activity denied status", wanted=WANTED)


@REGISTRY.query(
    "search_hits_hydrated",
    FILTERED + f""", o AS (SELECT DISTINCT document_id, occurrence_id FROM occurrences WHERE {WANTED_SQL}),
    c AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY occurrence_id)::INT AS position, count(*) OVER (PARTITION BY document_id) AS eligible FROM o)
    SELECT document_id, score, rank, occurrence_id, eligible, position, eligible <= 50 AS exhausted FROM hits LEFT JOIN (SELECT * FROM c WHERE position <= 50) USING (document_id)""",
)
def search_hits_hydrated(spark: SparkSession, folder: str) -> DataFrame:
    hits = filtered_search(spark, folder)
    return search.hydrate(hits, table(spark, folder, "occurrences"), WANTED)


@REGISTRY.query(
    "occurrence_cap",
    """WITH o AS (SELECT DISTINCT document_id, occurrence_id FROM occurrences WHERE document_id IS NOT NULL),
    c AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY occurrence_id)::INT AS position, count(*) OVER (PARTITION BY document_id) AS eligible FROM o)
    SELECT *, eligible <= 50 AS exhausted FROM c WHERE position <= 50""",
)
def occurrence_cap(spark: SparkSession, folder: str) -> DataFrame:
    return eligibility.bounded_occurrences(table(spark, folder, "occurrences"))


@REGISTRY.query(
    "attribute_predicate",
    """WITH a AS (SELECT DISTINCT occurrence_id, unnest(from_json(exact_attributes_json, '[{"namespace":"VARCHAR","path":"VARCHAR","value":"VARCHAR"}]')) AS a FROM occurrences WHERE json_valid(exact_attributes_json))
    SELECT DISTINCT occurrence_id FROM a WHERE a.path = '/activity_id' AND try_cast(a.value AS DOUBLE) >= 5""",
)
def attribute_predicate(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "occurrences").where(eligibility.attribute_predicate("/activity_id", "gte", 5))
    return rows.select("occurrence_id").distinct()


@REGISTRY.query("literal_rules", "SELECT doc_id FROM documents WHERE (contains(lower(text), 'lease') OR contains(lower(text), 'driver')) AND contains(lower(text), 'the') AND NOT contains(lower(text), 'queue')")
def literal_rules(spark: SparkSession, folder: str) -> DataFrame:
    return docs(spark, folder).where(eligibility.literal_match(F.col("text"), ["lease", "driver"], ["the"], ["queue"])).select("doc_id")


@REGISTRY.query("duplicate_vectors", "WITH g AS (SELECT vector, count(*) AS copies FROM vectors WHERE vector IS NOT NULL GROUP BY 1) SELECT copies, count(*) AS groups FROM g GROUP BY 1")
def duplicate_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return dense.duplicate_vectors(table(spark, folder, "vectors"), "vector")
