"""Named queries of closed filters, catalogues, paging, relationships, receipts and written indexes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestigo.functions import projection
from vestigo.functions import text as tx
from vestigo.operators import audit, dense, eligibility, evaluate, geometry, lexical, sampling
from vestigo.plans import derivations, search
from vestigo.plans.evaluation_queries import _neighbours, _nn_sql
from vestigo.plans.retrieval_queries import DENSE, QUERY, SEED, bm25_sql, docs, index, tokens_sql
from vestigo.registry import Registry
from vestigo.sources.index import verify_index
from vestigo.sources.tables import relation_key, spread, table

REGISTRY = Registry()

ENTITY_WANTED = """o.document_id IS NOT NULL AND o.event_time >= TIMESTAMPTZ '2026-03-05 00:00:00+00'
  AND o.event_id IN (SELECT event_id FROM participants WHERE entity_id IN (SELECT entity_id FROM entities ORDER BY entity_id LIMIT 25))
  AND o.occurrence_id IN (SELECT occurrence_id FROM (SELECT occurrence_id, unnest(from_json(exact_attributes_json, '[{"path":"VARCHAR","value":"VARCHAR"}]')) AS a FROM occurrences WHERE json_valid(exact_attributes_json))
    WHERE a.path = '/activity_id' AND try_cast(a.value AS BIGINT) IN (1, 2, 3, 5))"""


@REGISTRY.query("eligible_by_entity", f"SELECT DISTINCT o.document_id FROM occurrences o WHERE {ENTITY_WANTED}")
def eligible_by_entity(spark: SparkSession, folder: str) -> DataFrame:
    """A closed filter by participating entities, a numeric field and time; the entities asked for are a stated set."""
    asked = [r[0] for r in table(spark, folder, "entities").orderBy("entity_id").select("entity_id").limit(25).collect()]
    wanted = eligibility.OccurrenceFilter(start="2026-03-05 00:00:00", entities=tuple(asked), uids=(("/activity_id", (1, 2, 3, 5)),))
    return eligibility.eligible_documents(table(spark, folder, "occurrences"), wanted, table(spark, folder, "participants"))


@REGISTRY.query("second_page", bm25_sql(QUERY) + "SELECT doc_id, round(score, 6) AS score FROM scored WHERE score > 0 ORDER BY round(score, 6) DESC, doc_id LIMIT 20 OFFSET 20")
def second_page(spark: SparkSession, folder: str) -> DataFrame:
    """The page behind the last hit of the first page, by its score and identifier."""
    scored = index(spark, folder).scores(QUERY, "doc_id")
    first = search.page_after(scored, "doc_id", 20).collect()
    return search.page_after(scored, "doc_id", 20, (first[-1].score, first[-1].doc_id) if first else None)


_CATALOGUE = """, lx AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY round(score, 6) DESC, doc_id) AS rank FROM scored WHERE score > 0 AND source IS NOT NULL),
qq AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = """ + str(SEED) + """),
dn AS (SELECT d.source, d.doc_id, row_number() OVER (PARTITION BY d.source ORDER BY round(list_dot_product(embedding::DOUBLE[], qv), 6) DESC, doc_id) AS rank FROM embeddings JOIN documents d ON d.doc_id = vec_id, qq WHERE d.source IS NOT NULL),
fs AS (SELECT source, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT * FROM lx UNION ALL SELECT * FROM dn) GROUP BY 1, 2),
fu AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rank FROM fs),
m AS (SELECT 'lexical' AS mode, * FROM lx UNION ALL SELECT 'dense', * FROM dn UNION ALL SELECT 'fused', * FROM fu)
SELECT mode, source, doc_id, rank::BIGINT AS rank, row_number() OVER (PARTITION BY mode ORDER BY rank, source, doc_id)::INT AS merged_rank FROM m WHERE rank <= 10 QUALIFY merged_rank <= 20"""


@REGISTRY.query("catalogue_modes", bm25_sql(QUERY, by="source") + _CATALOGUE)
def catalogue_modes(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings")
    q = dense.vector_of(e, SEED, "vec_id", "embedding")
    own = docs(spark, folder).where("source is not null").select("doc_id", "source")
    near = dense.score_against(e, q, "vec_id", "embedding").withColumnRenamed("vec_id", "doc_id").join(own, "doc_id")
    lists = {"lexical": index(spark, folder, by="source").scores(QUERY, "doc_id"), "dense": near.select("source", "doc_id", "score")}
    return search.catalogue_modes(lists, "source", "doc_id").select("mode", "source", "doc_id", F.col("rank").cast("long").alias("rank"), "merged_rank")


@REGISTRY.query(
    "catalogue_similar",
    DENSE + f""", r AS (SELECT s.vec_id, e.label, s.score, row_number() OVER (PARTITION BY e.label ORDER BY s.score DESC, s.vec_id)::INT AS rank FROM scored s JOIN embeddings e USING (vec_id) WHERE s.vec_id != {SEED} QUALIFY rank <= 10)
    SELECT label, vec_id, score, rank, round(1.0::DOUBLE / (60 + rank), 6) AS fused, row_number() OVER (ORDER BY round(1.0::DOUBLE / (60 + rank), 6) DESC, label, vec_id)::INT AS merged_rank FROM r QUALIFY merged_rank <= 20""",
)
def catalogue_similar(spark: SparkSession, folder: str) -> DataFrame:
    return search.catalogue_similar(table(spark, folder, "embeddings"), SEED, "label", "vec_id", "embedding")


@REGISTRY.query(
    "catalogue_batch",
    f"""WITH t AS (SELECT doc_id, source, {tokens_sql('camel')} AS toks FROM documents WHERE source IS NOT NULL),
    s AS (SELECT source, count(*) AS n, greatest(avg(len(toks)), 1) AS a FROM t GROUP BY 1),
    q AS (SELECT DISTINCT item_id AS query_id, unnest({tokens_sql('camel')}) AS term FROM eval_items WHERE item_id % 100 = 0),
    f AS (SELECT doc_id, source, len(toks) AS dl, term, count(*) AS tf FROM (SELECT doc_id, source, toks, unnest(toks) AS term FROM t) GROUP BY ALL),
    d AS (SELECT source, term, count(*) AS df FROM f GROUP BY 1, 2),
    scored AS (SELECT query_id, source, doc_id, round(sum(ln((n - df + 0.5) / (df + 0.5) + 1) * (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * dl / a))), 6) AS score
      FROM q JOIN f USING (term) JOIN d USING (source, term) JOIN s USING (source) GROUP BY 1, 2, 3),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id, source ORDER BY score DESC, doc_id)::INT AS rank FROM scored QUALIFY rank <= 10)
    SELECT query_id, source AS dataset, doc_id, rank, row_number() OVER (PARTITION BY query_id ORDER BY rank, source, doc_id)::INT AS merged_rank FROM r QUALIFY merged_rank <= 20""",
)
def catalogue_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The queries are every hundredth item, a stated set; all datasets and all documents are searched."""
    asked = [(r[0], r[1]) for r in table(spark, folder, "eval_items").where("item_id % 100 = 0 and text is not null").select("item_id", "text").collect()]
    return search.catalogue_batch(index(spark, folder, by="source"), asked, "doc_id")


@REGISTRY.query(
    "relationship_ends",
    """WITH r AS (SELECT event_id, min(entity_id) FILTER (role IN ('user', 'actor')) AS source_entity_id, max(entity_id) FILTER (role IN ('resource', 'device', 'target')) AS target_entity_id
      FROM participants WHERE event_id IS NOT NULL GROUP BY 1)
    SELECT s.kind AS source_kind, t.kind AS target_kind, coalesce((source_entity_id IS NOT NULL AND s.kind IS NULL) OR (target_entity_id IS NOT NULL AND t.kind IS NULL), FALSE) AS dangling, count(*) AS n
    FROM r LEFT JOIN entities s ON s.entity_id = source_entity_id LEFT JOIN entities t ON t.entity_id = target_entity_id GROUP BY 1, 2, 3""",
)
def relationship_ends(spark: SparkSession, folder: str) -> DataFrame:
    """Who acted on what, one relationship per event, by the kinds of both ends."""
    p = table(spark, folder, "participants").where("event_id is not null")
    one = lambda f, roles: f(F.when(F.col("role").isin(roles), F.col("entity_id")))
    rows = p.groupBy("event_id").agg(one(F.min, ["user", "actor"]).alias("source_entity_id"), one(F.max, ["resource", "device", "target"]).alias("target_entity_id"))
    ends = audit.resolved_ends(rows, table(spark, folder, "entities"))
    return ends.groupBy("source_kind", "target_kind", "dangling").agg(F.count("*").alias("n"))


def _point_sql(*columns: str) -> str:
    parts = " || chr(0) || ".join(f"coalesce('=' || {c}, '-')" for c in columns)
    return f"('0x' || substr(sha256({parts}), 1, 13))::BIGINT"


RECEIPT_COLUMNS = ["event_id", "typed_event_json", "support_ref"]
_RECEIPTS = f"SELECT lower(trim(relation_name)) AS part, count(*) AS n_rows, sum({_point_sql(*RECEIPT_COLUMNS)})::VARCHAR AS content FROM typed_events GROUP BY 1"


@REGISTRY.query("snapshot_receipts", _RECEIPTS)
def snapshot_receipts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.receipts(table(spark, folder, "typed_events"), relation_key("relation_name"), RECEIPT_COLUMNS)


@REGISTRY.query(
    "snapshot_admission",
    f"""WITH a AS (SELECT lower(trim(relation_name)) AS part, count(*) AS n, sum({_point_sql('event_id')}) AS h FROM typed_events GROUP BY 1),
    b AS (SELECT lower(trim(relation_name)) AS part, count(*) AS n, sum({_point_sql('event_id')}) AS h FROM base_occurrences GROUP BY 1)
    SELECT coalesce(a.part, b.part) AS part, CASE WHEN b.n IS NULL THEN 'not expected' WHEN a.n IS NULL THEN 'missing' WHEN a.n != b.n THEN 'row count differs' ELSE 'content differs' END AS problem
    FROM a FULL JOIN b ON a.part IS NOT DISTINCT FROM b.part WHERE a.n IS NULL OR b.n IS NULL OR a.n != b.n OR a.h != b.h""",
)
def snapshot_admission(spark: SparkSession, folder: str) -> DataFrame:
    """The events against the base ledger as the receipt they are held to."""
    sides = [audit.receipts(table(spark, folder, t), relation_key("relation_name"), ["event_id"]) for t in ("typed_events", "base_occurrences")]
    return audit.admission(*sides)


@REGISTRY.query(
    "index_state",
    f"""WITH t AS (SELECT doc_id, {tokens_sql('camel')} AS toks FROM documents), p AS (SELECT DISTINCT doc_id, unnest(toks) AS term FROM t)
    SELECT (SELECT count(*) FROM t) AS documents, (SELECT sum(len(toks))::BIGINT FROM t) AS tokens, (SELECT count(*) FROM p) AS postings, (SELECT count(DISTINCT term) FROM p) AS terms, 0::BIGINT AS problems""",
)
def index_state(spark: SparkSession, folder: str) -> DataFrame:
    """What the written index of the documents holds, and how many problems its verification finds."""
    found = index(spark, folder)
    counts = [found.table(t).agg(F.count("*").alias(n)) for t, n in (("postings", "postings"), ("terms", "terms"))]
    lengths = found.table("lengths").agg(F.count("*").alias("documents"), F.sum("doc_len").alias("tokens"))
    return lengths.crossJoin(counts[0]).crossJoin(counts[1]).withColumn("problems", F.lit(len(verify_index(spark, found.path))).cast("long"))  # one row each


@REGISTRY.query(
    "relation_geometry",
    _nn_sql("same", 10) + """, back AS (SELECT vec_id AS neighbour, neighbour AS vec_id, 1 AS b FROM nn), i AS (SELECT label, vec_id, avg(1 - similarity) AS i, count(b) / count(*)::DOUBLE AS r, count(*) AS k FROM nn LEFT JOIN back USING (vec_id, neighbour) GROUP BY 1, 2)
    SELECT label, count(*) AS documents, max(k) AS effective_k, round(avg(i), 6) AS mean_isolation, round(quantile_cont(i, 0.5), 6) AS median_isolation, round(quantile_cont(i, 0.9), 6) AS p90_isolation,
    round(quantile_cont(i, 0.99), 6) AS p99_isolation, round(avg(r), 6) AS reciprocal_rate FROM i GROUP BY 1""",
)
def relation_geometry(spark: SparkSession, folder: str) -> DataFrame:
    return geometry.relation_summary(_neighbours(spark, folder, 10, "same"), "vec_id", 10)


@REGISTRY.query("state_signatures")
def state_signatures(spark: SparkSession, folder: str) -> DataFrame:
    return derivations.state_signatures(spread(table(spark, folder, "typed_events")))


@REGISTRY.query("paired_bootstrap")
def paired_bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    """How much later the listed ranks of a query's commands are than those by distance, with an interval over queries."""
    rows = table(spark, folder, "candidate_rankings").where("query_id is not null and command_id is not null and rank is not null and distance_millionths between 0 and 2000000")
    best = rows.groupBy("query_id", "command_id").agg(F.min("rank").cast("double").alias("stale"), F.min("distance_millionths").alias("d"))
    pair = F.concat_ws(" ", "query_id", "command_id").alias("pair")
    left = best.select(pair, "query_id", F.col("stale").alias("v"))
    right = best.select(pair, F.round(F.col("d") / 1e6, 6).alias("v"))
    return evaluate.paired_bootstrap(left, right, "pair", "v", "query_id")


@REGISTRY.query(
    "run_summary",
    """WITH RECURSIVE l AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, coalesce(length(text), 0)::BIGINT AS n FROM documents),
    w AS (SELECT r, n, 0::BIGINT AS task, 1::BIGINT AS items, n AS total FROM l WHERE r = 1
      UNION ALL SELECT l.r, l.n, CASE WHEN w.total + l.n > 20000 OR w.items >= 64 THEN w.task + 1 ELSE w.task END, CASE WHEN w.total + l.n > 20000 OR w.items >= 64 THEN 1 ELSE w.items + 1 END,
        CASE WHEN w.total + l.n > 20000 OR w.items >= 64 THEN l.n ELSE w.total + l.n END FROM w JOIN l ON l.r = w.r + 1),
    t AS (SELECT task, count(*) AS items, sum(n)::BIGINT AS tokens FROM w GROUP BY 1)
    SELECT count(*) AS tasks, sum(items)::BIGINT AS items, sum(tokens)::BIGINT AS tokens, max(tokens) AS most_tokens, max(items) AS most_items, round(avg(tokens) / 20000, 6) AS fill FROM t""",
)
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A planned run in one row."""
    tasks = sampling.greedy_ranges(table(spark, folder, "documents").select("doc_id", F.length("text").alias("n")), "doc_id", "n", 20_000, 64)
    return tasks.agg(F.count("*").alias("tasks"), F.sum("items").alias("items"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("most_tokens"), F.max("items").alias("most_items"), F.round(F.avg("tokens") / 20_000, 6).alias("fill"))


@REGISTRY.query("parity_sample", "SELECT doc_id, row_number() OVER (ORDER BY sha256('parity' || chr(0) || doc_id), doc_id)::INT AS ordinal FROM documents WHERE doc_id IS NOT NULL QUALIFY ordinal <= 200")
def parity_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.min_k(table(spark, folder, "documents"), "doc_id", 200, "parity").select("doc_id", "ordinal")


@REGISTRY.query("projection_parity", "SELECT least(200, count(*)) AS sampled, least(200, count(*)) AS equal FROM documents WHERE text IS NOT NULL")
def projection_parity(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the row-wise and the column-wise redaction agree on a sample of smallest hashes."""
    few = sampling.min_k(table(spark, folder, "documents").where("text is not null"), "doc_id", 200, "parity").select("doc_id", "text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = projection.sanitizer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([one(t) for t in b.column(1).to_pylist()], pa.string())], ["doc_id", "text", "by_row"])

    both = few.mapInArrow(clean, "doc_id long, text string, by_row string")
    return both.agg(F.count("*").alias("sampled"), F.count_if(F.col("by_row") == tx.sanitize(F.col("text"))).alias("equal"))


@REGISTRY.query(
    "derived_vectors",
    """WITH p AS (SELECT vec_id, list_transform(embedding[1:32]::DOUBLE[], lambda x: x) AS h FROM embeddings), u AS (SELECT vec_id, list_transform(h, lambda x: (x / sqrt(list_dot_product(h, h)))::FLOAT::DOUBLE) AS u FROM p)
    SELECT vec_id, len(u)::INT AS dimensions, round(list_sum(u), 5) AS total, abs(sqrt(list_dot_product(u, u)) - 1) <= 1e-4 AS unit FROM u""",
)
def derived_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The vector set of the first 32 components, brought back to length 1."""
    short = table(spark, folder, "embeddings").select("vec_id", dense.prefix_unit(F.col("embedding"), 32).alias("u"))
    total = F.aggregate("u", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return short.select("vec_id", F.size("u").alias("dimensions"), F.round(total, 5).alias("total"), (F.abs(dense.norm(F.col("u")) - 1) <= 1e-4).alias("unit"))
