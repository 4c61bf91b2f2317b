"""Named queries of relevance evaluation and embedding geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vestigo.operators import dense, evaluate, geometry, ranking
from vestigo.registry import Registry
from vestigo.sources.tables import table

REGISTRY = Registry()

USABLE = "query_id IS NOT NULL AND command_id IS NOT NULL AND distance_millionths BETWEEN 0 AND 2000000"
COST = "CASE WHEN score_direction = 'higher_is_better' THEN -distance_millionths ELSE distance_millionths END"
RANKED = f"""WITH best AS (SELECT query_id, command_id, min({COST}) AS cost, max(pointer_resolved::INT + filter_compliant::INT + (distance_millionths % 3 = 0)::INT) AS grade FROM candidate_rankings WHERE {USABLE} GROUP BY 1, 2),
ranking AS (SELECT query_id, command_id, cost, row_number() OVER (PARTITION BY query_id ORDER BY cost, command_id) AS rank FROM best QUALIFY rank <= 20),
judgements AS (SELECT query_id, command_id, grade FROM best)"""


def _best(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "candidate_rankings").where(USABLE)
    cost, grade = F.expr(COST), F.expr("cast(pointer_resolved AS int) + cast(filter_compliant AS int) + cast(distance_millionths % 3 = 0 AS int)")
    return rows.groupBy("query_id", "command_id").agg(F.min(cost).alias("cost"), F.max(grade).alias("grade"))


def _ranking(best: DataFrame) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("cost", "command_id")
    return best.select("query_id", "command_id", "cost", F.row_number().over(w).alias("rank")).where("rank <= 20")


def metrics_sql(relevant: int) -> str:
    ks = (5, 10, 20)
    gain = "(power(2.0, grade) - 1) / log2(rank + 1.0)"
    return (
        """, j AS (SELECT r.query_id, r.rank, coalesce(g.grade, 0) AS grade FROM ranking r LEFT JOIN judgements g USING (query_id, command_id)),
    i AS (SELECT query_id, grade, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, command_id) AS rank FROM judgements WHERE grade > 0),
    got AS (SELECT query_id, """
        + ", ".join(f"sum(CASE WHEN rank <= {k} THEN {gain} ELSE 0 END) AS dcg{k}, count(*) FILTER (rank <= {k} AND grade >= {relevant}) AS hit{k}" for k in ks)
        + f""", min(rank) FILTER (grade >= {relevant}) AS first FROM j GROUP BY 1),
    ideal AS (SELECT query_id, """
        + ", ".join(f"sum(CASE WHEN rank <= {k} THEN {gain} ELSE 0 END) AS ideal{k}" for k in ks)
        + f""", count(*) FILTER (grade >= {relevant}) AS relevant FROM i GROUP BY 1)
    SELECT query_id, """
        + ", ".join(f"round(coalesce(coalesce(dcg{k}, 0) / nullif(ideal{k}, 0), 0), 6) AS ndcg_{k}, round(coalesce(hit{k}, 0) / nullif(relevant, 0)::DOUBLE, 6) AS recall_{k}" for k in ks)
        + ", round(coalesce(1.0::DOUBLE / first, 0), 6) AS reciprocal_rank FROM (SELECT DISTINCT query_id FROM judgements) LEFT JOIN got USING (query_id) LEFT JOIN ideal USING (query_id)"
    )


@REGISTRY.query("retrieval_metrics", RANKED + metrics_sql(2))
def retrieval_metrics(spark: SparkSession, folder: str) -> DataFrame:
    best = _best(spark, folder)
    return evaluate.retrieval_metrics(_ranking(best), best, "query_id", "command_id", relevant=2)


GROUPS = """, grp AS (SELECT document_id AS command_id, min(source) AS "group" FROM documents WHERE document_id IS NOT NULL GROUP BY 1)"""


@REGISTRY.query(
    "grouped_metrics",
    RANKED.replace("ranking AS", "ranking0 AS").replace("judgements AS", "judgements0 AS") + GROUPS + """,
    rg AS (SELECT r.*, g."group" FROM ranking0 r LEFT JOIN grp g USING (command_id)),
    rf AS (SELECT *, "group" IS NULL OR row_number() OVER (PARTITION BY query_id, "group" ORDER BY rank) = 1 AS first_hit FROM rg),
    ranking AS (SELECT query_id, command_id, rank FROM rf WHERE first_hit),
    jg AS (SELECT j.query_id, j.command_id, j.grade, coalesce(g."group", j.command_id) AS gg, row_number() OVER (PARTITION BY j.query_id, coalesce(g."group", j.command_id) ORDER BY j.grade DESC, j.command_id) AS n FROM judgements0 j LEFT JOIN grp g USING (command_id)),
    st AS (SELECT r.query_id, r.command_id AS kept, coalesce(g."group", r.command_id) AS gg FROM ranking r LEFT JOIN grp g USING (command_id)),
    judgements AS (SELECT query_id, coalesce(kept, command_id) AS command_id, grade FROM jg LEFT JOIN st USING (query_id, gg) WHERE n = 1)"""
    + metrics_sql(2),
)
def grouped_metrics(spark: SparkSession, folder: str) -> DataFrame:
    best = _best(spark, folder)
    groups = table(spark, folder, "documents").where("document_id is not null").groupBy(F.col("document_id").alias("command_id")).agg(F.min("source").alias("group"))
    kept, judged = evaluate.grouped_judgements(_ranking(best), best, "query_id", "command_id", groups)
    return evaluate.retrieval_metrics(kept, judged, "query_id", "command_id", relevant=2)


TRIPLETS = """, pos AS (SELECT query_id, min(command_id) AS positive FROM best WHERE grade = 3 GROUP BY 1), neg AS (SELECT query_id, command_id AS negative FROM best WHERE grade <= 1),
    tri AS (SELECT * FROM pos JOIN neg USING (query_id))"""


@REGISTRY.query(
    "hard_negative_triplets",
    RANKED + TRIPLETS + """, m AS (SELECT a.rank AS ra, b.rank AS rb, (-a.cost) - (-b.cost) AS margin FROM tri LEFT JOIN ranking a ON a.query_id = tri.query_id AND a.command_id = positive LEFT JOIN ranking b ON b.query_id = tri.query_id AND b.command_id = negative)
    SELECT count(*) AS triplets, count(*) FILTER (ra IS NOT NULL AND rb IS NOT NULL) AS covered, count(*) FILTER (ra < rb) AS ordered, round(quantile_cont(margin, 0.5) FILTER (ra IS NOT NULL AND rb IS NOT NULL), 6) AS median_margin FROM m""",
)
def hard_negative_triplets(spark: SparkSession, folder: str) -> DataFrame:
    best = _best(spark, folder)
    positive = best.where("grade = 3").groupBy("query_id").agg(F.min("command_id").alias("positive"))
    triplets = positive.join(best.where("grade <= 1").select("query_id", F.col("command_id").alias("negative")), "query_id")
    scored = _ranking(best).withColumn("score", -F.col("cost"))
    return evaluate.hard_negatives(scored, triplets, "query_id", "positive", "negative", "command_id")


MACRO = "WITH m AS (" + RANKED + metrics_sql(2) + ")"


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval_metrics(spark, folder).withColumn("cohort", F.right("query_id", F.lit(1)))


@REGISTRY.query("macro_rollup", MACRO + ", c AS (SELECT right(query_id, 1) AS cohort, avg(ndcg_10) AS v FROM (SELECT query_id, avg(ndcg_10) AS ndcg_10 FROM m GROUP BY 1) GROUP BY 1) SELECT round(avg(v), 6) AS ndcg_10, count(*) AS groups FROM c")
def macro_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.macro(_metrics(spark, folder), ["cohort", "query_id"], "ndcg_10")


@REGISTRY.query("bootstrap_ci")
def bootstrap_ci(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.bootstrap(_metrics(spark, folder), "cohort", "ndcg_10")


@REGISTRY.query(
    "promotion_gates",
    MACRO + """, v AS (SELECT round(avg(ndcg_10), 6) AS ndcg, round(avg(recall_20), 6) AS recall, round(avg(reciprocal_rank), 6) AS mrr FROM m)
    SELECT 'ndcg' AS gate, ndcg AS value, 0.5::DOUBLE AS threshold, ndcg >= 0.5 AS passed FROM v UNION ALL SELECT 'recall', recall, 0.9, recall >= 0.9 FROM v UNION ALL SELECT 'mrr', mrr, 0.4, mrr >= 0.4 FROM v""",
)
def promotion_gates(spark: SparkSession, folder: str) -> DataFrame:
    m = _metrics(spark, folder)
    values = m.agg(F.round(F.avg("ndcg_10"), 6).alias("ndcg"), F.round(F.avg("recall_20"), 6).alias("recall"), F.round(F.avg("reciprocal_rank"), 6).alias("mrr"))
    return evaluate.gates(values, {"ndcg": 0.5, "recall": 0.9, "mrr": 0.4})


@REGISTRY.query(
    "paired_deltas",
    RANKED.replace("WITH best", "WITH listed AS (SELECT query_id, command_id, min(rank) AS stale FROM candidate_rankings WHERE query_id IS NOT NULL AND command_id IS NOT NULL AND rank IS NOT NULL GROUP BY 1, 2), best")
    + """, a AS (SELECT query_id || ' ' || command_id AS pair, stale FROM listed), b AS (SELECT query_id || ' ' || command_id AS pair, rank FROM ranking)
    SELECT pair, round((rank - stale)::DOUBLE, 6) AS delta FROM a JOIN b USING (pair)""",
)
def paired_deltas(spark: SparkSession, folder: str) -> DataFrame:
    pair = F.concat_ws(" ", "query_id", "command_id").alias("pair")
    rows = table(spark, folder, "candidate_rankings").where("query_id is not null and command_id is not null and rank is not null")
    stale = rows.groupBy("query_id", "command_id").agg(F.min("rank").cast("double").alias("v")).select(pair, "v")
    now = _ranking(_best(spark, folder)).select(pair, F.col("rank").cast("double").alias("v"))
    return evaluate.paired_deltas(stale, now, "pair", "v")


@REGISTRY.query(
    "rank_audit",
    """SELECT query_id, count(*) AS n_rows, count(DISTINCT command_id) AS items, count(*) FILTER (rank IS NULL) AS no_rank,
    coalesce(count(*) FILTER (rank IS NULL) = 0 AND min(rank) = 1 AND max(rank) = count(*) AND count(DISTINCT rank) = count(*), FALSE) AS contiguous FROM candidate_rankings GROUP BY 1""",
)
def rank_audit(spark: SparkSession, folder: str) -> DataFrame:
    got = ranking.rank_audit(table(spark, folder, "candidate_rankings"), "query_id", "command_id")
    return got.withColumn("contiguous", F.coalesce("contiguous", F.lit(False)))


SIM = "round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9)"


def _neighbours(spark: SparkSession, folder: str, k: int, scope: str) -> DataFrame:
    return dense.exact_neighbours(table(spark, folder, "embeddings"), "vec_id", "embedding", "label", k, scope)


def _nn_sql(scope: str, k: int) -> str:
    cond = {"same": "AND a.label = b.label", "other": "AND a.label != b.label", "all": ""}[scope]
    return f"""WITH nn AS (SELECT a.vec_id, a.label, b.vec_id AS neighbour, b.label AS neighbour_label, {SIM} AS similarity,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) DESC, b.vec_id)::INT AS rank FROM embeddings a, embeddings b WHERE a.vec_id != b.vec_id {cond} QUALIFY rank <= {k}) """


@REGISTRY.query("knn_same_label", _nn_sql("same", 10) + "SELECT * FROM nn")
def knn_same_label(spark: SparkSession, folder: str) -> DataFrame:
    return _neighbours(spark, folder, 10, "same")


@REGISTRY.query("nearest_other_label", _nn_sql("other", 1) + "SELECT * FROM nn")
def nearest_other_label(spark: SparkSession, folder: str) -> DataFrame:
    return _neighbours(spark, folder, 1, "other")


@REGISTRY.query("confusion_matrix", _nn_sql("all", 1) + "SELECT label, neighbour_label, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY label), 6) AS share FROM nn GROUP BY 1, 2")
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return geometry.confusion(_neighbours(spark, folder, 1, "all"))


@REGISTRY.query(
    "isolation_mad",
    _nn_sql("same", 10) + """, x AS (SELECT label, vec_id, 1 - similarity AS distance FROM nn WHERE rank = 10), m AS (SELECT label, quantile_cont(distance, 0.5) AS med FROM x GROUP BY 1),
    d AS (SELECT x.*, med, abs(distance - med) AS off FROM x JOIN m USING (label)), a AS (SELECT label, quantile_cont(off, 0.5) AS mad FROM d GROUP BY 1)
    SELECT label, vec_id, round(distance, 6) AS distance, round(CASE WHEN mad > 0 THEN 0.6745::DOUBLE * (distance - med) / mad END, 4) AS isolation, CASE WHEN mad > 0 THEN 'scored' ELSE 'zero_mad' END AS status FROM d JOIN a USING (label)""",
)
def isolation_mad(spark: SparkSession, folder: str) -> DataFrame:
    rows = _neighbours(spark, folder, 10, "same").where("rank = 10").select("label", "vec_id", (1 - F.col("similarity")).alias("distance"))
    return geometry.robust_isolation(rows, "label", "vec_id", "distance")


CENTROID = """WITH p AS (SELECT unnest(range(1, 65)) AS i), c AS (SELECT i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, p GROUP BY 1), n AS (SELECT list(m ORDER BY i) AS v FROM c),
u AS (SELECT list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM n), dist AS (SELECT vec_id, label, round(1 - list_dot_product(embedding::DOUBLE[], u), 6) AS distance FROM embeddings, u) """


@REGISTRY.query("centroid_outliers", CENTROID + "SELECT vec_id, distance FROM dist ORDER BY distance DESC, vec_id LIMIT 12")
def centroid_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return geometry.centroid_distances(table(spark, folder, "embeddings"), "vec_id", "embedding").orderBy(F.desc("distance"), "vec_id").limit(12)


@REGISTRY.query(
    "rank_percentile",
    CENTROID + ", r AS (SELECT vec_id, rank() OVER (ORDER BY distance) AS low, count(*) OVER (PARTITION BY distance) AS ties, count(*) OVER () AS n FROM dist) SELECT vec_id, round((low + (ties - 1) / 2.0::DOUBLE) / n * 100, 6) AS percentile FROM r",
)
def rank_percentile(spark: SparkSession, folder: str) -> DataFrame:
    return geometry.average_rank_percentile(geometry.centroid_distances(table(spark, folder, "embeddings"), "vec_id", "embedding"), "vec_id", "distance")


@REGISTRY.query(
    "weighted_sensitivity",
    CENTROID + """SELECT coalesce(label, -1) AS label, CASE WHEN grouping(label) = 1 THEN 'all' ELSE 'group' END AS scope, count(*) AS n, round(sum(distance) / count(*), 6) AS by_document, round(sum(distance * (vec_id % 7 + 1)) / sum(vec_id % 7 + 1), 6) AS by_occurrence,
    round(sum(distance * (1.0::DOUBLE / (vec_id % 5 + 1))) / sum(1.0::DOUBLE / (vec_id % 5 + 1)), 6) AS by_inverse, round(sum(distance * ((vec_id % 7 + 1) / (vec_id % 5 + 1)::DOUBLE)) / sum((vec_id % 7 + 1) / (vec_id % 5 + 1)::DOUBLE), 6) AS by_both FROM dist GROUP BY GROUPING SETS ((label), ())""",
)
def weighted_sensitivity(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings")
    rows = geometry.centroid_distances(e, "vec_id", "embedding").join(e.select("vec_id", "label"), "vec_id")
    weights = {"by_document": "1", "by_occurrence": "vec_id % 7 + 1", "by_inverse": "1.0D / (vec_id % 5 + 1)", "by_both": "(vec_id % 7 + 1) / (vec_id % 5 + 1)"}
    return geometry.weighted_means(rows, "label", "distance", weights)


@REGISTRY.query(
    "lof",
    _nn_sql("all", 20) + """, d AS (SELECT vec_id AS a, neighbour AS b, greatest(1 - similarity, 1e-12) AS d FROM nn), k AS (SELECT a AS b, max(d) AS kd FROM d GROUP BY 1),
    l AS (SELECT a, 1 / avg(greatest(d, kd)) AS lrd FROM d JOIN k USING (b) GROUP BY 1), m AS (SELECT d.a, avg(o.lrd) AS m FROM d JOIN l o ON o.a = d.b GROUP BY 1)
    SELECT a AS vec_id, round(m / lrd, 4) AS lof FROM m JOIN l USING (a)""",
)
def lof(spark: SparkSession, folder: str) -> DataFrame:
    return geometry.local_outlier_factor(_neighbours(spark, folder, 20, "all"), "vec_id")


@REGISTRY.query("pca")
def pca(spark: SparkSession, folder: str) -> DataFrame:
    return geometry.principal_components(table(spark, folder, "embeddings"), "vec_id", "embedding", 3)
