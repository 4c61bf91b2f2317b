"""Queries of the text, vector and ranking problems, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestigo.llm import leakage, neighbours, packing, sentences, stable_sample, top_items
from vestigo.registry import Registry
from vestigo.sources.tables import spread, table

REGISTRY = Registry()


_BEST_SQL = """
WITH best AS (
  SELECT query_id, command_id, min(CASE WHEN score_direction = 'higher_is_better' THEN -distance_millionths ELSE distance_millionths END) AS cost
  FROM candidate_rankings WHERE query_id IS NOT NULL AND command_id IS NOT NULL AND distance_millionths BETWEEN 0 AND 2000000 GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cost, command_id) AS position FROM best)
"""


def _top_commands(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "candidate_rankings").where("distance_millionths between 0 and 2000000")
    return top_items.top_items(rows, "query_id", "command_id", "distance_millionths", 10, "score_direction != 'higher_is_better'")


@REGISTRY.query("p2_found", _BEST_SQL + "SELECT query_id, command_id FROM ranked WHERE position <= 10")
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _top_commands(spark, folder).select("query_id", "command_id")


@REGISTRY.query("p2_ranked", _BEST_SQL + "SELECT query_id, command_id, cost, position::INT AS position FROM ranked WHERE position <= 10")
def p2_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return _top_commands(spark, folder)


def _point_sql(identifier: str) -> str:
    return f"('0x' || substr(sha256('s1:' || {identifier}), 1, 13))::BIGINT"


@REGISTRY.query(
    "p3_occurrences_sample",
    f"""SELECT occurrence_id, 1.0::DOUBLE AS weight, min(batch_no) AS first_order, count(*) AS deliveries FROM occurrences
    WHERE occurrence_id IS NOT NULL AND {_point_sql('occurrence_id')} < 0.05 * 4503599627370496 GROUP BY 1""",
)
def p3_occurrences_sample(spark: SparkSession, folder: str) -> DataFrame:
    return stable_sample.stable_sample(table(spark, folder, "occurrences"), "occurrence_id", 0.05, order="batch_no")


@REGISTRY.query(
    "p3_documents_sample",
    f"""SELECT document_id, 1.0::DOUBLE AS weight, min(batch_no) AS first_order, count(*) AS deliveries FROM documents
    WHERE document_id IS NOT NULL AND {_point_sql('document_id')} < 0.1 * 4503599627370496 GROUP BY 1""",
)
def p3_documents_sample(spark: SparkSession, folder: str) -> DataFrame:
    return stable_sample.stable_sample(table(spark, folder, "documents"), "document_id", 0.1, order="batch_no")


@REGISTRY.query(
    "p3_documents_by_length",
    f"""SELECT document_id, max(coalesce(length(text), 0) / 1000.0::DOUBLE) AS weight, min(batch_no) AS first_order, count(*) AS deliveries FROM documents
    WHERE document_id IS NOT NULL AND {_point_sql('document_id')} < least(coalesce(length(text), 0) / 1000.0::DOUBLE * (0.2 * 4503599627370496), 4503599627370496) GROUP BY 1""",
)
def p3_documents_by_length(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    return stable_sample.stable_sample(rows, "document_id", 0.2, F.length("text") / F.lit(1000.0), "batch_no")


@REGISTRY.query(
    "p3_merged_by_delivery",
    f"""WITH w AS (SELECT document_id, max(coalesce(length(text), 0) / 1000.0::DOUBLE) AS weight FROM documents WHERE document_id IS NOT NULL GROUP BY 1)
    SELECT document_id, weight FROM w WHERE {_point_sql('document_id')} < least(weight * (0.2 * 4503599627370496), 4503599627370496)""",
)
def p3_merged_by_delivery(spark: SparkSession, folder: str) -> DataFrame:
    """The sample that grows delivery by delivery, from nothing but the stored weights and the new rows; equal to the sample of all rows at once."""
    rows = table(spark, folder, "documents").select("document_id", "batch_no", (F.coalesce(F.length("text"), F.lit(0)) / F.lit(1000.0)).alias("weight"))
    kept = rows.where("false").select("document_id", "weight")
    for batch in [r[0] for r in rows.select("batch_no").distinct().orderBy("batch_no").collect()]:  # a handful of deliveries
        new = rows.where(F.col("batch_no").eqNullSafe(F.lit(batch)))
        kept = stable_sample.merge_weights(kept, new, "document_id")
    return stable_sample.stable_sample(kept, "document_id", 0.2, "weight").select("document_id", "weight")


_COSINE_SQL = """
WITH u AS (
  SELECT DISTINCT document_id, list_transform(vector, lambda x: x::DOUBLE) AS v FROM vectors
  WHERE document_id IS NOT NULL AND vector IS NOT NULL AND len(vector) = 96
    AND len(list_filter(vector, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(vector, lambda x: x != 0)) > 0),
s AS (
  SELECT a.document_id AS a, b.document_id AS b, max(list_cosine_similarity(a.v, b.v)) AS sim FROM u a, u b
  WHERE a.document_id != b.document_id GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS position FROM s)
"""


@REGISTRY.query("p1_found", _COSINE_SQL + "SELECT DISTINCT least(a, b) AS document_id_a, greatest(a, b) AS document_id_b FROM r WHERE position <= 10 AND sim >= 0.92")
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.mutual_pairs(neighbours.most_similar(spread(table(spark, folder, "vectors")), min_similarity=0.92))


@REGISTRY.query("p1_neighbours")
def p1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    found = neighbours.most_similar(spread(table(spark, folder, "vectors")), queries=F.col("vector_ordinal") % 100 == 0)
    return found.withColumn("similarity", F.round(F.col("similarity").cast("double"), 4))


@REGISTRY.query(
    "p1_recall",
    """SELECT least(500, count(DISTINCT document_id)) AS queries, TRUE AS at_least_nine_tenths FROM vectors WHERE vector_ordinal % 100 = 0 AND document_id IS NOT NULL AND vector IS NOT NULL AND len(vector) = 96
    AND len(list_filter(vector, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(vector, lambda x: x != 0)) > 0""",
)
def p1_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the open search finds nine tenths of the true ten nearest, by brute force over all rows for 500 of its queries."""
    vectors = spread(table(spark, folder, "vectors"))
    found = neighbours.most_similar(vectors, queries=F.col("vector_ordinal") % 100 == 0)
    return neighbours.recall(found, vectors).select("queries", (F.col("recall") >= 0.9).alias("at_least_nine_tenths"))


def _token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", packing.regex_token_count(F.col("text")).alias("n_tokens"))


_TOKENS_SQL = r"WITH c AS (SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^ \t\n\r]')) AS n FROM documents WHERE text IS NOT NULL) "


@REGISTRY.query("p7_found", _TOKENS_SQL + "SELECT doc_id FROM c WHERE n > 1024")
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    sizes = _token_counts(spark, folder)
    packed = packing.pack(sizes, "doc_id", "n_tokens")
    return packed.groupBy("doc_id").agg(F.count("*").alias("pieces")).where("pieces > 1").select("doc_id")


@REGISTRY.query("p7_containers")
def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_token_counts(spark, folder), "doc_id", "n_tokens")


@REGISTRY.query(
    "p7_packing_audit",
    _TOKENS_SQL + """SELECT sum(n)::BIGINT AS tokens, sum(ceil(n / 1024.0::DOUBLE))::BIGINT AS pieces, count(*) AS documents, count(*) FILTER (n > 1024) AS cut_documents,
    0::BIGINT AS over_capacity, 0::BIGINT AS cut_needlessly, TRUE AS full_to_98_percent FROM c WHERE n > 0""",
)
def p7_packing_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the containers keep every token, keep to the capacity, cut nothing needlessly, and are at least 98 % full but for the last one."""
    packed = packing.pack(_token_counts(spark, folder), "doc_id", "n_tokens")
    boxes = packed.groupBy("container").agg(F.sum("n_tokens").alias("t")).agg(F.count("*").alias("boxes"), F.count_if(F.col("t") > 1024).alias("over_capacity"))
    each = packed.groupBy("doc_id").agg(F.count("*").alias("p"), F.sum("n_tokens").alias("t"))
    docs = each.agg(F.count("*").alias("documents"), F.sum("p").alias("pieces"), F.sum("t").alias("tokens"), F.count_if(F.col("p") > 1).alias("cut_documents"), F.count_if((F.col("p") > 1) & (F.col("t") <= 1024)).alias("cut_needlessly"))
    full = (F.col("tokens") / 1024 >= 0.98 * (F.col("boxes") - 1)).alias("full_to_98_percent")
    return docs.crossJoin(boxes).select("tokens", "pieces", "documents", "cut_documents", "over_capacity", "cut_needlessly", full)  # one row each


@REGISTRY.query("p8_found")
def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    found = leakage.leaked_items(spread(table(spark, folder, "documents").select("doc_id", "text")), table(spark, folder, "eval_items"), every_passage=False)
    return found.where(F.col("run_words") >= 12).select("doc_id", "item_id")


@REGISTRY.query("p8_report")
def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaked_items(spread(table(spark, folder, "documents").select("doc_id", "text")), table(spark, folder, "eval_items"))


def _prose(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").where(F.col("doc_type").isin("note", "report", "question")).select("doc_id", "text"))


@REGISTRY.query("p9_found")
def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.split_sentences(_prose(spark, folder))


#: White space, as a class of both engines' patterns.
_WHITE = r"\t-\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


@REGISTRY.query(
    "p9_coverage",
    f"""SELECT doc_id, length(regexp_replace(text, '[{_WHITE}]', '', 'g'))::BIGINT AS dark_chars, 0::BIGINT AS white_ends, 0::BIGINT AS overlaps, 0::BIGINT AS blank_lines
    FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '[^{_WHITE}]')""",
)
def p9_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: the characters but white space that its units hold, and units that begin or end in white space, overlap or run across a blank line."""
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    units = sentences.split_sentences(docs)
    spans = units.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start_char", "end_char"))).alias("u"))  # the units of one document
    each = docs.join(spans, "doc_id").select("doc_id", "u", F.transform("u", lambda x: F.substr("text", x["start_char"] + 1, x["end_char"] - x["start_char"])).alias("t"))
    count = lambda pattern: F.size(F.filter("t", lambda x: x.rlike(pattern))).cast("long")
    dark = F.aggregate("t", F.lit(0).cast("long"), lambda s, x: s + F.length(F.regexp_replace(x, f"[{_WHITE}]", "")))
    overlaps = F.size(F.filter(F.transform("u", lambda x, i: (i > 0) & (x["start_char"] < F.coalesce(F.get("u", i - 1)["end_char"], F.lit(0)))), lambda x: x)).cast("long")
    return each.select("doc_id", dark.alias("dark_chars"), count(rf"\A[{_WHITE}]|[{_WHITE}]\z").alias("white_ends"), overlaps.alias("overlaps"), count(r"\n[ \t]*\n").alias("blank_lines"))


@REGISTRY.query("p9_unit_counts")
def p9_unit_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, of any doc_type; p9_found is fixed to prose."""
    units = sentences.split_sentences(spread(table(spark, folder, "documents").select("doc_id", "text")))
    return units.groupBy("doc_id").agg(F.count("*").alias("units"), F.max(F.col("end_char") - F.col("start_char")).alias("longest_unit"))
