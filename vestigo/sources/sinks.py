"""Parquet, JSON lines and index sinks. Nothing is overwritten; a folder without _SUCCESS isn't complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in a file of documents or occurrences.
SHARD_ROWS = 8192


def write_documents(documents: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    documents.repartitionByRange("document_id").sortWithinPartitions("document_id").write.mode("errorifexists").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_occurrences(occurrences: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """By relation, sorted by document within files. Rows are spread by relation and document, so a large relation has many writers."""
    spread = occurrences.repartition("relation_name", "document_id").sortWithinPartitions("relation_name", "document_id")
    spread.write.mode("errorifexists").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy("relation_name").parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("compression", "gzip").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines by a fixed schema; a line that isn't such an object is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def cached_embeddings(documents: DataFrame, cache: DataFrame, embed, key: str = "text_sha256", text: str = "text") -> DataFrame:
    """(key, vector) for every distinct text: from the cache where it is, else from ``embed``, a mapInPandas function over (key, text)."""
    wanted = documents.where(F.col(text).isNotNull()).select(F.sha2(F.col(text), 256).alias(key), text).dropDuplicates([key])
    fresh = wanted.join(cache.select(key), key, "left_anti").mapInPandas(embed, f"{key} string, vector array<float>")
    return cache.select(key, "vector").join(wanted.select(key), key, "left_semi").unionByName(fresh)


def read_canonical_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines of JSON files, each an object with sorted keys and no blanks outside texts; any other line is an error."""
    import json
    from collections.abc import Iterator

    import pyarrow as pa

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for line in b.column(0).to_pylist():
                o = json.loads(line)
                if not isinstance(o, dict) or json.dumps(o, sort_keys=True, separators=(",", ":"), ensure_ascii=False) != line:
                    raise ValueError(f"not canonical: {line[:80]}")
            yield b

    return spark.read.text(path).select("value").mapInArrow(check, "value string")
