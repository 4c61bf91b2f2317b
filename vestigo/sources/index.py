"""A written search index: postings, lengths, statistics and vectors.

An index is built once for a state of its tables and then only read. Postings
lie in files by hash of the term, so a query's filter on the bucket prunes all
but a few files; a term's statistics and the corpus' size and mean length
stand in small tables of their own, so no query touches the corpus. A folder
is complete when its manifest is there, which is written last.
"""

from __future__ import annotations

import hashlib
import json
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vestigo.functions.text import TOKENIZERS
from vestigo.operators import lexical
from vestigo.session import shared_folder

#: Tokens of a folder of postings, and folders at most; a query reads as many folders as it has terms, or fewer.
BUCKET_TOKENS, MOST_BUCKETS = 4_000_000, 4_096
MANIFEST = "manifest.json"
#: Changes with what is written, so that no other version's index is opened.
FORMAT = 3
TABLES = ("postings", "terms", "lengths", "corpus")


class Files:
    """The few file system calls an index needs, on whatever file system the folder is on."""

    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.jvm = jvm

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def state(self, path: str) -> list[tuple[str, int, int]]:
        """(name, bytes, time of change) of the data files of a table, in order."""
        p = self.path(path)
        if not self.fs.exists(p):
            return []
        found = self.fs.listFiles(p, True)
        out = []
        while found.hasNext():
            f = found.next()
            if not f.getPath().getName().startswith(("_", ".")):
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return sorted(out)

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The whole text or nothing: it is written beside its place and renamed."""
        aside = f"{path}.{hashlib.sha256(text.encode()).hexdigest()[:12]}.tmp"
        stream = self.fs.create(self.path(aside), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(self.path(aside), self.path(path)):
            self.fs.delete(self.path(aside), False)

    def rename(self, a: str, b: str) -> bool:
        """Whether the folder is at its new place now; another writer may have been first."""
        moved = not self.exists(b) and self.fs.rename(self.path(a), self.path(b))
        if not moved:
            self.fs.delete(self.path(a), True)
        return moved

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(term), F.lit(buckets)).cast("int")


def term_counts(rows: DataFrame, tokens: str) -> DataFrame:
    """``rows`` with (term, tf) for every distinct token instead of the array, by the runs of equal tokens in order: a document is counted where it stands, without an exchange."""
    keep = [c for c in rows.columns if c != tokens]
    ordered = rows.where(F.size(tokens) > 0).withColumn("_s", F.array_sort(tokens))
    begins = F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    runs = F.transform("_b", lambda at, j: F.struct(F.get("_s", at).alias("term"), (F.coalesce(F.get("_b", j + 1), F.size("_s")) - at).alias("tf")))
    return ordered.withColumn("_b", begins).select(*keep, F.explode(runs).alias("_p")).select(*keep, "_p.term", "_p.tf")


def write_index(documents: DataFrame, path: str, identifier: str = "document_id", text: str = "text", tokenizer: str = "camel", keep: tuple[str, ...] = (), by: str | None = None) -> None:
    """The tables of an index and its manifest.

    Postings carry their document's length and its ``keep`` columns, so
    scoring and filtering need no join with the documents. Null texts have no
    postings and a length of 0. ``by``: statistics for each value of this
    column, as if each were an index of its own; rows where it is null are
    left out.
    """
    spark = documents.sparkSession
    tokens = TOKENIZERS[tokenizer](F.coalesce(F.col(text), F.lit("")))
    group = F.lit("") if by is None else F.col(by).cast("string")
    rows = documents.select(F.col(identifier).alias("_id"), group.alias("_by"), *keep, tokens.alias("_t")).where("_by is not null")
    schemas: dict[str, StructType] = {}

    def put(name: str, df: DataFrame, bucketed: bool = False) -> DataFrame:
        """Writes a table, and reads it from there."""
        names = [c for c in df.columns if c != "bucket"] + ["bucket"] * bucketed
        schemas[name] = df.select(*names).schema
        out = df.write.mode("errorifexists")
        (out.partitionBy("bucket") if bucketed else out).parquet(f"{path}/{name}")
        return spark.read.schema(schemas[name]).parquet(f"{path}/{name}")

    own = ["_id", "_by", *keep, "doc_len"]
    counted = rows.withColumn("doc_len", F.size("_t"))
    lengths = put("lengths", counted.select(*own))
    corpus = put("corpus", lengths.groupBy("_by").agg(F.count("*").alias("n_docs"), F.sum("doc_len").alias("n_tokens")))
    total = corpus.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    buckets = int(min(MOST_BUCKETS, max(1, total[1] // BUCKET_TOKENS)))
    each = term_counts(counted.select(*own, "_t"), "_t")
    # a frequent term is spread over several files of its bucket
    placed = each.withColumn("bucket", term_bucket(F.col("term"), buckets)).repartition("bucket", F.pmod(F.xxhash64("_id"), F.lit(4)))
    postings = put("postings", placed.sortWithinPartitions("bucket", "term"), True)
    terms = postings.groupBy("bucket", "_by", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    put("terms", terms.repartition("bucket").sortWithinPartitions("bucket", "term"), True)
    files = Files(spark, path)
    said = {
        "tokenizer": tokenizer,
        "identifier": identifier,
        "n_docs": total[0],
        "n_tokens": total[1],
        "by": by,
        "keep": list(keep),
        "buckets": buckets,
        "schemas": {t: schemas[t].jsonValue() for t in TABLES},
        "rows": {t: spark.read.schema(schemas[t]).parquet(f"{path}/{t}").count() for t in TABLES},
        "files": {t: len(files.state(f"{path}/{t}")) for t in TABLES},
    }
    files.write(f"{path}/{MANIFEST}", json.dumps(said, sort_keys=True))


def verify_index(spark: SparkSession, path: str) -> list[str]:
    """What is wrong with an index; empty if it may be used."""
    files = Files(spark, path)
    if not files.exists(f"{path}/{MANIFEST}"):
        return ["no manifest"]
    said = json.loads(files.read(f"{path}/{MANIFEST}"))
    wrong = [f"{t}: {len(files.state(f'{path}/{t}'))} files, {n} expected" for t, n in said["files"].items() if len(files.state(f"{path}/{t}")) != n]
    if wrong:
        return wrong
    held = {t: Index(spark, path).table(t) for t in TABLES}
    wrong = [f"{t}: {held[t].count()} rows, {n} expected" for t, n in said["rows"].items() if held[t].count() != n]
    sums = held["postings"].groupBy("_id", "doc_len").agg(F.sum("tf").alias("n")).where("n != doc_len").limit(1).count()
    if sums:
        wrong.append("postings: a document's term counts don't add up to its length")
    orphans = held["postings"].select("_id").distinct().join(held["lengths"], "_id", "left_anti").limit(1).count()
    if orphans:
        wrong.append("postings: a document without a length")
    return wrong


class Index:
    """An open index; opening reads the manifest only, and queries read what their terms and filters ask for."""

    def __init__(self, spark: SparkSession, path: str):
        files = Files(spark, path)
        if not files.exists(f"{path}/{MANIFEST}"):
            raise FileNotFoundError(f"no complete index at {path}")
        said = json.loads(files.read(f"{path}/{MANIFEST}"))
        self.spark, self.path, self.tokenizer, self.by = spark, path, said["tokenizer"], said["by"]
        self.n_docs, self.mean = said["n_docs"], max(1.0, said["n_tokens"] / said["n_docs"]) if said["n_docs"] else 1.0
        self.keep, self.buckets = said["keep"], said["buckets"]
        self._schemas, self._tables = said["schemas"], {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.schema(StructType.fromJson(self._schemas[name])).parquet(f"{self.path}/{name}")
        return self._tables[name]

    def of_terms(self, name: str, terms: list[str]) -> DataFrame:
        """Rows of postings or terms of some terms: their buckets only, sorted by term within files."""
        buckets = sorted({zlib.crc32(t.encode()) % self.buckets for t in terms})
        return self.table(name).where(F.col("bucket").isin(buckets) & F.col("term").isin(terms)).drop("bucket")

    def scores(self, query: str, identifier: str, where: Column | None = None, allowed: DataFrame | None = None, scope: str = "corpus", repeat_terms: bool = False, keep_zero: bool = False) -> DataFrame:
        """(identifier, score), and the index's ``by`` column if it has one; equal to ``lexical.bm25_scan``.

        ``identifier`` names the index's own identifier, or a kept column that
        is as unique.
        ``where`` (over the kept columns) and ``allowed`` (a frame of
        identifiers) say which documents may come out. ``scope`` 'eligible'
        takes statistics over the documents that pass ``where`` only.
        """
        own = F.col(identifier if identifier in self.keep else "_id")
        asked = lexical.tokenize_query(query, self.tokenizer)
        weights = {t: asked.count(t) if repeat_terms else 1 for t in sorted(set(asked))}
        hits = self.of_terms("postings", list(weights))
        lengths = self.table("lengths")
        if where is not None:
            hits, lengths = hits.where(where), lengths.where(where)
        df = F.col("df")
        if scope == "eligible":
            terms = hits.groupBy("term").agg(F.count("*").alias("df"))
        else:
            terms = self.of_terms("terms", list(weights)).select("term", "df", *(["_by"] if self.by else []))
        hits = hits.join(F.broadcast(terms), ["term", "_by"] if self.by else "term")  # a row per query term (and group)
        n, mean = F.lit(float(self.n_docs)), F.lit(self.mean)
        if scope == "eligible" or self.by:
            sizes = lengths.groupBy(F.lit("").alias("_by")).agg(F.count("*").alias("n_docs"), F.sum("doc_len").alias("n_tokens")) if scope == "eligible" else self.table("corpus")
            hits = hits.join(F.broadcast(sizes), "_by")  # a row, or one per group
            n, mean = F.col("n_docs").cast("double"), F.greatest(F.col("n_tokens") / F.col("n_docs"), F.lit(1.0))
        if allowed is not None:
            few = allowed.select(F.col(identifier).alias("_allowed"))
            hits = hits.join(few, own == F.col("_allowed"), "left_semi")
        tf, weight = F.col("tf"), F.lit(1.0)
        for t, w in weights.items():
            weight = weight if w == 1 else F.when(F.col("term") == t, float(w)).otherwise(weight)
        part = weight * lexical._idf(n, df) * (tf * (lexical.K1 + 1)) / (tf + lexical.K1 * (1 - lexical.B + lexical.B * F.col("doc_len") / mean))
        keys = [own.alias(identifier), *([F.col("_by").alias(self.by)] if self.by else [])]
        scored = hits.groupBy(*keys).agg(F.sum(part).alias("score"))
        if not keep_zero:
            return scored
        every = lengths.select(own.alias(identifier))
        return every.join(scored, identifier, "left").select(identifier, F.coalesce("score", F.lit(0.0)).alias("score"))


    def batch_scores(self, queries: list[tuple[object, str]], identifier: str) -> DataFrame:
        """(query_id, identifier, score), and the ``by`` column if there is one, for a stated set of queries at once; each term of a query counts once."""
        asked = sorted({(k, t) for k, q in queries for t in lexical.tokenize_query(q, self.tokenizer)}, key=str)
        kind = "bigint" if all(isinstance(k, int) for k, _ in asked) else "string"
        book = self.spark.createDataFrame(asked, f"query_id {kind}, term string")
        terms = self.of_terms("terms", sorted({t for _, t in asked})).select("term", "_by", "df").join(self.table("corpus"), "_by")
        weights = terms.withColumn("_idf", lexical._idf(F.col("n_docs").cast("double"), F.col("df"))).withColumn("_mean", F.greatest(F.col("n_tokens") / F.col("n_docs"), F.lit(1.0)))
        hits = self.of_terms("postings", sorted({t for _, t in asked})).join(F.broadcast(weights), ["term", "_by"]).join(F.broadcast(book), "term")
        tf = F.col("tf")
        part = F.col("_idf") * (tf * (lexical.K1 + 1)) / (tf + lexical.K1 * (1 - lexical.B + lexical.B * F.col("doc_len") / F.col("_mean")))
        keys = ["query_id", F.col("_id").alias(identifier), *([F.col("_by").alias(self.by)] if self.by else [])]
        return hits.groupBy(*keys).agg(F.sum(part).alias("score"))


def index_of(documents: DataFrame, tables: list[str], identifier: str, text: str = "text", tokenizer: str = "camel", keep: tuple[str, ...] = (), by: str | None = None) -> Index:
    """The index of a frame over the table files ``tables``, built if there is none for their present state.

    Indexes lie in the shared folder under a digest of the files' names, sizes
    and times, and of what the index holds; a changed table has another digest.
    A build goes to a folder of its own and is renamed when it is complete, so
    readers never see half of one and of two builders the first one counts.
    """
    spark = documents.sparkSession
    root = shared_folder(spark).rstrip("/") + "/indexes"
    state = [Files(spark, t).state(t) for t in tables]
    said = json.dumps([state, identifier, text, tokenizer, keep, by, documents.columns, FORMAT])
    path = f"{root}/{hashlib.sha256(said.encode()).hexdigest()[:24]}"
    files = Files(spark, root)
    if not files.exists(f"{path}/{MANIFEST}"):
        aside = f"{path}.{spark.sparkContext.applicationId}.building"
        files.delete(aside)
        write_index(documents, aside, identifier, text, tokenizer, keep, by)
        files.rename(aside, path)
    return Index(spark, path)
