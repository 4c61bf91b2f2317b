"""Written indexes against the scan without one; catalogues; paging."""

import shutil

import pytest
from pyspark.sql import functions as F

from vestigo.operators import lexical
from vestigo.plans import search
from vestigo.sources import index as ix

ROWS = [
    (1, "red fox in the red den", "en", "x"), (2, "Red hen", "de", "x"), (3, None, "en", "x"), (4, "", None, "y"), (5, "a fox, a hen, a foxHole", "en", "y"),
    (6, "nothing", "en", None), (7, "fox fox fox", "en", "y"), (8, "red fox in the red den", "en", "z"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")


def _scores(df, key="doc_id"):
    return {r[key]: round(r.score, 9) for r in df.collect()}


@pytest.mark.parametrize("tokenizer", ["camel", "plain", "camel_digit"])
def test_index_equals_scan(spark, docs, tmp_path, tokenizer):
    path = str(tmp_path / "i")
    ix.write_index(docs, path, "doc_id", tokenizer=tokenizer, keep=("lang",))
    with pytest.raises(Exception, match="exists"):
        ix.write_index(docs, path, "doc_id")
    assert ix.verify_index(spark, path) == []
    i = ix.Index(spark, path)
    en = F.col("lang") == "en"
    for query in ("red fox red", "hole", "missing", ""):
        for how in ({}, {"repeat_terms": True}, {"keep_zero": True}):
            assert _scores(i.scores(query, "doc_id", **how)) == _scores(lexical.bm25_scan(docs, query, tokenizer=tokenizer, **how))
        assert _scores(i.scores(query, "doc_id", where=en)) == _scores(lexical.bm25_scan(docs, query, tokenizer=tokenizer, eligible=en))
        assert _scores(i.scores(query, "doc_id", where=en, scope="eligible")) == _scores(lexical.bm25_scan(docs, query, tokenizer=tokenizer, eligible=en, scope="eligible"))
        few = docs.where("doc_id < 6").select("doc_id")
        assert _scores(i.scores(query, "doc_id", allowed=few)) == {k: v for k, v in _scores(lexical.bm25_scan(docs, query, tokenizer=tokenizer)).items() if k < 6}


def test_index_of_nothing(spark, docs, tmp_path):
    ix.write_index(docs.limit(0), str(tmp_path / "i"), "doc_id")
    assert ix.verify_index(spark, str(tmp_path / "i")) == [] and ix.Index(spark, str(tmp_path / "i")).scores("fox", "doc_id").count() == 0


def test_verification_finds_what_is_missing(spark, docs, tmp_path):
    path = str(tmp_path / "i")
    assert ix.verify_index(spark, path) == ["no manifest"]
    with pytest.raises(FileNotFoundError):
        ix.Index(spark, path)
    ix.write_index(docs, path, "doc_id")
    part = next((tmp_path / "i" / "lengths").glob("part-*"))
    shutil.move(part, tmp_path / "away")
    assert "lengths" in ix.verify_index(spark, path)[0]
    docs.limit(1).selectExpr("doc_id _id", "'' _by", "99 doc_len").coalesce(1).write.parquet(str(tmp_path / "wrong"))
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    shutil.move(next((tmp_path / "wrong").glob("part-*.parquet")), part)
    assert any("lengths" in x for x in ix.verify_index(spark, path))


def test_an_index_is_built_once_for_a_state_of_its_tables(spark, docs, tmp_path):
    table = str(tmp_path / "documents.parquet")
    docs.write.parquet(table)
    first = ix.index_of(spark.read.parquet(table), [table], "doc_id")
    assert ix.index_of(spark.read.parquet(table), [table], "doc_id").path == first.path
    assert ix.index_of(spark.read.parquet(table), [table], "doc_id", tokenizer="plain").path != first.path
    docs.withColumn("text", F.lit("new words")).write.mode("overwrite").parquet(table)
    second = ix.index_of(spark.read.parquet(table), [table], "doc_id")
    assert second.path != first.path and second.scores("words", "doc_id").count() == len(ROWS)


def test_catalogues(spark, docs, tmp_path):
    path = str(tmp_path / "i")
    ix.write_index(docs, path, "doc_id", by="source")
    i = ix.Index(spark, path)
    want = {}
    for name in ("x", "y", "z"):
        want |= _scores(lexical.bm25_scan(docs.where(F.col("source") == name), "red fox"))
    got = i.scores("red fox", "doc_id")
    assert got.columns == ["doc_id", "source", "score"] and _scores(got) == want
    merged = [(r.dataset, r["rank"], r.merged_rank) for r in search.catalogue_search(i, "red fox", "doc_id", 4).orderBy("merged_rank").collect()]
    assert [m[:2] for m in merged][:3] == [("x", 1), ("y", 1), ("z", 1)] and [m[2] for m in merged] == list(range(1, len(merged) + 1))
    batch = search.catalogue_batch(i, [(1, "red fox"), (2, "hen")], "doc_id", 4).collect()
    assert [(r.dataset, r["rank"]) for r in sorted(batch, key=lambda r: r.merged_rank) if r.query_id == 1] == [m[:2] for m in merged]
    v = spark.createDataFrame([(1, "x", [1.0, 0.0]), (2, "x", [0.9, 0.1]), (5, "y", [0.0, 1.0]), (7, "y", [0.5, 0.5])], "doc_id long, source string, v array<double>")
    near = search.catalogue_similar(v, 1, "source", "doc_id", "v").orderBy("merged_rank").collect()
    assert [(r.source, r.doc_id) for r in near] == [("x", 2), ("y", 7), ("y", 5)]
    lists = {"lexical": got, "dense": v.select("doc_id", "source", F.get("v", F.lit(0)).alias("score"))}
    modes = search.catalogue_modes(lists, "source", "doc_id").collect()
    assert {r["mode"] for r in modes} == {"lexical", "dense", "fused"}
    assert next(r.doc_id for r in modes if r["mode"] == "fused" and r.source == "x" and r["rank"] == 1) == 1


def test_pages_hold_every_row_once(spark):
    df = spark.createDataFrame([(f"d{k:02d}", float(k % 4)) for k in range(23)], "document_id string, score double")
    seen, after = [], None
    while page := search.page_after(df, "document_id", 5, after).collect():
        seen += page
        after = (page[-1].score, page[-1].document_id)
    assert [r.document_id for r in seen] == [r.document_id for r in df.orderBy(F.desc("score"), "document_id").collect()]
