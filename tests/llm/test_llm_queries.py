"""Queries of the subpackage against their twins, and every operator on awkward tables."""

from __future__ import annotations

import pytest
from check_oracle import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm.common import WORDS
from footfall.llm.queries import ORACLE, QUERIES
from footfall.session import materialize

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog " * 4, "en", "a", 176),
    (1, "the quick brown fox jumps over the lazy dog " * 4, "en", "a", 176),  # a repeated row
    (2, None, None, None, None),
    (3, "", "en", None, 0),
    (None, "call +1 (555) 123-4567 or write to a.b@example.com today", None, "b", 56),
    (None, None, "en", "a", None),
    (4, " \t\n ", "en", "b", 4),
    (5, "word " * 40000, "en", "b", 200000),
    (6, "x" * 100000, "en", "c", 100000),
    (7, "Éà ü 漢字 \U0001f600 <|endoftext|> 1.2.3.4 \0 end", "fr", "c", 30),
    (8, "the quick brown fox jumps over the lazy dog " * 4, "de", "d", 176),
]


@pytest.fixture
def folder(spark, tmp_path):
    def make(rows, extra=False):
        docs = spark.createDataFrame(rows, DOCS)
        if extra:  # names that the operators use inside
            for name in ("size", "n", "row", "id", "rank", "copies", "found", "kept", "set", "curve", "key", "t", "m"):
                docs = docs.withColumn(name, F.lit("x"))
        path = str(tmp_path / "tables")
        docs.write.mode("overwrite").parquet(f"{path}/documents.parquet")
        pages = docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))
        pages.write.mode("overwrite").parquet(f"{path}/pages.parquet")
        items = docs.select(F.col("doc_id").alias("item_id"), "text", "source")
        items.write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
        turns = docs.select(F.col("doc_id").alias("conv_id"), F.col("n_chars").alias("turn"), F.col("lang").alias("role"), "text")
        turns.write.mode("overwrite").parquet(f"{path}/conversations.parquet")
        return path

    return make


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql_twin(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


@pytest.mark.parametrize("name", QUERIES)
def test_awkward_tables_have_a_result(spark, folder, name):
    rows = QUERIES[name](spark, folder(AWKWARD, extra=True)).collect()
    if name.startswith(("op10", "op12", "op13", "op4", "op5")):
        assert rows
    else:
        assert len(rows) == len(AWKWARD)
    assert QUERIES[name](spark, folder([])).collect() == []


LONG = [
    (1, " ".join(str(i * 7919 % 100_003) for i in range(150_000)), "en", "a", 1),  # a million characters of numbers
    (2, "short line\n" * 300_000, "en", "a", 1),
    (3, "word, " * 10 + "a.b@example.com 4111111111111111 4111111111111111 1.2.3.4", None, "b", 1),
]


def test_values_on_awkward_tables(spark, folder):
    path = folder(AWKWARD + LONG, extra=True)
    texts = sorted(((i, t) for i, t, *_ in AWKWARD + LONG), key=lambda x: (x[0] is not None, x[0] or 0))
    words = {(i, len(WORDS.findall(t or ""))) for i, t in texts}
    mix = QUERIES["op1_pareto_mix"](spark, path).collect()
    assert {(r.doc_id, r.size) for r in mix} == words
    assert all(r.taken in (0, r.size, 2 * r.size) for r in mix)
    files = sorted(QUERIES["op3_zstd_token_files"](spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in files] == [i for i, _ in texts]
    assert files[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(files, files[1:]))
    pieces = QUERIES["op5_best_fit_packing"](spark, path).collect()
    assert {(r.doc_id, r.length, r.start) for r in pieces if r.doc_id in (2, 3)} >= {(2, 1, 0), (3, 1, 0)}
    assert max(r.length for r in pieces) == 4096
    sets = QUERIES["op6_ngram_jaccard_join"](spark, path).collect()
    lazy = {r.component_id for r in sets if r.doc_id in (1, 8) and r.n_shingles < 100}
    assert lazy == {1} and all(r.component_id == r.doc_id for r in sets if not r.n_shingles)
    found = {(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in QUERIES["op7_semi_markov_pii"](spark, path).collect()}
    assert {(3, 1, 1, 0, 0), (None, 1, 0, 0, 1), (7, 0, 1, 0, 0), (2, 0, 0, 0, 0)} <= found
    shards = QUERIES["op8_hilbert_shards"](spark, path).collect()
    assert {(r.doc_id, r.size) for r in shards} == {(i, len((t or "").encode()) + 1) for i, t in texts}
    for shard in range(8):
        slots = sorted(r.slot for r in shards if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (len(texts) // 8, len(texts) // 8 + 1)
    rules = {(r.doc_id, r.n_words, r.n_dup_lines) for r in QUERIES["op9_quality_rules"](spark, path).collect()}
    assert {(2, 600_000, 299_999), (1, 150_000, 0), (5, 40_000, 0), (2, 0, 0)} <= rules
    ranked = QUERIES["op13_lexical_search"](spark, path).collect()
    assert {r.item_id for r in ranked} == {1, 2, 3, 5, 6, 7, 8, None} and all(r.score > 0 for r in ranked)


def test_pipeline_on_awkward_tables(spark, folder):
    for extra in (False, True):
        path = folder(AWKWARD, extra)
        docs = spark.read.parquet(f"{path}/documents.parquet")
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, path), name)
            assert docs.columns == columns
    assert corpus_pipeline.run(spark, folder([])).collect() == []


def test_pipeline_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        sizes.append(docs.count())
        if name == "personal_data":
            assert docs.where(F.col("text").rlike(r"@[a-z0-9]+\.example")).count() == 0
            assert docs.where("n_chars != length(text)").count() == 0
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] != sizes[4]
    packed = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    assert packed.where("piece = 0").count() == sizes[4]
