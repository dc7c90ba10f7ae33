"""The pipeline and the queries without SQL against brute force on the smallest tables."""

import re

import pytest
from llm_data import documents
from pyspark.sql import functions as F
from test_exact_and_suffix import expected_groups, removed
from test_ngram_join import classes
from test_secrets_and_language import base_spans
from test_simhash_and_mixing import expected_copies

import __spark_entry__ as catalog
import corpus_pipeline
from postlens.llm.queries import TARGETS, VOCABULARY

QUERIES = catalog.queries()


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())


def test_run_equals_brute_force(spark, sf_dir, docs):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(pytest.importorskip("public_tokenizers").path(VOCABULARY))
    rows = [r for r in docs if r.text and re.search(r"[^\W\d_]", r.text)]
    scored = {r.doc_id: r for r in QUERIES["op8_language_id"](spark, sf_dir).collect()}
    rows = [r for r in rows if scored[r.doc_id].score >= 0.5]
    first = expected_groups([r.text for r in rows])
    rows = [r for i, r in enumerate(rows) if first[i][2]]
    near = classes([r.text for r in rows], 5, 80)
    rows = [r for (i, _, c), r in zip(near, rows) if i == c]
    text = {r.doc_id: r.text for r in rows}
    expected = sorted(
        (i, library.encode(text[i], add_special_tokens=False).ids) for i, _ in expected_copies([(r.doc_id, r.source) for r in rows], TARGETS)
    )
    got = QUERIES["pipeline"](spark, sf_dir)
    assert sorted((r.doc_id, r.ids) for r in got.collect()) == expected


def test_stages_keep_the_columns(spark, sf_dir):
    frame = documents(spark, ["the and of", None, "the and of", "123"], langs=["en", "de", "en", None]).withColumn("extra", F.lit(1))
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, frame, sf_dir)
        assert out.columns == frame.columns, name
    assert sorted(r.doc_id for r in stage("language_id")(spark, frame, sf_dir).collect()) == [0, 2]


def test_stages_lose_no_column_whatever_its_name_and_take_long_texts(spark, sf_dir):
    long = "the and of " * 200_000
    frame = documents(spark, [long, long + "x", None, "the and of", "the and of"], ids=[3, 4, 5, None, None])
    names = ["_likeliest_language", "_language_odds", "_copy_number", "_Copy_Number_", "tkey", "text_sha256", "copy"]
    frame = frame.select("*", *[F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in names])
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, frame, sf_dir)
        assert out.columns == frame.columns, name
        for r in out.select("doc_id", *names).collect():
            said = "none" if r.doc_id is None else r.doc_id
            assert [r[n] for n in names] == [f"{n} of {said}" for n in names], name
    rows = stage("bpe")(spark, frame, sf_dir).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == [("3", 600_000), ("4", 600_001), ("5", 0), ("None", 3), ("None", 3)]


def test_stages_take_empty_tables(spark, sf_dir):
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, documents(spark, []), sf_dir).collect() == [], name


def test_op6_equals_brute_force(spark, sf_dir, docs):
    got = sorted(tuple(r) for r in QUERIES["op6_suffix_dedup"](spark, sf_dir).collect())
    assert got == removed([(r.doc_id, r.text.encode()) for r in docs], 100)


def test_op7_equals_brute_force(spark, sf_dir, docs):
    got = {r.doc_id: r.spans for r in QUERIES["op7_secrets"](spark, sf_dir).collect()}
    for r in docs:
        assert [x for x in got[r.doc_id].split(",") if x and not x.startswith("markov")] == base_spans(r.text)


def test_op9_equals_brute_force(spark, sf_dir, docs):
    got = sorted(tuple(r) for r in QUERIES["op9_ngram_join"](spark, sf_dir).collect())
    assert got == classes([r.text for r in docs], 3, 90)


def test_op10_has_every_conversation(spark, sf_dir):
    ids = {r.conv_id for r in QUERIES["op10_chat_format"](spark, sf_dir).collect()}
    every = {r.conv_id for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().collect()}
    assert ids == every | {-1}
