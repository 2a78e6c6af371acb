import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from aeroperf.llm import jaccard, mixing, passages, workers

CLEAN = " ".join


@pytest.fixture(scope="module")
def docs(spark):
    w = lambda tag, n: CLEAN(f"{tag}word{i}" for i in range(n))
    shared = w("shared", 70)
    rows = [(i, w(f"d{i}x", 80), "en", f"s{i % 3}") for i in range(12)]
    rows += [(20, w("d3x", 80), "en", "s0"), (21, w("d3x", 79) + " changed", "en", "s0"), (22, "12 34 5", "en", "s0"), (23, None, "en", "s1"), (24, "", "en", "s1")]
    rows += [(30, w("p", 60) + " " + shared, "en", "s2"), (31, w("q", 60) + " " + shared + " " + w("r", 60), "en", "s2"), (32, "d0xword0 d0xword1", "en", "s2")]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "repeated_passages", "mixing", "packing"]
    at, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, "").cache()
        seen[name] = at.collect()
        if name != "packing":
            assert at.columns == docs.columns
    ids = {n: {r.doc_id for r in rows} for n, rows in seen.items()}
    every = {r.doc_id for r in docs.collect()}
    assert ids["language_id"] == every - {22, 23, 24}
    assert ids["near_duplicates"] == ids["language_id"] - {20, 21}
    assert ids["repeated_passages"] == ids["near_duplicates"]
    text = {r.doc_id: r.text for r in seen["repeated_passages"]}
    before = {r.doc_id: r.text for r in docs.collect()}
    assert {i for i in text if text[i] != before[i]} == {31} and len(text[31].split()) <= 60 + 60 + 70 - 32
    assert all(r.n_chars == len(r.text) for r in seen["repeated_passages"])
    assert ids["mixing"] == ids["repeated_passages"] == ids["packing"]
    assert max(Counter(r.doc_id for r in seen["mixing"]).values()) <= 2
    pieces = Counter(r.doc_id for r in seen["packing"] if r.start == 0)
    assert pieces == Counter(r.doc_id for r in seen["mixing"])


def test_run_is_registered_and_runs(spark, sf):
    assert "pipeline" not in entry.oracle_sql()
    out = entry.queries()["pipeline"](spark, sf)
    assert out.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)


def test_empty_documents_go_through(spark, docs):
    at = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, "")
    assert at.count() == 0


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert jaccard and mixing and passages


def test_texts_with_a_letter_stay_without_labels(spark, docs):
    out = corpus_pipeline.known_language(spark, docs.withColumn("lang", F.lit(None).cast("string")), "")
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - {22, 23, 24}


def test_stages_bound_the_bytes_of_batches(spark, docs):
    kept = spark.conf.get(workers.BATCH_BYTES)
    spark.conf.unset(workers.BATCH_BYTES)
    long = spark.range(0, 2_000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.repeat(F.lit("x"), 10_000)).alias("text"))
    sizes = long.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [len(b)], "bytes": [b.nbytes]}) for b in batches), "n long, bytes long")
    try:
        corpus_pipeline.STAGES[-1][1](spark, docs, "")
        got = sizes.collect()
        assert sum(r.n for r in got) == 2_000 and max(r.bytes for r in got) < 3 << 20
        spark.conf.set(workers.BATCH_BYTES, "1m")
        corpus_pipeline.STAGES[0][1](spark, docs, "")
        assert spark.conf.get(workers.BATCH_BYTES) == "1m"
    finally:
        spark.conf.set(workers.BATCH_BYTES, kept)
