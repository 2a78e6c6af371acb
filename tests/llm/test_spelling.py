"""Spelling variants against brute force: counts, every kind of edit, crowded halves that are halved again, ties and odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from aeroperf.llm import spelling


def distance_is_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute(counts, factor=5):
    near = {w: [x for x in counts if distance_is_one(w, x)] for w in counts}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] is not None else None) for w, n in counts.items()}


def brute_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def words_near_each_other(seed, size, letters="abé"):
    rng = random.Random(seed)
    out = {"".join(rng.choices(letters, k=rng.randint(2, 7))): rng.choice([1, 5, 25, 126, 700]) for _ in range(size)}
    out |= {"inter" + "".join(rng.choices(letters, k=rng.randint(1, 5))): rng.randint(1, 99) for _ in range(size)}
    return out | {"a": 9, "": 3, "ńłaaaa": 4, "ńłaaab": 44, "x" * 3000: 1, "x" * 2999: 8}


@pytest.mark.parametrize("most,shard_words", [(4096, 1 << 15), (3, 64)])
def test_variants_equal_brute_force(spark, most, shard_words):
    counts = words_near_each_other(most, 300)
    rows = [(w, n, "mine", "mine") for w, n in counts.items()]
    words = spark.createDataFrame([*rows, (None, 3, "", ""), ("null", None, "", "")], "word string, n long, form string, key string").repartition(3)
    got = spelling.variants(words, most=most, shard_words=shard_words)
    assert got.columns == ["word", "n", "form", "root", "n_near", "form_n"]
    alone = {w: n for w, n in counts.items() if len(w) < 2}
    want = brute({w: n for w, n in counts.items() if len(w) > 1}) | {(w, None, w, n, 0, None) for w, n in alone.items()}
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()} == want


def test_crowded_halves_are_halved_until_few_words_share_a_key(spark):
    counts = words_near_each_other(1, 400)
    words = spark.createDataFrame([(w, n) for w, n in counts.items() if len(w) > 1], "word string, n long")
    held = spelling._dealt(words, 3).where("n IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"), F.max(F.col("hi") - F.col("lo")).alias("unknown")).collect()
    assert all(r.n <= 3 or r.unknown == 1 for r in held) and max(r.n for r in held) <= 6
    assert max(r.n for r in spelling._dealt(words, 4096).where("n IS NOT NULL").groupBy("key").count().toDF("key", "n").collect()) > 30


def test_crc_of_spans():
    data = np.frombuffer(("ab" * 100 + "é" * 90 + "xyz").encode(), np.uint8)
    begin, end = np.array([0, 3, 200, 380, 383]), np.array([0, 67, 380, 383, 383])
    state = np.array([zlib.crc32(b"7:")] * 5, np.uint32)
    assert spelling.crc32_spans(data, begin, end, state).tolist() == [zlib.crc32(b"7:" + data[a:b].tobytes()) for a, b in zip(begin, end)]


def test_odd_texts(spark):
    rows = [(i % 40, "Straße naïve_word NAÏVE longer2longest Ünder×der ab") for i in range(600)]
    rows += [(None, "nullid " * 500), (None, None), (5, ""), (5, "x" * 1_300_000), (6, "y" * 300 + " " + "y" * 300)] + [(7, "y" * 300)] * 4
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, word string").repartition(4)
    got = spelling.spelling_variants(docs)
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()} == brute(brute_counts(rows))


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op13_spelling"](spark, sf).collect()
    want = brute(brute_counts(rows))
    assert len(want) > 500 and {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
