"""The registered queries themselves: on empty tables, and against brute force on whole small tables."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from aeroperf.llm import jaccard, language, mixing, packing, passages, token_files, url_filter
from aeroperf.llm.queries import RULES, TOKENIZER

NAMES = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]


@pytest.fixture(scope="module")
def empty(spark, sf, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name in ("documents", "embeddings", "pages"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_give_no_rows(spark, empty, name):
    assert len(NAMES) == 14 and entry.queries()[name](spark, empty).collect() == []


def brute_bucket(chars, order):
    h = order
    for c in chars:
        h = ((h ^ ord(c)) * 2654435761) & 0xFFFFFFFF
        h ^= h >> 15
    return h & 32767


def test_language_query_equals_naive_bayes_by_hand(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    held_out = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    grams = {r.doc_id: [brute_bucket(t[i : i + n], n) for n in (2, 3) for t in [f" {r.text.lower()} "] for i in range(len(t) - n + 1)] if r.text else [] for r in rows}
    langs = sorted({r.lang for r in rows if r.lang and not held_out[r.doc_id]})
    counts, n_docs = {x: Counter() for x in langs}, Counter({x: 1 for x in langs})
    for r in rows:
        if not held_out[r.doc_id] and r.lang and r.text is not None:
            counts[r.lang].update(grams[r.doc_id])
            n_docs[r.lang] += 1
    total = {x: sum(c.values()) + 0.5 * 32768 for x, c in counts.items()}
    got = {r.doc_id: r for r in entry.queries()["op6_language_id"](spark, sf).collect()}
    assert len(got) == len(rows) and len(langs) > 1
    for r in rows:
        own = got[r.doc_id]
        assert own.held_out == held_out[r.doc_id]
        if not re.search(r"[^\W\d_]", r.text or ""):
            assert (own.lang_pred, own.score) == ("und", 0.0)
            continue
        g = grams[r.doc_id]
        odds = {x: sum(math.log((counts[x][b] + 0.5) / total[x]) for b in g) / math.sqrt(len(g)) + math.log(n_docs[x] / sum(n_docs.values())) for x in langs}
        best = max(odds.values())
        score = 1 / sum(math.exp(o - best) for o in odds.values())
        assert odds[own.lang_pred] >= best - 1e-4 and abs(own.score - score) < 1e-3


def test_mixing_query_equals_blocks_by_hand(spark, sf):
    """Shares of real tokens, the exponent, whole blocks, and the last block up to its budget."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    h = F.xxhash64(F.lit(17), "doc_id", "text")
    rows = docs.select("doc_id", "source", "text", *[F.xxhash64(F.lit(17), F.lit(e), h).alias(f"e{e}") for e in range(3)]).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    n = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in rows}
    own = Counter()
    for r in rows:
        own[r.source] += n[r.doc_id]
    low, high = 0.0, 1.0
    weights = lambda e: {s: x**e / sum(y**e for y in own.values()) for s, x in own.items()}
    for _ in range(80):
        mid = (low + high) / 2
        epochs = [w / own[s] for s, w in weights(mid).items()]
        low, high = (low, mid) if max(epochs) / min(epochs) <= 1.25 else (mid, high)
    w = weights(high)
    budget = max(own[s] / w[s] for s in own)
    want = Counter()
    for s in own:
        left, epoch = w[s] * budget, 0
        while left > 1e-3 * own[s] / max(own.values()) and left > 1e-3:
            for r in sorted((r for r in rows if r.source == s), key=lambda r: r[f"e{epoch}"]):
                if left > 1e-3:
                    want[r.doc_id, epoch] += 1
                    left -= n[r.doc_id]
            epoch += 1
    got = entry.queries()["op10_mixing"](spark, sf).collect()
    mine = Counter((r.doc_id, r.epoch) for r in got)
    apart = (mine - want) + (want - mine)
    assert sum(mine.values()) > len(rows) and len(apart) <= len(own)  # rounding may move one document where a budget ends
    assert all(abs(r.mix_weight - w[r.source]) < 1e-6 for r in got)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, null, empty and very long texts, repeated rows, nulls in every column, and clashing names."""
    word = lambda tag, n: " ".join(f"{tag}w{i}" for i in range(n))
    long = word("Long", 130_000)  # 1.4 MB
    rows = [(1, long, "en", "s"), (2, long + " end", "en", "s"), (3, word("a", 60), "en", None), (3, word("a", 60), "en", None), (4, word("b", 50), None, "t"), (4, word("c", 50), "en", "t"), (None, word("a", 60), "en", "s"), (None, None, None, None), (5, None, "en", "t"), (6, "", "en", "t"), (7, "12 !", None, "t"), (8, "x" * 1_200_000, "en", "t"), (9, word("a", 60), "en", "s")]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    clash = {"score": "mine", "epoch": "mine", "Lang_Pred": "mine", "mix_weight": "mine", "mix_order": "mine", "start": "mine", "length": "mine", "component_id": "mine", "key": "mine", "id": "mine", "kind": "mine", "_mix_h": "mine"}
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], names).withColumns({k: F.lit(v) for k, v in clash.items()}).repartition(3)


def test_odd_rows_in_every_document_operator(spark, odd, tmp_path):
    rows = odd.select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    n = Counter((r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in rows)
    packed = packing.pack(odd, TOKENIZER).collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in packed if r.start == 0) == n
    assert sum(r.length for r in packed) == sum(size * c for (_, size), c in n.items())
    token_files.write_token_files(odd, f"file://{tmp_path}/t", TOKENIZER)
    assert Counter((r.doc_id, r.n_tokens) for r in token_files.read_token_files(spark, f"file://{tmp_path}/t").collect()) == n
    sets = Counter((r.doc_id, r.component_id) for r in jaccard.jaccard_components(odd).collect())
    assert sets == Counter({(1, 1): 1, (2, 1): 1, (3, 3): 2, (4, 4): 2, (None, None): 2, (5, 5): 1, (6, 6): 1, (7, 7): 1, (8, 8): 1, (9, 3): 1})
    model = language.train_language_model(odd)
    said = language.identify(odd, model)
    assert Counter(r.lang_pred for r in said.collect()) == Counter({"en": 9, "und": 4}) and "lang_pred" in said.columns
    spans = {r.doc_id: (r.start, r.n_words) for r in passages.repeated_passages(odd).collect()}
    assert spans == {2: (0, 130_001), 9: (0, 60)}  # all of a near copy, its own last word too
    mixed = mixing.mix(odd, TOKENIZER, names=("_e", "_w", "_o"))
    assert mixed.columns[: len(odd.columns)] == odd.columns and {r[c] for r in mixed.collect() for c in ("score", "epoch", "mix_order", "_mix_h")} == {"mine"}
    assert Counter((r.doc_id, r.text) for r in mixed.where("_e = 0").collect()) == Counter((r.doc_id, r.text) for r in rows)


def test_odd_rows_through_the_pipeline(spark, odd):
    """No stage crashes, overwrites a column or loses a clean document; a document without an id stays."""
    at = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, "").cache()
        assert at.columns == odd.columns
        assert all(r[c] == "mine" for r in at.collect() for c in ("score", "epoch", "Lang_Pred", "mix_weight", "mix_order", "start", "id", "key"))
        if name == "language_id":
            assert Counter(r.doc_id for r in at.collect()) == Counter([1, 2, 3, 3, 4, 4, None, 8, 9])
        if name == "near_duplicates":
            assert Counter(r.doc_id for r in at.collect()) == Counter([1, 3, 3, 4, 4, None, 8])
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, at, "").collect()} == {1, 3, 4, None, 8}


def test_odd_rows_in_the_url_filter(spark):
    rows = [(1, "http://a.com/", "mine"), (1, "http://a.com/", "mine"), (None, "http://x.example.com/en/1", "mine"), (None, None, None), (2, "", "mine"), (3, "http://example.com/en/" + "x" * 1_200_000, "mine")]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, `key` string"), RULES)[0]
    assert Counter((r.page_id, r.rule, r.verdict, r.key) for r in got.collect()) == Counter({(1, "com/", "allow", "mine"): 2, (None, "example.com/en/", "block", "mine"): 1, (None, None, "allow", None): 1, (2, None, "allow", "mine"): 1, (3, "example.com/en/", "block", "mine"): 1})


def test_url_filter_bounds_what_it_gathers(spark):
    keys = spark.range(1000).selectExpr("concat('k', id) AS key")
    for listed, universe in ((keys, keys), (keys.limit(900), keys)):
        with pytest.raises(ValueError, match="listed keys pass"):
            url_filter.build_cascade(listed, universe, max_filter_bytes=16 * 800)
    assert len(url_filter.build_cascade(keys, keys, max_filter_bytes=16 * 1000).levels) >= 1
