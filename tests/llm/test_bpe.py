"""BPE by recursive queries against the tiktoken library: its own vocabulary, vocabularies that merge out of order, long words, odd rows."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

import __spark_entry__ as entry
from aeroperf.llm import bpe
from aeroperf.llm.queries import RANKS

PATTERN = public_tokenizers.PATTERN


def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts_of(seed, n=200):
    rng = random.Random(seed)
    parts = ["the", " and", "Ünïcode", "日本語", "🙂", "\n", "\n\n", "  ", "\t", " ", "it's", "x" * 60, "12345", "!?", "\r\n", " ", "aa", "ab" * 40, "é", "\x00"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(n)]


def test_ids_and_bytes_of_the_public_vocabulary():
    own, lib = bpe.Coder(RANKS, PATTERN, most=400), library(bpe.read_ranks(RANKS))
    for seed in range(3):  # more words than the memo holds, and words that it holds already
        texts = [*texts_of(seed), None, "", "naïve " * 50, "".join(random.Random(seed).choices("acgt", k=5000)), "z" * 100_000]
        ids, starts = own.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [lib.encode_ordinary(t or "") for t in texts]
        data, ends = own.decode(ids, starts)
        assert [data[a:b].tobytes() for a, b in zip(ends, ends[1:])] == [(t or "").encode() for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_vocabularies_that_merge_out_of_order(tmp_path, seed, monkeypatch):
    """Any two neighbours that make up a token can merge, by its rank, even if it ranks before its parts."""
    monkeypatch.setattr(bpe, "_ROWS", 500)  # recursions stop on the way and go on
    rng = random.Random(seed)
    tokens = [bytes([i]) for i in range(256)]
    made = list({"".join(rng.choices("abc", k=rng.randint(2, 5))).encode() for _ in range(60)})
    rng.shuffle(made)
    ranks = {t: i for i, t in enumerate([*tokens, *made])}
    (tmp_path / "v").write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for t, i in ranks.items()) + b"\n")
    own, lib = bpe.Coder(str(tmp_path / "v"), PATTERN), library(ranks)
    texts = ["".join(rng.choices("abc", k=rng.randint(1, 150))) for _ in range(60)] + ["a" * n for n in range(1, 80)]
    ids, starts = own.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [lib.encode_ordinary(t) for t in texts]
    assert any(single for *_, single in bpe.merge_rows(ranks))


def test_rows_stay_as_they_are(spark):
    rows = [(1, "a b", "mine"), (1, "a b", "mine"), (None, None, None), (2, "", "mine"), (3, "word " * 300_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string").repartition(2)
    both = bpe.encode_and_decode(df, RANKS, PATTERN)
    assert both.columns == ["doc_id", "text", "decoded", "n_tokens", "token_ids", "_decoded"]
    got = both.collect()
    assert sorted(map(repr, ((r.doc_id, r.text, r.decoded) for r in got))) == sorted(map(repr, rows))
    assert all(bytes(r["_decoded"]).decode() == (r.text or "") and len(r.token_ids) == 4 * r.n_tokens for r in got)
    apart = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert sorted(repr((r.doc_id, r.token_ids, r["_decoded"])) for r in apart) == sorted(repr((r.doc_id, r.token_ids, r["_decoded"])) for r in got)


def test_query_equals_the_library(spark, sf):
    lib = library(bpe.read_ranks(RANKS))
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = lib.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    got = entry.queries()["op12_bpe"](spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)
