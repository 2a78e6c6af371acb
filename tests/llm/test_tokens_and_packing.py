import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aeroperf.llm import packing, token_files
from aeroperf.llm.tokens import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
ODD = ["", None, "  a  b", "a\n\nb", "x\n y", "don't 's", "a\tb c", "a\xa0b \xa0c", "\n", " é b", "end ", "a\r\nb", "漢字 かな 12 3,4 <|endoftext|> x", "ñ é\nü\u3000 a", "word " * 700, "Of " * 3000]


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'é漢 \n\t\xa0\u2028.1Z"), max_size=40), max_size=6))
def test_pieces_encode_as_whole_texts(texts):
    got, starts = PieceEncoder.encode(ENCODER, pa.array(texts, pa.string()), None)
    assert [got[a:b].tolist() for a, b in zip(starts, starts[1:])] == [ids(t) for t in texts]


ENCODER = PieceEncoder(PATH, max_pieces=500)


def test_odd_texts_and_a_table_that_starts_anew():
    for _ in range(3):
        got, starts = ENCODER.encode(pa.array(ODD, pa.string()))
        assert [got[a:b].tolist() for a, b in zip(starts, starts[1:])] == [ids(t) + [0] for t in ODD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_decreasing_equals_brute_force(lengths):
    lengths = sorted(lengths, reverse=True)
    which, offset = packing.best_fit_decreasing(np.array(lengths, np.int64), 64)
    room = []
    for n, w, o in zip(lengths, which, offset):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            assert room[w] == min(fits)[0] and o == 64 - room[w]
        else:
            assert w == len(room) and o == 0
            room.append(64)
        room[w] -= n


def test_packing_places_every_id_once(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "word", "xyzzy"]) for _ in range(rng.randrange(0, 400))), "s") for i in range(60)] + [(100 + i, t, "s") for i, t in enumerate(ODD)] + [(None, "a", "s"), (7, "twice", "s"), (7, "twice", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")  # a column of a clashing name
    got = packing.pack(df, PATH, window=128, keep_ids=True).toPandas()
    assert len(got) == len(packing.pack(df, PATH, window=128).toPandas())
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq.offset.values == np.r_[0, seq.length.values.cumsum()[:-1]]).all() and seq.length.sum() <= 128
        used = seq.length.sum()
        assert (seq.sequence_tokens == used).all() and (seq.padded_to == (used if used & (used - 1) == 0 else 128)).all()
    whole = {}
    for r in got[got.doc_id.notna() & (got.doc_id != 7)].sort_values("start").itertuples():
        assert zlib.crc32(r.ids) == r.ids_crc32
        whole.setdefault(int(r.doc_id), []).extend(struct.unpack(f"<{r.length}I", r.ids))
    assert whole == {d: ids(t) + [0] for d, t, _ in rows if d is not None and d != 7}
    assert got.length.sum() == sum(len(ids(t)) + 1 for _, t, _ in rows)
    assert packing.pack(df.limit(0), PATH).count() == 0


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.lists(st.integers(0, 6), max_size=60), max_size=12))
def test_repair_round_trip_and_random_access(docs):
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    flat = np.array([x for d in docs for x in d], np.uint32)
    raw = token_files._shard(list(range(len(docs))), flat, starts) if len(flat) else None
    symbols, first, g = token_files.repair(flat, starts, 7, least=2)
    assert token_files.expand(symbols, g).tolist() == flat.tolist()
    assert [token_files.expand(symbols[a:b], g).tolist() for a, b in zip(first, first[1:])] == docs
    if raw:
        shard = token_files.Shard(struct.unpack("<5Q", raw[4:44]), raw[44:])
        for i, d in enumerate(docs):
            assert shard.document(i).tolist() == d and [shard.token(i, j) for j in range(len(d))] == d
            with pytest.raises(IndexError):
                shard.token(i, len(d))


def test_repair_ends_where_no_pair_is_frequent():
    rng = np.random.default_rng(0)
    passage = rng.integers(0, 50_000, 5000)
    flat = np.concatenate([np.r_[passage, rng.integers(0, 70_000, 300)] for _ in range(20)]).astype(np.uint32)
    for base in (int(flat.max()) + 1, 50_000):  # symbols of more than 2 bytes change nothing
        ids = flat % base
        symbols, _, g = token_files.repair(ids.astype(np.uint32), np.array([0, len(ids)]), base)
        assert (token_files.expand(symbols, g) == ids).all()
        pairs, n = np.unique(symbols[:-1].astype(np.int64) << 32 | symbols[1:], return_counts=True)
        assert n.max() < 12 and g.lengths.max() > 2000


def test_repair_compresses_what_repeats():
    flat = np.array([1, 2, 3, 4] * 500, np.uint32)
    symbols, _, g = token_files.repair(flat, np.array([0, len(flat)]), 5)
    assert len(symbols) + 2 * len(g.lengths) < len(flat) / 20


def test_token_files_round_trip(spark, tmp_path):
    rows = [(i * 3 % 41, t) for i, t in enumerate(ODD + ["same"] * 20)] + [(None, "no id"), (5, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n = token_files.write_token_files(df.repartition(3), f"file://{tmp_path}/t", PATH, shard_ids=500)
    got = token_files.read_token_files(spark, f"file://{tmp_path}/t", keep_ids=True).collect()
    assert len(got) == len(rows) and n == sum(len(ids(t)) + 1 for _, t in rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.n_tokens}I", *r.ids))
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted([d for d, _ in rows], key=lambda d: (d is not None, d or 0))
    assert sorted(tuple(r.ids) for r in got) == sorted(tuple(ids(t) + [0]) for _, t in rows)


def test_no_documents_no_files(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    folder = f"file://{tmp_path}/none"
    assert token_files.write_token_files(empty, folder, PATH) == 0
    assert token_files.read_token_files(spark, folder).count() == 0
