"""Jaccard join, passages, embeddings and nearest neighbours against brute force."""

import inspect
import random
from collections import Counter
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroperf.llm import embedding_dedup, jaccard, nearest, passages
from aeroperf.llm.components import components
from aeroperf.llm.hashing import shingle_sets, words
from aeroperf.llm.id_filter import without_listed
import pyarrow as pa


def split(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x20\x09-\x0d]+", low)


def shingles(text, k):
    w = split(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset()


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(nodes)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {n: root(n) for n in nodes}


def near_copies(rng, vocabulary, n, size):
    """Groups of texts that differ in a few words, around many thresholds, and short ones."""
    out = []
    while len(out) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 12, size]))]
        for _ in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                i = rng.randrange(len(w))
                w[i : i + rng.randrange(2)] = [rng.choice(vocabulary)]
            out.append(" ".join(w))
    return out[:n]


def test_words_and_sets():
    odd = ["", None, "A b\tC", "é É", "a\x0bb", " lead trail ", "one", "漢字 x", "a\xa0b c"]
    h, bounds, begin, end = words(pa.array(odd))
    for i, t in enumerate(odd):
        raw = (t or "").encode()
        assert [raw[a:b].decode().translate({c: c + 32 for c in range(65, 91)}) for a, b in zip(begin[bounds[i] : bounds[i + 1]], end[bounds[i] : bounds[i + 1]])] == split(t)
    _, starts = shingle_sets(pa.array(odd), 2)
    assert np.diff(starts).tolist() == [len(shingles(t, 2)) for t in odd]


@pytest.mark.parametrize("k,num,den,tile", [(4, 85, 100, 2048), (4, 85, 100, 3), (5, 8, 10, 2), (1, 1, 2, 4)])
def test_jaccard_equals_brute_force(spark, k, num, den, tile):
    rng = random.Random(k * tile)
    texts = near_copies(rng, [f"w{i}" for i in range(60)], 160, 40) + ["", None, "  ", "One", "one", "a b c", "A B C"] + ["hot copy of many words in a row"] * 20
    rng.shuffle(texts)
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "hot copy of many words in a row", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string").repartition(5)
    sets = {i: shingles(t, k) for i, t, _ in rows if i is not None}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and den * len(x & y) >= num * len(x | y)

    want = brute_components(sets, linked)
    got = jaccard.jaccard_components(df, k, num, den, tile=tile, anew=tile).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {i: (len(sets[i]), want[i]) for i in sets}
    assert [r.component_id for r in got if r.doc_id is None] == [None] and len(got) == len(rows)


@pytest.mark.parametrize("num,den", [(85, 100), (8, 10)])
def test_parts_never_miss_a_partner(num, den):
    """Every pair at the threshold shares a key, with common shingles left out or not."""
    rng, bands = np.random.default_rng(1), jaccard.Bands(num, den)
    for n in [1, 2, 3, 5, 6, 7, 9, 12, 20, 50, 200, 900]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            cut = rng.integers(0, len(a) + 1)
            new = rng.integers(0, len(a) + 1)
            b = np.unique(np.concatenate([a[cut:], rng.integers(0, 2**63, new, dtype=np.uint64)]))
            if not len(b) or jaccard.overlap(a, b) * (num + den) < num * (len(a) + len(b)):
                continue
            flat, starts = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            common = rng.integers(0, 2**63, 16, dtype=np.uint64)
            for c in (None, common, np.full(16, 2**64 - 1, np.uint64)):
                for paired in (False, True):
                    keys, docs = jaccard.part_keys(flat, starts, bands, c, paired)
                    assert set(keys[docs == 0].tolist()) & set(keys[docs == 1].tolist())


def test_paired_parts_part_what_met_by_chance(spark):
    """Documents that share rare passages are one component by parts, and small ones by pairs; work follows the parts."""
    rng = np.random.default_rng(4)
    bands, quotes = jaccard.Bands(85, 100), [rng.integers(0, 2**64 - 1, 12, dtype=np.uint64) for _ in range(40)]
    sets = [np.unique(np.concatenate([rng.integers(0, 2**64 - 1, 60, dtype=np.uint64), *[quotes[q] for q in rng.choice(40, 3)]])) for _ in range(200)]
    starts = np.cumsum([0, *map(len, sets)])
    shared = []
    for paired in (False, True):
        keys, docs = jaccard.part_keys(np.concatenate(sets), starts, bands, None, paired)
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        shared.append(len({(a, b) for a, b, same in zip(docs, docs[1:], keys[1:] == keys[:-1]) if same and a != b}))
        long = np.unique(rng.integers(0, 2**64 - 1, 20_000, dtype=np.uint64))
        assert len(jaccard.part_keys(long, np.array([0, len(long)]), bands, None, paired)[0]) < 15 * 2 * 4000
    assert shared[1] < shared[0] / 3


def test_jaccard_of_nothing(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert jaccard.jaccard_components(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()[:] == (1, 0, 1)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 90)] + [(5000, 5000), (None, 3), (7001, 7000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(90)) and got[7001] == 7000 and 5000 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_listed(spark):
    df = spark.createDataFrame([(i, "x") for i in range(300)] + [(None, "x")], "id long, listed string")
    got = {r.id for r in without_listed(df, "id", spark.createDataFrame([(i,) for i in range(0, 300, 7)] * 2 + [(None,)], "i long")).collect()}
    assert got == {i for i in range(300) if i % 7} | {None}


def test_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(4)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    passage, other = fresh(51), fresh(120)
    rows = []
    for i in range(40):
        w = fresh(rng.choice([5, 60, 200]))
        if i % 4 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() for x in passage] if i == 8 else passage
        if i in (1, 2):
            w += other
        rows.append((i, " ".join(w), f"k{i}"))
    own = fresh(60)
    rows += [(90, " ".join(own + fresh(30) + own), "repeats itself"), (91, None, "n"), (92, "", "e"), (93, "short text", "s"), (94, "short text", "s"), (None, " ".join(passage), "no id"), (95, "w " * 400, "one word")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _spans string").repartition(6)
    spans = passages.repeated_passages(df)
    got = {r.doc_id: r for r in spans.collect()}
    assert set(got) == {i for i in range(4, 40, 4)} | {2}
    assert all(r.n_words >= 32 and r.found_in < r.doc_id for r in got.values())
    cut = {r.doc_id: r.text for r in passages.cut_passages(df, spans).collect()}
    assert {r._spans for r in passages.cut_passages(df, spans).collect()} == {r[2] for r in rows}
    for i, t, _ in rows:
        if i is not None and i not in got:
            assert cut[i] == t
    for i, r in got.items():
        w = next(t for d, t, _ in rows if d == i).split()
        assert cut[i].split() == w[: r.start] + w[r.start + r.n_words :]
    assert passages.repeated_passages(df.limit(0)).count() == 0


def test_a_passage_that_loses_a_word_is_still_found(spark):
    rng = random.Random(9)
    p = [f"u{rng.randrange(10**9)}" for _ in range(200)]
    q = list(p)
    q[100] = "changed"
    df = spark.createDataFrame([(1, " ".join(p)), (2, " ".join(q))], "doc_id long, text string")
    assert sum(r.n_words for r in passages.repeated_passages(df).collect()) >= 120


@pytest.mark.parametrize("tile", [2048, 4])
def test_all_pairs_of_a_key_are_looked_at(spark, tile):
    """One key with many contents: the most frequent one is like none of them, and like ones are not neighbours."""
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 2**62, 28)) for _ in range(12)]
    sets = [base[0]] + [np.unique(np.r_[b[:-2], rng.integers(0, 2**62, 2)]) for b in base[1:] for _ in range(4)]
    c = rng.permutation(10**6)[: len(sets)].tolist()
    rows = [("key", x, i, 0) for i, x in enumerate(c)] + [("key", c[0], 900, 0), ("key", c[0], 901, 0)]
    batch = pa.RecordBatch.from_pylist([{"key": 7, "c": x, "d": d, "p": p, "n": 32, "kind": passages.FIRST, "d2": None, "p2": None} for _, x, d, p in rows], pa.schema([("key", pa.int64()), ("c", pa.int64()), ("d", pa.int64()), ("p", pa.int64()), ("n", pa.int64()), ("kind", pa.int8()), ("d2", pa.int64()), ("p2", pa.int64())]))
    met = [r for b in passages._collide([batch]) for r in b.to_pylist() if r["kind"] == passages.MEMBER]
    assert sorted(r["c"] for r in met) == sorted(c)
    members = spark.createDataFrame([(r["d2"], r["c"], r["d"], r["p"], r["n"], r["single"]) for r in met], "g long, c long, d long, p long, n long, single boolean")
    links = passages._verified(members, spark.createDataFrame([(x, s.tolist()) for x, s in zip(c, sets)], "c long, shingles array<long>"), 0.8, tile)
    near = lambda i, j: 10 * len(set(sets[c.index(i)]) & set(sets[c.index(j)])) >= 8 * len(set(sets[c.index(i)]) | set(sets[c.index(j)]))
    want = brute_components(c, near)
    got = {r.node: r.component for r in components(links).collect()}
    assert {x: got.get(x, x) for x in c} == want and len(set(want.values())) == 12


def test_whole_paragraphs_and_ends_of_runs(spark):
    """A line with a word changed every 30 is a near copy; a shared run goes whole, wherever the windows stand in it."""
    rng = random.Random(12)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    rows, changed, run = [], {}, {}
    for i in range(0, 30, 2):
        line = fresh(100)
        near = [f"c{i}" if at in (33, 67) else x for at, x in enumerate(line)]
        rows += [(i, "\n".join(map(" ".join, (fresh(50), line, fresh(40))))), (i + 1, "\n".join(map(" ".join, (fresh(45), near))))]
        changed[i + 1] = (45, 100)
    for i in range(100, 130, 2):
        shared = fresh(51 + i % 7)
        rows += [(i, " ".join(fresh(60) + shared + fresh(70))), (i + 1, " ".join(fresh(80) + shared + fresh(90)))]
        run[i + 1] = (80, len(shared))
    rows += [(200, " ".join(p := fresh(20)) + "\n" + " ".join(q := fresh(20)) + "\n\n" + " ".join(fresh(90))), (201, " ".join(fresh(99)) + "\n \n" + " ".join(p) + "\n" + " ".join(q[:19] + ["other"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.start, r.n_words) for r in passages.repeated_passages(df).collect()}
    assert {i: got[i] for i in run} == run
    whole = [i for i, span in changed.items() if got.get(i) == span]
    assert len(whole) >= 14 and got[201] == (99, 40) and set(got) <= {201, *run, *changed}  # bands find 99 of 100


def test_passages_against_brute_force(spark):
    """All pairs of paragraphs at 0.8 or more, and all shared runs of 51 words or more: nearly all are cut, and nothing else."""
    rng = random.Random(21)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    pool, texts = [fresh(rng.choice([32, 40, 90, 180, 400])) for _ in range(40)], {}

    def edited(line):
        line = list(line)
        for at in rng.sample(range(len(line)), rng.randrange(0, 1 + len(line) // 30)):
            line[at] = fresh(1)[0]
        return line

    for i in range(160):
        lines = [edited(rng.choice(pool)) if rng.random() < 0.3 else fresh(rng.choice([3, 33, 100, 250])) for _ in range(rng.randrange(1, 6))]
        texts[i] = [x + rng.choice(pool)[:60] if rng.random() < 0.1 else x for x in lines]
    df = spark.createDataFrame([(i, "\n".join(map(" ".join, t))) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    cut: dict[int, set] = {i: set() for i in texts}
    for r in passages.repeated_passages(df).collect():
        cut[r.doc_id] |= set(range(r.start, r.start + r.n_words))
        assert r.found_in < r.doc_id
    flat = {i: [w for x in t for w in x] for i, t in texts.items()}
    paragraphs = []  # (document, first word, words, shingles): lines and blocks
    for i, t in texts.items():
        at = 0
        for x in [*t, flat[i]]:
            paragraphs.append((i, at if x is not flat[i] else 0, len(x), shingles(" ".join(x), 5))) if len(x) >= 32 else None
            at += len(x)
    pairs = [(p, q) for p in paragraphs for q in paragraphs if p[0] < q[0] and 10 * len(p[3] & q[3]) >= 8 * len(p[3] | q[3])]
    lost = [set(range(q[1], q[1] + q[2])) <= cut[q[0]] for _, q in pairs]
    assert len(pairs) > 100 and sum(lost) / len(lost) >= 0.97
    grams: dict[tuple, list] = {}
    for i, w in flat.items():
        for p in range(len(w) - 50):
            grams.setdefault(tuple(w[p : p + 51]), []).append((i, p))
    for places in grams.values():
        keeper = min(i for i, _ in places)
        for i, p in places:
            left = sorted(set(range(p, p + 51)) - cut[i])  # at an end only, where another holder's run is shorter
            assert i == keeper or len(left) <= 19 and (not left or left[0] == p or left[-1] == p + 50)
    held: dict[tuple, set] = {}  # words of a cut that no shingle of another document has, and no paragraph that is like one
    for i, w in flat.items():
        for p in range(len(w) - 4):
            held.setdefault(tuple(w[p : p + 5]), set()).add(i)
    for i, w in flat.items():
        may = {x for p in range(len(w) - 4) if held[tuple(w[p : p + 5])] - {i} for x in range(p, p + 5)}
        may |= {x for p, q in pairs for s in (p, q) if s[0] == i for x in range(s[1], s[1] + s[2])}
        assert len(cut[i] - may) <= 0.12 * len(cut[i])


def test_tuned_bands():
    assert passages.tune_bands(0.8, 3, 0.88) == 3 and passages.tune_bands(0.8, 1, 0.5) == 1


def test_bands_find_nearly_all_pairs_at_the_threshold():
    """By default: 99 of 100 in theory, and by the code that makes the keys."""
    default = {k: v.default for k, v in inspect.signature(passages.repeated_passages).parameters.items()}
    bands, rows = passages.tune_bands(0.8, default["rows"], default["recall"]), default["rows"]
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99
    rng, met = random.Random(2), 0
    for _ in range(200):
        p = [f"u{rng.randrange(10**9)}" for _ in range(32)]
        q = p[:29] + [f"u{rng.randrange(10**9)}" for _ in range(3)]
        assert 25 / 31 >= 0.8 and len(shingles(" ".join(p), 5) & shingles(" ".join(q), 5)) == 25
        keys = [{}, {}]
        for side, w in enumerate((p, q)):
            batch = pa.RecordBatch.from_pydict({"id": pa.array([side]), "text": pa.array([" ".join(w)])})
            for b in passages._banded(32, 20, 96, bands, rows)([batch]):
                keys[side] |= dict.fromkeys(b.column("key").to_pylist())
        met += bool(keys[0].keys() & keys[1].keys())
    assert met >= 194


def vectors(spark, n, width=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width)).astype(np.float32)
    for i in range(0, n // 3, 3):
        x[i + 1] = x[i] + rng.standard_normal(width).astype(np.float32) * 0.04
        x[i + 2] = 3 * x[i]
    x[n - 8 :] = x[n - 9]
    labels = rng.integers(0, 2, n).tolist()
    rows = [(i, v.tolist(), labels[i]) for i, v in enumerate(x)]
    rows += [(n, None, 0), (n + 1, [0.0] * width, 0), (n + 2, [float("nan")] * width, 0), (n + 3, [None] + [1.0] * (width - 1), 0), (n + 4, x[0].tolist(), None), (n + 5, [], 1), (n + 6, [1.0, 2.0], 1)]
    return x.astype(float), labels, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


@pytest.mark.parametrize("tile", [1024, 4])
def test_near_embeddings_equal_brute_force(spark, tile):
    x, labels, df = vectors(spark, 240)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = u @ u.T
    linked = lambda a, b: labels[a] == labels[b] and cos[a, b] >= 0.98
    want = brute_components(range(240), linked)
    got = {r.vec_id: r for r in embedding_dedup.near_embeddings(df, tile=tile).collect()}
    assert len(got) == 247
    for i in range(240):
        r = got[i]
        assert (r.n_links, r.component_id, r.kept) == (sum(linked(i, j) for j in range(240) if j != i), want[i], want[i] == i)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(240, 247))
    assert embedding_dedup.near_embeddings(df.limit(0)).count() == 0


def test_embeddings_with_repeated_ids_widths_and_any_label(spark):
    """Every row comes back once, and nothing depends on how rows are dealt."""
    rng = np.random.default_rng(3)
    a, b, c = rng.standard_normal(8), rng.standard_normal(8), rng.standard_normal(3)
    rows = [(1, a, "en"), (1, b, "en"), (2, a * 2, "en"), (3, b + 1e-4, "en"), (4, a, "de"), (5, c, "en"), (6, c * 3, "en"), (7, None, "en"), (2, None, "en"), (2, np.zeros(8), "en"), (8, a, None), (None, a, "en"), (9, a, "en"), (9, a, "en"), (10, a[:7], "en"), (11, a * 1e200, "de")]
    df = spark.createDataFrame([(i, None if v is None else v.tolist(), x, "clash") for i, v, x in rows], "vec_id long, embedding array<double>, label string, n_links string")
    want = Counter({(1, 3, 1, True): 1, (1, 1, 1, True): 1, (2, 3, 1, False): 1, (3, 1, 1, False): 1, (4, 1, 4, True): 1, (11, 1, 4, False): 1, (5, 1, 5, True): 1, (6, 1, 5, False): 1, (7, 0, 7, True): 1, (2, 0, 2, True): 2, (8, 0, 8, True): 1, (None, 0, None, True): 1, (9, 3, 1, False): 2, (10, 0, 10, True): 1})
    for parts in (1, 7):
        got = embedding_dedup.near_embeddings(df.repartition(parts, F.rand(4))).collect()
        assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want


def test_codes_and_bands_lose_no_pair(spark):
    """Pairs at the threshold and hot groups, whatever the tile; bits follow the largest group, and the miss rate stays."""
    for n in (10, 10**5, 10**11):
        bits, bands = embedding_dedup.tune_bits(0.98, n, 4e-6)
        assert 2**bits >= 2 * n and (1 - (1 - np.arccos(0.98) / np.pi) ** bits) ** bands <= 4e-6
    rng = np.random.default_rng(8)
    center = rng.standard_normal((3, 64))
    x = np.concatenate([c + rng.standard_normal((150, 64)) * s for c, s in zip(center, (0.08, 0.15, 0.5))]).astype(np.float32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.98
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(4)
    assert 5000 < near.sum() < 40_000
    for tile in (1024, 100):
        got = {r.vec_id: r.n_links for r in embedding_dedup.near_embeddings(df, tile=tile).collect()}
        assert [got[i] for i in range(len(x))] == near.sum(1).tolist()


def test_nearest_recall_scores_and_ties(spark):
    x, _, df = vectors(spark, 700, seed=3)
    df = df.where("vec_id <> 704")  # a copy without a label
    got = nearest.nearest(df, F.col("vec_id") % 50 == 0, k=10, orderings=12, part_rows=100, part_pairs=900).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(range(0, 700, 50))
    hit = 0
    for i, rows in by.items():
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 11)) and all(abs(d[r.vec_id] - r.score) < 1e-12 for r in rows)
        assert [(r.score, r.vec_id) for r in rows] == sorted((r.score, r.vec_id) for r in rows)
        hit += len({r.vec_id for r in rows} & set(np.lexsort((np.arange(700), d))[:10].tolist()))
    assert hit / (10 * len(by)) >= 0.9


def test_nearest_recall_without_structure(spark):
    """The defaults on vectors of no structure: recall of 0.95 or more, and fewer comparisons than rows."""
    x = np.random.default_rng(1).standard_normal((3000, 32)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    hit, x = 0, x.astype(float)
    for r in nearest.nearest(df, F.col("vec_id") % 30 == 0).groupBy("query_id").agg(F.collect_list("vec_id").alias("ids")).collect():
        d = ((x - x[r.query_id]) ** 2).sum(1)
        d[r.query_id] = np.inf
        assert len(r.ids) == len(set(r.ids)) == 10
        hit += len(set(r.ids) & set(np.argsort(d)[:10].tolist()))
    assert hit / 1000 >= 0.95


def test_nearest_with_repeated_ids(spark):
    """An id's nearest vector counts, on either side; every query has one ranking."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((60, 4))
    ids = [i % 20 for i in range(60)]
    rows = [(i, v.tolist()) for i, v in zip(ids, x)] * 2 + [(0, None), (None, x[0].tolist()), (1, [1.0]), (2, [0.0] * 4)]
    got: dict[int, list] = {}
    for r in nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("vec_id") < 5, k=6).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(5):
        d = {i: min(np.sqrt(((x[a] - x[b]) ** 2).sum()) for a in range(60) for b in range(60) if ids[a] == q and ids[b] == i) for i in range(20) if i != q}
        want = sorted(d.items(), key=lambda e: (e[1], e[0]))[:6]
        assert [(r, i) for r, i, _ in got[q]] == [(n + 1, i) for n, (i, _) in enumerate(want)] and np.allclose([s for *_, s in got[q]], [s for _, s in want])


def test_nearest_ties_go_to_the_smaller_id(spark):
    """Many different vectors at exactly one distance, over several parts."""
    rng = np.random.default_rng(6)
    signs = np.array([[1 - 2 * (i >> b & 1) for b in range(7)] for i in range(128)])  # all at distance 7 ** 0.5 from none but equal coordinates
    ids = (2**60 + rng.permutation(1000)[:128]).tolist()  # beyond what a double tells apart
    rows = [(i, [*map(float, s), 0.0]) for i, s in zip(ids, signs)] + [(5000, [0.0] * 7 + [1.0])]
    got = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("vec_id") == 5000, part_rows=20).orderBy("rank").collect()
    assert [r.vec_id for r in got] == sorted(ids)[:10] and {round(r.score, 9) for r in got} == {round(8**0.5, 9)}


def test_nearest_with_copies_and_few_candidates(spark):
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(100, [1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in nearest.nearest(df, F.col("vec_id") == 7, k=10).orderBy("rank").collect()]
    assert got == [(i, 0.0) for i in range(11) if i != 7]
    few = nearest.nearest(df.where("vec_id >= 38"), F.col("vec_id") == 100, k=10).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in few] == [(38, 1.0), (39, 1.0)]
    assert nearest.nearest(df.limit(0), F.col("vec_id") == 7).count() == 0
    assert nearest.nearest(df, F.col("vec_id") == -1).count() == 0


def test_hilbert_curve_moves_one_cell_at_a_time():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = nearest.hilbert_keys(cells, 3)
    walk = cells[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_code_estimates_are_unbiased():
    from aeroperf.llm.vectors import rotation

    rng, d = np.random.default_rng(0), 64
    u = rng.standard_normal((2, d))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    got = []
    for seed in range(400):
        o, q = u @ rotation(d, seed)
        code = np.sign(o) / np.sqrt(d)
        got.append(code @ q / (code @ o))
    assert abs(np.mean(got) - u[0] @ u[1]) < 4 * np.std(got) / 20


def test_short_lines_go_where_asked(spark):
    """A line of 30 words, the same in 50 documents between unlike lines; one of 7 words stays."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    line, brief = " ".join(word() for _ in range(30)), " ".join(word() for _ in range(7))
    rows = [(i, "\n".join([" ".join(word() for _ in range(40)), line, " ".join(word() for _ in range(12)), brief])) for i in range(50)]
    docs = spark.createDataFrame([*rows, (50, line), (51, None), (52, "")], "doc_id long, text string")
    assert passages.repeated_passages(docs).count() == 0
    got = passages.repeated_passages(docs, short=8).collect()
    assert {(r.doc_id, r.start, r.n_words) for r in got} == {(i, 40, 30) for i in range(1, 50)} | {(50, 0, 30)} and all(r.found_in < r.doc_id for r in got)


def test_recall_of_near_passages_inside_long_lines(spark):
    """A passage with a changed word in every 60, inside lines of 400 unlike words: of 200 words 0.94 go, of 120 words 0.76."""
    rng = random.Random(6)
    words_of = lambda n: ["".join(rng.choices("abcdefghij", k=7)) for _ in range(n)]
    rows, want = [], {}
    for i in range(60):
        size = (120, 200)[i % 2]
        passage = words_of(size)
        other = [w if j % 60 != 30 else w + "x" for j, w in enumerate(passage)]
        for k, own in enumerate((passage, other)):
            before = words_of(rng.randint(150, 200))
            rows.append((2 * i + k, " ".join([*before, *own, *words_of(200)])))
        want[2 * i + 1] = (size, len(before))
    cut = Counter()
    for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        size, begin = want[r.doc_id]
        cut[r.doc_id] += max(0, min(r.start + r.n_words, begin + size) - max(r.start, begin))
        assert r.start >= begin - 11 and r.start + r.n_words <= begin + size + 11  # up to a ninth of a near window may be its own
    share = lambda size: sum(cut[d] for d, (s, _) in want.items() if s == size) / sum(s for s, _ in want.values() if s == size)
    assert share(200) > 0.9 and share(120) > 0.7, (share(120), share(200))


def test_nearest_in_many_rooms_is_the_same(spark):
    """A reach of a fixed share of the rows: the lists of a block are dealt to rooms, and nothing else changes."""
    rng = np.random.default_rng(4)
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(3000, 24)))], "vec_id long, embedding array<double>")
    run = lambda **o: sorted(map(tuple, nearest.nearest(vectors, F.col("vec_id") % 50 == 0, orderings=6, **o).collect()))
    assert run() == run(room_ids=2000)
