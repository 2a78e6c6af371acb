"""The divergence audit against brute force, with seats of several groups, several shards and odd rows."""

import re
from collections import Counter, defaultdict

import pytest

from aeroperf.llm import divergence


def brute(rows, min_docs, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower)
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in docs:
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        own = {s: Counter({t: n for t, n in c.items() if t in kept}) for (x, s), c in counts.items() if x == lang}
        whole = sum(own.values(), Counter())
        value = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        p = {s: {t: value(c, t) for t in kept} for s, c in own.items()}
        q = {t: value(whole, t) for t in kept}
        for s in own:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in own if o != s)
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if own[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, i.decode(), -v, k) for part, x in (("pair", pairs), ("term", terms)) for k, (v, i) in enumerate(x, 1)]
    return sorted(out)


def rows_of(n_sources):
    """A hot source with a third of the rows, ties, words beyond ASCII, nulls, empty and repeated texts, and a language without kept terms."""
    words = ["Ab", "bé", "çà", "dd", "eE", "zz9yy", "日本", "_f_", "gh"]
    rows = [(" ".join(words[(i * j) % 9] for j in range(1 + i % 12)), "xx", f"s{i % n_sources}") for i in range(240)]
    rows += [("ab ab gh", "xx", "s0")] * 120 + [(None, "xx", "none"), ("", "xx", ""), (None, None, None), ("ab", None, "s1"), ("rare", "yy", "a"), ("scarce", "yy", "b"), ("x" * 1_500_000 + " ab", "xx", "s1")]
    return rows


@pytest.mark.parametrize("n_sources,seats,shard_terms", [(5, 64, 1 << 15), (6, 3, 3), (7, 4, 2), (12, 12, 1)])
def test_equals_brute_force(spark, n_sources, seats, shard_terms):
    rows = rows_of(n_sources)
    docs = spark.createDataFrame([(*r, "mine", 7) for r in rows], "text string, lang string, source string, `rank` string, n int").repartition(5)
    got = divergence.divergence(docs, min_docs=10, top=4, seats=seats, shard_terms=shard_terms)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 10, 4)


def test_each_pair_of_seats_meets_once_and_a_seat_has_one_visitor_a_round(spark):
    for n in (2, 3, 8, 9):
        groups = spark.range(n).selectExpr("'x' AS lang", "concat('s', id) AS source", "cast(id AS int) AS slot", "cast(id AS int) AS seat", f"{n} AS seats", "1 AS shards", "0L AS base")
        vectors = spark.createDataFrame([], "lang string, shard int, slot int, held int, vector binary")
        kept = spark.createDataFrame([("x", 0)], "lang string, shard int")
        met = [r for r in divergence._rounds(groups, vectors, kept).collect() if r["round"] >= 0]
        assert sorted(tuple(sorted((r["home"], r["slot"]))) for r in met) == [(i, j) for i in range(n) for j in range(i + 1, n)]
        busy = Counter((r["round"], seat) for r in met for seat in (r["home"], r["slot"]))
        assert set(busy.values()) == {1} and max(r["round"] for r in met) < n + n % 2 - 1


def test_values_are_exact_beyond_64_bits(spark):
    c, n, v = 80_000_000_000_000, 89_999_999_999_999, 1_000
    got = spark.range(1).select(divergence.smoothed(*[divergence.F.lit(x) for x in (c, n, v)])).first()[0]
    assert got == 1 + 10**9 * (c + 5) // (n + 5 * v)
