"""URL filter: a cascade of Bloom filters decides exactly, without a join, which rule a URL falls under.

Level 0 encodes the listed keys. Level 1 encodes the keys of the corpus that
level 0 takes for listed by mistake, level 2 the listed keys that level 1 takes
for those, and so on until a level makes no mistake. The first level that says
"absent" settles a key; for every key of the universe it was built over (all
candidate keys of the corpus, and the list) the answer is exact.

The first level's size follows from the numbers of listed and of corpus keys,
so that about half as many false positives as listed keys are left. Each level
therefore is of the size of the list (times the logarithm of corpus over list),
whatever the corpus: it is what is broadcast, and ``max_filter_bytes`` bounds
it by an error, never by dropping keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroperf.llm.storage import discard, stored

U = np.uint64


@dataclass
class Level:
    bits: np.ndarray  # uint64 words
    size: int
    probes: int


@dataclass
class Cascade:
    """``levels`` and nothing else; empty for an empty list."""

    levels: list[Level]

    def contains(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Membership of keys given by their two 64-bit hashes."""
        found = np.zeros(len(one), bool)
        open_at = np.arange(len(one))
        for depth, level in enumerate(self.levels):
            if not len(open_at):
                break
            hit = _probe(level, one[open_at], two[open_at], depth)
            # absent at an even depth: not listed; absent at an odd depth: listed
            found[open_at[~hit]] = depth % 2 == 1
            open_at = open_at[hit]
        found[open_at] = len(self.levels) % 2 == 1  # present at the last level
        return found

    @property
    def nbytes(self) -> int:
        return sum(x.bits.nbytes for x in self.levels)


def _places(size: int, probes: int, one: np.ndarray, two: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    step = two | U(1)
    for i in range(probes):
        x = one + step * U(i + 1 + 64 * depth)
        x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
        yield (x ^ (x >> U(29))) % U(size)


def _probe(level: Level, one: np.ndarray, two: np.ndarray, depth: int) -> np.ndarray:
    hit = np.ones(len(one), bool)
    for at in _places(level.size, level.probes, one, two, depth):
        hit &= (level.bits[at >> U(6)] >> (at & U(63))) & U(1) == 1
    return hit


def _level(one: np.ndarray, two: np.ndarray, rate: float, depth: int) -> Level:
    size = max(64, math.ceil(-max(1, len(one)) * math.log(rate) / math.log(2) ** 2))
    probes = max(1, round(-math.log2(rate)))
    bits = np.zeros(-(-size // 64), np.uint64)
    for at in _places(size, probes, one, two, depth):
        np.bitwise_or.at(bits, at >> U(6), U(1) << (at & U(63)))
    return Level(bits, size, probes)


def _hashes(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.xxhash64(F.lit("one"), key).alias("one"), F.xxhash64(F.lit("two"), key).alias("two"))


def _numpy(hashes: DataFrame, what: str, max_filter_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of hashes, to the driver, in order; counted before, so that no more than ``max_filter_bytes`` arrive."""
    kept = stored(hashes.distinct(), "filter-keys")
    n = kept.count()
    if 16 * n > max_filter_bytes:
        raise ValueError(f"{n} {what} pass max_filter_bytes={max_filter_bytes}")
    got = kept.toArrow()
    discard(kept)
    one, two = (got.column(i).to_numpy().view(np.uint64) for i in (0, 1))
    order = np.lexsort((two, one))
    return one[order], two[order]


def _among(keys: tuple[np.ndarray, np.ndarray], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which pairs of hashes are among ``keys``, which are in order."""
    at, found = np.searchsorted(keys[0], one), np.zeros(len(one), bool)
    for _ in range(int(np.unique(keys[0], return_counts=True)[1].max(initial=0))):  # once, but for colliding hashes
        here = np.minimum(at, len(keys[0]) - 1)
        found |= (at < len(keys[0])) & (keys[0][here] == one) & (keys[1][here] == two)
        at = at + 1
    return found


def build_cascade(listed: DataFrame, universe: DataFrame, max_filter_bytes: int = 256 << 20) -> Cascade:
    """``listed`` and ``universe`` hold one string column ``key``; the universe may hold listed keys and repeats.

    Null keys count for nothing. Raises ValueError when the listed keys' hashes,
    a filter, or the false positives would pass ``max_filter_bytes``, before they
    are gathered or sent. False positives of level 0 are found by one job over
    the universe; of later levels, among those and the list alone.
    """
    spark = universe.sparkSession
    member = _numpy(_hashes(listed.where("key is not null"), "key"), "listed keys", max_filter_bytes)
    n = len(member[0])
    if not n:
        return Cascade([])
    total = universe.agg(F.approx_count_distinct("key")).first()[0]
    rate = min(0.5, max(n / (2 * max(1, total)), 2.0**-40))
    if -n * math.log(rate) / math.log(2) ** 2 / 8 > max_filter_bytes:
        raise ValueError(f"a filter of {n} keys passes max_filter_bytes={max_filter_bytes}")
    first = _level(*member, rate, 0)
    shared = spark.sparkContext.broadcast((first, member))

    @F.pandas_udf(T.BooleanType())
    def mistaken(one: pd.Series, two: pd.Series) -> pd.Series:
        level, keys = shared.value
        a, b = one.to_numpy().view(np.uint64), two.to_numpy().view(np.uint64)
        hit = _probe(level, a, b, 0)
        hit[hit] = ~_among(keys, a[hit], b[hit])
        return pd.Series(hit)

    wrong = _numpy(_hashes(universe.where("key is not null"), "key").where(mistaken("one", "two")), "false positives", max_filter_bytes)
    levels, inside, outside = [first], member, wrong
    while len(outside[0]):
        depth = len(levels)
        levels.append(_level(*outside, 0.5, depth))
        inside = tuple(x[_probe(levels[-1], *inside, depth)] for x in inside)
        inside, outside = outside, inside
    return Cascade(levels)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys under which a rule would fit: for each shape (labels of the host, characters of the path), ``host + path`` cut to it."""
    labels = F.size(F.split(host, "\\."))
    keys = [F.when((labels >= n) & (F.length(path) >= m), F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m))) for n, m in shapes]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", default: str = "allow", max_filter_bytes: int = 256 << 20) -> tuple[DataFrame, dict[str, Cascade]]:
    """Adds host, path, rule and verdict to every row; ``rules`` are (host, path prefix, verdict).

    A rule fits its host and all subdomains where the path begins with its own;
    the longest fitting rule wins. A URL under no rule is absent from every
    cascade and gets ``default``. A null URL, or one without ``://``, has an
    empty host and path, which no rule fits. Columns of these names in
    ``pages`` are replaced. Rows are neither lost nor repeated. A repeated rule
    counts once; one listed with two verdicts raises ValueError.
    """
    spark, verdicts = pages.sparkSession, sorted({v for _, _, v in rules})
    seen: dict[str, str] = {}
    for h, p, v in rules:
        if seen.setdefault(h + p, v) != v:
            raise ValueError(f"rule {h + p} has two verdicts")
    shapes = sorted({(len(h.split(".")), len(p)) for h, p, _ in rules})
    df = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    keys = candidate_keys(F.col("host"), F.col("path"), shapes)
    universe = df.select(F.explode(keys).alias("key"))
    cascades = {v: build_cascade(spark.createDataFrame([(h + p,) for h, p, w in rules if w == v], "key string"), universe, max_filter_bytes) for v in verdicts}
    shared = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("struct<rule:string,verdict:string>")
    def decide(key: pd.Series, one: pd.Series, two: pd.Series) -> pd.DataFrame:
        counts = key.map(len).to_numpy()
        row = np.repeat(np.arange(len(key)), counts)
        flat = np.concatenate([np.asarray(x, object) for x in key]) if len(row) else np.zeros(0, object)
        a, b = (np.concatenate([np.asarray(y, np.int64) for y in x]).view(np.uint64) if len(row) else np.zeros(0, np.uint64) for x in (one, two))
        rule, verdict = np.full(len(key), None, object), np.full(len(key), default, object)
        names, hits = list(shared.value), [np.flatnonzero(c.contains(a, b)) for c in shared.value.values()]
        hit, of = np.concatenate([*hits, np.zeros(0, np.int64)]), np.repeat(np.arange(len(hits)), [len(h) for h in hits])
        length = np.fromiter(map(len, flat[hit]), np.int64, len(hit))
        order = np.lexsort((length, row[hit]))  # the last of a row is its longest
        hit, of = hit[order], of[order]
        last = np.flatnonzero(np.diff(row[hit], append=-1))
        rule[row[hit[last]]], verdict[row[hit[last]]] = flat[hit[last]], np.array(names, object)[of[last]] if len(last) else []
        return pd.DataFrame({"rule": rule, "verdict": verdict})

    one, two = F.transform(keys, lambda k: F.xxhash64(F.lit("one"), k)), F.transform(keys, lambda k: F.xxhash64(F.lit("two"), k))
    got = decide(keys, one, two)
    out = df.withColumn("_judged", got).withColumns({"rule": F.col("_judged.rule"), "verdict": F.col("_judged.verdict")})
    return out.drop("_judged"), cascades
