"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is one matrix of log probabilities, a row for each hash bucket and a
column for each language; a batch of texts is scored by sparse gathers from it
in numpy. Its size is fixed by ``buckets``, so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroperf.llm.hashing import slices
from aeroperf.llm.workers import tidy

LETTER = regex.compile(r"\p{L}")
CHUNK = 1 << 18


@dataclass
class LanguageModel:
    langs: list[str]
    logs: np.ndarray  # float32 [buckets, langs]
    prior: np.ndarray
    orders: tuple[int, ...]


def _features(codes: np.ndarray, doc: np.ndarray, order: int, buckets: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram that stays inside one text and begins among the first ``most`` code points, and its text."""
    n = min(most, len(codes) - order + 1)
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.full(n, order, np.uint32)
    for i in range(order):
        h = (h ^ codes[i : i + n]) * np.uint32(2654435761)
        h ^= h >> np.uint32(15)
    whole = doc[:n] == doc[order - 1 : order - 1 + n]
    return (h & np.uint32(buckets - 1))[whole], doc[:n][whole]


def _batches(texts: list[str | None], overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Lower-cased code points between blanks, the text of each, and how many n-grams may begin: bounded chunks.

    A chunk of a very long text goes on for ``overlap`` code points in which no n-gram of its own begins.
    """
    codes, docs, size = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        own = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(own) > CHUNK:
            for at in range(0, len(own), CHUNK):
                part = own[at : at + CHUNK + overlap]
                yield part, np.full(len(part), i), CHUNK
            continue
        codes.append(own)
        docs.append(np.full(len(own), i))
        size += len(own)
        if size >= CHUNK:
            yield np.concatenate(codes), np.concatenate(docs), size
            codes, docs, size = [], [], 0
    if codes:
        yield np.concatenate(codes), np.concatenate(docs), size


def train_language_model(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows_per_lang: int = 3000, buckets: int = 1 << 15, orders: tuple[int, ...] = (2, 3), smoothing: float = 0.5, max_langs: int = 1024) -> LanguageModel:
    """Fit on about ``rows_per_lang`` whole labelled texts of each language, chosen by a hash of ``key``.

    Rows with a null text or language are not used. Counts of n-grams are
    summed by language and bucket before they reach the driver: at most
    ``buckets`` rows for each language. No labelled row gives a model without
    languages, under which every text is ``und``. More than ``max_langs``
    languages raise ValueError: a model holds 4 bytes, and a task that counts 8,
    for each language and bucket.
    """
    spark = labelled.sparkSession
    df = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit("train"), F.col(key)).alias("h"))
    sizes = {r["lang"]: r["n"] for r in df.groupBy("lang").agg(F.count("*").alias("n")).limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages: labels of another kind, or raise max_langs")
    if not sizes:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), np.zeros(0), orders)
    langs = sorted(sizes)
    shares = spark.createDataFrame([(name, int(min(1.0, rows_per_lang / n) * (1 << 20))) for name, n in sizes.items()], "lang string, _of long")
    chosen = df.join(F.broadcast(shares), "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("_of"))  # max_langs rows at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), buckets), np.int64)
        docs = np.zeros(len(langs), np.int64)
        at = {x: i for i, x in enumerate(langs)}
        for batch in (part for b in batches for part in slices(b, "text")):
            own = np.array([at[x] for x in batch.column("lang").to_pylist()], np.int64)
            np.add.at(docs, own, 1)
            for codes, doc, most in _batches(batch.column("text").to_pylist(), max(orders) - 1):
                for order in orders:
                    f, d = _features(codes, doc, order, buckets, most)
                    total += np.bincount(own[d] * buckets + f, minlength=total.size).reshape(total.shape)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["lang", "bucket", "n"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(langs))), pa.array(np.full(len(langs), -1)), pa.array(docs)], ["lang", "bucket", "n"])

    got = chosen.select("lang", "text").mapInArrow(tidy(count), "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    i, j, n = (got.column(x).to_numpy() for x in ("lang", "bucket", "n"))
    table = np.full((buckets, len(langs)), smoothing)
    np.add.at(table, (j[j >= 0], i[j >= 0]), n[j >= 0])
    docs = np.full(len(langs), 1.0)
    np.add.at(docs, i[j < 0], n[j < 0])
    return LanguageModel(langs, np.log(table / table.sum(0)).astype(np.float32), np.log(docs / docs.sum()), orders)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds lang_pred and score, or other ``names``, to every row, and keeps all other columns (older ones of these names are replaced).

    A null text, or one without a letter (Unicode category L), is ``und`` with
    score 0. The score is the posterior probability of the language under the
    mean log likelihood per n-gram times the square root of their number,
    which keeps long texts from all saturating at 1. Ties go to the language
    that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.drop(*names)
    schema = T.StructType([*base.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k, buckets = len(m.langs), len(m.logs)
        for batch in (part for b in batches for part in slices(b, text)):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            total, grams = np.zeros((len(texts), max(k, 1))), np.zeros(len(texts))
            for codes, doc, most in _batches(texts, max(m.orders) - 1):
                lo, hi = doc[0], doc[-1] + 1
                for order in m.orders:
                    f, d = _features(codes, doc, order, buckets, most)
                    if k and len(f):
                        starts = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
                        total[d[starts]] += np.add.reduceat(m.logs[f], starts, axis=0, dtype=np.float64)
                        grams[lo:hi] += np.bincount(d - lo, minlength=hi - lo)
            known = np.array([bool(k and t and LETTER.search(t)) for t in texts], bool)
            langs, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if k and len(texts):
                odds = total / np.sqrt(np.maximum(grams, 1))[:, None] + m.prior
                best = odds.argmax(1)
                odds = np.exp(odds - odds.max(1, keepdims=True))
                langs[known] = np.array(m.langs, object)[best[known]]
                score[known] = (odds.max(1) / odds.sum(1))[known]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(score)], names=[*batch.schema.names, *names])

    return base.mapInArrow(tidy(predict), schema)
