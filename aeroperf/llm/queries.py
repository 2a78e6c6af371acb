"""The queries of the operators, each over its whole table, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroperf.llm import bpe, divergence, embedding_dedup, jaccard, language, mixing, nearest, packing, passages, spelling, storage, token_files, url_filter, warc

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: (host, path, verdict)
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest of each vector whose id is divisible by 100. Nulls, repeats and empty tables as in ``nearest``."""
    return nearest.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens. Nulls, repeats and empty tables as in ``pack``."""
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as ARC files, converted to WARC and read back. Nulls, repeats and empty tables as in ``write_arc`` and ``choose_responses``."""
    arcs, warcs = storage.scratch(spark, "arc"), storage.scratch(spark, "warc")
    warc.write_arc(_table(spark, sf_dir, "pages"), arcs)
    warc.convert_arc(spark, arcs, warcs)
    return warc.read_warc(spark, warcs).select(F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page. Null and broken URLs, repeats and empty tables as in ``judge_urls``."""
    out, _ = url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents at 0.85 over 4-word shingles. Nulls, repeats and empty tables as in ``jaccard_components``."""
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language for every document, learnt from those whose id does not hash to 2 modulo 4 (a null id is learnt from). Nulls, repeats and empty tables as in ``identify``."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.train_language_model(docs.where(~held_out))
    out = language.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors of one label at a cosine of 0.98. Nulls, repeats and empty tables as in ``near_embeddings``."""
    return embedding_dedup.near_embeddings(_table(spark, sf_dir, "embeddings"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back. Nulls, repeats and empty tables as in ``write_token_files``."""
    folder = storage.scratch(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, TOKENIZER)
    return token_files.read_token_files(spark, folder)


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all documents that a document of a smaller id holds too. Nulls, repeats and empty tables as in ``repeated_passages``."""
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as often as the mixture takes them. Nulls, repeats and empty tables as in ``mix``."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, TOKENIZER).select("doc_id", "source", "epoch", "mix_weight", "mix_order")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source of every language against the others and its terms against the language's. Nulls, repeats and empty tables as in ``divergence``."""
    return divergence.divergence(_table(spark, sf_dir, "documents"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by ranks and decoded again. Nulls, repeats and empty tables as in ``encode``."""
    both = bpe.encode_and_decode(_table(spark, sf_dir, "documents").select("doc_id", "text"), RANKS, public_tokenizers.PATTERN)
    return both.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every frequent word. Nulls, repeats and empty tables as in ``spelling_variants``."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest": op1_nearest,
    "op2_packing": op2_packing,
    "op3_warc": op3_warc,
    "op4_url_filters": op4_url_filters,
    "op5_jaccard": op5_jaccard,
    "op6_language_id": op6_language_id,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_token_files": op8_token_files,
    "op9_passages": op9_passages,
    "op10_mixing": op10_mixing,
    "op11_divergence": op11_divergence,
    "op12_bpe": op12_bpe,
    "op13_spelling": op13_spelling,
}

ORACLE_SQL: dict[str, str] = {
    "op5_jaccard": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS c FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.c, w.doc_id) AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.node = w.doc_id
""",
    "op7_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
r AS (SELECT a AS node, a AS seen FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
c AS (SELECT node, min(seen) AS c FROM r GROUP BY node), n AS (SELECT a, count(*) AS n FROM l GROUP BY ALL)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.c, vec_id) AS component_id, vec_id = coalesce(c.c, vec_id) AS kept FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.node = vec_id
""",
    "op11_divergence": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text, row_number() OVER () AS doc FROM documents),
t AS (SELECT lang, source, doc, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS item FROM d),
l AS (SELECT lang, item, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
c AS (SELECT lang, source, item, count(*) AS n FROM t GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM l GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(c.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT c.* FROM c JOIN l USING (lang, item)) c USING (lang, source) GROUP BY ALL),
p AS (SELECT lang, source, item, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * v.v) AS p, 1 + (1000000000::HUGEINT * (l.n + 5)) // (v.n + 5 * v.v) AS q
  FROM g JOIN l USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, item)),
a AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.item = b.item AND a.source <> b.source GROUP BY ALL),
r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL SELECT lang, source, 'term', item, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r QUALIFY part = 'pair' OR rank <= 50
""",
    "op13_spelling": """
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS tab),
t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
r AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM t WHERE length(run) >= 6 GROUP BY ALL),
b AS (SELECT doc_id, run, n, list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i::INT + 1, 2))::BIGINT)) AS b FROM r),
h AS (SELECT run, n, xor(4294967295, list_reduce(b, lambda c, k: xor(c >> 8, tab[(xor(c, k) & 255) + 1]))) AS h FROM b, tab),
e AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= 6 GROUP BY word HAVING sum(e.n) >= 5),
d AS (SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word UNION SELECT a.word, w.word, w.n FROM d a JOIN w ON w.word = a.rest UNION SELECT a.rest, a.word, a.n FROM d a JOIN w ON w.word = a.rest),
m AS (SELECT word, count(*) AS n_near, max(n) AS best_n FROM p GROUP BY ALL),
f AS (SELECT w.word, w.n, coalesce(m.n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n, (SELECT min(near) FROM p WHERE p.word = w.word AND p.n = m.best_n AND m.best_n >= 5 * w.n) AS form FROM w LEFT JOIN m ON m.word = w.word),
c AS (SELECT word, word AS at, 0 AS step FROM f UNION ALL SELECT c.word, f.form, step + 1 FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, form, (SELECT arg_max(c.at, step) FROM c WHERE c.word = f.word) AS root, n, n_near, form_n FROM f
""",
    "op3_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS response FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND response < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND response < page_id THEN response END AS refers_to FROM r
""",
    "op4_url_filters": r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rhost, rpath, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT h.page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS verdict
  FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY h.page_id)
SELECT h.page_id, host, path, m.rule AS rule, coalesce(m.verdict, 'allow') AS verdict FROM h LEFT JOIN m ON h.page_id = m.page_id
""",
}
