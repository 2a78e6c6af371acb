import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroperf.llm import language, mixing, url_filter, warc
from aeroperf.llm.queries import RULES


def brute_judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_urls_equal_brute_force(spark):
    rng = random.Random(0)
    hosts = ["example.com", "WWW.Example.com", "a.net", "net", "xnet", "b.example.com", "example.org", "com", ".com", "", "user@h.com:80"]
    paths = ["", "/", "/en/", "/en/x", "/en", "/es/1", "/fr/?q", "?x=/en/", "#/en/", "/EN/", "//en/", "/x#/fr/"]
    urls = [f"{s}{h}{p}" for h in hosts for p in paths for s in ("http://", "")] + [None, "", "://", "a://b://com/", "http://Ünï.com/en/"]
    rows = [(i, u, "clash") for i, u in enumerate(urls + rng.choices(urls, k=50))]
    got, cascades = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string"), RULES)
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: brute_judge(u) for i, u, _ in rows}
    assert set(cascades) == {"allow", "block"}
    assert url_filter.judge_urls(spark.createDataFrame([], "url string"), RULES)[0].count() == 0
    assert {r.verdict for r in url_filter.judge_urls(spark.createDataFrame([("http://a.com/",)], "url string"), [])[0].collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    listed = spark.range(0, 300).select(F.concat(F.lit("k"), "id").alias("key"))
    universe = spark.range(0, 20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    c = url_filter.build_cascade(listed, universe)
    h = universe.select("key", F.xxhash64(F.lit("one"), "key").alias("a"), F.xxhash64(F.lit("two"), "key").alias("b")).toPandas()
    said = c.contains(h.a.to_numpy().view(np.uint64), h.b.to_numpy().view(np.uint64))
    assert set(h.key[said]) == {f"k{i}" for i in range(300)} and len(c.levels) > 1 and c.nbytes < 4000
    assert not url_filter.build_cascade(listed.limit(0), universe).contains(np.zeros(3, np.uint64), np.zeros(3, np.uint64)).any()
    with pytest.raises(ValueError):
        url_filter.build_cascade(listed, universe, max_filter_bytes=8)


def test_rules_may_not_contradict(spark):
    with pytest.raises(ValueError):
        url_filter.judge_urls(spark.createDataFrame([("a",)], "url string"), [("com", "/", "allow"), ("com", "/", "block")])


def test_language_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.train_language_model(docs.where("doc_id % 4 <> 2"))
    got = language.identify(docs, model).where("doc_id % 4 = 2").select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) >= 0.97 and all(0 <= r.score <= 1 for r in got)


def test_language_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "", "de"), (5, "12 34 !?", "en"), (6, "the the " * 200_000, None), (7, "é", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("old")).withColumn("score", F.lit(9))
    model = language.train_language_model(df)
    got = {r.doc_id: r for r in language.identify(df, model).collect()}
    assert {i: r.lang_pred for i, r in got.items() if i != 7} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", 6: "en"}
    assert got[3].score == 0 and got[7].lang_pred in ("en", "de") and len(got) == 7
    none = language.train_language_model(df.limit(0))
    assert {r.lang_pred for r in language.identify(df, none).collect()} == {"und"}
    assert language.identify(df.limit(0), model).count() == 0


def pages():
    long = "<html>" + "x" * 300 + "é</html>"
    return [(0, "http://a/ b", long), (1, "http://a/1", "short"), (2, None, "short"), (3, "u", None), (4, "u", ""), (5, "http://é/", long), (6, "u", long), (7, "u", "a\n\nb\r\n\r\nWARC/1.1\r\n" * 20), (None, "u", long), (6, "u", long)]


@pytest.mark.parametrize("version", [1, 2, None])
def test_archives_round_trip(spark, tmp_path, version):
    df = spark.createDataFrame([(*p, "x") for p in pages()], "page_id long, url string, html string, file string").repartition(3)
    a, w = f"file://{tmp_path}/a", f"file://{tmp_path}/w"
    assert warc.write_arc(df, a, version=version, max_bytes=400) == 10 and warc.convert_arc(spark, a, w) == 10
    got = warc.read_warc(spark, w, keep_payload=True).collect()
    kinds = Counter((r.row_id, r.record_type, r.refers_to) for r in got)
    assert kinds == Counter({(0, "response", None): 1, (1, "response", None): 1, (2, "response", None): 1, (3, "response", None): 1, (4, "response", None): 1, (5, "revisit", 0): 1, (6, "revisit", 0): 2, (7, "response", None): 1, (None, "revisit", 0): 1})
    import hashlib

    html = {p: (h or "").encode() for p, _, h in pages()}
    for r in got:
        assert r.payload_bytes == len(html[r.row_id]) and r.payload_digest == hashlib.sha256(html[r.row_id]).hexdigest()
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == html[r.row_id]


def test_revisits_name_their_response(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://h/{i}", "same " * 50) for i in range(4)], "page_id long, url string, html string").repartition(2)
    a, w = f"file://{tmp_path}/a", f"file://{tmp_path}/w"
    warc.write_arc(df, a)
    assert warc.convert_arc(spark, a, w) == 4
    records = [r.headers for p in (tmp_path / "w").glob("*.warc.gz") for r in warc.iterate_warc(f"file://{p}")]
    (response,) = (h for h in records if h["warc-type"] == "response")
    revisits = [h for h in records if h["warc-type"] == "revisit"]
    assert len(revisits) == 3 and response["warc-target-uri"] == "http://h/0"
    assert {(h["warc-refers-to"], h["warc-refers-to-target-uri"], h["warc-refers-to-date"]) for h in revisits} == {(response["warc-record-id"], "http://h/0", response["warc-date"])}


def test_a_very_long_page(spark, tmp_path):
    df = spark.createDataFrame([(0, "u", "é" * 3_000_000), (1, "v", "é" * 3_000_000), (2, "w", "short")], "page_id long, url string, html string")
    a, w = f"file://{tmp_path}/a", f"file://{tmp_path}/w"
    assert warc.write_arc(df, a) == 3 and warc.convert_arc(spark, a, w) == 3
    assert sorted((r.row_id, r.payload_bytes, r.refers_to) for r in warc.read_warc(spark, w).collect()) == [(0, 6_000_000, None), (1, 6_000_000, 0), (2, 5, None)]


def test_arc_headers_of_either_version(tmp_path):
    import gzip

    body = b"HTTP/1.0 200 OK\r\n\r\nhello"
    for version, line in ((1, f"http://h/ 1.2.3.4 19970102030405 text/html {len(body)}"), (2, f"http://h/ 1.2.3.4 19970102030405 text/html 200 abc - 7 f.arc {len(body)}")):
        block = f"{version} 0 x\n{' '.join(warc.ARC_FIELDS[version])}\n".encode()
        path = tmp_path / f"{version}.arc.gz"
        path.write_bytes(gzip.compress(f"filedesc://f 0.0.0.0 19970102030405 text/plain {len(block)}\n".encode() + block) + gzip.compress(line.encode() + b"\n" + body + b"\n"))
        (record,) = warc.read_arc(f"file://{path}")
        out = warc.warc_record(record, None)
        assert record.split[1] == b"hello" and b"WARC-Date: 1997-01-02T03:04:05Z" in out and b"WARC-Type: response" in out and out == warc.warc_record(record, None)
    fields = warc.arc_fields(1, "http://h/a b 1.2.3.4 19970102030405 text/html; charset=x 12\n")
    assert fields == {"URL": "http://h/a b", "IP-address": "1.2.3.4", "Archive-date": "19970102030405", "Content-type": "text/html; charset=x", "Archive-length": "12"}
    assert warc.arc_fields(2, "u 1.2.3.4 1997 text/html; a=b 200 c - 7 f.arc 3")["Content-type"] == "text/html; a=b" and warc.arc_fields(1, "u 1.2.3.4 19970102030405 3")["Content-type"] == "-"
    assert warc.arc_fields(1, "http://h/ text/html 3") is None and warc.iso_date("199702") == "1997-02-01T00:00:00Z"
    (tmp_path / "bad.arc.gz").write_bytes(gzip.compress(b"nothing"))
    with pytest.raises(ValueError):
        list(warc.read_arc(f"file://{tmp_path}/bad.arc.gz"))


def test_no_pages_no_archives(spark, tmp_path):
    a, w = f"file://{tmp_path}/a", f"file://{tmp_path}/w"
    assert warc.write_arc(spark.createDataFrame([], "page_id long, url string, html string"), a) == 0
    assert warc.convert_arc(spark, a, w) == 0 and warc.read_warc(spark, w).count() == 0


def test_bisection_meets_its_targets():
    tokens = {"a": 1000, "b": 100, "c": 10}
    e = mixing.bisect_exponent(tokens, max_epochs=3.0)
    assert abs(mixing.spread(tokens, e) - 3.0) < 1e-6
    h = mixing.bisect_exponent(tokens, target_entropy=0.9)
    assert abs(mixing.entropy(mixing.temper(tokens, h)) - 0.9) < 1e-6
    assert mixing.bisect_exponent({"a": 5, "b": 0}) == 1.0 and mixing.bisect_exponent(tokens, max_epochs=1e9) == 0.0 and mixing.bisect_exponent(tokens, target_entropy=99) == 0.0


def mixed_counts(df, **kw):
    return Counter((r.doc_id, r.epoch) for r in mixing.mix(df, **kw).select("doc_id", "epoch").collect())


def test_mixture_realises_its_weights(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 9}", "w " * (i % 40 + 1), "x") for i in range(1500)] + [(5000, None, "a b c", "x"), (5001, None, None, "x"), (5002, "hot", "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, epoch string").withColumns({"_h": F.lit("mine"), "slot": F.lit(1)}).repartition(5)
    got = mixing.mix(df, max_epochs=2.5, slot_rows=16).collect()
    words = {d: len((t or "").split()) for d, _, t, _ in rows}
    own, mine = Counter(), Counter()
    for d, s, _, _ in rows:
        own[s] += words[d]
    for r in got:
        mine[r.source] += words[r.doc_id]
    weights = {r.source: r.mix_weight for r in got}
    budget = max(own[s] / weights[s] for s in own)
    for s in own:
        assert abs(mine[s] - weights[s] * budget) <= 41
    assert abs(sum(weights.values()) - 1) < 1e-9 and {r.doc_id for r in got} == {r[0] for r in rows}
    assert max(Counter((r.doc_id, r.epoch) for r in got).values()) == 1
    assert mixed_counts(df, max_epochs=2.5, slot_rows=16) == mixed_counts(df.repartition(2), max_epochs=2.5, slot_rows=700)
    assert {r._h for r in got} == {"mine"} and "epoch" in mixing.mix(df).columns and mixing.mix(df.limit(0)).count() == 0


def test_mixture_with_a_budget_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a", "w w"), (1, "a", "w w"), (2, "b", "w w w w")], "doc_id long, source string, text string")
    assert sum(mixed_counts(df, max_epochs=1.0, budget=4).values()) == 2
    with pytest.raises(ValueError):
        mixing.source_sizes(df.withColumn("tokens", F.lit(1)), max_sources=1)


def test_n_words(spark):
    df = spark.createDataFrame([(" a  b\tc\n",), ("",), (None,), ("é\xa0x y",)], "t string")
    assert [r[0] for r in df.select(mixing.n_words(F.col("t"))).collect()] == [3, 0, 0, 2]


def test_a_thousand_languages_and_no_more(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "concat('l', id % 1000) AS lang", "concat('word', id % 1000, ' and ', id) AS text")
    model = language.train_language_model(rows, buckets=256)
    assert len(model.langs) == 1000 and language.identify(rows, model).where("lang_pred = 'und'").count() == 0
    with pytest.raises(ValueError, match="more than 999 languages"):
        language.train_language_model(rows, buckets=256, max_langs=999)
