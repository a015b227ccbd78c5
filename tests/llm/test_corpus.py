"""Operators on whole tables: packing, language, URL filters, mixing, classification; the pipeline."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellplane.llm import language_id, mixing, packing, quality_knn, url_filters
from cellplane.llm.common import n_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_boundaries():
    rng = random.Random(2)
    for _ in range(20):
        lengths = np.array(sorted(rng.sample(range(1, 60), 9)), dtype=float)
        counts = np.array([rng.randint(1, 9) for _ in lengths])

        def padding(ends, lengths=lengths, counts=counts):
            return sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts, strict=True))

        from itertools import combinations

        best = min(padding((*e, lengths[-1])) for e in combinations(lengths[:-1], 2))
        assert padding(packing.boundaries(lengths, counts, 3)) == best


def test_packing(spark, docs, rows, empty):
    out = packing.length_buckets(docs, "doc_id", n_words("text"), buckets=4, budget=1000).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in out) == sorted((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    batches = defaultdict(list)
    for r in out:
        assert r.n_tokens <= r.bucket_len
        batches[r.bucket_len, r.batch].append(r.slot)
    for (size, batch), slots in batches.items():
        fit = max(1, 1000 // max(size, 1))
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= fit
        assert len(slots) == fit or (size, batch + 1) not in batches
    assert packing.length_buckets(empty, "doc_id", n_words("text")).count() == 0


def test_mixing(docs, rows, empty):
    out = mixing.balance(docs, "doc_id", n_words("text"), "source").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal, left, rest = {}, dict(sizes), 1.5 * sum(sizes.values())
    while True:
        level = rest / sum(weight[s] for s in left)
        full = [s for s in left if level * weight[s] > 2 * sizes[s]]
        if not full:
            goal |= {s: level * weight[s] for s in left}
            break
        for s in full:
            goal[s] = 2.0 * sizes[s]
            rest -= goal[s]
            del left[s]
    source = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, goal[s], rel_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
    largest = {s: max(len(WORD.findall(r[1] or "")) for r in rows if r[3] == s) for s in order}
    assert all(abs(taken[s] - goal[s]) <= max(0.01 * goal[s], largest[s] / 2) for s in order)
    again = mixing.balance(docs.repartition(3), "doc_id", n_words("text"), "source").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))
    assert mixing.balance(empty, "doc_id", n_words("text"), "source").count() == 0


def test_language(spark, docs, rows, empty):
    out = language_id.identify(docs, "doc_id", "text", "lang", host="source").collect()
    by = {r.row: r for r in out}
    assert len(out) == len(rows)
    for r in rows:
        got = by[r[0]]
        if not re.search(r"[A-Za-z\u0080-\uffff]", r[1] or ""):
            assert not got.kept and got.lang_id is None
        elif r[2] and len(r[1]) > 300:
            assert got.lang_id == r[2] and got.kept
    assert language_id.identify(empty, "doc_id", "text", "lang", host="source").count() == 0
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.identify(none, "doc_id", "text", "lang").filter("kept").count() == 0


def test_more_than_64_languages(spark):
    """Rare declared languages are known too."""
    rng = random.Random(8)
    rows = []
    for i in range(80):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)]
        tag = "x" + chr(97 + i // 26) + chr(97 + i % 26)
        rows += [(1000 * i + j, " ".join(rng.choice(words) for _ in range(60)), tag) for j in range(2 if i % 4 else 5)]
    df = spark.createDataFrame(rows, "id long, text string, lang string").repartition(4)
    got = {r.row: (r.lang_id, r.kept) for r in language_id.identify(df, "id", "text", "lang").collect()}
    assert got == {i: (tag, True) for i, _, tag in rows}


def test_page_evidence(spark):
    pages = spark.createDataFrame([(2, "http://a.example.com/fr/825?page=2", "<html><p lang=xx>"), (1, "https://b.org/en/825.html#t", '<html class="x" lang="FR-ca">'), (3, None, None), (4, "x", "y")], "page_id long, url string, html string")
    assert [tuple(r) for r in language_id.page_evidence(pages).collect()] == [(825, "FR-ca", "b.org")]


def test_prior_wins_only_without_text(spark):
    """Hosts settle texts that say nothing; texts that say much settle themselves."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["the", "and", "of", "with"]) if i % 2 else rng.choice(["und", "der", "von", "mit"]) for _ in range(60)), "en" if i % 2 else "de", "h1.at" if i % 2 == 0 else "h2.uk") for i in range(80)]
    rows += [(500, "q", None, "h1.at"), (501, "q", None, "h2.uk"), (502, rows[1][1], None, "h1.at")]
    df = spark.createDataFrame(rows, "id long, text string, lang string, host string")
    got = {r.row: r.lang_id for r in language_id.identify(df, "id", "text", "lang", host="host").collect()}
    assert (got[500], got[501], got[502]) == ("de", "en", "en")


URLS = [
    ("http://WWW.Example.NET/en/1?q=2", "www.example.net", "/en/1", "example.net/en/", "allow"), ("http://example.net/de/1", "example.net", "/de/1", "net/", "block"), ("http://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
    ("https://m.example.com/de/7#x", "m.example.com", "/de/7", "example.com/de/", "block"), ("https://example.com/de", "example.com", "/de", None, "allow"), ("ftp://x.org/fr/y", "x.org", "/fr/y", "org/fr/", "allow"),
    ("http://a.net", "a.net", "", None, "allow"), ("http://ÄB.net:80/x", "Äb.net:80", "/x", None, "allow"), ("no scheme.net/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("a://b://c.net/x", "b:", "//c.net/x", None, "allow"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] + [(0, URLS[0][0])], "page_id long, url string")
    none = spark.createDataFrame([], "url string, bad boolean")
    out = url_filters.judge(pages, "page_id", "url", none).collect()
    assert len(out) == len(URLS) + 1
    assert {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in out} == {(i, *u[1:]) for i, u in enumerate(URLS)}


@pytest.mark.parametrize("times", [1, url_filters.LOT, url_filters.LOT + 1, 5 * url_filters.LOT - 3])
def test_a_url_repeated_often(spark, times):
    """One row repeated beside one that is not: every repeat comes back."""
    pages = spark.range(times).select(F.lit(7).cast("long").alias("page_id"), F.lit("http://a.net/x").alias("url")).unionByName(spark.createDataFrame([(8, "http://b.fr/")], "page_id long, url string"))
    none = spark.createDataFrame([], "url string, bad boolean")
    out = url_filters.judge(pages, "page_id", "url", none).groupBy("page_id", "host", "path", "rule", "verdict").count().collect()
    assert {tuple(r) for r in out} == {(7, "a.net", "/x", "net/", "block", times), (8, "b.fr", "/", None, "allow", 1)}


def test_url_mining(spark):
    rows = [(f"http://{'spam' if i % 2 else 'ham'}.example.com/{'ads' if i % 4 == 1 else 'news'}/{i}", i % 4 == 1) for i in range(200)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    pages = spark.createDataFrame([(1, "http://spam.example.com/ads/999"), (2, "http://spam.example.com/news/999"), (3, "http://other.example.com/ads/1")], "page_id long, url string")
    out = {r.page_id: r for r in url_filters.judge(pages, "page_id", "url", labelled, confidence=0.9).collect()}
    assert out[1].verdict == "block" and out[2].verdict == "allow" and out[3].verdict == "block"
    # Brute force: a page is blocked if and only if some mined rule's tokens all occur in its url.
    seen = labelled.select(url_filters.tokens(F.col("url")).alias("items"), "bad").withColumn("items", F.when(F.col("bad"), F.concat("items", F.array(F.lit(url_filters.BAD)))).otherwise(F.col("items")))
    rules = [set(r["items"]) for r in url_filters.mine(seen.select("items"), confidence=0.9).collect()]
    for r in pages.select("page_id", url_filters.tokens(F.col("url")).alias("t")).collect():
        assert (out[r.page_id].verdict == "block") == any(x <= set(r.t) for x in rules)


def test_classifier(spark, empty):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choice(["the", "house", "was", "old", "and", "near", "river"]) for _ in range(80))
    bad = lambda: " ".join(rng.choice(["BUY!!", "###", "$$$", "NOW!!", "%%%"]) for _ in range(80))
    rows = [(i, good() if i % 3 else bad()) for i in range(300)] + [(300, None), (301, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0) for i in range(0, 300, 2)] + [(None, 1), (3, None), (9999, 0)], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality_knn.nearest_votes(df, "doc_id", "text", labels, "quality").collect()}
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    assert all((r.score >= 0.3) == bool(i % 3) for i, r in out.items() if i < 300)
    assert 0 < out[300].score < 1 and out[300].score == out[301].score
    # Labels of held-out rows are never read: turned round, they change nothing.
    turned = labels.withColumn("quality", F.when(quality_knn.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality_knn.nearest_votes(df, "doc_id", "text", turned, "quality").collect()} == pytest.approx({i: r.score for i, r in out.items()})
    assert quality_knn.nearest_votes(empty, "doc_id", "text", labels, "quality").count() == 0
    assert {r.score for r in quality_knn.nearest_votes(df, "doc_id", "text", labels.limit(0), "quality").collect()} == {0.5}


def test_pipeline(spark, docs, rows, tmp_path):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
    import corpus_pipeline
    from tests.llm.test_texts import brute_spans, linked

    docs.select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    now, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        kept[name] = now.collect()
    first = [(r.doc_id, r.text) for r in kept["language"]]
    assert {i for i, _ in first} == {r[0] for r in rows if re.search(r"[A-Za-z\u0080-\uffff]", r[1] or "")}
    least = {i: c for i, _, c in linked([(i, t) for i, t in first])}
    second = [(r.doc_id, r.text) for r in kept["near_copies"]]
    assert sorted(i for i, _ in second) == sorted({i for i, _ in first if least[i] == i})
    spans = brute_spans(second, 100)
    third = {r.doc_id: r.text for r in kept["repeated_passages"]}
    want = {}
    for i, t in second:
        at, left = 0, []
        for c in t:  # a character goes if all its bytes do
            n = len(c.encode())
            left += [] if set(range(at, at + n)) <= spans[i, t] else [c]
            at += n
        if WORD.search("".join(left)):
            want[i] = "".join(left)
    assert third == want
    fourth = [r.doc_id for r in kept["mixture"]]
    assert set(fourth) <= set(third) and max(map(fourth.count, set(fourth))) <= 2
    assert sorted(r.doc_id for r in kept["packed"]) == sorted(fourth)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(fourth)


def pipeline():
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
    import corpus_pipeline

    return corpus_pipeline


def test_stages_on_an_empty_table(spark, tmp_path):
    stages = pipeline()
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    for name, stage in stages.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "packed" or out.columns == stages.COLUMNS)


def test_rows_of_one_id(spark, tmp_path):
    """Only links take documents away: rows of one id with different texts stay, repeated and linked ones leave one."""
    stages = pipeline()
    text = lambda seed: " ".join(f"w{seed}x{i}" for i in range(60))
    rows = [(5, text(1)), (5, text(2)), (5, text(2)), (3, text(2) + " end"), (9, text(3)), (9, text(3)), (7, None), (7, ""), (None, text(1)), (8, "one two"), (2**62 + 1, text(4)), (-5, text(4))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, extra string")
    got = [(r.doc_id, r.text) for r in stages.near_copies(spark, docs, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(5, text(1)), (3, text(2) + " end"), (9, text(3)), (7, None), (7, ""), (None, text(1)), (8, "one two"), (-5, text(4))], key=str)


def test_mixture_and_packing_of_odd_rows(spark, tmp_path):
    stages = pipeline()
    rows = [(1, None, None), (2, "", "a"), (3, "a b c", "a"), (3, "a b c", "a"), (4, "d " * 70_000, None), (5, "e f", "b")]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = stages.mixture(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= {3, 4, 5} and all(r.text for r in out) and Counter(r.doc_id for r in out)[3] in (0, 2, 4)
    placed = stages.packed(spark, docs, str(tmp_path)).collect()
    assert sorted(r.n_tokens for r in placed) == [0, 0, 2, 3, 3, 70_000] and len({(r.bucket_len, r.batch, r.slot) for r in placed}) == 6
