"""The registered queries on the smallest tables, whole, against brute force."""

import hashlib
import math
import re
import unicodedata
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cellplane.llm import language_id, mixing, ngram_join, packing, quality_knn, queries, url_filters
from cellplane.llm.features import trigrams
from tests.llm.test_texts import WORD, brute_spans, linked, shingle_sets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.fixture(scope="module")
def texts(duck):
    """(doc_id, text) by id."""
    return [(i, t or "") for i, t in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()]


def run(spark, name):
    return queries.queries()[name](spark, SF).collect()


def n_words(t):
    return len(WORD.findall(t))


def test_sql(spark, duck):
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, SF)
        columns = sorted(df.columns)
        rel = duck.execute(sql)
        names = [d[0] for d in rel.description]
        assert sorted(names) == columns
        assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(tuple(dict(zip(names, r, strict=True))[c] for c in columns) for r in rel.fetchall())


def test_op2(spark, texts):
    canon = lambda t: re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t).casefold()).strip()
    down, want = texts[::-1], {}
    for (i, t), (_, n) in zip(down, down[1:] + down[:1], strict=True):
        third = len(t) // 3
        edited = t[: len(t) - third] + n[:third]
        want[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), float(canon(edited) == canon(t)), float(canon(n) == canon(t)))
    out = run(spark, "op2_fingerprints")
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in out} == want and len(out) == len(texts)
    by = {r.doc_id: r.fingerprint for r in out}
    assert len(set(by.values())) == len({canon(t) for _, t in texts}) == len({(by[i], canon(t)) for i, t in texts})
    assert all((r.edited_fingerprint == r.fingerprint) == (r.near_edited == 1.0) for r in out)


def test_op3(spark, texts):
    out = run(spark, "op3_ngram_join")
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == linked(texts)
    sets = shingle_sets(texts)
    distinct = {frozenset(s) for s in sets if s}
    links = {i: sum(o != s and 100 * len(s & o) >= 80 * len(s | o) for o in distinct) if s else 0 for (i, _), s in zip(texts, sets, strict=True)}
    assert {r.doc_id: r.n_links for r in out} == links


def least_padding(lengths, k):
    """Padding of the best k buckets over all lengths, by the plain programme."""
    c = Counter(lengths)
    v = sorted(c)
    best = [sum((v[j] - x) * c[x] for x in v[: j + 1]) for j in range(len(v))]
    for _ in range(k - 1):
        best = [min([best[j], *(best[i] + sum((v[j] - x) * c[x] for x in v[i + 1 : j + 1]) for i in range(j))]) for j in range(len(v))]
    return best[-1]


def test_op4(spark, texts):
    out = run(spark, "op4_packing")
    assert {r.doc_id: r.n_tokens for r in out} == {i: n_words(t) for i, t in texts} and len(out) == len(texts)
    assert max(r.n_tokens for r in out) > 1024 and all(r.n_tokens <= r.bucket_len for r in out)
    assert sum(r.bucket_len - r.n_tokens for r in out) == least_padding([n_words(t) for _, t in texts], 16)
    batches = defaultdict(list)
    for r in out:
        batches[r.bucket_len, r.batch].append(r.slot)
    for (size, batch), slots in batches.items():
        fit = max(1, 65536 // max(size, 1))
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= fit and (len(slots) == fit or (size, batch + 1) not in batches)


def test_boundaries_of_long_texts():
    rng = np.random.default_rng(7)
    for k in (1, 2, 5, 9):
        lengths = rng.choice(np.arange(1, 40_000, 13), 60)
        v, c = np.unique(lengths, return_counts=True)
        ends = packing.boundaries(v, c, k)
        assert len(ends) <= k and sum(min(e for e in ends if e >= x) - x for x in lengths) == least_padding(lengths.tolist(), k)


def test_op5(spark, duck, texts):
    """The posterior from its parts, in plain numpy: trigram counts and evidence are taken as they are."""
    rows = duck.execute("SELECT doc_id, coalesce(text, ''), lang, source FROM documents ORDER BY doc_id").fetchall()
    tag = lambda s: (re.match(r"\s*([A-Za-z]{2,8})", s or "") or [None, "none"])[1].lower()
    grams = trigrams([r[1].encode() for r in rows], language_id.BITS, fold=True)
    langs = sorted({tag(r[2]) for r in rows} - {"none"})
    table = np.array([grams[[tag(r[2]) == x for r in rows]].sum(axis=0) for x in langs], dtype=float)
    whole = table.sum(axis=0) + 0.5
    smooth = table + 200 * whole / whole.sum()
    logs = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    n = grams.sum(axis=1)
    lls = grams @ logs.T * (np.minimum(n, language_id.MOST) / np.maximum(n, 1))[:, None]
    evidence = {r["id"]: r for r in language_id.page_evidence(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    marks, hosts = [], []
    for i, _, lang, source in rows:
        e = evidence.get(i)
        marks.append(tag(e["page_lang"]) if e and tag(e["page_lang"]) != "none" else tag(lang))
        hosts.append((e["page_host"] if e else source) or "none")
    ends = [h.rsplit(".", 1)[1] if re.search(r"\.[^.]+$", h) else "none" for h in hosts]
    guess = np.where(n > 0, lls.argmax(axis=1), -1)
    base = 1.0 + np.array([(guess == j).sum() for j in range(len(langs))])

    def by(keys):
        out = defaultdict(lambda: np.zeros(len(langs)))
        for k, g in zip(keys, guess, strict=True):
            out[k] += np.eye(len(langs))[g] if g >= 0 else 0
        return out

    mark, end, host = by(marks), by(ends), by(hosts)
    near = lambda c, p: (c + language_id.KAPPA * p) / (c.sum() + language_id.KAPPA)
    got = {r.doc_id: r for r in run(spark, "op5_language_id")}
    assert len(got) == len(rows)
    suffix_of = {}
    for h, e in zip(hosts, ends, strict=True):
        suffix_of[h] = min(e, suffix_of.get(h, e))
    for j, (i, *_rest) in enumerate(rows):
        prior = near(host[hosts[j]], near(end[suffix_of[hosts[j]]], base / base.sum()))
        post = lls[j] + np.log((mark[marks[j]] + 1) / (base + len(mark))) + np.log((end[ends[j]] + 1) / (base + len(end))) + np.log(prior)
        sure = 1 / np.exp(post - post.max()).sum()
        assert got[i].lang_id == (langs[int(post.argmax())] if n[j] else None) and abs(got[i].confidence - sure) < 1e-3, i
        assert got[i].kept == bool(n[j] and sure >= language_id.SURE) or abs(sure - language_id.SURE) < 1e-3


def test_op6(spark, texts):
    out = {r.doc_id: r for r in run(spark, "op6_quality_rules")}
    assert len(out) == len(texts)
    for i, t in texts:
        w, r = WORD.findall(t), out[i]
        lines = [x for x in t.split("\n") if WORD.search(x)]

        def covered(k, w=w):
            grams = Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1))
            return len({j + x for j in range(len(w) - k + 1) if grams[tuple(w[j : j + k])] > 1 for x in range(k)})

        failed = len(w) < 50 or 100 * covered(3) > 50 * len(w)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), covered(3), failed)
        assert r.kept == (not failed and covered(5) <= 0.3 * len(w) and not covered(61))


def test_op7(spark, texts):
    gone = brute_spans(texts, 100)
    want = []
    for i, t in texts:
        b, g = t.encode(), gone[i, t]
        want.append((i, len(b), len(g), sum(p - 1 not in g for p in g), hashlib.sha256(bytes(x for p, x in enumerate(b) if p not in g)).hexdigest()))
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in run(spark, "op7_suffix_dedup")) == want


def test_op8(spark, duck):
    """Stated rules by plain string work; mined ones by counting every combination of a page's tokens among the labelled pages."""
    pages = duck.execute("SELECT page_id, url FROM pages").fetchall()
    split = {}
    for i, u in pages:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        split[i] = ("".join(c.lower() if "A" <= c <= "Z" else c for c in host), path)
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    labelled = url_filters.labelled_pages(spark.read.parquet(f"{SF}/pages.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).select(url_filters.tokens(F.col("url")).alias("t"), "bad").collect()
    tokens = {r.page_id: r.t for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", url_filters.tokens(F.col("url")).alias("t")).collect()}
    least = math.ceil(0.005 * len(labelled))
    seen, mined = {}, {}
    for i, t in tokens.items():
        if (key := tuple(sorted(t))) not in seen:
            bit = {x: 1 << n for n, x in enumerate(key)}
            total, bad = (np.zeros(1 << len(key), dtype=np.int64) for _ in range(2))
            for r in labelled:
                at = sum(bit.get(x, 0) for x in set(r.t))
                total[at] += 1
                bad[at] += r.bad
            for n in range(len(key)):  # sums over supersets
                for a in (total, bad):
                    view = a.reshape(-1, 2, 1 << n)
                    view[:, 0] += view[:, 1]
            # A rule has an antecedent of one token at least, and as support the share of pages with it and the class.
            ok = (bad[1:] >= max(least, 1)) & (bad[1:] >= 0.4 * total[1:])
            seen[key] = bool(ok.any())
        mined[i] = seen[key]
    got = {r.page_id: r for r in run(spark, "op8_url_filters")}
    assert len(got) == len(pages)
    for i, u in pages:
        host, path = split[i]
        fits = [r for r in rules if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len) if fits else None
        verdict = rules[rule] if rule else "block" if u and "://" in u and mined[i] else "allow"
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u


def test_op9(spark, duck, texts):
    source = dict(duck.execute("SELECT doc_id, source FROM documents").fetchall())
    size = {i: n_words(t) for i, t in texts}
    sums = defaultdict(int)
    for i in size:
        sums[source[i]] += size[i]
    order = sorted(sums, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    open_, rest, goal = set(order), 1.5 * sum(sums.values()), {}
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sums[s]}
        goal |= {s: 2.0 * sums[s] for s in full} if full else {s: level * weight[s] for s in open_}
        rest -= sum(goal[s] for s in full)
        open_ = open_ - full if full else set()
    outcomes = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for p in ("1", "4", "7", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", p)
        outcomes.append(sorted(map(tuple, run(spark, "op9_mixing"))))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(o == outcomes[0] for o in outcomes)
    taken = defaultdict(int)
    for i, z, total, target, t in outcomes[0]:
        assert z == size[i] and total == sums[source[i]] and math.isclose(target, goal[source[i]], rel_tol=1e-9) and t in (0, z, 2 * z)
        taken[source[i]] += t
    # Off by no more than half of the smallest document that could still be flipped, or of what three flips leave.
    assert all(abs(taken[s] - goal[s]) <= max(0.02 * goal[s], max(size[i] for i in size if source[i] == s) / 2) for s in order)


def test_dual(spark):
    """Every multiplier meets its target before rounding, and equals the one that bisection finds."""
    rng = np.random.default_rng(3)
    rows = [(f"s{j}" if j else None, int(z), int(n)) for j in range(12) for z, n in zip(rng.choice(3000, 20, replace=False) + 1, rng.integers(1, 9, 20), strict=True)]
    rows += [("one", 5, 1), ("steep", 1, 1_000_000), ("steep", 20_000, 3)]
    hist = spark.createDataFrame(rows, "source string, size long, n long")
    own = defaultdict(list)
    for s, z, n in rows:
        own[s].append((z, n))
    share = {s: [0.02, 0.3, 0.9, 1.0, 1.4, 1.97, 1.9999][i % 7] for i, s in enumerate(own)}
    total = {s: sum(z * n for z, n in v) for s, v in own.items()}
    goal = spark.createDataFrame([(s, total[s], share[s] * total[s]) for s in own], "source string, source_size long, target double")
    found = {r["source"]: (r["scale"], r["lam"]) for r in mixing.multipliers(hist, goal).collect()}
    assert set(found) == set(own)
    for s, v in own.items():
        scale, lam = found[s]

        def got(x, v=v, scale=scale):
            return sum(z * n * 2 / (1 + math.exp(-max(-500, min(500, x * z / scale)))) for z, n in v)

        assert abs(got(lam) / (share[s] * total[s]) - 1) < 1e-9
        lo, hi = -1e5, 1e5
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if got(mid) < share[s] * total[s] else (lo, mid)
        assert abs(got(lo) / got(lam) - 1) < 1e-9


def test_few_flips(spark):
    """Rounding alone comes near: at most FLIPS documents of a source differ from it."""
    rows = [("a", int(z), 1) for z in range(1, 400)] + [("b", 7, 5), ("b", 900, 1)]
    hist = spark.createDataFrame(rows, "source string, size long, n long")
    goal = spark.createDataFrame([("a", sum(z for _, z, _ in rows[:399]), 50_000.0), ("b", 935, 700.0)], "source string, source_size long, target double")
    found = mixing.multipliers(hist, goal)
    plain = mixing.rounded.__globals__["FLIPS"]
    try:
        mixing.FLIPS = 0
        zero = {(r["source"], r["size"]): r["extra"] for r in mixing.rounded(hist, found, goal).collect()}
    finally:
        mixing.FLIPS = plain
    some = mixing.rounded(hist, found, goal).collect()
    for s in ("a", "b"):
        assert sum(abs(r["extra"] - zero[s, r["size"]]) for r in some if r["source"] == s) <= plain
    got = sum((r["n"] * r["whole"] + r["extra"]) * r["size"] for r in some if r["source"] == "a")
    assert abs(got - 50_000) <= 2


def test_op10(spark, duck, texts):
    """The vote in plain numpy over the operator's own vectors; the held-out rows by crc32."""
    import zlib

    labels = dict(duck.execute("SELECT doc_id, max(quality) FROM labels WHERE quality IS NOT NULL GROUP BY doc_id").fetchall())
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in texts}
    out = {r.doc_id: r for r in run(spark, "op10_quality_knn")}
    assert {i: r.held_out for i, r in out.items()} == held and all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in out.values())
    counts = quality_knn.counted([t.encode() for _, t in texts])
    idf = np.log((1 + len(texts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    x = quality_knn.weighted(counts, idf)
    known = [j for j, (i, _) in enumerate(texts) if i in labels and not held[i]]
    y = np.array([labels[texts[j][0]] for j in known])
    _, vecs = np.linalg.eigh(x[known].T.astype(np.float64) @ x[known])
    z = x @ vecs[:, ::-1][:, : quality_knn.DIMENSIONS].astype(np.float32)
    size = np.linalg.norm(z, axis=1)
    z = z / np.maximum(size, 1e-9)[:, None]
    share = y.mean()
    off = 0
    for j, (i, _) in enumerate(texts):
        sims = [(-round(float(s), 6), k) for k, s in enumerate(z[known] @ z[j])]
        top = [k for _, k in sorted(sims)[: quality_knn.NEAR]]
        best = max(-sims[k][0] for k in top)
        w = [math.exp(12 * (-sims[k][0] - best)) * (0.5 / share if y[k] else 0.5 / (1 - share)) for k in top]
        want = sum(a * y[k] for a, k in zip(w, top, strict=True)) / sum(w) if size[j] > 1e-6 else share
        off += abs(out[i].score - want) > 1e-3
    assert off <= len(texts) // 50  # neighbours whose similarities differ in the last digit only may change places
    rated = [(out[i].score >= 0.3, labels[i]) for i, _ in texts if i in labels and held[i]]
    assert sum(a == b for a, b in rated) >= 0.9 * len(rated)


def test_nearest_breaks_ties_by_place():
    sims = np.array([[0.5, 0.9, 0.5, 0.5, 0.1], [0.2, 0.2, 0.2, 0.2, 0.2]])
    assert [sorted(r) for r in quality_knn.nearest(sims, 2).tolist()] == [[0, 1], [0, 1]]


def test_key_names(spark):
    """A key that is named like a result column comes back under another name."""
    for name, call in (
        ("slot", lambda df: packing.length_buckets(df, "slot", F.length("t"))), ("n_links", lambda df: ngram_join.jaccard_components(df, "n_links", "t")), ("taken", lambda df: mixing.balance(df, "taken", F.length("t"), "t")),
    ):
        df = spark.createDataFrame([(1, "a b c"), (2, None)], f"{name} long, t string")
        out = call(df)
        assert len(set(out.columns)) == len(out.columns) and sorted(r[f"key_{name}"] for r in out.collect()) == [1, 2]


def test_many_short_texts(spark):
    """Texts without a byte go through in bounded blocks."""
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"), F.lit("en").alias("lang")).coalesce(1)
    assert language_id.identify(df, "doc_id", "text", "lang").filter("kept").count() == 0
    assert ngram_join.jaccard_components(df.limit(3000), "doc_id", "text").filter("component_id = doc_id").count() == 3000
