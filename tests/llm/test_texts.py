"""Operators on whole texts against plain ones: fingerprints, n-gram join, quality rules, repeated passages, sharding."""

import hashlib
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cellplane.llm import bytesops, fingerprints, ngram_join, quality_rules, sharding, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_fingerprints(spark, docs, empty):
    got = fingerprints.fingerprint(docs, "text").select("text", "fingerprint", "slot").collect()
    for r in got:
        canon = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", r.text or "").casefold()).strip()
        assert r.fingerprint[:16] == xxhash.xxh64(canon.encode(), seed=42).hexdigest()
    by = {r.text: r.fingerprint for r in got}
    assert by["ﬁne Straße  É"] == by["fine strasse é"] and by["one two"] == by["One\ttwo "] and by[None] == by[""]
    few = fingerprints.fingerprint(docs, "text", bits=2).select("text", "fingerprint").collect()  # collisions everywhere
    assert len({r.fingerprint for r in few}) == len({r.fingerprint for r in got})
    assert fingerprints.fingerprint(empty, "text").count() == 0


def test_next_document(spark):
    ids = [5, 9, 9, 1, 40, None, 12, 2**62 + 7, -(2**62) - 5]
    df = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(ids)], "k long, t string").withColumn("tie", F.xxhash64("t"))
    out = fingerprints.with_next(df, "k", ["t"], "tie").collect()
    order = sorted(out, key=lambda r: (r.k is None, -(r.k or 0), -r.tie))
    assert [r.next_t for r in order] == [r.t for r in order[1:] + order[:1]]


def shingle_sets(rows):
    out = []
    for r in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(r[1] or "")]
        out.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def linked(rows):
    """(id, size, least id) of every row by comparing all pairs."""
    s, ids = shingle_sets(rows), [r[0] for r in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]):
                up[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return sorted((ids[i], len(s[i]), least[find(i)]) for i in range(len(rows)))


def test_ngram_join(docs, rows, empty):
    out = ngram_join.jaccard_components(docs, "doc_id", "text")
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()) == linked(rows)
    assert ngram_join.jaccard_components(empty, "doc_id", "text").count() == 0


@pytest.mark.parametrize("small,block", [(2, 3), (64, 1000)])
def test_ngram_join_of_large_groups(spark, monkeypatch, small, block):
    """Many near copies at growing distance, whose ends are not alike, among texts that share their shingles."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", block)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(24):
        w = list(base)
        for j in range(i):
            w[j * 3 % 80] = f"v{j}" if i % 2 else f"u{j}"
        rows.append((i + 100, " ".join(w)))
    rows += [(i, " ".join(base[: 30 + i])) for i in range(12)] + [(None, " ".join(base)), (99, None)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(6)
    got = [(r.id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, "id", "text").collect()]
    assert sorted(g for g in got if g[0] is not None) == linked([r for r in rows if r[0] is not None])
    assert (None, 76, None) in got


@pytest.mark.parametrize("block,columns", [(1000, 2048), (3, 7)])
def test_links_of_large_groups(spark, docs, rows, monkeypatch, block, columns):
    """Every link counts, also between members of one component of a group above SMALL."""
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", block)
    monkeypatch.setattr(ngram_join, "COLUMNS", columns)

    def brute(rows):
        s = shingle_sets(rows)
        sets = {frozenset(x) for x in s if x}
        return sorted((r[0], sum(y != x and 100 * len(x & y) >= 80 * len(x | y) for y in sets) if x else 0) for r, x in zip(rows, s, strict=True))

    assert ngram_join.SMALL == 8
    base = [f"w{i}" for i in range(200)]
    alike = [(i, " ".join([*base[: 9 * i], f"v{i}", *base[9 * i + 1 :]])) for i in range(20)]
    chain = [(100 + i, " ".join([*(f"u{j}" for j in range(4 * i)), *(f"x{j}" for j in range(4 * i, 120))])) for i in range(20)]
    made = [*alike, *chain, (200, alike[3][1]), (201, None), (202, "one")]
    got = ngram_join.jaccard_components(spark.createDataFrame(made, "id long, text string").repartition(5), "id", "text").collect()
    assert sorted((r.id, r.n_links) for r in got) == brute(made)
    assert {r.n_links for r in got if r.id < 20} == {19}
    assert sorted((r.doc_id, r.n_links) for r in ngram_join.jaccard_components(docs, "doc_id", "text").collect()) == brute(rows)


def test_quality_rules(docs, rows, empty):
    out = quality_rules.repetition_rules(docs, "doc_id", "text")
    got = sorted(tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat", "base_failed")) for r in out.collect())
    want = []
    for r in rows:
        t = r[1] or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]

        def covered(k, w=w):
            grams = Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1))
            return len({j + x for j in range(len(w) - k + 1) if grams[tuple(w[j : j + k])] > 1 for x in range(k)})

        lo, hi = 0, len(w)
        while lo < hi:  # a longest repeat of k has repeats of all shorter lengths
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if covered(mid) else (lo, mid - 1)
        rep = covered(3)
        want.append((r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep, covered(5), lo, len(w) < 50 or 100 * rep > 50 * len(w)))
    assert got == sorted(want)
    kept = {r.doc_id for r in out.filter("kept").collect()}
    assert all((r[0] in kept) == (not r[8] and r[6] <= 0.3 * r[1] and r[7] <= 60) for r in got)
    assert quality_rules.repetition_rules(empty, "doc_id", "text").count() == 0


def brute_spans(rows, threshold):
    """Removed byte positions of each distinct (id, text), in the order of ids and text hashes."""
    seen, out = set(), {}
    for key in sorted({(r[0], r[1] or "") for r in rows}):
        b = key[1].encode()
        gone = set()
        for s in range(len(b) - threshold + 1):
            w = b[s : s + threshold]
            if w in seen:
                gone.update(range(s, s + threshold))
            seen.add(w)
        out[key] = gone
    return out


@pytest.mark.parametrize("often", [256, 1])
def test_repeated_passages(docs, rows, empty, monkeypatch, often):
    monkeypatch.setattr(suffix_dedup, "OFTEN", often)
    monkeypatch.setattr(suffix_dedup, "FLUSH", 300)
    want = brute_spans(rows, 100)
    out = suffix_dedup.without_repeats(docs, "doc_id", "text").select("doc_id", "removed_spans", "kept", "slot").collect()
    got = sorted((r.doc_id, hashlib.sha256(r.kept).hexdigest(), sum(s.end - s.start for s in r.removed_spans)) for r in out)
    plain = sorted((r[0], hashlib.sha256(bytes(x for i, x in enumerate((r[1] or "").encode()) if i not in want[r[0], r[1] or ""])).hexdigest(), len(want[r[0], r[1] or ""])) for r in rows)
    assert got == plain
    assert all(a.end < b.start for r in out for a, b in zip(r.removed_spans, r.removed_spans[1:], strict=False))
    assert suffix_dedup.without_repeats(empty, "doc_id", "text").count() == 0


def test_passages_of_one_key(spark):
    """Texts of one key, null or not, stay apart although few bits of their hash are taken: clashes change the seed."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    passage = " ".join(word() for _ in range(20))
    texts = [f"{word()} {passage} {word()}", f"{passage} {word()} {word()}", *(" ".join(word() for _ in range(30)) for _ in range(4))]
    for key in (None, 5):
        df = spark.createDataFrame([(key, t, t) for t in texts] + [(key, texts[2], texts[2])], "id long, text string, whole string").repartition(3)
        out = suffix_dedup.without_repeats(df, "id", "text", bits=5).collect()
        assert len(out) == 7
        assert all(not r.removed_spans and r.kept.decode() == r.whole for r in out if passage not in r.whole)
        assert sorted(len(r.whole) - len(r.kept) >= len(passage) for r in out if passage in r.whole) == [False, True]
    with pytest.raises(ValueError):
        suffix_dedup.without_repeats(df, "id", "text", bits=1)


def test_whole_characters(spark):
    text = "é" * 80 + " "
    df = spark.createDataFrame([(1, "x" + text + "a"), (2, "yy" + text + "b")], "id long, text string")
    out = {r.id: r.kept.decode() for r in suffix_dedup.without_repeats(df, "id", "text", characters=True).collect()}
    assert out[1].startswith("x") and out[2].startswith("yy") and len(out[2]) < 20


def test_block_edges(monkeypatch):
    """A text longer than a block is cut into pieces that lose no window."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_BITS", 9)
    monkeypatch.setattr(suffix_dedup, "POSITION", 511)
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 100, 3000, dtype=np.uint8))
    sender = suffix_dedup.Sender(100, 4, 4)
    sender.add(1, 0, text)
    sender.block()
    at = np.concatenate([h[4] for h in sender.held])
    n = np.concatenate([h[5] for h in sender.held]) + 1
    assert sorted(bytesops.ranges(at, n).tolist()) == list(range(len(text) - 99))


def test_sharding(spark, docs, rows, empty):
    limit = 20_000
    out = sharding.extendible_shards(docs, "doc_id", F.octet_length("text"), limit).collect()
    assert sorted((r.doc_id, r.n_bytes) for r in out) == sorted((r[0], len((r[1] or "").encode())) for r in rows)
    for r in out:
        assert r.shard_bytes <= limit or r.shard_rows == 1 or r.depth == sharding.BITS
        bits = bin(int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16))[2:].zfill(60)
        assert bits.startswith(r.shard) and len(r.shard) == r.depth
        if r.depth:  # the bucket above was over the limit
            above = [x for x in out if x.shard.startswith(r.shard[:-1])]
            assert sum(x.n_bytes for x in above) > limit
    same = spark.createDataFrame([(7, 400)] * 10 + [(None, 300)], "k long, b long")
    pages = sharding.extendible_shards(same, "k", F.col("b"), 1000).collect()
    assert Counter((r.k, r.page) for r in pages if r.k == 7) == {(7, p): 2 for p in range(1, 6)}
    assert sharding.extendible_shards(empty, "doc_id", F.octet_length("text"), limit).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_longest_repeats_of_periodic_texts(seed):
    """Several texts at once, with few words, long periods and whole copies: each position's longest run that its own text has elsewhere."""
    rng = np.random.default_rng(seed)
    texts = [list(rng.integers(0, 3, int(rng.integers(0, 40)))) for _ in range(4)] + [[0] * 33, [0, 1, 2] * 11, []]
    texts.append(texts[0] + texts[0])
    codes = np.array([1000 * d + w for d, t in enumerate(texts) for w in t], dtype=np.int64)
    end = np.repeat(np.cumsum([len(t) for t in texts]), [len(t) for t in texts])
    want = []
    for t in texts:
        for i in range(len(t)):
            best = 0
            for j in range(len(t)):
                k = 0
                while j != i and i + k < len(t) and j + k < len(t) and t[i + k] == t[j + k]:
                    k += 1
                best = max(best, k)
            want.append(best)
    assert quality_rules.longest_repeats(codes, end).tolist() == want
