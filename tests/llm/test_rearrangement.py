"""Operators 11 to 13 against brute force: token alignment, licence scan, fill-in-middle."""

import hashlib
import random
import re
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from cellplane.llm import fill_middle as fm
from cellplane.llm import license_scan as ls
from cellplane.llm import token_alignment as ta

SF = "/root/testdata/sf0.001"


def same(got, want):
    key = lambda r: tuple(str(x) for x in r)
    return sorted(map(key, got)) == sorted(map(key, want))


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


# Operator 13


def rearranged(i, t, rate=100, spm=50, unit=r"[^\n]*\n|[^\n]+"):
    t = t or ""
    u = re.findall(unit, t)
    n = len(u)
    d = sha(f"7:{'' if i is None else i}")
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return i, n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h[3] % 100 < spm:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(1)
    parts = ["a", "\n", "ö", "𝄞", "<", "P", ">", "S", "M<", " ", "<P"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 5, 50, 3000])))) for i in range(200)]
    rows += [(1, None), (None, "x\ny"), (None, ""), (5, "\n" * 1000), (6, "x" * 5000 + "<P"), (7, "a\n" * 2000 + "<M>")]
    return rows + rows[:3]


@pytest.mark.parametrize("piece", [1 << 16, 7, 700])
def test_fill_middle(spark, odd, piece):
    out = fm.fill_middle(spark.createDataFrame(odd, "doc_id long, text string").repartition(3), piece=piece).cache()
    assert same([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect()], [rearranged(i, t) for i, t in odd])
    assert same([(r.doc_id, r.t) for r in out.select("doc_id", fm.restored(out.output, out.form).alias("t")).collect()], [(i, t or "") for i, t in odd])


def test_fill_middle_rates_and_units(spark, odd):
    odd = [(i, t) for i, t in odd if not (t or "").startswith((" ", "\n"))]
    out = fm.fill_middle(spark.createDataFrame(odd, "doc_id long, text string"), rate=60, spm_rate=20, units=fm.word_units, piece=400).collect()
    assert same([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out], [rearranged(i, t, 60, 20, r"[^ \n]+[ \n]*") for i, t in odd])


def test_op13(spark, texts):
    want = [(*rearranged(i, t)[:5], sha(rearranged(i, t)[5]), sha(t or "")) for i, t in texts]
    assert same(fm.op13_fill_middle(spark, SF).collect(), want)


def test_fill_middle_columns_and_empty(spark):
    out = fm.fill_middle(spark.createDataFrame([(1, "a\nb", 5, "kept")], "doc_id long, text string, n long, row string"))
    assert out.columns == ["doc_id", "text", "row", "n", "form", "prefix_chars", "middle_chars", "output"] and out.collect()[0].row == "kept"
    assert fm.fill_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# Operator 12


def test_license_notices(spark):
    rng = random.Random(2)
    filler = lambda n: " ".join(rng.choice(["the", "software", "of", "license", "mit", "any", "work", "under"]) for _ in range(n))
    rows, want = [], {}
    for n, (label, text) in enumerate(ls.TEMPLATES):
        for at, ahead in enumerate((0, 13, 500)):
            rows.append((100 * n + at, f"{filler(ahead)}\n{text.upper()}\n{filler(40)}"))
            want[100 * n + at] = label
    rows += [(-1, None), (-2, ""), (-3, "released under the licence of MIT, not a license"), (None, "MIT License"), (None, "MIT License"), (-4, filler(50_000)), (-5, "general PUBLIC license general public-license!")]
    docs, spans = ls.license_scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    out = docs.collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all(label in by[i].labels.split(",") and by[i].score == 1.0 for i, label in want.items())
    assert {i for i in want} <= {r.doc_id for r in spans.collect()}
    assert all((by[i].labels, by[i].score, by[i].n_base, by[i].first_word) == ("", 0.0, 0, None) for i in (-1, -2, -3))
    assert [(r.n_base, r.labels, r.first_word, r.last_word) for r in out if r.doc_id is None] == [(1, "mit", 0, 0)] * 2
    assert (by[-5].n_base, by[-5].first_word, by[-5].last_word, by[-5].base_labels) == (2, 0, 3, "gpl")


def test_license_filters_lose_nothing(spark):
    """Random blocks and templates: the join finds exactly the pairs that counting finds."""
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefgh")
    templates = [(f"t{i}", " ".join(word() for _ in range(rng.choice([3, 6, 8, 9, 15, 16, 30])))) for i in range(12)]
    rows = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(40)]
    docs, spans = ls.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), templates=templates, percent=60)
    want = set()
    for i, t in rows:
        w = t.split()
        for n, (_, template) in enumerate(templates):
            need, s = set(ls.pairs_of(template)), ls.class_of(template)
            for at in range(0, len(w) + 1, s):
                block = w[at : at + 2 * s]
                if 100 * len(need & {f"{a} {b}" for a, b in zip(block, block[1:])}) >= 60 * len(need):
                    want.add((i, n, at))
    assert {(r.doc_id, r.template, r.first_word) for r in spans.collect()} == want and len(want) > 20


def test_license_empty(spark):
    assert ls.license_scan(spark.createDataFrame([], "doc_id long, text string"))[0].count() == 0
    assert ls.license_scan(spark.createDataFrame([("x", "MIT license")], "score string, text string"), key="score")[0].columns[0] == "key_score"


# Operator 11


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(f"{ta.TOKENIZERS}/{ta.A_FILE}")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{ta.TOKENIZERS}/{ta.B_FILE}")
        self.byte = ta._byte_of()

    def of_b(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()

    def results(self, rows):
        docs, count = [], Counter()
        for i, t in rows:
            whole = (" " + (t or "")).encode()
            sides = []
            for ids, of in ((self.a.encode(" " + t, add_special_tokens=False).ids if t else [], lambda x: bytes(self.byte[c] for c in self.a.id_to_token(x))), (self.b.encode(t) if t else [], self.of_b)):
                ends, n = [], 0
                for x in ids:
                    n += len(of(x))
                    ends.append(n)
                sides.append((ids, ends, b"".join(map(of, ids)) == whole))
            (a, ends_a, ok_a), (b, ends_b, ok_b) = sides
            if not (t and ok_a and ok_b):
                docs.append((i, 0, 0, [], ""))
                continue
            both = sorted(set(ends_a) & set(ends_b))
            of_a, of_b = dict(zip(ends_a, a)), dict(zip(ends_b, b))
            links = [(of_b[e], of_a[e]) for e in both]
            count.update(links)
            groups, at_a, at_b = [], 0, 0
            for e in both:
                to_a, to_b = ends_a.index(e, at_a) + 1, ends_b.index(e, at_b) + 1
                groups.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
                at_a, at_b = to_a, to_b
            docs.append((i, len(a), len(b), links, ";".join(groups)))
        best = Counter()
        for (b, _), n in count.items():
            best[b] = max(best[b], n)
        return [(i, na, nb, len(x), len(x), sum(count[y] == best[y[0]] for y in x), sum(count[y] for y in x), sha(g) if g else "") for i, na, nb, x, g in docs], count, best


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_alignment_of_odd_texts(spark, plain):
    rng = random.Random(5)
    odd = ["", None, " ", "  ", "a  b", " lead", "trail ", "x\n\ny z", "<|endoftext|> hi <s> </s>", "▁ under", "a▁b c", "don't we'll I'm", "𝄞 ö ﬁ É é", "\t\ttab", "\x00nul \x01", "a ́b", "日本語 テキスト です", "x" * 3000, "ab " * 1000, "<0x41> <unk>", "\x1c a \x1c", "😀😀 👩‍👩‍👧"]
    parts = ["a", "b", " ", "  ", "\n", "'s", "ö", "𝄞", "1", "23", ".", "the", "<s>", " ", "\t", "ing", "日", "́", "​", "É", "\r", "\x85"]
    odd += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(500)]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(odd)] + [(3, "same text"), (3, "same text")]
    docs, pairs = ta.token_alignment(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), block=2000, volume=500)
    want, count, best = plain.results(rows)
    assert same(docs.collect(), want) and sum(r[1] == 0 for r in want) >= 4
    assert {(r.b_id, r.a_id): (r.n_links, r.best) for r in pairs.collect()} == {(b, a): (n, n == best[b]) for (b, a), n in count.items()}


def test_op11(spark, plain, texts):
    assert same(ta.op11_token_alignment(spark, SF).collect(), plain.results(texts)[0])


def test_alignment_groups_and_empty(spark):
    out = ta.token_alignment(spark.createDataFrame([("7", "one two"), (None, "")], "n_a string, text string"), key="n_a", groups=True)[0].collect()
    assert {r.key_n_a: sha(r.groups) == r.groups_sha256 for r in out} == {7: True, None: False} and len(out) == 2
    docs, pairs = ta.token_alignment(spark.createDataFrame([], "doc_id long, text string"))
    assert docs.count() == 0 and pairs.count() == 0
