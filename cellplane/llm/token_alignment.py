"""Operator 11: alignment of two tokenizers by co-occurrence counts in id-striped dense matrices.

A text is encoded by both vocabularies (A: byte-level BPE, B: pieces with byte fallback). Where tokens of both end at the same byte, the text is cut into
groups, and the two tokens that end there are linked. Counts of linked id pairs over the corpus say which A id goes best with a B id.

1. Encoding. Both vocabularies treat the stretches between single blanks with no white space beside them apart from each other (checked on loading; else texts
   go through whole), so a block of texts encodes each distinct stretch once. Links are summed by document and pair and dealt out by B id.
2. Counting. Tasks pre-aggregate pairs; the pairs are partitioned by stripes of B ids (id modulo `STRIPES`). A stripe is a dense matrix, B ids of the stripe by
   A ids, that np.add.at fills from partial counts as they stream by; row maxima give the best count of each B id.
3. Scoring. Links are partitioned by `SLOTS` groups of stripes together with the counts of these stripes; a slot with many links is cut into parts of `VOLUME`
   bytes, each with the counts. Links stream by and give sums for each document, which are added up.

Nothing grows with the corpus in memory: a task holds a block of texts, one matrix, or the counts of one slot (at most vocabulary x vocabulary / `SLOTS` pairs) and
one record of links. Only the two vocabulary files (a few MB) go to all executors, read once on the driver, so executors need no copy of them.

Defined results: texts that are null or empty, or whose joined bytes of A or B differ from a blank and the text, have no tokens: zeros and ''. Rows are told apart by
their place in a block, so repeated rows and null keys each get their own result. Keys must be castable to long; only the key and the results are returned, a key named like a
result as key_<name>. An empty table gives an empty result. Long texts are cut between stretches; a text costs memory of about ten times its bytes.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import by_slot, pack, unpack
from .bytesops import ranges
from .common import bounded_batches, materialise, own_name, partitions, table
from .words import blocks

#: Where the vocabulary files are, and their names.
TOKENIZERS, A_FILE, B_FILE = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of texts encoded at once; slots of links; stripes of the count matrix (a multiple of the slots); bytes of links a part; pairs held before they are summed up;
#: stretches encoded together.
BLOCK, SLOTS, STRIPES, VOLUME, HELD, RUN = 1 << 22, 32, 512, 1 << 26, 1 << 21, 256
RESULT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256"]
ENCODED = "block long, slot int, data binary, idx int, key long, n_a long, n_b long, n_groups long, groups string"
_ENCODED = pa.schema([("block", pa.int64()), ("slot", pa.int32()), ("data", pa.binary()), ("idx", pa.int32()), ("key", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.string())])
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for: itself if printable, else the next free code from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Pair:
    """Both vocabularies, loaded from their files' contents."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_buffer(a), SentencePieceProcessor(model_proto=b)
        self.a.encode_special_tokens = True
        byte = _byte_of()
        vocab = self.a.get_vocab()
        self.n_a, self.n_b = max(vocab.values()) + 1, self.b.vocab_size()
        self.a_bytes = [b""] * self.n_a
        for entry, i in vocab.items():
            self.a_bytes[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.a_size, self.b_size = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        split = json.loads(a)
        plain = (split.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and split["pre_tokenizer"].get("use_regex", True) and not split.get("normalizer")
        self.apart = plain and not any("▁" in p.lstrip("▁") for p in pieces) and self.b.encode("a  b Ä ﬁ", out_type=str) == self.b.encode("a  b", out_type=str) + self.b.encode("Ä", out_type=str) + self.b.encode("ﬁ", out_type=str)
        top = max(self.n_a, self.n_b)
        width = len(str(top - 1))
        self.digits = np.frombuffer(b"".join(str(i).encode().ljust(width, b"\0") for i in range(top)), np.uint8).reshape(top, width)

    def stretches(self, text: str) -> list[str]:
        return _CUT.split(text) if self.apart else [text]


class Aligned:
    """Distinct stretches of a block: tokens, groups and links of each. Stretches are encoded in runs, joined by blanks as in a text."""

    def __init__(self, p: Pair, stretches: list[str]):
        bare = [i for i, s in enumerate(stretches) if p.apart and s and not s[0].isspace() and not s[-1].isspace()]
        joined = set(bare)
        runs = [bare[i : i + RUN] for i in range(0, len(bare), RUN)] + [[i] for i in range(len(stretches)) if i not in joined]
        order, tokens_a, tokens_b = [], [], []
        while runs:  # a run whose bytes do not come back is taken apart
            texts, again = [" ".join([stretches[i] for i in run]) for run in runs], []
            ids = zip(runs, texts, p.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False), p.b.encode(texts, num_threads=1), strict=True)
            for run, t, a, b in ids:
                a, want = a.ids, b" " + t.encode()
                if b"".join(map(p.a_bytes.__getitem__, a)) == want == b"".join(map(p.b_bytes.__getitem__, b)):
                    order += run
                    tokens_a.append(np.array(a, dtype=np.int64)), tokens_b.append(np.array(b, dtype=np.int64))
                elif len(run) > 1:
                    again += [[i] for i in run]
            runs = again
        n, m = len(stretches), len(order)
        a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in (tokens_a, tokens_b))
        end_a, end_b = np.cumsum(p.a_size[a]), np.cumsum(p.b_size[b])  # both run over the same bytes
        ends = np.cumsum(np.array([len(stretches[i].encode()) + 1 for i in order], dtype=np.int64))
        last_a, last_b = np.isin(end_a, end_b), np.isin(end_b, end_a)
        self.links = b[last_b] * p.n_a + a[last_a]
        n_a, n_b, n_groups = (np.bincount(np.searchsorted(ends, e), minlength=m) for e in (end_a, end_b, end_a[last_a]))
        # Group by group, A's tokens and then B's, each with the mark behind it.
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        ends_a, ends_b = np.flatnonzero(last_a) + 1, np.concatenate([[0], np.flatnonzero(last_b) + 1])
        shown = np.empty((len(a) + len(b), p.digits.shape[1] + 1), dtype=np.uint8)
        at_a, at_b = np.arange(len(a)) + ends_b[group_a], np.arange(len(b)) + ends_a[group_b]
        shown[at_a, :-1], shown[at_b, :-1] = p.digits[a], p.digits[b]
        shown[at_a, -1], shown[at_b, -1] = np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))
        rows = np.concatenate([[0], np.cumsum(np.count_nonzero(shown, axis=1))])
        flat = shown.ravel()
        text, cut = flat[flat != 0].tobytes(), rows[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
        # Back to the order of the stretches; those without a way back to their bytes have nothing.
        self.valid, self.text = np.zeros(n, dtype=bool), [b""] * n
        self.valid[order] = True
        for i, s, e in zip(order, cut, cut[1:], strict=False):
            self.text[i] = text[s:e]
        self.n_a, self.n_b, self.n_groups, self.first = (np.zeros(n, dtype=np.int64) for _ in range(4))
        self.n_a[order], self.n_b[order], self.n_groups[order], self.first[order] = n_a, n_b, n_groups, np.cumsum(n_groups) - n_groups


def encoded(docs: DataFrame, key: str, text: str, files: tuple[bytes, bytes], block: int = BLOCK) -> DataFrame:
    """Rows of documents (idx, key, sizes, groups as text) and of links (slot, data: document, B id, A id, times), by block of texts."""
    sent = docs.sparkSession.sparkContext.broadcast(files)  # two vocabulary files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, number = Pair(*sent.value), TaskContext.get().partitionId() << 32
        for batch in batches:
            rows = zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(0).to_pylist(), strict=True)
            for held in blocks(rows, block):
                yield from one(p, number, held)
                number += 1

    def one(p: Pair, number: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        cut = [p.stretches(t.decode()) if t else [] for t, _ in held]
        of = [[known.setdefault(s, len(known)) for s in c] for c in cut]
        del cut
        doc = np.repeat(np.arange(len(held)), [len(x) for x in of])
        each = np.fromiter((i for x in of for i in x), np.int64, len(doc))
        s = Aligned(p, list(known))
        bad = np.bincount(doc[~s.valid[each]], minlength=len(held)) > 0
        texts = ["" if wrong else b"".join(map(s.text.__getitem__, x))[:-1].decode() for x, wrong in zip(of, bad, strict=True)]
        doc, each = doc[~bad[doc]], each[~bad[doc]]
        sums = [np.bincount(doc, weights=n[each], minlength=len(held)).astype(np.int64) for n in (s.n_a, s.n_b, s.n_groups)]
        n, null = len(held), pa.nulls
        yield pa.RecordBatch.from_arrays(
            [pa.array([number] * n, pa.int64()), null(n, pa.int32()), null(n, pa.binary()), pa.array(np.arange(n), pa.int32()), pa.array([k for _, k in held], pa.int64()), *[pa.array(x) for x in sums], pa.array(texts)],
            schema=_ENCODED,
        )
        pair, times = np.unique(doc * max(len(known), 1) + each, return_counts=True)
        doc, each = np.divmod(pair, max(len(known), 1))
        many = s.n_groups[each]
        link = s.links[ranges(s.first[each], many)]
        code, back = np.unique(np.repeat(doc, many) * (p.n_a * p.n_b) + link, return_inverse=True)
        times = np.bincount(back, weights=np.repeat(times, many), minlength=len(code)).astype(np.int64)
        doc, link = np.divmod(code, p.n_a * p.n_b)
        b, a = np.divmod(link, p.n_a)
        out: list[tuple[int, int, bytes]] = []
        by_slot(b % SLOTS, 1, [doc, b, a, times], out)
        n = len(out)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int64()), pa.array([r[0] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.binary()), null(n, pa.int32()), *[null(n, pa.int64()) for _ in range(4)], null(n, pa.string())], schema=_ENCODED,
            )

    text_ = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{key}`").cast("long").alias("key"), text_.alias("text")).mapInArrow(run, ENCODED)


def _summed(code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(code, kind="stable")
    code, times = code[order], times[order]
    at = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.empty(0, np.int64)
    return code[at], np.add.reduceat(times, at) if len(at) else times


def pair_counts(links: DataFrame, n_a: int, n_b: int) -> DataFrame:
    """A row for each stripe of B ids that occurs: slot, data (B id, A id, links of the pair, whether no A id has more with this B id)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, times, held = [], [], 0

        def dealt() -> pa.RecordBatch:
            code, n = _summed(np.concatenate(codes), np.concatenate(times))
            b, a = np.divmod(code, n_a)
            out: list[tuple[int, int, bytes]] = []
            by_slot(b % STRIPES, 0, [b // STRIPES, a, n], out)
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.binary())], ["stripe", "data"])

        for batch in batches:
            for data in batch.column(0).to_pylist():
                _, b, a, n = unpack(data)
                codes.append(b.astype(np.int64) * n_a + a), times.append(n.astype(np.int64))
                held += len(b)
                if held > HELD:
                    code, n = _summed(np.concatenate(codes), np.concatenate(times))
                    codes, times, held = [code], [n], len(code)
                    if held > HELD // 2:  # mostly different pairs: they go as they are
                        yield dealt()
                        codes, times, held = [], [], 0
        if held:
            yield dealt()

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, now = np.zeros((-(-n_b // STRIPES), n_a), dtype=np.int64), None

        def done() -> pa.RecordBatch:
            row, a = np.nonzero(matrix)
            n = matrix[row, a]
            best = n == matrix.max(axis=1)[row]
            matrix.fill(0)
            return pa.RecordBatch.from_arrays([pa.array([now % SLOTS], pa.int32()), pa.array([pack(row * STRIPES + now, a, n, best.astype(np.uint8))], pa.binary())], ["slot", "data"])

        for batch in batches:
            for stripe, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now is not None and stripe != now:
                    yield done()
                now = stripe
                row, a, n = unpack(data)
                np.add.at(matrix, (row.astype(np.int64), a.astype(np.int64)), n.astype(np.int64))
        if now is not None:
            yield done()

    parts = links.select("data").mapInArrow(partial, "stripe int, data binary")
    return parts.repartition(min(STRIPES, max(16, partitions(links.sparkSession))), "stripe").sortWithinPartitions("stripe").mapInArrow(dense, "slot int, data binary")


def scored(links: DataFrame, counts: DataFrame, n_a: int, volume: int = VOLUME) -> DataFrame:
    """(block, idx, n_best, count_sum) of each document and slot. links: block, slot, data; counts as pair_counts gives them."""
    sizes = links.groupBy("slot").agg(F.sum(F.octet_length("data")).alias("bytes")).select("slot", F.greatest(F.ceil(F.col("bytes") / volume), F.lit(1)).cast("int").alias("parts"))
    sizes = F.broadcast(sizes)  # SLOTS rows at most
    ours = links.join(sizes, "slot").select("slot", F.pmod(F.hash("block"), F.col("parts")).alias("part"), F.lit(1).alias("kind"), "block", "data")
    theirs = counts.join(sizes, "slot").select("slot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("block"), "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, codes = None, [], None
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for slot, part, kind, block, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (slot, part) != now:
                    now, parts, codes = (slot, part), [], None
                if kind == 0:
                    parts.append(unpack(data))
                    continue
                if codes is None:
                    codes, n, best = (np.concatenate(x) for x in zip(*[(b.astype(np.int64) * n_a + a, n.astype(np.int64), best.astype(np.int64)) for b, a, n, best in parts], strict=True))
                    order = np.argsort(codes)
                    codes, n, best, parts = codes[order], n[order], best[order], []
                doc, b, a, times = unpack(data)
                at, times = np.searchsorted(codes, b.astype(np.int64) * n_a + a), times.astype(np.int64)
                first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                for list_, x in zip(out, (np.full(len(first), block), doc[first].astype(np.int32), np.add.reduceat(best[at] * times, first), np.add.reduceat(n[at] * times, first)), strict=True):
                    list_.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["block", "idx", "n_best", "count_sum"])

    dealt = ours.unionByName(theirs).repartition("slot", "part").sortWithinPartitions("slot", "part", "kind")
    return dealt.mapInArrow(run, "block long, idx int, n_best long, count_sum long")


def pair_table(counts: DataFrame) -> DataFrame:
    """The counts as rows: b_id, a_id, n_links, best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                b, a, n, best = unpack(data)
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (b, a, n)] + [pa.array(best.astype(bool))], ["b_id", "a_id", "n_links", "best"])

    return counts.select("data").mapInArrow(run, "b_id long, a_id long, n_links long, best boolean")


def token_alignment(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, a_file: str = A_FILE, b_file: str = B_FILE, groups: bool = False, block: int = BLOCK, volume: int = VOLUME) -> tuple[DataFrame, DataFrame]:
    """A row for each document (key, sizes, n_best, count_sum, digest of its groups; with groups, the groups themselves), and the pair counts as pair_table."""
    bounded_batches(docs.sparkSession)
    files = []
    for name in (a_file, b_file):
        with open(os.path.join(folder, name), "rb") as f:
            files.append(f.read())
    p = Pair(*files)
    done = encoded(docs, key, text, (files[0], files[1]), block).withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))
    done = materialise(done if groups else done.drop("groups"), "tokens")
    links = done.filter("slot is not null").select("block", "slot", "data")
    counts = materialise(pair_counts(links, p.n_a, p.n_b), "token-pairs")
    sums = scored(links, counts, p.n_a, volume).groupBy("block", "idx").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = done.filter("slot is null").join(sums, ["block", "idx"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    shown = [F.col("key").alias(own_name(key, RESULT)), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256"]
    return out.select(*shown, *(["groups"] if groups else [])), pair_table(counts)


def op11_token_alignment(spark, sf_dir):
    """Every document encoded by both vocabularies, its links scored by the corpus-wide counts."""
    return token_alignment(table(spark, sf_dir, "documents"))[0]
