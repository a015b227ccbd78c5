"""Operator 3: n-gram Jaccard join by vertical partitioning.

Texts become sets of five-word shingles. All shingles stand in one global order: the frequent ones last, by count, the others by
hash. Texts of one set are one node from the start.

1. Two sets that are alike enough share shingles among the first p = n - ceil(0.8 n) + 1 of each: with a as the least intersection
   that their sizes ask for, at least min(p - n + a) over the two. The global order of those prefixes is cut into fragments; each receiver
   counts for its fragment what two nodes share, and the sum per pair must reach that number. Where more than `SMALL` nodes meet at one
   shingle no pairs are formed: the nodes join the unit of the group's least node of like size.
2. A unit is a node with those that it may be linked with (or whose links the unit shall find). A member of large groups stays in
   a unit only if what it could share with some other member there, summed over the units of both, reaches what their sizes ask for, and
   this is the unit where the two share most.
3. Whole sets go to their units, large units in blocks of nodes, each two blocks to one task. There the global order is cut again; the
   overlaps of each fragment are counted for all pairs at once by a matrix product, and the sum over the fragments is the exact
   intersection. A pair of two common units counts in the first. Only a row for each linked node leaves a block: how many links it has, and
   a node that it is connected to. So no group expands into rows of pairs, and every link counts once.
4. Connected nodes make components.

Defined results: null and wordless texts have empty sets and link with nothing. Repeated rows are returned as often as they occur;
rows of equal sets are linked. Rows of one key and different texts are nodes of their own. A row with a null key takes part in no link and
has a null component. Keys must be whole numbers or castable to such; a key column named like a result column comes back as
key_<name>. Texts of any length are taken whole, in pieces. Other columns of the input,
whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellplane.operators.components import least_labels

from .blobs import DDL, batch, by_slot, joined, unpack
from .bytesops import mix
from .common import bounded_batches, drop, materialise, own_name, table
from .words import blocks, distinct, shingles, word_hashes

WORDS, PERCENT = 5, 80
#: Shingles that stand last in the order: at most so many, each met so often by one sender, and in total.
FREQUENT, OFTEN, TOTAL = 1 << 16, 8, 64
#: Groups up to this size are candidates pairwise at once; the members of larger ones meet in units.
SMALL = 8
#: Prefix shingles of a receiver, and the least number of receivers.
RECORDS, SLOTS = 500_000, 64
#: Nodes and shingles of a block in which links are counted (one text may be longer), and shingles of a fragment there.
BLOCK_NODES, BLOCK_SHINGLES, COLUMNS = 1000, 500_000, 2048
NODES = pa.schema([("k", pa.int64()), ("n", pa.int64()), ("s", pa.int64()), ("s2", pa.int64()), ("shingle", pa.int64()), ("times", pa.int64())])


def sets(batches, k: int = WORDS):
    """Blocks of (keys, sizes, text numbers, shingles): the distinct shingles of each text, sorted by text and hash."""
    rows = ((text.as_py() or b"", key) for b in batches for text, key in zip(b.column("text"), b.column("k").to_pylist(), strict=True))
    for block in blocks(rows):
        words, doc = word_hashes([t for t, _ in block], lower=True)
        values, doc = distinct(*shingles(words, doc, k, len(block)))
        yield [key for _, key in block], np.bincount(doc, minlength=len(block)), doc, values


def identity(doc: np.ndarray, values: np.ndarray, n: int, seed: int) -> np.ndarray:
    """64 bits that a set has, whatever its order."""
    out = np.zeros(n, dtype=np.uint64)
    at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, np.int64)
    if len(at):
        out[doc[at]] = np.add.reduceat(mix(values + np.uint64(seed * 2 + 1)), at)
    return mix(out)


def profile(seed: int):
    """A row for each text with the size and identity of its set; rows of shingles that were met often."""

    def run(batches):
        met: list[np.ndarray] = []
        for keys, sizes, doc, values in sets(batches):
            s, s2 = identity(doc, values, len(keys), seed), identity(doc, values, len(keys), seed + 1000)
            none = pa.nulls(len(keys), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(s.view(np.int64)), pa.array(s2.view(np.int64)), none, none], schema=NODES)
            once = np.zeros(len(keys), dtype=bool)
            once[np.unique(s, return_index=True)[1]] = True
            met.append(values[once[doc]])
            if sum(map(len, met)) > 1_000_000:
                yield often(met)
                met = []
        if met:
            yield often(met)

    return run


def often(met: list[np.ndarray]) -> pa.RecordBatch:
    values, times = np.unique(np.concatenate(met), return_counts=True)
    keep = times >= OFTEN
    none = pa.nulls(int(keep.sum()), pa.int64())
    return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(values[keep].view(np.int64)), pa.array(times[keep], pa.int64())], schema=NODES)


def ordered(values: np.ndarray, doc: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles as places in the global order, sorted within each text. last: frequent shingles by ascending hash, with ranks."""
    place = values >> np.uint64(1)
    if len(last):
        at = np.minimum(np.searchsorted(last[:, 0], values), len(last) - 1)
        hit = last[at, 0] == values
        place[hit] = np.uint64(1 << 63) | last[at[hit], 1]
    return distinct(place, doc)


def prefixes(seed: int, last: np.ndarray, slots: int):
    """The prefix of every set, packed for the receivers of its shingles."""

    def run(batches):
        held, count = [], 0

        def flush():
            out: list = []
            if held:
                s, n, t = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.lexsort((s, t))
                s, n, t = s[order], n[order], t[order]
                keep = np.ones(len(t), dtype=bool)
                keep[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
                spread = mix(t[keep])
                by_slot((spread >> np.uint64(32)).astype(np.int64) % slots, 0, [spread, s[keep], n[keep]], out)
            return batch(out)

        for keys, sizes, doc, values in sets(batches):
            s = identity(doc, values, len(keys), seed)
            once = np.zeros(len(keys), dtype=bool)
            once[np.unique(s, return_index=True)[1]] = True
            once &= np.array([k is not None for k in keys])
            place, doc = ordered(values, doc, last)
            n = np.bincount(doc, minlength=len(keys))
            begin = np.cumsum(n) - n
            first = n - (PERCENT * n + 99) // 100 + 1
            keep = once[doc] & (np.arange(len(doc)) - begin[doc] < first[doc])
            held.append((s[doc[keep]], n[doc[keep]], place[keep]))
            count += int(keep.sum())
            if count > 250_000:
                yield flush()
                held, count = [], 0
        yield flush()

    return run


#: What a receiver says. PAIR: x and y share a shingles here. MEMBER: x meets the unit of y at a shingles. TOTAL: x meets others at a shingles, at b in large groups.
MET = "kind int, x long, y long, nx long, ny long, a long, b long"
MET_SCHEMA = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("x", "y", "nx", "ny", "a", "b")]])
PAIR, MEMBER, MEETS = range(3)


def near_sizes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)


def said(kind: int, x, y=None, nx=None, ny=None, a=None, b=None) -> pa.Table:
    none = pa.nulls(len(x), pa.int64())
    columns = [none if c is None else pa.array(c.astype(np.int64)) for c in (x, y, nx, ny, a, b)]
    return pa.table([pa.array(np.full(len(x), kind, np.int32)), *columns], schema=MET_SCHEMA)


def tallied(kind: int, parts: list[tuple[np.ndarray, ...]]) -> pa.Table:
    """Rows (x, y, nx, ny), each once, and how often they came."""
    if not parts:
        return MET_SCHEMA.empty_table()
    x, y, nx, ny = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.lexsort((y, x))
    x, y, nx, ny = x[order], y[order], nx[order], ny[order]
    at = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])) if len(x) else np.empty(0, np.int64)
    return said(kind, x[at], y[at], nx[at], ny[at], np.diff(np.append(at, len(x))))


def candidates(t: pa.Table) -> pa.Table:
    """What the nodes of one receiver share, see MET."""
    pa.default_memory_pool().release_unused()  # what the group before this one held
    digit, s, n = joined([unpack(d) for d in t.column("data").to_pylist()], ("u8", "u8", "i8"))
    s = s.view(np.int64)
    order = np.lexsort((s, n, digit))
    digit, s, n = digit[order], s[order], n[order]
    if not len(digit):
        return MET_SCHEMA.empty_table()
    new = np.concatenate([[True], (digit[1:] != digit[:-1]) | (s[1:] != s[:-1])])
    digit, s, n = digit[new], s[new], n[new]
    begin = np.flatnonzero(np.concatenate([[True], digit[1:] != digit[:-1]]))
    count = np.diff(np.append(begin, len(digit)))
    size = np.repeat(count, count)
    meeting, inverse, times = np.unique(s[size > 1], return_inverse=True, return_counts=True)
    large = np.bincount(inverse, weights=size[size > 1] > SMALL, minlength=len(meeting))
    little = (size > 1) & (size <= SMALL)
    d, a, m = digit[little], s[little], n[little]
    pairs = []
    for step in range(1, SMALL):
        if len(d) <= step:
            break
        i = np.flatnonzero((d[step:] == d[:-step]) & near_sizes(m[step:], m[:-step]))
        j = i + step
        low = a[i] < a[j]
        pairs.append((np.where(low, a[i], a[j]), np.where(low, a[j], a[i]), np.where(low, m[i], m[j]), np.where(low, m[j], m[i])))
    members = []
    for at, many in zip(begin[count > SMALL].tolist(), count[count > SMALL].tolist(), strict=True):
        # Sorted by size. A lead's unit reaches two bands of like size, so the partners of all of its own band are there.
        end, sizes = at + many, n[at : at + many]
        while at < end:
            first = end - len(sizes)
            own, wide = (first + int(np.searchsorted(sizes, least, side="right")) for least in (n[at] * 100 // PERCENT, n[at] * 10000 // PERCENT**2))
            if wide - at > 1:
                members.append((s[at:wide], np.full(wide - at, s[at]), n[at:wide], np.full(wide - at, n[at])))
            at = own
    return pa.concat_tables([tallied(PAIR, pairs), tallied(MEMBER, members), said(MEETS, meeting, a=times, b=large)])


def needed(a: str, b: str) -> Column:
    """How many shingles the prefixes of alike sets of these sizes share at least."""
    least = F.expr(f"({PERCENT} * ({a} + {b}) + {99 + PERCENT}) div {100 + PERCENT}")
    return F.greatest(1 - F.expr(f"({PERCENT} * greatest({a}, {b}) + 99) div 100") + least, F.lit(1))


def dealt(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows (c, parts, bin, s, …) by (u, b1, b2): small units share a bin (b1 = -1), of larger ones each two blocks meet."""
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("s"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    small = F.col("parts") == 1
    u, b1, b2 = F.when(small, F.col("bin")).otherwise(F.col("c")), F.when(small, -1).otherwise(F.least("mine", "other")), F.when(small, -1).otherwise(F.greatest("mine", "other"))
    return rows.select(u.alias("u"), b1.alias("b1"), b2.alias("b2"), "c", "s", "mine", *columns)


def by_unit(t: pa.Table):
    """For each unit of a bin (or the one of two blocks): its name, its rows in t, their nodes, and which are of the first and of the second block."""
    c, s, mine, first, last = (t.column(x).to_numpy() for x in ("c", "s", "mine", "b1", "b2"))
    order = np.lexsort((s, c))
    c, s, mine = c[order], s[order], mine[order]
    once = np.concatenate([[True], (c[1:] != c[:-1]) | (s[1:] != s[:-1])])
    order, c, s, mine = order[once], c[once], s[once], mine[once]
    begin = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(c)], strict=True):
        if b - a > 1:
            left = np.flatnonzero(mine[a:b] == max(first[0], 0))
            yield c[a], order[a:b], s[a:b], left, left if first[0] == last[0] else np.flatnonzero(mine[a:b] == last[0])


def lists_of(t: pa.Table, column: str) -> list[np.ndarray]:
    lists = t.column(column).combine_chunks()
    return np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])


def partners(t: pa.Table) -> pa.Table:
    """Members (c, s, n) of units that could be linked with another member, and whose links with that one this unit shall find.

    A pair shares at most min(times of the one, times of the other) in each unit of both, and of these units the one where that is most
    shall find the link. Pairs that meet in small groups as well are not needed here: they are units of their own.
    """
    n, places, times = t.column("n").to_numpy(), lists_of(t, "units"), lists_of(t, "times")
    out = [(np.empty(0, np.int64),) * 3]
    for c, rows, s, left, right in by_unit(t):
        of, unit = np.repeat(np.arange(len(rows)), [len(places[i]) for i in rows]), np.concatenate([places[i] for i in rows])
        many = np.concatenate([times[i] for i in rows])
        order = np.argsort(unit, kind="stable")
        of, unit, many = of[order], unit[order], many[order]
        begin = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        most, best, here = (np.zeros((len(left), len(right)), dtype=np.int64) for _ in range(3))
        row_of, column_of = np.full(len(rows), -1), np.full(len(rows), -1)
        row_of[left], column_of[right] = np.arange(len(left)), np.arange(len(right))
        for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(unit)], strict=True):
            x, y, z = row_of[of[i:j]], column_of[of[i:j]], many[i:j]
            at = np.ix_(x[x >= 0], y[y >= 0])
            both = np.minimum.outer(z[x >= 0], z[y >= 0])
            most[at] += both
            more = both > best[at]
            best[at], here[at] = np.where(more, both, best[at]), np.where(more, unit[i] == c, here[at])
        a, b = n[rows[left]][:, None], n[rows[right]][None, :]
        far = np.maximum(a, b)
        asked = np.maximum(1 - (PERCENT * far + 99) // 100 + (PERCENT * (a + b) + 99 + PERCENT) // (100 + PERCENT), 1)
        hit = (here > 0) & (most >= asked) & (100 * np.minimum(a, b) >= PERCENT * far) & (left[:, None] != right[None, :])
        found = np.union1d(left[hit.any(axis=1)], right[hit.any(axis=0)])
        out.append((np.full(len(found), c), s[found], n[rows[found]]))
    return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["c", "s", "n"])


def units(met: DataFrame) -> DataFrame:
    """(c, s, n): the members of the units, c being the unit's name."""
    large = met.filter(F.col("kind") == MEETS).groupBy("x").agg(F.sum("b").alias("large"))
    large = materialise(large.filter("large > 0"), "join-meets")
    pairs = met.filter(F.col("kind") == PAIR).groupBy("x", "y").agg(F.max("nx").alias("nx"), F.max("ny").alias("ny"), F.sum("a").alias("shared"))
    # What a pair shares in large groups is not counted: at most as many as either end has there.
    ends = pairs.join(large.select("x", F.col("large").alias("lx")), "x", "left").join(large.select(F.col("x").alias("y"), F.col("large").alias("ly")), "y", "left")
    unseen = F.coalesce(F.least(F.coalesce("lx", F.lit(0)), F.coalesce("ly", F.lit(0))), F.lit(0))
    asked = ends.filter(F.col("shared") + unseen >= needed("nx", "ny"))
    asked = asked.select(F.col("x").alias("c"), F.explode(F.array(F.struct(F.col("x").alias("s"), F.col("nx").alias("n")), F.struct(F.col("y").alias("s"), F.col("ny").alias("n")))).alias("r"))
    star = materialise(met.filter(F.col("kind") == MEMBER).groupBy(F.col("y").alias("c"), F.col("x").alias("s")).agg(F.max("nx").alias("n"), F.sum("a").alias("w")), "join-star")
    sizes = star.groupBy("c").agg(F.count("*").alias("many")).filter("many > 1")
    bins = max(SLOTS, star.count() // (20 * BLOCK_NODES))
    sizes = sizes.select("c", F.ceil(F.col("many") / BLOCK_NODES).cast("int").alias("parts"), F.pmod(F.xxhash64("c"), F.lit(bins)).alias("bin"))
    lists = star.groupBy("s").agg(F.collect_list(F.struct("c", "w")).alias("meets"))
    rows = star.select("c", "s", "n").join(sizes, "c").join(lists.select("s", F.col("meets.c").alias("units"), F.col("meets.w").alias("times")), "s")
    star = dealt(rows, ["n", "units", "times"]).groupBy("u", "b1", "b2").applyInArrow(partners, "c long, s long, n long")
    out = materialise(asked.select("c", "r.s", "r.n").unionByName(star).groupBy("c", "s").agg(F.max("n").alias("n")), "join-members")
    drop(large)
    return out


SHIPPED = "units array<struct<c:long,parts:int,bin:long>>, s long, places array<long>"


def ship(seed: int, last: np.ndarray):
    """The sets of the asked texts, in the global order, with the units that they go to. k: the node and its units."""

    def run(batches):
        kind = None

        def typed():
            nonlocal kind
            for b in batches:
                kind = b.schema.field("k").type.field("units").type
                yield b

        for keys, sizes, doc, values in sets(typed()):
            s = identity(doc, values, len(keys), seed).view(np.int64)
            place, doc = ordered(values, doc, last)
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(place.view(np.int64)))
            out = pa.RecordBatch.from_arrays([pa.array([k["units"] for k in keys], kind), pa.array(s), lists], names=["units", "s", "places"])
            yield out.filter(pa.array(s == np.array([k["s"] for k in keys], dtype=np.int64)))

    return run


def overlaps(row: np.ndarray, code: np.ndarray, size: int, left: np.ndarray, right: np.ndarray, rows: int) -> np.ndarray:
    """Sizes of the intersections of the sets of left and right. row, code: members of the sets by code; counted fragment by fragment of the codes."""
    shared = np.zeros((len(left), len(right)), dtype=np.int32)
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    for begin in range(0, size, COLUMNS):
        a, b = np.searchsorted(code, [begin, begin + COLUMNS])
        has = np.zeros((rows, min(COLUMNS, size - begin)), dtype=np.float32)
        has[row[a:b], code[a:b] - begin] = 1
        shared += (has[left] @ has[right].T).astype(np.int32)
    return shared


def links_of(own: list[np.ndarray], other: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node of one or two blocks of a unit: number of links, and number of a node that it is connected to.

    own: the nodes' sets in the global order; other: the units before this one that they are in as well.
    """
    m, n = len(own), np.array([len(p) for p in own])
    row, place = np.repeat(np.arange(m), n), np.concatenate(own)
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    many = np.diff(np.append(begin, len(place)))
    met = np.repeat(many > 1, many)
    code = np.repeat(np.arange(int((many > 1).sum())), many[many > 1])
    shared = overlaps(row[met], code, int((many > 1).sum()), left, right, m)
    alike = 100 * shared.astype(np.int64) >= PERCENT * (n[left][:, None] + n[right][None, :] - shared)
    alike &= left[:, None] != right[None, :]
    if any(map(len, other)) and alike.any():
        before, code = np.unique(np.concatenate(other), return_inverse=True)
        alike &= overlaps(np.repeat(np.arange(m), [len(o) for o in other]), code, len(before), left, right, m) == 0
    whole = np.zeros((m, m), dtype=bool)
    whole[np.ix_(left, right)] = alike
    whole |= whole.T
    links, root = whole.sum(axis=1), np.full(m, -1)
    for i in np.flatnonzero(links):
        if root[i] < 0:
            front = np.array([i])
            while len(front):
                root[front] = i
                front = np.flatnonzero(whole[front].any(axis=0) & (root < 0))
    return links, root


def unit_links(t: pa.Table) -> pa.Table:
    """Links of the nodes (s, root, links) of a bin of whole units, or of one or two blocks of a unit; nodes without links are left out."""
    pa.default_memory_pool().release_unused()
    places, earlier = lists_of(t, "places"), lists_of(t, "earlier")
    out = [(np.empty(0, np.int64),) * 3]
    for _, rows, s, left, right in by_unit(t):
        links, root = links_of([places[i] for i in rows], [earlier[i] for i in rows], left, right)
        at = np.flatnonzero(links)
        out.append((s[at], s[root[at]], links[at]))
    return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["s", "root", "links"])


def linked(members: DataFrame, docs: DataFrame, nodes: DataFrame, seed: int, last: np.ndarray) -> DataFrame:
    """(s, root, links): how many links each node has in each block of its units, and a node that it is connected to."""
    parts = F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_NODES))
    sizes = members.groupBy("c").agg(F.count("*").alias("many"), F.sum("n").alias("volume"), F.least(parts, F.count("*")).cast("int").alias("parts"))
    sizes = materialise(sizes.filter("many > 1"), "join-units")
    bins = max(SLOTS, -(-(sizes.filter("parts = 1").agg(F.sum("volume")).first()[0] or 0) // BLOCK_SHINGLES))
    of = members.join(sizes, "c").select("s", F.struct("c", "parts", F.pmod(F.xxhash64("c"), F.lit(bins)).alias("bin")).alias("u"))
    of = of.groupBy("s").agg(F.collect_list("u").alias("units"))
    one = nodes.filter("k is not null").groupBy("s").agg(F.min("k").alias("k"))
    asked = materialise(of.join(one, "s").select("k", F.struct("s", "units").alias("to")), "join-asked")
    few = asked.agg(F.sum(F.size("to.units") + 2)).first()[0] or 0
    few = F.broadcast(asked) if few <= 500_000 else asked
    shipped = docs.join(few, "k").select(F.col("to").alias("k"), "text").mapInArrow(ship(seed, last), SHIPPED)
    rows = shipped.select("s", "places", "units", F.explode("units").alias("u")).select("s", "places", "u.*", F.transform(F.filter("units", lambda v: v["c"] < F.col("u.c")), lambda v: v["c"]).alias("earlier"))
    out = materialise(dealt(rows, ["earlier", "places"]).groupBy("u", "b1", "b2").applyInArrow(unit_links, "s long, root long, links long"), "join-linked")
    drop(sizes, asked)
    return out


def jaccard_components(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each row of docs: the key, n_shingles, component_id (least key reachable by links), n_links (different sets linked with its own)."""
    docs = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("binary").alias("text"))
    bounded_batches(docs.sparkSession)
    seed = 21
    while True:
        seen = materialise(docs.mapInArrow(profile(seed), "k long, n long, s long, s2 long, shingle long, times long"), "join-profile")
        nodes = seen.filter("shingle is null").select("k", "n", "s", "s2")
        if not nodes.filter("n > 0").groupBy("s").agg(F.min("s2").alias("a"), F.max("s2").alias("b")).filter("a <> b").head(1):
            break
        seed += 1  # two sets of one identity: other identities
    counts = seen.filter("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("times")).filter(F.col("times") >= TOTAL)
    top = counts.orderBy(F.col("times").desc(), "shingle").limit(FREQUENT).collect()
    last = np.array([(r.shingle % (1 << 64), FREQUENT - i) for i, r in enumerate(top)], dtype=np.uint64).reshape(-1, 2)
    last = last[np.argsort(last[:, 0])]
    records = nodes.agg(F.sum(F.expr(f"n - ({PERCENT} * n + 99) div 100 + 1"))).first()[0] or 0
    slots = max(SLOTS, -(-records // RECORDS))
    met = materialise(docs.mapInArrow(prefixes(seed, last, slots), DDL).groupBy("slot").applyInArrow(candidates, MET), "join-met")
    members = units(met)
    found = linked(members, docs, nodes, seed, last)
    drop(met, members)
    labels = least_labels(found.filter("s <> root").select(F.col("s").alias("a"), F.col("root").alias("b")), lambda df: materialise(df, "join-labels"))
    degree = found.groupBy("s").agg(F.sum("links").alias("n_links"))
    known = nodes.filter("k is not null and n > 0").groupBy("s").agg(F.min("k").alias("least"))
    known = known.join(labels.select(F.col("v").alias("s"), "label"), "s", "left").join(degree, "s", "left")
    known = known.withColumn("label", F.coalesce("label", "s"))
    known = known.join(known.groupBy("label").agg(F.min("least").alias("component")), "label").select("s", "component", "n_links")
    # Empty sets are nodes of their own; a key of their own keeps them from meeting in one task.
    rows = nodes.withColumn("j", F.when((F.col("n") > 0) & F.col("k").isNotNull(), F.col("s")))
    full = rows.filter("j is not null").join(known, "s").select("k", "n", "component", "n_links")
    rest = rows.filter("j is null").select("k", "n", F.col("k").alias("component"), F.lit(None).cast("long").alias("n_links"))
    full = full.unionByName(rest)
    return full.select(F.col("k").alias(own_name(key, ["n_shingles", "component_id", "n_links"])), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def op3_ngram_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), "doc_id", "text")
