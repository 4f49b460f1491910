"""Near-duplicates by a chosen-path join over minwise tokens.

Documents with equal shingle sets become one record. A record has `COORDS` minwise tokens and a
sketch of one bit from each of `FUNCTIONS` minwise hashes. Each of `TREES` trees starts at the root,
where it branches on `PICKS` tokens: records with the same token share a node. What follows:

1. In every first-level node all records are compared with the node's smallest record by sketch;
   each record's most alike partner of these is confirmed on full sets. This joins copies by the
   thousand with a linear number of comparisons. Labels are the components of the links so far.
2. Nodes whose records are all joined already have nothing to add and end. Nodes of at most `NODE`
   records are compared exhaustively: by sketch, which names the records that may have a partner,
   then on the shingle sets of these, which travel to the node. A node answers with a spanning
   forest of its links, so with fewer links than it has records. A larger node in which all but
   `NODE` records are joined already is cut into pieces of the joined ones, each compared with all
   the others.
3. Labels are drawn up again. Larger nodes branch on tokens chosen by the node's hash, on one in two
   of three nodes and on two in the others, so that the rows of a linked pair neither grow nor
   shrink from level to level, while nodes of unlinked records shrink by their similarity. What is
   still large at depth `DEPTH` is compared in blocks of `NODE` / 2 records, each block against
   each; all nodes below the first level are compared at once.

A pair of similarity 0.75 that never meets in a smaller node survives a first-level node's branching
with q' = q - 0.1875 q^2 a level, 0.48 at depth 5: of the 12 first-level nodes none keeps it with
(1 - 0.75 * 0.48)^12 = 0.5 %. Pairs of nodes that are small at once are missed with 0.25^12 = 6e-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import cut, drop_cut, maybe_in, without
from pagewright.llm.components import components
from pagewright.llm.shingles import mix, shingle_set

TREES, PICKS, COORDS, FUNCTIONS = 6, 2, 40, 128
NODE, DEPTH = 256, 12
#: Sets of more shingles travel to nodes as a sample by hash of about this size; their pairs are confirmed on full sets.
FULL = 2048
#: Sketch bits that agree: 112 of 128 are expected at similarity 0.75, with a deviation of 3.7; 93 is five deviations below.
AGREE = 93
_rng = np.random.default_rng(20240607)
_MUL = (_rng.integers(0, 2**32, FUNCTIONS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_XOR = _rng.integers(0, 2**32, FUNCTIONS, dtype=np.uint64).astype(np.uint32)
_BIT = (np.uint64(1) << np.arange(64, dtype=np.uint64)).astype(np.uint64)
SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, s0 long, s1 long, tokens array<int>"


def minhash(found: np.ndarray) -> np.ndarray:
    """FUNCTIONS minwise values of a set of hashes, in slices of bounded memory."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(FUNCTIONS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        v = (x[at : at + 512, None] ^ _XOR[None, :]) * _MUL[None, :]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        v ^= v >> np.uint32(13)
        np.minimum(out, v.min(axis=0), out=out)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        n = batch.num_rows
        size, num, tokens = np.zeros(n, np.int64), np.zeros((n, 4), np.uint64), np.zeros((n, COORDS), np.uint32)
        for i in range(n):
            found = shingle_set(texts[i].as_py())
            size[i] = len(found)
            if len(found):
                low = minhash(found)
                bits = (low & np.uint32(1)).astype(np.uint64)
                num[i] = mix(found).sum(), mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(), (bits[:64] * _BIT).sum(), (bits[64:] * _BIT).sum()
                tokens[i] = low[:COORDS]
        signed = num.view(np.int64)
        flat = pa.array(tokens.view(np.int32).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * COORDS, COORDS, dtype=np.int32)), flat)
        yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(size), *[pa.array(np.ascontiguousarray(signed[:, k])) for k in range(4)], lists], names=["doc_id", "n_shingles", "d1", "d2", "s0", "s1", "tokens"])


def _sets(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """rec, n (size of the set), level and found: the set, or the hashes below 2^64 / 2^level of one larger than `most`."""
    for batch in batches:
        found, sizes, levels = [], [], []
        for t in batch.column("text"):
            x = shingle_set(t.as_py())
            sizes.append(len(x))
            level = 0 if most is None or len(x) <= most else (len(x) - 1) // most
            level = int(level).bit_length()
            levels.append(level)
            found.append((x[x < (np.uint64(1) << np.uint64(64 - level))] if level else x).view(np.int64))
        ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
        flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))
        cols = [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int32()), pa.array(levels, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), flat)]
        yield pa.RecordBatch.from_arrays(cols, names=["rec", "n", "level", "found"])


SETS = "rec long, n int, level int, found array<long>"


def agreement(a0, a1, b0, b1):
    return F.lit(128) - F.bit_count(a0.bitwiseXOR(b0)) - F.bit_count(a1.bitwiseXOR(b1))


def _fits(n, m, alike: int):
    """Whether two sets of these sizes can reach the similarity at all."""
    return F.lit(100) * F.least(n, m) >= F.lit(alike) * F.greatest(n, m)


def _partners(batches: Iterator[pa.RecordBatch], alike: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node: node, rec and comp of those that agree by sketch with one of another component in the node."""
    held = None
    names = ["node", "rec", "comp", "s0", "s1", "n_shingles"]

    def compare(rows: np.ndarray) -> list[np.ndarray]:
        out = []
        edges = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0]))).tolist() + [len(rows)]
        for p, q in zip(edges, edges[1:], strict=False):
            if q - p < 2:
                continue
            g = rows[p:q]
            s = np.ascontiguousarray(g[:, 3:5]).view(np.uint64)
            same = 128 - np.bitwise_count(s[:, None, :] ^ s[None, :, :]).sum(axis=2, dtype=np.int32)
            n = g[:, 5]
            fits = 100 * np.minimum(n[:, None], n[None, :]) >= alike * np.maximum(n[:, None], n[None, :])
            ok = (same >= AGREE) & fits & (g[:, 2][:, None] != g[:, 2][None, :])
            if len(i := np.flatnonzero(ok.any(axis=1))):
                out.append(g[i, :3])
        return out

    def table(found: list[np.ndarray]) -> pa.RecordBatch:
        x = np.concatenate(found)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[:, k])) for k in range(3)], names=names[:3])

    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)
        if held is not None:
            rows = np.concatenate([held, rows])
        if not len(rows):
            continue
        last = np.searchsorted(np.cumsum(rows[::-1, 0] != rows[-1, 0]) > 0, True)
        held, rows = rows[len(rows) - last :], rows[: len(rows) - last]
        if len(rows) and (found := compare(rows)):
            yield table(found)
    if held is not None and (found := compare(held)):
        yield table(found)


def forest(recs: list[int], comps: list[int], sizes: list[int], levels: list[int], found: list[np.ndarray], alike: int) -> list[tuple[int, int, bool]]:
    """Links (a, b, sure) across the components of one node.

    Sure ones are exact and span what whole sets link; a pair with a sampled set is named, unsure,
    where the sample does not rule it out.
    """
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := top.get(x, x)) != x:
            top[x] = top.get(y, y)
            x = y
        return x

    out, size = [], np.array(sizes, np.int64)
    whole = np.flatnonzero(np.array(levels) == 0)
    if len(whole) > 1:
        sets = [found[i] for i in whole]
        values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count > 1
        column = (np.cumsum(shared) - 1)[place]
        row = np.repeat(np.arange(len(whole)), [len(x) for x in sets])
        row, column = row[shared[place]], column[shared[place]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((len(whole), len(whole)), np.float32)
        for c in range(0, int(shared.sum()), 4096):
            a, b = np.searchsorted(column, [c, c + 4096])
            x = np.zeros((len(whole), 4096), np.float32)
            x[row[a:b], column[a:b] - c] = 1
            common += x @ x.T
        n, own = size[whole], np.array(comps)[whole]
        ok = 100 * common.astype(np.int64) >= alike * (n[:, None] + n[None, :] - common.astype(np.int64))
        for i, j in np.argwhere(np.triu(ok & (own[:, None] != own[None, :]))).tolist():
            p, q = find(int(own[i])), find(int(own[j]))
            if p != q:
                top[p] = q
                out.append((*sorted((recs[whole[i]], recs[whole[j]])), True))
    for i in np.flatnonzero(np.array(levels) > 0).tolist():
        for j in range(len(recs)):
            if (levels[j] and j <= i) or find(comps[i]) == find(comps[j]) or 100 * min(sizes[i], sizes[j]) < alike * max(sizes[i], sizes[j]):
                continue
            cut_at = np.uint64(1) << np.uint64(64 - max(levels[i], levels[j]))
            x, y = (v.view(np.uint64)[v.view(np.uint64) < cut_at] for v in (found[i], found[j]))
            both = len(np.intersect1d(x, y, assume_unique=True))
            union = len(x) + len(y) - both
            s = alike / 100
            if both + 5 * np.sqrt(s * (1 - s) * union) + 1 >= s * union:
                out.append((*sorted((recs[i], recs[j])), False))
    return out


def _links(batches: Iterator[pa.RecordBatch], alike: int) -> Iterator[pa.RecordBatch]:
    """Rows with sets, sorted by node: the links of every node."""
    node, held = None, ([], [], [], [], [])

    def answer(found):
        cols = list(zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.bool_()), strict=True)], names=["a", "b", "sure"])

    for batch in batches:
        lists = batch.column("found")
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        told = []
        for k, (v, *row) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("node", "rec", "comp", "n", "level")], strict=True)):
            if v != node:
                if len(held[0]) > 1:
                    told += forest(*held, alike)
                node, held = v, ([], [], [], [], [])
            for c, x in zip(held, (*row, flat[ends[k] : ends[k + 1]]), strict=True):
                c.append(x)
        # what stays for the next batch must not hold on to this one
        held[4][:] = [x.copy() for x in held[4]]
        if told:
            yield answer(told)
    if len(held[0]) > 1 and (told := forest(*held, alike)):
        yield answer(told)


def shingle_sets(docs: DataFrame, ids: DataFrame, most: int | None = None) -> DataFrame:
    """SETS of the texts whose doc_id is in ids; both are written to the shared folder."""
    ids = cut(ids, "neardup-ids")
    sets = maybe_in(docs.select("doc_id", "text"), ids).join(ids, "doc_id", "left_semi").mapInArrow(partial(_sets, most=most), SETS)
    sets = cut(sets, "neardup-sets")
    drop_cut(ids)
    return sets


def confirm(pairs: DataFrame, docs: DataFrame, alike: int = 75) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= alike * union."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = shingle_sets(docs, ids)
    left, right = sets.select(F.col("rec").alias("a"), F.col("found").alias("x")), sets.select(F.col("rec").alias("b"), F.col("found").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    good = both.filter(F.lit(100) * common >= F.lit(alike) * (F.size("x") + F.size("y") - common))
    out = cut(good.select("a", "b").distinct(), "neardup-links")
    drop_cut(sets)
    return out


def near_duplicates(docs: DataFrame, alike: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs.

    Documents link at 100 * intersection >= alike * union of their 5-word shingle sets. A null or
    empty text, or one of white space, has no shingles, links with nothing and is kept. Rows that
    repeat a doc_id are one document and share its component. A row with a null doc_id takes no part:
    component_id null, kept true. An empty table gives an empty result; further columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut(docs.mapInArrow(_sign, SIGNED), "neardup-signed")
    known = signed.filter("doc_id is not null and n_shingles > 0")
    groups = known.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rec"), F.max("doc_id").alias("last"))
    recs = cut(known.join(groups.select(F.col("rec").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("rec"), "n_shingles", "s0", "s1", "tokens"), "neardup-records")

    # first-level nodes: tree, pick and token decide
    first = recs.select("rec", "n_shingles", "s0", "s1", F.posexplode(F.slice("tokens", 1, TREES * PICKS)).alias("pick", "token"))
    first = first.select(F.xxhash64("pick", "token").alias("node"), "rec", "n_shingles", "s0", "s1")
    least = first.groupBy("node").agg(F.min(F.struct("rec", "n_shingles", "s0", "s1")).alias("m"), F.count("*").alias("n")).filter("n > 1")
    # written, so that a node that many records share can be split in the join
    least = cut(least.select(F.col("node").alias("k"), F.col("m.rec").alias("p"), F.col("m.n_shingles").alias("pn"), F.col("m.s0").alias("p0"), F.col("m.s1").alias("p1")), "neardup-least")
    alike_by = agreement(F.col("s0"), F.col("s1"), F.col("p0"), F.col("p1"))
    star = first.join(least, first["node"] == least["k"]).filter((F.col("p") < F.col("rec")) & _fits(F.col("n_shingles"), F.col("pn"), alike)).withColumn("same", alike_by).filter(F.col("same") >= AGREE)
    star = cut(star.groupBy(F.col("rec").alias("b")).agg(F.max(F.struct("same", (-F.col("p")).alias("p"))).alias("m")).select((-F.col("m.p")).alias("a"), "b"), "neardup-star")
    links = confirm(star, docs, alike)
    # a doc_id that repeats with different texts joins their groups
    several = known.groupBy("doc_id").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi")).filter("lo <> hi").select("doc_id")
    same = known.join(several, "doc_id").join(groups, ["d1", "d2", "n_shingles"]).select(F.col("rec").alias("a"), F.col("doc_id").alias("b")).filter("a <> b").distinct()
    whole = _deeper(recs, links.union(same), docs, alike)
    copies = known.join(groups.filter("last > rec"), ["d1", "d2", "n_shingles"]).filter("doc_id <> rec").groupBy("doc_id").agg(F.min("rec").alias("rec"))
    out = signed.select("doc_id", "n_shingles").join(copies, "doc_id", "left").withColumn("rec", F.coalesce("rec", "doc_id"))
    out = out.join(whole, F.col("rec") == F.col("node"), "left").select("doc_id", "n_shingles", F.coalesce("component", "rec").alias("component_id"))
    out = out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    drop_cut(recs, least, star)
    return out


def keep_one(docs: DataFrame, alike: int = 75) -> DataFrame:
    """docs without the documents that near_duplicates() does not keep; all columns stay.

    Rows with a null doc_id, and null or empty texts, stay. Of the rows that repeat a kept doc_id with
    equal texts the one with the smallest hash of its other columns stays; different texts of one
    doc_id all stay. An empty table gives an empty result.
    """
    gone = cut(near_duplicates(docs, alike).filter("not kept").select("doc_id").distinct(), "neardup-gone")
    out = without(docs, gone)
    again = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if again.isEmpty():
        return out
    again = cut(again, "neardup-again")
    rest = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])
    one = out.join(again, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min_by(F.struct(*docs.columns), rest).alias("row")).select("row.*")
    return out.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(one)


def _deeper(recs: DataFrame, links: DataFrame, docs: DataFrame, alike: int) -> DataFrame:
    """node, component: labels of the records after all nodes are compared, those of the first level first."""
    labels = cut(components(links), "neardup-labels")

    def relabel(found: DataFrame) -> DataFrame:
        """Labels after further links, by the components of the labels that these join."""
        of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        j = found.join(of("a"), "a", "left").join(of("b"), "b", "left")
        joined = cut(components(j.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))), "neardup-joined")
        to = joined.select(F.col("node").alias("component"), F.col("component").alias("to"))
        moved = labels.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        return cut(moved.union(joined.join(labels.select("node"), "node", "left_anti").select("node", "component")), "neardup-labels")

    def tag(rows: DataFrame) -> DataFrame:
        """rows (node, rec) of nodes with more than one component: comp, n (records), k and top (size and label of the largest component)."""
        mine = labels.select(F.col("node").alias("rec"), F.col("component").alias("comp"))
        rows = rows.join(mine, "rec", "left").select("node", "rec", F.coalesce("comp", "rec").alias("comp"))
        stats = rows.groupBy("node", "comp").agg(F.count("*").alias("k")).groupBy("node").agg(F.sum("k").alias("n"), F.max(F.struct("k", "comp")).alias("top"), F.count("*").alias("comps")).filter("comps > 1")
        # written, so that a node that many records share can be split in the join
        stats = cut(stats.select("node", "n", F.col("top.k").alias("k"), F.col("top.comp").alias("top")), "neardup-stats")
        out = cut(rows.join(stats, "node"), "neardup-level")
        drop_cut(stats)
        return out

    def parts(level: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What can be compared (nodes of bounded size), and the rows of nodes that are too large."""
        rest = F.col("n") - F.col("k")
        chunks = F.ceil(F.col("k") / NODE).cast("int")
        mine = F.array(F.pmod(F.xxhash64("rec"), chunks).cast("int"))
        star = level.filter((F.col("n") > NODE) & (rest <= NODE)).withColumn("chunk", F.explode(F.when(F.col("comp") == F.col("top"), mine).otherwise(F.sequence(F.lit(0), chunks - 1))))
        ready = level.filter(F.col("n") <= NODE).select("node", "rec", "comp").union(star.select(F.xxhash64("node", "chunk").alias("node"), "rec", "comp"))
        return ready, level.filter((F.col("n") > NODE) & (rest > NODE))

    def children(large: DataFrame, depth: int) -> DataFrame:
        h = F.xxhash64("node", F.lit(depth))
        own = COORDS - TREES * PICKS
        c1 = F.pmod(h, F.lit(own))
        c2 = F.pmod(c1 + 1 + F.pmod(F.shiftright(h, 8), F.lit(own - 1)), F.lit(own))
        second = F.pmod(F.shiftright(h, 20), F.lit(3)) == 0
        x = large.join(recs.select("rec", "tokens"), "rec").select("node", "rec", c1.cast("int").alias("c1"), c2.cast("int").alias("c2"), second.alias("second"), "tokens")
        token = lambda c: F.element_at("tokens", F.lit(TREES * PICKS + 1) + F.col(c))
        one, two = F.xxhash64("node", "c1", token("c1")), F.xxhash64("node", "c2", token("c2"))
        return x.select(F.explode(F.when(F.col("second"), F.array(one, two)).otherwise(F.array(one))).alias("node"), "rec")

    def blocks(large: DataFrame) -> DataFrame:
        x = large.withColumn("blocks", F.ceil(F.col("n") / (NODE // 2)).cast("int"))
        x = x.withColumn("mine", F.pmod(F.xxhash64("rec"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return x.select(F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")).alias("node"), "rec", "comp")

    def compare(ready: DataFrame) -> DataFrame:
        rows = ready.join(recs.select("rec", "s0", "s1", "n_shingles"), "rec").select("node", "rec", "comp", "s0", "s1", "n_shingles")
        maybe = cut(rows.repartition("node").sortWithinPartitions("node").mapInArrow(partial(_partners, alike=alike), "node long, rec long, comp long"), "neardup-maybe")
        sets = shingle_sets(docs, maybe.select(F.col("rec").alias("doc_id")).distinct(), FULL)
        rows = maybe.join(sets, "rec").select("node", "rec", "comp", "n", "level", "found").repartition("node").sortWithinPartitions("node", "rec")
        told = cut(rows.mapInArrow(partial(_links, alike=alike), "a long, b long, sure boolean").distinct(), "neardup-told")
        sure, unsure = told.filter("sure").select("a", "b"), told.filter("not sure").select("a", "b")
        out = sure if unsure.isEmpty() else sure.union(confirm(unsure, docs, alike))
        drop_cut(maybe, sets)
        return out

    picks = F.transform(F.slice("tokens", 1, TREES * PICKS), lambda t, i: F.xxhash64(i, t))
    ready, large = parts(tag(recs.select(F.explode(picks).alias("node"), "rec")))
    labels = relabel(compare(ready))
    waiting = []
    for depth in range(1, DEPTH + 1):
        if large.isEmpty():
            break
        if depth == DEPTH:
            waiting.append(blocks(large))
            break
        below = cut(children(large, depth), "neardup-children")
        ready, large = parts(tag(below))
        drop_cut(below)
        waiting.append(ready)
    return relabel(compare(reduce(DataFrame.union, waiting))) if waiting else labels
