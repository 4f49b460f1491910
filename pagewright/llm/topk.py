"""Exact top-k by inner product over a pivot-distance index.

A vector v gets one more component sqrt(M - |v|^2), M the largest squared length; a query gets 0
there. Squared distances are then |q|^2 + M - 2 (q . v): the nearest are those of the highest
product, and the distance obeys the triangle inequality. Every vector is keyed by its nearest
pivot and its distance to it; the vectors of a pivot, sorted by that distance, are cut into rings
(blocks) of about BLOCK rows. A query first looks at the block its own vector lies in, which gives
a bound on its k-th distance r. A ring [lo, hi] of pivot p can then only matter if
lo - r <= d(q, p) <= hi + r; all other rings are passed over, so results are exact.

Pivots are the PIVOTS vectors of the smallest hashes. Ring borders are quantiles; a value that many
vectors share has several rings and the vectors are spread over them by hash.

Rings travel in groups of neighbours, about HELD vectors each, and queries in chunks of at most CHUNK: a
vector is sent once for each chunk and a query once for each group that holds a ring it needs. Inside a
group its rings are looked at one by one, and every ring may raise the bound for the next. Only the
rings' borders (one row for about BLOCK vectors) and the pivots come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import cut, drop_cut

PIVOTS, BLOCK, STEPS = 64, 1024, 128
#: Vectors of a group of rings and queries of a chunk, at most, at 64 components; SLICE queries are multiplied with a ring at once.
HELD, CHUNK, SLICE = 1 << 16, 1 << 16, 2048
#: Products are whole numbers, exact in doubles below this, and in floats below the other.
EXACT, SHORT = 1 << 53, 1 << 24


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled up with 0."""
    out = np.zeros((len(lists), dim))
    lens = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(lens)), lens), np.concatenate([np.arange(n) for n in lens]) if len(lens) else []] = flat
    return out


def slack(squared: np.ndarray, longest: float, dim: int) -> np.ndarray:
    """How far a computed distance may be off: the root of the rounding error of the squares it is the difference of."""
    return np.sqrt(16 * (dim + 4) * np.finfo(float).eps * (squared + longest))


def _spread(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) >> np.uint64(8)


class Index:
    """Pivots (with their further component) and, once known, the ring borders of every pivot."""

    def __init__(self, pivots: np.ndarray, dim: int, longest: float):
        self.dim, self.longest = dim, longest
        self.pivots = np.concatenate([pivots, np.sqrt(np.maximum(0, longest - (pivots**2).sum(1)))[:, None]], axis=1)
        self.rings: list[np.ndarray] = []

    def distances(self, v: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(v)) if query else np.sqrt(np.maximum(0, self.longest - (v**2).sum(1)))
        full = np.concatenate([v, more[:, None]], axis=1)
        d = (full**2).sum(1)[:, None] + (self.pivots**2).sum(1)[None, :] - 2 * full @ self.pivots.T
        return np.sqrt(np.maximum(0, d))

    def radius(self, squared: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The distance that products of at least `least` lie within, for queries of these squared lengths."""
        r = np.sqrt(np.maximum(0, squared + self.longest - 2 * np.maximum(least, -1e300)))
        # the radius, the query's distance and the ring's borders may each be off
        return np.where(np.isneginf(least), np.inf, r + 3 * slack(squared, self.longest, self.dim))

    def block(self, cell: np.ndarray, dist: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.empty(len(cell), np.int64)
        for c in np.unique(cell):
            own = np.flatnonzero(cell == c)
            edges = self.rings[c]
            lo, hi = np.searchsorted(edges, dist[own], "left"), np.searchsorted(edges, dist[own], "right")
            out[own] = c * 1_000_000 + lo + (_spread(ids[own]) % (hi - lo + 1).astype(np.uint64)).astype(np.int64)
        return out


class Best:
    """The k highest products so far of some queries, ties to smaller ids."""

    def __init__(self, q: np.ndarray, own: np.ndarray, k: int, least: np.ndarray):
        self.q, self.own, self.k, self.least = q, own, k, least.copy()
        self.scores, self.ids = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)

    def see(self, near: np.ndarray, ids: np.ndarray, v: np.ndarray) -> None:
        """Compares the queries `near` with vectors sorted by id."""
        first, last = np.searchsorted(ids, self.own[near], "left"), np.searchsorted(ids, self.own[near], "right")
        for at in range(0, len(near), SLICE):
            asked = near[at : at + SLICE]
            s = self.q[asked] @ v.T
            for i in np.flatnonzero(first[at : at + SLICE] < last[at : at + SLICE]):
                s[i, first[at + i] : last[at + i]] = -np.inf
            i, j = np.nonzero(s >= np.maximum(self.least[asked], np.finfo(np.float32).min)[:, None].astype(s.dtype))
            if len(i) > 32 * len(asked):
                # stable, so that of equal scores the smaller ids are kept
                j = np.argsort(-s, axis=1, kind="stable")[:, : self.k].ravel()
                i = np.repeat(np.arange(len(asked)), len(j) // len(asked))
                ok = s[i, j] >= np.maximum(self.least[asked], np.finfo(np.float32).min)[i]
                i, j = i[ok], j[ok]
            if len(i):
                self._merge(asked[i], ids[j], s[i, j].astype(float))

    def _merge(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        u = np.unique(at)
        q, x, s = np.concatenate([np.repeat(u, self.k), at]), np.concatenate([self.ids[u].ravel(), ids]), np.concatenate([self.scores[u].ravel(), scores])
        order = np.lexsort((x, -s, q))
        q = q[order]
        kept = order[np.arange(len(q)) - np.searchsorted(q, q) < self.k]
        self.ids[u], self.scores[u] = x[kept].reshape(-1, self.k), s[kept].reshape(-1, self.k)
        self.least[u] = np.maximum(self.least[u], self.scores[u, -1])


def quantize(embeddings: DataFrame) -> DataFrame:
    """vec_id and v = floor(256 x) of every vector without null or non-finite components."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    whole = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).filter("vec_id is not null and x is not null")
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return whole.filter(F.coalesce(fine, F.lit(False))).select("vec_id", F.transform("x", lambda e: F.floor(e * 256).cast("long")).alias("v"))


def search(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id and score: the k highest integer products of every query (vec_id divisible by `every`).

    Ties go to the smaller vec_id. A query's own vec_id is no candidate. Null vectors, vectors with
    null or non-finite components and rows with a null vec_id take no part. A shorter vector counts as
    filled up with zeros. Rows that repeat a vec_id are candidates each, and so may come several times
    in one result; as queries equal ones give it once, and different vectors of one vec_id the k best
    of all their products. Squared lengths from 2^53 on, where doubles are not exact, are an error. An
    empty table, or one without queries, gives an empty result.
    """
    rows = cut(quantize(embeddings), "topk-vectors")
    known = rows.agg(
        F.max(F.size("v")).alias("dim"), F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, e: a + e * e)).alias("longest"),
        F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high"), F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("queries"),
    ).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not known["n"] or not known["queries"]:
        return embeddings.sparkSession.createDataFrame([], schema)
    if known["longest"] >= EXACT:
        raise ValueError(f"a squared length of {known['longest']} is beyond exact doubles")
    dim = max(1, known["dim"])
    far = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    pivots = np.zeros((len(far), dim))
    for i, r in enumerate(far):
        pivots[i, : len(r["v"])] = r["v"]
    index = Index(np.unique(pivots, axis=0), dim, float(known["longest"]))

    # vectors travel as the bytes of the narrowest whole numbers
    kind = next(t for t in (np.int8, np.int16, np.int32) if np.iinfo(t).min <= (known["low"] or 0) and (known["high"] or 0) <= np.iinfo(t).max)
    real = np.float32 if known["longest"] < SHORT else np.float64

    def pack(v: np.ndarray) -> pa.Array:
        ends = pa.array(np.arange(0, (len(v) + 1) * dim * kind().itemsize, dim * kind().itemsize, dtype=np.int32))
        return pa.Array.from_buffers(pa.binary(), len(v), [None, ends.buffers()[1], pa.py_buffer(v.astype(kind).tobytes())])

    def unpack(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(float)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column("v"), dim)
            d = index.distances(v)
            cell = d.argmin(1) if len(d) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pack(v), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], names=["vec_id", "v", "cell", "dist"])

    keyed = cut(rows.mapInArrow(key, "vec_id long, v binary, cell int, dist double"), "topk-keyed")
    borders = keyed.groupBy("cell").agg(F.count("*").alias("n"), F.percentile_approx("dist", [i / STEPS for i in range(1, STEPS)], 2000).alias("q")).collect()
    index.rings = [np.zeros(0)] * len(index.pivots)
    for r in borders:  # one row for each pivot
        parts = min(STEPS, math.ceil(r["n"] / BLOCK))
        index.rings[r["cell"]] = np.array([r["q"][round(i * STEPS / parts) - 1] for i in range(1, parts)])
    salts = max(1, math.ceil(max(r["n"] for r in borders) / STEPS / BLOCK))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("vec_id").to_numpy()
            at = index.block(b.column("cell").to_numpy(), b.column("dist").to_numpy(), ids)
            at = at * salts + ((_spread(ids) >> np.uint64(20)) % np.uint64(salts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=["vec_id", "v", "cell", "dist", "block"])

    placed = cut(keyed.mapInArrow(place, "vec_id long, v binary, cell int, dist double, block long"), "topk-placed")
    drop_cut(rows, keyed)
    rings = placed.groupBy("cell", "block").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.count("*").alias("n")).toArrow().sort_by("block")
    cells, numbers, low, high, count = (rings.column(c).to_numpy() for c in ("cell", "block", "lo", "hi", "n"))
    narrow = max(1, dim // 64)
    # smaller groups where the table would else be one task
    held = min(HELD // narrow, max(4 * BLOCK, known["n"] // 24))
    group = (np.cumsum(count) - count) // held
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    chunks = math.ceil(known["queries"] * narrow / CHUNK)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ring = np.searchsorted(numbers, b.column("block").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(group[ring]), pa.array(ring.astype(np.int32)), b.column("vec_id"), b.column("v")], names=["group", "ring", "vec_id", "v"])

    sides = placed.select("vec_id", "v", "block").mapInArrow(grouped, "group long, ring int, vec_id long, v binary")

    def by_ring(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """ring, ids and vectors of every ring of a group, by id."""
        ring, ids = table.column("ring").to_numpy(), table.column("vec_id").to_numpy()
        order = np.lexsort((ids, ring))
        ring, ids, v = ring[order], ids[order], unpack(table.column("v")).astype(real)[order]
        edges = [*np.flatnonzero(np.concatenate(([True], ring[1:] != ring[:-1]))).tolist(), len(ring)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield ring[a], ids[a:b], v[a:b]

    def start(table: pa.Table) -> pa.Table:
        """The queries of a group, with the k-th highest product inside their own ring."""
        out = []
        for _, ids, v in by_ring(table):
            asked = np.flatnonzero(ids % every == 0)
            best = Best(v[asked], ids[asked], k, np.full(len(asked), -np.inf))
            best.see(np.arange(len(asked)), ids, v)
            out.append(pa.table([pa.array(ids[asked]), pack(v[asked]), pa.array(best.least)], names=["query_id", "q", "least"]))
        return pa.concat_tables(out)

    begun = cut(sides.groupBy("group").applyInArrow(start, "query_id long, q binary, least double").dropDuplicates(["query_id", "q"]), "topk-begun")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every query once for each group with a ring it needs."""
        step = max(1, (1 << 22) // len(numbers))
        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                q = unpack(part.column("q"))
                d, r = index.distances(q, query=True), index.radius((q**2).sum(1), part.column("least").to_numpy())[:, None]
                needed = (d[:, cells] - r <= high) & (d[:, cells] + r >= low)
                i, g = np.nonzero(np.logical_or.reduceat(needed, starts, axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(group[starts][g]), *part.take(pa.array(i)).columns], names=["group", "query_id", "q", "least"])

    wanted = begun.mapInArrow(reach, "group long, query_id long, q binary, least double").withColumn("chunk", F.pmod(F.xxhash64("query_id", "q"), F.lit(chunks)).cast("int"))
    # every chunk meets every group; queries come only to groups they need
    sent = sides.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def compare(asked: pa.Table, held: pa.Table) -> pa.Table:
        none = pa.array([], pa.int64())
        if not asked.num_rows or not held.num_rows:
            return pa.table([none, none, none], names=["query_id", "vec_id", "score"])
        q, own = unpack(asked.column("q")), asked.column("query_id").to_numpy()
        d, squared = index.distances(q, query=True), (q**2).sum(1)
        best = Best(q.astype(real), own, k, asked.column("least").to_numpy())
        for ring, ids, v in by_ring(held):
            r, to = index.radius(squared, best.least), d[:, cells[ring]]
            best.see(np.flatnonzero((to - r <= high[ring]) & (to + r >= low[ring])), ids, v)
        i, j = np.nonzero(best.scores > -np.inf)
        return pa.table([pa.array(own[i]), pa.array(best.ids[i, j]), pa.array(best.scores[i, j].astype(np.int64))], names=["query_id", "vec_id", "score"])

    found = wanted.groupBy("group", "chunk").cogroup(sent.groupBy("group", "chunk")).applyInArrow(compare, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
