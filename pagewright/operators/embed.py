"""Hand-off of texts to an embedding provider and what comes back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8192


def cosine(a, b):
    """Cosine similarity of two arrays of numbers of one length, as double."""
    x, y = F.transform(a, lambda e: e.cast("double")), F.transform(b, lambda e: e.cast("double"))
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda u, v: u * v), F.lit(0.0), lambda s, e: s + e)
    return F.try_divide(dot(x, y), F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))


def batches(rows: DataFrame, keys: list[str], order: str, item: str, size: int) -> DataFrame:
    """Fixed-size batches inside each key: keys, batch, items in order. A batch has at most `size` rows."""
    w = Window.partitionBy(*keys).orderBy(order)
    b = rows.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("int"))
    return b.groupBy(*keys, "batch").agg(F.array_sort(F.collect_list(F.struct(order, item))).alias("x")).select(*keys, "batch", F.transform("x", lambda e: e[item]).alias("items"))


def _best_of_block(x: np.ndarray, xi: np.ndarray, y: np.ndarray, yi: np.ndarray):
    """(row of x, row of y, similarity) of the pairs that may be the best of a row, with the similarity of cosine() to the bit.

    Products of matrices find what is within 2e-9 of the best, more than rounding to 9 digits and the order of sums can move;
    of equal similarities the smallest heading stays, so copies don't multiply. NaN is above all, as it is in max().
    """

    def dots(a, b):
        s = np.zeros(len(a))
        for k in range(a.shape[1]):
            s = s + a[:, k] * b[:, k]
        return s

    nx, ny = np.sqrt(dots(x, x)), np.sqrt(dots(y, y))
    step = max(1, 4_000_000 // max(len(y), 1))
    for at in range(0, len(x), step):
        with np.errstate(all="ignore"):
            below = nx[at : at + step, None] * ny[None, :]
            s = x[at : at + step] @ y.T
            s /= below
        s[np.isnan(s)] = np.inf
        s[(below == 0) | (xi[at : at + step, None] == yi[None, :])] = -np.inf
        top = s.max(axis=1)
        near = (s >= np.where(np.isfinite(top), top - 2e-9, top)[:, None]) & (top > -np.inf)[:, None]
        i, j = np.nonzero(near)
        if not len(i):
            continue
        i += at
        for lo in range(0, len(i), 100_000):
            a, b = i[lo : lo + 100_000], j[lo : lo + 100_000]
            with np.errstate(all="ignore"):
                exact = dots(x[a], y[b]) / (nx[a] * ny[b])
            order = np.lexsort((yi[b], exact, a))
            a, b, exact = a[order], b[order], exact[order]
            same = (a[1:] == a[:-1]) & ((exact[1:] == exact[:-1]) | (np.isnan(exact[1:]) & np.isnan(exact[:-1])))
            keep = np.concatenate([[True], ~same])
            yield a[keep], b[keep], exact[keep]


def nearest_heading(entries: DataFrame, headings: DataFrame) -> DataFrame:
    """For every entry the heading of its group with the highest cosine; ties to the smaller heading_id.

    All pairs of a group are compared, as blocks of BLOCK entries and BLOCK headings: a task holds two blocks, whatever the
    group's size. A pair without a cosine (a null, other lengths, no length) counts only where an entry has no other.
    """
    doubles = lambda v: F.transform(v, lambda e: e.cast("double"))
    size = lambda v: F.when(F.forall(v, lambda e: e.isNotNull()), F.array_size(v))
    e = entries.filter("grp is not null and entry_id is not null").select("grp", "entry_id", size(F.col("e")).alias("n"), doubles(F.col("e")).alias("v"))
    h = headings.filter("grp is not null and heading_id is not null").select("grp", "heading_id", size(F.col("h")).alias("n"), doubles(F.col("h")).alias("v"))

    def blocks(side, key):
        return side.filter("n > 0").groupBy("grp", "n").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(key))

    counts = blocks(e, "ne").join(blocks(h, "nh"), ["grp", "n"])

    def spread(side, id, own, other, mark):
        own_block = F.pmod(F.xxhash64(id), F.col(own)).cast("int")
        return side.filter("n > 0").join(counts, ["grp", "n"]).select("grp", "n", F.col(id).alias("id"), F.lit(mark).alias("heading"), "v", own_block.alias("b"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("o"))

    es = spread(e, "entry_id", "ne", "nh", False).withColumnsRenamed({"b": "eb", "o": "hb"})
    hs = spread(h, "heading_id", "nh", "ne", True).withColumnsRenamed({"b": "hb", "o": "eb"})
    kind, other = e.schema["entry_id"].dataType.simpleString(), h.schema["heading_id"].dataType.simpleString()
    pairs = es.unionByName(hs).select("grp", "n", "eb", "hb", "heading", F.col("id").cast("long").alias("id"), "v")

    def run(t: pa.Table) -> pa.Table:
        mark = t.column("heading").to_numpy()
        ids = t.column("id").combine_chunks().to_numpy(zero_copy_only=False)
        flat = t.column("v").combine_chunks()
        v = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        x, xi, y, yi = v[~mark], ids[~mark], v[mark], ids[mark]
        out = [(xi[a], yi[b], s) for a, b, s in _best_of_block(x, xi, y, yi)] if len(x) and len(y) else []
        of = t.schema.field("id").type
        cols = [np.concatenate([o[k] for o in out]) if out else [] for k in range(3)]
        return pa.table([pa.array(cols[0], of), pa.array(cols[1], of), pa.array(cols[2], pa.float64())], names=["entry_id", "heading_id", "similarity"])

    near = pairs.groupBy("grp", "n", "eb", "hb").applyInArrow(run, "entry_id long, heading_id long, similarity double")
    near = near.select(F.col("entry_id").cast(kind).alias("entry_id"), F.col("heading_id").cast(other).alias("heading_id"), "similarity")
    # stands in where no pair of an entry has a cosine: the smallest heading that isn't the entry itself
    least = h.groupBy("grp").agg(F.array_sort(F.collect_set("heading_id")).alias("least")) if False else h.groupBy("grp").agg(F.min("heading_id").alias("h1"))
    second = h.join(least, "grp").filter("heading_id > h1").groupBy("grp").agg(F.min("heading_id").alias("h2"))
    none = e.select("grp", "entry_id").join(least.join(second, "grp", "left"), "grp").withColumn("heading_id", F.when(F.col("entry_id") != F.col("h1"), F.col("h1")).otherwise(F.col("h2"))).filter("heading_id is not null")
    j = near.unionByName(none.select("entry_id", "heading_id", F.lit(None).cast("double").alias("similarity")))
    best = j.groupBy("entry_id").agg(F.max(F.struct(F.round("similarity", 9).alias("s"), (-F.col("heading_id")).alias("back"), "similarity")).alias("m"))
    return best.select("entry_id", (-F.col("m.back")).alias("heading_id"), F.round("m.similarity", 5).alias("similarity"))
