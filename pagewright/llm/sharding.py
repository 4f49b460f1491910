"""Sharding by a hierarchical weighted hash tree.

Shards are leaves of a tree region / rack / shard. A document descends from the root: at every node
each child draws -ln(u) / weight with u hashed from (document id, child), and the smallest draw
wins, so that a child is taken in proportion to its weight and a change of one weight moves rows
only to or from that child's subtree. Weights are the numbers of shards below. A further shard
opens a region of its own once the present regions are full, so rows move into it alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import gapless_rank

RACKS, SHARDS = 3, 4


def tree(shards: int, racks: int = RACKS, per_rack: int = SHARDS) -> list[list[int]]:
    """Shards below each rack of each region; regions fill one after the other."""
    out, left = [], shards
    while left > 0:
        region = []
        for _ in range(racks):
            here = min(per_rack, left)
            if here:
                region.append(here)
            left -= here
        out.append(region)
    return out


def _draw(key: Column, node: str, weight: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node)), 11)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(2**53))) / F.lit(float(weight))


def _choose(key: Column, nodes: list[tuple[str, int, Column]]) -> Column:
    """The value of the node with the smallest draw; ties (never seen) go to the first."""
    if len(nodes) == 1:
        return nodes[0][2]
    draws = F.array(*[_draw(key, n, w) for n, w, _ in nodes])
    place = F.array_position(draws, F.array_min(draws)).cast("int")
    return F.element_at(F.array(*[v for *_, v in nodes]), place)


def levels(key: Column, shards: int, racks: int = RACKS, per_rack: int = SHARDS) -> tuple[Column, Column, Column]:
    """Region of a key, its rack (reads __region) and its leaf 0 .. shards-1 (reads both).

    A null key hashes like any other value and gets one leaf.
    """
    regions = tree(shards, racks, per_rack)
    region = _choose(key, [(f"g{g}", sum(r), F.lit(g)) for g, r in enumerate(regions)])
    rack_of = leaf_of = F.lit(None).cast("int")
    for g, region_racks in enumerate(regions):
        first = g * racks * per_rack
        rack = _choose(key, [(f"g{g}r{k}", n, F.lit(k)) for k, n in enumerate(region_racks)])
        for k, n in enumerate(region_racks):
            leaf = _choose(key, [(f"g{g}r{k}s{s}", 1, F.lit(first + k * per_rack + s)) for s in range(n)])
            leaf_of = F.when((F.col("__region") == g) & (F.col("__rack") == k), leaf).otherwise(leaf_of)
        rack_of = F.when(F.col("__region") == g, rack).otherwise(rack_of)
    return region, rack_of, leaf_of


def with_shard(df: DataFrame, key: str, shards: int, name: str) -> DataFrame:
    region, rack, leaf = levels(F.col(key), shards)
    return df.withColumn("__region", region).withColumn("__rack", rack).withColumn(name, leaf.cast("int")).drop("__region", "__rack")


def shard_documents(docs: DataFrame, shards: int = 24, buckets: int = 256) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of docs.

    Law `key`: doc_id and the number of shards decide. Size is the text's UTF-8 bytes plus 8; a null
    or empty text has 0 bytes and checksum 0. Rows with a null doc_id share one shard. Repeated rows
    land in one shard with a slot each. Slots run from 0 without gaps in every shard. An empty table
    gives an empty result; further columns of docs are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = with_shard(with_shard(rows, "doc_id", shards, "shard"), "doc_id", shards + 1, "grown_shard")
    ranked = gapless_rank(rows, ["shard"], ["doc_id", "size", "text_crc32"], F.xxhash64("doc_id", "size", "text_crc32"), buckets, "slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
