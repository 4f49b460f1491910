"""Benchmark decontamination by fingerprints of item-sized windows.

An item of L words has n = L - 4 shingles of five words (a shorter item is one shingle). A document
is contaminated by it if some window of n successive shingles has a weighted similarity (sum of the
smaller counts over sum of the larger counts of each shingle) of 0.75 or more. What is done:

1. Windows. A window that reaches the similarity shares at least 3 (n + m) / 7 of its m shingles with
   items of that size, so only windows around that many shared shingles are formed; the rest cannot
   qualify. A document shorter than the item is one window.
2. Fingerprints. Windows and items get 64-bit SimHashes, every shingle voting with its count.
3. Multi-index Hamming blocks. Fingerprints split into BLOCKS blocks; two fingerprints within RADIUS
   differ by at most RADIUS // BLOCKS bits in one block. Items are listed under all block values that
   close, so an equality join finds every pair within RADIUS of one size.
4. The exact weighted similarity of each such pair decides.

At similarity 0.75 the expected distance is 11 bits with a deviation of 3, so RADIUS 20 keeps 99.8 %.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import cut, let, maybe_in, without, words

WIDTH, RADIUS, BLOCKS = 5, 20, 7
#: Block sizes in bits, 64 together.
SIZES = [10, 9, 9, 9, 9, 9, 9]
#: The table of benchmark shingles is broadcast up to this many rows (16 bytes each) and joined by shuffle beyond.
MOST_BROADCAST = 1_000_000


def shingles(hashed: Column, width: int) -> Column:
    """Hashes of all runs of `width` words, in order and with repeats; empty for shorter texts."""

    def runs(w: Column) -> Column:
        n = F.size(w) - width + 1
        found = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, F.lit(width))))
        return F.when(n > 0, found).otherwise(F.expr("cast(array() as array<bigint>)"))

    return let(hashed, runs)


def hashed_words(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def simhash(found: Column) -> Column:
    """64 majority votes over the bits of the hashes; a tie gives 0."""

    def bit(b: Column) -> Column:
        ones = F.aggregate(found, F.lit(0), lambda a, h: a + F.getbit(h, b).cast("int"))
        return F.when(2 * ones > F.size(found), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(bit(b)))


def block(fingerprint: Column, k: int) -> Column:
    low = sum(SIZES[:k])
    return F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << SIZES[k]) - 1).cast("long"))


def _near(k: int) -> list[int]:
    """All differences of at most RADIUS // BLOCKS bits in block k."""
    out = {0}
    for _ in range(RADIUS // BLOCKS):
        out |= {x ^ (1 << b) for x in out for b in range(SIZES[k])}
    return sorted(out)


def _listed(k: int) -> Column:
    """Entries of an item's fingerprint in the index of block k."""
    near = F.array(*[F.lit(x).cast("long") for x in _near(k)])
    return F.transform(near, lambda x: F.struct(F.lit(k).alias("k"), block(F.col("print"), k).bitwiseXOR(x).alias("v")))


def similarity_sums(x: Column, y: Column) -> tuple[Column, Column]:
    """Sum of the smaller and of the larger counts over the shingles of x and y."""
    count = lambda a, h: F.size(F.filter(a, lambda v: v == h))
    low = F.aggregate(F.array_distinct(x), F.lit(0), lambda a, h: a + F.least(count(x, h), count(y, h)))
    return low, F.size(x) + F.size(y) - low


def _windows(docs: DataFrame, hashed: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """doc_id, n, found (the window's shingles) and at (its first word)."""
    sized = items.select(F.explode("found").alias("h"), F.size("found").alias("n")).distinct()
    rows = hashed.select("doc_id", shingles(F.col("hashed"), width).alias("found")).select("doc_id", F.size("found").alias("all"), F.posexplode("found").alias("pos", "h"))
    sized = F.broadcast(sized) if sized.count() <= MOST_BROADCAST else sized
    hits = rows.join(sized, "h").groupBy("doc_id", "all", "n").agg(F.sort_array(F.collect_list("pos")).alias("p"))
    hits = hits.withColumn("m", F.least("n", "all")).withColumn("need", F.ceil(3 * (F.col("n") + F.col("m")) / 7).cast("int"))
    hits = hits.filter(F.size("p") >= F.col("need"))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("p") - F.col("need")),
        lambda i: F.struct(F.greatest(F.lit(0), F.get("p", i + F.col("need") - 1) - F.col("m") + 1).alias("lo"), F.least(F.get("p", i), F.col("all") - F.col("m")).alias("hi")),
    )
    runs = F.filter(runs, lambda r: r["lo"] <= r["hi"])
    starts = F.array_distinct(F.flatten(F.transform(runs, lambda r: F.sequence(r["lo"], r["hi"]))))
    hits = cut(hits.select("doc_id", "all", "n", "m", starts.alias("starts")).filter(F.size("starts") > 0), "decontam-windows")
    # a repeated doc_id brings its other rows along; windows are taken where the length agrees
    again = hits.groupBy("doc_id").agg(F.collect_list(F.struct("all", "n", "m", "starts")).alias("w"))
    # only texts with windows are shuffled, and the few that the table of ids lets pass besides
    text = maybe_in(docs, again.select("doc_id")).join(again, "doc_id").select("doc_id", "w", shingles(hashed_words(F.col("text")), width).alias("found"))
    text = text.select("doc_id", "found", F.explode("w").alias("w")).filter(F.size("found") == F.col("w.all"))
    return text.select("doc_id", F.col("w.n").alias("n"), F.col("w.m").alias("m"), "found", F.explode("w.starts").alias("at")).select("doc_id", "n", "at", F.slice("found", F.col("at") + 1, F.col("m")).alias("found"))


def contaminated(docs: DataFrame, benchmark: DataFrame, alike: int = 75) -> DataFrame:
    """doc_id, item_id, similarity, first_word and n_words: the best (then earliest) window of every contaminated pair.

    Null, empty or blank texts and items match nothing; an item of fewer than five words matches where
    its words stand in a row. Rows with a null doc_id or item_id take no part. If a doc_id repeats, its
    best window counts. An empty table gives an empty result; further columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), hashed_words(F.col("text")).alias("hashed")).filter((F.size("hashed") > 0) & F.col("item_id").isNotNull())
    rows = cut(rows.withColumn("width", F.least(F.lit(WIDTH), F.size("hashed"))), "decontam-items")
    widths = sorted(r[0] for r in rows.select("width").distinct().collect()) or [WIDTH]  # at most five values
    hashed = docs.select("doc_id", hashed_words(F.col("text")).alias("hashed"))
    found = []
    for width in widths:
        items = rows.filter(F.col("width") == width).select("item_id", shingles(F.col("hashed"), width).alias("found"))
        items = items.withColumn("n", F.size("found")).withColumn("print", simhash(F.col("found")))
        windows = _windows(docs, hashed, items, width).withColumn("print", simhash(F.col("found")))
        listed = F.flatten(F.array(*[_listed(k) for k in range(BLOCKS)]))
        index = items.select("item_id", "n", "print", "found", F.explode(listed).alias("b")).select("item_id", "n", F.col("print").alias("print_i"), F.col("found").alias("found_i"), "b.k", "b.v")
        own = F.array(*[F.struct(F.lit(k).alias("k"), block(F.col("print"), k).alias("v")) for k in range(BLOCKS)])
        probes = windows.select("doc_id", "n", "at", "print", "found", F.explode(own).alias("b")).select("doc_id", "n", "at", "print", "found", "b.k", "b.v")
        pairs = probes.join(index, ["n", "k", "v"]).filter(F.bit_count(F.col("print").bitwiseXOR(F.col("print_i"))) <= RADIUS)
        # the first block that agrees speaks for the pair
        first = reduce(lambda out, k: F.when(F.bit_count(block(F.col("print").bitwiseXOR(F.col("print_i")), k)) <= RADIUS // BLOCKS, k).otherwise(out), reversed(range(BLOCKS)), F.lit(None))
        pairs = pairs.filter(F.col("k") == first)
        low, high = similarity_sums(F.col("found_i"), F.col("found"))
        pairs = pairs.select("doc_id", "item_id", "at", (F.col("n") + width - 1).alias("n_words"), low.alias("low"), high.alias("high")).filter(F.lit(100) * F.col("low") >= F.lit(alike) * F.col("high"))
        found.append(pairs)
    pairs = reduce(DataFrame.union, found).withColumn("similarity", F.round(F.col("low") / F.col("high"), 6))
    best = pairs.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("at")).alias("back"), "n_words")).alias("x"))
    return best.select("doc_id", "item_id", F.col("x.similarity").alias("similarity"), (-F.col("x.back")).cast("long").alias("first_word"), F.col("x.n_words").cast("long").alias("n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold a benchmark passage; all columns stay.

    Rows with a null doc_id, and null or empty texts, stay. Rows that repeat a contaminated doc_id all
    go. An empty table of either kind gives docs unchanged.
    """
    ids = cut(contaminated(docs, benchmark).select("doc_id").distinct(), "decontam-ids")
    return without(docs, ids)
