"""Mixing sources to target weights by entropy balancing.

Every document gets a rate; rates stay as close as possible (in relative entropy) to one copy each,
no rate exceeds `most`, and each source's words meet its target. The optimum is the exponentially
tilted rate min(most, exp(l * size / mean size)); the multiplier l of each source solves the dual
by Newton steps, held in a bracket. Rates depend on source and size alone, so the steps run over
the table of counts by source and size, which is aggregated before any shuffle. Rates are then
rounded into whole copies, and the words still missing or over are settled in the smallest sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import WORD, cut, gapless_rank, join_on

MOST = 3
STEPS = 18
#: Multipliers beyond this give rates that no longer differ from 0 or the limit.
REACH = 60.0


def targets(by_source: DataFrame, most: int = MOST) -> DataFrame:
    """source_size and target of each source.

    Weights 1, 2, 3 repeat over the sources in code point order, null last. All words are shared by
    weight; a source over `most` times its own size stops there and the excess is reshared: the
    sources stop in the order of most * size / weight, so one pass of running sums finds who stops.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    rows = by_source.withColumn("weight", (F.pmod(F.row_number().over(order) - 1, F.lit(3)) + 1).cast("double"))
    rows = rows.withColumn("bound", F.col("source_size") * most).withColumn("stop", F.col("bound") / F.col("weight"))
    tie = [F.col("stop"), F.col("source").isNull(), F.col("source")]
    before = Window.orderBy(*tie).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = rows.withColumn("gone", F.coalesce(F.sum("bound").over(before), F.lit(0))).withColumn("gone_w", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("total", F.sum("source_size").over(whole)).withColumn("total_w", F.sum("weight").over(whole))
    level = (F.col("total") - F.col("gone")) / (F.col("total_w") - F.col("gone_w"))
    rows = rows.withColumn("level", F.when(F.col("stop") > level, level)).withColumn("level", F.max("level").over(whole))
    target = F.when(F.col("level").isNull(), F.col("bound").cast("double")).otherwise(F.least(F.col("bound").cast("double"), F.col("weight") * F.col("level")))
    return rows.select("source", "source_size", target.alias("target"))


def _rate(lam, size, mean, most):
    return F.least(F.lit(float(most)), F.exp(F.least(lam * size / mean, F.lit(50.0))))


def multipliers(hist: DataFrame, goals: DataFrame, most: int = MOST, steps: int = STEPS) -> DataFrame:
    """hist (source, size, n) with each row's rate. Every Newton step is one aggregation over hist."""
    rows = join_on(hist, goals, ["source"]).select("source", "size", "n", "source_size", "target")
    w = Window.partitionBy("source")
    rows = rows.withColumn("mean", F.sum(F.col("n") * F.col("size")).over(w) / F.sum("n").over(w))
    rows = cut(rows.filter("size > 0"), "mixing-sizes")
    lam = rows.groupBy("source").agg(F.lit(0.0).alias("lam"), F.lit(-REACH).alias("lo"), F.lit(REACH).alias("hi"))
    for step in range(steps):
        j = join_on(rows, lam, ["source"])
        rate = _rate(F.col("lam"), F.col("size"), F.col("mean"), most)
        words = F.col("n") * F.col("size")
        sums = j.groupBy("source").agg(
            F.first("lam").alias("lam"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("target").alias("target"),
            F.sum(words * rate).alias("got"), F.sum(F.when(rate < most, words * rate * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
        )
        under = F.col("got") < F.col("target")
        lo = F.when(under, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(under, F.col("hi")).otherwise(F.col("lam"))
        newton = F.col("lam") + F.try_divide(F.col("target") - F.col("got"), F.col("slope"))
        middle = (lo + hi) / 2
        lam = sums.select("source", F.when((newton >= lo) & (newton <= hi), newton).otherwise(middle).alias("lam"), lo.alias("lo"), hi.alias("hi"))
        if step % 6 == 5:
            lam = cut(lam, "mixing-step")
    out = join_on(rows, lam, ["source"]).select("source", "size", "n", "source_size", "target", F.round(_rate(F.col("lam"), F.col("size"), F.col("mean"), most), 12).alias("rate"))
    out = out.withColumn("rate", F.when(F.col("target") >= most * F.col("source_size"), F.lit(float(most))).otherwise(F.col("rate")))
    return out


def copies(rates: DataFrame, most: int = MOST) -> DataFrame:
    """Whole copies for each (source, size): every document gets `base`, the first `extra` of them one more.

    The wanted number is rounded up or down by a hash of source and size, so roundings don't add up;
    what is missing or over at the end goes to the smallest sizes that have room.
    """
    dither = F.pmod(F.xxhash64("source", "size"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = rates.withColumn("made", F.least(F.col("n") * most, F.floor(F.col("n") * F.col("rate") + dither).cast("long")))
    whole = Window.partitionBy("source")
    rows = rows.withColumn("miss", F.round(F.col("target") - F.sum(F.col("made") * F.col("size")).over(whole)).cast("long"))
    room = F.when(F.col("miss") >= 0, F.col("n") * most - F.col("made")).otherwise(F.col("made"))
    up = Window.partitionBy("source").orderBy(F.desc("fits"), "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("room", room).withColumn("fits", F.col("size") <= F.abs("miss"))
    rows = rows.withColumn("used", F.coalesce(F.sum(F.col("room") * F.col("size")).over(up), F.lit(0)))
    fix = F.least(F.col("room"), F.greatest(F.lit(0), F.floor((F.abs("miss") - F.col("used")) / F.col("size")).cast("long")))
    rows = rows.withColumn("made", F.when(F.col("miss") >= 0, F.col("made") + fix).otherwise(F.col("made") - fix))
    for _ in range(2):
        # one copy of the size closest to what is left
        miss = F.round(F.col("target") - F.sum(F.col("made") * F.col("size")).over(whole)).cast("long")
        rows = rows.withColumn("miss", miss)
        room = F.when(F.col("miss") >= 0, F.col("n") * most - F.col("made")).otherwise(F.col("made"))
        off = F.abs(F.abs("miss") - F.col("size"))
        rows = rows.withColumn("near", F.min(F.when((room > 0) & (off < F.abs("miss")), F.struct(off.alias("o"), "size"))).over(whole))
        rows = rows.withColumn("made", F.when(F.col("near.size") == F.col("size"), F.col("made") + F.signum("miss").cast("long")).otherwise(F.col("made")))
    return rows.select("source", "size", "source_size", "target", F.floor(F.col("made") / F.col("n")).cast("long").alias("base"), F.pmod("made", "n").alias("extra"), "rate")


def mix(docs: DataFrame, most: int = MOST, buckets: int = 64) -> DataFrame:
    """Each document's size, source_size, target, rate, copies and taken.

    Size: words of the text; a null or empty text has 0 words and is kept once (its copies weigh
    nothing). Null sources form one source, ranked last. Which documents of one source and size get
    the extra copy is decided by a hash of doc_id, so reruns agree; repeated rows are documents of
    their own. An empty table gives an empty result; further columns are ignored.
    """
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size")), "mixing-docs")
    hist = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mixing-hist")
    goals = cut(targets(hist.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), most), "mixing-goals")
    plan = cut(copies(multipliers(hist, goals, most), most), "mixing-plan")
    ranked = gapless_rank(rows.withColumn("h", F.xxhash64("doc_id")), ["source", "size"], ["h", "doc_id"], F.col("h"), buckets, "place")
    j = join_on(ranked, plan.select("source", "size", "base", "extra", "rate"), ["source", "size"], "left")
    j = j.select("doc_id", "source", "size", "rate", (F.col("base") + (F.col("place") < F.col("extra")).cast("long")).alias("copies"))
    j = j.withColumn("copies", F.coalesce("copies", F.lit(1)))
    out = join_on(j, F.broadcast(goals) if goals.count() <= 10_000 else goals, ["source"], "left")
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies", "rate")


def apply_mix(docs: DataFrame, most: int = MOST, buckets: int = 64) -> DataFrame:
    """docs with every row repeated (or left out) as mix() says; all columns stay.

    Rows that agree in doc_id, source and size (null equal to null) share their copies: each gets the
    same number, and those of the smallest text hashes one more where it does not divide. Texts without
    words are kept once. An empty table gives an empty result.
    """
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    keys = ["__id", "source", "__size"]
    times = mix(docs, most, buckets).groupBy(F.col("doc_id").alias("__id"), "source", F.col("size").alias("__size")).agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    times = cut(times, "mixing-times")
    rows = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__size": size, "__n": F.monotonically_increasing_id()})
    rows = join_on(rows, times, keys)
    one = rows.filter("__rows = 1").select(*docs.columns, F.col("__copies").cast("int").alias("__copies"))
    if not times.filter("__rows > 1").isEmpty():
        h = F.xxhash64("text")
        shared = gapless_rank(rows.filter("__rows > 1").withColumn("__h", h), keys, ["__h"], F.xxhash64("__n"), buckets, "__place")
        own = F.floor(F.col("__copies") / F.col("__rows")) + (F.col("__place") < F.col("__copies") % F.col("__rows")).cast("int")
        one = one.union(shared.select(*docs.columns, own.cast("int")))
    return one.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies")))).select(docs.columns)
