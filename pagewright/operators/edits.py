"""Edits of line ranges under optimistic concurrency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def line_range(text: Column, start: Column, end: Column) -> Column:
    """Lines start .. end (from 1, inclusive), both held inside the text; null if none is left."""
    lines = F.split(text, "\n", -1)
    a = F.greatest(start, F.lit(1))
    b = F.least(end, F.size(lines))
    return F.when(a <= b, F.array_join(F.slice(lines, a, b - a + 1), "\n"))


def validate_ranges(ranges: DataFrame, files: DataFrame) -> DataFrame:
    """doc_id, valid: ranges start at 1 or later, end in the file and in order, and don't overlap."""
    w = Window.partitionBy("doc_id").orderBy("a", "b")
    n = files.select("doc_id", F.size(F.split("text", "\n", -1)).alias("n"))
    ok = (F.col("a") >= 1) & (F.col("b") >= F.col("a")) & (F.col("b") <= F.col("n")) & (F.col("before").isNull() | (F.col("a") > F.col("before")))
    return ranges.withColumn("before", F.lag("b").over(w)).join(n, "doc_id").groupBy("doc_id").agg(F.bool_and(ok).alias("valid"))


def delete_ranges(files: DataFrame, ranges: DataFrame) -> DataFrame:
    """Texts without the lines of their ranges; a file whose ranges are not valid stays as it is (applied false)."""
    per = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("rs")).join(validate_ranges(ranges, files), "doc_id")
    j = files.select("doc_id", "text").join(per, "doc_id", "left")
    numbered = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct((i + 1).alias("i"), x.alias("x")))
    kept = F.filter(numbered, lambda s: ~F.exists("rs", lambda r: s["i"].between(r["a"], r["b"])))
    new = F.when(F.col("valid"), F.array_join(F.transform(kept, lambda s: s["x"]), "\n")).otherwise(F.col("text"))
    return j.select("doc_id", new.alias("text"), F.coalesce("valid", F.lit(False)).alias("applied"))


def valid_patches(patches: Column, total: Column) -> Column:
    """Whether patches (start, end; a null or zero end is the last line) by start neither overlap nor pass the end of the file."""

    def step(acc: Column, p: Column) -> Column:
        end = F.coalesce(F.nullif(p["end"], F.lit(0)), total)
        return F.struct((acc["ok"] & (p["start"] > acc["before"]) & (end <= total)).alias("ok"), end.alias("before"))

    by_start = F.array_sort(F.transform(patches, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))))
    return F.aggregate(by_start, F.struct(F.lit(True).alias("ok"), F.lit(0).alias("before")), step, lambda acc: acc["ok"])


def apply_patches(files: DataFrame, patches: DataFrame) -> DataFrame:
    """Patches array<struct<pos, start, end, contents>> put in one after the other, on the lines as they stand by then.

    result: ok, stale (expected_hash is not the text's), invalid (see valid_patches), or none without patches.
    """
    j = files.join(patches, "doc_id", "left")

    def step(lines: Column, p: Column) -> Column:
        n = F.size(lines)
        end = F.coalesce(F.nullif(p["end"], F.lit(0)), n)
        head = F.slice(lines, F.lit(1), F.greatest(F.least(p["start"] - 1, n), F.lit(0)))
        tail = F.when(end < n, F.slice(lines, F.least(end + 1, n), F.greatest(n - end, F.lit(0)))).otherwise(F.slice(lines, F.lit(1), F.lit(0)))
        return F.concat(head, F.split(p["contents"], "\n", -1), tail)

    lines = F.split("text", "\n", -1)
    fresh = F.col("expected_hash") == F.sha2("text", 256)
    new = F.array_join(F.aggregate("patches", lines, step), "\n")
    result = F.when(F.col("patches").isNull(), "none").when(~fresh, "stale").when(~valid_patches(F.col("patches"), F.size(lines)), "invalid").otherwise("ok")
    return j.select("doc_id", result.alias("result"), F.when(result == "ok", new).otherwise(F.col("text")).alias("new_text"))


def delete_checked(files: DataFrame, ranges: DataFrame) -> DataFrame:
    """doc_id, result, reason, new_text: ranges (a, b, range_hash) deleted where the file and every range are as expected.

    files: doc_id, text, expected_hash. Checked in this order: the file's hash, that there are ranges,
    that they are valid, and the hash of each range's lines (with their line ends), from the last range
    up. A file that fails a check stays as it is.
    """
    valid = validate_ranges(ranges, files)
    per = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b", "range_hash")).alias("rs")).join(valid, "doc_id", "left")
    j = files.select("doc_id", "text", "expected_hash").join(per, "doc_id", "left").withColumn("lines", F.split("text", "\n", -1))

    def stands(r: Column) -> Column:
        part = F.array_join(F.slice("lines", r["a"], r["b"] - r["a"] + 1), "\n")
        return F.sha2(F.when(r["b"] < F.size("lines"), F.concat(part, F.lit("\n"))).otherwise(part), 256) == r["range_hash"]

    off = F.array_max(F.transform(F.filter("rs", lambda r: ~stands(r)), lambda r: F.struct(r["a"], r["b"])))
    reason = (
        F.when(F.sha2("text", 256) != F.col("expected_hash"), "Content hash mismatch").when(F.col("rs").isNull(), "Missing required argument: ranges").when(~F.col("valid"), "Invalid ranges")
        .when(off.isNotNull(), F.concat(F.lit("Content hash mismatch for range "), off["a"].cast("string"), F.lit("-"), off["b"].cast("string")))
    )
    j = j.withColumn("reason", reason)
    numbered = F.transform("lines", lambda x, i: F.struct((i + 1).alias("i"), x.alias("x")))
    kept = F.filter(numbered, lambda s: ~F.exists("rs", lambda r: s["i"].between(r["a"], r["b"])))
    new = F.when(F.col("reason").isNull(), F.array_join(F.transform(kept, lambda s: s["x"]), "\n")).otherwise(F.col("text"))
    return j.select("doc_id", F.when(F.col("reason").isNull(), "ok").otherwise("error").alias("result"), "reason", new.alias("new_text"))


def valid_patch_request(hash_: Column, start: Column, end: Column, range_hash: Column) -> Column:
    """A patch names the file's hash, a range from 1 in order (an open end is null) and the range's hash."""
    return F.coalesce((hash_ != "") & (start >= 1) & (end.isNull() | (end >= start)) & (range_hash != ""), F.lit(False))


def valid_insert(before: Column, after: Column) -> Column:
    """Exactly one of the two is given, and it is 1 or more."""
    return F.coalesce((before.isNull() != after.isNull()) & (F.coalesce(before, after) >= 1), F.lit(False))


def line_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Lines removed and added in each document, counted as multisets."""
    lines = lambda x, n: x.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line")).groupBy("doc_id", "line").agg(F.count("*").alias(n))
    j = lines(old, "n").join(lines(new, "m"), ["doc_id", "line"], "full")
    n, m = F.coalesce("n", F.lit(0)), F.coalesce("m", F.lit(0))
    return j.groupBy("doc_id").agg(F.sum(F.greatest(n - m, F.lit(0))).alias("removed"), F.sum(F.greatest(m - n, F.lit(0))).alias("added"))
