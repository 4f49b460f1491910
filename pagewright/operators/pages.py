"""Logical page labels: typing, interpolation, accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import exprs as X


def interpolate(labels: DataFrame) -> DataFrame:
    """Fills missing labels between two known pages of one numbering type.

    labels: doc_id, page_number, label. Successive known pages (p0, v0), (p1, v1) of a type are used
    if p1 - p0 > 1, the values rise by 1 up to three times the pages, and by 0.8 to 1.2 a page. A page
    between gets v0 + round-half-even((p - p0) * dv / dp). Known pages stay; where several types would
    fill a page, the type seen first in the document wins. Pages without a row may be added.
    """
    known = labels.filter("label is not null").withColumn("kind", X.label_type(F.col("label"))).withColumn("value", X.label_value(F.col("label"))).filter("kind <> 'unknown'")
    w = Window.partitionBy("doc_id", "kind")
    o = w.orderBy("page_number")
    pairs = known.select("doc_id", "kind", F.col("page_number").alias("p0"), F.col("value").alias("v0"), F.lead("page_number").over(o).alias("p1"), F.lead("value").over(o).alias("v1"), F.min("page_number").over(w).alias("first"))
    dp, dv = F.col("p1") - F.col("p0"), F.col("v1") - F.col("v0")
    pairs = pairs.filter((dp > 1) & (dv >= 1) & (dv <= 3 * dp) & (dv / dp >= 0.8) & (dv / dp <= 1.2))
    fills = pairs.select("doc_id", "kind", "first", "p0", "v0", dp.alias("dp"), dv.alias("dv"), F.explode(F.sequence(F.col("p0") + 1, F.col("p1") - 1)).alias("page_number"))
    value = (F.col("v0") + F.bround((F.col("page_number") - F.col("p0")) * F.col("dv") / F.col("dp"), 0)).cast("int")
    fills = fills.select("doc_id", "page_number", "first", X.format_label(value, F.col("kind")).alias("filled")).filter("filled is not null")
    best = fills.groupBy("doc_id", "page_number").agg(F.min(F.struct("first", "filled"))["filled"].alias("filled"))
    j = labels.join(best, ["doc_id", "page_number"], "full")
    return j.select("doc_id", "page_number", F.coalesce("label", "filled").alias("label"), (F.col("label").isNull() & F.col("filled").isNotNull()).alias("interpolated"))


def expected_mapping(pages: DataFrame) -> DataFrame:
    """The labels a report of 72 pages with front matter, 51 numbered pages and an appendix should carry."""
    p = F.col("page_number")
    label = F.when(p.between(3, 7), X.to_roman(p - 2)).when(p.between(9, 15), F.upper(X.to_roman(p - 8))).when(p.between(17, 67), (p - 16).cast("string")).when(p.between(68, 70), F.char(p - 3))
    return pages.withColumn("expected", label)


def section_of(page):
    """Number of the page range (1 .. 8) that a page of such a report lies in."""
    # fixed values: last pages of the eight ranges
    last = [2, 7, 8, 15, 16, 67, 70, 72]
    out = F.lit(None).cast("int")
    for k, end in reversed(list(enumerate(last, 1))):
        out = F.when(page <= end, k).otherwise(out)
    return F.when(page >= 1, out)
