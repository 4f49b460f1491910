"""Operators on layout blocks: geometry, furniture, visual candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import exprs as X


# fixed values: block types whose text stands around a picture
CONTEXT_TYPES = ["Text", "Title", "Section header", "Caption", "List item", "Formula", "Table"]


def correct_page_dimensions(blocks: DataFrame, actual: DataFrame) -> DataFrame:
    """Width and height of a page are replaced, both, where either is off by more than 1; pages without a known size stay."""
    a = actual.select("doc_id", "page_number", F.col("width").alias("aw"), F.col("height").alias("ah"))
    j = blocks.join(a, ["doc_id", "page_number"], "left")
    off = F.coalesce((F.abs(F.col("page_width") - F.col("aw")) > 1.0) | (F.abs(F.col("page_height") - F.col("ah")) > 1.0), F.lit(False))
    return j.withColumns({"page_width": F.when(off, F.col("aw")).otherwise(F.col("page_width")), "page_height": F.when(off, F.col("ah")).otherwise(F.col("page_height"))}).drop("aw", "ah")


def retype_furniture(blocks: DataFrame) -> DataFrame:
    """Text blocks in the page margins become headers or footers."""
    return blocks.withColumn("type", X.retype(F.col("type"), F.col("top"), F.col("top") + F.col("height"), F.col("page_height")))


def drop_furniture(blocks: DataFrame) -> DataFrame:
    return blocks.filter(~F.col("type").isin(X.HEADER, X.FOOTER))


def furniture_text(blocks: DataFrame) -> DataFrame:
    """Non-blank stripped texts of headers and footers of each page, in input order."""
    b = blocks.filter(F.col("type").isin(X.HEADER, X.FOOTER) & X.has_text(F.col("text")))
    g = b.groupBy("doc_id", "page_number").agg(F.array_sort(F.collect_list(F.struct("input_pos", X.strip(F.col("text")).alias("t")))).alias("x"))
    return g.select("doc_id", "page_number", F.transform("x", lambda e: e["t"]).alias("texts"))


def number_blocks(blocks: DataFrame) -> DataFrame:
    """block_id: position in the document, by page, then input order. One window over each document."""
    w = Window.partitionBy("doc_id").orderBy("page_number", "input_pos")
    return blocks.withColumn("block_id", (F.row_number().over(w) - 1).cast("int"))


def containment(blocks: DataFrame, rects: DataFrame) -> DataFrame:
    """Images and drawings inside each block of their page: n_images, n_drawings, n_shapes (drawings that are no rules).

    Equal keys (document, page) carry the join, the corners are residual conditions; the counts are
    taken once for all rules that need them.
    """
    box = X.bbox_integers(F.col("left"), F.col("top"), F.col("width"), F.col("height"))
    b = blocks.select("doc_id", "page_number", "input_pos", box.alias("b"))
    r = rects.select("doc_id", "page_number", "kind", "x0", "y0", "x1", "y1")
    inside = (F.col("x0") >= F.col("b.x1")) & (F.col("y0") >= F.col("b.y1")) & (F.col("x1") <= F.col("b.x2")) & (F.col("y1") <= F.col("b.y2"))
    j = b.join(r, ["doc_id", "page_number"]).filter(inside)
    draw = F.col("kind") == "drawing"
    rule = X.is_rule(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    return j.groupBy("doc_id", "input_pos").agg(F.count_if(~draw).alias("n_images"), F.count_if(draw).alias("n_drawings"), F.count_if(draw & ~rule).alias("n_shapes"))


def visual_candidates(blocks: DataFrame, rects: DataFrame) -> DataFrame:
    """Why a text block may be a picture: the first rule that fires, else null.

    Rules in order: large_empty (over 5000), large_text (over 200000), visual_pattern, image (not for
    empty blocks); then drawings, of which fewer than three must include one that is no rule. A block
    with an image is a picture at once; the other rules only make candidates.
    """
    found = containment(blocks, rects)
    b = blocks.filter(F.col("type") == "Text").join(found, ["doc_id", "input_pos"], "left")
    size = X.area(X.bbox_integers(F.col("left"), F.col("top"), F.col("width"), F.col("height")))
    empty = X.strip(F.col("text")) == ""
    drawn = F.when(F.col("n_drawings") < 3, F.col("n_shapes") > 0).otherwise(F.col("n_drawings") > 0)
    rule = (
        F.when(empty & (size > 5000), "large_empty").when(~empty & (size > 200000), "large_text").when(X.suggests_visual(F.col("text")), "visual_pattern")
        .when(~empty & (F.coalesce("n_images", F.lit(0)) > 0), "image").when(F.coalesce(drawn, F.lit(False)), "drawing")
    )
    return b.select("doc_id", "input_pos", "page_number", "text", rule.alias("rule"))


def accept_candidates(candidates: DataFrame, responses: DataFrame, keep_images: bool = False) -> DataFrame:
    """Candidates worth asking about count only if the response is data_labels or other, or cannot be read; blocks with an image are none."""
    r = responses.select("doc_id", "input_pos", "content_type")
    candidates = candidates.filter(~F.col("rule").eqNullSafe("image") | F.lit(keep_images))
    j = candidates.join(r, ["doc_id", "input_pos"], "left")
    asked = X.worth_asking(F.col("text"))
    return j.withColumn("accepted", F.when(~asked, True).otherwise(F.coalesce(F.col("content_type").isin("data_labels", "other"), F.lit(True))))


def detection_stats(candidates: DataFrame) -> DataFrame:
    """How often each rule fired; initial and final count candidates, which blocks with an image are not."""
    n = lambda r: F.count_if(F.col("rule") == r)
    return candidates.agg(n("large_empty").alias("large_empty"), n("large_text").alias("large_text"), n("visual_pattern").alias("visual_patterns"), n("image").alias("images"), n("drawing").alias("drawings"), F.count_if(F.col("rule") != "image").alias("initial"), F.count_if((F.col("rule") != "image") & F.col("accepted")).alias("final"))


def route_failed_pictures(blocks: DataFrame) -> DataFrame:
    """A picture that could not be cut out becomes text if it has any, else it goes. Needs columns failed, storage_url."""
    pic = (F.col("block_type") == "Picture") & F.col("failed")
    keep = ~pic | X.has_text(F.col("text_content"))
    return blocks.filter(keep).withColumns({"block_type": F.when(pic, "Text").otherwise(F.col("block_type")), "storage_url": F.when(~pic, F.col("storage_url"))})


def merge_boxes_by_page(positions: DataFrame, keys: list[str]) -> DataFrame:
    """One box for each page of a group: outer corners and the first logical page that is known, in input order."""
    g = positions.groupBy(*keys, "page_number").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.min(F.when(F.col("page_logical").isNotNull(), F.struct("ord", "page_logical")))["page_logical"].alias("page_logical"))
    return g


def unique_pages(blocks: DataFrame) -> DataFrame:
    """One row for each page in the order first seen, its box the whole page."""
    g = blocks.groupBy("doc_id", "page_number").agg(F.min("input_pos").alias("first"), F.min(F.when(F.col("page_logical").isNotNull(), F.struct("input_pos", "page_logical")))["page_logical"].alias("page_logical"), F.max("page_width").alias("x2"), F.max("page_height").alias("y2"))
    return g.withColumn("ord", F.row_number().over(Window.partitionBy("doc_id").orderBy("first")) - 1)
