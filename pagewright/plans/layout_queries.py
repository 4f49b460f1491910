"""Queries on layout blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import exprs as X
from pagewright.operators import layout as L
from pagewright.plans.registry import query
from pagewright.sources import views as V
from pagewright.sources.views import BLOCKS_SQL, CONTENT_SQL, RECTS_SQL

# the same expressions in SQL
Y2 = "(top + height)"
FURNITURE = f"CASE WHEN {Y2} <= 72 THEN 'Page header' WHEN top >= page_height - 72 THEN 'Page footer' END"
RETYPE = f"CASE WHEN type = 'Text' THEN coalesce({FURNITURE}, type) ELSE type END"
BOX = "CAST(trunc(\"left\") AS INTEGER) AS bx1, CAST(trunc(top) AS INTEGER) AS by1, CAST(ceil(\"left\" + width) AS INTEGER) AS bx2, CAST(ceil(top + height) AS INTEGER) AS by2"
STRIP = r"regexp_replace({0}, '^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$', '', 'g')"
WORDS = r"len(regexp_extract_all({0}, '[^ \t\n\r\f\v]+'))"
PATTERN = X.VISUAL.replace("'", "''")


def strip_sql(x: str) -> str:
    return STRIP.format(x)


def words_sql(x: str) -> str:
    return WORDS.format(x)


PATTERNS_SQL = f"""
patterned AS (SELECT *, {strip_sql('text')} = '' AS is_empty,
 length(text) - length(replace(text, chr(10), '')) > 0 AND (length(text) - length(replace(text, chr(10), ''))) / greatest({words_sql('text')}, 1) > 0.3 AS many_lines,
 regexp_matches(upper(text), '{PATTERN}') AS visual, CAST(length({strip_sql('text')}) AS BIGINT) AS n_chars, CAST({words_sql('text')} AS BIGINT) AS n_words FROM blocks),
suggested AS (SELECT *, NOT is_empty AND (many_lines OR (visual AND n_chars < 50)) AS suggests_visual FROM patterned)"""
ASK = "(NOT is_empty AND (n_chars > 100 OR n_words > 15))"


@query("bbox_from_ltwh", BLOCKS_SQL + ' SELECT doc_id, input_pos, "left" AS x1, top AS y1, "left" + width AS x2, top + height AS y2 FROM blocks')
def _(spark, d):
    b = X.bbox(F.col("left"), F.col("top"), F.col("width"), F.col("height"))
    return V.blocks(spark, d).select("doc_id", "input_pos", b.alias("b")).select("doc_id", "input_pos", "b.*")


@query("bbox_integerize", BLOCKS_SQL + f" SELECT doc_id, input_pos, bx1 AS x1, by1 AS y1, bx2 AS x2, by2 AS y2 FROM (SELECT *, {BOX} FROM blocks)")
def _(spark, d):
    b = X.bbox_integers(F.col("left"), F.col("top"), F.col("width"), F.col("height"))
    return V.blocks(spark, d).select("doc_id", "input_pos", b.alias("b")).select("doc_id", "input_pos", "b.*")


@query("bbox_area", BLOCKS_SQL + f" SELECT doc_id, input_pos, (bx2 - bx1) * (by2 - by1) AS area FROM (SELECT *, {BOX} FROM blocks)")
def _(spark, d):
    b = X.bbox_integers(F.col("left"), F.col("top"), F.col("width"), F.col("height"))
    return V.blocks(spark, d).select("doc_id", "input_pos", X.area(b).alias("area"))


@query("classify_header_footer", BLOCKS_SQL + f" SELECT doc_id, input_pos, {FURNITURE} AS furniture FROM blocks")
def _(spark, d):
    return V.blocks(spark, d).select("doc_id", "input_pos", X.furniture(F.col("top"), F.col("top") + F.col("height"), F.col("page_height")).alias("furniture"))


@query("reclassify_headers_footers", BLOCKS_SQL + f" SELECT doc_id, input_pos, {RETYPE} AS type FROM blocks")
def _(spark, d):
    return L.retype_furniture(V.blocks(spark, d)).select("doc_id", "input_pos", "type")


@query("correct_page_dimensions", BLOCKS_SQL + """, actual AS (SELECT DISTINCT doc_id, page_number, CAST(612 + page_number % 3 AS DOUBLE) AS w, CAST(792 + doc_id % 2 AS DOUBLE) AS h FROM blocks WHERE page_number % 4 <> 0)
 SELECT doc_id, input_pos, CASE WHEN abs(page_width - w) > 1 OR abs(page_height - h) > 1 THEN w ELSE page_width END AS page_width, CASE WHEN abs(page_width - w) > 1 OR abs(page_height - h) > 1 THEN h ELSE page_height END AS page_height FROM blocks LEFT JOIN actual USING (doc_id, page_number)""")
def _(spark, d):
    b = V.blocks(spark, d)
    actual = b.filter("page_number % 4 <> 0").select("doc_id", "page_number", (612 + F.col("page_number") % 3).cast("double").alias("width"), (792 + F.col("doc_id") % 2).cast("double").alias("height")).distinct()
    return L.correct_page_dimensions(b, actual).select("doc_id", "input_pos", "page_width", "page_height")


@query("drop_page_furniture", BLOCKS_SQL + f" SELECT doc_id, input_pos, t AS type FROM (SELECT *, {RETYPE} AS t FROM blocks) WHERE t NOT IN ('Page header', 'Page footer')")
def _(spark, d):
    return L.drop_furniture(L.retype_furniture(V.blocks(spark, d))).select("doc_id", "input_pos", "type")


@query("drop_position_furniture", BLOCKS_SQL + f" SELECT doc_id, input_pos FROM blocks WHERE type NOT IN ('Page header', 'Page footer') AND {FURNITURE} IS NULL")
def _(spark, d):
    b = L.drop_furniture(V.blocks(spark, d))
    return b.filter(X.furniture(F.col("top"), F.col("top") + F.col("height"), F.col("page_height")).isNull()).select("doc_id", "input_pos")


@query("keep_pictures_or_text", BLOCKS_SQL + f" SELECT doc_id, input_pos, type FROM blocks WHERE type = 'Picture' OR {strip_sql('text')} <> ''")
def _(spark, d):
    return V.blocks(spark, d).filter((F.col("type") == "Picture") | X.has_text(F.col("text"))).select("doc_id", "input_pos", "type")


@query("analyze_text_patterns", BLOCKS_SQL + "," + PATTERNS_SQL + " SELECT doc_id, input_pos, is_empty, many_lines, visual, n_chars, n_words, suggests_visual FROM suggested")
def _(spark, d):
    return V.blocks(spark, d).select("doc_id", "input_pos", X.text_patterns(F.col("text")).alias("p")).select("doc_id", "input_pos", "p.*")


@query("should_use_llm_text_filter", BLOCKS_SQL + "," + PATTERNS_SQL + f" SELECT doc_id, input_pos, {ASK} AS ask FROM suggested")
def _(spark, d):
    return V.blocks(spark, d).select("doc_id", "input_pos", X.worth_asking(F.col("text")).alias("ask"))


RULE = "CASE WHEN y1 - y0 <= 2 AND x1 - x0 > 10 * (y1 - y0) AND x1 - x0 > 20 THEN true ELSE false END"


@query("is_horizontal_line", RECTS_SQL + f" SELECT doc_id, page_number, kind, x0, y0, x1, y1, {RULE} AS is_rule FROM rects")
def _(spark, d):
    return V.rects(spark, d).withColumn("is_rule", X.is_rule(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))


@query("get_embedding_source", BLOCKS_SQL + " SELECT type, CASE WHEN type = 'Picture' THEN 'DESCRIPTION' ELSE 'TEXT_CONTENT' END AS embedding_source, count(*) AS n FROM blocks GROUP BY ALL")
def _(spark, d):
    return V.blocks(spark, d).groupBy("type", X.embedding_source(F.col("type")).alias("embedding_source")).agg(F.count("*").alias("n"))


INSIDE = f"""contained AS (SELECT b.doc_id, b.input_pos, count(*) FILTER (WHERE kind = 'image') AS n_images, count(*) FILTER (WHERE kind = 'drawing') AS n_drawings, count(*) FILTER (WHERE kind = 'drawing' AND NOT ({RULE})) AS n_shapes
 FROM (SELECT *, {BOX} FROM blocks) b JOIN rects r ON b.doc_id = r.doc_id AND b.page_number = r.page_number AND x0 >= bx1 AND y0 >= by1 AND x1 <= bx2 AND y1 <= by2 GROUP BY ALL)"""


@query("image_containment", RECTS_SQL + f" SELECT doc_id, input_pos FROM (SELECT *, {BOX} FROM blocks) b WHERE EXISTS (SELECT 1 FROM rects r WHERE kind = 'image' AND b.doc_id = r.doc_id AND b.page_number = r.page_number AND x0 >= bx1 AND y0 >= by1 AND x1 <= bx2 AND y1 <= by2)")
def _(spark, d):
    found = L.containment(V.blocks(spark, d), V.rects(spark, d))
    return found.filter("n_images > 0").select("doc_id", "input_pos")


@query("drawing_containment", RECTS_SQL + "," + INSIDE + " SELECT doc_id, input_pos, n_drawings, n_shapes, CASE WHEN n_drawings < 3 THEN n_shapes > 0 ELSE true END AS drawn FROM contained WHERE n_drawings > 0")
def _(spark, d):
    found = L.containment(V.blocks(spark, d), V.rects(spark, d)).filter("n_drawings > 0")
    return found.select("doc_id", "input_pos", "n_drawings", "n_shapes", F.when(F.col("n_drawings") < 3, F.col("n_shapes") > 0).otherwise(True).alias("drawn"))


@query("geometry_containment", RECTS_SQL + " SELECT doc_id, page_number, kind, count(*) AS n FROM rects WHERE x0 >= 36 AND y0 >= 0 AND x1 <= 100 AND y1 <= 200 GROUP BY ALL")
def _(spark, d):
    r = V.rects(spark, d).filter("x0 >= 36 and y0 >= 0 and x1 <= 100 and y1 <= 200")
    return r.groupBy("doc_id", "page_number", "kind").agg(F.count("*").alias("n"))


CANDIDATES = RECTS_SQL + "," + INSIDE + "," + PATTERNS_SQL + f""",
candidates AS (SELECT doc_id, input_pos, page_number, is_empty, n_chars, n_words, CASE WHEN is_empty AND (bx2 - bx1) * (by2 - by1) > 5000 THEN 'large_empty' WHEN NOT is_empty AND (bx2 - bx1) * (by2 - by1) > 200000 THEN 'large_text' WHEN suggests_visual THEN 'visual_pattern'
 WHEN NOT is_empty AND coalesce(n_images, 0) > 0 THEN 'image' WHEN coalesce(CASE WHEN n_drawings < 3 THEN n_shapes > 0 ELSE n_drawings > 0 END, false) THEN 'drawing' END AS rule
 FROM (SELECT *, {BOX} FROM suggested WHERE type = 'Text') LEFT JOIN contained USING (doc_id, input_pos))"""
RESPONSES = "responses AS (SELECT doc_id, CAST(i AS INTEGER) AS input_pos, CASE (doc_id + i) % 4 WHEN 0 THEN 'data_labels' WHEN 1 THEN 'paragraph' WHEN 2 THEN 'other' END AS content_type FROM lines WHERE (doc_id + i) % 9 <> 0)"


def _responses(spark, d):
    k = F.col("doc_id") + F.col("input_pos")
    t = F.when(k % 4 == 0, "data_labels").when(k % 4 == 1, "paragraph").when(k % 4 == 2, "other")
    return V.blocks(spark, d).filter(k % 9 != 0).select("doc_id", "input_pos", t.alias("content_type"))


@query("visual_candidate_rules", CANDIDATES + " SELECT doc_id, input_pos, page_number, rule FROM candidates")
def _(spark, d):
    return L.visual_candidates(V.blocks(spark, d), V.rects(spark, d)).drop("text")


@query("llm_filter_split", CANDIDATES + "," + RESPONSES + f" SELECT doc_id, input_pos, rule, CASE WHEN NOT {ASK} THEN true ELSE coalesce(content_type IN ('data_labels', 'other'), true) END AS accepted FROM candidates LEFT JOIN responses USING (doc_id, input_pos) WHERE rule IS NOT NULL AND rule <> 'image'")
def _(spark, d):
    c = L.visual_candidates(V.blocks(spark, d), V.rects(spark, d)).filter("rule <> 'image'")
    return L.accept_candidates(c, _responses(spark, d)).select("doc_id", "input_pos", "rule", "accepted")


@query("detection_stats", CANDIDATES + "," + RESPONSES + f""" SELECT count(*) FILTER (WHERE rule = 'large_empty') AS large_empty, count(*) FILTER (WHERE rule = 'large_text') AS large_text, count(*) FILTER (WHERE rule = 'visual_pattern') AS visual_patterns,
 count(*) FILTER (WHERE rule = 'image') AS images, count(*) FILTER (WHERE rule = 'drawing') AS drawings, count(*) FILTER (WHERE rule <> 'image') AS initial, count(*) FILTER (WHERE rule <> 'image' AND (CASE WHEN NOT {ASK} THEN true ELSE coalesce(content_type IN ('data_labels', 'other'), true) END)) AS final FROM candidates LEFT JOIN responses USING (doc_id, input_pos)""")
def _(spark, d):
    c = L.visual_candidates(V.blocks(spark, d), V.rects(spark, d))
    return L.detection_stats(L.accept_candidates(c, _responses(spark, d), keep_images=True))


@query("layout_profile", BLOCKS_SQL + "," + PATTERNS_SQL + f""" SELECT lang, count(*) AS n_blocks, count(*) FILTER (WHERE t = 'Page header') AS headers, count(*) FILTER (WHERE t = 'Page footer') AS footers, count(*) FILTER (WHERE t NOT IN ('Page header', 'Page footer') AND suggests_visual) AS visual,
 count(*) FILTER (WHERE t NOT IN ('Page header', 'Page footer') AND is_empty) AS empty FROM (SELECT *, {RETYPE} AS t FROM suggested) JOIN (SELECT doc_id, lang FROM documents) USING (doc_id) GROUP BY lang""")
def _(spark, d):
    b = L.retype_furniture(V.blocks(spark, d)).select("doc_id", "type", X.suggests_visual(F.col("text")).alias("visual"), (X.strip(F.col("text")) == "").alias("is_empty")).join(V.table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    body = ~F.col("type").isin(X.HEADER, X.FOOTER)
    return b.groupBy("lang").agg(F.count("*").alias("n_blocks"), F.count_if(F.col("type") == X.HEADER).alias("headers"), F.count_if(F.col("type") == X.FOOTER).alias("footers"), F.count_if(body & F.col("visual")).alias("visual"), F.count_if(body & F.col("is_empty")).alias("empty"))


@query("group_header_footer_text", BLOCKS_SQL + f" SELECT doc_id, page_number, list({strip_sql('text')} ORDER BY input_pos) AS texts FROM (SELECT *, {RETYPE} AS t FROM blocks) WHERE t IN ('Page header', 'Page footer') AND {strip_sql('text')} <> '' GROUP BY ALL")
def _(spark, d):
    return L.furniture_text(L.retype_furniture(V.blocks(spark, d)))


@query("blocks_by_page", BLOCKS_SQL + " SELECT doc_id, page_number, list(input_pos ORDER BY input_pos) AS block_ids, count(*) AS n FROM blocks GROUP BY ALL")
def _(spark, d):
    return V.blocks(spark, d).groupBy("doc_id", "page_number").agg(F.array_sort(F.collect_list("input_pos")).alias("block_ids"), F.count("*").alias("n"))


@query("block_id_assignment", BLOCKS_SQL + " SELECT doc_id, input_pos, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_number, input_pos) - 1 AS INTEGER) AS block_id FROM blocks")
def _(spark, d):
    return L.number_blocks(V.blocks(spark, d)).select("doc_id", "input_pos", "block_id")


@query("picture_failure_route", CONTENT_SQL + f" SELECT doc_id, block_id, CASE WHEN block_type = 'Picture' AND block_id % 3 = 0 THEN 'Text' ELSE block_type END AS block_type, CASE WHEN NOT (block_type = 'Picture' AND block_id % 3 = 0) THEN storage_url END AS storage_url FROM content_blocks WHERE NOT (block_type = 'Picture' AND block_id % 3 = 0) OR {strip_sql('text_content')} <> ''")
def _(spark, d):
    b = V.content_blocks(spark, d).withColumn("failed", F.col("block_id") % 3 == 0)
    return L.route_failed_pictures(b).select("doc_id", "block_id", "block_type", "storage_url")


@query("merge_bboxes_by_page", CONTENT_SQL + " SELECT doc_id, page_number, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, arg_min(page_logical, block_id) FILTER (WHERE page_logical IS NOT NULL) AS page_logical FROM content_blocks GROUP BY ALL")
def _(spark, d):
    return L.merge_boxes_by_page(V.content_blocks(spark, d).withColumn("ord", F.col("block_id")), ["doc_id"]).select("doc_id", "page_number", "x1", "y1", "x2", "y2", "page_logical")


@query("unique_page_positions", CONTENT_SQL + " SELECT doc_id, page_number, page_logical, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY f) - 1 AS INTEGER) AS ord, CAST(612 AS DOUBLE) AS x2, CAST(792 AS DOUBLE) AS y2 FROM (SELECT doc_id, page_number, min(block_id) AS f, arg_min(page_logical, block_id) FILTER (WHERE page_logical IS NOT NULL) AS page_logical FROM content_blocks GROUP BY ALL)")
def _(spark, d):
    b = V.content_blocks(spark, d).withColumn("input_pos", F.col("block_id")).withColumn("page_width", F.lit(V.PAGE_WIDTH)).withColumn("page_height", F.lit(V.PAGE_HEIGHT))
    return L.unique_pages(b).select("doc_id", "page_number", "page_logical", "ord", "x2", "y2")


@query("pages_sorted", BLOCKS_SQL + " SELECT doc_id, list(DISTINCT page_number ORDER BY page_number) AS pages FROM blocks GROUP BY doc_id")
def _(spark, d):
    return V.blocks(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_set("page_number")).alias("pages"))


@query("position_key_lookup", BLOCKS_SQL + ' SELECT a.doc_id, a.input_pos, b.input_pos AS match_pos FROM blocks a JOIN blocks b ON a.doc_id = b.doc_id AND a.page_number = b.page_number AND a."left" = b."left" AND a.top = b.top AND a.width = b.width AND a.height = b.height')
def _(spark, d):
    key = ["doc_id", "page_number", "left", "top", "width", "height"]
    b = V.blocks(spark, d)
    return b.select(*key, "input_pos").join(b.select(*key, F.col("input_pos").alias("match_pos")), key).select("doc_id", "input_pos", "match_pos")


@query("image_context_window", CONTENT_SQL + """ SELECT doc_id, block_id, coalesce(string_agg(t || chr(10), '' ORDER BY o), '') AS context FROM (
 SELECT a.doc_id, a.block_id, b.block_id AS o, b.text_content AS t FROM content_blocks a LEFT JOIN content_blocks b ON a.doc_id = b.doc_id AND a.page_number = b.page_number AND b.block_id BETWEEN a.block_id - 2 AND a.block_id + 2 AND (b.block_type IN ('Text', 'Title', 'Section header', 'Caption', 'List item', 'Formula', 'Table') OR b.block_id = a.block_id) AND b.text_content <> '' WHERE a.block_type = 'Picture') GROUP BY ALL""")
def _(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id", "page_number").orderBy("block_id").rangeBetween(-2, 2)
    b = V.content_blocks(spark, d)
    allowed = F.col("block_type").isin(*L.CONTEXT_TYPES)
    near = F.collect_list(F.struct("block_id", F.col("text_content").alias("t"), allowed.alias("ok"))).over(w)
    b = b.withColumn("near", near).filter("block_type = 'Picture'")
    text = F.filter("near", lambda x: (x["ok"] | (x["block_id"] == F.col("block_id"))) & (x["t"] != ""))
    return b.select("doc_id", "block_id", F.array_join(F.transform(F.array_sort(text), lambda x: F.concat(x["t"], F.lit("\n"))), "").alias("context"))
