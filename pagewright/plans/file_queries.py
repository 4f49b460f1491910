"""Queries that write files and read them again, and that read drawings."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import exprs as X
from pagewright.plans.registry import query
from pagewright.sources import readers, sinks
from pagewright.sources import views as V
from pagewright.sources.views import BLOCKS_SQL, CONTENT_SQL, RECTS_SQL


@query("scan_layout_json", BLOCKS_SQL + ' SELECT "left", top, width, height, page_number, page_width, page_height, text, type FROM blocks')
def _(spark, d):
    path = sinks.scratch(spark)
    sinks.write_layout(V.blocks(spark, d).withColumnRenamed("doc_id", "document_id"), path)
    return readers.layout_json(spark, path)


@query("scan_content_blocks_json", CONTENT_SQL + " SELECT doc_id AS document_id, page_number AS page_pdf, page_logical, x1, y1, x2, y2, block_type, CASE WHEN block_type = 'Picture' THEN 'DESCRIPTION' ELSE 'TEXT_CONTENT' END AS embedding_source, text_content, storage_url, description, caption FROM content_blocks")
def _(spark, d):
    b = V.content_blocks(spark, d).withColumnRenamed("doc_id", "document_id")
    where = F.struct(F.col("page_number").alias("page_pdf"), "page_logical", F.struct("x1", "y1", "x2", "y2").alias("bbox"))
    path = sinks.scratch(spark)
    sinks.write_content_blocks(b.withColumns({"positional_data": where, "embedding_source": X.embedding_source(F.col("block_type"))}), path)
    r = readers.content_blocks_json(spark, path)
    return r.select("document_id", "positional_data.page_pdf", "positional_data.page_logical", "positional_data.bbox.*", "block_type", "embedding_source", "text_content", "storage_url", "description", "caption")


@query("scan_html_documents", "SELECT page_id AS document_id, sha256(CASE WHEN starts_with(html, '<!-- Approved -->') THEN html ELSE '<!-- Approved -->' || chr(10) || html END || chr(10)) AS html_sha256 FROM pages")
def _(spark, d):
    path = sinks.scratch(spark)
    sinks.write_html(V.table(spark, d, "pages").withColumnRenamed("page_id", "document_id"), path)
    return readers.html_documents(spark, path).select("document_id", F.sha2("html", 256).alias("html_sha256"))


@query("scan_svg_elements", RECTS_SQL + " SELECT doc_id, CASE WHEN kind = 'image' THEN 'image' ELSE 'rect' END AS tag, x0, y0, x1, y1 FROM rects")
def _(spark, d):
    attr = lambda n, c: F.concat(F.lit(f' {n}="'), c.cast("string"), F.lit('"'))
    shape = F.concat(F.lit("<"), F.when(F.col("kind") == "image", "image").otherwise("rect"), attr("x", F.col("x0")), attr("y", F.col("y0")), attr("width", F.col("x1") - F.col("x0")), attr("height", F.col("y1") - F.col("y0")), F.lit("/>"))
    pages = V.rects(spark, d).groupBy("doc_id", "page_number").agg(F.array_join(F.collect_list(shape), "").alias("x"))
    svg = pages.select("doc_id", F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg"><g><path id="font_1" d="M0 0 L9 9"/>'), "x", F.lit("</g></svg>")).alias("svg"))
    return readers.svg_elements(svg, "doc_id", "svg").select("doc_id", "tag", "x0", "y0", "x1", "y1")


@query("has_geometry", RECTS_SQL + " SELECT doc_id, page_number, kind, count(*) FILTER (WHERE x1 > x0 OR y1 > y0) AS n FROM rects GROUP BY ALL")
def _(spark, d):
    box = readers.has_geometry(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])
    return V.rects(spark, d).groupBy("doc_id", "page_number", "kind").agg(F.count_if(box).alias("n"))


@query("nonempty_text", BLOCKS_SQL + " SELECT doc_id, input_pos FROM blocks WHERE regexp_replace(text, '[ \t\n\r\f\v]+', '', 'g') <> ''")
def _(spark, d):
    return V.blocks(spark, d).filter(X.has_text(F.col("text"))).select("doc_id", "input_pos")
