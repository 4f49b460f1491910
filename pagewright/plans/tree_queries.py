"""Queries on document trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import exprs as X
from pagewright.operators import tree as T
from pagewright.plans.registry import query
from pagewright.plans.text_queries import ESCAPE
from pagewright.sources import views as V
from pagewright.sources.views import CATALOGUE_SQL, NODES_SQL

UP = "ups AS (SELECT n.doc_id, n.node_id, n.tag, a.node_id AS ancestor_id, a.tag AS ancestor_tag, len(n.path) - list_position(n.path, a.node_id) AS distance FROM nodes n JOIN nodes a ON n.doc_id = a.doc_id AND list_contains(n.path, a.node_id) AND a.node_id <> n.node_id)"


@query("sequence_in_parent", NODES_SQL + " SELECT node_id, CAST(row_number() OVER (PARTITION BY doc_id, parent_id ORDER BY seq, node_id) - 1 AS INTEGER) AS sequence_in_parent FROM nodes")
def _(spark, d):
    return T.sequence_in_parent(V.nodes(spark, d)).select("node_id", "sequence_in_parent")


@query("children_order", NODES_SQL + " SELECT parent_id, list(node_id ORDER BY seq, node_id) AS children FROM nodes WHERE parent_id IS NOT NULL GROUP BY parent_id")
def _(spark, d):
    n = V.nodes(spark, d).filter("parent_id is not null")
    return n.groupBy("parent_id").agg(F.array_sort(F.collect_list(F.struct("seq", "node_id"))).alias("x")).select("parent_id", F.transform("x", lambda e: e["node_id"]).alias("children"))


@query("upload_structured_nodes", NODES_SQL + " SELECT doc_id, node_id, parent_id, seq, tag, CAST(len(path) - 1 AS INTEGER) AS depth FROM nodes")
def _(spark, d):
    return T.node_rows(V.nodes(spark, d))[0]


@query("upload_content_data", NODES_SQL + " SELECT node_id, CASE WHEN tag <> 'img' THEN text_content END AS text_content, description, CASE WHEN tag = 'img' THEN 'DESCRIPTION' ELSE 'TEXT_CONTENT' END AS embedding_source FROM nodes WHERE tag = 'img' OR text_content IS NOT NULL")
def _(spark, d):
    return T.node_rows(V.nodes(spark, d))[1]


@query("nearest_ancestor_with_tag", NODES_SQL + "," + UP + " SELECT n.node_id, c.container_id FROM nodes n LEFT JOIN (SELECT node_id, arg_min(ancestor_id, distance) AS container_id FROM ups WHERE ancestor_tag IN ('ul', 'section') GROUP BY ALL) c ON n.node_id = c.node_id WHERE n.tag IN ('li', 'p')")
def _(spark, d):
    n = V.nodes(spark, d)
    wanted = n.filter(F.col("tag").isin("li", "p")).select("node_id", F.array(F.lit("ul"), F.lit("section")).alias("tags"))
    return T.nearest_ancestor(n, wanted)


@query("render_containing_parent", NODES_SQL + "," + UP + " SELECT n.node_id, coalesce(c.container_id, n.node_id) AS target_id FROM nodes n LEFT JOIN (SELECT node_id, arg_min(ancestor_id, distance) AS container_id FROM ups WHERE ancestor_tag = 'ul' GROUP BY ALL) c ON n.node_id = c.node_id")
def _(spark, d):
    n = V.nodes(spark, d)
    return T.nearest_ancestor(n, n.select("node_id", F.array(F.lit("ul")).alias("tags"))).select("node_id", F.coalesce("container_id", "node_id").alias("target_id"))


@query("render_context", NODES_SQL + "," + UP + """ SELECT n.node_id, coalesce(c.container_id, n.node_id) AS target_id FROM nodes n LEFT JOIN (SELECT node_id, arg_min(ancestor_id, distance) AS container_id FROM ups
 WHERE tag NOT IN ('section', 'aside', 'nav', 'figure', 'table', 'ul', 'ol') AND CASE WHEN tag IN ('thead', 'tbody', 'tfoot', 'th', 'tr', 'td', 'caption') THEN ancestor_tag IN ('table', 'section', 'main', 'header', 'footer') WHEN tag IN ('img', 'figcaption') THEN ancestor_tag IN ('figure', 'section', 'main', 'header', 'footer')
 WHEN tag = 'li' THEN ancestor_tag IN ('ul', 'ol', 'section', 'main', 'header', 'footer') ELSE ancestor_tag IN ('figure', 'table', 'section', 'aside', 'nav', 'main', 'header', 'footer') END GROUP BY ALL) c ON n.node_id = c.node_id""")
def _(spark, d):
    return T.context_node(V.nodes(spark, d))


@query("path_children_arrays", NODES_SQL + "," + UP + " SELECT n.node_id, coalesce(string_agg(ancestor_tag, ' -> ' ORDER BY distance DESC), 'None') AS parents FROM nodes n LEFT JOIN ups u ON n.node_id = u.node_id GROUP BY n.node_id")
def _(spark, d):
    n = V.nodes(spark, d)
    tags = n.select(F.col("node_id").alias("ancestor_id"), F.col("tag").alias("t"))
    a = T.ancestors(n).join(tags, "ancestor_id").groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("k"), "t"))).alias("x"))
    return n.select("node_id").join(a, "node_id", "left").select("node_id", F.coalesce(F.array_join(F.transform("x", lambda e: e["t"]), " -> "), F.lit("None")).alias("parents"))


@query("render_leaf_nodes", NODES_SQL + f" SELECT node_id, sha256(CASE WHEN tag = 'img' THEN '<img src=\"\" alt=\"' || {ESCAPE.format('coalesce(description, chr(0))')} || '\" />' ELSE '<' || tag || '>' || {ESCAPE.format('coalesce(text_content, repeat(chr(65), 0))')} || '</' || tag || '>' END) AS h FROM nodes WHERE tag NOT IN ('section', 'ul')")
def _(spark, d):
    n = V.nodes(spark, d).filter(~F.col("tag").isin("section", "ul"))
    return n.select("node_id", F.sha2(T.render_leaf(F.col("tag"), F.col("text_content"), F.col("description")), 256).alias("h"))


@query("render_document")
def _(spark, d):
    return T.render_documents(V.nodes(spark, d)).select("doc_id", F.sha2("html", 256).alias("h"), F.length("html").alias("n"))


@query("node_tree_to_html")
def _(spark, d):
    return T.node_tree_to_html(V.nodes(spark, d)).select("doc_id", F.sha2("html", 256).alias("h"), F.length("html").alias("n"))


@query("top_level_deferred_nodes", NODES_SQL + "," + UP + " SELECT doc_id, node_id FROM nodes n WHERE node_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM ups u WHERE u.node_id = n.node_id AND u.ancestor_id % 2 = 0)")
def _(spark, d):
    return T.top_level_only(V.nodes(spark, d), F.col("node_id") % 2 == 0)


RESOLVED = "resolved AS (SELECT doc_id, node_id + 90000000000 AS node_id, node_id AS parent_id, tag FROM nodes WHERE tag = 'ul')"


@query("splice_resolved_children", NODES_SQL + "," + RESOLVED + " SELECT doc_id, node_id, parent_id, 'new' AS tag FROM resolved UNION ALL SELECT doc_id, node_id, parent_id, tag FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM resolved r WHERE r.parent_id = n.parent_id)")
def _(spark, d):
    n = V.nodes(spark, d).select("doc_id", "node_id", "parent_id", "tag", "path")
    new = n.filter("tag = 'ul'").select("doc_id", (F.col("node_id") + 90000000000).alias("node_id"), F.col("node_id").alias("parent_id"), F.lit("new").alias("tag"), F.array_append("path", F.col("node_id") + 90000000000).alias("path"))
    return T.splice(n, new).drop("path")


@query("classify_section_types", NODES_SQL + " SELECT node_id, CASE WHEN page_number = 1 THEN 'TITLE_PAGE' WHEN page_number % 5 = 0 THEN NULL ELSE 'SECTION' END AS section_type FROM nodes WHERE tag = 'section'")
def _(spark, d):
    """Responses arrive as a table; sections without a valid one keep a null type."""
    n = V.nodes(spark, d).filter("tag = 'section'")
    p = F.col("page_number")
    responses = n.select("node_id", F.when(p == 1, "TITLE_PAGE").when(p % 5 == 0, "NO_SUCH_TYPE").otherwise("SECTION").alias("response"))
    valid = F.col("response").isin("SECTION", "SUBSECTION", "TITLE_PAGE", "CHAPTER", "APPENDIX", "INDEX")
    return n.select("node_id").join(responses, "node_id", "left").select("node_id", F.when(valid, F.col("response")).alias("section_type"))


CLEAN = r"nullif(trim({0}, ' '), '')"


@query("citation_attributes", NODES_SQL + "," + CATALOGUE_SQL + f" SELECT node_id, concat_ws(' ', CASE WHEN parent_id IS NULL THEN 'data-publication-title=\"' || {CLEAN.format('title')} || '\"' END, CASE WHEN parent_id IS NULL THEN 'data-publication-date=\"' || publication_date || '\"' END, CASE WHEN parent_id IS NULL THEN 'data-document-description=\"' || c.description || '\"' END, 'data-pages=\"' || page_number || '\"') AS attrs FROM nodes n JOIN catalogue c ON n.doc_id = c.document_id JOIN publications p ON c.publication_id = p.publication_id")
def _(spark, d):
    c = V.catalogue(spark, d).select(F.col("document_id").alias("doc_id"), "publication_id", F.col("description").alias("about"))
    j = V.nodes(spark, d).select("doc_id", "node_id", "parent_id", "page_number").join(c, "doc_id").join(V.publications(spark, d), "publication_id")
    attr = lambda name, v: F.concat(F.lit(f'{name}="'), v, F.lit('"'))
    top = lambda x: F.when(F.col("parent_id").isNull(), x)
    return j.select("node_id", F.concat_ws(" ", top(attr("data-publication-title", X.strip_or_null(F.col("title")))), top(attr("data-publication-date", F.date_format("publication_date", "yyyy-MM-dd"))), top(attr("data-document-description", F.col("about"))), attr("data-pages", F.col("page_number").cast("string"))).alias("attrs"))


@query("ensure_description_caption_allowed", NODES_SQL + " SELECT node_id, tag FROM nodes WHERE (description IS NOT NULL AND trim(description, ' ') <> '' OR page_number % 6 = 5) AND tag NOT IN ('img', 'table')")
def _(spark, d):
    n = V.nodes(spark, d).withColumn("caption", F.when(F.col("page_number") % 6 == 5, "caption"))
    return n.filter((X.has_text(F.col("description")) | X.has_text(F.col("caption"))) & ~F.col("tag").isin("img", "table")).select("node_id", "tag")


@query("jsonb_positions", NODES_SQL + " SELECT node_id, '[{\"page_pdf\":' || page_number || ',\"bbox\":{\"x1\":36,\"y1\":' || (seq * 10) || '}}]' AS positions FROM nodes")
def _(spark, d):
    box = F.struct(F.lit(36).alias("x1"), (F.col("seq") * 10).alias("y1"))
    return V.nodes(spark, d).select("node_id", F.to_json(F.array(F.struct(F.col("page_number").alias("page_pdf"), F.lit(None).cast("string").alias("page_logical"), box.alias("bbox")))).alias("positions"))
