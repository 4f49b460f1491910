"""Queries on HTML: parsing, tag and coverage rules, subsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import exprs as X
from pagewright.operators import html as H
from pagewright.plans.layout_queries import strip_sql
from pagewright.plans.registry import query
from pagewright.plans.text_queries import BLOCK_HTML, ESCAPE, _html
from pagewright.sources import views as V
from pagewright.sources.views import BLOCKS_SQL, CONTENT_SQL

ALLOWED = ", ".join(f"'{t}'" for t in H.NODE_TAGS + H.INLINE_TAGS)
BODY = "CASE WHEN contains(html, '<body>') AND contains(html, '</body>') THEN split_part(substr(html, position('<body>' IN html) + 6), '</body>', 1) ELSE html END"


@query("parse_html_elements")
def _(spark, d):
    e = H.parse_elements(V.table(spark, d, "pages"), "page_id", "html")
    return e.select("page_id", "ord", "parent", "depth", "tag", F.length("own_text").alias("text_chars"), "n_children")


@query("create_nodes_from_html")
def _(spark, d):
    return H.create_nodes(V.table(spark, d, "pages").withColumn("body", X.html_body(F.col("html"))), "page_id", "body")


@query("html_to_graph", CONTENT_SQL + f""", c AS (SELECT *, CAST(page_number - 1 AS INTEGER) AS p, CAST(count(*) OVER (PARTITION BY doc_id, page_number ORDER BY block_id) AS INTEGER) AS nth, CAST(block_id AS INTEGER) + page_number AS ord FROM content_blocks),
 s AS (SELECT doc_id, p, page_number, CAST(min(ord) - 1 AS INTEGER) AS ord, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, any_value(page_logical) AS page_logical FROM c GROUP BY ALL)
 SELECT doc_id, ord, CAST(NULL AS INTEGER) AS parent, p AS seq, 'section' AS tag, CAST(NULL AS VARCHAR) AS text_content, CAST(ord AS VARCHAR) AS path, page_number, page_logical, x1, y1, x2, y2, CAST(NULL AS VARCHAR) AS storage_url, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS caption FROM s
 UNION ALL SELECT c.doc_id, c.ord, s.ord, nth - 1, CASE WHEN block_type = 'Picture' THEN 'img' ELSE 'p' END, CASE WHEN block_type <> 'Picture' AND text_content <> '' THEN {strip_sql('text_content')} END, s.ord || '/' || c.ord, c.page_number, c.page_logical, c.x1, c.y1, c.x2, c.y2, storage_url, description, CASE WHEN block_type = 'Picture' THEN caption END FROM c JOIN s USING (doc_id, p)""")
def _(spark, d):
    b = V.content_blocks(spark, d)
    pic = F.col("block_type") == "Picture"
    source = F.concat(F.lit(' data-sources="'), F.col("block_id").cast("string"), F.lit('"'))
    one = F.when(pic, F.concat(F.lit("<img"), source, F.lit(" />"))).otherwise(F.concat(F.lit("<p"), source, F.lit(">"), X.html_escape(F.col("text_content")), F.lit("</p>")))
    page = b.groupBy("doc_id", "page_number").agg(F.min("block_id").alias("lo"), F.max("block_id").alias("hi"), F.array_sort(F.collect_list(F.struct("block_id", one.alias("h")))).alias("x"))
    page = page.select("doc_id", "page_number", F.concat(F.lit('<section data-sources="'), F.col("lo").cast("string"), F.lit("-"), F.col("hi").cast("string"), F.lit('">'), F.array_join(F.transform("x", lambda e: e["h"]), ""), F.lit("</section>")).alias("h"))
    docs = page.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_number", "h"))).alias("x")).select("doc_id", F.array_join(F.transform("x", lambda e: e["h"]), "").alias("html"))
    g = H.document_graph(docs, "doc_id", "html", b)
    at = g["positions"][0]
    return g.select("doc_id", "ord", "parent", "seq", "tag", "text_content", F.array_join(F.col("path").cast("array<string>"), "/").alias("path"), at["page_number"].alias("page_number"), at["page_logical"].alias("page_logical"), *[at[c].alias(c) for c in ("x1", "y1", "x2", "y2")], "storage_url", "description", "caption")


@query("pretty_print_html")
def _(spark, d):
    return H.pretty_print(V.table(spark, d, "pages"), "page_id", "html").select("page_id", F.sha2("pretty", 256).alias("pretty_sha256"))


@query("tag_counts", f"t AS (SELECT unnest(regexp_extract_all({BODY}, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pages) SELECT lower(tag) AS tag, count(*) AS n FROM t GROUP BY ALL")
def _(spark, d):
    return V.table(spark, d, "pages").select(F.explode(H.tags_in(F.col("html"))).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query("validate_html_tags", f"t AS (SELECT page_id, lower(unnest(regexp_extract_all({BODY}, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages), b AS (SELECT page_id, list(DISTINCT tag ORDER BY tag) AS bad FROM t WHERE tag NOT IN ({ALLOWED}) GROUP BY page_id) SELECT page_id, coalesce(bad, []) AS bad, bad IS NULL AS is_valid FROM pages LEFT JOIN b USING (page_id)")
def _(spark, d):
    p = V.table(spark, d, "pages").select("page_id", H.disallowed_tags(F.col("html")).alias("bad"))
    return p.withColumn("is_valid", F.size("bad") == 0)


@query("allowed_minus_excluded", f"SELECT tag FROM (SELECT unnest([{ALLOWED}]) AS tag) WHERE tag NOT IN ('table', 'td', 'tr')")
def _(spark, d):
    allowed = F.array(*[F.lit(t) for t in H.NODE_TAGS + H.INLINE_TAGS])
    return spark.range(1).select(F.explode(F.array_except(allowed, F.transform(F.array(F.lit("TABLE"), F.lit("td"), F.lit("Tr")), F.lower))).alias("tag"))


# outputs of restructuring: which ids of a document its elements name as sources or defer as children
USES = BLOCKS_SQL + """, uses AS (SELECT doc_id, CAST(i AS BIGINT) AS id, true AS is_input, i % 7 <> 3 AS in_sources, i % 5 = 4 AS in_children FROM lines
 UNION ALL SELECT doc_id, CAST(9000 + doc_id % 3 AS BIGINT), false, true, doc_id % 2 = 0 FROM documents WHERE doc_id % 4 = 1)"""


def _uses(spark, d):
    b = V.blocks(spark, d).select("doc_id", F.col("input_pos").cast("long").alias("id"), F.lit(True).alias("is_input"), (F.col("input_pos") % 7 != 3).alias("in_sources"), (F.col("input_pos") % 5 == 4).alias("in_children"))
    x = V.table(spark, d, "documents").filter("doc_id % 4 = 1").select("doc_id", (9000 + F.col("doc_id") % 3).alias("id"), F.lit(False), F.lit(True), F.col("doc_id") % 2 == 0)
    return b.union(x)


ISSUES = """issues AS (SELECT doc_id, id, 'MISSING_COVERAGE' AS code FROM uses WHERE is_input AND NOT in_sources AND NOT in_children UNION ALL SELECT doc_id, id, 'OVERLAP' FROM uses WHERE in_sources AND in_children UNION ALL SELECT doc_id, id, 'EXTRA_ID' FROM uses WHERE NOT is_input AND (in_sources OR in_children))"""


@query("validate_coverage", USES + "," + ISSUES + " SELECT * FROM issues WHERE code = 'MISSING_COVERAGE'")
def _(spark, d):
    return H.coverage_issues(_uses(spark, d), "doc_id").filter("code = 'MISSING_COVERAGE'")


@query("validate_disjoint", USES + "," + ISSUES + " SELECT * FROM issues WHERE code = 'OVERLAP'")
def _(spark, d):
    return H.coverage_issues(_uses(spark, d), "doc_id").filter("code = 'OVERLAP'")


@query("validate_data_sources", USES + "," + ISSUES + " SELECT doc_id, id, code FROM issues WHERE code <> 'OVERLAP'")
def _(spark, d):
    return H.coverage_issues(_uses(spark, d), "doc_id").filter("code <> 'OVERLAP'")


@query("validate_sources_and_children", USES + "," + ISSUES + " SELECT u.doc_id, count(*) FILTER (WHERE is_input) AS input_id_count, count(*) FILTER (WHERE in_sources) AS covered_by_sources, count(*) FILTER (WHERE in_children) AS covered_by_children, coalesce(any_value(n), 0) AS n_issues, coalesce(any_value(n), 0) = 0 AS is_valid FROM uses u LEFT JOIN (SELECT doc_id, count(*) AS n FROM issues WHERE code <> 'EXTRA_ID' GROUP BY ALL) x ON u.doc_id = x.doc_id GROUP BY u.doc_id")
def _(spark, d):
    u = _uses(spark, d)
    missing, both = F.col("is_input") & ~F.col("in_sources") & ~F.col("in_children"), F.col("in_sources") & F.col("in_children")
    g = u.groupBy("doc_id").agg(F.count_if("is_input").alias("input_id_count"), F.count_if("in_sources").alias("covered_by_sources"), F.count_if("in_children").alias("covered_by_children"), (F.count_if(missing) + F.count_if(both)).alias("n_issues"))
    return g.withColumn("is_valid", F.col("n_issues") == 0)


SETS = USES + ", sets AS (SELECT doc_id, list(id) FILTER (WHERE is_input) AS ins, coalesce(list(id) FILTER (WHERE in_sources), []) AS src, coalesce(list(id) FILTER (WHERE in_children), []) AS chi FROM uses GROUP BY doc_id)"


def _sets(spark, d):
    return _uses(spark, d).groupBy("doc_id").agg(F.collect_list(F.when(F.col("is_input"), F.col("id"))).alias("ins"), F.collect_list(F.when(F.col("in_sources"), F.col("id"))).alias("src"), F.collect_list(F.when(F.col("in_children"), F.col("id"))).alias("chi"))


@query("missing_and_extra_ids", SETS + " SELECT doc_id, list_sort(list_filter(ins, lambda x: NOT list_contains(src, x))) AS missing, list_sort(list_filter(src, lambda x: NOT list_contains(ins, x))) AS extra FROM sets")
def _(spark, d):
    return _sets(spark, d).select("doc_id", F.array_sort(F.array_except("ins", "src")).alias("missing"), F.array_sort(F.array_except("src", "ins")).alias("extra"))


@query("uncovered_ids", SETS + " SELECT doc_id, list_sort(list_filter(ins, lambda x: NOT list_contains(src, x) AND NOT list_contains(chi, x))) AS uncovered FROM sets")
def _(spark, d):
    return _sets(spark, d).select("doc_id", F.array_sort(F.array_except("ins", F.array_union("src", "chi"))).alias("uncovered"))


@query("overlapping_ids", SETS + " SELECT doc_id, list_sort(list_filter(src, lambda x: list_contains(chi, x))) AS overlap FROM sets")
def _(spark, d):
    return _sets(spark, d).select("doc_id", F.array_sort(F.array_intersect("src", "chi")).alias("overlap"))


@query("issue_concatenation", USES + "," + ISSUES + " SELECT code, count(*) AS n FROM issues GROUP BY code")
def _(spark, d):
    i = H.coverage_issues(_uses(spark, d), "doc_id")
    parts = [i.filter(F.col("code") == c) for c in ("MISSING_COVERAGE", "OVERLAP", "EXTRA_ID")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("code").agg(F.count("*").alias("n"))


@query("validate_total_coverage", BLOCKS_SQL + """, claimed AS (SELECT doc_id, i AS id FROM lines WHERE i % 9 <> 8 UNION ALL SELECT doc_id, i FROM lines WHERE i % 8 = 7), n AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY ALL),
 dup AS (SELECT doc_id, count(*) AS d FROM (SELECT doc_id, id FROM claimed GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL), mis AS (SELECT l.doc_id, count(*) AS m FROM lines l ANTI JOIN claimed c ON l.doc_id = c.doc_id AND l.i = c.id GROUP BY ALL)
 SELECT n.doc_id, coalesce(d, 0) AS duplicates, coalesce(m, 0) AS missing, coalesce(d, 0) + coalesce(m, 0) = 0 AS is_valid FROM n LEFT JOIN dup USING (doc_id) LEFT JOIN mis USING (doc_id)""")
def _(spark, d):
    b = V.blocks(spark, d).select("doc_id", F.col("input_pos").alias("id"))
    claimed = b.filter("id % 9 <> 8").union(b.filter("id % 8 = 7")).groupBy("doc_id", "id").agg(F.count("*").alias("n"))
    j = b.join(claimed, ["doc_id", "id"], "left")
    return j.groupBy("doc_id").agg(F.count_if(F.col("n") > 1).alias("duplicates"), F.count_if(F.col("n").isNull()).alias("missing")).withColumn("is_valid", (F.col("duplicates") + F.col("missing")) == 0)


@query("duplicates_and_missing_ids", BLOCKS_SQL + " SELECT doc_id, i AS id, 2 AS times FROM lines WHERE i % 8 = 7 AND i % 9 <> 8")
def _(spark, d):
    b = V.blocks(spark, d).select("doc_id", F.col("input_pos").alias("id"))
    return b.filter("id % 9 <> 8").union(b.filter("id % 8 = 7")).groupBy("doc_id", "id").agg(F.count("*").cast("int").alias("times")).filter("times > 1")


def _annotated(spark, d):
    """Flat HTML of every document as it comes back from restructuring, with source and child ranges."""
    k = F.col("page_number")
    attr = F.when(k % 5 == 0, F.concat(F.lit('data-children="'), F.col("r"), F.lit('"'))).when(k % 7 == 0, F.concat(F.lit('data-sources="'), F.col("r"), F.lit('" data-children="'), F.col("r"), F.lit('"'))).otherwise(F.concat(F.lit('data-sources="'), F.col("r"), F.lit('"')))
    body = F.when(k % 5 == 0, F.when(k % 2 == 0, "text").otherwise("")).when(k % 3 == 0, " ").otherwise("some <b>text</b>")
    g = V.blocks(spark, d).groupBy("doc_id", "page_number").agg(F.min("input_pos").alias("a"), F.max("input_pos").alias("b"))
    g = g.withColumn("r", F.concat(F.col("a").cast("string"), F.lit("-"), F.col("b").cast("string"))).withColumn("e", F.concat(F.lit("<p "), attr, F.lit(">"), body, F.lit("</p>")))
    return g.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "e"))), lambda x: x["e"]), "").alias("html"))


PAGES_SQL = BLOCKS_SQL + ", pg AS (SELECT doc_id, page_number, min(input_pos) AS a, max(input_pos) AS b, row_number() OVER (PARTITION BY doc_id ORDER BY page_number) AS k FROM blocks GROUP BY doc_id, page_number)"


@query("validate_mutual_exclusive", PAGES_SQL + " SELECT doc_id, count(*) AS n FROM pg WHERE page_number % 7 = 0 AND page_number % 5 <> 0 GROUP BY doc_id")
def _(spark, d):
    i = H.element_issues(H.parse_elements(_annotated(spark, d), "doc_id", "html"), "doc_id")
    return i.filter("code = 'BOTH_ATTRIBUTES'").groupBy("doc_id").agg(F.count("*").alias("n"))


@query("validate_children_empty", PAGES_SQL + " SELECT doc_id, count(*) AS n FROM pg WHERE (page_number % 5 = 0 AND page_number % 2 = 0) OR (page_number % 5 <> 0 AND page_number % 7 = 0 AND page_number % 3 <> 0) GROUP BY doc_id")
def _(spark, d):
    i = H.element_issues(H.parse_elements(_annotated(spark, d), "doc_id", "html"), "doc_id")
    return i.filter("code = 'CHILDREN_NOT_EMPTY'").groupBy("doc_id").agg(F.count("*").alias("n"))


@query("validate_sources_populated", PAGES_SQL + " SELECT doc_id, count(*) AS n FROM pg WHERE page_number % 5 <> 0 AND page_number % 3 = 0 GROUP BY doc_id")
def _(spark, d):
    i = H.element_issues(H.parse_elements(_annotated(spark, d), "doc_id", "html"), "doc_id")
    return i.filter("code = 'SOURCES_NOT_POPULATED'").groupBy("doc_id").agg(F.count("*").alias("n"))


@query("collect_output_ranges", PAGES_SQL + " SELECT doc_id, CASE WHEN page_number % 5 = 0 THEN 'data-children' ELSE 'data-sources' END AS attr, a, b FROM pg UNION ALL SELECT doc_id, 'data-children', a, b FROM pg WHERE page_number % 7 = 0 AND page_number % 5 <> 0")
def _(spark, d):
    e = H.parse_elements(_annotated(spark, d), "doc_id", "html").select("doc_id", F.explode("attrs").alias("attr", "r"))
    e = e.filter(F.col("attr").isin("data-sources", "data-children")).withColumn("ids", X.parse_ranges(F.col("r"))["ids"])
    return e.select("doc_id", "attr", F.array_min("ids").alias("a"), F.array_max("ids").alias("b"))


@query("parse_input_ids", BLOCKS_SQL + " SELECT doc_id, count(*) AS n, CAST(min(i) AS BIGINT) AS lo, CAST(max(i) AS BIGINT) AS hi FROM lines GROUP BY doc_id")
def _(spark, d):
    b = V.content_blocks(spark, d).select("doc_id", "block_id", _html(None).alias("html"))
    i = b.select("doc_id", F.regexp_extract("html", '^<[a-z]+ id="([0-9]+)"', 1).try_cast("long").alias("id")).filter("id is not null")
    return i.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))


@query("min_max_id", BLOCKS_SQL + " SELECT d.doc_id, coalesce(min(i), 0) AS lo, coalesce(max(i), -1) AS hi FROM documents d LEFT JOIN lines l ON d.doc_id = l.doc_id AND i % 6 = 5 GROUP BY d.doc_id")
def _(spark, d):
    b = V.blocks(spark, d).filter("input_pos % 6 = 5").select("doc_id", "input_pos")
    return V.table(spark, d, "documents").select("doc_id").join(b, "doc_id", "left").groupBy("doc_id").agg(F.coalesce(F.min("input_pos"), F.lit(0)).alias("lo"), F.coalesce(F.max("input_pos"), F.lit(-1)).alias("hi"))


WANTED = "wanted AS (SELECT doc_id, unnest([5, 2, 4, 99999]) AS id, unnest([0, 1, 2, 3]) AS pos FROM documents)"


def _wanted(spark, d):
    return V.table(spark, d, "documents").select("doc_id", F.posexplode(F.array(*[F.lit(x) for x in (5, 2, 4, 99999)])).alias("pos", "id"))


@query("subset_flat_html_by_ids", CONTENT_SQL + "," + WANTED + f" SELECT doc_id, sha256(string_agg(html, '' ORDER BY pos)) AS h FROM (SELECT w.doc_id, pos, {BLOCK_HTML} AS html FROM wanted w JOIN content_blocks c ON w.doc_id = c.doc_id AND w.id = c.block_id) GROUP BY doc_id")
def _(spark, d):
    b = V.content_blocks(spark, d).select("doc_id", F.col("block_id").alias("id"), _html(None).alias("html"))
    g = _wanted(spark, d).join(b, ["doc_id", "id"]).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "html"))).alias("x"))
    return g.select("doc_id", F.sha2(F.array_join(F.transform("x", lambda e: e["html"]), ""), 256).alias("h"))


@query("split_group_html", CONTENT_SQL + "," + WANTED + f" SELECT w.doc_id, count(c.block_id) AS found, count(*) - count(c.block_id) AS missing, sha256(coalesce(string_agg({BLOCK_HTML}, chr(10) ORDER BY pos), '')) AS h FROM wanted w LEFT JOIN content_blocks c ON w.doc_id = c.doc_id AND w.id = c.block_id GROUP BY w.doc_id")
def _(spark, d):
    b = V.content_blocks(spark, d).select("doc_id", F.col("block_id").alias("id"), _html(None).alias("html"))
    g = _wanted(spark, d).join(b, ["doc_id", "id"], "left").groupBy("doc_id").agg(F.count("html").alias("found"), F.count_if(F.col("html").isNull()).alias("missing"), F.array_sort(F.collect_list(F.when(F.col("html").isNotNull(), F.struct("pos", "html")))).alias("x"))
    return g.select("doc_id", "found", "missing", F.sha2(F.array_join(F.transform("x", lambda e: e["html"]), "\n"), 256).alias("h"))


@query("filter_blocks_by_numbers", CONTENT_SQL + "," + WANTED + " SELECT w.doc_id, CAST(pos AS INTEGER) AS pos, block_id, block_type FROM wanted w JOIN content_blocks c ON w.doc_id = c.doc_id AND w.id = c.block_id")
def _(spark, d):
    b = V.content_blocks(spark, d).select("doc_id", "block_id", "block_type")
    return _wanted(spark, d).join(b.withColumn("id", F.col("block_id")), ["doc_id", "id"]).select("doc_id", "pos", "block_id", "block_type")


@query("source_blocks_by_index", CONTENT_SQL + "," + WANTED + " SELECT w.doc_id, block_id, page_number FROM wanted w JOIN content_blocks c ON w.doc_id = c.doc_id AND w.id = c.block_id")
def _(spark, d):
    ids = _wanted(spark, d).select("doc_id", F.col("id").alias("block_id"))
    return ids.join(V.content_blocks(spark, d).select("doc_id", "block_id", "page_number"), ["doc_id", "block_id"])


@query("first_picture_source", CONTENT_SQL + " SELECT doc_id, page_number, min(block_id) AS block_id, arg_min(storage_url, block_id) AS storage_url, arg_min(caption, block_id) AS caption FROM content_blocks WHERE block_type = 'Picture' GROUP BY ALL")
def _(spark, d):
    pics = V.content_blocks(spark, d).filter("block_type = 'Picture'")
    return pics.groupBy("doc_id", "page_number").agg(F.min(F.struct("block_id", "storage_url", "caption")).alias("x")).select("doc_id", "page_number", "x.block_id", "x.storage_url", "x.caption")


@query("fixup_accept", "m AS (SELECT doc_id, doc_id % 4 AS bad0, doc_id % 3 AS bad1, doc_id % 5 AS iss0, doc_id % 6 AS iss1 FROM documents) SELECT doc_id, (bad1 = 0 AND bad0 > 0) OR bad1 < bad0 OR iss1 < iss0 OR (iss1 = 0 AND iss0 > 0) AS accept FROM m")
def _(spark, d):
    i = F.col("doc_id")
    bad0, bad1, iss0, iss1 = i % 4, i % 3, i % 5, i % 6
    return V.table(spark, d, "documents").select("doc_id", (((bad1 == 0) & (bad0 > 0)) | (bad1 < bad0) | (iss1 < iss0) | ((iss1 == 0) & (iss0 > 0))).alias("accept"))
