"""Queries on scalar text functions, id ranges, id sets, styling, prompts and text edits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.functions import exprs as X
from pagewright.operators import edits as E
from pagewright.operators import style as S
from pagewright.plans.layout_queries import strip_sql, words_sql
from pagewright.plans.registry import query
from pagewright.sources import views as V
from pagewright.sources.views import BLOCKS_SQL, CONTENT_SQL, SPANS_SQL

BREAK = r"'[ \t\n\r\f\v]+'"


@query("normalize_text_for_matching", rf"SELECT item_id, regexp_replace(trim(regexp_replace(lower(text), {BREAK}, ' ', 'g'), ' '), '[.,;:!?]$', '') AS form FROM benchmark")
def _(spark, d):
    return V.table(spark, d, "benchmark").select("item_id", X.match_form(F.col("text")).alias("form"))


@query("strip_control_chars", r"SELECT doc_id, length(regexp_replace(text || chr(7) || chr(127) || chr(9), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g')) AS n FROM documents")
def _(spark, d):
    odd = F.concat("text", F.lit("\x07\x7f\t"))
    return V.table(spark, d, "documents").select("doc_id", F.length(X.strip_control(odd)).cast("long").alias("n"))


@query("extract_body", "SELECT page_id, sha256(CASE WHEN contains(html, '<body>') AND contains(html, '</body>') THEN split_part(substr(html, position('<body>' IN html) + 6), '</body>', 1) ELSE html END) AS body_sha256 FROM pages")
def _(spark, d):
    return V.table(spark, d, "pages").select("page_id", F.sha2(X.html_body(F.col("html")), 256).alias("body_sha256"))


ESCAPE = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


@query("html_escape", f"SELECT page_id, sha256({ESCAPE.format('html')}) AS escaped FROM pages")
def _(spark, d):
    return V.table(spark, d, "pages").select("page_id", F.sha2(X.html_escape(F.col("html")), 256).alias("escaped"))


CORNERS = "'[' || CAST(trunc(x1) AS INTEGER) || ', ' || CAST(trunc(y1) AS INTEGER) || ', ' || CAST(trunc(x2) AS INTEGER) || ', ' || CAST(trunc(y2) AS INTEGER) || ']'"
BLOCK_HTML = f"""CASE WHEN block_type = 'Picture' THEN '<img id="' || block_id || '" data-page="' || page_number || '" src="' || {ESCAPE.format('storage_url')} || '" alt="' || {ESCAPE.format('coalesce(description, text_content)')} || '" data-bbox="' || {CORNERS} || '" />'
 ELSE '<p id="' || block_id || '" data-page="' || page_number || '" data-bbox="' || {CORNERS} || '">' || text_content || '</p>' END"""


def _html(b):
    return X.block_html(F.col("block_id"), F.col("block_type"), F.col("page_number"), F.col("text_content"), F.struct("x1", "y1", "x2", "y2"), F.col("storage_url"), F.col("description"))


@query("block_to_html", CONTENT_SQL + f" SELECT doc_id, block_id, {BLOCK_HTML} AS html FROM content_blocks")
def _(spark, d):
    return V.content_blocks(spark, d).select("doc_id", "block_id", _html(None).alias("html"))


@query("flatten_document_html", CONTENT_SQL + f" SELECT doc_id, sha256(string_agg({BLOCK_HTML}, chr(10) ORDER BY block_id)) AS html_sha256, count(*) AS n FROM content_blocks GROUP BY doc_id")
def _(spark, d):
    b = V.content_blocks(spark, d).select("doc_id", F.struct("block_id", _html(None).alias("html")).alias("x"))
    g = b.groupBy("doc_id").agg(F.array_sort(F.collect_list("x")).alias("x"), F.count("*").alias("n"))
    return g.select("doc_id", F.sha2(F.array_join(F.transform("x", lambda e: e["html"]), "\n"), 256).alias("html_sha256"), "n")


@query("number_lines", "l AS (SELECT item_id, unnest(list_zip(range(1, len(string_split(text, chr(10))) + 1), string_split(text, chr(10)))) AS z FROM benchmark) SELECT item_id, string_agg(z[1] || ': ' || z[2], chr(10) ORDER BY z[1]) AS numbered FROM l GROUP BY item_id")
def _(spark, d):
    return V.table(spark, d, "benchmark").select("item_id", X.numbered_lines(F.col("text")).alias("numbered"))


@query("sha256_content", "SELECT doc_id, sha256(text) AS hash FROM documents")
def _(spark, d):
    return V.table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))


@query("base64_image", "SELECT item_id, 'data:image/webp;base64,' || base64(encode(text)) AS url FROM benchmark")
def _(spark, d):
    return V.table(spark, d, "benchmark").select("item_id", F.concat(F.lit("data:image/webp;base64,"), F.regexp_replace(F.base64(F.encode("text", "utf-8")), "[\\r\\n]", "")).alias("url"))


@query("coerce_page_logical", CONTENT_SQL + " SELECT doc_id, block_id, CAST(page_number AS VARCHAR) AS page_logical FROM content_blocks")
def _(spark, d):
    return V.content_blocks(spark, d).select("doc_id", "block_id", F.col("page_number").cast("string").alias("page_logical"))


@query("starts_with_marker", "SELECT page_id, coalesce(starts_with(html, '<html'), false) AS marked FROM pages")
def _(spark, d):
    return V.table(spark, d, "pages").select("page_id", X.starts_with(F.col("html"), "<html").alias("marked"))


@query("write_html_marker", "m AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '<!-- Approved -->' || chr(10) || html ELSE html END AS html FROM pages) SELECT page_id, sha256(CASE WHEN starts_with(html, '<!-- Approved -->') THEN html ELSE '<!-- Approved -->' || chr(10) || html END) AS h FROM m")
def _(spark, d):
    m = V.table(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<!-- Approved -->\n"), "html")).otherwise(F.col("html")).alias("html"))
    return m.select("page_id", F.sha2(X.with_marker(F.col("html"), "<!-- Approved -->"), 256).alias("h"))


@query("chunk_count", f"SELECT page_id, CASE WHEN length(html) * 60 > {X.SPLIT_CHARS} THEN length(html) * 60 // {X.SPLIT_CHARS} + 1 ELSE 1 END AS n FROM pages")
def _(spark, d):
    return V.table(spark, d, "pages").select("page_id", X.chunk_count(F.repeat("html", F.lit(60))).alias("n"))


@query("route_prompt_by_size", f"SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'TOP_LEVEL' WHEN length(text) < {X.ONE_PASS_CHARS} THEN 'NO_DEFERRAL' ELSE 'STANDARD' END AS route FROM documents")
def _(spark, d):
    return V.table(spark, d, "documents").select("doc_id", X.prompt_route(F.col("doc_id") % 4, F.lit(None).cast("string"), F.col("text")).alias("route"))


@query("section_too_long", "SELECT doc_id, length(text) > 3 * 64000 / 20 AS too_long FROM documents")
def _(spark, d):
    return V.table(spark, d, "documents").select("doc_id", (F.length("text") > 3 * 64000 / 20).alias("too_long"))


CASES = ["0-3,5,7-9", "", "  ", "1,,2", "-5", "3-1", "4", "2,2,1", "5 - 7, 1", "a", "1-b", "0-0"]
CASES_SQL = "cases AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}')" for c in CASES) + ") c(x))"


@query("parse_range_string", CASES_SQL + r""", p AS (SELECT x, unnest(string_split(x, ',')) AS part FROM cases), q AS (SELECT x, trim(part, ' ') AS part FROM p),
 r AS (SELECT x, part, regexp_matches(part, '^[0-9]+$') AS single, regexp_matches(part, '^[0-9]+ *- *[0-9]+$') AS double, contains(part, '-') AS dash, TRY_CAST(regexp_extract(part, '^([0-9]+)', 1) AS INTEGER) AS lo, TRY_CAST(regexp_extract(part, '([0-9]+)$', 1) AS INTEGER) AS hi FROM q),
 e AS (SELECT x, CASE WHEN trim(x, ' ') = '' THEN NULL WHEN bool_or(NOT dash AND NOT single) THEN 'Non-numeric value' WHEN bool_or(dash AND NOT double) THEN 'Non-numeric values in range' WHEN bool_or(double AND lo > hi) THEN 'Start after end' END AS error FROM r GROUP BY x)
 SELECT x, error, CASE WHEN error IS NULL THEN coalesce((SELECT list(v ORDER BY v) FROM (SELECT CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS v FROM r WHERE r.x = e.x AND lo IS NOT NULL)), CAST([] AS INTEGER[])) END AS ids FROM e""")
def _(spark, d):
    return spark.createDataFrame([(c,) for c in CASES], "x string").select("x", X.parse_ranges(F.col("x")).alias("r")).select("x", "r.error", "r.ids")


IDS_SQL = "ids AS (SELECT DISTINCT conv_id AS k, length(text) % 50 AS id FROM conversations)"


def _ids(spark, d):
    return V.table(spark, d, "conversations").select(F.col("conv_id").alias("k"), (F.length("text") % 50).cast("long").alias("id")).distinct()


@query("list_to_ranges", IDS_SQL + ", g AS (SELECT k, id, id - row_number() OVER (PARTITION BY k ORDER BY id) AS g FROM ids), r AS (SELECT k, g, min(id) AS a, max(id) AS b FROM g GROUP BY ALL) SELECT k, string_agg(CASE WHEN a = b THEN '' || a ELSE a || '-' || b END, ',' ORDER BY a) AS ranges FROM r GROUP BY k")
def _(spark, d):
    return _ids(spark, d).groupBy("k").agg(F.collect_list("id").alias("ids")).select("k", X.format_ranges(F.col("ids")).alias("ranges"))


@query("list_to_ranges_rows", IDS_SQL + ", g AS (SELECT k, id, id - row_number() OVER (PARTITION BY k ORDER BY id) AS g FROM ids) SELECT k, min(id) AS lo, max(id) AS hi, count(*) AS n FROM g GROUP BY k, g")
def _(spark, d):
    """The gaps-and-islands form, for id sets that do not fit a row."""
    w = Window.partitionBy("k").orderBy("id")
    return _ids(spark, d).withColumn("g", F.col("id") - F.row_number().over(w)).groupBy("k", "g").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).drop("g")


@query("validate_range_string", CASES_SQL + r" SELECT x, regexp_matches(x, '^[0-9 \t\n\r,\-]+$') AS valid FROM cases")
def _(spark, d):
    return spark.createDataFrame([(c,) for c in CASES], "x string").select("x", X.valid_range_text(F.col("x")).alias("valid"))


FENCES = ["```json\n{\"a\": 1}\n```", "```\nx\n```", "``` json\n[1]\n```\n", "plain", "```json {}```", "  ```json\n{}\n``` ", "```json\n{}"]


@query("de_fence")
def _(spark, d):
    return spark.createDataFrame([(c,) for c in FENCES], "x string").select("x", X.de_fence(F.col("x")).alias("inner"))


@query("parse_model_json", "r AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '{\"label\": \"' || role || '\", \"n\": ' || conv_id || '}' ELSE '{\"label\": ' END AS response FROM conversations) SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN json_extract_string(response, '$.label') END AS label, CASE WHEN turn % 2 = 0 THEN conv_id END AS n, turn % 2 <> 0 AS failed FROM r")
def _(spark, d):
    c = V.table(spark, d, "conversations")
    fenced = F.concat(F.lit('```json\n{"label": "'), "role", F.lit('", "n": '), F.col("conv_id").cast("string"), F.lit("}\n```"))
    r = c.select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, fenced).otherwise('{"label": ').alias("response"))
    p = r.withColumn("p", F.from_json(X.de_fence(F.col("response")), "label string, n long, _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}))
    return p.select("conv_id", "turn", "p.label", "p.n", F.coalesce(F.col("p._bad").isNotNull() | F.col("p.label").isNull(), F.lit(True)).alias("failed"))


@query("retry_transcript", "SELECT conv_id, list(role || ':' || length(text) ORDER BY turn) AS messages, count(*) AS n FROM conversations GROUP BY conv_id")
def _(spark, d):
    c = V.table(spark, d, "conversations").select("conv_id", F.struct("turn", F.concat_ws(":", "role", F.length("text").cast("string")).alias("m")).alias("x"))
    return c.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"), F.count("*").alias("n")).select("conv_id", F.transform("x", lambda e: e["m"]).alias("messages"), "n")


@query("build_fixup_prompt", "SELECT doc_id, concat_ws(chr(10), 'Repair the output.', CASE WHEN doc_id % 2 = 0 THEN 'Missing ids: ' || doc_id END, CASE WHEN doc_id % 3 = 0 THEN 'Extra ids: ' || (doc_id + 1) END, CASE WHEN doc_id % 5 = 0 THEN 'Tags not allowed: div' END, CASE WHEN doc_id % 7 = 0 THEN 'Feedback: ' || lang END) AS prompt FROM documents")
def _(spark, d):
    i, on = F.col("doc_id"), lambda k, x: F.when(F.col("doc_id") % k == 0, x)
    return V.table(spark, d, "documents").select("doc_id", F.concat_ws("\n", F.lit("Repair the output."), on(2, F.concat(F.lit("Missing ids: "), i.cast("string"))), on(3, F.concat(F.lit("Extra ids: "), (i + 1).cast("string"))), on(5, F.lit("Tags not allowed: div")), on(7, F.concat(F.lit("Feedback: "), "lang"))).alias("prompt"))


@query("feedback_lines", "SELECT conv_id, string_agg('- ' || role || ' affected_ids=[' || turn || ']', chr(10) ORDER BY turn) AS feedback FROM conversations GROUP BY conv_id")
def _(spark, d):
    line = F.concat(F.lit("- "), "role", F.lit(" affected_ids=["), F.col("turn").cast("string"), F.lit("]"))
    c = V.table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))).alias("x"))
    return c.select("conv_id", F.array_join(F.transform("x", lambda e: e["l"]), "\n").alias("feedback"))


@query("critical_feedback", "SELECT conv_id, turn FROM conversations WHERE CASE WHEN length(text) % 3 = 0 THEN 'critical' ELSE 'minor' END = 'critical'")
def _(spark, d):
    c = V.table(spark, d, "conversations").withColumn("severity", F.when(F.length("text") % 3 == 0, "critical").otherwise("minor"))
    return c.filter("severity = 'critical'").select("conv_id", "turn")


STYLED = "CASE WHEN flags & 2 <> 0 THEN '<i>' || b || '</i>' ELSE b END"


@query("apply_style_flags", SPANS_SQL + f" SELECT doc_id, span_pos, {STYLED} AS styled FROM (SELECT *, CASE WHEN flags & 16 <> 0 THEN '<b>' || text || '</b>' ELSE text END AS b FROM spans)")
def _(spark, d):
    return V.spans(spark, d).select("doc_id", "span_pos", X.styled(F.col("text"), F.col("flags")).alias("styled"))


@query("scan_pdf_styled_spans", SPANS_SQL + f" SELECT doc_id, page_number, span_pos, text, flags FROM spans WHERE flags & 18 <> 0 AND {strip_sql('text')} <> ''")
def _(spark, d):
    return V.spans(spark, d).filter((F.col("flags").bitwiseAND(18) != 0) & X.has_text(F.col("text"))).select("doc_id", "page_number", "span_pos", "text", "flags")


@query("spans_longest_first", SPANS_SQL + " SELECT doc_id, page_number, list(span_pos ORDER BY length(text) DESC, span_pos) AS spans FROM spans GROUP BY ALL")
def _(spark, d):
    s = V.spans(spark, d).groupBy("doc_id", "page_number").agg(F.array_sort(F.collect_list(F.struct((-F.length("text")).alias("k"), "span_pos"))).alias("x"))
    return s.select("doc_id", "page_number", F.transform("x", lambda e: e["span_pos"]).alias("spans"))


@query("span_to_block_match", SPANS_SQL + " SELECT s.doc_id, span_pos, b.input_pos, contains(lower(b.text), lower(s.text)) AS found FROM spans s JOIN blocks b ON s.doc_id = b.doc_id AND s.page_number = b.page_number WHERE b.text <> ''")
def _(spark, d):
    s = V.spans(spark, d).select("doc_id", "page_number", "span_pos", F.col("text").alias("span"))
    b = V.blocks(spark, d).filter("text <> ''").select("doc_id", "page_number", "input_pos", "text")
    j = s.join(b, ["doc_id", "page_number"])
    return j.select("doc_id", "span_pos", "input_pos", F.lower("text").contains(F.lower("span")).alias("found"))


@query("best_span_match")
def _(spark, d):
    s = V.spans(spark, d).select("doc_id", "page_number", "span_pos", F.col("text").alias("span"))
    j = s.join(V.blocks(spark, d).select("doc_id", "page_number", "input_pos", "text"), ["doc_id", "page_number"])
    return j.select("doc_id", "span_pos", "input_pos", S.best_match(F.col("text"), F.col("span")).alias("m")).filter("m is not null").select("doc_id", "span_pos", "input_pos", "m.rule", "m.n")


@query("style_text")
def _(spark, d):
    return S.style_blocks(V.content_blocks(spark, d), V.spans(spark, d), V.PAGE_HEIGHT).select("doc_id", "block_id", "text_content", "changed")


@query("rebuild_styled_block")
def _(spark, d):
    return S.style_blocks(V.content_blocks(spark, d), V.spans(spark, d), V.PAGE_HEIGHT).select("doc_id", "block_id", "changed", "storage_url", "description", "caption")


@query("styling_summary")
def _(spark, d):
    return S.styling_summary(V.content_blocks(spark, d), V.spans(spark, d), V.PAGE_HEIGHT)


# text edits: every line of a document is a row; ranges to delete are made up from the id
LINES = "file_lines AS (SELECT doc_id, CAST(i + 1 AS INTEGER) AS pos, line FROM lines), ranges AS (SELECT doc_id, CAST(k * 4 + 1 + doc_id % 3 AS INTEGER) AS a, CAST(k * 4 + 1 + doc_id % 3 + (doc_id + k) % 6 AS INTEGER) AS b FROM documents, (SELECT unnest([0, 1]) AS k))"


def _ranges(spark, d):
    r = V.table(spark, d, "documents").select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    a = F.col("k") * 4 + 1 + F.col("doc_id") % 3
    return r.select("doc_id", a.cast("int").alias("a"), (a + (F.col("doc_id") + F.col("k")) % 6).cast("int").alias("b"))


@query("read_line_range", BLOCKS_SQL + "," + LINES + " SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS part FROM file_lines WHERE pos BETWEEN greatest(1, CAST(doc_id % 4 AS INTEGER) - 1) AND 3 GROUP BY doc_id")
def _(spark, d):
    docs = V.table(spark, d, "documents")
    return docs.select("doc_id", E.line_range(F.col("text"), (F.col("doc_id") % 4 - 1).cast("int"), F.lit(3)).alias("part")).filter("part is not null")


CHECKED = """checked AS (SELECT doc_id, a, b, n, lag(b) OVER (PARTITION BY doc_id ORDER BY a, b) AS before FROM ranges JOIN (SELECT doc_id, count(*) AS n FROM file_lines GROUP BY ALL) USING (doc_id)),
verdict AS (SELECT doc_id, bool_and(a >= 1 AND b >= a AND b <= n AND (before IS NULL OR a > before)) AS valid FROM checked GROUP BY doc_id)"""


@query("validate_ranges", BLOCKS_SQL + "," + LINES + "," + CHECKED + " SELECT * FROM verdict")
def _(spark, d):
    return E.validate_ranges(_ranges(spark, d), V.table(spark, d, "documents"))


@query("overlap_check", BLOCKS_SQL + "," + LINES + "," + CHECKED + " SELECT doc_id, a, b FROM checked WHERE before IS NOT NULL AND a <= before")
def _(spark, d):
    w = Window.partitionBy("doc_id").orderBy("a", "b")
    return _ranges(spark, d).withColumn("before", F.lag("b").over(w)).filter("a <= before").select("doc_id", "a", "b")


@query("delete_text_file_contents", BLOCKS_SQL + "," + LINES + "," + CHECKED + " SELECT l.doc_id, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT (valid AND EXISTS (SELECT 1 FROM ranges r WHERE r.doc_id = l.doc_id AND l.pos BETWEEN r.a AND r.b))), '')) AS hash, any_value(valid) AS applied FROM file_lines l JOIN verdict v ON l.doc_id = v.doc_id GROUP BY l.doc_id")
def _(spark, d):
    return E.delete_ranges(V.table(spark, d, "documents"), _ranges(spark, d)).select("doc_id", F.sha2("text", 256).alias("hash"), "applied")


PATCHED = """p AS (SELECT doc_id, string_split(text, chr(10)) AS l, text, 1 + doc_id % 3 AS a0, 1 + doc_id % 3 + doc_id % 6 AS b0, 5 + doc_id % 3 AS a1, 5 + doc_id % 3 + (doc_id + 1) % 6 AS b1 FROM documents),
 q AS (SELECT *, a1 > b0 AND b0 <= len(l) AND b1 <= len(l) AS valid, list_concat(list_concat(l[1:a0 - 1], ['PATCH', 'LINE']), l[b0 + 1:]) AS l1 FROM p)"""


def _patches(spark, d):
    p = F.struct(F.col("a").alias("pos"), F.col("a").alias("start"), F.col("b").alias("end"), F.lit("PATCH\nLINE").alias("contents"))
    return _ranges(spark, d).select("doc_id", p.alias("p")).groupBy("doc_id").agg(F.array_sort(F.collect_list("p")).alias("patches"))


@query("validate_patches", PATCHED + " SELECT doc_id, valid FROM q")
def _(spark, d):
    docs = V.table(spark, d, "documents").join(_patches(spark, d), "doc_id")
    return docs.select("doc_id", E.valid_patches(F.col("patches"), F.size(F.split("text", "\n", -1))).alias("valid"))


@query("edit_file_contents", PATCHED + " SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'stale' WHEN NOT valid THEN 'invalid' ELSE 'ok' END AS result, sha256(CASE WHEN doc_id % 5 <> 0 AND valid THEN array_to_string(list_concat(list_concat(l1[1:a1 - 1], ['PATCH', 'LINE']), l1[b1 + 1:]), chr(10)) ELSE text END) AS hash FROM q")
def _(spark, d):
    docs = V.table(spark, d, "documents")
    return E.apply_patches(docs.withColumn("expected_hash", F.when(F.col("doc_id") % 5 != 0, F.sha2("text", 256)).otherwise("stale")), _patches(spark, d)).select("doc_id", "result", F.sha2("new_text", 256).alias("hash"))


@query("delete_with_range_hashes", """r AS (SELECT doc_id, text, string_split(text, chr(10)) AS l, 1 + doc_id % 3 AS a, 1 + doc_id % 3 + doc_id % 4 AS b FROM documents),
 s AS (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'Content hash mismatch' WHEN doc_id % 11 = 0 THEN 'Missing required argument: ranges' WHEN b > len(l) THEN 'Invalid ranges' WHEN doc_id % 5 = 0 THEN 'Content hash mismatch for range ' || a || '-' || b END AS reason FROM r)
 SELECT doc_id, CASE WHEN reason IS NULL THEN 'ok' ELSE 'error' END AS result, reason, sha256(CASE WHEN reason IS NULL THEN array_to_string(list_concat(l[1:a - 1], l[b + 1:]), chr(10)) ELSE text END) AS hash FROM s""")
def _(spark, d):
    docs, i, lines = V.table(spark, d, "documents"), F.col("doc_id"), F.split("text", "\n", -1)
    a, b = (1 + i % 3).cast("int"), (1 + i % 3 + i % 4).cast("int")
    own = F.concat(F.array_join(F.slice(lines, a, b - a + 1), "\n"), F.when(b < F.size(lines), "\n").otherwise(""))
    ranges = docs.filter(i % 11 != 0).select("doc_id", a.alias("a"), b.alias("b"), F.when(i % 5 != 0, F.sha2(own, 256)).otherwise("other").alias("range_hash"))
    files = docs.select("doc_id", "text", F.when(i % 7 != 0, F.sha2("text", 256)).otherwise("other").alias("expected_hash"))
    return E.delete_checked(files, ranges).select("doc_id", "result", "reason", F.sha2("new_text", 256).alias("hash"))


@query("patch_request_validation", "SELECT doc_id, doc_id % 3 <> 0 AND doc_id % 5 >= 1 AND (doc_id % 4 = 0 OR doc_id % 7 >= doc_id % 5) AND doc_id % 2 = 1 AS valid FROM documents")
def _(spark, d):
    i = F.col("doc_id")
    return V.table(spark, d, "documents").select("doc_id", E.valid_patch_request(F.when(i % 3 != 0, "h").otherwise(""), i % 5, F.when(i % 4 != 0, i % 7), F.when(i % 2 == 1, "r")).alias("valid"))


@query("edit_result", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '{\"result\":\"error\",\"reason\":\"stale\"}' ELSE '{\"result\":\"ok\",\"hash\":\"' || sha256(text) || '\"}' END AS result FROM documents")
def _(spark, d):
    bad = F.col("doc_id") % 3 == 0
    s = F.struct(F.when(bad, "error").otherwise("ok").alias("result"), F.when(bad, "stale").alias("reason"), F.when(~bad, F.sha2("text", 256)).alias("hash"))
    return V.table(spark, d, "documents").select("doc_id", F.to_json(s).alias("result"))


@query("insert_request_validation", "r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN doc_id % 5 END AS before, CASE WHEN doc_id % 3 = 0 THEN doc_id % 7 END AS after FROM documents) SELECT doc_id, coalesce((before IS NULL) <> (after IS NULL) AND coalesce(before, after) >= 1, false) AS valid FROM r")
def _(spark, d):
    i = F.col("doc_id")
    r = V.table(spark, d, "documents").select("doc_id", F.when(i % 2 == 0, i % 5).alias("before"), F.when(i % 3 == 0, i % 7).alias("after"))
    return r.select("doc_id", E.valid_insert(F.col("before"), F.col("after")).alias("valid"))


@query("schema_sync_diff", "a AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), b AS (SELECT doc_id, unnest(string_split(replace(text, 'the', 'THE'), chr(10))) AS line FROM documents), x AS (SELECT doc_id, line, count(*) AS n FROM a GROUP BY ALL), y AS (SELECT doc_id, line, count(*) AS m FROM b GROUP BY ALL) SELECT doc_id, CAST(sum(greatest(coalesce(n, 0) - coalesce(m, 0), 0)) AS BIGINT) AS removed, CAST(sum(greatest(coalesce(m, 0) - coalesce(n, 0), 0)) AS BIGINT) AS added FROM x FULL JOIN y USING (doc_id, line) GROUP BY doc_id")
def _(spark, d):
    docs = V.table(spark, d, "documents")
    return E.line_diff(docs.select("doc_id", "text"), docs.select("doc_id", F.replace("text", F.lit("the"), F.lit("THE")).alias("text")))
