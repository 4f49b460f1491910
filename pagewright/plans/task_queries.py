"""Queries on model tasks: responses, right and wrong ones, are made up from ids; the SQL names what each kind must lead to."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.operators import tasks as K
from pagewright.plans.registry import query
from pagewright.sources import views as V

# every document is a request of n blocks; one in ten has no response yet, the others have one to three
REQUESTS = """req AS (SELECT doc_id AS request_key, len(string_split(text, chr(10))) AS n FROM documents),
att AS (SELECT request_key, n, CAST(a AS INTEGER) AS attempt FROM req, (SELECT unnest([1, 2, 3]) AS a) WHERE request_key % 10 <> 9 AND a <= 1 + request_key % 3)"""
SETTLED = """, g AS (SELECT request_key, min(attempt) FILTER (WHERE error IS NULL) AS ok, count(*) AS k FROM r GROUP BY ALL),
f AS (SELECT request_key, count(*) AS n_failed, arg_max(error, attempt) AS error FROM r JOIN g USING (request_key) WHERE error IS NOT NULL AND (ok IS NULL OR attempt < ok) GROUP BY ALL)
SELECT q.request_key, CASE WHEN ok IS NOT NULL THEN 'ok' WHEN k IS NULL THEN 'open' ELSE '{failed}' END AS status, CASE WHEN ok IS NOT NULL THEN r.result WHEN k IS NOT NULL THEN {stand_in} END AS result, CAST(coalesce(n_failed, 0) AS INTEGER) AS n_failed, f.error
FROM req q LEFT JOIN g USING (request_key) LEFT JOIN f USING (request_key) LEFT JOIN r ON r.request_key = q.request_key AND r.attempt = ok"""


def settled(kinds: str, failed: str = "failed", stand_in: str = "NULL") -> str:
    """kinds: SQL of (error, result) by `c`, the kind of a response."""
    return f"{REQUESTS}, r AS (SELECT request_key, attempt, {kinds} FROM (SELECT *, (request_key * 7 + attempt * 3) % 8 AS c FROM att))" + SETTLED.format(failed=failed, stand_in=stand_in)


def _requests(spark, d):
    return V.table(spark, d, "documents").select(F.col("doc_id").alias("request_key"), F.size(F.split("text", "\n", -1)).alias("n"))


def _responses(spark, d, kinds):
    """kinds: responses by kind, texts or columns; the last stands for all further kinds."""
    a = _requests(spark, d).filter("request_key % 10 <> 9").withColumn("attempt", F.explode(F.array(*[F.lit(k) for k in (1, 2, 3)]))).filter("attempt <= 1 + request_key % 3")
    kinds = [F.lit(x) if isinstance(x, str) else x for x in kinds]
    c, out = (F.col("request_key") * 7 + F.col("attempt") * 3) % 8, kinds[-1]
    for k, x in reversed(list(enumerate(kinds[:-1]))):
        out = F.when(c == k, x).otherwise(out)
    return a.select("request_key", "attempt", out.alias("response"))


def text(*parts):
    """Parts put together: strings as they are, one-string tuples as expressions over the columns of a request."""
    return F.concat(*[F.expr(p[0]).cast("string") if isinstance(p, tuple) else F.lit(p) for p in parts])


MAPPING = ['```json\n{"mapping": {"1": null, "2": "i"}}\n```', '{"mapping": {"1": 3}}', '{"other": 1}', "no page has a number", '{"mapping": {"7": "C"}}']
MAPPING_SQL = "CASE c WHEN 1 THEN 'a label is no text' WHEN 2 THEN 'no mapping' WHEN 3 THEN 'no JSON' END AS error, CASE WHEN c = 0 THEN '{\"1\":null,\"2\":\"i\"}' WHEN c > 3 THEN '{\"7\":\"C\"}' END AS result"


@query("page_mapper", settled(MAPPING_SQL))
def _(spark, d):
    return K.settle(_requests(spark, d), _responses(spark, d, MAPPING), K.page_mapping).drop("n")


@query("page_mapper_retries", f"""{REQUESTS}, r AS (SELECT request_key, attempt, {MAPPING_SQL} FROM (SELECT *, (request_key * 7 + attempt * 3) % 8 AS c FROM att))
 SELECT request_key, CAST(count(*) + 1 AS INTEGER) AS attempt, 'Your previous response had a validation error: ' || arg_max(error, attempt) || '. Please correct your response to match the required schema and constraints.' AS message FROM r GROUP BY request_key HAVING bool_and(error IS NOT NULL) AND count(*) < 3""")
def _(spark, d):
    return K.retries(_requests(spark, d), _responses(spark, d, MAPPING), K.page_mapping)


@query("block_type_classifier", settled("CASE WHEN c IN (1, 2) THEN 'classification is none of the classes' END AS error, CASE WHEN c = 0 THEN 'table' WHEN c > 2 THEN 'picture' END AS result"))
def _(spark, d):
    kinds = [text('{"reason": "rows", "classification": "table"}'), text('{"reason": "art", "classification": "pic"}'), text("picture"), text('```json\n{"classification": "picture"}\n```')]
    return K.settle(_requests(spark, d), _responses(spark, d, kinds), lambda r: K.one_of(r, "classification", K.BLOCK_CLASSES)).drop("n")


@query("image_description", settled("CASE WHEN c IN (1, 2, 3) THEN 'no label or description' END AS error, CASE WHEN c = 0 THEN 'map: rivers' WHEN c > 3 THEN 'chart: prices by year' END AS result"))
def _(spark, d):
    kinds = [text('{"label": "map", "description": "rivers"}'), text('{"label": "painting", "description": "x"}'), text('{"label": "map"}'), text("[1]"), text('{"label": "chart", "description": "prices by year"}')]
    return K.settle(_requests(spark, d), _responses(spark, d, kinds), K.image_description).drop("n")


@query("top_level_structure", settled("""CASE WHEN c = 1 AND n > 1 THEN 'duplicate ids' WHEN c = 1 THEN 'duplicate ids' WHEN c = 2 THEN 'coverage' WHEN c = 3 THEN 'no JSON of three ranges' WHEN c = 4 THEN 'Non-numeric value' WHEN c = 5 THEN 'no JSON of three ranges' END AS error,
 CASE WHEN c = 0 OR c > 5 THEN CASE WHEN n >= 3 THEN '{"header":"0","main":"1-' || (n - 2) || '","footer":"' || (n - 1) || '"}' ELSE '{"header":"","main":"0-' || (n - 1) || '","footer":""}' END END AS result"""))
def _(spark, d):
    good = F.when(F.col("n") >= 3, text('{"header": "0", "main": "1-', ("n - 2",), '", "footer": "', ("n - 1",), '"}')).otherwise(text('{"header": "", "main": "0-', ("n - 1",), '", "footer": ""}'))
    kinds = [good, text('{"header": "0", "main": "0-', ("n - 1",), '", "footer": ""}'), text('{"header": "", "main": "0-', ("n",), '", "footer": ""}'), text('{"header": "", "main": "0"}'), text('{"header": "", "main": "x", "footer": ""}'), text("```json\n{\"header\"\n```"), good]
    q = _requests(spark, d)
    return K.settle(q, _responses(spark, d, kinds), lambda r: K.top_level_structure(r, F.col("n"))).drop("n")


GROUPS_SQL = """CASE c WHEN 2 THEN 'no JSON of groups' WHEN 3 THEN 'coverage' WHEN 4 THEN 'duplicate ids' WHEN 5 THEN 'range or tag' WHEN 6 THEN 'range or tag' WHEN 7 THEN 'Start after end' END AS error,
 CASE WHEN c < 2 THEN CASE WHEN n >= 2 THEN '[{"range":"0-' || (n // 2 - 1) || '","tag":"section"},{"range":"' || (n // 2) || '-' || (n - 1) || '"}]' ELSE '[{"range":"0"}]' END END AS result"""


def _groups(spark, d):
    good = F.when(F.col("n") >= 2, text('{"groups": [{"range": "0-', ("n div 2 - 1",), '", "tag": "section"}, {"range": "', ("n div 2",), "-", ("n - 1",), '"}]}')).otherwise(text('{"groups": [{"range": "0", "tag": null}]}'))
    kinds = [good, good, text("{groups}"), text('{"groups": [{"range": "0-', ("n",), '"}]}'), text('{"groups": [{"range": "0-', ("n - 1",), '"}, {"range": "0"}]}'), text('{"groups": [{"range": "a-b"}]}'), text('{"groups": [{"range": "0-', ("n - 1",), '", "tag": "div"}]}'), text('{"groups": [{"range": "5-1"}]}')]
    line = lambda i: F.concat(F.lit('<p id="'), i.cast("string"), F.lit('">x</p>'))
    q = _requests(spark, d).withColumn("html", F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), line), "\n"))
    return K.settle(q, _responses(spark, d, kinds), lambda r: K.split_groups(r, F.col("n"), F.col("html")))


@query("html_splitter", settled(GROUPS_SQL))
def _(spark, d):
    return _groups(spark, d).drop("n", "html")


@query("process_top_level_structure", f"""{REQUESTS}, r AS (SELECT request_key, n, attempt, {GROUPS_SQL} FROM (SELECT *, (request_key * 7 + attempt * 3) % 8 AS c FROM att)), ok AS (SELECT request_key, any_value(n) AS n FROM r WHERE error IS NULL GROUP BY ALL),
 l AS (SELECT request_key, n, unnest(range(0, n)) AS i FROM ok), s AS (SELECT request_key, CASE WHEN n >= 2 AND i >= n // 2 THEN 1 ELSE 0 END AS section, n, string_agg('<p id="' || i || '">x</p>', chr(10) ORDER BY i) AS inner_html FROM l GROUP BY ALL)
 SELECT request_key, CAST(section AS INTEGER) AS section, CASE WHEN n >= 2 AND section = 0 THEN 'section' END AS tag, sha256(CASE WHEN n >= 2 AND section = 0 THEN '<section>' || chr(10) || inner_html || chr(10) || '</section>' ELSE inner_html END) AS html_sha256 FROM s""")
def _(spark, d):
    return K.sections(_groups(spark, d), "html").select("request_key", "section", "tag", F.sha2("html", 256).alias("html_sha256"))


@query("html_parser", settled("CASE c WHEN 1 THEN 'empty' WHEN 2 THEN 'data-sources' WHEN 3 THEN 'no JSON' END AS error, CASE WHEN c = 0 OR c > 3 THEN '<p data-sources=\"0-3, 5\">x</p>' END AS result", "fallback", "'<p>' || q.n || '</p>'"))
def _(spark, d):
    kinds = [text('{"html": "<p data-sources=\\"0-3, 5\\">x</p>"}'), text('{"html": "  "}'), text('{"html": "<p data-sources=\\"all\\">x</p>"}'), text("<p>x</p>"), text('```json\n{"html": "<p data-sources=\\"0-3, 5\\">x</p>"}\n```')]
    return K.settle(_requests(spark, d), _responses(spark, d, kinds), K.restructured_html, text("<p>", ("n",), "</p>")).drop("n")


@query("agent_session_output", """j AS (SELECT doc_id AS job_id, text FROM documents) SELECT job_id, CASE WHEN job_id % 3 <> 0 THEN substr(text, 1, 20) END AS content,
 CASE WHEN job_id % 3 = 0 THEN 'no file output.html; files: ' || CASE WHEN job_id % 2 = 0 THEN 'input.html, notes.txt' ELSE 'input.html' END END AS error FROM j""")
def _(spark, d):
    docs = V.table(spark, d, "documents").withColumnRenamed("doc_id", "job_id")
    f = lambda path, content, when: F.when(when, F.struct(F.lit(path).alias("path"), content.alias("content")))
    own = F.array_compact(F.array(f("input.html", F.col("text"), F.lit(True)), f("output.html", F.substring("text", 1, 20), F.col("job_id") % 3 != 0), f("notes.txt", F.lit("n"), F.col("job_id") % 2 == 0)))
    files = docs.select("job_id", F.explode(own).alias("f")).select("job_id", "f.path", "f.content")
    return K.job_output(docs.select("job_id", F.lit("output.html").alias("output")), files)
