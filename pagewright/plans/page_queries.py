"""Queries on page labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import exprs as X
from pagewright.operators import layout as L
from pagewright.operators import pages as P
from pagewright.plans.layout_queries import RETYPE
from pagewright.plans.registry import query
from pagewright.sources import views as V
from pagewright.sources.views import BLOCKS_SQL, LABELS_SQL

TYPE = "CASE WHEN regexp_matches({0}, '^[0-9]+$') THEN 'integer' WHEN regexp_matches({0}, '^[ivxlcdm]+$') THEN 'roman_lower' WHEN regexp_matches({0}, '^[IVXLCDM]+$') THEN 'roman_upper' WHEN regexp_matches({0}, '^[A-Z]$') THEN 'letter' ELSE 'unknown' END"
DIGITS = [(1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")]


def roman_sql(n: str) -> str:
    out = []
    left = n
    for value, letters in DIGITS:
        out.append(f"repeat('{letters}', CAST(({left}) // {value} AS INTEGER))")
        left = f"({left}) % {value}"
    return " || ".join(out)


#: Values 0 .. 120 are enough for the labels of the views; the operator itself covers 1 .. 3999.
ROMANS = f"romans AS (SELECT v, {roman_sql('v')} AS r FROM (SELECT unnest(range(1, 121)) AS v))"


@query("detect_page_number_type", LABELS_SQL + f" SELECT doc_id, page_number, label, {TYPE.format('label')} AS kind FROM page_labels WHERE label IS NOT NULL")
def _(spark, d):
    return V.page_labels(spark, d).filter("label is not null").withColumn("kind", X.label_type(F.col("label")))


@query("looks_like_page_number", BLOCKS_SQL + ", w AS (SELECT doc_id, i, unnest(string_split(line, ' ')) AS word FROM lines) SELECT word, regexp_matches(word, '^([0-9]{1,2}|[ivxlcdmIVXLCDM]+|[A-Z])$') AS page_like, count(*) AS n FROM w WHERE word <> '' GROUP BY ALL")
def _(spark, d):
    w = V.table(spark, d, "documents").select(F.explode(F.split("text", "[ \\n]")).alias("word")).filter("word <> ''")
    return w.groupBy("word").agg(F.count("*").alias("n")).withColumn("page_like", X.like_page_number(F.col("word")))


@query("roman_numbers", f"{ROMANS.replace('121', '4000')} SELECT CAST(v AS BIGINT) AS v, r, CAST(v AS BIGINT) AS back FROM romans")
def _(spark, d):
    n = spark.range(1, 4000).select(F.col("id").alias("v"))
    return n.withColumn("r", X.to_roman(F.col("v"))).withColumn("back", X.from_roman(F.col("r")).cast("bigint"))


@query("increment_page_number", LABELS_SQL + "," + ROMANS.replace("121", "4000") + f""", typed AS (SELECT doc_id, page_number, label, {TYPE.format('label')} AS kind FROM page_labels WHERE label IS NOT NULL)
 SELECT doc_id, page_number, label, CASE kind WHEN 'integer' THEN CAST(CAST(label AS INTEGER) - 3 AS VARCHAR) WHEN 'roman_lower' THEN b.r WHEN 'roman_upper' THEN upper(b.r) WHEN 'letter' THEN CASE WHEN ascii(label) - 68 BETWEEN 0 AND 25 THEN chr(ascii(label) - 3) END END AS moved
 FROM typed LEFT JOIN romans a ON kind LIKE 'roman%' AND a.r = lower(label) LEFT JOIN romans b ON b.v = a.v - 3""")
def _(spark, d):
    return V.page_labels(spark, d).filter("label is not null").withColumn("moved", X.increment_label(F.col("label"), F.lit(-3)))


INTERPOLATED = LABELS_SQL + "," + ROMANS.replace("121", "4000") + f""",
typed AS (SELECT doc_id, page_number, label, {TYPE.format('label')} AS kind FROM page_labels WHERE label IS NOT NULL),
valued AS (SELECT t.doc_id, t.page_number, t.kind, CASE WHEN kind = 'integer' THEN CAST(label AS INTEGER) WHEN kind LIKE 'roman%' THEN CAST(v AS INTEGER) WHEN kind = 'letter' THEN ascii(label) - 65 END AS value FROM typed t LEFT JOIN romans ON kind LIKE 'roman%' AND r = lower(label) WHERE kind <> 'unknown'),
pairs AS (SELECT doc_id, kind, page_number AS p0, value AS v0, lead(page_number) OVER w AS p1, lead(value) OVER w AS v1, min(page_number) OVER (PARTITION BY doc_id, kind) AS first FROM valued WINDOW w AS (PARTITION BY doc_id, kind ORDER BY page_number)),
fills AS (SELECT doc_id, kind, first, p, CAST(v0 + round_even((p - p0) * (v1 - v0) / (p1 - p0), 0) AS INTEGER) AS value FROM (SELECT *, unnest(range(p0 + 1, p1)) AS p FROM pairs WHERE p1 - p0 > 1 AND v1 - v0 BETWEEN 1 AND 3 * (p1 - p0) AND (v1 - v0) / (p1 - p0) BETWEEN 0.8 AND 1.2)),
texts AS (SELECT doc_id, first, p, CASE WHEN kind = 'integer' THEN CAST(value AS VARCHAR) WHEN kind = 'roman_lower' THEN r WHEN kind = 'roman_upper' THEN upper(r) WHEN value BETWEEN 0 AND 25 THEN chr(value + 65) END AS filled FROM fills LEFT JOIN romans ON v = value),
best AS (SELECT doc_id, CAST(p AS INTEGER) AS page_number, arg_min(filled, first) AS filled FROM texts WHERE filled IS NOT NULL GROUP BY ALL),
interpolated AS (SELECT doc_id, page_number, coalesce(label, filled) AS label, label IS NULL AND filled IS NOT NULL AS interpolated FROM page_labels FULL JOIN best USING (doc_id, page_number))"""


@query("interpolate_page_numbers", INTERPOLATED + " SELECT * FROM interpolated")
def _(spark, d):
    return P.interpolate(V.page_labels(spark, d))


@query("attach_logical_page", INTERPOLATED + " SELECT b.doc_id, input_pos, b.page_number, label AS logical_page_number FROM blocks b LEFT JOIN interpolated l ON b.doc_id = l.doc_id AND b.page_number = l.page_number")
def _(spark, d):
    labels = P.interpolate(V.page_labels(spark, d)).select("doc_id", "page_number", F.col("label").alias("logical_page_number"))
    return V.blocks(spark, d).select("doc_id", "input_pos", "page_number").join(labels, ["doc_id", "page_number"], "left")


@query("mapped_counts", INTERPOLATED + " SELECT doc_id, count(*) FILTER (WHERE NOT interpolated AND label IS NOT NULL) AS before, count(label) AS after FROM interpolated GROUP BY doc_id")
def _(spark, d):
    return P.interpolate(V.page_labels(spark, d)).groupBy("doc_id").agg(F.count_if(~F.col("interpolated") & F.col("label").isNotNull()).alias("before"), F.count("label").alias("after"))


@query("map_lookup", LABELS_SQL + " SELECT doc_id, page_number, label AS found FROM page_labels")
def _(spark, d):
    """Labels as one map for each document, looked up by page."""
    p = V.page_labels(spark, d)
    m = p.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("page_number").cast("string").alias("k"), "label"))).alias("mapping"))
    return p.select("doc_id", "page_number").join(m, "doc_id").select("doc_id", "page_number", F.try_element_at("mapping", F.col("page_number").cast("string")).alias("found"))


@query("first_label_per_page", LABELS_SQL + " SELECT doc_id, page_number, arg_min(label, k) AS label FROM (SELECT *, k FROM page_labels, (SELECT unnest([1, 2]) AS k)) GROUP BY ALL")
def _(spark, d):
    b = V.page_labels(spark, d).select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    return b.groupBy("doc_id", "page_number").agg(F.min_by("label", "k").alias("label"))


EXPECTED = f"""expected AS (SELECT p AS page_number, CASE WHEN p BETWEEN 3 AND 7 THEN {roman_sql('p - 2')} WHEN p BETWEEN 9 AND 15 THEN upper({roman_sql('p - 8')}) WHEN p BETWEEN 17 AND 67 THEN CAST(p - 16 AS VARCHAR) WHEN p BETWEEN 68 AND 70 THEN chr(CAST(p - 3 AS INTEGER)) END AS expected FROM (SELECT unnest(range(1, 73)) AS p))"""


def _expected(spark):
    return P.expected_mapping(spark.range(1, 73).select(F.col("id").alias("page_number")))


@query("expected_page_mapping", EXPECTED + " SELECT CAST(page_number AS BIGINT) AS page_number, expected FROM expected")
def _(spark, d):
    return _expected(spark)


ACTUAL = "compared AS (SELECT page_number, expected, CASE WHEN page_number % 20 = 0 THEN 'x' ELSE expected END AS actual FROM expected)"


def _compared(spark):
    e = _expected(spark)
    return e.withColumn("actual", F.when(F.col("page_number") % 20 == 0, "x").otherwise(F.col("expected")))


@query("mapping_accuracy", EXPECTED + "," + ACTUAL + " SELECT count(*) FILTER (WHERE expected IS NOT DISTINCT FROM actual) AS correct, count(*) AS pages, round(avg(CASE WHEN expected IS NOT DISTINCT FROM actual THEN 100.0 ELSE 0 END), 6) AS accuracy FROM compared")
def _(spark, d):
    same = F.col("expected").eqNullSafe(F.col("actual"))
    return _compared(spark).agg(F.count_if(same).alias("correct"), F.count("*").alias("pages"), F.round(F.avg(F.when(same, 100.0).otherwise(0.0)), 6).alias("accuracy"))


@query("accuracy_by_section", EXPECTED + "," + ACTUAL + " SELECT s.k AS section, count(*) AS pages, count(*) FILTER (WHERE expected IS NOT DISTINCT FROM actual) AS correct FROM compared JOIN (VALUES (1,1,2),(2,3,7),(3,8,8),(4,9,15),(5,16,16),(6,17,67),(7,68,70),(8,71,72)) s(k, lo, hi) ON page_number BETWEEN lo AND hi GROUP BY ALL")
def _(spark, d):
    c = _compared(spark).withColumn("section", P.section_of(F.col("page_number")))
    return c.groupBy("section").agg(F.count("*").alias("pages"), F.count_if(F.col("expected").eqNullSafe(F.col("actual"))).alias("correct"))


@query("furniture_counts", BLOCKS_SQL + f" SELECT count(*) FILTER (WHERE t = 'Page header') AS headers, count(*) FILTER (WHERE t = 'Page footer') AS footers, count(*) FILTER (WHERE t = 'Page footer' AND type = 'Text' AND top = 740) AS low_footers FROM (SELECT *, {RETYPE} AS t FROM blocks)")
def _(spark, d):
    b = V.blocks(spark, d).withColumn("was", F.col("type"))
    b = L.retype_furniture(b)
    return b.agg(F.count_if(F.col("type") == X.HEADER).alias("headers"), F.count_if(F.col("type") == X.FOOTER).alias("footers"), F.count_if((F.col("type") == X.FOOTER) & (F.col("was") == "Text") & (F.col("top") == 740)).alias("low_footers"))


TRUTH = "judged AS (SELECT l.doc_id, toxic, d.n_chars, (d.n_chars % 3 = 0) AS flagged, text FROM labels l JOIN documents d USING (doc_id))"


def _judged(spark, d):
    return V.table(spark, d, "labels").join(V.table(spark, d, "documents"), "doc_id").withColumn("flagged", F.col("n_chars") % 3 == 0)


@query("picture_coverage_precision", TRUTH + " SELECT count(*) FILTER (WHERE flagged AND toxic = 1) AS detected, count(*) FILTER (WHERE NOT flagged AND toxic = 1) AS missed, count(*) FILTER (WHERE flagged AND toxic = 0) AS extra, round(100.0 * count(*) FILTER (WHERE flagged AND toxic = 1) / nullif(count(*) FILTER (WHERE toxic = 1), 0), 6) AS recall, round(100.0 * count(*) FILTER (WHERE flagged AND toxic = 1) / nullif(count(*) FILTER (WHERE flagged), 0), 6) AS precision FROM judged")
def _(spark, d):
    hit, f, t = F.col("flagged") & (F.col("toxic") == 1), F.col("flagged"), F.col("toxic") == 1
    a = _judged(spark, d).agg(F.count_if(hit).alias("detected"), F.count_if(~f & t).alias("missed"), F.count_if(f & ~t).alias("extra"))
    return a.select("*", F.round(F.try_divide(F.lit(100.0) * F.col("detected"), F.col("detected") + F.col("missed")), 6).alias("recall"), F.round(F.try_divide(F.lit(100.0) * F.col("detected"), F.col("detected") + F.col("extra")), 6).alias("precision"))


@query("detected_missed_false_positive", TRUTH + " SELECT doc_id, CASE WHEN flagged AND toxic = 1 THEN 'detected' WHEN toxic = 1 THEN 'missed' ELSE 'false_positive' END AS outcome FROM judged WHERE flagged OR toxic = 1")
def _(spark, d):
    j = _judged(spark, d)
    truth, told = j.filter("toxic = 1").select("doc_id"), j.filter("flagged").select("doc_id")
    part = lambda x, y, how, name: x.join(y, "doc_id", how).withColumn("outcome", F.lit(name))
    return part(truth, told, "left_semi", "detected").union(part(truth, told, "left_anti", "missed")).union(part(told, truth, "left_anti", "false_positive"))


@query("false_positive_profile", TRUTH + " SELECT CASE WHEN n_chars < 50 THEN 'short' WHEN n_chars < 200 THEN 'medium' ELSE 'long' END AS bucket, count(*) AS n FROM judged WHERE flagged AND toxic = 0 GROUP BY ALL")
def _(spark, d):
    bucket = F.when(F.col("n_chars") < 50, "short").when(F.col("n_chars") < 200, "medium").otherwise("long")
    return _judged(spark, d).filter("flagged and toxic = 0").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("known_false_positive_check", TRUTH + ", known AS (SELECT * FROM (VALUES ('idiot'), ('the of and the'), ('zzz')) k(phrase)) SELECT phrase, EXISTS (SELECT 1 FROM judged WHERE flagged AND contains(lower(text), phrase)) AS found FROM known")
def _(spark, d):
    known = spark.createDataFrame([("idiot",), ("the of and the",), ("zzz",)], "phrase string")
    j = _judged(spark, d).filter("flagged").select(F.lower("text").alias("low"))
    hits = j.join(F.broadcast(known), F.col("low").contains(F.col("phrase"))).select("phrase").distinct().withColumn("hit", F.lit(True))
    return known.join(hits, "phrase", "left").select("phrase", F.coalesce("hit", F.lit(False)).alias("found"))
