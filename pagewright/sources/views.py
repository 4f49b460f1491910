"""Views that give document tables the shape of page layouts, catalogues and trees.

Every view is a DataFrame here and a CTE of the same rows in SQL (for checking by another engine).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_WIDTH, PAGE_HEIGHT = 612.0, 792.0


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """One block for each line of a document, three to a page, with made-up geometry and types."""
    docs = table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    d, i, n = F.col("doc_id"), F.col("i"), F.length("line")
    slot = i % 3
    top = F.when(slot == 0, F.when(d % 2 == 0, 20.0).otherwise(90.0)).when(slot == 1, 150.0).otherwise(F.when(d % 3 == 0, 740.0).otherwise(640.0))
    height = F.when(slot == 1, F.least(F.lit(560.0), 24.0 * F.ceil(n / 80.0))).otherwise(40.0)
    text = F.when((d + i) % 11 == 0, "").when((d + i) % 7 == 0, F.replace("line", F.lit(" "), F.lit("\n"))).otherwise(F.col("line"))
    kind = F.when((d + i) % 13 == 0, "Picture").when((d + i) % 17 == 0, "Table").otherwise("Text")
    return docs.select(
        "doc_id", F.col("i").alias("input_pos"), (F.floor(i / 3) + 1).cast("int").alias("page_number"), F.lit(36.5).alias("left"), top.cast("double").alias("top"),
        F.least(F.lit(540.0), 6.0 * n + 0.25).alias("width"), height.cast("double").alias("height"), F.lit(PAGE_WIDTH).alias("page_width"), F.lit(PAGE_HEIGHT).alias("page_height"), text.alias("text"), kind.alias("type"),
    )


BLOCKS_SQL = """
lines AS (SELECT doc_id, CAST(u.i - 1 AS INTEGER) AS i, u.line AS line FROM (SELECT doc_id, unnest(list_zip(range(1, len(string_split(text, chr(10))) + 1), string_split(text, chr(10)))) AS z FROM documents) t, LATERAL (SELECT z[1] AS i, z[2] AS line) u),
blocks AS (SELECT doc_id, i AS input_pos, CAST(i // 3 + 1 AS INTEGER) AS page_number, CAST(36.5 AS DOUBLE) AS "left",
 CAST(CASE WHEN i % 3 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 20 ELSE 90 END WHEN i % 3 = 1 THEN 150 ELSE CASE WHEN doc_id % 3 = 0 THEN 740 ELSE 640 END END AS DOUBLE) AS top,
 CAST(least(540, 6 * length(line) + 0.25) AS DOUBLE) AS width, CAST(CASE WHEN i % 3 = 1 THEN least(560, 24 * ceil(length(line) / 80.0)) ELSE 40 END AS DOUBLE) AS height,
 CAST(612 AS DOUBLE) AS page_width, CAST(792 AS DOUBLE) AS page_height,
 CASE WHEN (doc_id + i) % 11 = 0 THEN '' WHEN (doc_id + i) % 7 = 0 THEN replace(line, ' ', chr(10)) ELSE line END AS text,
 CASE WHEN (doc_id + i) % 13 = 0 THEN 'Picture' WHEN (doc_id + i) % 17 = 0 THEN 'Table' ELSE 'Text' END AS type FROM lines)"""


def content_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks in document order with block_id = input position, truncated box, source and picture fields."""
    b = blocks(spark, folder)
    pic = F.col("type") == "Picture"
    key = F.concat_ws("/", F.lit("https://store.example.com/img"), F.col("doc_id").cast("string"), F.concat(F.col("input_pos").cast("string"), F.lit(".webp")))
    return b.select(
        "doc_id", F.col("input_pos").alias("block_id"), "page_number", F.when(F.col("page_number") > 1, (F.col("page_number") - 1).cast("string")).alias("page_logical"),
        F.col("left").alias("x1"), F.col("top").alias("y1"), (F.col("left") + F.col("width")).alias("x2"), (F.col("top") + F.col("height")).alias("y2"),
        F.col("type").alias("block_type"), F.col("text").alias("text_content"), F.when(pic, key).alias("storage_url"), F.when(pic & (F.col("input_pos") % 2 == 0), F.concat(F.lit("picture <"), F.col("input_pos").cast("string"), F.lit("> & \"more\""))).alias("description"),
        F.when(F.col("type") != "Text", F.concat(F.lit("caption "), F.col("input_pos").cast("string"))).alias("caption"),
    )


CONTENT_SQL = BLOCKS_SQL + """,
content_blocks AS (SELECT doc_id, input_pos AS block_id, page_number, CASE WHEN page_number > 1 THEN CAST(page_number - 1 AS VARCHAR) END AS page_logical,
 "left" AS x1, top AS y1, "left" + width AS x2, top + height AS y2, type AS block_type, text AS text_content,
 CASE WHEN type = 'Picture' THEN 'https://store.example.com/img/' || doc_id || '/' || input_pos || '.webp' END AS storage_url,
 CASE WHEN type = 'Picture' AND input_pos % 2 = 0 THEN 'picture <' || input_pos || '> & "more"' END AS description,
 CASE WHEN type <> 'Text' THEN 'caption ' || input_pos END AS caption FROM blocks)"""


def rects(spark: SparkSession, folder: str) -> DataFrame:
    """Rectangles of images and drawings, most of them inside a block of their page."""
    b = blocks(spark, folder).select("doc_id", "page_number", F.col("input_pos").alias("i"), F.col("top").cast("int").alias("t"))
    img = b.filter((F.col("doc_id") + F.col("i")) % 5 == 0).select("doc_id", "page_number", F.lit("image").alias("kind"), *_corners(F.lit(38) + F.when((F.col("doc_id") + F.col("i")) % 10 == 5, 600).otherwise(0), F.col("t") + 1, F.lit(4), F.lit(5)))
    draws = b.filter((F.col("doc_id") + F.col("i")) % 3 == 0).select("*", F.explode(F.sequence(F.lit(0), F.col("i") % 4)).alias("k"))
    wide = F.col("k") % 2 == 0
    draws = draws.select("doc_id", "page_number", F.lit("drawing").alias("kind"), *_corners(F.lit(38) + F.col("k") * 3, F.col("t") + 2, F.when(wide, 30).otherwise(6), F.when(wide, 1).otherwise(4)))
    return img.unionByName(draws)


def _corners(x, y, w, h):
    return x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + w).cast("double").alias("x1"), (y + h).cast("double").alias("y1")


RECTS_SQL = BLOCKS_SQL + """,
rects AS (SELECT doc_id, page_number, 'image' AS kind, CAST(x AS DOUBLE) AS x0, CAST(y AS DOUBLE) AS y0, CAST(x + 4 AS DOUBLE) AS x1, CAST(y + 5 AS DOUBLE) AS y1
 FROM (SELECT doc_id, page_number, 38 + CASE WHEN (doc_id + input_pos) % 10 = 5 THEN 600 ELSE 0 END AS x, CAST(top AS INTEGER) + 1 AS y FROM blocks WHERE (doc_id + input_pos) % 5 = 0)
 UNION ALL SELECT doc_id, page_number, 'drawing', CAST(38 + k * 3 AS DOUBLE), CAST(y AS DOUBLE), CAST(38 + k * 3 + CASE WHEN k % 2 = 0 THEN 30 ELSE 6 END AS DOUBLE), CAST(y + CASE WHEN k % 2 = 0 THEN 1 ELSE 4 END AS DOUBLE)
 FROM (SELECT doc_id, page_number, CAST(top AS INTEGER) + 2 AS y, unnest(range(0, input_pos % 4 + 1)) AS k FROM blocks WHERE (doc_id + input_pos) % 3 = 0))"""


def page_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Printed page labels: roman first, then numbers, then letters; every third is missing."""
    from pagewright.functions.exprs import to_roman

    p = blocks(spark, folder).select("doc_id", "page_number").distinct()
    n, d = F.col("page_number"), F.col("doc_id")
    label = F.when(n <= 4, to_roman(n)).when((n > 12) & (d % 5 == 0) & (n <= 30), F.char(52 + n)).otherwise((n - 4).cast("string"))
    return p.select("doc_id", "page_number", F.when(n % 3 != 0, label).alias("label"))


LABELS_SQL = BLOCKS_SQL + """,
page_labels AS (SELECT doc_id, page_number, CASE WHEN page_number % 3 <> 0 THEN CASE WHEN page_number <= 4 THEN ['i', 'ii', 'iii', 'iv'][page_number]
 WHEN page_number > 12 AND doc_id % 5 = 0 AND page_number <= 30 THEN chr(52 + page_number) ELSE CAST(page_number - 4 AS VARCHAR) END END AS label
 FROM (SELECT DISTINCT doc_id, page_number FROM blocks))"""


def spans(spark: SparkSession, folder: str) -> DataFrame:
    """Styled spans: the first three words of a block that has as many, with flags 16 (bold) and 2 (italic)."""
    b = blocks(spark, folder).select("doc_id", "page_number", "input_pos", F.slice(F.split("text", "[ \\n]"), 1, 3).alias("w")).filter(F.size("w") == 3)
    k = (F.col("doc_id") + F.col("input_pos")) % 4
    return b.select("doc_id", "page_number", F.col("input_pos").alias("span_pos"), F.array_join("w", " ").alias("text"), F.when(k == 0, 16).when(k == 1, 2).when(k == 2, 18).otherwise(0).alias("flags"))


SPANS_SQL = BLOCKS_SQL + """,
spans AS (SELECT doc_id, page_number, input_pos AS span_pos, array_to_string(w, ' ') AS text, CAST(CASE (doc_id + input_pos) % 4 WHEN 0 THEN 16 WHEN 1 THEN 2 WHEN 2 THEN 18 ELSE 0 END AS INTEGER) AS flags
 FROM (SELECT doc_id, page_number, input_pos, list_slice(regexp_split_to_array(text, '[ \\n]'), 1, 3) AS w FROM blocks) WHERE len(w) = 3)"""


def publications(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "documents").groupBy("source").agg(F.min("doc_id").alias("publication_id"))
    p = F.col("publication_id")
    return s.select(
        "publication_id", F.concat(F.lit(" Report "), "source", F.lit(" ")).alias("title"), F.when(p % 3 != 0, F.concat(F.lit("Author "), p.cast("string"))).otherwise("  ").alias("authors"),
        F.date_add(F.lit("2010-01-15").cast("date"), (p * 97).cast("int")).alias("publication_date"), F.upper("source").alias("source"),
        F.when(p % 2 == 0, F.concat(F.lit("https://pub.example.com/"), p.cast("string"))).alias("source_url"), F.concat(F.lit("https://uri.example.com/"), p.cast("string")).alias("uri"),
    )


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """document rows: publication, type, storage url, file size, version."""
    d = table(spark, folder, "documents")
    p = d.groupBy("source").agg(F.min("doc_id").alias("publication_id"))
    i = F.col("doc_id")
    return d.join(p, "source").select(
        i.alias("document_id"), "publication_id", F.when(i % 4 == 0, "MAIN").when(i % 4 == 1, "SUPPLEMENTAL").otherwise("OTHER").alias("type"),
        F.when(i % 3 != 0, F.concat(F.lit("https://bucket.s3.example.com/pub_"), F.col("publication_id").cast("string"), F.lit("/doc_"), i.cast("string"), F.lit(".pdf"))).alias("storage_url"),
        F.when(i % 5 == 0, F.concat(F.lit("v"), (i % 7).cast("string"))).alias("version"), F.concat(F.lit("Volume "), (i % 9).cast("string")).alias("description"), F.length("text").cast("long").alias("file_size"),
    )


CATALOGUE_SQL = """
pub_keys AS (SELECT source, min(doc_id) AS publication_id FROM documents GROUP BY source),
publications AS (SELECT publication_id, ' Report ' || source || ' ' AS title, CASE WHEN publication_id % 3 <> 0 THEN 'Author ' || publication_id ELSE '  ' END AS authors,
 CAST(DATE '2010-01-15' + CAST(publication_id * 97 AS INTEGER) AS DATE) AS publication_date, upper(source) AS source,
 CASE WHEN publication_id % 2 = 0 THEN 'https://pub.example.com/' || publication_id END AS source_url, 'https://uri.example.com/' || publication_id AS uri FROM pub_keys),
catalogue AS (SELECT doc_id AS document_id, publication_id, CASE WHEN doc_id % 4 = 0 THEN 'MAIN' WHEN doc_id % 4 = 1 THEN 'SUPPLEMENTAL' ELSE 'OTHER' END AS type,
 CASE WHEN doc_id % 3 <> 0 THEN 'https://bucket.s3.example.com/pub_' || publication_id || '/doc_' || doc_id || '.pdf' END AS storage_url,
 CASE WHEN doc_id % 5 = 0 THEN 'v' || (doc_id % 7) END AS version, 'Volume ' || (doc_id % 9) AS description, CAST(length(text) AS BIGINT) AS file_size FROM documents JOIN pub_keys USING (source))"""


def nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Trees as adjacency rows: a section for each page; its blocks below it, every fourth as a list item in a list of its own.

    Ids are doc_id * 1_000_000 + a number inside the document; path lists the ids from the root.
    """
    b = blocks(spark, folder)
    base, page, i = F.col("doc_id") * 1_000_000, F.col("page_number"), F.col("input_pos")
    sect = b.select("doc_id", "page_number").distinct().select("doc_id", (base + page * 10).alias("node_id"), F.lit(None).cast("long").alias("parent_id"), (page - 1).cast("int").alias("seq"), F.lit("section").alias("tag"), F.lit(None).cast("string").alias("text_content"), F.lit(None).cast("string").alias("description"), page.alias("page_number"), F.array(base + page * 10).alias("path"))
    item = i % 4 == 3
    own, up, mid = base + 500_000 + i, base + page * 10, base + 800_000 + i
    tag = F.when(item, "li").when(F.col("type") == "Picture", "img").when(F.col("type") == "Table", "table").otherwise("p")
    leaf = b.select("doc_id", own.alias("node_id"), F.when(item, mid).otherwise(up).alias("parent_id"), F.when(item, 0).otherwise(i % 3).cast("int").alias("seq"), tag.alias("tag"), F.when(tag != "img", F.col("text")).alias("text_content"), F.when(tag == "img", F.concat(F.lit("picture "), i.cast("string"))).alias("description"), page.alias("page_number"), F.when(item, F.array(up, mid, own)).otherwise(F.array(up, own)).alias("path"))
    lists = b.filter(item).select("doc_id", mid.alias("node_id"), up.alias("parent_id"), (i % 3).cast("int").alias("seq"), F.lit("ul").alias("tag"), F.lit(None).cast("string").alias("text_content"), F.lit(None).cast("string").alias("description"), page.alias("page_number"), F.array(up, mid).alias("path"))
    return sect.unionByName(leaf).unionByName(lists)


NODES_SQL = BLOCKS_SQL + """,
nodes AS (SELECT doc_id, doc_id * 1000000 + page_number * 10 AS node_id, CAST(NULL AS BIGINT) AS parent_id, CAST(page_number - 1 AS INTEGER) AS seq, 'section' AS tag, CAST(NULL AS VARCHAR) AS text_content, CAST(NULL AS VARCHAR) AS description, page_number, [doc_id * 1000000 + page_number * 10] AS path FROM (SELECT DISTINCT doc_id, page_number FROM blocks)
 UNION ALL SELECT doc_id, own, CASE WHEN item THEN mid ELSE up END, CAST(CASE WHEN item THEN 0 ELSE input_pos % 3 END AS INTEGER), tag, CASE WHEN tag <> 'img' THEN text END, CASE WHEN tag = 'img' THEN 'picture ' || input_pos END, page_number, CASE WHEN item THEN [up, mid, own] ELSE [up, own] END
 FROM (SELECT *, doc_id * 1000000 + 500000 + input_pos AS own, doc_id * 1000000 + page_number * 10 AS up, doc_id * 1000000 + 800000 + input_pos AS mid, input_pos % 4 = 3 AS item, CASE WHEN input_pos % 4 = 3 THEN 'li' WHEN type = 'Picture' THEN 'img' WHEN type = 'Table' THEN 'table' ELSE 'p' END AS tag FROM blocks)
 UNION ALL SELECT doc_id, doc_id * 1000000 + 800000 + input_pos, doc_id * 1000000 + page_number * 10, CAST(input_pos % 3 AS INTEGER), 'ul', NULL, NULL, page_number, [doc_id * 1000000 + page_number * 10, doc_id * 1000000 + 800000 + input_pos] FROM blocks WHERE input_pos % 4 = 3)"""
