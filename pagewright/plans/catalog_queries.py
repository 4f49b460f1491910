"""Queries on the catalogue, the object store, backlogs and the hand-off to models."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.functions import exprs as X
from pagewright.operators import catalog as C
from pagewright.operators import embed as M
from pagewright.operators import provider as R
from pagewright.plans.layout_queries import strip_sql
from pagewright.plans.registry import query
from pagewright.sources import views as V
from pagewright.sources.views import CATALOGUE_SQL, CONTENT_SQL, NODES_SQL

DONE = "done AS (SELECT DISTINCT doc_id AS document_id FROM labels), files AS (SELECT doc_id AS document_id, unnest(CASE doc_id % 6 WHEN 0 THEN ['blocks'] WHEN 1 THEN ['blocks', 'html'] WHEN 2 THEN ['blocks', 'html', 'approved'] WHEN 3 THEN ['html', 'approved'] WHEN 4 THEN ['layout'] ELSE [] END) AS kind FROM documents)"


def _missing(spark, d):
    return C.unprocessed(V.catalogue(spark, d).select("document_id"), V.table(spark, d, "labels").select(F.col("doc_id").alias("document_id")))


def _files(spark, d):
    k = F.col("doc_id") % 6
    arr = lambda *x: F.array(*[F.lit(v) for v in x])
    kinds = F.when(k == 0, arr("blocks")).when(k == 1, arr("blocks", "html")).when(k == 2, arr("blocks", "html", "approved")).when(k == 3, arr("html", "approved")).when(k == 4, arr("layout"))
    return V.table(spark, d, "documents").select(F.col("doc_id").alias("document_id"), F.explode(kinds).alias("kind"))


@query("unprocessed_documents", DONE + " SELECT doc_id AS document_id FROM documents WHERE doc_id NOT IN (SELECT document_id FROM done)")
def _(spark, d):
    return _missing(spark, d)


def _has(kind: str) -> str:
    return f"EXISTS (SELECT 1 FROM files f WHERE f.document_id = d.doc_id AND kind = '{kind}')"


MISSING = "FROM documents d WHERE doc_id NOT IN (SELECT document_id FROM done)"


@query("eligible_documents_html", DONE + f" SELECT doc_id AS document_id {MISSING} AND {_has('blocks')} AND NOT {_has('approved')}")
def _(spark, d):
    return C.eligible(_missing(spark, d), _files(spark, d), ["blocks"], ["approved"])


@query("eligible_documents_nodes", DONE + f" SELECT doc_id AS document_id {MISSING} AND {_has('blocks')} AND {_has('html')} AND {_has('approved')}")
def _(spark, d):
    return C.eligible(_missing(spark, d), _files(spark, d), ["blocks", "html", "approved"], [])


@query("eligible_documents_blocks", DONE + f" SELECT doc_id AS document_id {MISSING} AND NOT {_has('blocks')}")
def _(spark, d):
    return C.eligible(_missing(spark, d), _files(spark, d), [], ["blocks"])


@query("batch_limit", DONE + f" SELECT doc_id AS document_id {MISSING} ORDER BY doc_id LIMIT 200")
def _(spark, d):
    return C.batch_limit(_missing(spark, d), 200)


@query("download_document", CATALOGUE_SQL + "," + DONE + " SELECT c.document_id, storage_url, CASE WHEN f.document_id IS NOT NULL THEN replace(storage_url, '.pdf', '.json') END AS layout_path FROM catalogue c LEFT JOIN (SELECT document_id FROM files WHERE kind = 'layout') f ON c.document_id = f.document_id")
def _(spark, d):
    f = _files(spark, d).filter("kind = 'layout'").select("document_id", F.lit(True).alias("there"))
    c = V.catalogue(spark, d).select("document_id", "storage_url").join(f, "document_id", "left")
    return c.select("document_id", "storage_url", F.when(F.col("there"), F.replace("storage_url", F.lit(".pdf"), F.lit(".json"))).alias("layout_path"))


@query("scan_catalog_tables", CATALOGUE_SQL + " SELECT type, count(*) AS n, count(storage_url) AS stored, CAST(sum(file_size) AS BIGINT) AS bytes FROM catalogue GROUP BY type")
def _(spark, d):
    return V.catalogue(spark, d).groupBy("type").agg(F.count("*").alias("n"), F.count("storage_url").alias("stored"), F.sum("file_size").alias("bytes"))


@query("publication_title_for_document", CATALOGUE_SQL + " SELECT document_id, title FROM catalogue JOIN publications USING (publication_id)")
def _(spark, d):
    return C.publication_of(V.catalogue(spark, d), V.publications(spark, d))


CLEAN = "nullif(trim({0}, ' '), '')"


@query("citation", CATALOGUE_SQL + f""", v AS (SELECT publication_id, arg_min(version, (CASE WHEN type = 'MAIN' THEN 0 ELSE 1 END) * 1000000000 + document_id) AS version FROM catalogue WHERE version IS NOT NULL GROUP BY ALL)
 SELECT publication_id, concat_ws(' ', nullif(concat_ws(' ', {CLEAN.format('authors')}, '(' || year(publication_date) || ')'), '') || '.', {CLEAN.format('title')} || '.', {CLEAN.format('source')} || '.', 'Version ' || version || '.', coalesce(source_url, uri)) AS citation FROM publications LEFT JOIN v USING (publication_id)""")
def _(spark, d):
    return C.citations(V.publications(spark, d), V.catalogue(spark, d))


@query("strip_or_null", CATALOGUE_SQL + f" SELECT publication_id, {CLEAN.format('authors')} AS authors, {CLEAN.format('title')} AS title FROM publications")
def _(spark, d):
    return V.publications(spark, d).select("publication_id", X.strip_or_null(F.col("authors")).alias("authors"), X.strip_or_null(F.col("title")).alias("title"))


@query("object_key_parse_storage_url", CATALOGUE_SQL + " SELECT document_id, 'pub_' || publication_id || '/doc_' || document_id || '.pdf' AS made, CASE WHEN storage_url IS NOT NULL THEN 'bucket' END AS bucket, CASE WHEN storage_url IS NOT NULL THEN 'pub_' || publication_id || '/doc_' || document_id || '.pdf' END AS key, CASE WHEN storage_url IS NOT NULL THEN 'pub_' || publication_id || '/doc_' || document_id || '.json' END AS layout_key FROM catalogue")
def _(spark, d):
    c = V.catalogue(spark, d).select("document_id", X.object_key(F.col("publication_id"), F.col("document_id")).alias("made"), X.storage_parts(F.col("storage_url")).alias("p"))
    return c.select("document_id", "made", "p.bucket", "p.key", "p.layout_key")


@query("validate_url", "SELECT url, regexp_matches(url, '^https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[^ ]*)?$') AS valid FROM pages")
def _(spark, d):
    return V.table(spark, d, "pages").select("url", X.valid_url(F.col("url")).alias("valid"))


@query("put_image_put_json", CONTENT_SQL + " SELECT doc_id, block_id, 'https://b.s3.eu-west-1.amazonaws.com/doc_' || doc_id || '/images/' || block_id || '.webp' AS url FROM content_blocks WHERE block_type = 'Picture'")
def _(spark, d):
    b = V.content_blocks(spark, d).filter("block_type = 'Picture'")
    return b.select("doc_id", "block_id", F.format_string("https://%s.s3.%s.amazonaws.com/doc_%s/images/%s.webp", F.lit("b"), F.lit("eu-west-1"), F.col("doc_id"), F.col("block_id")).alias("url"))


@query("sync_up", DONE + " SELECT document_id, kind, 'doc_' || document_id || CASE kind WHEN 'html' THEN '.html' WHEN 'blocks' THEN '_content_blocks.json' ELSE '.bin' END AS key, CASE kind WHEN 'html' THEN 'text/html' WHEN 'blocks' THEN 'application/json' ELSE 'application/octet-stream' END AS mime FROM files")
def _(spark, d):
    name = F.concat(F.lit("doc_"), F.col("document_id").cast("string"), F.when(F.col("kind") == "html", ".html").when(F.col("kind") == "blocks", "_content_blocks.json").otherwise(".bin"))
    return _files(spark, d).select("document_id", "kind", name.alias("key")).withColumn("mime", X.mime_type(F.col("key")))


@query("sync_down", DONE + " SELECT document_id, kind FROM files f WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.document_id AND l.quality = 1)")
def _(spark, d):
    local = V.table(spark, d, "labels").filter("quality = 1").select(F.col("doc_id").alias("document_id"))
    return _files(spark, d).join(local, "document_id", "left_anti")


@query("list_object_store", DONE + " SELECT kind, count(*) AS n FROM files WHERE kind <> 'approved' GROUP BY kind")
def _(spark, d):
    return _files(spark, d).filter("kind <> 'approved'").groupBy("kind").agg(F.count("*").alias("n"))


@query("mixed_existence_checks", DONE + " SELECT document_id, count(*) AS n, bool_or(kind = 'approved') AS approved FROM files GROUP BY document_id")
def _(spark, d):
    return _files(spark, d).groupBy("document_id").agg(F.count("*").alias("n"), F.bool_or(F.col("kind") == "approved").alias("approved"))


@query("crop_and_store_image", CONTENT_SQL + " SELECT doc_id, block_id, CASE WHEN block_type = 'Picture' THEN 'doc_' || doc_id || '/images/' || block_id || '.webp' END AS key FROM content_blocks")
def _(spark, d):
    return V.content_blocks(spark, d).select("doc_id", "block_id", F.when(F.col("block_type") == "Picture", F.concat(X.object_key(F.lit(0), F.col("doc_id"), "").substr(7, 100), F.lit("/images/"), F.col("block_id").cast("string"), F.lit(".webp"))).alias("key"))


CONTENT = """content AS (SELECT doc_id, doc_id * 100000 + block_id AS content_id, CASE WHEN block_type = 'Picture' THEN 'DESCRIPTION' WHEN block_type = 'Table' THEN 'CAPTION' ELSE 'TEXT_CONTENT' END AS embedding_source, nullif(text_content, '') AS text_content, description, caption FROM content_blocks),
embedded AS (SELECT vec_id * 100000 + label AS content_id FROM embeddings)"""
NEED = "((embedding_source = 'TEXT_CONTENT' AND text_content IS NOT NULL) OR (embedding_source = 'DESCRIPTION' AND description IS NOT NULL) OR (embedding_source = 'CAPTION' AND caption IS NOT NULL))"


def _content(spark, d):
    t = F.col("block_type")
    return V.content_blocks(spark, d).select("doc_id", (F.col("doc_id") * 100000 + F.col("block_id")).alias("content_id"), F.when(t == "Picture", "DESCRIPTION").when(t == "Table", "CAPTION").otherwise("TEXT_CONTENT").alias("embedding_source"), F.nullif("text_content", F.lit("")).alias("text_content"), "description", "caption")


def _embedded(spark, d):
    return V.table(spark, d, "embeddings").select((F.col("vec_id") * 100000 + F.col("label")).alias("content_id"))


@query("needs_embedding", CONTENT_SQL + "," + CONTENT + f" SELECT content_id, embedding_source FROM content WHERE {NEED}")
def _(spark, d):
    return C.needs_embedding(_content(spark, d)).select("content_id", "embedding_source")


@query("content_pending_embedding", CONTENT_SQL + "," + CONTENT + f", pending AS (SELECT * FROM content c WHERE {NEED} AND NOT EXISTS (SELECT 1 FROM embedded e WHERE e.content_id = c.content_id)) SELECT doc_id, content_id FROM pending WHERE doc_id IN (SELECT DISTINCT doc_id FROM pending ORDER BY doc_id LIMIT 50)")
def _(spark, d):
    return C.pending_embedding(_content(spark, d), _embedded(spark, d), 50).select("doc_id", "content_id")


@query("distinct_documents_pending", CONTENT_SQL + "," + CONTENT + f" SELECT DISTINCT doc_id FROM content c WHERE {NEED} AND NOT EXISTS (SELECT 1 FROM embedded e WHERE e.content_id = c.content_id) ORDER BY doc_id LIMIT 200")
def _(spark, d):
    p = C.needs_embedding(_content(spark, d)).join(_embedded(spark, d), "content_id", "left_anti")
    return p.select("doc_id").distinct().orderBy("doc_id").limit(200)


@query("batch_items", CONTENT_SQL + "," + CONTENT + f", n AS (SELECT doc_id, content_id, (row_number() OVER (PARTITION BY doc_id ORDER BY content_id) - 1) // 8 AS batch FROM content WHERE {NEED}) SELECT doc_id, CAST(batch AS INTEGER) AS batch, list(content_id ORDER BY content_id) AS items FROM n GROUP BY ALL")
def _(spark, d):
    return M.batches(C.needs_embedding(_content(spark, d)).withColumn("item", F.col("content_id")), ["doc_id"], "content_id", "item", 8)


@query("embeddings_by_index", "SELECT label, list(vec_id ORDER BY vec_id) AS vecs FROM embeddings GROUP BY label")
def _(spark, d):
    return V.table(spark, d, "embeddings").groupBy("label").agg(F.array_sort(F.collect_list("vec_id")).alias("vecs"))


@query("upload_embeddings", CONTENT_SQL + "," + CONTENT + " SELECT c.content_id, e.vec_id, len(e.embedding) = 64 AS dimension_ok FROM content c JOIN embeddings e ON c.content_id = e.vec_id * 100000 + e.label")
def _(spark, d):
    e = V.table(spark, d, "embeddings").withColumn("content_id", F.col("vec_id") * 100000 + F.col("label"))
    return _content(spark, d).select("content_id").join(e, "content_id").select("content_id", "vec_id", (F.size("embedding") == 64).alias("dimension_ok"))


@query("lazy_relationship_navigation", NODES_SQL + "," + CATALOGUE_SQL + " SELECT node_id, document_id, p.publication_id, p.source FROM nodes n JOIN catalogue c ON n.doc_id = c.document_id LEFT JOIN publications p ON c.publication_id = p.publication_id")
def _(spark, d):
    n = V.nodes(spark, d).select("node_id", F.col("doc_id").alias("document_id"))
    return n.join(V.catalogue(spark, d).select("document_id", "publication_id"), "document_id").join(V.publications(spark, d).select("publication_id", "source"), "publication_id", "left")


@query("cascade_delete", NODES_SQL + " SELECT node_id FROM nodes WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'fr')")
def _(spark, d):
    return C.cascade_delete(V.table(spark, d, "documents").filter("lang = 'fr'").select("doc_id"), V.nodes(spark, d), "doc_id").select("node_id")


COS = "SELECT a.vec_id AS entry_id, b.vec_id AS heading_id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id"


@query("toc_to_heading", f"SELECT entry_id, heading_id, round(s, 5) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY round(s, 9) DESC, heading_id) AS r FROM ({COS})) WHERE r = 1")
def _(spark, d):
    e = V.table(spark, d, "embeddings")
    entries = e.select(F.col("label").alias("grp"), F.col("vec_id").alias("entry_id"), F.col("embedding").alias("e"))
    heads = e.select(F.col("label").alias("grp"), F.col("vec_id").alias("heading_id"), F.col("embedding").alias("h"))
    return M.nearest_heading(entries, heads)


@query("model_router", "m AS (SELECT * FROM (VALUES ('text', 'small', 3), ('text', 'large', 1), ('image', 'vision', 2)) r(grp, model, weight)), c AS (SELECT grp, model, sum(weight) OVER (PARTITION BY grp ORDER BY model) - weight AS lo, sum(weight) OVER (PARTITION BY grp ORDER BY model) AS hi, sum(weight) OVER (PARTITION BY grp) AS w FROM m), k AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'image' ELSE 'text' END AS grp, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM documents) SELECT doc_id, model FROM k JOIN c ON k.grp = c.grp AND h % w >= lo AND h % w < hi")
def _(spark, d):
    routes = spark.createDataFrame([("text", "small", 3), ("text", "large", 1), ("image", "vision", 2)], "grp string, model string, weight int")
    req = V.table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, "image").otherwise("text").alias("grp"))
    return R.route(req, routes, "doc_id").select("doc_id", "model")


@query("replay_provider", "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'ok' ELSE 'other' END AS answer FROM conversations")
def _(spark, d):
    c = V.table(spark, d, "conversations").select("conv_id", "turn")
    req = c.select(F.concat_ws(":", "conv_id", "turn").alias("request_key"), "conv_id", "turn")
    responses = c.filter("turn % 2 = 0").select(F.lit("classify").alias("task"), F.concat_ws(":", "conv_id", "turn").alias("request_key"), F.lit(1).alias("attempt"), F.lit('{"label": "ok"}').alias("response"))
    return R.replay(req, responses, "classify", "label string").select("conv_id", "turn", F.coalesce("parsed.label", F.lit("other")).alias("answer"))


@query("approval_transition", "s AS (SELECT doc_id, CAST(doc_id % 4 AS INTEGER) AS attempt, doc_id % 5 <> 0 AS checks_pass, doc_id % 3 AS n_critical FROM documents) SELECT doc_id, checks_pass AND (attempt >= 2 OR n_critical = 0) AS approved, CASE WHEN checks_pass AND (attempt >= 2 OR n_critical = 0) THEN attempt ELSE attempt + 1 END AS attempt FROM s")
def _(spark, d):
    i = F.col("doc_id")
    s = V.table(spark, d, "documents").select("doc_id", (i % 4).cast("int").alias("attempt"), (i % 5 != 0).alias("checks_pass"), (i % 3).alias("n_critical"))
    return R.approval_step(s).select("doc_id", "approved", "attempt")
