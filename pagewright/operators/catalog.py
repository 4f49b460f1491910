"""Catalogue of publications and documents: backlogs, keys, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import exprs as X


def unprocessed(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """Documents without nodes. Written as an anti join: an outer join with IS NULL would stay one."""
    return documents.join(nodes.select("document_id").distinct(), "document_id", "left_anti")


def eligible(missing: DataFrame, files: DataFrame, want: list[str], without: list[str]) -> DataFrame:
    """Missing documents that have files of all the wanted kinds and none of the others. files: document_id, kind."""
    out = missing
    for kind in want:
        out = out.join(files.filter(F.col("kind") == kind).select("document_id"), "document_id", "left_semi")
    for kind in without:
        out = out.join(files.filter(F.col("kind") == kind).select("document_id"), "document_id", "left_anti")
    return out


def batch_limit(documents: DataFrame, n: int) -> DataFrame:
    """The n eligible documents of the smallest ids (the limit of a run)."""
    return documents.orderBy("document_id").limit(n)


def needs_embedding(content: DataFrame) -> DataFrame:
    """Content whose own source has a text: the text, the description or the caption."""
    s = F.col("embedding_source")
    return content.filter(((s == "TEXT_CONTENT") & F.col("text_content").isNotNull()) | ((s == "DESCRIPTION") & F.col("description").isNotNull()) | ((s == "CAPTION") & F.col("caption").isNotNull()))


def pending_embedding(content: DataFrame, embeddings: DataFrame, documents: int) -> DataFrame:
    """Pending content of the first `documents` documents that have any: limit on the keys, then semi join."""
    pending = needs_embedding(content).join(embeddings.select("content_id"), "content_id", "left_anti")
    keys = pending.select("doc_id").distinct().orderBy("doc_id").limit(documents)
    return pending.join(keys, "doc_id", "left_semi")


def publication_of(documents: DataFrame, publications: DataFrame) -> DataFrame:
    """Title of the one publication of each document; a key that is not unique raises an error."""
    j = documents.select("document_id", "publication_id").join(publications.select("publication_id", "title"), "publication_id")
    g = j.groupBy("document_id").agg(F.count("*").alias("n"), F.min("title").alias("title"))
    return g.select("document_id", F.when(F.col("n") == 1, F.col("title")).otherwise(F.raise_error(F.lit("a document has several publications")).cast("string")).alias("title"))


def citations(publications: DataFrame, documents: DataFrame) -> DataFrame:
    """Authors (Year). Title. Source. Version v. URL - parts that are blank are left out.

    The version is that of the first main document with one, else of the first document with one.
    """
    main = F.when(F.col("type") == "MAIN", 0).otherwise(1)
    v = documents.filter(X.has_text(F.col("version"))).groupBy("publication_id").agg(F.min(F.struct(main.alias("k"), "document_id", "version"))["version"].alias("version"))
    p = publications.join(v, "publication_id", "left")
    c = X.strip_or_null
    who = F.concat_ws(" ", c(F.col("authors")), F.concat(F.lit("("), F.year("publication_date").cast("string"), F.lit(")")))
    who = F.when(who != "", F.concat(who, F.lit(".")))
    dot = lambda x: F.concat(c(x), F.lit("."))
    return p.select("publication_id", F.concat_ws(" ", who, dot(F.col("title")), dot(F.col("source")), F.concat(F.lit("Version "), c(F.col("version")), F.lit(".")), F.coalesce(c(F.col("source_url")), c(F.col("uri")))).alias("citation"))


def cascade_delete(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Children without those of deleted parents."""
    return children.join(parents.select(key), key, "left_anti")
