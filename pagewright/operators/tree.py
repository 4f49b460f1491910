"""Trees as adjacency rows with path arrays (ids from the root)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import exprs as X

# fixed values: the containers that show a part of a table, of a figure, of a list, or anything else, and tags that show themselves
CONTAINERS = {
    "table": (["thead", "tbody", "tfoot", "th", "tr", "td", "caption"], ["table", "section", "main", "header", "footer"]),
    "figure": (["img", "figcaption"], ["figure", "section", "main", "header", "footer"]),
    "list": (["li"], ["ul", "ol", "section", "main", "header", "footer"]),
    "default": ([], ["figure", "table", "section", "aside", "nav", "main", "header", "footer"]),
}
SELF = ["section", "aside", "nav", "figure", "table", "ul", "ol"]


def sequence_in_parent(nodes: DataFrame) -> DataFrame:
    w = Window.partitionBy("doc_id", "parent_id").orderBy("seq", "node_id")
    return nodes.withColumn("sequence_in_parent", (F.row_number().over(w) - 1).cast("int"))


def node_rows(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node rows (with depth) and the content rows of nodes that have any: pictures and nodes with text."""
    n = nodes.select("doc_id", "node_id", "parent_id", "seq", "tag", (F.size("path") - 1).alias("depth"))
    img = F.col("tag") == "img"
    c = nodes.filter(img | F.col("text_content").isNotNull())
    return n, c.select("node_id", F.when(~img, F.col("text_content")).alias("text_content"), "description", F.when(img, "DESCRIPTION").otherwise("TEXT_CONTENT").alias("embedding_source"))


def ancestors(nodes: DataFrame) -> DataFrame:
    """node_id, ancestor_id, distance (1 for the parent) from the path arrays: no recursion, one row for each step."""
    p = nodes.select("doc_id", "node_id", F.posexplode("path").alias("k", "ancestor_id"), F.size("path").alias("n"))
    return p.filter("ancestor_id <> node_id").select("doc_id", "node_id", "ancestor_id", (F.col("n") - 1 - F.col("k")).alias("distance"))


def nearest_ancestor(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted: node_id, tags. The closest proper ancestor with one of the tags, else null."""
    tags = nodes.select("doc_id", F.col("node_id").alias("ancestor_id"), F.col("tag").alias("ancestor_tag"))
    a = ancestors(nodes).join(wanted, "node_id").join(tags, ["doc_id", "ancestor_id"]).filter(F.array_contains("tags", F.col("ancestor_tag")))
    best = a.groupBy("node_id").agg(F.min_by("ancestor_id", "distance").alias("container_id"))
    return wanted.select("node_id").join(best, "node_id", "left")


def context_tags(tag):
    """Tags of the containers that give a node its context; containers are their own context (null)."""
    out = F.array(*[F.lit(t) for t in CONTAINERS["default"][1]])
    for parts, up in list(CONTAINERS.values())[:3]:
        out = F.when(tag.isin(parts), F.array(*[F.lit(t) for t in up])).otherwise(out)
    return F.when(~tag.isin(SELF), out)


def context_node(nodes: DataFrame) -> DataFrame:
    """node_id, target_id: the node whose rendering is a node's context; itself if no container is found."""
    wanted = nodes.select("node_id", context_tags(F.col("tag")).alias("tags")).filter("tags is not null")
    found = nearest_ancestor(nodes, wanted)
    return nodes.select("node_id").join(found, "node_id", "left").select("node_id", F.coalesce("container_id", "node_id").alias("target_id"))


def render_leaf(tag, text, description):
    """HTML of a node without children."""
    img = F.concat(F.lit('<img src="" alt="'), X.html_escape(F.coalesce(description, F.lit(""))), F.lit('" />'))
    return F.when(tag == "img", img).otherwise(F.concat(F.lit("<"), tag, F.lit(">"), X.html_escape(F.coalesce(text, F.lit(""))), F.lit("</"), tag, F.lit(">")))


def _by_document(nodes: DataFrame, fields: list[str], render: Callable[[list[tuple]], str]) -> DataFrame:
    """doc_id, html: render of the rows (node_id, parent_id, *fields) of each document in order of seq and node_id.

    Rows come sorted and in batches of bounded size: a task holds one document and some finished ones.
    """
    kind = nodes.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, keys, texts, held = None, [], [], 0

        def rows():
            nonlocal of
            for b in batches:
                of = b.schema.field(0).type
                yield from zip(*[c.to_pylist() for c in b.columns], strict=True)

        for key, own in groupby(rows(), lambda r: r[0]):
            keys.append(key)
            texts.append(render([r[1:] for r in own]))
            held += len(texts[-1])
            if held > 4_000_000 or len(keys) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(keys, of), pa.array(texts, pa.string())], names=["doc_id", "html"])
                keys, texts, held = [], [], 0
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, of), pa.array(texts, pa.string())], names=["doc_id", "html"])

    order = ["doc_id", F.col("seq").asc_nulls_last(), F.col("node_id").asc_nulls_last()]
    rows = nodes.select("doc_id", "node_id", "parent_id", *fields, "seq").repartition("doc_id").sortWithinPartitions(*order).drop("seq")
    return rows.mapInArrow(run, f"doc_id {kind}, html string")


def _below(rows: list[tuple]) -> dict:
    below: dict = {}
    for r in rows:
        below.setdefault(r[1], []).append(r)
    return below


def render_documents(nodes: DataFrame) -> DataFrame:
    """doc_id, html: every document rendered from its nodes; by a stack, so any depth will do.

    A node with children shows the children only, in order; empty fragments are skipped.
    """
    leafs = nodes.withColumn("html", render_leaf(F.col("tag"), F.col("text_content"), F.col("description")))

    def render(rows: list[tuple]) -> str:
        below = _below(rows)
        # an open level: the tag around it, the nodes left, the fragments so far
        stack = [(None, iter(below.get(None, [])), [])]
        while True:
            tag, left, out = stack[-1]
            r = next(left, None)
            if r is None:
                stack.pop()
                inner = "\n".join(out)
                if not stack:
                    return inner
                stack[-1][2].append(f"<{tag}>\n{inner}\n</{tag}>")
            elif r[0] is not None and r[0] in below:
                stack.append((r[2], iter(below[r[0]]), []))
            elif r[3]:
                out.append(r[3])

    return _by_document(leafs, ["tag", "html"], render)


def node_tree_to_html(nodes: DataFrame) -> DataFrame:
    """doc_id, html in the plain form used for prompts: a node with text shows the text and drops its children; by a stack, so any depth will do."""

    def render(rows: list[tuple]) -> str:
        below = _below(rows)
        stack = [(None, iter(below.get(None, [])), [])]
        while True:
            tag, left, out = stack[-1]
            r = next(left, None)
            if r is None:
                stack.pop()
                inner = "\n".join(out)
                if not stack:
                    return inner
                stack[-1][2].append(f"<{tag}>{inner}</{tag}>")
            elif r[2] == "img":
                out.append(f'<img src="" alt="{r[4] or ""}" />')
            elif r[3]:
                out.append(f"<{r[2]}>{r[3]}</{r[2]}>")
            else:
                stack.append((r[2], iter(below.get(r[0], []) if r[0] is not None else []), []))

    return _by_document(nodes, ["tag", "text_content", "description"], render)


def top_level_only(nodes: DataFrame, marked) -> DataFrame:
    """Nodes that `marked` holds for and that have no such ancestor."""
    m = nodes.filter(marked).select("doc_id", "node_id")
    under = ancestors(nodes).join(m.withColumnRenamed("node_id", "ancestor_id"), ["doc_id", "ancestor_id"]).select("doc_id", "node_id").distinct()
    return m.join(under, ["doc_id", "node_id"], "left_anti")


def splice(nodes: DataFrame, resolved: DataFrame) -> DataFrame:
    """Replaces what is below deferred nodes: children of a resolved parent go, the resolved rows come in."""
    parents = resolved.select("doc_id", F.col("parent_id").alias("ancestor_id")).distinct()
    gone = ancestors(nodes).join(parents, ["doc_id", "ancestor_id"]).select("doc_id", "node_id").distinct()
    return nodes.join(gone, ["doc_id", "node_id"], "left_anti").select(nodes.columns).unionByName(resolved)
