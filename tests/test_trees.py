"""Trees of any depth, rows of documents in any order."""

import pytest
from pyspark.sql import functions as F

from pagewright.operators import tree

NODES = "doc_id long, node_id long, parent_id long, seq int, tag string, text_content string, description string"


def chain(n):
    return [(1, k, k - 1 if k else None, 0, "ul", None if k < n - 1 else "x", None) for k in range(n)]


def mixed():
    big = 2**53
    return [(2, big + 2, None, 1, "p", "b", None), (2, big + 1, None, 1, "p", "a", None), (2, big + 3, None, 0, "ul", None, None), (2, big + 4, big + 3, 0, "img", None, None), (3, 1, 9, 0, "p", "lost", None), (2, 7, None, None, "p", None, None)]


def shown(spark, f, rows):
    df = spark.createDataFrame(rows, NODES)
    return {r.doc_id: r.html for r in f(df.orderBy(F.desc("node_id"))).collect()}


@pytest.mark.parametrize("n", [3000])
def test_deep_tree_to_html(spark, n):
    """no limit of depth; ids beyond 2 ** 53, ties of seq, a node without its parent."""
    got = shown(spark, tree.node_tree_to_html, chain(n) + mixed())
    assert got == {1: "<ul>" * n + "x" + "</ul>" * n, 2: '<ul><img src="" alt="" /></ul>\n<p>a</p>\n<p>b</p>\n<p></p>', 3: ""}


@pytest.mark.parametrize("n", [3000])
def test_deep_document(spark, n):
    """the same for whole documents."""
    got = shown(spark, tree.render_documents, chain(n) + mixed())
    assert got == {1: "<ul>\n" * (n - 1) + "<ul>x</ul>" + "\n</ul>" * (n - 1), 2: '<ul>\n<img src="" alt="" />\n</ul>\n<p>a</p>\n<p>b</p>\n<p></p>', 3: ""}
