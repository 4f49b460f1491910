"""Node rows leave a task in small batches."""

import pytest

from pagewright.operators import html


@pytest.mark.parametrize("held", [1, 500])
def test_nodes_in_small_batches(spark, monkeypatch, held):
    """wherever rows are cut into batches, they are the same; pages without nodes and without HTML have none."""
    monkeypatch.setattr(html, "HELD", held)
    pages = spark.createDataFrame([(1, "<ul><li>a</li><li><p>b</p></li></ul>"), (2, None), (3, "plain"), (4, "<p>c</p>" * 30)], "page_id long, html string")
    got = sorted((r.page_id, r.ord, r.parent, r.text_content, r.path) for r in html.create_nodes(pages, "page_id", "html", paths=True).collect() if r.page_id == 1)
    assert got == [(1, 0, None, None, [0]), (1, 1, 0, "a", [0, 1]), (1, 2, 0, None, [0, 2]), (1, 3, 2, "b", [0, 2, 3])]
    assert html.create_nodes(pages, "page_id", "html").count() == 34
