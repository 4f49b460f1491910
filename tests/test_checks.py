"""Checks of model responses: as much work as the response and the text are long, whatever ranges it names."""

import json
import random

from pyspark.sql import functions as F

from pagewright.functions import exprs as X
from pagewright.operators import tasks as K


def answers(spark, rows, check):
    """rows: (response, n, html)."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, response string, n int, html string")
    return [(r.c.error, r.c.result) for r in df.select("i", check(F.col("response"), F.col("n"), F.col("html")).alias("c")).orderBy("i").collect()]


def lines(ids):
    return "\n".join(f'<p id="{i}">x{k}</p>' for k, i in enumerate(ids))


def groups(*ranges):
    return json.dumps({"groups": [{"range": r} for r in ranges]})


def test_wide_ranges_make_no_ids(spark):
    """a range of a billion ids is compared, not written out."""
    rows = [(groups("0-999999999"), 3, lines(range(3))), (groups("0-2", "0-999999999"), 3, lines(range(3)))]
    assert [e for e, _ in answers(spark, rows, K.split_groups)] == ["coverage", "coverage"]


def test_group_lines(spark):
    """ids as they are written, lines in any order, the first of several; none may be missing."""
    rows = [(groups("0-2"), 3, lines([2, 0, 1, 0])), (groups("0-2"), 3, lines([0, "01", 2])), (groups("0,2", "1"), 3, lines([0, 1, 2, 7])), (groups(), 0, None), (groups("0"), 1, None), (groups("0-1"), 2, lines([0, 1]).replace("x1", "y" * K.LONGEST))]
    assert [e for e, _ in answers(spark, rows, K.split_groups)] == [None, "id not found", None, None, "id not found", "too long"]


def test_many_sections(spark):
    """a section for every line of a long document."""
    n = 3000
    settled = spark.createDataFrame([(1, "ok", json.dumps([{"range": str(i), "tag": "nav" if i % 2 else None} for i in range(n)]), lines(range(n)))], "request_key int, status string, result string, html string")
    got = {r.section: (r.tag, r.html) for r in K.sections(settled, "html").collect()}
    assert got == {i: ("nav", f'<nav>\n<p id="{i}">x{i}</p>\n</nav>') if i % 2 else (None, f'<p id="{i}">x{i}</p>') for i in range(n)}


def test_section_lines_in_order_of_ids(spark):
    """ranges out of order, lines out of order and one id twice."""
    settled = spark.createDataFrame([(1, "ok", '[{"range":"2,0"},{"range":"1","tag":"nav"}]', lines([2, 1, 0, 1]))], "request_key int, status string, result string, html string")
    assert sorted((r.section, r.html) for r in K.sections(settled, "html").collect()) == [(0, '<p id="0">x2</p>\n<p id="2">x0</p>'), (1, '<nav>\n<p id="1">x1</p>\n</nav>')]


def test_wide_parts_make_no_ids(spark):
    """the same for the three ranges of a page structure."""
    parts = lambda a, b, c: json.dumps({"header": a, "main": b, "footer": c})
    rows = [(parts("", "0-999999999", ""), 3, None), (parts("0-999999999", "5", ""), 3, None), (parts("0", "1-2", ""), 3, None), (parts("", "", ""), 0, None), (parts("", "3-1", "x"), 3, None)]
    assert [e for e, _ in answers(spark, rows, lambda r, n, _: K.top_level_structure(r, n))] == ["coverage", "duplicate ids", None, None, "Start after end"]


def test_bounds_against_ids(spark):
    """coverage by bounds is coverage by ids."""
    rng = random.Random(5)
    cases = []
    for _ in range(400):
        n = rng.randrange(7)
        cut = sorted(rng.sample(range(n + 1), min(n + 1, 2)))
        parts = [(a, b - 1) for a, b in zip([0, *cut], [*cut, n], strict=True) if a < b]
        if rng.random() < 0.6:
            a = rng.randrange(7)
            parts.append((a, a + rng.randrange(3)))
        if parts and rng.random() < 0.4:
            parts.pop(rng.randrange(len(parts)))
        rng.shuffle(parts)
        cases.append((",".join(f"{a}-{b}" for a, b in parts), n))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, n int")
    b = X.parse_bounds(F.col("t"))["bounds"]
    got = df.select("i", K._covers(b, F.col("n"), True).alias("x"), K._covers(b, F.col("n"), False).alias("y")).orderBy("i").collect()
    for (t, n), r in zip(cases, got, strict=True):
        ids = [k for p in t.split(",") if p for k in range(int(p.split("-")[0]), int(p.split("-")[1]) + 1)]
        twice, off = len(ids) > len(set(ids)), set(ids) != set(range(n))
        assert (r.x, r.y) == ("duplicate ids" if twice else "coverage" if off else None, "coverage" if off else "duplicate ids" if twice else None), (t, n)
