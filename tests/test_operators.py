"""Edge cases of the operators, with rows written by hand."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from pagewright.functions import exprs as X
from pagewright.operators import catalog, edits, html, layout, pages, provider, style, tree
from pagewright.sources import readers, sinks
from pagewright.streaming import jobs


def values(spark, kind, items, f):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_furniture_bands_are_inclusive(spark):
    df = spark.createDataFrame([(0.0, 72.0), (0.0, 72.5), (720.0, 760.0), (719.5, 760.0), (748.0, 804.0)], "a double, b double")
    got = [r[0] for r in df.select(X.furniture(F.col("a"), F.col("b"), F.lit(792.0))).collect()]
    assert got == ["Page header", None, "Page footer", None, "Page footer"]


def test_label_types(spark):
    labels = ["12", "iv", "XIV", "C", "A", "B", " 7 ", "a1", "", "mcm"]
    assert values(spark, "string", labels, X.label_type) == ["integer", "roman_lower", "roman_upper", "roman_upper", "letter", "letter", "integer", "unknown", "unknown", "roman_lower"]


def roman(n):
    out = ""
    for v, s in X.ROMANS:
        out += s * (n // v)
        n %= v
    return out


def test_romans(spark):
    df = spark.range(1, 4000).select("id", X.to_roman(F.col("id")).alias("r"))
    rows = df.select("id", "r", X.from_roman(F.col("r")).alias("back")).collect()
    assert all(r.r == roman(r.id) and r.back == r.id for r in rows)
    assert values(spark, "string", ["iiii", "vx", "", "ic", "XL"], X.from_roman) == [None, None, None, None, 40]
    assert values(spark, "int", [0, 4000, -3], X.to_roman) == [None, None, None]


def test_increment(spark):
    df = spark.createDataFrame([("2", -5), ("ii", -2), ("Y", 1), ("Z", 1), ("IX", 1), ("q?", 1)], "l string, n int")
    assert [r[0] for r in df.select(X.increment_label(F.col("l"), F.col("n"))).collect()] == ["-3", None, "Z", None, "X", None]


def ranges(ids):
    out, ids = [], sorted(set(ids))
    while ids:
        k = 1
        while k < len(ids) and ids[k] == ids[0] + k:
            k += 1
        out.append(str(ids[0]) if k == 1 else f"{ids[0]}-{ids[k - 1]}")
        ids = ids[k:]
    return ",".join(out)


def test_ranges_round_trip(spark):
    rng = random.Random(3)
    sets = [[rng.randrange(30) for _ in range(rng.randrange(12))] for _ in range(80)]
    texts = values(spark, "array<int>", sets, X.format_ranges)
    assert texts == [ranges(s) for s in sets]
    assert values(spark, "string", texts, lambda c: X.parse_ranges(c)["ids"]) == [sorted(set(s)) for s in sets]


def test_range_errors(spark):
    got = values(spark, "string", ["1,,2", "-5", "3-1", " ", "2,2,1", "7 - 9"], lambda c: X.parse_ranges(c))
    assert [(g.ids, g.error) for g in got] == [(None, "Non-numeric value"), (None, "Non-numeric values in range"), (None, "Start after end"), ([], None), ([1, 2, 2], None), ([7, 8, 9], None)]


def test_de_fence(spark):
    assert values(spark, "string", ["```json\n{}\n```", "```\nx\n```", "``` json\n[1] \n```\n", " plain ", "```json {}```", "```json\n{}"], X.de_fence) == ["{}", "x", "[1]", "plain", "```json {}```", "{}"]


def test_text_patterns(spark):
    p = values(spark, "string", ["", "Year 2024", "12.5", "JAN", "a\nb\nc", "plain words only", "2024 " + "x" * 60, "$5", "JANE", "10K"], lambda c: X.text_patterns(c)["suggests_visual"])
    assert p == [False, True, True, True, True, False, False, True, False, True]
    assert values(spark, "string", ["x" * 100, "x" * 101, "w " * 15, "w " * 16, "", None], X.worth_asking) == [False, True, False, True, False, False]


def test_interpolation_rules(spark):
    def fill(known, n=12):
        df = spark.createDataFrame([(1, p, known.get(p)) for p in range(1, n + 1)], "doc_id long, page_number int, label string")
        return {r.page_number: r.label for r in pages.interpolate(df).collect() if r.interpolated}

    assert fill({1: "i", 4: "iv"}) == {2: "ii", 3: "iii"}
    assert fill({1: "5", 3: "12"}) == {}
    # 0.9 a page, halves go to the even number
    assert fill({1: "1", 11: "10"}) == {p: str(1 + round((p - 1) * 9 / 10)) for p in range(2, 11)}
    # types pair across pages of other types; known pages stay; the type seen first wins
    assert fill({1: "1", 2: "A", 4: "C", 5: "5"}) == {3: "3"}
    assert fill({1: "A", 3: "C"}) == {}
    assert fill({1: "10", 3: "10"}) == {}


def test_header_beats_footer_and_only_text_changes(spark):
    df = spark.createDataFrame([("Text", 0.0, 10.0, 60.0), ("Table", 0.0, 10.0, 60.0)], "type string, top double, height double, page_height double")
    assert [r.type for r in layout.retype_furniture(df).collect()] == ["Page header", "Table"]


def test_elements_and_nodes():
    rows = html.elements_of("<div><p id='1'>a<b>x</p>y<br><p>z</div></nope>tail")
    assert [(r["tag"], r["depth"]) for r in rows] == [("div", 0), ("p", 1), ("b", 2), ("br", 1), ("p", 1)]
    nodes = html.nodes_of("<ul data-sources='0,1'><li>one <b>two</b> three</li><li> <p>in</p>out</li><img src='x'/><span>q</span></ul>")
    assert [(n[4], n[5], n[7]) for n in nodes] == [("ul", None, True), ("li", "one <b>two</b> three", True), ("li", "out", True), ("p", "in", True), ("img", None, True), ("span", "q", False)]
    assert html.nodes_of(None) == [] and html.elements_of("plain") == []
    deep = html.nodes_of("<section>" * 3000 + "x")
    assert len(deep) == 3000 and deep[-1][5] == "x"


def test_tag_rules(spark):
    got = values(spark, "string", ["<p>a</p>", "<div><span>x</span><p>", "", "plain", "<body><p></body><div>", "<TABLE>"], html.disallowed_tags)
    assert got == [[], ["div", "span"], [], [], [], []]


def test_style_fold(spark):
    s = "array<struct<text: string, flags: int, pos: int>>"
    df = spark.createDataFrame([("Bold and more bold text", [("more bold", 16, 1), ("bold", 2, 0), ("TEXT", 2, 2)]), ("a.b $1 c", [("a.b $1", 18, 0)]), ("none", [("zzz", 16, 0)])], f"t string, s {s}")
    assert [r[0] for r in df.select(style.apply_spans(F.col("t"), F.col("s"))).collect()] == ["Bold and <b>more bold</b> <i>TEXT</i>", "<i><b>a.b $1</b></i> c", "none"]


def test_edits(spark):
    files = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "a\nb")], "doc_id long, text string")
    r = spark.createDataFrame([(1, 1, 1), (1, 3, 4), (2, 1, 2), (2, 2, 2)], "doc_id long, a int, b int")
    assert {x.doc_id: (x.text, x.applied) for x in edits.delete_ranges(files, r).collect()} == {1: ("b", True), 2: ("a\nb", False)}
    p = spark.createDataFrame([(1, [(1, 2, 3, "X\nY\nZ"), (2, 1, 1, "Q")])], "doc_id long, patches array<struct<pos: int, start: int, end: int, contents: string>>")
    got = edits.apply_patches(files.withColumn("expected_hash", F.sha2("text", 256)), p).collect()
    assert {x.doc_id: (x.result, x.new_text) for x in got} == {1: ("ok", "Q\nX\nY\nZ\nd"), 2: ("none", "a\nb")}
    assert values(spark, "int", [-3, 1, 9], lambda c: edits.line_range(F.lit("a\nb\nc"), c, F.lit(99))) == ["a\nb\nc", "a\nb\nc", None]


def test_tree_and_provider(spark):
    n = spark.createDataFrame([(1, 1, None, 0, "section", None, None, [1]), (1, 2, 1, 0, "ul", None, None, [1, 2]), (1, 3, 2, 0, "li", "x & y", None, [1, 2, 3]), (1, 4, 1, 1, "img", None, "d\"q", [1, 4])], "doc_id long, node_id long, parent_id long, seq int, tag string, text_content string, description string, path array<long>")
    assert tree.render_documents(n).first().html == '<section>\n<ul>\n<li>x &amp; y</li>\n</ul>\n<img src="" alt="d&quot;q" />\n</section>'
    assert {r.node_id: r.target_id for r in tree.context_node(n).collect()} == {1: 1, 2: 2, 3: 2, 4: 1}
    req = spark.createDataFrame([("a",), ("b",)], "request_key string")
    res = spark.createDataFrame([("t", "a", 1, "nonsense"), ("t", "a", 2, '```json\n{"v": 2}\n```'), ("t", "a", 4, '{"v": 4}'), ("u", "b", 1, '{"v": 9}')], "task string, request_key string, attempt int, response string")
    assert {r.request_key: r.parsed and r.parsed.v for r in provider.replay(req, res, "t", "v int").collect()} == {"a": 2, "b": None}
    calls = lambda ts: [[float(len(t))] for t in ts]
    rows = spark.createDataFrame([(1, "abc"), (2, ""), (3, None), (4, "z")], "k long, t string")
    assert {r.k: r.vector for r in provider.embed(rows, calls, "k", "t", 1).collect()} == {1: [3.0], 4: [1.0]}


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "l.json").write_text('[{"left": 1, "top": 2, "width": 3, "height": 4, "page_number": 1, "page_width": 9, "page_height": 9, "text": "x", "type": "Text", "more": 1}, {"page_number": 0, "type": "Text"}, {"page_number": 1, "type": "Odd"}]')
    assert [(r.left, r.text) for r in readers.layout_json(spark, f"{tmp_path}/l.json").collect()] == [(1.0, "x")]
    docs = spark.createDataFrame([(7, "<p>x</p>"), (8, "<!-- Approved -->\n<p>y</p>")], "document_id long, html string")
    sinks.write_html(docs, f"{tmp_path}/html")
    assert all(r.html.startswith("<!-- Approved -->\n<p>") for r in spark.read.text(f"{tmp_path}/html", wholetext=True).select(F.col("value").alias("html")).collect())
    svg = spark.createDataFrame([(1, '<svg xmlns="http://www.w3.org/2000/svg"><g><rect x="1" y="2" width="3" height="4"/><circle cx="5" cy="5" r="2"/><path id="font_1" d="M0 0 L1 1"/><line x1="4" y1="1" x2="0" y2="3"/></g></svg>'), (2, "broken <")], "k int, s string")
    assert [(r.tag, r.x0, r.y0, r.x1, r.y1) for r in readers.svg_elements(svg, "k", "s").collect()] == [("rect", 1, 2, 4, 6), ("circle", 3, 3, 7, 7), ("line", 0, 1, 4, 3)]
    with pytest.raises(OSError):
        readers.require({"A": " "}, ["A"], ["B", "C"])
    readers.require({"B": "1", "C": "2"}, ["A"], ["B", "C"])


def test_streams(spark, tmp_path):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "document_id long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/in")
    done = spark.createDataFrame([(2,)], "document_id long")
    for _ in range(2):  # a second run finds nothing new
        q = jobs.backlog_stream(spark, f"{tmp_path}/in", docs.schema, lambda: done, lambda df: df, f"{tmp_path}/out", f"{tmp_path}/check")
        assert q.awaitTermination(120)
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 3]
    e = spark.createDataFrame([(1, "running", "2024-01-01 00:00:00"), (1, "completed", "2024-01-01 00:05:00"), (2, "running", "2024-01-01 00:00:00")], "job_id long, status string, t string").select("job_id", "status", F.to_timestamp("t").alias("ts"))
    assert {r.job_id: (r.status, r.terminal) for r in jobs.latest_status(e).collect()} == {1: ("completed", True), 2: ("running", False)}


def test_context_containers(spark):
    """Cases worked out by hand: table and figure parts fall back to a section, an aside shows itself, main does not."""
    rows = [
        (1, 1, None, 0, "main", None, None, [1]), (1, 2, 1, 0, "p", "a", None, [1, 2]), (1, 3, 1, 1, "section", None, None, [1, 3]), (1, 4, 3, 0, "td", "b", None, [1, 3, 4]),
        (1, 5, 3, 1, "aside", None, None, [1, 3, 5]), (1, 6, 5, 0, "p", "c", None, [1, 3, 5, 6]), (1, 7, 3, 2, "figure", None, None, [1, 3, 7]), (1, 8, 7, 0, "p", "d", None, [1, 3, 7, 8]), (1, 9, 5, 1, "figcaption", "e", None, [1, 3, 5, 9]),
    ]
    n = spark.createDataFrame(rows, "doc_id long, node_id long, parent_id long, seq int, tag string, text_content string, description string, path array<long>")
    assert {r.node_id: r.target_id for r in tree.context_node(n).collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 5, 7: 7, 8: 7, 9: 3}


def test_span_match_by_whole_words(spark):
    cases = [("art", "a party", ("contains", 1)), ("the art show", "party at the show", None), ("the show", "the big show", ("words", 1)), ("show the", "the big show", None), ("a b", "a x b", ("words", 1)), ("one two three four", "one two nine three", ("most", 1)), ("b.c d", "b.c and d", ("words", 1))]
    df = spark.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(cases)], "k int, span string, text string")
    got = {r.k: r.m and tuple(r.m) for r in df.select("k", style.best_match(F.col("text"), F.col("span")).alias("m")).collect()}
    assert got == {k: w for k, (*_, w) in enumerate(cases)}


def test_images_are_no_candidates(spark):
    c = spark.createDataFrame([(1, 0, 1, "x " * 80, "image"), (1, 1, 1, "y " * 80, "drawing"), (1, 2, 1, "z", "visual_pattern"), (1, 3, 1, "w", None)], "doc_id long, input_pos int, page_number int, text string, rule string")
    r = spark.createDataFrame([(1, 0, "paragraph"), (1, 1, "paragraph")], "doc_id long, input_pos int, content_type string")
    assert {x.input_pos: x.accepted for x in layout.accept_candidates(c.filter("rule is not null"), r).collect()} == {1: False, 2: True}
    s = layout.detection_stats(layout.accept_candidates(c, r, keep_images=True)).first()
    assert (s.images, s.drawings, s.visual_patterns, s.initial, s.final) == (1, 1, 1, 2, 1)


def test_styling_leaves_furniture_out(spark):
    b = spark.createDataFrame(
        [(1, 0, 1, 50.0, 60.0, "Text", "bold words", "s"), (1, 1, 1, 100.0, 120.0, "Page header", "bold words", None), (1, 2, 1, 100.0, 120.0, "Text", "some bold words here", "s"), (1, 3, 1, 730.0, 740.0, "Text", "foot", None)],
        "doc_id long, block_id int, page_number int, y1 double, y2 double, block_type string, text_content string, storage_url string",
    ).withColumn("description", F.lit(None).cast("string")).withColumn("caption", F.lit(None).cast("string"))
    s = spark.createDataFrame([(1, 1, 0, " bold words ", 16)], "doc_id long, page_number int, span_pos int, text string, flags int")
    assert [tuple(r) for r in style.style_blocks(b, s, 792.0).select("block_id", "text_content", "storage_url").collect()] == [(2, "some <b>bold words</b> here", None)]
    assert style.styling_summary(b, s, 792.0).first().asDict() == {"total": 1, "styled": 1, "spans_applied": 1, "excluded": 3}


def test_citation_without_a_year(spark):
    p = spark.createDataFrame([(1, " A. Author ", None, "Title", None, None, "uri"), (2, None, datetime.date(2001, 2, 3), " ", "Src", "url", "uri"), (3, None, None, "T", None, None, None)], "publication_id long, authors string, publication_date date, title string, source string, source_url string, uri string")
    d = spark.createDataFrame([], "publication_id long, document_id long, type string, version string")
    assert {r.publication_id: r.citation for r in catalog.citations(p, d).collect()} == {1: "A. Author. Title. uri", 2: "(2001). Src. url", 3: "T."}
