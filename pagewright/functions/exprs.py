"""Scalar expressions on layout blocks, labels, text and HTML. All are Column in, Column out, without UDFs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = "[ \\t\\n\\r\\f\\x0B]"
HEADER, FOOTER = "Page header", "Page footer"
MARGIN = 72
# fixed values: what points to a chart, matched against upper-cased text (word borders are ASCII)
_EDGE, _END = "(^|[^A-Z0-9_])", "([^A-Z0-9_]|$)"
VISUAL = "|".join([
    f"{_EDGE}[0-9]{{4}}{_END}",
    f"{_EDGE}(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC){_END}",
    "[0-9]+%",
    "\\$[0-9]+",
    f"{_EDGE}[0-9]+\\.[0-9]+{_END}",
    f"{_EDGE}[0-9]+[KMB]{_END}",
])
# the same texts as VISUAL has; what a place may start with comes before any choice, so a place in a word costs one look
_VISUAL = "|".join([
    "[0-9]%",
    "\\$[0-9]",
    "(?<![A-Z0-9_])(?=[0-9JFMASOND])(?:[0-9]{4}|JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC|[0-9]+\\.[0-9]+|[0-9]+[KMB])(?![A-Z0-9_])",
])
ROMANS = [(1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")]


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(" \t\n\r\f\x0b"))


def strip_or_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def has_text(x: Column) -> Column:
    return F.coalesce(strip(x) != "", F.lit(False))


def bbox(left: Column, top: Column, width: Column, height: Column) -> Column:
    return F.struct(left.alias("x1"), top.alias("y1"), (left + width).alias("x2"), (top + height).alias("y2"))


def bbox_integers(left: Column, top: Column, width: Column, height: Column) -> Column:
    """Corners of whole numbers: the first truncated, the second rounded up."""
    return F.struct(left.cast("int").alias("x1"), top.cast("int").alias("y1"), F.ceil(left + width).cast("int").alias("x2"), F.ceil(top + height).cast("int").alias("y2"))


def area(b: Column) -> Column:
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])


def furniture(y1: Column, y2: Column, page_height: Column) -> Column:
    """Header if the block ends in the top margin, else footer if it starts in the bottom one, else null."""
    return F.when(y2 <= MARGIN, HEADER).when(y1 >= page_height - MARGIN, FOOTER)


def retype(kind: Column, y1: Column, y2: Column, page_height: Column) -> Column:
    return F.when(kind == "Text", F.coalesce(furniture(y1, y2, page_height), kind)).otherwise(kind)


def label_type(label: Column) -> Column:
    """Roman numbers are looked for before letters, so a single C, D, I, L, M, V or X is roman."""
    s = strip(label)
    return F.when(s.rlike("^[0-9]+$"), "integer").when(s.rlike("^[ivxlcdm]+$"), "roman_lower").when(s.rlike("^[IVXLCDM]+$"), "roman_upper").when(s.rlike("^[A-Z]$"), "letter").otherwise("unknown")


def like_page_number(text: Column) -> Column:
    return F.coalesce(strip(text).rlike("^([0-9]{1,2}|[ivxlcdmIVXLCDM]+|[A-Z])$"), F.lit(False))


def to_roman(n: Column) -> Column:
    """Lower-case roman number of 1 .. 3999, else null."""
    out, left = F.lit(""), n
    for value, letters in ROMANS:
        out = F.concat(out, F.repeat(F.lit(letters), F.floor(left / value).cast("int")))
        left = F.pmod(left, F.lit(value))
    return F.when((n >= 1) & (n <= 3999), out)


def from_roman(label: Column) -> Column:
    """Value of a roman number in canonical form, any case; null for anything else."""
    low = F.lower(strip(label))
    ok = low.rlike("^m{0,3}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$") & (low != "")
    total = F.lit(0)
    for value, letter in [(1000, "m"), (500, "d"), (100, "c"), (50, "l"), (10, "x"), (5, "v"), (1, "i")]:
        total = total + value * F.regexp_count(low, F.lit(letter))
    for value, pair in [(200, "cm"), (200, "cd"), (20, "xc"), (20, "xl"), (2, "ix"), (2, "iv")]:
        total = total - value * F.regexp_count(low, F.lit(pair))
    return F.when(ok, total)


def label_value(label: Column) -> Column:
    s, kind = strip(label), label_type(label)
    return F.when(kind == "integer", s.try_cast("int")).when(kind.startswith("roman"), from_roman(s)).when(kind == "letter", F.ascii(s) - 65)


def format_label(value: Column, kind: Column) -> Column:
    return (
        F.when(kind == "integer", value.cast("string"))
        .when(kind == "roman_lower", to_roman(value))
        .when(kind == "roman_upper", F.upper(to_roman(value)))
        .when((kind == "letter") & (value >= 0) & (value <= 25), F.char(value + 65))
    )


def increment_label(label: Column, by: Column) -> Column:
    """The label `by` places on; integers may turn negative, romans end at 1, letters stay in A-Z."""
    return format_label(label_value(label) + by, label_type(label))


def de_fence(x: Column, kind: str = "json") -> Column:
    """Stripped, and without an opening fence line (```, ```kind or ``` kind) and the closing fence that belongs to it."""
    s = strip(x)
    inner = F.regexp_replace(s, f"^```({kind}| {kind})?\\n", "")
    closed = F.when(inner.endswith("\n```"), F.regexp_replace(F.regexp_replace(inner, "\\n```$", ""), f"{BLANK}+$", "")).otherwise(inner)
    return F.when(s.rlike(f"^```({kind}| {kind})?\\n"), closed).otherwise(s)


def match_form(text: Column) -> Column:
    """Lower case, single spaces, stripped, without one closing mark."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(text), f"{BLANK}+", " ")), "[.,;:!?]$", "")


def n_words(text: Column) -> Column:
    return F.array_size(F.array_remove(F.split(F.translate(text, "\t\n\r\f\x0b", "     "), " ", -1), ""))


def n_line_ends(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def text_patterns(text: Column) -> Column:
    stripped = strip(text)
    lines = n_line_ends(text)
    ratio = (lines > 0) & (lines / F.greatest(n_words(text), F.lit(1)) > 0.3)
    visual = F.upper(text).rlike(_VISUAL)
    return F.struct(
        (stripped == "").alias("is_empty"), ratio.alias("many_lines"), visual.alias("visual"), F.length(stripped).cast("long").alias("n_chars"), n_words(text).cast("long").alias("n_words"),
        ((stripped != "") & (ratio | (visual & (F.length(stripped) < 50)))).alias("suggests_visual"),
    )


def suggests_visual(text: Column) -> Column:
    """suggests_visual of text_patterns() alone; the pattern is tried on short texts only."""
    stripped = strip(text)
    lines = n_line_ends(text)
    ratio = (lines > 0) & (lines / F.greatest(n_words(text), F.lit(1)) > 0.3)
    return (stripped != "") & (ratio | F.when(F.length(stripped) < 50, F.upper(text).rlike(_VISUAL)).otherwise(False))


def worth_asking(text: Column) -> Column:
    """Whether a text is long enough to ask a model about: over 100 characters or over 15 words."""
    s = strip(text)
    return F.coalesce((s != "") & ((F.length(s) > 100) | (n_words(text) > 15)), F.lit(False))


def is_rule(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A horizontal line: at most 2 high, over 20 wide and over ten times as wide as high."""
    h, w = y1 - y0, x1 - x0
    return (h <= 2.0) & (w > 10 * h) & (w > 20)


def embedding_source(kind: Column) -> Column:
    return F.when(kind == "Picture", "DESCRIPTION").otherwise("TEXT_CONTENT")


def styled(text: Column, flags: Column) -> Column:
    bold = F.when(flags.bitwiseAND(16) != 0, F.concat(F.lit("<b>"), text, F.lit("</b>"))).otherwise(text)
    return F.when(flags.bitwiseAND(2) != 0, F.concat(F.lit("<i>"), bold, F.lit("</i>"))).otherwise(bold)


def strip_control(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]", "")


def html_body(html: Column) -> Column:
    """What stands between the first <body> and the next </body>; the whole text if either is missing."""
    return F.when(html.contains("<body>") & html.contains("</body>"), F.substring_index(F.substr(html, F.instr(html, "<body>") + 6), "</body>", 1)).otherwise(html)


def html_escape(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def block_html(block_id: Column, kind: Column, page: Column, text: Column, b: Column, url: Column, description: Column) -> Column:
    """<img> for pictures, <p> for all else; the text of a paragraph keeps its inline tags as they are."""
    corners = F.concat(F.lit("["), F.array_join(F.array(*[b[k].cast("int").cast("string") for k in ("x1", "y1", "x2", "y2")]), ", "), F.lit("]"))
    attr = lambda name, v: F.concat(F.lit(f'{name}="'), v, F.lit('"'))
    first = [attr("id", block_id.cast("string")), attr("data-page", page.cast("string"))]
    img = F.concat(F.lit("<img "), F.concat_ws(" ", *first, attr("src", html_escape(url)), attr("alt", html_escape(F.coalesce(description, text))), attr("data-bbox", corners)), F.lit(" />"))
    par = F.concat(F.lit("<p "), F.concat_ws(" ", *first, attr("data-bbox", corners)), F.lit(">"), F.coalesce(text, F.lit("")), F.lit("</p>"))
    return F.when(kind == "Picture", img).otherwise(par)


def object_key(publication: Column, document: Column, ending: str = ".pdf") -> Column:
    return F.concat(F.lit("pub_"), publication.cast("string"), F.lit("/doc_"), document.cast("string"), F.lit(ending))


def storage_parts(url: Column) -> Column:
    """Bucket (first host label), key (path without its slash) and the key of the layout file."""
    key = F.regexp_extract(url, "^https?://[^/]+/(.*)$", 1)
    return F.struct(F.regexp_extract(url, "^https?://([^./]+)", 1).alias("bucket"), key.alias("key"), F.replace(key, F.lit(".pdf"), F.lit(".json")).alias("layout_key"))


def valid_url(url: Column) -> Column:
    """http or https, a host, no blanks; null is not valid."""
    return F.coalesce(url.rlike("^https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[^ ]*)?$"), F.lit(False))


def starts_with(text: Column, marker: str) -> Column:
    return F.coalesce(text.startswith(marker), F.lit(False))


def with_marker(text: Column, marker: str) -> Column:
    """text with the marker line in front, once."""
    return F.when(starts_with(text, marker), text).otherwise(F.concat(F.lit(marker + "\n"), text))


def numbered_lines(text: Column) -> Column:
    return F.array_join(F.transform(F.split(text, "\n", -1), lambda x, i: F.concat((i + 1).cast("string"), F.lit(": "), x)), "\n")


def mime_type(name: Column) -> Column:
    ending = F.lower(F.regexp_extract(name, "\\.([A-Za-z0-9]+)$", 1))
    # fixed values: endings of the files that are stored
    known = {"pdf": "application/pdf", "json": "application/json", "html": "text/html", "txt": "text/plain", "webp": "image/webp", "png": "image/png", "svg": "image/svg+xml"}
    out = F.lit("application/octet-stream")
    for k, v in known.items():
        out = F.when(ending == k, v).otherwise(out)
    return out


SPLIT_CHARS = 64000 * 4 * 2 // 3
ONE_PASS_CHARS = 15000


def chunk_count(html: Column) -> Column:
    return F.when(F.length(html) > SPLIT_CHARS, F.floor(F.length(html) / SPLIT_CHARS) + 1).otherwise(1).cast("long")


def prompt_route(n_parents: Column, heading: Column, html: Column) -> Column:
    return F.when((n_parents == 0) & heading.isNull(), "TOP_LEVEL").when(F.length(html) < ONE_PASS_CHARS, "NO_DEFERRAL").otherwise("STANDARD")


def parse_bounds(text: Column) -> Column:
    """struct<bounds, error>: "0-3,5" as [(0, 3), (5, 5)], sorted, repeats kept; bounds null where the text is wrong. Never as long as the ranges are wide."""
    # fixed values: what may be wrong with a part, the first in this order counts
    errors = ["Non-numeric value", "Non-numeric values in range", "Start after end"]

    def part(p):
        span, lo, hi = p.contains("-"), F.regexp_extract(p, "^([0-9]+)", 1).try_cast("int"), strip(F.regexp_extract(p, "-(.*)$", 1)).try_cast("int")
        single, double = p.rlike("^[0-9]{1,9}$"), p.rlike("^[0-9]{1,9}[ ]*-[ ]*[0-9]{1,9}$")
        wrong = F.when(~span & ~single, 0).when(span & ~double, 1).when(span & (lo > hi), 2)
        return F.struct(lo.alias("lo"), F.when(span, hi).otherwise(lo).alias("hi"), wrong.alias("wrong"))

    def whole(parts):
        first = F.array_min(F.transform(parts, lambda p: p["wrong"]))
        bounds = F.array_sort(F.transform(parts, lambda p: F.struct(p["lo"].alias("lo"), p["hi"].alias("hi"))))
        return F.struct(F.when(first.isNull(), bounds).alias("bounds"), F.get(F.array(*[F.lit(e) for e in errors]), first).alias("error"))

    none = F.struct(F.expr("cast(array() as array<struct<lo: int, hi: int>>)").alias("bounds"), F.lit(None).cast("string").alias("error"))
    return F.when(strip(text) == "", none).otherwise(bind(F.transform(F.split(text, ",", -1), lambda p: bind(strip(p), part)), whole))


def parse_ranges(text: Column) -> Column:
    """struct<ids, error>: "0-3,5" as [0,1,2,3,5], sorted, repeats kept; ids null where the text is wrong."""
    ids = lambda b: F.array_sort(F.flatten(F.transform(b["bounds"], lambda r: F.sequence(r["lo"], r["hi"]))))
    return bind(parse_bounds(text), lambda b: F.struct(ids(b).alias("ids"), b["error"].alias("error")))


def format_ranges(ids: Column) -> Column:
    """Distinct sorted ids as "1-3,5"; empty for none."""
    s = F.array_sort(F.array_distinct(ids))
    starts = F.filter(s, lambda x: ~F.array_contains(s, x - 1))
    ends = F.filter(s, lambda x: ~F.array_contains(s, x + 1))
    return F.array_join(F.zip_with(starts, ends, lambda a, b: F.when(a == b, a.cast("string")).otherwise(F.concat(a.cast("string"), F.lit("-"), b.cast("string")))), ",")


def valid_range_text(x: Column) -> Column:
    return F.coalesce(x.rlike("^[0-9 \\t\\n\\r,\\-]+$"), F.lit(False))
