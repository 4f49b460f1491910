"""HTML as element rows, and the rules that restructured HTML must keep."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import exprs as X

# fixed values: tags of nodes, and tags that style text inside one
NODE_TAGS = "header main footer figure figcaption table thead tbody tfoot th tr td caption section nav aside p ul ol li h1 h2 h3 h4 h5 h6 img math code cite blockquote".split()
INLINE_TAGS = "b i u s sup sub br".split()
# fixed values: elements without an end tag
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# characters of node rows that a task holds
HELD = 4_000_000
ELEMENTS = "ord int, parent int, depth int, tag string, attrs map<string,string>, own_text string, n_children int"


class _Tree(HTMLParser):
    """Elements in document order. An end tag closes the nearest open element of its name, else nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs):
        up = self.open[-1] if self.open else None
        row = {"ord": len(self.rows), "parent": up, "depth": len(self.open), "tag": tag, "attrs": {k: v or "" for k, v in attrs}, "own_text": "", "n_children": 0, "parts": []}
        if up is not None:
            self.rows[up]["n_children"] += 1
            self.rows[up]["parts"].append(row["ord"])
        self.rows.append(row)
        if tag not in VOID:
            self.open.append(row["ord"])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[k]]["tag"] == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        if self.open:
            row = self.rows[self.open[-1]]
            row["own_text"] += data
            row["parts"].append(data)

    handle_comment = handle_data


def elements_of(html: str | None) -> list[dict]:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.rows


def parse_elements(pages: DataFrame, key: str, html: str) -> DataFrame:
    """One row for every element of the HTML in column `html`, with the key of its page."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for b in batches:
            fields = [("ord", pa.int32()), ("parent", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("own_text", pa.string()), ("n_children", pa.int32())]
            schema = pa.schema([(key, b.schema.field(0).type), *fields])
            out = {n: [] for n in schema.names}
            for k, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for e in elements_of(h):
                    out[key].append(k)
                    for n, _ in fields:
                        out[n].append(list(e[n].items()) if n == "attrs" else e[n])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, {ELEMENTS}")


_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
NODES = "ord int, parent int, depth int, seq int, tag string, text_content string, sources string, ok boolean"


def _plain(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _quoted(value: str) -> str:
    """An attribute value in double quotes, in single ones if it holds double ones only."""
    value = _plain(value)
    if '"' not in value:
        return f'"{value}"'
    return f"'{value}'" if "'" not in value else '"' + value.replace('"', "&quot;") + '"'


def markup(rows: list[dict], top: int) -> str:
    """An element with all that it holds as HTML again; by a stack, so any depth will do."""
    out, stack = [], [top]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            out.append(x[0])
        elif isinstance(x, str):
            out.append(_plain(x))
        else:
            e = rows[x]
            start = e["tag"] + "".join(f" {k}={_quoted(v)}" for k, v in e["attrs"].items())
            if e["tag"] in VOID:
                out.append(f"<{start}/>")
            else:
                out.append(f"<{start}>")
                stack += [(f"</{e['tag']}>",), *reversed(e["parts"])]
    return "".join(out)


def nodes_of(html: str | None) -> list[tuple]:
    """Node rows of a page: (ord, parent, depth, seq, tag, text, sources, ok).

    Text with inline tags keeps them as they are written, attributes and entities included; otherwise
    the first text that is not blank counts, and a text that is all of the element even if blank.
    Pictures keep no text and no children. ok is false for a tag that no node may have.
    """
    rows = elements_of(html)
    out = []

    def visit(n: int, parent, depth: int, seq: int) -> None:
        stack = [(n, parent, depth, seq)]
        while stack:
            n, parent, depth, seq = stack.pop()
            e = rows[n]
            styled = any(not isinstance(p, str) and rows[p]["tag"] in INLINE_TAGS for p in e["parts"])
            text = None
            if e["tag"] != "img":
                if styled:
                    text = "".join(p if isinstance(p, str) else markup(rows, p) for p in e["parts"] if isinstance(p, str) or rows[p]["tag"] in INLINE_TAGS).strip()
                elif len(e["parts"]) == 1 and isinstance(e["parts"][0], str):
                    text = e["parts"][0].strip()
                else:
                    text = next((p.strip() for p in e["parts"] if isinstance(p, str) and p.strip()), None)
            out.append((n, parent, depth, seq, e["tag"], None if text is None else _CONTROL.sub("", text), e["attrs"].get("data-sources"), e["tag"] in NODE_TAGS))
            if e["tag"] != "img":
                below = [p for p in e["parts"] if not isinstance(p, str) and rows[p]["tag"] not in INLINE_TAGS]
                stack += [(p, n, depth + 1, k) for k, p in reversed(list(enumerate(below)))]

    for k, e in enumerate([r for r in rows if r["parent"] is None]):
        visit(e["ord"], None, 0, k)
    return out


def create_nodes(pages: DataFrame, key: str, html: str, paths: bool = False) -> DataFrame:
    """Node rows of every page (see nodes_of), in document order; with paths also `path`, the ords from the root.

    Rows leave in batches of bounded size, so that a page nested to any depth needs bounded memory.
    """
    kind = pages.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in NODES.split(", ")] + ["path"] * paths
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_()] + [pa.list_(pa.int32())] * paths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(keys, rows, of):
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(keys, of), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=[key, *names])

        for b in batches:
            of = b.schema.field(0).type
            keys, rows, held = [], [], 0
            for at in range(b.num_rows):
                k, found = b.column(0)[at].as_py(), nodes_of(b.column(1)[at].as_py())
                up = {r[0]: r[1] for r in found} if paths else {}
                for r in found:
                    if paths:
                        path, n = [], r[0]
                        while n is not None:
                            path.append(n)
                            n = up[n]
                        r = (*r, path[::-1])
                    # some 100 characters of memory go to a row, and 10 to a step of its path
                    held += 100 + len(r[5] or "") + 10 * len(r[-1] if paths else ())
                    keys.append(k)
                    rows.append(r)
                    if held > HELD:
                        yield table(keys, rows, of)
                        keys, rows, held = [], [], 0
            yield table(keys, rows, of)

    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, {NODES}" + ", path array<int>" * paths)


def document_graph(pages: DataFrame, key: str, html: str, blocks: DataFrame) -> DataFrame:
    """Nodes of every page with what their content blocks know: path, positions and picture fields.

    blocks: key, block_id, block_type, page_number, page_logical, x1, y1, x2, y2, storage_url,
    description, caption. Ids in data-sources that no block has don't count, nor does an attribute
    that is no id range. positions holds one box a page, with the first logical page known; a picture
    takes its fields from its first source that is one. path lists the ords from the root.
    """
    nodes = create_nodes(pages, key, html, paths=True)
    ids = X.parse_ranges(F.col("sources"))["ids"]
    wanted = nodes.filter("sources is not null").select(key, "ord", "tag", F.posexplode(ids).alias("pos", "block_id"))
    j = wanted.join(blocks, [key, "block_id"])
    box = j.groupBy(key, "ord", "page_number").agg(
        F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.min(F.when(F.col("page_logical").isNotNull(), F.struct("pos", "page_logical")))["page_logical"].alias("page_logical"),
    )
    positions = box.groupBy(key, "ord").agg(F.sort_array(F.collect_list(F.struct("page_number", "page_logical", "x1", "y1", "x2", "y2"))).alias("positions"))
    pictures = j.filter("tag = 'img' and block_type = 'Picture'").groupBy(key, "ord").agg(F.min_by(F.struct("storage_url", "description", "caption"), "pos").alias("p"))
    return nodes.join(positions, [key, "ord"], "left").join(pictures, [key, "ord"], "left").select("*", "p.*").drop("p")


def pretty_print(pages: DataFrame, key: str, html: str) -> DataFrame:
    """HTML reparsed and indented by one space a level; attributes in their order."""
    kind = pages.schema[key].dataType.simpleString()

    def show(h: str | None) -> str:
        rows, lines = elements_of(h), []

        stack = [(r["ord"], 0) for r in reversed(rows) if r["parent"] is None]
        while stack:
            x, depth = stack.pop()
            if isinstance(x, str):
                if x.strip():
                    lines.append(" " * depth + x.strip())
                continue
            e = rows[x]
            attrs = "".join(f' {a}="{v}"' for a, v in e["attrs"].items())
            lines.append(" " * depth + f"<{e['tag']}{attrs}>")
            if e["tag"] not in VOID:
                stack.append((f"</{e['tag']}>", depth))
            stack += [(p, depth + 1) for p in reversed(e["parts"])]
        return "\n".join(lines)

    def run(batches):
        for b in batches:
            out = [show(h) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=[key, "pretty"])

    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, pretty string")


def tags_in(html: Column) -> Column:
    """Lower-case names of the start tags in the body (in all of the text without one), by pattern."""
    return F.transform(F.regexp_extract_all(X.html_body(html), F.lit("<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1)), F.lower)


def disallowed_tags(html: Column, exclude: list[str] | None = None) -> Column:
    allowed = [t for t in NODE_TAGS + INLINE_TAGS if t not in {x.lower() for x in exclude or []}]
    return F.array_sort(F.array_except(F.array_distinct(tags_in(html)), F.array(*[F.lit(t) for t in allowed])))


def element_issues(elements: DataFrame, key: str) -> DataFrame:
    """Issues of single elements: both attributes at once, deferred elements with content, sources without."""
    has = lambda a: F.col("attrs").getItem(a).isNotNull()
    text = F.regexp_replace("own_text", "[ \\t\\n\\r\\f\\x0B]+", "") != ""
    e = elements.select(key, "ord", "tag", has("data-sources").alias("s"), has("data-children").alias("c"), text.alias("has_text"), "n_children", "parent")
    inner = elements.filter(~F.col("tag").isin(INLINE_TAGS)).groupBy(key, F.col("parent").alias("ord")).agg(F.count("*").alias("n_structural"))
    e = e.join(inner, [key, "ord"], "left").withColumn("n_structural", F.coalesce("n_structural", F.lit(0)))
    codes = F.array_compact(F.array(
        F.when(F.col("s") & F.col("c"), "BOTH_ATTRIBUTES"),
        F.when(F.col("c") & (F.col("has_text") | (F.col("n_children") > 0)), "CHILDREN_NOT_EMPTY"),
        F.when(F.col("s") & (F.col("tag") != "img") & ~F.col("has_text") & (F.col("n_structural") == 0), "SOURCES_NOT_POPULATED"),
    ))
    return e.select(key, "ord", "tag", F.explode(codes).alias("code"))


def coverage_issues(ids: DataFrame, key: str) -> DataFrame:
    """ids: key, id, is_input, in_sources, in_children. One row for every id that breaks a rule."""
    out = F.col("in_sources") | F.col("in_children")
    codes = F.array_compact(F.array(
        F.when(F.col("is_input") & ~out, "MISSING_COVERAGE"), F.when(F.col("in_sources") & F.col("in_children"), "OVERLAP"), F.when(~F.col("is_input") & out, "EXTRA_ID"),
    ))
    return ids.select(key, "id", F.explode(codes).alias("code"))
