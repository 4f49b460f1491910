"""Tasks for models as tables: what a response must be, which attempt counts, and what the next one is told.

A check is a Column function of the response (and of columns of its request): struct<error, result>,
where error is null if the response will do. responses: request_key, attempt (from 1), response.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import exprs as X

ATTEMPTS = 3
# fixed values: classes and labels a model may answer with, and the longest section in characters
BLOCK_CLASSES = ["text", "picture", "table"]
IMAGE_LABELS = ["chart", "graph", "diagram", "map", "photo", "table", "text_box"]
SECTION_TAGS = ["section", "aside", "nav"]
LONGEST = 3 * 64000


def _fields(response: Column, schema: str) -> Column:
    """The JSON object of a response (fenced or not) by schema; null where it is none."""
    found = lambda x: F.from_json(x, f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return X.bind(X.de_fence(response), lambda x: F.when(x.startswith("{"), X.bind(found(x), lambda f: F.when(f["_bad"].isNull(), f))))


def _answer(error: Column, result: Column) -> Column:
    return X.bind(error.cast("string"), lambda e: F.struct(e.alias("error"), F.when(e.isNull(), result.cast("string")).alias("result")))


def page_mapping(response: Column) -> Column:
    """{"mapping": {page: label or null}}; result: the mapping as JSON."""
    kinds = F.try_variant_get(F.try_parse_json(X.de_fence(response)), "$.mapping", "map<string,variant>")
    bad = F.exists(F.map_values(kinds), lambda v: ~F.schema_of_variant(v).isin("STRING", "VOID"))
    error = F.when(F.try_parse_json(X.de_fence(response)).isNull(), "no JSON").when(kinds.isNull(), "no mapping").when(F.coalesce(bad, F.lit(False)), "a label is no text")
    return _answer(error, F.to_json(_fields(response, "mapping map<string,string>")["mapping"], {"ignoreNullFields": "false"}))


def one_of(response: Column, field: str, values: list[str]) -> Column:
    """A class out of a list."""
    got = _fields(response, f"{field} string")[field]
    return _answer(F.when(got.isNull() | ~got.isin(values), f"{field} is none of the classes"), got)


def image_description(response: Column) -> Column:
    """A label out of the list and a description: "label: description"."""
    got = _fields(response, "label string, description string")
    error = F.when(got.isNull() | got["description"].isNull() | ~F.coalesce(got["label"].isin(IMAGE_LABELS), F.lit(False)), "no label or description")
    return _answer(error, F.concat_ws(": ", got["label"], got["description"]))


def _covers(bounds: Column, total: Column, doubles_first: bool) -> Column:
    """Why id ranges are not 0 .. total - 1, each id once; null if they are. One walk over the sorted bounds, no ids are made."""

    def step(a, r):
        return F.struct(F.greatest(a["reach"], r["hi"]).alias("reach"), (a["gap"] | (r["lo"] > a["reach"] + 1)).alias("gap"), (a["twice"] | (r["lo"] <= a["reach"])).alias("twice"))

    def reason(a):
        off = a["gap"] | (a["reach"] != F.greatest(F.coalesce(total, F.lit(0)), F.lit(0)) - 1)
        return F.when(a["twice"], "duplicate ids").when(off, "coverage") if doubles_first else F.when(off, "coverage").when(a["twice"], "duplicate ids")

    start = F.struct(F.lit(-1).alias("reach"), F.lit(False).alias("gap"), F.lit(False).alias("twice"))
    return F.aggregate(F.array_sort(bounds), start, step, reason)


def top_level_structure(response: Column, total: Column) -> Column:
    """Three id ranges (header, main, footer) that share out the blocks 0 .. total - 1; result: the three as JSON."""
    names = ("header", "main", "footer")

    def check(got):
        def judge(parts):
            missing = F.coalesce(got.isNull() | got["header"].isNull() | got["main"].isNull() | got["footer"].isNull(), F.lit(True))
            wrong = F.coalesce(*[parts[k]["error"] for k in range(3)])
            return F.when(missing, "no JSON of three ranges").when(wrong.isNotNull(), wrong).otherwise(_covers(F.flatten(F.transform(parts, lambda p: p["bounds"])), total, True))

        error = X.bind(F.array(*[X.parse_bounds(got[f]) for f in names]), judge)
        return _answer(error, F.to_json(F.struct(*[got[f].alias(f) for f in names])))

    return X.bind(_fields(response, "header string, main string, footer string"), check)


def lines_by_id(html: Column) -> Column:
    """The lines of a flat HTML, one tag a line, of the ids 0, 1 and so on up to the first that has none; the first line if several have one id."""

    def named(x, i):
        return X.bind(F.regexp_extract(x, '^.+ id="([0-9]+)".+$', 1), lambda d: F.struct(F.when(d.try_cast("int").cast("string") == d, d.try_cast("int")).alias("id"), i.alias("i"), x.alias("line")))

    rows = F.array_sort(F.filter(F.transform(F.split(html, "\n", -1), named), lambda p: p["id"].isNotNull()))
    first = X.bind(rows, lambda r: F.filter(r, lambda p, i: F.when(i > 0, F.get(r, i - 1)["id"] != p["id"]).otherwise(True)))
    return F.transform(F.filter(first, lambda p, i: p["id"] == i), lambda p: p["line"])


def group_html(own: Column, bounds: Column) -> Column:
    """The lines of id ranges out of lines_by_id; null where an id has none."""
    found = F.forall(bounds, lambda r: r["hi"] < F.size(own))
    return F.when(found, F.array_join(F.flatten(F.transform(F.array_sort(bounds), lambda r: F.slice(own, r["lo"] + 1, r["hi"] - r["lo"] + 1))), "\n"))


def split_groups(response: Column, total: Column, html: Column) -> Column:
    """Groups of ids (range, tag) that share out the blocks, each id a line of the HTML, no group too long; result: the groups as JSON."""

    def check(got):
        odd = F.exists(got, lambda g: ~F.coalesce(X.valid_range_text(g["range"]), F.lit(False)) | ~F.coalesce(g["tag"].isin(SECTION_TAGS), F.lit(True)))

        def judge(parts):
            wrong = F.get(F.filter(F.transform(parts, lambda p: p["error"]), lambda e: e.isNotNull()), F.lit(0))
            covers = _covers(F.flatten(F.transform(parts, lambda p: p["bounds"])), total, False)
            lengths = X.bind(lines_by_id(html), lambda own: F.transform(parts, lambda p: F.length(group_html(own, p["bounds"]))))
            lost = lambda n: F.when(F.exists(n, lambda k: k.isNull()), "id not found").when(F.exists(n, lambda k: k > LONGEST), "too long")
            return X.bind(F.coalesce(wrong, covers), lambda e: F.when(e.isNotNull(), e).otherwise(X.bind(lengths, lost)))

        error = F.when(got.isNull(), "no JSON of groups").when(odd, "range or tag").otherwise(X.bind(F.transform(got, lambda g: X.parse_bounds(g["range"])), judge))
        return _answer(error, F.to_json(got))

    return X.bind(_fields(response, "groups array<struct<range:string,tag:string>>")["groups"], check)


def restructured_html(response: Column) -> Column:
    """{"html": ...}, not blank, every data-sources of digits, blanks, dashes and commas; result: the HTML."""
    html = _fields(response, "html string")["html"]
    sources = F.regexp_extract_all(html, F.lit('data-sources="([^"]+)"'), F.lit(1))
    error = F.when(html.isNull(), "no JSON").when(X.strip(html) == "", "empty").when(F.exists(sources, lambda s: ~X.valid_range_text(s)), "data-sources")
    return _answer(error, html)


def settle(requests: DataFrame, responses: DataFrame, check: Callable[[Column], Column], fallback: Column | None = None) -> DataFrame:
    """requests with status, result, n_failed and error.

    Of at most ATTEMPTS responses the first that passes counts (ok); n_failed is the number before it,
    error what the last of these got wrong. Without one the fallback, a column of the request, stands in
    (fallback), or the request has failed; without any response it is open.
    """
    a = requests.join(responses.filter(F.col("attempt") <= ATTEMPTS), "request_key", "left")
    a = a.withColumn("c", F.when(F.col("attempt").isNotNull(), check(F.col("response"))))
    passed = F.col("c.error").isNull() & F.col("attempt").isNotNull()
    wrong = F.when(F.col("c.error").isNotNull(), F.struct("attempt", F.col("c.error").alias("error")))
    per = a.groupBy("request_key").agg(F.min(F.when(passed, F.struct("attempt", F.col("c.result").alias("result")))).alias("__ok"), F.array_sort(F.collect_list(wrong)).alias("__bad"), F.count("attempt").alias("__tried"))
    j = requests.join(per, "request_key")
    bad = F.filter("__bad", lambda b: F.col("__ok").isNull() | (b["attempt"] < F.col("__ok.attempt")))
    j = j.withColumn("__bad", bad)
    ok, tried = F.col("__ok").isNotNull(), F.col("__tried") > 0
    stand_in = F.lit(None).cast("string") if fallback is None else fallback
    status = F.when(ok, "ok").when(~tried, "open").when(stand_in.isNotNull(), "fallback").otherwise("failed")
    result = F.coalesce(F.col("__ok.result"), F.when(tried & ~ok, stand_in))
    return j.select(*requests.columns, status.alias("status"), result.alias("result"), F.size("__bad").alias("n_failed"), F.get("__bad", F.size("__bad") - 1)["error"].alias("error"))


def retries(requests: DataFrame, responses: DataFrame, check: Callable[[Column], Column]) -> DataFrame:
    """request_key, attempt, message: what the next attempt of every request is told that has no good response and attempts left."""
    s = settle(requests, responses, check).filter((F.col("status") == "failed") & (F.col("n_failed") < ATTEMPTS))
    text = F.concat(F.lit("Your previous response had a validation error: "), F.col("error"), F.lit(". Please correct your response to match the required schema and constraints."))
    return s.select("request_key", (F.col("n_failed") + 1).alias("attempt"), text.alias("message"))


def job_output(jobs: DataFrame, files: DataFrame) -> DataFrame:
    """jobs (job_id, output) with the content of the named output file, or an error that lists the files there are."""
    there = files.groupBy("job_id").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    found = files.select("job_id", F.col("path").alias("output"), "content")
    j = jobs.join(found, ["job_id", "output"], "left").join(there, "job_id", "left")
    error = F.concat(F.lit("no file "), F.col("output"), F.lit("; files: "), F.coalesce(F.array_join("paths", ", "), F.lit("")))
    return j.select("job_id", "content", F.when(F.col("content").isNull(), error).alias("error"))


def sections(settled: DataFrame, html: str) -> DataFrame:
    """request_key, section, tag, html: the sections of settled split_groups, each in its tag if it has one."""
    groups = F.from_json("result", "array<struct<range:string,tag:string>>")

    def show(own, g):
        return X.bind(group_html(own, X.parse_bounds(g["range"])["bounds"]), lambda inner: F.struct(
            g["tag"].alias("tag"), F.when(g["tag"].isNotNull(), F.concat(F.lit("<"), g["tag"], F.lit(">\n"), inner, F.lit("\n</"), g["tag"], F.lit(">"))).otherwise(inner).alias("html")))

    parts = X.bind(lines_by_id(F.col(html)), lambda own: F.transform(groups, lambda g: show(own, g)))
    return settled.filter("status = 'ok'").select("request_key", F.posexplode(parts).alias("section", "g")).select("request_key", "section", "g.tag", "g.html")
