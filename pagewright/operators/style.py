"""Inline styling of block text by spans of the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import exprs as X


def best_match(text: Column, span: Column) -> Column:
    """struct<rule, n>: how a span is found in a text, both in match form.

    contains: n places; words: all words over two letters are words of the text, and all words occur in
    order, with gaps, at word borders; most: of at least three words 70 % are words of the text. Null
    rule for none.
    """
    t, s = X.match_form(text), X.match_form(span)
    words, own = F.split(s, " "), F.split(t, " ")
    long = F.filter(words, lambda w: F.length(w) > 2)
    here = F.size(F.filter(words, lambda w: F.array_contains(own, w)))
    quoted = F.transform(words, lambda w: F.regexp_replace(w, "([^A-Za-z0-9_\\u0080-\\uFFFF])", "\\\\$1"))
    ordered = F.regexp_count(t, F.concat(F.lit("(?U)\\b"), F.array_join(quoted, "\\b.*?\\b"), F.lit("\\b")))
    n = F.floor((F.length(t) - F.length(F.replace(t, s, F.lit("")))) / F.greatest(F.length(s), F.lit(1))).cast("int")
    return (
        F.when((s != "") & (n > 0), F.struct(F.lit("contains").alias("rule"), n.alias("n")))
        .when((F.size(words) > 1) & F.forall(long, lambda w: F.array_contains(own, w)) & (ordered > 0), F.struct(F.lit("words").alias("rule"), ordered.alias("n")))
        .when((F.size(words) >= 3) & (here >= F.ceil(F.size(words) * 0.7)), F.struct(F.lit("most").alias("rule"), F.lit(1).alias("n")))
    )


def apply_spans(text: Column, spans: Column) -> Column:
    """Folds array<struct<text, flags>> over a text, longest span first.

    A span that occurs exactly once in the text as it stands by then (case aside) is replaced by its
    own, styled, text; a span found several times or never leaves it alone.
    """

    def step(t: Column, s: Column) -> Column:
        low, find = F.lower(t), F.lower(s["text"])
        at = F.instr(low, find)
        once = (at > 0) & (F.length(F.replace(low, find, F.lit(""))) == F.length(low) - F.length(find))
        return F.when(once, F.concat(F.substr(t, F.lit(1), at - 1), X.styled(s["text"], s["flags"]), F.substr(t, at + F.length(find)))).otherwise(t)

    ordered = F.transform(F.array_sort(F.transform(spans, lambda s: F.struct((-F.length(s["text"])).alias("k"), s["pos"].alias("pos"), s["text"].alias("text"), s["flags"].alias("flags")))), lambda s: s)
    return F.aggregate(ordered, text, step)


def excluded(kind: Column, y1: Column, y2: Column, page_height: Column) -> Column:
    """Whether a block is furniture, by its type or by its place in the page margins."""
    return F.coalesce(kind.isin(X.HEADER, X.FOOTER), F.lit(False)) | X.furniture(y1, y2, page_height).isNotNull()


def style_blocks(blocks: DataFrame, spans: DataFrame, page_height: float) -> DataFrame:
    """Blocks, without page furniture, with their text styled by the spans of their page.

    Spans are stripped; those without a style or text don't count. Where the text changes, stored
    picture fields go.
    """
    blocks = blocks.filter(~excluded(F.col("block_type"), F.col("y1"), F.col("y2"), F.lit(page_height)))
    s = spans.filter((F.col("flags").bitwiseAND(18) != 0) & X.has_text(F.col("text"))).withColumn("text", X.strip(F.col("text")))
    per_page = s.groupBy("doc_id", "page_number").agg(F.collect_list(F.struct("text", "flags", F.col("span_pos").alias("pos"))).alias("spans"))
    j = blocks.join(per_page, ["doc_id", "page_number"], "left")
    new = F.when((F.col("block_type") != "Picture") & F.col("spans").isNotNull(), apply_spans(F.col("text_content"), F.col("spans"))).otherwise(F.col("text_content"))
    j = j.withColumn("new", new).withColumn("changed", ~F.col("new").eqNullSafe(F.col("text_content")))
    for c in ("storage_url", "description", "caption"):
        j = j.withColumn(c, F.when(~F.col("changed"), F.col(c)))
    return j.withColumn("text_content", F.col("new")).drop("new", "spans")


def styling_summary(blocks: DataFrame, spans: DataFrame, page_height: float) -> DataFrame:
    """One row: blocks kept, blocks styled, tags applied in them, and blocks excluded as page furniture."""
    s = style_blocks(blocks, spans, page_height)
    tags = F.when(F.col("changed"), F.regexp_count("text_content", F.lit("<[bi]>"))).otherwise(0)
    kept = s.agg(F.count("*").alias("total"), F.count_if("changed").alias("styled"), F.coalesce(F.sum(tags), F.lit(0)).alias("spans_applied"))
    gone = blocks.agg(F.count_if(excluded(F.col("block_type"), F.col("y1"), F.col("y2"), F.lit(page_height))).alias("excluded"))
    return kept.crossJoin(gone)  # one row each
