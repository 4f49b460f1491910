"""Chat formatting with a grammar round trip.

A turn is rendered as `<|im_start|>role`, a line end, the text, `<|im_end|>` and a line end; turns
follow one another by (turn, role, text). The parser splits at the two marks and takes one
backslash out of every `<\\|`, `<\\\\|` ... A turn whose text or role does not come back as it was is
rendered again with one backslash more in every `<|`, `<\\|` ...; roles also escape line ends. The
escaped form never holds a mark, so the second round trip gives the source; a turn that still
differs raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, "<(\\\\*)\\|", "<$1\\\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "<\\\\(\\\\*)\\|", "<$1|")


def escape_role(role: Column) -> Column:
    """Backslashes doubled and line ends as backslash n, so that a role stays on its line."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), "\\\\\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """array<struct<role,text>> of rendered turns; null where the grammar does not fit."""
    pieces = F.split(formatted, "<\\|im_start\\|>", -1)
    bodies = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    tail = END + "\n"

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        body = F.substr(x, F.length(role) + 2, F.length(x) - F.length(role) - 1 - len(tail))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    def fits(x: Column) -> Column:
        return x.endswith(tail) & (F.size(F.split(x, "<\\|im_end\\|>", -1)) == 2) & (F.instr(x, "\n") < F.instr(x, END))

    return F.when((F.element_at(pieces, 1) == "") & F.forall(bodies, fits), F.transform(bodies, turn))


def format_turns(turns: DataFrame) -> DataFrame:
    """Every turn with `piece`, its rendered text, escaped only where the plain form does not parse back.

    A null role or text counts as empty.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    same = lambda p: (F.size(p) == 1) & (p[0]["role"] == F.col("role")) & (p[0]["text"] == F.col("text"))
    plain = render(F.col("role"), F.col("text"))
    rows = rows.withColumn("piece", plain).withColumn("back", parse(F.col("piece")))
    # a turn without `<` or backslash, and a role of one line, are safe in either form
    rows = rows.withColumn("piece", F.when(F.coalesce(same(F.col("back")), F.lit(False)), F.col("piece")).otherwise(render(escape_role(F.col("role")), escape(F.col("text")))))
    rows = rows.withColumn("back", parse(F.col("piece")))
    wrong = F.raise_error(F.concat(F.lit("a turn does not survive its round trip, conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    return rows.withColumn("piece", F.when(F.coalesce(same(F.col("back")), F.lit(False)), F.col("piece")).otherwise(wrong.cast("string"))).drop("back")


def format_conversations(turns: DataFrame, chunk: int = 256) -> DataFrame:
    """conv_id, formatted (all chunks' text) as `chunks`: array<struct<text, spans>> in order.

    spans hold [start, end) of the loss-bearing (assistant) texts inside a chunk, in code points. A
    chunk gathers `chunk` successive values of turn, so a conversation of any length is put together
    from bounded pieces; only its final text is one value. Null turns come first. Repeated and tied
    turns all stay, ordered by (turn, role, text). An empty table gives no rows.
    """
    rows = format_turns(turns)
    head = F.length(F.lit(START)) + F.length(F.col("piece")) * 0
    escaped_role = F.length(F.substring_index(F.substr("piece", F.lit(len(START) + 1)), "\n", 1))
    start = head + escaped_role + 1
    stop = F.length("piece") - len(END) - 1
    rows = rows.select("conv_id", F.floor(F.col("turn") / chunk).alias("part"), F.struct("turn", "role", "text", "piece", F.length("piece").alias("n"), start.alias("a"), stop.alias("b")).alias("t"))
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<a:int,b:int>>)").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        span = F.struct((acc["at"] + t["a"]).cast("int").alias("a"), (acc["at"] + t["b"]).cast("int").alias("b"))
        spans = F.when(t["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((acc["at"] + t["n"]).cast("int").alias("at"), spans.alias("spans"))

    spans = F.aggregate("ts", zero, step, lambda acc: acc["spans"])
    parts = parts.select("conv_id", F.struct("part", F.array_join(F.transform("ts", lambda t: t["piece"]), "").alias("text"), spans.alias("spans")).alias("c"))
    return parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("c")).alias("chunks"))


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted text says when it is read back: turns and the text under the loss mask."""
    chunks = F.col("chunks")
    turns = F.flatten(F.transform(chunks, lambda c: parse(c["text"])))
    loss = F.flatten(F.transform(chunks, lambda c: F.transform(c["spans"], lambda s: unescape(F.substr(c["text"], s["a"] + 1, s["b"] - s["a"])))))
    rows = formatted.select("conv_id", turns.alias("turns"), F.array_join(loss, "").alias("loss"), F.aggregate(chunks, F.lit(0).cast("long"), lambda a, c: a + F.length(c["text"])).alias("formatted_chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
