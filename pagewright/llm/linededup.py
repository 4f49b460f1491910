"""Substring dedup by hashing lines and the sentences inside them.

A text splits at line ends and at the space after a sentence mark, so every unit keeps its offsets.
A unit is normalised (A-Z lowered, white space as single spaces) and hashed to 128 bits; equal
digests anywhere in the corpus are one unit. The occurrence that ranks first by (doc_id, start)
stays, the rest goes. A text is told from others of its doc_id by its hash, which ranks between the
doc_id and the place. min_words, 1 by default, lets repeated sentences stay that amount to fewer
words in a row; a line whose units are all repeats goes whatever its length.

Texts in which nothing is removed are not shuffled, but for the few that a bounded table of ids lets
pass besides.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from pagewright.llm.common import by_bit, cut

_BREAK = re.compile(r"\n|(?<=[.!?])[ \t]")
UNITS = "doc_id long, row long, unit int, start long, stop long, n_words int, line int, of int, d1 long, d2 long"


def units(text: str) -> list[tuple[int, int]]:
    """[start, end) of the units of a text, in code points; blank ones are left out."""
    out, at = [], 0
    for m in _BREAK.finditer(text):
        if text[at : m.start()].strip(" \t\n\r\v\f"):
            out.append((at, m.start()))
        at = m.end()
    if text[at:].strip(" \t\n\r\v\f"):
        out.append((at, len(text)))
    return out


def line_numbers(text: str, found: list[tuple[int, int]]) -> list[int]:
    """The line each unit of a text stands in."""
    out, line, at = [], 0, 0
    for a, b in found:
        line += text.count("\n", at, a)
        out.append(line)
        at = b
    return out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    names = ["doc_id", "row", "unit", "start", "stop", "n_words", "line", "of", "d1", "d2"]

    def table(cols, digests):
        d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)] + [pa.array(np.ascontiguousarray(d[:, k])) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        cols, digests = tuple([] for _ in kinds), []
        for i, h, t in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), batch.column("text"), strict=True):
            text = t.as_py() or ""
            found_units = units(text)
            lines = line_numbers(text, found_units)
            size = Counter(lines)
            for k, (a, b) in enumerate(found_units):
                found = text[a:b].encode("utf-8", "surrogatepass").lower().split()
                for c, v in zip(cols, (i, h, k, a, b, len(found), lines[k], size[lines[k]]), strict=True):
                    c.append(v)
                digests.append(xxh3_128_digest(b" ".join(found)))
            if len(digests) >= 50_000:
                yield table(cols, digests)
                cols, digests = tuple([] for _ in kinds), []
        if digests:
            yield table(cols, digests)


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"doc_id": [], "n_removed": [], "removed_chars": [], "spans": [], "clean_chars": [], "clean_sha256": [], "clean_text": []}
        for i, t, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("gone").to_pylist(), strict=True):
            text, spans = t.as_py() or "", spans or []
            kept, at = [], 0
            for s in spans:
                kept.append(text[at : s["start"]])
                at = s["stop"] + (s["stop"] < len(text))  # with the line end or space behind it
            kept.append(text[at:])
            clean = "".join(kept)
            out["doc_id"].append(i)
            out["n_removed"].append(len(spans))
            out["removed_chars"].append(len(text) - len(clean))
            out["spans"].append(",".join(f"{s['start']}:{s['stop']}:{s['first_doc']}:{s['first_start']}" for s in spans))
            out["clean_chars"].append(len(clean))
            out["clean_sha256"].append(hashlib.sha256(clean.encode("utf-8", "surrogatepass")).hexdigest())
            out["clean_text"].append(clean)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc_id", pa.int64()), ("n_removed", pa.int64()), ("removed_chars", pa.int64()), ("spans", pa.string()), ("clean_chars", pa.int64()), ("clean_sha256", pa.string()), ("clean_text", pa.string())]))


def remove_repeats(docs: DataFrame, min_words: int = 1) -> DataFrame:
    """doc_id, n_removed, removed_chars, spans, clean_chars, clean_sha256 and clean_text of every row.

    spans lists start:end:first_doc:first_start of the removed units (code points of the original
    text, end exclusive, comma-joined). Null and empty texts have no units. Rows with a null doc_id
    are kept as they are. Rows that repeat a doc_id with the same text are one occurrence, so neither
    is removed from the other; different texts of one doc_id are told apart. An empty table gives an
    empty result; further columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    # read twice: splitting again costs less than keeping a row for every unit on disk
    rows = docs.filter("doc_id is not null").mapInArrow(_units, UNITS)
    first = rows.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row", "start")).alias("first")).filter("n > 1").select("d1", "d2", F.col("first.doc_id").alias("first_doc"), F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start"))
    first = cut(first, "linededup-first")
    again = rows.join(first, ["d1", "d2"]).filter("doc_id <> first_doc or row <> first_row or start <> first_start").select("doc_id", "row", "unit", "start", "stop", "n_words", "line", "of", "first_doc", "first_start").distinct()
    if min_words > 1:
        w = Window.partitionBy("doc_id", "row")
        again = again.withColumn("run", F.col("unit") - F.row_number().over(w.orderBy("unit")))
        again = again.withColumn("run_words", F.sum("n_words").over(Window.partitionBy("doc_id", "row", "run")))
        again = again.withColumn("line_units", F.count("*").over(Window.partitionBy("doc_id", "row", "line")))
        again = again.filter((F.col("run_words") >= min_words) | (F.col("line_units") >= F.col("of")))
    gone = again.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "first_doc", "first_start"))).alias("gone"))
    gone = cut(gone, "linededup-gone")
    schema = "doc_id long, n_removed long, removed_chars long, spans string, clean_chars long, clean_sha256 string, clean_text string"
    maybe = by_bit(docs, gone.select("doc_id"))
    moved = maybe.filter("__maybe").drop("__maybe").join(gone, ["doc_id", "row"], "left").select("doc_id", "text", "gone")
    rest = maybe.filter("not __maybe").select("doc_id", "text", F.lit(None).cast(gone.schema["gone"].dataType).alias("gone"))
    return moved.union(rest).mapInArrow(_clean, schema)
