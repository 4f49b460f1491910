"""Readers of the files that document processing starts from."""

from __future__ import annotations

import os
import zlib
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYOUT = "left double, top double, width double, height double, page_number int, page_width double, page_height double, text string, type string"
BOX = "struct<x1: double, y1: double, x2: double, y2: double>"
CONTENT = f"positional_data struct<page_pdf: int, page_logical: string, bbox: {BOX}>, block_type string, embedding_source string, text_content string, storage_url string, description string, caption string"
# fixed values: the types of a layout block
BLOCK_TYPES = ["Text", "Title", "Section header", "Picture", "Table", "List item", "Formula", "Footnote", "Page header", "Page footer", "Caption"]


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path in the file system of this machine that a file: URL or, without another default, an absolute path names; None for any other."""
    if path.startswith("/"):
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
        return path if not default or default.startswith("file:") else None
    u = urlsplit(path)
    return unquote(u.path) if u.scheme == "file" and u.netloc in ("", "localhost") else None


def _whole_files(spark: SparkSession, path: str) -> DataFrame | None:
    """file_path, value (bytes) of the files in a local or mounted folder and in its folders named key=value; None for all else.

    Tasks list and read the files, so the driver holds none of them. Names with _ or . in front are passed over.
    """
    root = local_path(spark, path)
    if root is None or not os.path.isdir(root) or any(c in root for c in "*?[{\\"):
        return None
    hidden = lambda n: n[0] == "." or n.endswith("._COPYING_") or (n[0] == "_" and "=" not in n)
    folder = lambda e: "=" in e.name and not hidden(e.name) and e.is_dir()
    slices = 4 * spark.sparkContext.defaultParallelism
    with os.scandir(root) as found:
        work = [(e.path, 0, 1) for e in found if folder(e)]
    # files right in the folder may be many: every slice lists it and takes its share of the names
    work = sorted(work) + [(root, k, slices) for k in range(slices)]

    def run(batches):
        schema = pa.schema([("file_path", pa.string()), ("value", pa.binary())])
        local, names, values, held = pa.fs.LocalFileSystem(), [], [], 0

        def files(top, deep):
            with os.scandir(top) as found:
                entries = sorted(found, key=lambda e: e.name)
            for e in entries:
                if deep and folder(e):
                    yield from files(e.path, True)
                elif not hidden(e.name) and e.is_file():
                    yield e

        for b in batches:
            for top, k, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for e in files(top, n == 1):
                    if n > 1 and zlib.crc32(os.fsencode(e.name)) % n != k:
                        continue
                    if e.name.endswith((".gz", ".bz2", ".zst", ".lz4")):
                        with local.open_input_stream(e.path) as f:
                            values.append(f.read())
                    else:
                        with open(e.path, "rb") as f:
                            values.append(f.read())
                    names.append(e.path)
                    held += len(values[-1])
                    if held > 4_000_000 or len(names) >= 2000:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], schema=schema)
                        names, values, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], schema=schema)

    rows = spark.createDataFrame(work, "folder string, k int, n int").repartition(slices)
    return rows.mapInArrow(run, "file_path string, value binary")


def _json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """file_path and the rows of JSON array files; a file that is no JSON is a row of nulls, an empty one is none."""
    files = _whole_files(spark, path)
    if files is None:
        return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file_path", F.col("_metadata.file_path"))
    text = files.select("file_path", F.ltrim(F.col("value").cast("string"), F.lit("\ufeff")).alias("value")).filter(F.btrim("value", F.lit(" \t\r\n")) != "")
    many = f"array<struct<{schema}>>"
    items = text.select("file_path", F.explode(F.coalesce(F.from_json("value", many), F.array(F.lit(None)).cast(many))).alias("b"))
    return items.select("file_path", "b.*")


def layout_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of JSON array files with a fixed schema; unknown fields are dropped, rows of unknown type or page below 1 too."""
    rows = _json_rows(spark, path, LAYOUT)
    return rows.filter(F.col("type").isin(BLOCK_TYPES) & (F.col("page_number") >= 1)).select(*[c.split()[0] for c in LAYOUT.split(", ")])


def content_blocks_json(spark: SparkSession, path: str) -> DataFrame:
    """Content blocks of doc_{id}_content_blocks.json files, with document_id from the name."""
    rows = _json_rows(spark, path, CONTENT)
    return rows.withColumn("document_id", F.regexp_extract("file_path", "doc_([0-9]+)_", 1).try_cast("long")).drop("file_path")


def html_documents(spark: SparkSession, path: str) -> DataFrame:
    """document_id, html: one row for each doc_{id}.html file."""
    rows = _whole_files(spark, path)
    if rows is None:
        rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), "value")
    return rows.select(F.regexp_extract("file_path", "doc_([0-9]+)", 1).try_cast("long").alias("document_id"), F.col("value").cast("string").alias("html"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path, size and time of files below a folder; folder placeholders are left out."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return rows.select("path", F.col("length").alias("size"), "modificationTime").filter(~F.col("path").endswith("/"))


def jdbc_tables(spark: SparkSession, url: str, tables: list[str], properties: dict[str, str]) -> dict[str, DataFrame]:
    """Catalogue tables of a database, filters and columns pushed down by the source."""
    return {t: spark.read.jdbc(url, t, properties=properties) for t in tables}


def require(environment: dict[str, str], *alternatives: list[str]) -> None:
    """Fails unless all keys of at least one alternative are set and not blank."""
    if not any(all(environment.get(k, "").strip() for k in keys) for keys in alternatives):
        raise OSError("missing settings: " + " or ".join(", ".join(keys) for keys in alternatives))


def _svg_rows(svg: str) -> list[tuple]:
    """(tag, id, x0, y0, x1, y1) of shapes; groups, definitions and font glyphs are skipped, broken XML gives none."""
    import re
    from xml.etree import ElementTree

    try:
        root = ElementTree.fromstring(svg)
    except ElementTree.ParseError:
        return []
    out = []
    number = lambda e, k: float(re.match(r"-?[0-9.]+", e.get(k, "0") or "0").group())
    for e in root.iter():
        tag, name = e.tag.rpartition("}")[2], e.get("id", "")
        if name.startswith("font_"):
            continue
        if tag in ("rect", "image"):
            x, y = number(e, "x"), number(e, "y")
            box = (x, y, x + number(e, "width"), y + number(e, "height"))
        elif tag in ("circle", "ellipse"):
            rx, ry = (number(e, "r"),) * 2 if tag == "circle" else (number(e, "rx"), number(e, "ry"))
            box = (number(e, "cx") - rx, number(e, "cy") - ry, number(e, "cx") + rx, number(e, "cy") + ry)
        elif tag == "line":
            xs, ys = sorted((number(e, "x1"), number(e, "x2"))), sorted((number(e, "y1"), number(e, "y2")))
            box = (xs[0], ys[0], xs[1], ys[1])
        elif tag in ("path", "polygon", "polyline"):
            n = [float(v) for v in re.findall(r"-?[0-9]+\.?[0-9]*", e.get("d", "") or e.get("points", ""))]
            if len(n) < 4:
                continue
            box = (min(n[0::2]), min(n[1::2]), max(n[0::2]), max(n[1::2]))
        else:
            continue
        out.append((tag, name, *map(float, box)))
    return out


def svg_elements(files: DataFrame, key: str, svg: str) -> DataFrame:
    """Boxes of the shapes in SVG texts (absolute coordinates of paths), one row each."""
    kind = files.schema[key].dataType.simpleString()

    def run(frames):
        import pandas as pd

        for f in frames:
            rows = [(k, *r) for k, s in zip(f[key], f[svg], strict=True) for r in _svg_rows(s or "")]
            yield pd.DataFrame(rows, columns=[key, "tag", "element_id", "x0", "y0", "x1", "y1"])

    return files.select(key, svg).mapInPandas(run, f"{key} {kind}, tag string, element_id string, x0 double, y0 double, x1 double, y1 double")


def has_geometry(x0, y0, x1, y1):
    """Whether a box has any extent."""
    return (x1 > x0) | (y1 > y0)
