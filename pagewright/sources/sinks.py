"""Writers of what document processing produces."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions.exprs import with_marker
from pagewright.sources.readers import local_path

FOLDERS = 256


def scratch(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see, below spark.checkpoint.dir; a temporary one in a session on one machine without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="pagewright-")
    return f"{shared.rstrip('/')}/files-{uuid.uuid4().hex}"


def _write_files(rows: DataFrame, path: str, unique: bool = False) -> None:
    """rows: file, value. Each file holds its text with a line end behind it; texts of one name follow each other, unless names are unique.

    On local or mounted paths tasks write part=k/{file} themselves, and the folder takes its place when all are done: nothing
    is kept, listed or renamed by the driver for each file. Elsewhere a folder named like the file holds its text.
    """
    root = local_path(rows.sparkSession, path)
    if root is None:
        return rows.repartition("file").write.mode("overwrite").partitionBy("file").text(path)
    root = root.rstrip("/")
    new = f"{root}-{uuid.uuid4().hex}"

    def put(batches):
        made = set()
        named = ((k, f, v) for b in batches for k, f, v in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True))
        for (k, file), same in groupby(named, lambda r: r[:2]):
            folder = f"{new}/part={k}"
            if folder not in made:
                os.makedirs(folder, exist_ok=True)
                made.add(folder)
            # readers pass over names with a dot in front: a file is there as a whole or not at all, whatever attempt wrote it
            part = f"{folder}/.{file}.{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                f.writelines((v or b"") + b"\n" for _, _, v in same)
            os.replace(part, f"{folder}/{file}")
        yield pa.RecordBatch.from_pydict({"n": [len(made)]}, schema=pa.schema([("n", pa.int64())]))

    os.makedirs(new)
    try:
        out = rows.select(F.pmod(F.hash("file"), F.lit(FOLDERS)).alias("k"), "file", F.col("value").cast("binary").alias("value"))
        out = out if unique else out.repartition("file").sortWithinPartitions("file")
        out.mapInArrow(put, "n long").agg(F.sum("n")).collect()
        if os.path.isdir(root):
            shutil.rmtree(root)
        elif os.path.exists(root):
            os.remove(root)
        os.replace(new, root)
    except BaseException:
        shutil.rmtree(new, ignore_errors=True)
        raise


def write_layout(blocks: DataFrame, path: str) -> None:
    """doc_{id}.json for each document: a JSON array of layout blocks, in input order."""
    fields = ["left", "top", "width", "height", "page_number", "page_width", "page_height", "text", "type"]
    a = blocks.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("input_pos", F.struct(*fields).alias("b")))).alias("x"))
    _write_files(a.select(F.format_string("doc_%d.json", "document_id").alias("file"), F.to_json(F.transform("x", lambda e: e["b"])).alias("value")), path, unique=True)


def write_content_blocks(blocks: DataFrame, path: str) -> None:
    """doc_{id}_content_blocks.json for each document: a JSON array of content blocks, by block_id."""
    fields = ["positional_data", "block_type", "embedding_source", "text_content", "storage_url", "description", "caption"]
    a = blocks.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("block_id", F.struct(*fields).alias("b")))).alias("x"))
    _write_files(a.select(F.format_string("doc_%d_content_blocks.json", "document_id").alias("file"), F.to_json(F.transform("x", lambda e: e["b"])).alias("value")), path, unique=True)


def write_html(documents: DataFrame, path: str, marker: str = "<!-- Approved -->") -> None:
    """doc_{id}.html for each document (document_id, html), approved marker in front, once."""
    _write_files(documents.select(F.format_string("doc_%d.html", "document_id").alias("file"), with_marker(F.col("html"), marker).alias("value")), path)


def append_nodes(nodes: DataFrame, content: DataFrame, path: str) -> None:
    nodes.write.mode("append").parquet(f"{path}/nodes")
    content.write.mode("append").parquet(f"{path}/content_data")


def append_embeddings(vectors: DataFrame, path: str, dimension: int) -> None:
    """Vectors of the right dimension only; a wrong one raises an error."""
    ok = F.when(F.size("vector") == dimension, F.col("vector")).otherwise(F.raise_error(F.lit("wrong dimension")).cast("array<float>"))
    vectors.withColumn("vector", ok).withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(path)
