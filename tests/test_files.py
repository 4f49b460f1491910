"""Files of many documents: written and read by tasks, one file each."""

import os

from pyspark.sql import functions as F

from pagewright.sources import readers, sinks


def names(path):
    return sorted(n for _, _, files in os.walk(path) for n in files if n[0] not in "._")


def folders(path):
    return sum(len(d) for _, d, _ in os.walk(path))


def test_content_blocks_take_no_folder_each(spark, tmp_path):
    """folders stay few however many documents there are; every document has its own file."""
    path = f"file://{tmp_path}/c"
    b = spark.range(0, 1200).select((F.col("id") % 600).alias("document_id"), F.floor(F.col("id") / 600).cast("int").alias("block_id"))
    where = F.struct(F.lit(1).alias("page_pdf"), F.lit(None).cast("string").alias("page_logical"), F.struct(*[F.lit(0.5).alias(c) for c in ("x1", "y1", "x2", "y2")]).alias("bbox"))
    none = {c: F.lit(None).cast("string") for c in ("storage_url", "description", "caption")}
    b = b.withColumns({"positional_data": where, "block_type": F.lit("Text"), "embedding_source": F.lit("TEXT_CONTENT"), "text_content": F.concat(F.lit("té\"\n"), F.col("block_id").cast("string")), **none})
    sinks.write_content_blocks(b, path)
    assert names(tmp_path / "c") == sorted(f"doc_{k}_content_blocks.json" for k in range(600))
    assert folders(tmp_path / "c") <= 256
    got = readers.content_blocks_json(spark, path).select("document_id", "text_content", "positional_data.bbox.x1").collect()
    assert sorted(map(tuple, got)) == sorted((k, f"té\"\n{j}", 0.5) for k in range(600) for j in (0, 1))


def test_odd_content_files(spark, tmp_path):
    """files in the folder itself, hidden, empty, broken and marked ones, as a JSON source reads them."""
    for k, x in {1: '[{"block_type": "a", "more": 1}, {"block_type": "b", "positional_data": {"page_pdf": "bad"}}]', 2: "[]", 3: " \n", 4: '[{"block_type": "cut"}, {"bl', 5: '﻿{"block_type": "one"}'}.items():
        (tmp_path / f"doc_{k}_content_blocks.json").write_text(x, encoding="utf-8")
    (tmp_path / ".doc_6_content_blocks.json").write_text('[{"block_type": "hidden"}]')
    (tmp_path / "_doc_7_content_blocks.json").write_text('[{"block_type": "hidden"}]')
    got = sorted((r.document_id, r.block_type) for r in readers.content_blocks_json(spark, str(tmp_path)).collect() if r.document_id != 4)
    assert got == [(1, "a"), (1, "b"), (5, "one")]
    assert [r.block_type for r in readers.content_blocks_json(spark, str(tmp_path)).filter("document_id = 4").collect()] == [None]


def test_layout_takes_no_folder_each(spark, tmp_path):
    """and a folder read is replaced as a whole by what was made of it."""
    path = f"file://{tmp_path}/l"
    kinds = "document_id long, input_pos int, left double, top double, width double, height double, page_number int, page_width double, page_height double, text string, type string"
    rows = [(k, j, 1.0, 2.0, 3.0, 4.0, 1, 9.0, 9.0, f"t{j}", "Text" if j else "Odd") for k in range(600) for j in (0, 1)]
    sinks.write_layout(spark.createDataFrame(rows, kinds), path)
    assert names(tmp_path / "l") == sorted(f"doc_{k}.json" for k in range(600)) and folders(tmp_path / "l") <= 256
    back = readers.layout_json(spark, path)
    assert [(r.text, r["count"]) for r in back.groupBy("text").count().collect()] == [("t1", 600)]
    sinks.write_layout(back.withColumns({"document_id": F.lit(7), "input_pos": F.lit(0)}), path)
    assert names(tmp_path / "l") == ["doc_7.json"] and readers.layout_json(spark, path).count() == 600
    assert os.listdir(tmp_path) == ["l"]


def test_html_takes_no_folder_each(spark, tmp_path):
    """names that occur twice share a file, a page without HTML has an empty one."""
    path = f"file://{tmp_path}/h"
    docs = spark.range(0, 600).select(F.col("id").alias("document_id"), F.when(F.col("id") != 3, F.concat(F.lit("<p>\r\n"), F.col("id").cast("string"))).alias("html"))
    sinks.write_html(docs.union(docs.filter("document_id = 5")), path)
    assert names(tmp_path / "h") == sorted(f"doc_{k}.html" for k in range(600)) and folders(tmp_path / "h") <= 256
    got = {r.document_id: r.html for r in readers.html_documents(spark, path).collect()}
    one = "<!-- Approved -->\n<p>\r\n5\n"
    assert len(got) == 600 and got[3] == "\n" and got[5] == one + one and got[599] == "<!-- Approved -->\n<p>\r\n599\n"
