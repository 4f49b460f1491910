"""The pipeline stage by stage on the small tables."""

import os

import corpus_pipeline
import pytest
from pagewright.llm import decontam, neardup, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_stages(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert out.columns == columns
        seen.append((docs, out))
        docs = out
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    a, b = seen[0]
    assert ids(b) == {r.doc_id for r in toxicity.score_documents(a, labels).collect() if not r.predicted}
    a, b = seen[1]
    assert ids(b) == {r.doc_id for r in neardup.near_duplicates(a).collect() if r.kept}
    a, b = seen[2]
    assert ids(b) == ids(a) - {r.doc_id for r in decontam.contaminated(a, bench).collect()}
    a, b = seen[4]
    assert a.count() == b.count()
    assert corpus_pipeline.run(spark, FOLDER).count() == b.count()
