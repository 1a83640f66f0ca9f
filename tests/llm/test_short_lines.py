"""The pipeline's line stage looks at lines of any number of words."""

import corpus_pipeline


def test_short_boilerplate_goes(spark):
    rows = [(i, f"own {i}\nAll rights reserved.\n ", f"s{i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert out[0] == rows[0][1]
    assert all(out[i] == f"own {i}\n " for i in range(1, 12))
