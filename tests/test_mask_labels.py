"""The query of C5 encodes a text once: no filter is pushed below the encoding."""

from chatmill.plans.catalog import q_mask_labels


def test_one_encoding(spark, tmp_path):
    sf = str(tmp_path)
    turns = [(1, 0, "user", "what"), (1, 1, "assistant", "one two three")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{sf}/conversations.parquet")
    spark.createDataFrame([(1, "the passage")], "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string").write.parquet(f"{sf}/pages.parquet")
    df = q_mask_labels(spark, sf)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert sorted(r.rec_key for r in df.collect()) == ["squad:1:0", "squad_v2:1:0", "trivia_qa:1:0"]
