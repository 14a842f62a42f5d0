"""The query of F6 reads the windows of all records and all replies, not replies alone."""

from chatmill.plans.catalog import q_filter_nonempty


def write_tables(spark, sf, turns):
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{sf}/conversations.parquet")
    spark.createDataFrame([(1, "the passage"), (9, "of no conversation")], "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string").write.parquet(f"{sf}/pages.parquet")


def test_records_and_replies(spark, tmp_path):
    write_tables(spark, str(tmp_path), [(1, 0, "user", "what"), (1, 1, "assistant", "one two three four"), (1, 2, "user", "and"), (1, 3, "assistant", "")])
    got = {r.rec_key: r.n_ids for r in q_filter_nonempty(spark, str(tmp_path)).collect()}
    assert {"squad:1:0", "squad_v2:1:0", "trivia_qa:1:0", "squad:1:2", "squad_v2:1:2"} <= got.keys()
    assert got["reply:1:0"] == 4 and "reply:1:2" not in got
