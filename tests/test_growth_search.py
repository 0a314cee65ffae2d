"""Shuffles of the stored text index."""

from pyspark.sql import functions as F

from paperloom.operators import text_index
from paperloom.session import cut_lineage


def test_query_words_go_to_the_index(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"alpha w{k % 7} beta") for k in range(40)], "doc_id bigint, text string")
    built = text_index.build_index(docs, block_docs=8)
    shuffles = built._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in shuffles  # words are grouped where their block lies
    text_index.write_index(built, str(tmp_path / "index"))
    words = cut_lineage(spark.createDataFrame([(1, "alpha")], "query_id bigint, term string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = text_index.of_words(text_index.read_index(spark, str(tmp_path / "index")), words)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert rows.agg(F.sum("df")).first()[0] == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(text_index, "BLOCK_BYTES", 4000)
    docs = spark.createDataFrame([(k, "x" * 1000) for k in range(40)], "doc_id bigint, text string")
    assert text_index.blocked(docs, "doc_id", "text").select("block").distinct().count() >= 7
