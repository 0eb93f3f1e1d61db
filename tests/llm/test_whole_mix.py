"""The registered mix is as large as the corpus."""

from tidemark.llm import queries


def test_a_scarce_source_does_not_shrink_the_mix(spark, tmp_path):
    documents = [(k, "the ship sailed on " * 50, "log") for k in range(40)] + [(99, "a plaque", "plaque")]
    spark.createDataFrame(documents, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("log", 0.5, 1), ("plaque", 0.5, 3)], "source string, target_share double, max_repeats int").coalesce(1).write.parquet(f"{tmp_path}/mix_targets.parquet")
    count = lambda name: {r["source"]: r["count"] for r in queries.queries()[name](spark, str(tmp_path)).groupBy("source").count().collect()}
    assert count("p8_mix") == {"log": 20, "plaque": 3}
    assert count("p8_mix_balanced").get("log", 0) == 0
    reached = {r["source"]: r for r in queries.queries()["p8_shares"](spark, str(tmp_path)).collect()}
    assert reached["log"]["records"] == 20 and reached["plaque"]["most_uses"] == 3 and reached["plaque"]["reached_share"] < 0.01
