"""Blocks of the benchmark are searched one after another."""

from sheaf.llm import decontaminate


def test_a_plan_holds_one_block(spark):
    bench = spark.createDataFrame([(i, f"a{i} b c") for i in range(6)], "item_id BIGINT, text STRING")
    docs = spark.createDataFrame([(1, "x a2 b c y a4 b c"), (2, "none")], "doc_id BIGINT, text STRING")
    found = decontaminate.benchmark_hits(docs, bench, block_bytes=220)
    assert found._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1
    assert {r["doc_id"]: r["items"] for r in found.collect()} == {1: ["2", "4"], 2: []}
