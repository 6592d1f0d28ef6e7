"""Blocks of a token store meet the numbers of ids before them without a shuffle of the matrices."""

import public_tokenizers
from recordlens.llm import token_store

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_matrices_are_not_shuffled(spark, tmp_path, plan_of):
    path = str(tmp_path / "store")
    docs = spark.createDataFrame([(i, None if i == 3 else f"text {i} " * i) for i in range(40)], "doc_id long, text string")
    token_store.write(docs, path, BPE, block_ids=64, shards=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = token_store.digests(token_store.open_store(spark, path))
        plan = plan_of(found)
        rows = sorted(found.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [r["doc_id"] for r in rows] == list(range(40))
    ends = [r["start"] + r["n_tokens"] for r in rows]
    assert [r["start"] for r in rows] == [0, *ends[:-1]]
