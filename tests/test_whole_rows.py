"""Every document can be a context and every question is split."""

from sievework.plans.catalogue import QUERIES


def test_no_row_is_left_out_by_id_or_content(spark, tmp_path):
    spark.createDataFrame([(i, f"text {i}", "en", "src0", 6) for i in range(1, 6)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    turns = [(i, t, role, f"Question: {role} {i}") for i in range(1, 8) for t, role in enumerate(("user", "assistant"))]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    run = lambda name: QUERIES[name](spark, str(tmp_path)).collect()
    assert {r["pair_id"]: r["context"] for r in run("context_left_blank")} == {f"{i}:0": f"text {i}" if i < 6 else "" for i in range(1, 8)}
    assert {r["pair_id"]: r["question"] for r in run("context_split")} == {f"{i}:0": f"Question: user {i}" for i in range(1, 6)}
    assert {r["row_index"] for r in run("outlier_flags") if "missing_context" in r["flags"]} == {5, 6}
