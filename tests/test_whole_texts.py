"""Contexts are whole documents: what stands at the end of a long text is in the results."""

import pytest

from sievework.plans.catalogue import QUERIES

N = 40


def body(i):
    return f"start {i} " + "lorem ipsum " * 400 + f"the and that end {i}"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("whole")
    spark.createDataFrame([(i, body(i), "en", "src0", len(body(i))) for i in range(3 * N)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    turns = [(i, t, role, f"{role} {i}") for i in range(N) for t, role in enumerate(("user", "assistant"))]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return str(d)


def user(i):
    return f"Context: {body(i)}\n\nQuestion: user {i}"


def test_messages_hold_whole_contexts(spark, folder):
    got = QUERIES["messages_flat"](spark, folder).collect()
    assert {r["context_mode"] for r in got} == {"with_context", "no_context"} and len(got) == N
    for r in got:
        i = int(r["assistant"].split()[1])
        assert r["user"] == (user(i) if r["context_mode"] == "with_context" else f"Question: user {i}")


def test_restored_and_split_contexts_are_whole(spark, folder):
    assert sorted(r["user"] for r in QUERIES["restore_context"](spark, folder).collect()) == sorted(map(user, range(N)))
    split = QUERIES["context_split"](spark, folder).collect()
    assert len(split) == N and all(r["context"] in (None, body(int(r["pair_id"].split(":")[0]))) for r in split) and any(r["context"] for r in split)


def test_prompt_tokens_count_whole_contexts(spark, folder):
    pairs = QUERIES["dialogue_pairs"](spark, folder).collect()
    for r in QUERIES["prompt_tokens"](spark, folder).collect():
        n = [max(1, round(len(user(p["conv_id"]) if r["context_mode"] == "with_context" else f"Question: user {p['conv_id']}") / 1.6)) for p in pairs if p["context_mode"] == r["context_mode"]]
        assert r["total_tokens"] == sum(n) + 18 * len(n) and r["n_over"] == sum(x > 500 for x in n)


def test_flags_see_the_end_of_a_context(spark, folder):
    flags = {r["row_index"]: r["flags"].split(";") for r in QUERIES["outlier_flags"](spark, folder).collect()}
    modes = {r["row_index"]: r["context_mode"] for r in QUERIES["dialogue_pairs"](spark, folder).collect()}
    assert len(flags) == N
    for i, mode in modes.items():
        assert ({"lean_context", "long_prompt"} <= set(flags[i])) == (mode == "with_context")


def test_context_left_blank_is_whole(spark, folder):
    got = [r["context"] for r in QUERIES["context_left_blank"](spark, folder).collect()]
    every = {body(i) for i in range(3 * N)}
    assert len(got) == N and all(c in every for c in got)
