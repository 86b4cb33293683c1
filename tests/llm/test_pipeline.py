"""The pipeline's stages on the smallest tables."""

import corpus_pipeline
from sievework.llm import ngram_join, packing

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
        ids, old = ({r[0] for r in x.select(x.columns[0]).collect()} for x in (docs, before))
        if name == "toxicity":
            toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
            assert ids < old and len(toxic & ids) <= 0.5 * len(toxic) and len(old - ids - toxic) <= 0.1 * len(old)  # few labels at this size
        elif name == "near_duplicates":
            assert ids < old
            j = ngram_join.similar(docs)
            assert j.pairs.count() == 0
        elif name == "pii":
            assert ids == old and before.join(docs, ["doc_id", "text"], "left_anti").count() > 0
        elif name == "mixture":
            assert ids <= old
    tokens = before.select(packing.token_count(before["text"]).alias("n")).agg({"n": "sum"}).first()[0]
    assert docs.agg({"n_tokens": "sum"}).first()[0] == tokens


def test_nothing_in(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs
