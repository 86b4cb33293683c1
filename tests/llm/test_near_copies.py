"""Near copies that lie below a Jaccard similarity of 0.6."""

import corpus_pipeline


def test_pipeline_keeps_one_of_two_copies_with_every_eleventh_word_edited(spark):
    words = [f"w{i}" for i in range(100)]
    edited = [f"x{i}" if i % 11 == 5 else w for i, w in enumerate(words)]  # 9 edits: 71 of 125 grams in common, 0.568
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(f"v{i}" for i in range(100)))]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == [1, 3]
