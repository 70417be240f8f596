"""The pipeline's first stage."""

import corpus_pipeline


def test_guesses_do_not_pass_the_language_stage(spark):
    words = {"de": "der schnee und", "en": "the thing with", "es": "la cancion que", "fr": "les choses vous"}
    rows = [(i, f"{words[g]} {i % 7}", g, "s", 9) for i in range(200) for g in [sorted(words)[i % 4]]]
    docs = spark.createDataFrame([*rows, (900, "漢", None, "s", 1), (901, "12 ?", None, "s", 4)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.identify(spark, docs, "").collect()}
    assert kept == set(range(200))
