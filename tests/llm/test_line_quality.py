"""Frequent lines of a hot host."""

from pyspark.sql import functions as F

import corpus_pipeline


def _own_words():
    """60 words that no other text has, without digits, which all count as zero."""
    name = F.translate(F.col("doc_id").cast("string"), "0123456789", "abcdefghij")
    return F.concat_ws(" ", *(F.concat(F.lit("w" + "x" * k), name) for k in range(60)))


def test_line_in_a_small_share_of_a_hot_host_is_removed(spark):
    """3000 texts of one host, a menu in 120 (4 %) of them, a line in 99 that stays, a depleted text among the 120."""
    words = _own_words()
    menu, other = "home about contact imprint", "a line in fewer texts"
    long_menu = " ".join(f"menu{k}" for k in range(70))
    text = (
        F.when(F.col("doc_id") < 120, F.concat(F.lit(menu + "\n" + long_menu + "\n"), words))
        .when(F.col("doc_id") < 219, F.concat(F.lit(other + "\n"), words))
        .otherwise(words)
    )
    docs = spark.range(3000).select(F.col("id").alias("doc_id")).select(
        "doc_id", text.alias("text"), F.lit("hot").alias("source"), F.lit(0).cast("long").alias("n_chars")
    )
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.quality(spark, docs, "").collect()}
    # the menus are 74 of 134 words: those texts are depleted, and their lines do not save them
    assert sorted(kept) == list(range(120, 3000))
    assert all(kept[i].startswith(other) for i in range(120, 219))


def test_frequent_line_is_taken_out_of_texts_that_stay(spark):
    words = _own_words()
    text = F.when(F.col("doc_id") < 120, F.concat(F.lit("home about contact\n"), words)).otherwise(words)
    docs = spark.range(3000).select(F.col("id").alias("doc_id")).select(
        "doc_id", text.alias("text"), F.lit("hot").alias("source"), F.lit(0).cast("long").alias("n_chars")
    )
    kept = corpus_pipeline.quality(spark, docs, "")
    assert kept.count() == 3000 and kept.filter("text like '%home about%'").count() == 0
