"""Columns named as helpers' own, and samples with very long texts."""

from pyspark.sql import functions as F

from indicata.llm import minhash, mixing, toxicity

SCHEMA = ("doc_id long, text string, source string, __id string, __m string, __copies string, __i string, __n string, "
          "___k string")


def test_any_column_names_beside_the_operators_own(spark):
    rows = [(i, f"some words of document {i} " * 3, "ab"[i % 2], *"123456") for i in range(40)]
    rows += [(5, "another text of the same id", "a", *"123456"), (7, rows[6][1], "b", *"654321")]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = mixing.take(docs, mixing.mix(docs))
    assert taken.columns == docs.columns and taken.count() > 0
    kept = minhash.keep_one(docs, minhash.near_duplicates(docs))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(40)) - {7} | {7}


def test_one_long_text_leaves_the_rest_of_the_sample(spark):
    texts = [("bad words here. fine day" if i % 2 else "a fine day. nothing more") + f" {i}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    first = labels.orderBy(F.xxhash64("doc_id"), "doc_id").first().doc_id
    docs = docs.withColumn("text", F.when(F.col("doc_id") == first, F.repeat(F.lit("long "), 10_000)).otherwise(
        F.col("text")))
    model = toxicity.learn(docs, labels, most_chars=20_000)
    assert model.weights and model.score("bad words here") >= 0.5 > model.score("a fine day")
