import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from indicata.llm import langid
from indicata.llm.queries import op3_language_id

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred string, held_out string"


def test_held_out_accuracy(spark, sf_small):
    found = {r.doc_id: r for r in op3_language_id(spark, sf_small).collect()}
    rows = duckdb.sql(f"select doc_id, lang, text from '{sf_small}/documents.parquet'").fetchall()
    assert len(found) == len(rows)
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    own = [(lang, found[i].lang_pred) for i, lang, text in rows if found[i].held_out and len(text) > 100]
    assert len(own) > 20 and np.mean([a == b for a, b in own]) >= 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def _learned(spark):
    rows = [(i, "the cat and the dog of that house with this " * 5, "en") for i in range(4)]
    rows += [(i, "der hund und die katze von dem haus mit der " * 5, "de") for i in range(4, 8)]
    rows += [(8, None, "en"), (9, "", "de"), (10, "unlabelled", None), (11, "123", "en")]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    return langid.learn(df)


def test_edges(spark):
    model = _learned(spark)
    assert model.languages == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "THE DOG AND THE CAT WITH THAT HOUSE"), (None, "die katze und der hund"),
            (5, "der hund und die katze " * 20000), (5, "der hund und die katze " * 20000)]
    df = spark.createDataFrame([(i, t, "xx", "a", "b", "c") for i, t in rows], SCHEMA)
    found = sorted((r.doc_id or 0, r.lang_pred) for r in langid.identify(df, model).collect())
    assert found == [(0, "de"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (5, "de")]
    assert langid.identify(df.where("false"), model).count() == 0
    assert not df.select(langid.held_out(F.lit(None).cast("long")).alias("x")).first().x


def test_mixture_and_single_language(spark):
    model = _learned(spark)
    english, german = "the cat and the dog of that house with this ", "der hund und die katze von dem haus mit der "
    names, scores = model.predict([english * 30 + german * 10, english * 40])
    assert names == ["en", "en"] and 0.6 < scores[0] < 0.9 and scores[1] == 1


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "some text", None, "a", "b", "c")], SCHEMA)
    assert langid.identify(df, langid.learn(df)).first().lang_pred == "und"
