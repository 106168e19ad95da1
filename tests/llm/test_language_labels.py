import pytest
from pyspark.sql import functions as F

from papyra.llm import language

ALPHABETS = {"many": "abcde", "long": "fghij"}


def text(alphabet, seed, words):
    return " ".join("".join(alphabet[(seed * 7 + w * 3 + k * (seed + w)) % len(alphabet)] for k in range(5)) for w in range(words))


def test_languages_of_few_long_texts_are_learned(spark):
    """Far fewer than one row of ``long`` fits the bytes; the singles may all be spare."""
    rows = [(f"m{i}", text("abcde", i, 20), "many") for i in range(300)]
    rows += [(f"l{i}", text("fghij", i, 40_000), "long") for i in range(6)]
    rows += [(f"s{c}", text(c, 1, 20), f"single {c}") for c in "klmnopqrstuv"]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    model = language.train(docs, sample_bytes=2_000)
    assert set(model.names) == {r[2] for r in rows}
    wrong = language.predict(docs.withColumn("text", F.substring("text", 1, 200)), model).filter("lang_pred <> lang")
    assert wrong.count() == 0


def test_too_many_languages_are_an_error(spark):
    docs = spark.range(language.MAX_LABELS + 1).selectExpr("cast(id AS string) doc_id", "'some words' text", "concat('l', id) lang")
    with pytest.raises(ValueError, match="different values of lang"):
        language.train(docs)
