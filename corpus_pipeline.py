"""Documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept, written as Parquet, and all but the
last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from papyra.llm import decontaminate, language, packing, runs, simhash
from papyra.llm.common import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models accept; they learn from ``lang``.

    Texts that are null or hold no letter go, and those far from every language.
    """
    return language.keep_known(docs, language.train(docs.select("doc_id", "text", "lang")))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that larger ids hold too; ``text`` changes.

    ``n_chars`` stays what it was on arrival. Null text becomes empty text.
    """
    return runs.keep_fresh(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest id."""
    return simhash.keep_one(docs, shingle=4, bits=4)


def without_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents packed into sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", fresh_lines),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", without_tests),
    ("best_fit_packing", sequences),
]

#: SQL can neither train the language models nor run the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
