"""From raw documents to token files, stage by stage.

Every stage works on all that the one before kept, and its result is written before the
next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ampertide.llm.common import prepare
from ampertide.llm.decontaminate import decontaminate
from ampertide.llm.language_id import UNKNOWN, fit, identify
from ampertide.llm.mixing import mix
from ampertide.llm.near_dup import distinct_documents
from ampertide.llm.queries import vocabulary
from ampertide.llm.token_files import read_tokens, write_tokens
from ampertide.session import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without text or letters go."""
    prepare(spark)
    model = fit(docs)
    return identify(docs, model).where(f"lang_pred <> '{UNKNOWN}'").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest ``doc_id``. Rows without id stay."""
    prepare(spark)
    return distinct_documents(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    prepare(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, twice at most."""
    prepare(spark)
    return mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, and per document what was read back from them."""
    prepare(spark)
    return read_tokens(write_tokens(docs, vocabulary()))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Cross-parsing, set similarity, string tiling and tokens are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
