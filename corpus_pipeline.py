"""From raw documents to packed training sequences, a stage at a time.

Every stage reads what the one before it wrote (Parquet in the shared folder) and works on all of
it. All but the last return the columns of documents, extra ones too, whatever their names. An empty
table passes through every stage; very long texts are worked on whole.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vistaloom.llm import langid, mixing, packing, pii, simhash, tokens
from vistaloom.llm.common import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in some language: null, empty and letterless texts go, repeated rows alike."""
    return langid.with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class, that of the smallest id (null ids last; ties: simhash.keep_one)."""
    return simhash.keep_one(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and e-mail names replaced in the text; n_chars follows.

    Rows stay as many as they were; null and empty texts stay. The secret is the session's (pii.secret).
    """
    return pii.with_length(pii.pseudonymised(docs, pii.secret(spark)), docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it, cut at the budget.

    A null source is a source of its own; wordless documents stay once; repeated rows count each.
    """
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences; repeated rows are packed each."""
    return packing.packed(docs, tokens.tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("pseudonyms", pseudonyms),
    ("source_mix", source_mix),
    ("sequences", sequences),
]

#: Language, SimHash and packing are beyond SQL: tests/llm/test_pipeline.py has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
