"""From raw documents to packed training sequences: five operators of `matchloom.llm`, each on what the one before it kept."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchloom.llm import op4_decontamination, op7_sanitise, op9_toxicity, op10_minhash
from matchloom.llm.queries import packed, table, toxicity_model
from matchloom.session import staged

#: Fitted models, shuffles and texts lie beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the severity that is rejected."""
    return op9_toxicity.without_toxic(docs, toxicity_model(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return op10_minhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages beyond the limit."""
    return op4_decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts sanitised; n_chars is that of the new text."""
    return op7_sanitise.sanitised(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents. Each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
