"""The training-data pipeline over ``documents``: five stages, each by one operator of ``docledger.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; its result is
written as Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``. Null texts count as empty: they have no toxic words, fail the quality rules and so
end there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docledger.llm.graph import stored
from docledger.llm.jaccard import keep_one
from docledger.llm.packing import pack
from docledger.llm.pii import with_pseudonyms
from docledger.llm.quality import drop_low_quality
from docledger.llm.queries import PII_KEY, model_path
from docledger.llm.text import table
from docledger.llm.tokens import TokensAndEnd
from docledger.llm.toxicity import drop_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on the labelled ones among them, does not reject."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base counts and the compression bands."""
    return drop_low_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by n-gram Jaccard similarity the document with the smallest id."""
    return keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms; ``n_chars`` follows the new text where it is present."""
    changed = with_pseudonyms(docs, PII_KEY)
    if "n_chars" in docs.columns:
        changed = changed.selectExpr(*[
            "CASE WHEN n_chars IS NULL THEN NULL ELSE CAST(length(text) AS BIGINT) END AS n_chars"
            if c == "n_chars" else f"`{c}`" for c in docs.columns])
    return changed


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, by exact tokens: its bin and its place there."""
    return pack(docs, count=TokensAndEnd(docs, model_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", pii),
    ("best-fit packing", packing),
]

#: SQL can express neither the fitted chain nor the permutations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
