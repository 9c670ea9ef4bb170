"""Small tables with every odd row: nulls, empty and long texts, repeated rows, clashing columns."""

import re
from pathlib import Path

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows, partitions=3):
    """Rows are (id, text)."""
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA).repartition(partitions)


def clashing(docs):
    """``docs`` with columns that bear names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["h", "n", "a", "b", "id", "row", "kept", "toxic", "score", "component_id", "class_id", "gram",
             "word", "ids", "end_id", "wanted_id", "label_id", "label", "start_id", "start_text", "body", "_row_of_id", "spans", "bin_id", "v"]
    return docs.select("*", *[F.lit(i).alias(name) for i, name in enumerate(names)])


def small(limit=None):
    """Ids and texts of the smallest given table."""
    rows = pq.read_table(Path(SMALL) / "documents.parquet").to_pydict()
    return list(zip(rows["doc_id"], rows["text"], strict=True))[:limit]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_id(df):
    return {row.doc_id: row for row in df.collect()}
