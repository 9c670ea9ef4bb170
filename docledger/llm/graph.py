"""Connected components of links between ids, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.session import fresh_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the folder all executors share and read back: later steps start from there."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for each id in ``links`` (``a``, ``b``); the component is its smallest id.

    Each turn takes the smallest label among the neighbours, then the label of that label, so a
    chain of n links needs about log n turns. Nothing but a count reaches the driver; each turn is
    written to the shared folder. Self-links and nulls are ignored.
    """
    both = links.where("a != b").select("a", "b")
    both = stored(both.union(both.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.min("b"), F.col("id")).alias("component")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["id"]).groupBy(F.col("a").alias("id"))
                .agg(F.min("component").alias("near")))
        nearer = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        of = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        turned = stored(nearer.join(of, "component").select(
            "id", "old", F.least("component", "further").alias("component")), "labels")
        labels = turned.select("id", "component")
        if turned.where("old != component").isEmpty():
            return labels
