"""Cutting work into batches and spreading it over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from docledger.functions.messages import payload_json
from docledger.schemas import KEYS
from docledger.session import fresh_dir
from docledger.sources.staging import stage

DEFAULT_BATCH = 5000

# monotonically_increasing_id: partition number above these bits, row position below.
_POSITION_BITS = 33


def num_batches(df: DataFrame, size: int) -> DataFrame:
    """One row, ``batches``: how many batches of ``size`` rows a table makes."""
    return df.agg(F.ceil(F.count("*") / size).cast("bigint").alias("batches"))


def assign_batches(df: DataFrame, size: int = DEFAULT_BATCH,
                   order: Sequence[str] = KEYS) -> DataFrame:
    """Add ``batch_id`` from 0: consecutive slices of ``size`` rows by ``order``, the last shorter.

    The rows are range-sorted and written with their position in their partition; a row's number
    is that position plus the sizes of the partitions before. No task sees more than its own
    partition, and rows that tie on ``order`` may still be split between partitions.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    ties = (F.xxhash64(*df.columns), F.spark_partition_id())
    ordered = df.orderBy(*order, *ties).withColumn("_id", F.monotonically_increasing_id())
    placed = stage(ordered, fresh_dir(df.sparkSession, "batches")).withColumns({
        "_part": F.shiftright("_id", _POSITION_BITS),
        "_position": F.col("_id").bitwiseAND((1 << _POSITION_BITS) - 1),
    })
    # One row per partition: bounded by the number of tasks, whatever the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")))
    index = F.col("_before") + F.col("_position")
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn("batch_id", ((index - index % size) / size).cast("bigint"))
            .select(*df.columns, "batch_id"))


def spread(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """``partitions`` tasks of even size, or by key where rows of one key must stay together."""
    return df.repartition(partitions, *keys) if keys else df.repartition(partitions)


def batch_payloads(batches: DataFrame, *columns: str) -> DataFrame:
    """One JSON array per batch; a batch is never larger than the size it was cut to."""
    rows = batches.select("batch_id", payload_json(*columns).alias("_row"))
    listed = rows.groupBy("batch_id").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    return listed.select("batch_id", F.concat(F.lit("["), F.array_join("_rows", ","),
                                              F.lit("]")).alias("payload"))
