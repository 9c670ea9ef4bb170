"""Run counters as aggregates over outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_BLOCK = 10_000


def count_rows(df: DataFrame) -> int:
    return df.count()


def counters() -> list[Column]:
    """Aggregates over outcomes; a row that is not ok counts as a failure."""
    failed = ~F.coalesce(F.col("ok"), F.lit(False))
    return [F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("successes"),
            F.count_if(failed).alias("failures")]


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """One row: total, successes, failures."""
    return outcomes.agg(*counters())


def run_rates(outcomes: DataFrame, seconds: float | Column) -> DataFrame:
    """One row: counts, success percentage and rows per second; NULL rates for an empty run."""
    spent = F.lit(float(seconds)) if isinstance(seconds, (int, float)) else seconds
    return outcome_counts(outcomes).withColumns({
        "success_rate": F.round(F.try_divide(F.col("successes") * 100.0, "total"), 2),
        "rows_per_second": F.when(F.col("total") > 0,
                                  F.round(F.try_divide(F.col("total").cast("double"), spent), 2)),
    })


def running_totals(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """Add ``cumulative_<column>`` along a whole-number ``order`` column, unique per row.

    A sum over one global window would put every row into one task. Rows are cut into blocks of
    consecutive numbers instead: running sums inside each block, plus the totals of the blocks
    before it. Only the block totals, one row per 10,000, meet in one task.
    """
    blocks = df.withColumn("_block", F.floor(F.col(order) / _BLOCK).cast("bigint"))
    totals = blocks.groupBy("_block").agg(*[F.sum(c).alias(f"_total_{c}") for c in columns])
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_block", *[
        F.coalesce(F.sum(f"_total_{c}").over(before), F.lit(0)).alias(f"_before_{c}")
        for c in columns])
    inside = (Window.partitionBy("_block").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # A left join keeps both readings of ``df`` alike, so that Spark computes it once.
    return (blocks.join(offsets, "_block", "left")
            .withColumns({f"cumulative_{c}": F.sum(c).over(inside) + F.col(f"_before_{c}")
                          for c in columns})
            .select(*df.columns, *[f"cumulative_{c}" for c in columns]))


def batch_progress(outcomes: DataFrame) -> DataFrame:
    """Successes and failures per batch, and cumulatively up to it."""
    per_batch = outcomes.groupBy("batch_id").agg(*counters()).drop("total")
    return running_totals(per_batch, "batch_id", ["successes", "failures"])


def copy_stats(outcomes: DataFrame) -> DataFrame:
    """One row: bytes copied, seconds spent, and MB per second (0 where no time passed)."""
    total = outcomes.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("total_bytes"),
        (F.coalesce(F.sum("execution_time_ms"), F.lit(0)) / 1000).alias("_seconds"))
    rate = F.col("total_bytes") / 1024 / 1024 / F.col("_seconds")
    return total.select(
        "total_bytes",
        F.round("_seconds", 3).alias("seconds"),
        F.when(F.col("_seconds") > 0, F.round(rate, 2)).otherwise(F.lit(0.0)).alias("mb_per_second"))
