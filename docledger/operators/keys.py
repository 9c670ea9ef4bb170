"""Keyed joins and set operations.

NULL never equals NULL in a join here, as in SQL: a row with a NULL key matches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from docledger.operators.bloom import maybe_known
from docledger.schemas import KEYS


def distinct_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Each key once. Copies of one key collapse before the shuffle (partial aggregation)."""
    return df.select(*keys).distinct()


def without_keys(df: DataFrame, known: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of ``df`` whose key is not in ``known`` (NOT EXISTS).

    ``known`` is joined as it is: an aggregate between its shuffle and the join would keep
    adaptive execution from splitting a hot key of ``df``. De-duplicate it with
    ``distinct_keys`` first only where its keys really repeat.
    """
    return df.join(known.select(*keys), list(keys), "left_anti")


def not_succeeded(docs: DataFrame, success: DataFrame) -> DataFrame:
    return without_keys(docs, success)


def not_failed(docs: DataFrame, failure: DataFrame) -> DataFrame:
    return without_keys(docs, failure)


def shared_keys(known: DataFrame, wanted: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys of ``known`` that ``wanted`` has too, without shuffling ``known``.

    ``wanted`` is broadcast: only for a side the caller has measured.
    """
    return known.select(*keys).join(F.broadcast(wanted.select(*keys)), list(keys), "left_semi")


def collapse_copies(known: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """A few rows per key at most, for the right side of an anti-join.

    Copies collapse before the shuffle, as in ``distinct_keys``. The salt makes the join shuffle
    the result once more, but by a shuffle of its own, which keeps a hot key of the join's
    other side splittable.
    """
    salted = known.select(*keys, (F.spark_partition_id() % 8).alias("_salt"))
    return salted.distinct().select(*keys)


def _without_keys_among(df: DataFrame, known: DataFrame, held: str) -> DataFrame:
    """``without_keys`` for rows that a filter on ``held`` has left, and after that filter.

    The optimiser moves an anti-join below the join that a filter needs, so that all rows would be
    shuffled for it. A condition that needs the filter's value keeps it above.
    """
    on = F.col(f"d.{held}")
    for key in KEYS:
        on = on & (F.col(f"d.{key}") == F.col(f"k.{key}"))
    return df.alias("d").join(known.select(*KEYS).alias("k"), on, "left_anti")


@dataclass(frozen=True)
class Seen:
    """A Bloom filter over the keys of both ledgers: what it does not hold, neither ledger does."""

    words: DataFrame
    blocks: int


def pending_only(docs: DataFrame, success: DataFrame, failure: DataFrame, *,
                 repeated_keys: bool = False, small_docs: bool = False, seen: Seen | None = None) -> DataFrame:
    """Documents in neither ledger, by one anti-join against both.

    One join instead of two: ``docs`` is shuffled and sorted once, and both inputs of the join
    are plain shuffles. Set ``repeated_keys`` for ledgers kept as history, where a key may
    have any number of rows, and ``small_docs`` for documents measured to be few: the ledgers are
    then reduced to their keys in place and not shuffled.

    With ``seen``, documents that the filter does not hold go around the join: they are neither shuffled nor
    sorted. The others, known ones and few more, are joined exactly. ``docs`` is read twice for that, which is for
    documents that come from files.
    """
    known = success.select(*KEYS).unionAll(failure.select(*KEYS))
    if small_docs:
        known = shared_keys(known, docs)
    known = collapse_copies(known) if repeated_keys else known
    if seen is None:
        return without_keys(docs, known)
    marked = maybe_known(docs, seen.words, seen.blocks)
    rest = _without_keys_among(marked.filter("_maybe"), known, "_maybe")
    return marked.filter("NOT _maybe").unionByName(rest).drop("_maybe")


def previously_failed(rows: DataFrame, failure: DataFrame) -> DataFrame:
    """Rows whose key is in the failure ledger and not marked reprocessed."""
    open_failures = failure.filter(F.col("reprocess_success") == 0)
    return rows.join(open_failures.select(*KEYS), list(KEYS), "left_semi")


def except_processed(docs: DataFrame, *processed: DataFrame,
                     columns: Sequence[str] = KEYS) -> DataFrame:
    """Set difference on ``columns``: distinct, and NULL equals NULL.

    Taking away one union equals taking away one after the other, in a single join.
    """
    left = docs.select(*columns)
    if not processed:
        return left.distinct()
    return left.subtract(reduce(DataFrame.unionAll, [p.select(*columns) for p in processed]))
