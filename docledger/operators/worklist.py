"""From a document manifest and two ledgers to the list of documents to copy."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from docledger.functions.paths import full_path, guid_parts, two_digits
from docledger.functions.status import cast_code
from docledger.operators.keys import Seen, not_succeeded, pending_only
from docledger.schemas import KEYS, WORKLIST

WORKLIST_COLUMNS = tuple(WORKLIST.fieldNames())


@dataclass(frozen=True)
class RetryPolicy:
    """Which failures get another attempt.

    The two named policies belong to the two ways of counting: ``TARGET_COUNTED`` goes with a
    ledger that adds one on every repeated failure (7 attempts in all), ``SOURCE_COUNTED`` with
    a ledger that stores the count the attempt carried (5 attempts in all). ``counted`` names the way; where
    it does not fit the limit's kind, one attempt too many or too few would result, and that is refused.
    """

    limit: int = 5
    inclusive: bool = True
    counted: str = ""

    def __post_init__(self) -> None:
        fits = "target" if self.inclusive else "source"
        if self.counted not in ("", fits):
            raise ValueError(f"a limit that is {'in' if self.inclusive else 'ex'}clusive goes with {fits}-counted "
                             f"ledgers, not with {self.counted}-counted ones")
        object.__setattr__(self, "counted", fits)

    def eligible(self, count: Column, reprocessed: Column) -> Column:
        below = count <= self.limit if self.inclusive else count < self.limit
        return below & (reprocessed == 0)


@dataclass(frozen=True)
class Backoff:
    """When a failure is due again: ``first`` seconds after it, then ``factor`` times as long each time."""

    first: float = 60.0
    factor: float = 2.0
    longest: float = 6 * 3600.0

    def due_at(self, failed_at: Column, count: Column) -> Column:
        pause = F.least(F.lit(self.first) * F.pow(F.lit(self.factor), F.greatest(count, F.lit(0))), F.lit(self.longest))
        return failed_at + F.make_dt_interval(secs=pause.cast("decimal(18,6)"))


TARGET_COUNTED = RetryPolicy(5, inclusive=True)
SOURCE_COUNTED = RetryPolicy(5, inclusive=False)


def canonicalise(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename source columns (source name to package name); others stay."""
    return df.withColumnsRenamed(dict(renames))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def has_root(df: DataFrame) -> DataFrame:
    return df.filter(F.col("root_folder").isNotNull())


def with_full_path(df: DataFrame, mode: str = "single") -> DataFrame:
    return df.withColumn("full_path",
                         full_path("root_folder", "container_folder", "file_name", mode))


def retryable(failure: DataFrame, policy: RetryPolicy = TARGET_COUNTED) -> DataFrame:
    return failure.filter(policy.eligible(F.col("retry_count"), F.col("reprocess_success")))


def due_failures(failure: DataFrame, asked: DataFrame, now: Column, backoff: Backoff) -> DataFrame:
    """Failures whose time has come: the pause after the last attempt is over, and also what the service asked for.

    ``asked`` has at most one ``retry_at`` for a document; one from before the last attempt has passed and
    changes nothing.
    """
    pause_over = backoff.due_at(F.col("date_updated"), F.col("retry_count")) <= now
    waiting = asked.filter(F.col("retry_at") > now)
    return failure.filter(F.coalesce(pause_over, F.lit(True))).join(waiting.select(*KEYS), list(KEYS), "left_anti")


def with_retry_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({"retry_count": F.lit(0), "reprocess_success": F.lit(0)})


def cast_error_code(df: DataFrame, column: str = "error_code") -> DataFrame:
    return df.withColumn(column, cast_code(column))


def stamp(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Created and updated stamps; pass a fixed ``at`` for results that can be repeated."""
    moment = F.current_timestamp() if at is None else at
    return df.withColumns({"date_created": moment, "date_updated": moment})


def with_correlation(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """One id for the whole run, so that re-running a batch is recognised."""
    return df.withColumn("correlation_id", F.lit(run_id or str(uuid.uuid4())))


def column_compat(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` under exactly these names whatever their case in ``df``; NULL becomes ''.

    A column ``df`` does not have at all is added empty.
    """
    present = {name.lower() for name in df.columns}
    return df.select(*[
        (F.coalesce(F.col(c), F.lit("")) if c.lower() in present else F.lit("")).alias(c)
        for c in columns
    ])


def multiply_rows(df: DataFrame, n: int = 100,
                  columns: Sequence[str] = ("document_id", "auth_request_id"),
                  partitions: int | None = None) -> DataFrame:
    """``n`` copies of each row with numbered identifiers, made in place without a join.

    Identifiers are taken apart once per source row, not once per copy. ``partitions`` deals the
    source rows out first, for a source with fewer partitions than the session has cores.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    rows = df if partitions is None else df.repartition(partitions)
    parts = {}
    for c in columns:
        parts[f"_head_{c}"], parts[f"_tail_{c}"] = guid_parts(c)
    numbers = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), two_digits)
    copies = rows.withColumns(parts).withColumn("_copy", F.explode(numbers))
    return copies.select(*[
        F.concat(f"_head_{c}", "_copy", f"_tail_{c}").alias(c) if c in columns else F.col(c)
        for c in df.columns])


def new_documents(manifest: DataFrame, success: DataFrame, failure: DataFrame, *,
                  path_mode: str = "single", repeated_keys: bool = False,
                  small_docs: bool = False, seen: Seen | None = None) -> DataFrame:
    """Manifest rows with a root folder that neither ledger knows, at zero retries."""
    docs = with_full_path(has_root(manifest), path_mode).select(
        "auth_request_id", "document_id", "ar_number", "full_path")
    fresh = with_retry_defaults(pending_only(docs, success, failure, repeated_keys=repeated_keys,
                                             small_docs=small_docs, seen=seen))
    return fresh.select(*WORKLIST_COLUMNS)


def worklist(manifest: DataFrame, success: DataFrame, failure: DataFrame, *,
             policy: RetryPolicy = TARGET_COUNTED, path_mode: str = "single",
             repeated_keys: bool = False, small_docs: bool = False,
             skip_succeeded_retries: bool = False,
             retry_only_if: Column | None = None, retries: DataFrame | None = None,
             seen: Seen | None = None) -> DataFrame:
    """New documents, and failed ones with retries left.

    A failed document that the success ledger holds too is still retried unless
    ``skip_succeeded_retries``. ``retry_only_if`` narrows the failures that are retried, ``retries`` names
    those that may be at all (``due_failures``).
    ``repeated_keys``, ``small_docs`` and ``seen`` are those of ``pending_only``.
    """
    again = retryable(failure if retries is None else retries, policy)
    if retry_only_if is not None:
        again = again.filter(retry_only_if)
    again = again.select(*WORKLIST_COLUMNS)
    if skip_succeeded_retries:
        again = not_succeeded(again, success)
    fresh = new_documents(manifest, success, failure, path_mode=path_mode,
                          repeated_keys=repeated_keys, small_docs=small_docs, seen=seen)
    return fresh.unionByName(again)
