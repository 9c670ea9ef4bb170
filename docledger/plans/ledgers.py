"""What a run does to its three ledgers.

Two ways of counting retries exist and must not be mixed. Target-counted: a first failure stores
0 and every further one adds 1 (``failure_upsert_increment`` with ``TARGET_COUNTED``).
Source-counted: the attempt carries its count, a first failure stores 1
(``failure_upsert_source`` with ``SOURCE_COUNTED``). Source-counted failures may also be kept as history, a
row for each attempt and one when the document succeeds at last; ``latest_failures`` reduces it.
``commit_outcomes`` does all three; a ledger keeps the way it was begun with (``claim_counting``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docledger.functions.messages import payload_json
from docledger.operators.dispatch import split_outcomes
from docledger.operators.keys import previously_failed
from docledger.operators.merge import merge, rows_to_insert, src, tgt
from docledger.operators.summary import counters
from docledger.schemas import ASKED, AUDIT, ATTEMPT_KEYS, FAILURE, FAILURE_DETAILS, KEYS, SUCCESS
from docledger.sources.ledger import Ledger, Ledgers, read_ledger, write_version
from docledger.sources.staging import children, file_system

# Rows whose measured size is below this may be broadcast.
SMALL_BYTES = 64 * 1024 * 1024


def _same(schema) -> dict[str, Column]:
    return {name: src(name) for name in schema.fieldNames()}


def _updates(schema, keys=KEYS) -> dict[str, Column]:
    return {name: src(name) for name in schema.fieldNames() if name not in keys}


# --- success ledger -------------------------------------------------------------------------

def success_insert_if_absent(success: DataFrame, new: DataFrame) -> DataFrame:
    """The first success of a document stays."""
    return merge(success, new, KEYS, insert_values=_same(SUCCESS))


def success_append(success: DataFrame, new: DataFrame) -> DataFrame:
    return success.unionByName(new.select(*success.columns))


def success_upsert_all(success: DataFrame, new: DataFrame) -> DataFrame:
    """The latest success of a document wins."""
    return merge(success, new, KEYS, matched_set=_updates(SUCCESS), insert_values=_same(SUCCESS))


# --- failure ledger -------------------------------------------------------------------------

def _increment() -> dict[str, Column]:
    return {
        "retry_count": (tgt("retry_count") + 1).cast("int"),
        "latest_error_message": src("latest_error_message"),
        "latest_error_code": src("latest_error_code"),
        "latest_correlation_id": src("latest_correlation_id"),
        "date_updated": src("date_updated"),
    }


def failure_upsert_increment(failure: DataFrame, failed: DataFrame) -> DataFrame:
    """Add one to a known failure and keep its path, created date and flag; insert others at 0.

    A failure that already carries the source's correlation id was counted by an earlier try of
    the same run and is left alone.
    """
    return merge(failure, failed, KEYS, matched_set=_increment(),
                 matched_if=~tgt("latest_correlation_id").eqNullSafe(src("latest_correlation_id")),
                 insert_values={**_same(FAILURE), "retry_count": F.lit(0)})


def failure_upsert_source(failure: DataFrame, failed: DataFrame,
                          with_error: bool = True) -> DataFrame:
    """Take over the count, path and flag the attempt carries; insert others as they are."""
    taken = ["retry_count", "full_path", "reprocess_success"]
    if with_error:
        taken += ["latest_error_message", "latest_error_code", "date_updated"]
    return merge(failure, failed, KEYS, matched_set={c: src(c) for c in taken},
                 insert_values=_same(FAILURE))


def failure_upsert_all(failure: DataFrame, failed: DataFrame) -> DataFrame:
    return merge(failure, failed, KEYS, matched_set=_updates(FAILURE),
                 insert_values=_same(FAILURE))


def failure_append(failure: DataFrame, failed: DataFrame) -> DataFrame:
    """Failures kept as history: one row per attempt."""
    return failure.unionByName(failed.select(*failure.columns))


def mark_reprocessed(failure: DataFrame, succeeded: DataFrame, guarded: bool = True,
                     dated: bool | None = None) -> DataFrame:
    """Set the flag of failures that have now succeeded; update-only.

    Guarded, only rows with flag 0 change, unguarded every match. ``dated`` says whether the updated
    date changes with the flag; by default it does where the mark is guarded.
    """
    changed = {"reprocess_success": F.lit(1)}
    if guarded if dated is None else dated:
        changed["date_updated"] = src("date_updated")
    return merge(failure, succeeded, KEYS, matched_set=changed,
                 extra_on=tgt("reprocess_success") == 0 if guarded else None)


def reprocessed_rows(succeeded: DataFrame, failure: DataFrame) -> DataFrame:
    """Successes of documents that had failed, as further rows for a failure history.

    ``succeeded`` carries the retry count the worklist gave it.
    """
    rows = previously_failed(succeeded, failure)
    return rows.select(
        *KEYS, F.col("correlation_id").alias("latest_correlation_id"), "retry_count", "full_path",
        F.lit(1).alias("reprocess_success"),
        F.lit(None).cast("string").alias("latest_error_message"),
        F.lit(None).cast("int").alias("latest_error_code"),
        "date_created", "date_updated", "ar_number")


# --- failure details and audit --------------------------------------------------------------

def detail_rows(failed: DataFrame) -> DataFrame:
    """The attempt log's rows for failures: latest_* become plain names."""
    return failed.select(
        *KEYS, F.col("latest_correlation_id").alias("correlation_id"),
        F.col("latest_error_code").alias("error_code"),
        F.col("latest_error_message").alias("error_message"),
        "date_created", "date_updated", "ar_number")


def failure_reasons(outcomes: DataFrame) -> DataFrame:
    """Failed rows as sent, each as one JSON record, with the reason next to it."""
    failed = outcomes.filter(~F.coalesce(F.col("ok"), F.lit(False)))
    record = payload_json("auth_request_id", "document_id", "ar_number", "full_path")
    return failed.select(record.alias("record"), F.col("error_message").alias("reason"))


def details_insert_if_absent(details: DataFrame, new: DataFrame) -> DataFrame:
    """One row per document and run, so that re-running a batch adds nothing."""
    return merge(details, new, ATTEMPT_KEYS, insert_values=_same(FAILURE_DETAILS))


def details_append(details: DataFrame, new: DataFrame) -> DataFrame:
    return details.unionByName(new.select(*details.columns))


def audit_entries(outcomes: DataFrame) -> DataFrame:
    """Outcomes in the columns of the flat audit log."""
    ok = F.coalesce(F.col("ok"), F.lit(False))
    return outcomes.select(
        "auth_request_id", F.col("document_id").alias("annotation_id"), "full_path",
        F.when(ok, "Success").otherwise("Failed").alias("status"),
        F.when(ok, F.lit(200)).otherwise(F.col("error_code")).cast("bigint").alias("status_code"),
        F.when(ok, F.col("target_path")).alias("azure_blob_path"), "execution_time_ms",
        F.coalesce(F.col("error_message"), F.lit("")).alias("message"),
    ).select(*AUDIT.fieldNames())


# --- all three ------------------------------------------------------------------------------

def one_per_key(outcomes: DataFrame) -> DataFrame:
    """One outcome per document: a success before a failure, then the latest.

    Needed only where a manifest lists a document twice. ``max_by`` is a partial aggregate, so
    copies collapse before the shuffle. Rows with a NULL key are no copies of each other.
    """
    complete = F.lit(True)
    for key in KEYS:
        complete = complete & F.col(key).isNotNull()
    best = F.struct("ok", "finished_at", F.xxhash64(*outcomes.columns))
    picked = (outcomes.filter(complete).groupBy(*KEYS)
              .agg(F.max_by(F.struct(*outcomes.columns), best).alias("o")).select("o.*"))
    return picked.unionByName(outcomes.filter(~complete))


def has_copies(outcomes: DataFrame) -> bool:
    """Whether a document occurs twice. Hashes tell that none does; keys decide where two hashes are equal."""
    complete = outcomes.dropna(subset=list(KEYS))
    hashed = complete.groupBy(F.xxhash64(*KEYS).alias("hash")).count().filter("count > 1")
    if hashed.isEmpty():
        return False
    return not complete.groupBy(*KEYS).count().filter("count > 1").isEmpty()


@dataclass
class LedgerState:
    """The three ledgers as DataFrames."""

    success: DataFrame
    failure: DataFrame
    details: DataFrame


def merge_failures(failure: DataFrame, succeeded: DataFrame, failed: DataFrame, *,
                   small_source: bool = False) -> DataFrame:
    """``mark_reprocessed`` and ``failure_upsert_increment`` in one pass over the ledger.

    The keys of both sources together must be unique.
    """
    marks = succeeded.select(*KEYS, "date_updated").withColumn("_ok", F.lit(True))
    states = failed.withColumn("_ok", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    marking = src("_ok") & (tgt("reprocess_success") == 0)
    counting = ~src("_ok") & ~tgt("latest_correlation_id").eqNullSafe(src("latest_correlation_id"))
    changes = {name: F.when(src("_ok"), tgt(name)).otherwise(value)
               for name, value in _increment().items() if name != "date_updated"}
    changes["reprocess_success"] = F.when(src("_ok"), F.lit(1)).otherwise(tgt("reprocess_success"))
    changes["date_updated"] = src("date_updated")
    return merge(failure, states, KEYS, matched_set=changes, matched_if=marking | counting,
                 insert_values={**_same(FAILURE), "retry_count": F.lit(0)},
                 insert_if=~src("_ok"), unique_source=True, unique_target=True,
                 small_source=small_source)


def merge_counted_failures(failure: DataFrame, succeeded: DataFrame, failed: DataFrame, *,
                           small_source: bool = False) -> DataFrame:
    """``failure_upsert_source`` and the unguarded, dated ``mark_reprocessed`` in one pass over the ledger.

    ``failed`` has the counts to be stored. The keys of both sources together must be unique.
    """
    marks = succeeded.select(*KEYS, "date_updated").withColumn("_ok", F.lit(True))
    states = failed.withColumn("_ok", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    taken = ("retry_count", "full_path", "latest_error_message", "latest_error_code")
    changes = {name: F.when(src("_ok"), tgt(name)).otherwise(src(name)) for name in taken}
    changes["reprocess_success"] = F.when(src("_ok"), F.lit(1)).otherwise(src("reprocess_success"))
    changes["date_updated"] = src("date_updated")
    return merge(failure, states, KEYS, matched_set=changes, insert_values=_same(FAILURE),
                 insert_if=~src("_ok"), unique_source=True, unique_target=True,
                 small_source=small_source)


def latest_failures(history: DataFrame) -> DataFrame:
    """The newest row of each document in a failure history.

    Newest by updated date; of equal dates a success counts as later, then the higher count. ``max_by`` is
    a partial aggregate: a document with very many attempts collapses before the shuffle. Rows
    with a NULL key are documents of their own and stay.
    """
    complete = F.lit(True)
    for key in KEYS:
        complete = complete & F.col(key).isNotNull()
    order = F.struct("date_updated", "reprocess_success", "retry_count", F.xxhash64(*history.columns))
    newest = (history.filter(complete).groupBy(*KEYS)
              .agg(F.max_by(F.struct(*history.columns), order).alias("row")).select("row.*"))
    return newest.unionByName(history.filter(~complete))


def apply_outcomes(state: LedgerState, outcomes: DataFrame, at: Column | None = None) -> LedgerState:
    """The ledgers after a batch, as plans. ``outcomes`` must be staged, one per document."""
    succeeded, failed = split_outcomes(outcomes, at)
    return LedgerState(
        success_insert_if_absent(state.success, succeeded),
        merge_failures(state.failure, succeeded, failed),
        details_insert_if_absent(state.details, detail_rows(failed)))


def text_size(df: DataFrame) -> Column:
    """Aggregate: size of the rows, text as it is and 100 bytes for the rest of a row."""
    size = F.lit(100)
    for field in df.schema.fields:
        if field.dataType.simpleString() == "string":
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
    return F.coalesce(F.sum(size), F.lit(0)).cast("bigint")


def is_small(df: DataFrame) -> bool:
    """True for rows measured to be below what may be broadcast."""
    return df.agg(text_size(df).alias("size")).first()["size"] <= SMALL_BYTES


def measure(outcomes: DataFrame, ledger: Ledger) -> dict:
    """Counters of staged outcomes, their size, and the ledger buckets they and the failures fall into, in one pass."""
    # At most ledger.buckets numbers each.
    touched = F.collect_set("_bucket").alias("buckets")
    failed = F.collect_set(F.when(~F.coalesce(F.col("ok"), F.lit(False)), F.col("_bucket"))).alias("failed_buckets")
    return (outcomes.withColumn("_bucket", ledger.bucket_of())
            .agg(*counters(), text_size(outcomes).alias("size"), touched, failed).first().asDict())


def commit_outcomes(spark: SparkSession, ledgers: Ledgers, outcomes: DataFrame,
                    at: Column | None = None, counted: str = "target",
                    measured: dict | None = None) -> dict[str, int]:
    """Write the next version of each ledger from staged outcomes; returns the run's counters.

    Success and details get only their new rows. Of the failure ledger, the buckets that hold a new
    failure or one that has now succeeded are rewritten; kept as history, it gets new rows only. Sides without
    rows are skipped. Success is written first, so a run that dies in between never retries what it has
    copied; committing again adds only what is missing. ``counted`` tells who counts attempts, see
    above; source-counted outcomes must carry ``retry_count``. ``measured`` is what ``measure`` gave, if it was asked.
    """
    claim_counting(spark, ledgers, counted)
    if counted == "source" and "retry_count" not in outcomes.columns:
        raise ValueError("source-counted outcomes must carry retry_count")
    counts = dict(measured or measure(outcomes, ledgers.failure))
    small, buckets, certain = counts.pop("size") <= SMALL_BYTES, counts.pop("buckets"), counts.pop("failed_buckets")
    if counts["total"] == 0:
        return counts
    if has_copies(outcomes):
        # A success may take the place of the only failure of its bucket.
        outcomes, certain = one_per_key(outcomes), []
    succeeded, failed = split_outcomes(outcomes, at, counted=counted == "source")
    if counts["successes"]:
        known = read_ledger(spark, ledgers.success, buckets)
        write_version(spark, ledgers.success,
                      rows_to_insert(known, succeeded, KEYS, small_source=small))
    if ledgers.failure.updatable:
        left = sorted(set(buckets) - set(certain))
        changed = sorted(certain)
        if left:
            inside = ledgers.failure.bucket_of().isin(left)
            changed += _changed_buckets(read_ledger(spark, ledgers.failure, left), succeeded.filter(inside),
                                        failed.filter(inside), ledgers.failure, small)
        if changed:
            failure = read_ledger(spark, ledgers.failure, changed)
            combine = merge_failures if counted == "target" else merge_counted_failures
            write_version(spark, ledgers.failure, combine(failure, succeeded, failed, small_source=small))
    else:
        _append_history(spark, ledgers.failure, succeeded, failed, buckets, small)
    if counts["failures"] and "retry_at" in outcomes.columns:
        _note_asked(spark, ledgers.asked, outcomes, small)
    if counts["failures"]:
        known = read_ledger(spark, ledgers.details, buckets)
        write_version(spark, ledgers.details,
                      rows_to_insert(known, detail_rows(failed), ATTEMPT_KEYS, small_source=small))
    return counts


def _append_history(spark: SparkSession, ledger: Ledger, succeeded: DataFrame, failed: DataFrame,
                    buckets: list[int], small: bool) -> None:
    """A row for each failed attempt, and one for each document that had failed and has now succeeded.

    Rows are told apart by document, run and flag, so committing again adds only what is missing.
    """
    known = read_ledger(spark, ledger, buckets)
    again = reprocessed_rows(succeeded, latest_failures(known))
    new = failed.select(*FAILURE.fieldNames()).unionByName(again.select(*FAILURE.fieldNames()))
    keys = (*KEYS, "latest_correlation_id", "reprocess_success")
    write_version(spark, ledger, rows_to_insert(known, new, keys, small_source=small))


def _note_asked(spark: SparkSession, ledger: Ledger, outcomes: DataFrame, small: bool) -> None:
    """Keep when services want to be called again, the latest for each document."""
    new = outcomes.filter("NOT ok AND retry_at IS NOT NULL").select(*ASKED.fieldNames())
    touched = [row["bucket"] for row in new.select(ledger.bucket_of().alias("bucket")).distinct().collect()]
    if touched:
        later = {"retry_at": F.greatest(tgt("retry_at"), src("retry_at"))}
        write_version(spark, ledger, merge(
            read_ledger(spark, ledger, touched), new, KEYS, matched_set=later, insert_values=_same(ASKED),
            unique_source=True, unique_target=True, small_source=small))


def _changed_buckets(failure: DataFrame, succeeded: DataFrame, failed: DataFrame, ledger: Ledger,
                     small: bool) -> list[int]:
    """Buckets of new failures and of known ones that succeeded; at most ``ledger.buckets`` numbers."""
    keys = succeeded.select(*KEYS)
    settled = failure.join(F.broadcast(keys) if small else keys, list(KEYS), "left_semi")
    found = failed.select(*KEYS).union(settled.select(*KEYS)).select(ledger.bucket_of().alias("bucket"))
    return [row["bucket"] for row in found.distinct().collect()]


def read_failures(spark: SparkSession, ledgers: Ledgers) -> DataFrame:
    """One row for each document that has failed, as it stands."""
    failure = read_ledger(spark, ledgers.failure)
    return failure if ledgers.failure.updatable else latest_failures(failure)


def claim_counting(spark: SparkSession, ledgers: Ledgers, counted: str) -> None:
    """Note in the failure ledger who counts attempts; another way than it was begun with is an error.

    The two ways give the same number different meanings, so a ledger that saw both would allow too many
    attempts for some documents and too few for others.
    """
    if counted not in ("target", "source"):
        raise ValueError(f"attempts are counted by target or source, not {counted}")
    if counted == "target" and not ledgers.failure.updatable:
        raise ValueError("a failure history has no row to add one to: its attempts are source-counted")
    begun = [name for name in children(spark, ledgers.failure.path) if name.startswith("_counted_by_")]
    if not begun:
        fs, marker = file_system(spark, f"{ledgers.failure.path}/_counted_by_{counted}")
        fs.mkdirs(marker.getParent())
        fs.create(marker, True).close()
    elif begun != [f"_counted_by_{counted}"]:
        raise ValueError(f"{ledgers.failure.path} is {begun[0].strip('_')}, this run counts by {counted}")


def read_state(spark: SparkSession, ledgers: Ledgers) -> LedgerState:
    return LedgerState(read_ledger(spark, ledgers.success), read_failures(spark, ledgers),
                       read_ledger(spark, ledgers.details))
