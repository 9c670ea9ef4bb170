"""Worklist, keyed joins and what their plans look like at scale."""

import pytest
from pyspark.sql import functions as F

from docledger.operators import keys, worklist as wl
from docledger.schemas import FAILURE, MANIFEST, SUCCESS
from docledger.sources.tables import create_bucketed
from tests.helpers import failure, final_plan, manifest, planned, rows, success


def test_worklist_takes_new_and_retryable(spark):
    docs = manifest(spark, ("a", "new"), ("a", "done"), ("a", "failed"), ("a", "spent"), ("a", "fixed"))
    failed = failure(spark, ("a", "failed", 5, 0), ("a", "spent", 6, 0), ("a", "fixed", 1, 1),
                     ("a", "gone", 0, 0))
    got = rows(wl.worklist(docs, success(spark, ("a", "done")), failed),
               "document_id", "full_path", "retry_count", "reprocess_success")
    assert got == [("failed", "path-failed", 5, 0), ("gone", "path-gone", 0, 0),
                   ("new", "\\\\srv\\share\\in\\new.pdf", 0, 0)]


def test_policies(spark):
    ledger = failure(spark, *[("a", str(n), n, 0) for n in range(4, 8)], ("a", "flag", 0, 1))
    assert rows(wl.retryable(ledger, wl.TARGET_COUNTED), "document_id") == [("4",), ("5",)]
    assert rows(wl.retryable(ledger, wl.SOURCE_COUNTED), "document_id") == [("4",)]


def test_null_parts(spark):
    no_root = manifest(spark, ("a", "1"), root=None)
    no_folder = manifest(spark, ("a", "2"), folder=None)
    got = wl.worklist(no_root.unionAll(no_folder), success(spark), failure(spark))
    assert rows(got, "document_id", "full_path") == [("2", None)]


def test_null_keys_stay_due(spark):
    docs = manifest(spark, ("a", None), (None, "d"), ("a", "d"))
    known = success(spark, ("a", None), (None, "d"), ("a", "d"))
    assert rows(wl.worklist(docs, known, failure(spark)), "auth_request_id", "document_id") == [
        ("a", None), (None, "d")]


def test_key_in_both_ledgers_is_retried_unless_told_otherwise(spark):
    docs, done, failed = (manifest(spark, ("a", "x")), success(spark, ("a", "x")),
                          failure(spark, ("a", "x", 1, 0)))
    assert wl.worklist(docs, done, failed).count() == 1
    assert wl.worklist(docs, done, failed, skip_succeeded_retries=True).count() == 0


def test_history_ledgers_with_repeated_keys(spark):
    docs = manifest(spark, ("a", "x"), ("a", "y"))
    done = success(spark, *[("a", "x")] * 50)
    got = wl.new_documents(docs, done, failure(spark), repeated_keys=True)
    assert rows(got, "document_id") == [("y",)]


def test_manifest_copies_are_kept(spark):
    docs = manifest(spark, ("a", "x"), ("a", "x"), ("a", "y"))
    assert wl.worklist(docs, success(spark), failure(spark)).count() == 3


def test_previously_failed(spark):
    failed = failure(spark, ("a", "x", 1, 0), ("a", "y", 1, 1))
    docs = manifest(spark, ("a", "x"), ("a", "y"), ("a", "z"))
    assert rows(keys.previously_failed(docs, failed), "document_id") == [("x",)]


def test_except_processed_is_distinct_and_null_equals_null(spark):
    docs = manifest(spark, ("a", None), ("a", "x"), ("a", "x"), ("a", "y"))
    got = keys.except_processed(docs, success(spark, ("a", None)), failure(spark, ("a", "y", 0, 0)))
    assert rows(got) == [("a", "x")]


def test_column_compat(spark):
    df = spark.createDataFrame([("1", None)], "DOC string, AR string")
    got = wl.column_compat(df, ["doc", "ar", "mime"])
    assert got.columns == ["doc", "ar", "mime"] and rows(got) == [("1", "", "")]


def test_multiply_rows(spark):
    df = spark.createDataFrame([("1-2-3-4-abcd", "9-8-7-6-wxyz-tail", "keep"), ("short", None, "k")],
                               "document_id string, auth_request_id string, other string")
    got = rows(wl.multiply_rows(df, 101), "document_id", "auth_request_id", "other")
    assert len(got) == 202
    assert ("1-2-3-4-07cd", "9-8-7-6-07yz", "keep") in got
    assert ("1-2-3-4-100cd", "9-8-7-6-100yz", "keep") in got
    assert got.count((None, None, "k")) == 101
    assert rows(wl.multiply_rows(df, 101, partitions=3), "document_id", "auth_request_id",
                "other") == got
    with pytest.raises(ValueError):
        wl.multiply_rows(df, 0)


def test_stamps_and_ids(spark):
    df = wl.with_correlation(manifest(spark, ("a", "x"), ("a", "y")))
    assert df.select("correlation_id").distinct().count() == 1
    assert wl.stamp(df).select("date_created", "date_updated").dtypes[0][1] == "timestamp"


# --- plans ----------------------------------------------------------------------------------

def _on_disk(spark, folder, n=4000):
    """Manifest and ledgers as parquet; a third of the manifest is one key."""
    i = F.col("id")
    hot = F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), i.cast("string")))
    base = spark.range(0, n, 1, 8).select(
        F.lit("a").alias("auth_request_id"), hot.alias("document_id"), F.lit("ar").alias("ar_number"),
        F.lit("r").alias("root_folder"), F.lit("c").alias("container_folder"),
        i.cast("string").alias("file_name"), "id")
    base.drop("id").write.parquet(f"{folder}/manifest")
    done = base.filter("id % 3 = 1").select(
        *[(F.col(c) if c in base.columns else F.lit(None)).cast(SUCCESS[c].dataType).alias(c)
          for c in SUCCESS.fieldNames()])
    done.write.parquet(f"{folder}/success")
    spark.createDataFrame([], FAILURE).write.parquet(f"{folder}/failure")
    return [spark.read.schema(s).parquet(f"{folder}/{n}")
            for n, s in (("manifest", MANIFEST), ("success", SUCCESS), ("failure", FAILURE))]


def test_worklist_prunes_and_pushes_down(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = planned(wl.worklist(*_on_disk(spark, str(tmp_path))))
    assert plan.count("SortMergeJoin") == 1 and "Cartesian" not in plan
    assert "ReadSchema: struct<auth_request_id:string,document_id:string>" in plan  # the ledgers
    assert "PushedFilters: [IsNotNull(root_folder)]" in plan
    assert "LessThanOrEqual(retry_count,5)" in plan
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("history", [False, True])
def test_hot_manifest_key_is_split(spark, tmp_path, conf, history):
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
         spark__sql__adaptive__coalescePartitions__enabled="false",
         spark__sql__shuffle__partitions="16")
    docs, done, failed = _on_disk(spark, str(tmp_path))
    if history:
        done = done.unionAll(done)
    due = wl.worklist(docs, done, failed, repeated_keys=history)
    assert "skew=true" in final_plan(due)
    assert due.count() == sum(1 for i in range(4000) if i % 3 != 1)


def test_few_documents_do_not_shuffle_the_ledgers(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    docs, done, failed = _on_disk(spark, str(tmp_path))
    few = manifest(spark, ("a", "d1"), ("a", "d4"), ("a", "new"), ("a", None), (None, "d1"))
    due = wl.worklist(few, done, failed, small_docs=True)
    assert "BroadcastHashJoin" in planned(due) and "LeftSemi" in planned(due)
    assert rows(due, "document_id") == rows(wl.worklist(few, done, failed), "document_id") == [
        ("d1",), ("new",), (None,)]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    frames = _on_disk(spark, str(tmp_path))
    wanted = wl.worklist(*frames).count()
    tables = [create_bucketed(df, f"bucketed_{i}", ("auth_request_id", "document_id"), 4)
              for i, df in enumerate(frames)]
    docs, done, _ = tables
    assert "Exchange" not in planned(keys.not_succeeded(docs, done))
    assert wl.worklist(*tables).count() == wanted
