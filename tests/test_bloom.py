"""Bloom filters as rows, and the worklist that goes around the join by them."""

import pytest
from pyspark.sql import functions as F

from docledger.operators import bloom
from docledger.operators.keys import Seen, pending_only
from docledger.operators.worklist import worklist
from docledger.plans.job import transfer_job
from docledger.sources.ledger import Ledgers, read_ledger, read_seen, versions, write_version
from tests.helpers import failure, final_plan, manifest, planned, rows, success
from tests.test_runs import docs, option, service


def keyed(spark, start, end):
    return spark.range(start, end).select(F.lit("a").alias("auth_request_id"), F.concat(F.lit("d"), "id").alias("document_id"))


@pytest.mark.parametrize("keys,most", [(5_000, 0.03), (2_000, 0.001)])
def test_nothing_known_is_missed_and_few_others_are_held(spark, keys, most):
    blocks = bloom.blocks_for(5_000)
    seen = bloom.dense(bloom.filter_rows(keyed(spark, 0, keys), blocks))
    marked = bloom.maybe_known(keyed(spark, 0, 40_000), seen, blocks)
    known = F.expr(f"CAST(substr(document_id, 2) AS INT) < {keys}")
    counted = marked.agg(F.count_if(known & F.col("_maybe")).alias("known"),
                         F.count_if(~known & F.col("_maybe")).alias("others")).first()
    assert counted["known"] == keys
    assert counted["others"] <= most * (40_000 - keys)


def test_filters_are_united(spark):
    one, two = (bloom.filter_rows(keyed(spark, a, b), 4) for a, b in ((0, 300), (200, 500)))
    both = bloom.filter_rows(keyed(spark, 0, 500), 4)
    assert rows(bloom.dense(one.union(two))) == rows(bloom.dense(both))


def test_blocks():
    assert bloom.blocks_for(1) == 1 and bloom.blocks_for(409) == 1 and bloom.blocks_for(410) == 2
    assert bloom.blocks_for(10**12) == bloom.MOST_BLOCKS


def filled(spark, path, n=200, **kind):
    ledgers = Ledgers.at(str(path), buckets=4, filter_keys=kind.pop("filter_keys", 1000), **kind)
    for part in range(2):
        write_version(spark, ledgers.success, success(spark, *[("a", f"d{i}") for i in range(part, n, 4)]))
    write_version(spark, ledgers.failure, failure(spark, *[("a", f"d{i}", i % 8, i % 2) for i in range(2, n, 4)]))
    return ledgers


def test_worklist_is_the_same(spark, tmp_path):
    ledgers = filled(spark, tmp_path)
    some = docs(spark, 600).union(manifest(spark, ("a", None), (None, "d1"), ("a", "d0"), ("a", "new"), ("a", "new")))
    parts = [some, read_ledger(spark, ledgers.success), read_ledger(spark, ledgers.failure)]
    seen = read_seen(spark, ledgers.success, ledgers.failure)
    assert rows(worklist(*parts, seen=seen)) == rows(worklist(*parts))
    assert rows(worklist(*parts, seen=seen, small_docs=True)) == rows(worklist(*parts))
    assert rows(worklist(some.limit(0), *parts[1:], seen=seen)) == rows(worklist(some.limit(0), *parts[1:]))


def test_new_documents_are_not_shuffled(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    ledgers = filled(spark, tmp_path)
    docs(spark, 5000).write.parquet(str(tmp_path / "manifest"))
    some = spark.read.parquet(str(tmp_path / "manifest")).select("auth_request_id", "document_id")
    seen = read_seen(spark, ledgers.success, ledgers.failure)
    marked = bloom.maybe_known(some, seen.words, seen.blocks)
    fresh = planned(marked.filter("NOT _maybe").select("document_id"))
    # Only the filter itself is put together by a shuffle, before it is broadcast.
    around = fresh.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in fresh and "Exchange" not in around and "SortMergeJoin" not in fresh
    assert marked.filter("_maybe").count() < 300  # 150 known ones and few more are what is joined
    joined = pending_only(some, read_ledger(spark, ledgers.success), read_ledger(spark, ledgers.failure), seen=seen)
    plan = final_plan(joined)
    assert plan.count("SortMergeJoin") == 1
    # The filter comes before the shuffle, not after it.
    assert "BroadcastHashJoin" in plan[plan.index("SortMergeJoin"):]


def test_a_version_without_a_filter_means_a_join(spark, tmp_path):
    ledgers, plain = filled(spark, tmp_path), Ledgers.at(str(tmp_path), buckets=4)
    assert isinstance(read_seen(spark, ledgers.success, ledgers.failure), Seen)
    assert read_seen(spark, plain.success, plain.failure) is None
    write_version(spark, plain.success, success(spark, ("a", "later")))
    assert read_seen(spark, ledgers.success, ledgers.failure) is None
    other = Ledgers.at(str(tmp_path), buckets=4, filter_keys=10_000)
    assert read_seen(spark, other.success, other.failure) is None
    empty = Ledgers.at(str(tmp_path / "none"), buckets=4, filter_keys=10)
    seen = read_seen(spark, empty.success, empty.failure)
    assert versions(spark, empty.success) == [] and pending_only(
        keyed(spark, 0, 5), keyed(spark, 0, 0), keyed(spark, 0, 0), seen=seen).count() == 5


def test_runs_with_filters(spark, tmp_path):
    ledgers = Ledgers.at(str(tmp_path), buckets=4, filter_keys=500)
    assert transfer_job(spark, docs(spark), ledgers, service(["d1", "d2"]), option(0))["total"] == 12
    assert transfer_job(spark, docs(spark, 14), ledgers, service(["d2"]), option(1))["total"] == 4
    assert transfer_job(spark, docs(spark, 14), ledgers, service(), option(2))["total"] == 1
