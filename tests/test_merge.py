"""Keyed upserts: NULL keys, repeated keys, extra conditions, both ways of counting."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docledger.operators.merge import merge, merge_into_table, rows_to_insert, src, tgt
from docledger.operators.dispatch import split_outcomes
from docledger.plans import ledgers as plans
from tests.helpers import T0, T1, details, failure, outcomes, planned, rows, success


def kv(spark, *pairs, value="v"):
    return spark.createDataFrame(list(pairs), f"k string, {value} string")


@pytest.mark.parametrize("small", [False, True])
def test_upsert(spark, small):
    target, source = kv(spark, ("a", "1"), ("b", "2")), kv(spark, ("b", "x"), ("c", "y"))
    got = merge(target, source, ["k"], matched_set={"v": F.concat(tgt("v"), src("v"))},
                insert_values={"k": src("k"), "v": src("v")}, small_source=small)
    assert rows(got) == [("a", "1"), ("b", "2x"), ("c", "y")]


def test_null_keys_never_match(spark):
    target, source = kv(spark, (None, "1")), kv(spark, (None, "x"), (None, "y"))
    got = merge(target, source, ["k"], matched_set={"v": src("v")},
                insert_values={"k": src("k"), "v": src("v")})
    assert rows(got) == [(None, "1"), (None, "x"), (None, "y")]


def test_null_values_are_updates_not_absences(spark):
    target, source = kv(spark, ("a", "1")), kv(spark, ("a", None))
    got = merge(target, source, ["k"], matched_set={"v": src("v")},
                insert_values={"k": src("k"), "v": src("v")})
    assert rows(got) == [("a", None)]


def test_several_source_rows_for_one_target_row_fail(spark):
    target, source = kv(spark, ("a", "1")), kv(spark, ("a", "x"), ("a", "y"))
    with pytest.raises(PySparkException, match="several source rows"):
        merge(target, source, ["k"], matched_set={"v": src("v")}).collect()


def test_repeated_unmatched_source_rows_all_insert(spark):
    target, source = kv(spark, ("a", "1")), kv(spark, ("b", "x"), ("b", "y"))
    got = merge(target, source, ["k"], matched_set={"v": src("v")},
                insert_values={"k": src("k"), "v": src("v")})
    assert rows(got) == [("a", "1"), ("b", "x"), ("b", "y")]


def test_extra_condition_with_insert_inserts_again(spark):
    """The documented meaning: a target row that fails the condition counts as absent."""
    target, source = kv(spark, ("a", "1"), ("b", "2")), kv(spark, ("a", "x"), ("b", "y"))
    update = merge(target, source, ["k"], matched_set={"v": src("v")}, extra_on=tgt("v") == "1")
    assert rows(update) == [("a", "x"), ("b", "2")]
    both = merge(target, source, ["k"], matched_set={"v": src("v")}, extra_on=tgt("v") == "1",
                 insert_values={"k": src("k"), "v": src("v")})
    assert rows(both) == [("a", "x"), ("b", "2"), ("b", "y")]


def test_unknown_column(spark):
    with pytest.raises(ValueError):
        merge(kv(spark, ("a", "1")), kv(spark, ("a", "x")), ["k"], matched_set={"w": src("v")})


def test_small_source_does_not_shuffle_the_target(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    kv(spark, *[(str(i), "v") for i in range(100)]).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    plan = planned(merge(target, kv(spark, ("5", "x")), ["k"], matched_set={"v": src("v")},
                         unique_source=True, small_source=True))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_unique_keys_take_one_full_join(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("t", "s"):
        kv(spark, *[(str(i), name) for i in range(50)]).write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in ("t", "s"))
    plan = planned(merge(target, source, ["k"], matched_set={"v": src("v")},
                         insert_values={"k": src("k"), "v": src("v")},
                         unique_source=True, unique_target=True))
    assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan
    assert "PushedFilters: [IsNull(k)]" in plan  # the way around for NULL keys


def test_rows_to_insert(spark):
    target, source = kv(spark, ("a", "1")), kv(spark, ("a", "x"), ("b", "y"), (None, "z"))
    for small in (False, True):
        assert rows(rows_to_insert(target, source, ["k"], small_source=small)) == [
            ("b", "y"), (None, "z")]


def test_merge_into_table_needs_a_row_level_format(spark):
    kv(spark, ("a", "1")).write.mode("overwrite").saveAsTable("plain_target")
    with pytest.raises(PySparkException):
        merge_into_table(kv(spark, ("a", "x")), "plain_target", ["k"],
                         matched_set={"v": F.col("source.v")})
    with pytest.raises(ValueError):
        merge_into_table(kv(spark, ("a", "x")), "plain_target", ["k"])


def _expected(target, source, extra, matched, insert):
    """MERGE on (g, k) row by row: ``extra`` and ``matched`` are tests, ``insert`` a test or None."""
    out = []
    for g, k, v, flag in target:
        hits = [s for s in source if None not in (g, k) and (s[0], s[1]) == (g, k) and extra(flag)]
        if hits and matched(flag, hits[0][2]):
            v = hits[0][2]
        out.append((g, k, v, flag))
    for g, k, v in source:
        found = any((t[0], t[1]) == (g, k) and None not in (g, k) and extra(t[3]) for t in target)
        if insert and insert(v) and not found:
            out.append((g, k, v, 0))
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", [
    {}, {"small_source": True}, {"unique_source": True},
    {"unique_source": True, "unique_target": True}])
@pytest.mark.parametrize("case", ["upsert", "update_extra", "conditions"])
def test_merge_against_brute_force(spark, case, how):
    rng = random.Random(f"{case}{how}")
    keys, target, source = [None, "a", "b", "c", "d"], [], []
    for g in range(150):
        target += [(g, rng.choice(keys), rng.randrange(9), rng.randrange(2))
                   for _ in range(rng.randrange(5))]
        picked = rng.sample(keys, rng.randrange(len(keys))) + [None] * rng.randrange(2)
        source += [(g, k, rng.randrange(9)) for k in picked]
    extra = (lambda f: f == 0) if case == "update_extra" else (lambda f: True)
    matched = (lambda f, v: f == 1 and v > 3) if case == "conditions" else (lambda f, v: True)
    insert = {"upsert": lambda v: True, "update_extra": None, "conditions": lambda v: v % 2 == 0}[case]
    got = merge(
        spark.createDataFrame(target, "g int, k string, v int, flag int"),
        spark.createDataFrame(source, "g int, k string, v int"), ["g", "k"],
        matched_set={"v": src("v")},
        matched_if=(tgt("flag") == 1) & (src("v") > 3) if case == "conditions" else None,
        extra_on=tgt("flag") == 0 if case == "update_extra" else None,
        insert_values=None if insert is None else {
            "g": src("g"), "k": src("k"), "v": src("v"), "flag": F.lit(0)},
        insert_if=src("v") % 2 == 0 if case == "conditions" else None, **how)
    assert rows(got) == _expected(target, source, extra, matched, insert)


# --- ledgers --------------------------------------------------------------------------------

def _sides(spark, *results, run="run-1"):
    return split_outcomes(outcomes(spark, *results, run=run))


def test_first_success_stays(spark):
    good, _ = _sides(spark, ("a", "x", 200), ("a", "y", 200))
    got = plans.success_insert_if_absent(success(spark, ("a", "x")), good)
    assert rows(got, "document_id", "correlation_id") == [("x", "run-0"), ("y", "run-1")]
    again = plans.success_insert_if_absent(got, good)
    assert rows(again) == rows(got)


def test_latest_success_wins(spark):
    good, _ = _sides(spark, ("a", "x", 200))
    got = plans.success_upsert_all(success(spark, ("a", "x")), good)
    assert rows(got, "document_id", "correlation_id", "target_path") == [("x", "run-1", "t/x")]


def test_increment(spark):
    _, bad = _sides(spark, ("a", "x", 404), ("a", "new", 500))
    got = plans.failure_upsert_increment(failure(spark, ("a", "x", 2, 0), ("a", "z", 1, 1)), bad)
    assert rows(got, "document_id", "retry_count", "latest_error_code", "full_path", "date_created",
                "date_updated", "reprocess_success") == [
        ("new", 0, 500, "path-new", T1, T1, 0), ("x", 3, 404, "path-x", T0, T1, 0),
        ("z", 1, 503, "path-z", T0, T0, 1)]
    assert rows(plans.failure_upsert_increment(got, bad)) == rows(got)  # the same run again


def test_increment_keeps_path_and_flag(spark):
    _, bad = _sides(spark, ("a", "x", 404))
    old = failure(spark, ("a", "x", 0, 1)).withColumn("full_path", F.lit("first"))
    assert rows(plans.failure_upsert_increment(old, bad), "full_path", "reprocess_success",
                "retry_count") == [("first", 1, 1)]


def test_source_counted(spark):
    _, bad = _sides(spark, ("a", "x", 404), ("a", "new", 500))
    carried = bad.withColumn("retry_count", F.lit(4))
    old = failure(spark, ("a", "x", 2, 1))
    got = plans.failure_upsert_source(old, carried)
    assert rows(got, "document_id", "retry_count", "reprocess_success", "latest_error_code",
                "date_created") == [("new", 4, 0, 500, T1), ("x", 4, 0, 404, T0)]
    plain = plans.failure_upsert_source(old, carried, with_error=False)
    assert ("x", 503) in rows(plain, "document_id", "latest_error_code")


def test_mark_reprocessed(spark):
    good, _ = _sides(spark, ("a", "x", 200), ("a", "y", 200), ("a", "none", 200))
    old = failure(spark, ("a", "x", 1, 0), ("a", "y", 1, 1), ("a", "z", 1, 0))
    guarded = plans.mark_reprocessed(old, good)
    assert rows(guarded, "document_id", "reprocess_success", "date_updated") == [
        ("x", 1, T1), ("y", 1, T0), ("z", 0, T0)]
    free = plans.mark_reprocessed(old, good, guarded=False)
    assert rows(free, "document_id", "reprocess_success", "date_updated") == [
        ("x", 1, T0), ("y", 1, T0), ("z", 0, T0)]


def test_details_once_per_run(spark):
    _, bad = _sides(spark, ("a", "x", 404))
    new = plans.detail_rows(bad)
    got = plans.details_insert_if_absent(details(spark, ("a", "x", "run-0")), new)
    assert rows(got, "correlation_id", "error_code") == [("run-0", 503), ("run-1", 404)]
    assert rows(plans.details_insert_if_absent(got, new)) == rows(got)


@pytest.mark.parametrize("small", [False, True])
def test_one_pass_equals_both_steps(spark, small):
    old = failure(spark, ("a", "ok0", 1, 0), ("a", "ok1", 1, 1), ("a", "bad0", 3, 0),
                  ("a", "bad1", 3, 1), ("a", "idle", 2, 0), (None, "bad0", 9, 0))
    counted = failure(spark, ("a", "again", 5, 0), run="run-1")
    old = old.unionAll(counted)
    good, bad = _sides(spark, ("a", "ok0", 200), ("a", "ok1", 200), ("a", "bad0", 404),
                       ("a", "bad1", 429), ("a", "again", 500), ("a", "fresh", 503),
                       (None, "bad0", 404), ("a", "fresh-ok", 200))
    steps = plans.failure_upsert_increment(plans.mark_reprocessed(old, good), bad)
    assert rows(plans.merge_failures(old, good, bad, small_source=small)) == rows(steps)


def test_empty_and_one_sided_batches(spark):
    before = plans.LedgerState(success(spark, ("a", "x")), failure(spark, ("a", "y", 0, 0)),
                               details(spark, ("a", "y", "run-0")))
    for batch in ([], [("a", "n", 200)], [("a", "n", 404)]):
        after = plans.apply_outcomes(before, outcomes(spark, *batch))
        good = [r for r in batch if r[2] == 200]
        assert after.success.count() == 1 + len(good)
        assert after.failure.count() == after.details.count() == 1 + len(batch) - len(good)


def test_one_per_key(spark):
    mixed = outcomes(spark, ("a", "x", 404), ("a", "x", 200), ("a", "x", 500), ("a", "y", 404),
                     (None, "z", 404), (None, "z", 404))
    assert plans.has_copies(mixed)
    got = plans.one_per_key(mixed)
    assert rows(got, "document_id", "ok") == [("x", True), ("y", False), ("z", False), ("z", False)]
    assert got.columns == mixed.columns and not plans.has_copies(got)


def test_audit_entries(spark):
    got = plans.audit_entries(outcomes(spark, ("a", "x", 200), ("a", "y", 404)))
    assert rows(got, "annotation_id", "status", "status_code", "azure_blob_path", "message") == [
        ("x", "Success", 200, "t/x", ""), ("y", "Failed", 404, None, "code 404")]


def test_a_hot_source_key_collapses_before_the_shuffle(spark, conf):
    """A source is shuffled once, as one row for each key and task, and what comes of it is joined where it is."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    hot = spark.range(20_000).selectExpr("IF(id < 19990, 'hot', concat('k', id)) AS k", "id AS v")
    target = spark.createDataFrame([("k19995", 0), ("other", 1)], "k string, v bigint")
    merged = merge(target, hot, ["k"], matched_set={"v": src("v")})
    assert rows(merged) == [("k19995", 19995), ("other", 1)]
    plan = planned(merged)
    assert plan.count("Exchange hashpartitioning") == 2
    below = plan[plan.index("Exchange hashpartitioning", plan.index("Exchange hashpartitioning") + 1):]
    assert "partial_count" in below
    with pytest.raises(Exception, match="several source rows"):
        merge(spark.createDataFrame([("hot", 0)], "k string, v bigint"), hot, ["k"], matched_set={"v": src("v")}).collect()
    only_keys = merge(target, hot.select("k"), ["k"], matched_set={"v": F.lit(7).cast("bigint")})
    assert rows(only_keys) == [("k19995", 7), ("other", 1)]
