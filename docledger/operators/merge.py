"""Keyed upsert as a composition of joins.

``merge`` maps a target and a source DataFrame to the merged DataFrame, with the meaning of SQL
MERGE. Matched rows come from ``target LEFT JOIN source``, inserted rows from
``source LEFT ANTI JOIN target``; both shapes let Spark broadcast a small source instead of
shuffling the target, and let adaptive execution split a hot key, neither of which a full outer
join allows. Where both sides are known to hold each key once, so that there is no hot key, one full
outer join does both with half the shuffling; rows with a NULL key, which match nothing, go around it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docledger.operators.keys import shared_keys, without_keys

_PREFIX = "_src_"
_HIT = "_src_hit"
_COPIES = "_src_copies"
_KEPT = "_tgt_kept"


def src(name: str) -> Column:
    """A source column inside a clause of ``merge``."""
    return F.col(_PREFIX + name)


def tgt(name: str) -> Column:
    """A target column inside a matched clause of ``merge``."""
    return F.col(name)


def rows_to_insert(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
                   small_source: bool = False) -> DataFrame:
    """Source rows whose key the target lacks.

    ``small_source`` is for a source the caller has measured: the target is first reduced to the
    keys it shares with the (broadcast) source, so that no target row is shuffled.
    """
    present = shared_keys(target, source, keys) if small_source else target
    return without_keys(source, present, keys)


def _collapsed(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key, and how many there are.

    A partial aggregate, so a key with very many rows is not gathered, and what it leaves is already dealt
    out as the join needs it. Which row stays does not matter: several that match are an error.
    """
    others = [c for c in source.columns if c not in keys]
    counted = [F.count(F.lit(1)).alias(_COPIES)]
    if not others:
        return source.groupBy(*keys).agg(*counted)
    row = F.first(F.struct(*others)).alias("_src_row")
    return source.groupBy(*keys).agg(*counted, row).select(*keys, "_src_row.*", _COPIES)


def _any_null(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def _same_key(keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(key) == src(key))
    return on


def _prefixed(source: DataFrame, *extra: str) -> DataFrame:
    return source.select(*[F.col(c).alias(_PREFIX + c) for c in source.columns if c not in extra],
                         *extra, F.lit(True).alias(_HIT))


def _updated(target: DataFrame, matched_set: Mapping[str, Column],
             matched_if: Column | None) -> dict[str, Column]:
    """Value of each target column after the matched clause, over joined rows."""
    applies = F.col(_HIT).isNotNull()
    if matched_if is not None:
        applies = applies & F.coalesce(matched_if, F.lit(False))
    return {c: F.when(applies, matched_set[c]).otherwise(F.col(c)) if c in matched_set else F.col(c)
            for c in target.columns}


def _inserted(target: DataFrame, insert_values: Mapping[str, Column]) -> dict[str, Column]:
    """Value of each target column in an inserted row."""
    return {f.name: insert_values.get(f.name, F.lit(None)).cast(f.dataType)
            for f in target.schema.fields}


def _insert(target: DataFrame, fresh: DataFrame, insert_values: Mapping[str, Column],
            insert_if: Column | None) -> DataFrame:
    """Source rows no target row matches, as target rows."""
    rows = _prefixed(fresh)
    rows = rows if insert_if is None else rows.filter(insert_if)
    return rows.select(*[v.alias(c) for c, v in _inserted(target, insert_values).items()])


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
          matched_set: Mapping[str, Column] | None = None,
          matched_if: Column | None = None,
          insert_values: Mapping[str, Column] | None = None,
          insert_if: Column | None = None,
          extra_on: Column | None = None,
          unique_source: bool = False,
          unique_target: bool = False,
          small_source: bool = False) -> DataFrame:
    """Upsert ``source`` into ``target``; the result has the target's columns.

    matched_set    target column to new value, written with ``src`` and ``tgt``
    matched_if     rows that match but fail this keep their values
    insert_values  target column to value, written with ``src``; None inserts nothing
    insert_if      condition on the source row for an insert
    extra_on       further ON condition over target columns. With an insert clause, a target row
                   that fails it counts as absent, so its key is inserted a second time: use it
                   with update-only merges
    unique_source  the caller vouches for unique keys; otherwise several source rows for one
                   target row make the job fail when the rows are computed
    unique_target  the target holds each key about once; matters for speed only
    small_source   the caller has measured the source and it may be broadcast
    """
    columns = target.columns
    unknown = set(matched_set or ()) - set(columns)
    if unknown:
        raise ValueError(f"not in the target: {sorted(unknown)}")
    if (matched_set and insert_values is not None and extra_on is None
            and unique_source and unique_target and not small_source):
        return _merge_by_full_join(target, source, keys, matched_set, matched_if, insert_values,
                                   insert_if)
    result = target
    if matched_set:
        rows = _prefixed(source) if unique_source else _prefixed(_collapsed(source, keys), _COPIES)
        on = _same_key(keys) if extra_on is None else _same_key(keys) & extra_on
        joined = target.join(F.broadcast(rows) if small_source else rows, on, "left")
        values = _updated(target, matched_set, matched_if)
        if not unique_source:
            several = F.col(_HIT).isNotNull() & (F.col(_COPIES) > 1)
            failing = F.raise_error(F.lit("several source rows match one target row"))
            first = keys[0]
            values[first] = F.when(several, failing.cast(target.schema[first].dataType)).otherwise(
                values[first])
        result = joined.select(*[values[c].alias(c) for c in columns])
    if insert_values is not None:
        known = target if extra_on is None else target.filter(extra_on)
        fresh = rows_to_insert(known, source, keys, small_source=small_source)
        result = result.unionAll(_insert(target, fresh, insert_values, insert_if))
    return result


def _merge_by_full_join(target: DataFrame, source: DataFrame, keys: Sequence[str],
                        matched_set: Mapping[str, Column], matched_if: Column | None,
                        insert_values: Mapping[str, Column],
                        insert_if: Column | None) -> DataFrame:
    loose = _any_null(keys)
    kept = target.filter(~loose).withColumn(_KEPT, F.lit(True))
    joined = kept.join(_prefixed(source.filter(~loose)), _same_key(keys), "full")
    if insert_if is not None:
        joined = joined.filter(F.col(_KEPT).isNotNull() | insert_if)
    old, new = _updated(target, matched_set, matched_if), _inserted(target, insert_values)
    merged = joined.select(*[
        F.when(F.col(_KEPT).isNotNull(), old[c]).otherwise(new[c]).alias(c) for c in target.columns])
    around = _insert(target, source.filter(loose), insert_values, insert_if)
    return merged.unionAll(target.filter(loose)).unionAll(around)


def merge_into_table(source: DataFrame, table: str, keys: Sequence[str], *,
                     matched_set: Mapping[str, Column] | None = None,
                     matched_if: Column | None = None,
                     insert_values: Mapping[str, Column] | None = None) -> None:
    """The same upsert on a catalog table whose format has row-level MERGE (Delta, Iceberg).

    Spark's own ``mergeInto`` runs it; expressions name the table's columns as
    ``<table>.<column>`` and the source's as ``source.<column>``.
    """
    if not matched_set and insert_values is None:
        raise ValueError("a merge needs a matched clause or an insert clause")
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(f"{table}.{key}") == F.col(f"source.{key}"))
    writer = source.alias("source").mergeInto(table, on)
    if matched_set:
        matched = writer.whenMatched() if matched_if is None else writer.whenMatched(matched_if)
        writer = matched.update(dict(matched_set))
    if insert_values is not None:
        writer = writer.whenNotMatched().insert(dict(insert_values))
    writer.merge()
