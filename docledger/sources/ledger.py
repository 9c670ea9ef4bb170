"""Ledgers as folders of complete, immutable versions.

Layout: ``<path>/v=<n>/of=<buckets>/``. A version counts once its ``_SUCCESS`` file is there, so a
job that dies while writing leaves nothing readable behind, and a job never overwrites what it
reads. The bucket of a row is a hash of its key. One writer at a time.

An insert-only ledger is the union of its versions: a run writes only its new rows, in as many
files as they need, sorted by a bucket column that lets scans skip row groups. A ledger with updates
has a folder per bucket and is read bucket by bucket, each from its newest version: a run reads
and rewrites only the buckets its keys fall into.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from docledger.operators.bloom import ROWS, blocks_for, dense, filter_rows
from docledger.operators.keys import Seen
from docledger.schemas import ASKED, ATTEMPT_KEYS, FAILURE, FAILURE_DETAILS, KEYS, SUCCESS
from docledger.sources.staging import children, file_system, is_complete

_VERSION = re.compile(r"^v=(\d+)$")
_BUCKET = StructField("bucket", IntegerType())


@dataclass(frozen=True)
class Ledger:
    path: str
    schema: StructType
    keys: tuple[str, ...]
    updatable: bool
    buckets: int = 32
    blocks: int = 0

    def bucket_of(self) -> Column:
        """Bucket by document, so that all ledgers of a run are cut alike."""
        return F.pmod(F.xxhash64(*KEYS), F.lit(self.buckets)).cast("int")


@dataclass(frozen=True)
class Ledgers:
    """The three ledgers of a transfer job below one folder, and what services asked for."""

    success: Ledger
    failure: Ledger
    details: Ledger
    asked: Ledger

    @staticmethod
    def at(root: str, buckets: int = 32, history: bool = False, filter_keys: int = 0) -> "Ledgers":
        """``history`` keeps a row for each failed attempt instead of one for each document.

        ``filter_keys`` keeps a Bloom filter beside each version of the success and failure ledgers, sized
        for that many documents in all; it cannot change later.
        """
        root, blocks = root.rstrip("/"), blocks_for(filter_keys) if filter_keys else 0
        return Ledgers(
            Ledger(f"{root}/success", SUCCESS, KEYS, False, buckets, blocks),
            Ledger(f"{root}/failure", FAILURE, KEYS, not history, buckets, blocks),
            Ledger(f"{root}/failure_details", FAILURE_DETAILS, ATTEMPT_KEYS, False, buckets),
            Ledger(f"{root}/asked", ASKED, KEYS, True, buckets))


def _complete(spark: SparkSession, ledger: Ledger) -> dict[int, str]:
    """Folder of each complete version, newest first, from one listing call."""
    fs, glob = file_system(spark, f"{ledger.path}/v=*/of=*/_SUCCESS")
    found = {}
    for status in fs.globStatus(glob) or []:
        folder = status.getPath().getParent()
        version = _VERSION.match(folder.getParent().getName())
        if version is None:
            continue
        if folder.getName() != f"of={ledger.buckets}":
            raise ValueError(
                f"{ledger.path} was written {folder.getName()}, not of={ledger.buckets} buckets")
        found[int(version.group(1))] = f"{ledger.path}/v={version.group(1)}/{folder.getName()}"
    return dict(sorted(found.items(), reverse=True))


def versions(spark: SparkSession, ledger: Ledger) -> list[int]:
    """Complete versions, newest first."""
    return list(_complete(spark, ledger))


def _newest_buckets(spark: SparkSession, ledger: Ledger) -> dict[int, str]:
    newest: dict[int, str] = {}
    for folder in _complete(spark, ledger).values():
        for name in children(spark, folder):
            if name.startswith("bucket="):
                newest.setdefault(int(name[len("bucket="):]), f"{folder}/{name}")
        if len(newest) == ledger.buckets:
            break
    return newest


def read_ledger(spark: SparkSession, ledger: Ledger,
                buckets: Iterable[int] | None = None) -> DataFrame:
    """The ledger as it stands, or only some of its buckets."""
    wanted = None if buckets is None else set(buckets)
    if ledger.updatable:
        paths = [path for b, path in sorted(_newest_buckets(spark, ledger).items())
                 if wanted is None or b in wanted]
    else:
        paths = list(_complete(spark, ledger).values())
    if not paths:
        return spark.createDataFrame([], ledger.schema)
    if ledger.updatable:
        return spark.read.schema(ledger.schema).parquet(*paths)
    rows = spark.read.schema(StructType(ledger.schema.fields + [_BUCKET])).parquet(*paths)
    if wanted is not None and len(wanted) < ledger.buckets:
        rows = rows.filter(F.col("bucket").isin(sorted(wanted)))
    return rows.select(*ledger.schema.fieldNames())


def write_version(spark: SparkSession, ledger: Ledger, rows: DataFrame) -> int:
    """Write the rows as the next version and return its number.

    For an updatable ledger the rows must be all rows of every bucket they fall into. The
    rebalance hint gathers a bucket into few files and lets a large bucket keep several tasks.
    Rows are written aside and become a version by a rename, so two writers never mix: the
    second to finish the same version gets an error.
    """
    done = versions(spark, ledger)
    version = done[0] + 1 if done else 0
    target = f"{ledger.path}/v={version}/of={ledger.buckets}"
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in ledger.schema.fields]
    laid_out = (rows.select(*columns, ledger.bucket_of().alias("bucket"))
                .hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket"))
    writer = laid_out.write.mode("overwrite")
    if ledger.updatable:
        writer = writer.partitionBy("bucket")
    written = f"{ledger.path}/writing-{uuid.uuid4().hex}"
    writer.parquet(written)
    fs, place = file_system(spark, target)
    if is_complete(spark, target):
        raise RuntimeError(f"another writer has finished {target}; {written} was not made a version")
    fs.delete(place, True)
    fs.mkdirs(place.getParent())
    if not fs.rename(file_system(spark, written)[1], place):
        raise RuntimeError(f"{written} could not become {target}")
    if ledger.blocks:
        keys = spark.read.schema(ledger.schema).parquet(target).select(*KEYS)
        filter_rows(keys, ledger.blocks).coalesce(1).write.mode("overwrite").parquet(_filter(ledger, version))
    return version


def _filter(ledger: Ledger, version: int) -> str:
    return f"{ledger.path}/filter/of={ledger.blocks}/v={version}"


def read_seen(spark: SparkSession, *ledgers: Ledger) -> Seen | None:
    """The filter over the keys of some ledgers; None where a version has none, so that a join must decide."""
    paths, blocks = [], {ledger.blocks for ledger in ledgers}
    if blocks == {0} or len(blocks) > 1:
        return None
    for ledger in ledgers:
        for version in versions(spark, ledger):
            path = _filter(ledger, version)
            if not is_complete(spark, path):
                return None
            paths.append(path)
    rows = spark.read.schema(ROWS).parquet(*paths) if paths else spark.createDataFrame([], ROWS)
    return Seen(dense(rows), blocks.pop())
