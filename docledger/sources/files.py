"""File content: bytes, digests, and the chunked, verified copy of one file.

Paths are URIs or mounted paths; tasks open them through ``pyarrow.fs``. Only local roots are
tested; whether a rename replaces an existing target differs between file systems.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from docledger.operators.dispatch import Reply

CHUNK = 1024 * 1024

_REFUSED = Reply(500, '{"message":"Target exists"}', final=True)

#: Bytes of a large file that a task reads at once when its stretches are compared.
RANGE = 256 * 1024 * 1024

# File content held in a task before it is handed on.
FLUSH = 32 * 1024 * 1024


def open_root(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and base path of a root given as URI or as path."""
    if "://" not in root and root.startswith("file:"):
        root = root[len("file:"):]
    if "://" in root:
        return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", root))
    return pafs.LocalFileSystem(), root


def below(base: str, relative: str | None) -> str:
    """A path under ``base``; one that would climb out of it is an error."""
    parts = (relative or "").split("/")
    if not relative or any(p in ("", ".", "..") or "\0" in p for p in parts):
        raise ValueError(f"path does not name a file below its root: {relative!r}")
    return f"{base.rstrip('/')}/{relative}"


def chunks(fs: pafs.FileSystem, path: str, size: int = CHUNK) -> Iterator[bytes]:
    with fs.open_input_stream(path) as stream:
        while block := stream.read(size):
            yield block


def _write_all(fs: pafs.FileSystem, path: str, data: bytes) -> None:
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data)


def digest(fs: pafs.FileSystem, path: str, size: int = CHUNK) -> tuple[int, str]:
    """Size and SHA-256 of a file, read in chunks."""
    total, sha = 0, hashlib.sha256()
    for block in chunks(fs, path, size):
        total += len(block)
        sha.update(block)
    return total, sha.hexdigest()


def publish(fs: pafs.FileSystem, written: str, target: str) -> None:
    """Give a finished file its name unless that name is taken, in one step of the file system.

    Raises FileExistsError where it is: whoever comes first keeps the name, whatever was seen before. Mounted
    file systems make a hard link, HDFS renames without replacing. Other file systems offer no such step through
    ``pyarrow.fs``; ``PUBLISHERS`` takes one for them, such as a conditional put.
    """
    kind = fs.type_name
    if kind not in PUBLISHERS:
        raise NotImplementedError(f"no exclusive create for file systems of type {kind}: add one to PUBLISHERS")
    PUBLISHERS[kind](fs, written, target)


def _by_link(fs: pafs.FileSystem, written: str, target: str) -> None:
    os.link(written, target)
    os.unlink(written)


def _by_rename(fs: pafs.FileSystem, written: str, target: str) -> None:
    """HDFS refuses a rename to a name that is there, which is the check; the look-up only tells why."""
    try:
        fs.move(written, target)
    except OSError as error:
        if fs.get_file_info(target).type != pafs.FileType.NotFound:
            raise FileExistsError(f"Target exists: {target}") from error
        raise


#: How a finished file becomes its target only if there is none, by type of file system.
PUBLISHERS: dict[str, Callable[[pafs.FileSystem, str, str], None]] = {"local": _by_link, "hdfs": _by_rename}


@dataclass(frozen=True)
class FileCopy:
    """Transport that copies ``row['source_file']`` to ``row['target_key']`` and checks the copy.

    The copy is written under a temporary name, read back, compared by size and hash, and only
    then renamed; a bad copy is deleted. Sending a row twice therefore gives the same file.

    With ``claims``, a folder below the target root that belongs to the run, a target is never replaced: one
    that is there, or that somebody makes while the copy is under way, is refused with code 500, ``Target
    exists``. Before a copy gets its name, a claim of its row is written there with the digest; a task
    that runs again, because its executor was lost or its run died, knows its own copy by claim and content.
    """

    source_root: str
    target_root: str
    chunk: int = CHUNK
    claims: str | None = None

    @contextmanager
    def open_client(self) -> Iterator[tuple]:
        """The two file systems, opened once per task."""
        yield (*open_root(self.source_root), *open_root(self.target_root))

    def __call__(self, client: tuple, row: dict) -> Reply:
        source_fs, source_base, target_fs, target_base = client
        source = below(source_base, row["source_file"])
        target = below(target_base, row["target_key"])
        if source_fs.get_file_info(source).type != pafs.FileType.File:
            raise FileNotFoundError(f"File not found: {row['full_path']}")
        claim = self._claim_of(target_base, row) if self.claims else None
        if claim and (known := self._standing(target_fs, target, row, self._claimed(target_fs, claim))):
            return known
        partial = f"{target}.{uuid.uuid4().hex}.part"
        target_fs.create_dir(target.rpartition("/")[0], recursive=True)
        try:
            size, sha = self._write(source_fs, source, target_fs, partial)
            if digest(target_fs, partial, self.chunk) != (size, sha):
                raise RuntimeError(f"copy failed validation: {row['target_key']}")
            if claim is None:
                target_fs.move(partial, target)
                return self._copied(row, size, sha)
            _write_all(target_fs, claim, json.dumps([size, sha]).encode())
            try:
                publish(target_fs, partial, target)
            except FileExistsError:
                target_fs.delete_file(partial)
                return self._standing(target_fs, target, row, (size, sha)) or _REFUSED
            return self._copied(row, size, sha)
        except BaseException:
            if target_fs.get_file_info(partial).type != pafs.FileType.NotFound:
                target_fs.delete_file(partial)
            raise

    def _copied(self, row: dict, size: int, sha: str) -> Reply:
        return Reply(200, json.dumps({"status": "Success", "azure_blob_path": row["target_key"],
                                      "total_bytes": size, "sha256": sha}))

    def _claim_of(self, base: str, row: dict) -> str:
        """Where this row's claim is; a thousand folders or so share them."""
        named = json.dumps([row.get(c) for c in ("auth_request_id", "document_id", "full_path", "target_key")])
        name = hashlib.sha256(named.encode()).hexdigest()
        return f"{below(base, self.claims)}/{name[:3]}/{name}"

    def _claimed(self, fs: pafs.FileSystem, claim: str) -> tuple[int, str] | None:
        """Size and hash that an earlier attempt of this row was about to publish."""
        if fs.get_file_info(claim).type != pafs.FileType.File:
            return None
        try:
            size, sha = json.loads(b"".join(chunks(fs, claim)))
        except ValueError:  # cut off in writing, so nothing was published after it
            return None
        return size, sha

    def _standing(self, fs: pafs.FileSystem, target: str, row: dict,
                  claimed: tuple[int, str] | None) -> Reply | None:
        """What is to be said of a target that is there: this row's own copy, or a foreign file; None if there is none."""
        if fs.get_file_info(target).type == pafs.FileType.NotFound:
            return None
        if claimed is not None and digest(fs, target, self.chunk) == claimed:
            return self._copied(row, *claimed)
        return _REFUSED

    def _write(self, source_fs: pafs.FileSystem, source: str,
               target_fs: pafs.FileSystem, partial: str) -> tuple[int, str]:
        size, sha = 0, hashlib.sha256()
        with target_fs.open_output_stream(partial) as out:
            for block in chunks(source_fs, source, self.chunk):
                out.write(block)
                size += len(block)
                sha.update(block)
        return size, sha.hexdigest()


def _per_file(df: DataFrame, root: str, column: str, fields: list[StructField],
              look: Callable[[pafs.FileSystem, str], tuple], partitions: int | None) -> DataFrame:
    """Add what ``look`` finds at the file each row names; NULLs where there is no such file.

    Work follows the rows, dealt out evenly (``partitions=0`` leaves them where they are): no
    folder is listed, so neither the number of files nor their spread over folders matters, and
    empty files are files like any other.
    """
    schema = StructType(df.schema.fields + fields)
    arrow = to_arrow_schema(StructType(fields))
    absent = (None,) * len(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_root(root)

        def found(relative: str | None) -> tuple:
            try:
                path = below(base, relative)
            except ValueError:
                return absent
            return look(fs, path) if fs.get_file_info(path).type == pafs.FileType.File else absent

        def joined(batch: pa.RecordBatch, start: int, values: list[tuple]) -> pa.RecordBatch:
            added = [pa.array([v[i] for v in values], field.type) for i, field in enumerate(arrow)]
            return pa.RecordBatch.from_arrays(
                [*batch.slice(start, len(values)).columns, *added],
                names=[*batch.schema.names, *arrow.names])

        for batch in batches:
            start, held, values = 0, 0, []
            for relative in batch.column(column).to_pylist():
                values.append(found(relative))
                held += sum(len(v) for v in values[-1] if isinstance(v, bytes))
                if held > FLUSH:
                    yield joined(batch, start, values)
                    start, held, values = start + len(values), 0, []
            if values:
                yield joined(batch, start, values)

    if partitions is None:
        partitions = df.sparkSession.sparkContext.defaultParallelism
    return (df.repartition(partitions) if partitions else df).mapInArrow(run, schema)


def read_bytes(df: DataFrame, root: str, column: str, name: str = "content",
               partitions: int | None = None) -> DataFrame:
    """Add the whole content of each row's file. For files that fit in memory one at a time."""
    def look(fs: pafs.FileSystem, path: str) -> tuple:
        return (b"".join(chunks(fs, path)),)
    return _per_file(df, root, column, [StructField(name, BinaryType())], look, partitions)


def with_digest(df: DataFrame, root: str, column: str, prefix: str = "",
                partitions: int | None = None) -> DataFrame:
    """Add ``<prefix>length`` and ``<prefix>sha256`` of each row's file, read in chunks."""
    fields = [StructField(f"{prefix}length", LongType()), StructField(f"{prefix}sha256", StringType())]
    return _per_file(df, root, column, fields, digest, partitions)


def with_file_size(df: DataFrame, root: str, column: str, name: str = "file_size",
                   partitions: int | None = None) -> DataFrame:
    """Add the size of each row's file."""
    def look(fs: pafs.FileSystem, path: str) -> tuple:
        return (fs.get_file_info(path).size,)
    return _per_file(df, root, column, [StructField(name, LongType())], look, partitions)


def verify_copy(pairs: DataFrame, source_root: str, target_root: str,
                partitions: int | None = None) -> DataFrame:
    """Compare each row's source_file and target_key by size and hash.

    Adds source_length, target_length and ``same``, which is false where either file is missing.
    """
    both = with_digest(with_digest(pairs, source_root, "source_file", "source_", partitions),
                       target_root, "target_key", "target_", partitions=0)
    same = ((F.col("source_length") == F.col("target_length"))
            & (F.col("source_sha256") == F.col("target_sha256")))
    return both.withColumn("same", F.coalesce(same, F.lit(False))).drop(
        "source_sha256", "target_sha256")


def byte_ranges(df: DataFrame, sizes: str, size: int = RANGE) -> DataFrame:
    """A row for each stretch of ``size`` bytes of each row's file: ``part``, ``start`` and ``bytes``.

    ``sizes`` names a column with the file's size. An empty file has one empty part, a missing one (NULL) none.
    """
    last = F.greatest(F.ceil(F.col(sizes) / F.lit(size)).cast("long") - 1, F.lit(0).cast("long"))
    parts = df.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.col("part") * size
    return parts.withColumns({"start": start, "bytes": F.least(F.lit(size).cast("long"), F.col(sizes) - start)})


def with_range_digest(ranges: DataFrame, root: str, column: str, name: str = "sha256") -> DataFrame:
    """Add the SHA-256 of each stretch of bytes; NULL where the file ends before the stretch does.

    Rows are read where they are: deal them out first.
    """
    schema = StructType(ranges.schema.fields + [StructField(name, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_root(root)
        for batch in batches:
            found = [_range_digest(fs, base, *where) for where in zip(
                *(batch.column(c).to_pylist() for c in (column, "start", "bytes")), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())],
                                             names=[*batch.schema.names, name])

    return ranges.mapInArrow(run, schema)


def _range_digest(fs: pafs.FileSystem, base: str, relative: str, start: int, size: int) -> str | None:
    try:
        path = below(base, relative)
    except ValueError:
        return None
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    sha, left = hashlib.sha256(), size
    with fs.open_input_file(path) as stream:
        if start + size > stream.size():
            return None
        stream.seek(start)
        while left and (block := stream.read(min(left, CHUNK))):
            sha.update(block)
            left -= len(block)
    return None if left else sha.hexdigest()


def _dealt(ranges: DataFrame, column: str, partitions: int | None) -> DataFrame:
    """Stretches dealt out by file and number, so that those of one large file lie in many tasks."""
    if partitions is None:
        partitions = ranges.sparkSession.sparkContext.defaultParallelism
    return ranges.repartition(partitions, column, "part")


def with_tree_digest(df: DataFrame, root: str, column: str, size: int = RANGE,
                     partitions: int | None = None) -> DataFrame:
    """Add ``length`` and ``tree_sha256`` of each row's file, read by as many tasks as it has stretches.

    A SHA-256 over a whole file has to be computed in order, by one task. The tree digest is the SHA-256 over the
    digests of the file's stretches of ``size`` bytes, in order (as hex text), so that only digests meet: 64
    characters for each stretch. Rows that name the same file share its reading; a missing file has NULLs.
    """
    sized = with_file_size(df.select(column).where(F.col(column).isNotNull()).distinct(), root, column, "length", partitions)
    parts = with_range_digest(_dealt(byte_ranges(sized, "length", size), column, partitions), root, column)
    listed = F.array_sort(F.collect_list(F.struct("part", "sha256")))
    trees = parts.groupBy(column).agg(
        F.first("length").alias("length"), F.count("*").alias("_parts"), F.count("sha256").alias("_read"),
        F.sha2(F.array_join(F.transform(listed, lambda p: p["sha256"]), ""), 256).alias("tree_sha256"))
    # A file that shrank while it was read has no digest.
    whole = trees.select(column, "length", F.when(F.col("_parts") == F.col("_read"), F.col("tree_sha256")).alias("tree_sha256"))
    return df.join(whole, column, "left")


def damaged_ranges(pairs: DataFrame, source_root: str, target_root: str, size: int = RANGE,
                   partitions: int | None = None) -> DataFrame:
    """Where targets differ from their sources: a row for each stretch that does, with ``start`` and ``bytes``.

    Like ``verify_copy``, for files too large for one task: every stretch of a file is read on both sides by
    a task of its own, and a wrong byte is found to within ``size`` bytes. ``problem`` is ``content``; ``length``
    for a target of another size, and then also its stretches are compared as far as both go;
    ``source missing`` or ``target missing``, each a single row.
    """
    sized = with_file_size(with_file_size(pairs, source_root, "source_file", "_source", partitions),
                           target_root, "target_key", "_target", partitions=0)
    columns = [c for c in sized.columns if not c.startswith("_")]
    missing = F.when(F.col("_source").isNull(), "source missing").when(F.col("_target").isNull(), "target missing")
    uneven = F.col("_source") != F.col("_target")
    whole = sized.withColumn("problem", F.coalesce(missing, F.when(uneven, F.lit("length")))).where("problem IS NOT NULL")
    both = sized.where("_source IS NOT NULL AND _target IS NOT NULL").withColumn("_both", F.least("_source", "_target"))
    parts = _dealt(byte_ranges(both, "_both", size), "source_file", partitions)
    read = with_range_digest(with_range_digest(parts, source_root, "source_file", "_a"), target_root, "target_key", "_b")
    wrong = read.where(~F.col("_a").eqNullSafe(F.col("_b")) | F.col("_a").isNull())
    return wrong.select(*columns, "start", "bytes", F.lit("content").alias("problem")).unionByName(
        whole.select(*columns, "problem"), allowMissingColumns=True)


def source_exists(worklist: DataFrame, root: str, column: str = "source_file",
                  partitions: int | None = None) -> DataFrame:
    """Add ``missing_code``: 404 where the source file is not there."""
    return (with_file_size(worklist, root, column, "_size", partitions)
            .withColumn("missing_code", F.when(F.col("_size").isNull(), F.lit(404))).drop("_size"))


def overwrite_guard(worklist: DataFrame, root: str, column: str = "target_key",
                    partitions: int | None = None) -> DataFrame:
    """Add ``blocked_code``: 500 where the target exists already."""
    return (with_file_size(worklist, root, column, "_size", partitions)
            .withColumn("blocked_code", F.when(F.col("_size").isNotNull(), F.lit(500))).drop("_size"))


def write_text_files(df: DataFrame, root: str, key: str, text: str) -> DataFrame:
    """Write each row's text as one file and return key and size of what was written."""
    schema = StructType([StructField(key, StringType()), StructField("written", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_root(root)
        for batch in batches:
            names, sizes = batch.column(key).to_pylist(), []
            for name, content in zip(names, batch.column(text).to_pylist()):
                path, data = below(base, name), (content or "").encode()
                partial = f"{path}.{uuid.uuid4().hex}.part"
                _write_all(fs, partial, data)
                fs.move(partial, path)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=[key, "written"])

    return df.select(key, text).mapInArrow(run, schema)
