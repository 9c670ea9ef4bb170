"""Words, hashes and shingles of whole texts, shared by the operators of this folder.

Everything here works on the UTF-8 bytes of a text: ``bytes.lower`` changes A-Z only and
``bytes.split`` splits at exactly ``\\x20`` and ``\\x09-\\x0D``, and neither byte range occurs inside
a longer UTF-8 sequence.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.session import ship

MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
BLOCK = 1 << 17  # bytes hashed at once; the arrays of a block, 8 bytes for each, are to fit a core's cache

_blank = np.zeros(256, bool)
_blank[[0x20, 9, 10, 11, 12, 13]] = True
_powers = _inverses = np.ones(1, np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, as ``doc_id`` and UTF-8 ``text``; a null text is empty."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))


def hand_back() -> None:
    """What the allocators of this process hold but do not use goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def handing_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` as a task of Arrow batches that hands back its memory at its end.

    Python workers live on and serve later tasks, also of other operators, beside an executor's JVM.
    """
    def whole(batches):
        yield from run(batches)
        hand_back()

    return whole


def map_documents(
    docs: DataFrame, schema: str, each: Callable[[Iterator[tuple]], Iterator[tuple | pa.RecordBatch]],
    id_col: str = "doc_id", text_col: str = "text", batch_rows: int = 2000,
) -> DataFrame:
    """``each`` turns an iterator of (id, bytes) into rows, or ready batches of them; texts stay in the task that read them."""
    ship(docs.sparkSession)
    source = id_and_bytes(docs, id_col, text_col)
    fields = docs.sparkSession.createDataFrame([], schema).schema
    id_type = source.schema["doc_id"].dataType
    if fields.fieldNames()[0] == "doc_id":
        fields[0].dataType = id_type
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches):
        def documents():
            for batch in batches:
                # In small steps, so that a batch of long texts is never held twice.
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                   strict=True)

        rows = []
        for row in each(documents()):
            if isinstance(row, pa.RecordBatch):
                yield row
                continue
            rows.append(row)
            if len(rows) >= batch_rows:
                yield columns(rows, arrow)
                rows = []
        if rows:
            yield columns(rows, arrow)

    return source.mapInArrow(handing_back(run), fields)


def columns(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in
         zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)


def keep_rows(docs: DataFrame, verdicts: Callable[[list[bytes]], list[bool]],
              text_col: str = "text") -> DataFrame:
    """Rows whose text ``verdicts`` keeps, every column as it was."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(docs.sparkSession)
    at = docs.columns.index(text_col)
    arrow = to_arrow_schema(docs.schema)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [(t or "").encode() for t in part.column(at).to_pylist()]
                kept = part.filter(pa.array(verdicts(texts), pa.bool_()))
                if kept.num_rows:
                    yield pa.RecordBatch.from_arrays(kept.columns, schema=arrow)

    return docs.mapInArrow(handing_back(run), docs.schema)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < size:
        size = max(size, 2 * len(_powers))
        out = []
        for base in (MULTIPLIER, INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        _powers, _inverses = out
    return _powers, _inverses


def _pieces(data: bytes) -> Iterator[bytes]:
    """Parts of at most about BLOCK bytes, cut at blanks; only a longer word makes a longer part."""
    at = 0
    while len(data) - at > BLOCK:
        end = at + BLOCK
        while end < len(data) and not _blank[data[end]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes."""
    powers, inverses = _tables(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    values = raw.astype(np.uint64)
    values += np.uint64(1)
    values *= powers[:len(raw)]
    np.cumsum(values, out=prefix[1:])
    h = prefix.take(ends)
    h -= prefix.take(starts)
    h *= inverses.take(starts)
    h += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mixed(h)


def _hash_piece(data: bytes, tails: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words, and where they begin."""
    raw = np.frombuffer(data, np.uint8)
    word = np.zeros(len(raw) + 2, bool)
    # Bytes are taken modulo 256, so the second test is that for 9 to 13.
    np.not_equal(raw, 0x20, out=word[1:-1])
    word[1:-1] &= raw - np.uint8(9) > 4
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    h = range_hashes(raw, starts, ends)
    if not tails:
        return h, starts
    out = np.empty((len(h), 2), np.uint64)
    out[:, 0] = h
    before = raw.take(np.maximum(ends - 2, 0)).astype(np.uint64)
    before *= ends - starts > 1
    before <<= np.uint64(8)
    before |= raw.take(ends - 1)
    out[:, 1] = before
    return out, starts


def word_hashes(texts: list[bytes], lower: bool = True,
                tails: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after another, and where each text begins.

    The second array has one entry more than there are texts. With ``tails`` the first has two
    columns, the hash and the last two bytes of the word. Work memory follows BLOCK, not the length
    of a text.
    """
    out, bounds, group, size = [], [0], [], 0

    def flush():
        nonlocal group, size
        if not group:
            return
        joined = b"\n".join(group)
        h, first = _hash_piece(joined.lower() if lower else joined, tails)
        ends = np.cumsum([len(t) + 1 for t in group])
        base = bounds[-1]
        bounds.extend((base + np.searchsorted(first, ends)).tolist())
        out.append(h)
        group, size = [], 0

    for text in texts:
        if len(text) > BLOCK:
            flush()
            parts = [_hash_piece(p.lower() if lower else p, tails)[0] for p in _pieces(text)]
            out.extend(parts)
            bounds.append(bounds[-1] + sum(map(len, parts)))
            continue
        if size + len(text) > BLOCK:
            flush()
        group.append(text)
        size += len(text) + 1
    flush()
    return (np.concatenate(out or [np.zeros((0, 2) if tails else 0, np.uint64)]),
            np.asarray(bounds, np.int64))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` neighbouring entries."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        factor = pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64)
        total += h[j:j + n] * np.uint64(factor)
    return mixed(total)


def shingle_set(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct shingles of one text's word hashes; a shorter text is one shingle, no words none."""
    if len(h) == 0:
        return h
    return np.unique(windows(h, min(k, len(h))))
