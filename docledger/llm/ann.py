"""Approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to length one and cut in two halves; each half is quantised by a codebook of its
own, so that ``codes`` x ``codes`` cells partition all rows. A query walks the cells in the order of
the summed distances of its halves (multi-sequence walk with a heap) until they hold enough rows,
and all rows of these cells are reranked by the exact cosine of the original vectors.

Scale: the codebooks come from a bounded sample, every row is indexed. Equal vectors are stored once
with their ``k + 1`` smallest ids, which are the only ones that ties can ever let into a result. The
rows of a first-half code are cut into blocks, and so are the queries; a task compares one block of
rows with one block of queries and returns its best ``k``.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.session import ship

#: Codes of each half.
CODES = 64
#: Rows, those with the smallest hash of their id, on which the codebooks are fitted.
SAMPLE = 16_384
#: A query reads cells until they hold this share of all distinct vectors. Vectors without any
#: structure, as in the given tables, need this much for a recall of 0.9; clustered ones need less.
SHARE = 0.42
ROW_BLOCK, QUERY_BLOCK = 4_096, 8_192


def _valid(vectors: list, width: int | None = None) -> tuple[np.ndarray, list[int]]:
    """Vectors that take part, and their places: not null, zero, or with null or non-finite parts."""
    rows, at = [], []
    for i, vector in enumerate(vectors):
        if vector is None or not len(vector) or any(x is None for x in vector):
            continue
        row = np.asarray(vector, np.float64)
        if np.isfinite(row).all() and row.any() and width in (None, len(row)):
            rows.append(row)
            at.append(i)
    return np.stack(rows) if rows else np.zeros((0, width or 0)), at


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares cannot overflow
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _distances(half: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((half ** 2).sum(1)[:, None] + (codes ** 2).sum(1) - 2 * half @ codes.T, 0)


def fit_codes(half: np.ndarray, codes: int, turns: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's k-means; at most one code for each row."""
    rng = np.random.default_rng(seed)
    centres = half[rng.choice(len(half), min(codes, len(half)), replace=False)].copy()
    for _ in range(turns):
        nearest = _distances(half, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, half)
        sizes = np.bincount(nearest, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Cells by rising sum of the two distances until they hold ``enough`` rows."""
    a, b = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    heap = [(first[a[0]] + second[b[0]], 0, 0)]
    seen, cells, rows = {(0, 0)}, [], 0
    while heap and rows < enough:
        _, i, j = heapq.heappop(heap)
        if n := sizes[a[i], b[j]]:
            cells.append((a[i], b[j]))
            rows += n
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))
    return cells


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.col(f"`{vector_col}`").cast("array<double>").alias("v")).where(
        "id IS NOT NULL AND v IS NOT NULL")


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, codes: int = CODES, share: float = SHARE,
    least: int = 0, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` nearest rows that the walk found.

    A candidate is every row but those with the query's own id. Ties go to the smaller id. Rows with
    a null id, a vector that is null, zero, empty or holds null or non-finite parts, or one of
    another width than the first of the sample, take no part. Repeated rows with the same id count once. Empty tables
    give an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows, asked = _vectors(vectors, id_col, vector_col), _vectors(queries, id_col, vector_col)
    taken = rows.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    widths = [len(r.v) for r in taken if _valid([r.v])[1]]
    schema = "query_id long, rank int, vec_id long, score double"
    if not widths:
        return spark.createDataFrame([], schema)
    width = max(set(widths), key=lambda w: (widths.count(w), w))
    fitted, _ = _valid([r.v for r in taken], width)
    half = width // 2 or width
    unit = _unit(fitted)
    books = [fit_codes(unit[:, :half], codes), fit_codes(unit[:, half:], codes)]

    def cells(batches):
        for batch in batches:
            found, at = _valid(batch["v"].tolist(), width)
            if len(at):
                u = _unit(found)
                yield pd.DataFrame({
                    "id": batch["id"].to_numpy()[at], "v": [r.tobytes() for r in found],
                    "a": _distances(u[:, :half], books[0]).argmin(1).astype("int32"),
                    "b": _distances(u[:, half:], books[1]).argmin(1).astype("int32")})

    same = Window.partitionBy("a", "b", "v").orderBy("id")
    entries = (rows.mapInPandas(cells, "id long, v binary, a int, b int").distinct()
               .withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1))
    entries = _stored(entries, "index")
    # At most codes x codes rows.
    counted = entries.where("n = 1").groupBy("a", "b").count().collect()
    sizes = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in counted:
        sizes[r["a"], r["b"]] = r["count"]
    enough = max(least, k + 1, math.ceil(share * int(sizes.sum())))
    row_blocks = np.maximum(1, -(-sizes.sum(1) // ROW_BLOCK)).tolist()
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def walks(batches):
        for batch in batches:
            found, at = _valid(batch["v"].tolist(), width)
            if not len(at):
                continue
            u = _unit(found)
            first, second = _distances(u[:, :half], books[0]), _distances(u[:, half:], books[1])
            out = []
            for i, place in enumerate(at):
                by_first: dict[int, list[int]] = {}
                for a, b in walk(first[i], second[i], sizes, enough):
                    by_first.setdefault(a, []).append(b)
                query = int(batch["id"].iat[place])
                for a, bs in by_first.items():
                    for block in range(row_blocks[a]):
                        out.append((query, found[i].tobytes(), a, block, query % query_blocks, bs))
                if len(out) > 5_000:
                    yield pd.DataFrame(out, columns=["query_id", "q", "a", "block", "part", "bs"])
                    out = []
            yield pd.DataFrame(out, columns=["query_id", "q", "a", "block", "part", "bs"])

    wanted = asked.mapInPandas(
        walks, "query_id long, q binary, a int, block int, part int, bs array<int>")
    blocks = F.element_at(F.array(*[F.lit(n) for n in row_blocks]), F.col("a") + 1)
    placed = entries.withColumn("block", F.pmod(F.xxhash64("v"), blocks).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def nearest(key, entries, queries):
        out = [[], [], []]
        if not len(entries) or not len(queries):
            return pd.DataFrame({"query_id": out[0], "vec_id": out[1], "score": out[2]}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        e = np.stack([np.frombuffer(v) for v in entries["v"]])
        unit, ids, b = _unit(e), entries["id"].to_numpy(), entries["b"].to_numpy()
        for query, q, bs in zip(queries["query_id"], queries["q"], queries["bs"], strict=True):
            q = np.frombuffer(q)
            read = np.zeros(len(books[1]), bool)
            read[np.asarray(bs)] = True
            at = np.flatnonzero(read[b] & (ids != query))
            if not len(at):
                continue
            near = unit[at] @ _unit(q[None])[0]
            if len(at) > k:
                # All that may be among the best after exact scoring.
                at = at[near >= np.partition(near, -k)[-k] - 1e-9]
            scored = sorted((-cosine(q, e[i]), ids[i]) for i in at)[:k]
            for score, i in scored:
                out[0].append(query)
                out[1].append(i)
                out[2].append(-score)
        return pd.DataFrame({"query_id": np.asarray(out[0], "int64"), "vec_id": np.asarray(out[1], "int64"),
                             "score": np.asarray(out[2], "float64")})

    found = (placed.groupBy("a", "block", "part")
             .cogroup(wanted.groupBy("a", "block", "part"))
             .applyInPandas(nearest, "query_id long, vec_id long, score double")).distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """In double precision; scaled first where squares would overflow or vanish."""
    with np.errstate(over="ignore", under="ignore"):
        below = math.sqrt(float(a @ a)) * math.sqrt(float(b @ b))
    if not 1e-140 < below < 1e140:
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        below = math.sqrt(float(a @ a)) * math.sqrt(float(b @ b))
    return float(a @ b) / below


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back, so that later steps do not repeat the work."""
    from docledger.session import fresh_dir

    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
