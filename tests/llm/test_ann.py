import random

import numpy as np
import pytest

from docledger.llm import ann
from docledger.llm.ann import cosine, search, walk

SCHEMA = "vec_id bigint, embedding array<float>, label int, id int, v int, a int, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3, 4) for i, v in rows], SCHEMA).repartition(3)


def nearest(rows, query, k):
    q = np.asarray(dict(rows)[query], np.float32).astype(float)
    scored = {}
    for i, v in rows:
        if i == query or v is None or i is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        scored[i] = -cosine(q, np.asarray(v, np.float32).astype(float))
    return sorted((round(s, 12), i) for i, s in scored.items())[:k]


def vectors(seed, n, width=8, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=width).astype(np.float32).tolist()) for i in range(n)]
    for c in range(copies):
        rows.append((n + c, list(rows[7][1])))
    return rows


@pytest.mark.parametrize("block", [4096, 16])
def test_all_cells_give_the_exact_result(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "ROW_BLOCK", block)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3 if block == 16 else 8192)
    rows = vectors(1, 150, copies=40)
    table = frame(spark, rows)
    got = search(table, table.where("vec_id % 10 = 0 OR vec_id = 7"), codes=4, least=10_000).collect()
    for query in {r.query_id for r in got}:
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == query)
        wanted = nearest(rows, query, 5)
        assert [r[0] for r in mine] == [1, 2, 3, 4, 5]
        assert [(round(-s, 12), i) for _, i, s in mine] == wanted
    assert len(got) == 5 * len({r[0] for r in rows if r[0] % 10 == 0 or r[0] == 7})


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (8, [1.0, 1.0]), (9, []), (10, [1e-30, 0.0]), (None, [1.0, 0.0]), (12, [3e38, 3e38])]
    table = spark.createDataFrame([(i, v, 0, 1, 2, 3, 4) for i, v in [*rows, (13, [1.0, None]), (1, [1.0, 0.0]),
                                                                      (14, [1.0, 2.0, 3.0])]], SCHEMA)
    got = search(table, table, codes=2, least=100).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in got} == {1, 2, 8, 10, 12}
    mine = [(r.vec_id, round(r.score, 9)) for r in got if r.query_id == 1]
    assert mine[:2] == [(2, 1.0), (10, 1.0)] and sorted(mine[2:]) == [(8, 0.707106781), (12, 0.707106781)]
    empty = table.limit(0)
    assert search(empty, empty).count() == 0 and search(table, empty).count() == 0
    alone = table.where("vec_id = 8")
    assert search(alone, alone).count() == 0


def test_walk_goes_by_summed_distance():
    rng = random.Random(3)
    first = np.array([rng.random() for _ in range(6)])
    second = np.array([rng.random() for _ in range(5)])
    sizes = np.array([[rng.randint(0, 3) for _ in range(5)] for _ in range(6)])
    cells = walk(first, second, sizes, int(sizes.sum()))
    assert len(cells) == (sizes > 0).sum() == len(set(cells))
    sums = [first[a] + second[b] for a, b in cells]
    assert sums == sorted(sums)
    few = walk(first, second, sizes, 7)
    assert few == cells[:len(few)] and sum(sizes[c] for c in few) >= 7 > sum(sizes[c] for c in few[:-1])


def test_recall(spark):
    """On given vectors, which have hardly any structure, with only the share of rows that is read."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    got = search(table, table.where("vec_id % 50 = 0"), least=0).collect()
    hit = total = 0
    data = np.array([v for _, v in rows])
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    for query in {r.query_id for r in got}:
        near = unit @ unit[np.flatnonzero(ids == query)[0]]
        near[ids == query] = -2
        best = set(ids[np.lexsort((ids, -near))[:5]].tolist())
        hit += len(best & {r.vec_id for r in got if r.query_id == query})
        total += 5
    assert hit >= 0.9 * total
