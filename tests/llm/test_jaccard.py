import random
from collections import Counter
from itertools import combinations

import duckdb
import llm_helpers as given
import numpy as np
import pytest

from docledger.llm import jaccard
from docledger.llm.graph import components
from docledger.llm.jaccard import jaccard_join, keep_one, least_overlap, overlaps, prefix_size
from docledger.llm.queries import ORACLES, QUERIES


def shingles(text, k=5):
    w = given.words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, min(len(w), 1))))


def linked(a, b, percent=80):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def brute(rows, percent=80):
    """Component and shingles of each id, by all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    part = {i: i for i, _ in sets}

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    for (i, a), (j, b) in combinations(sets, 2):
        if linked(a, b, percent) and top(i) != top(j):
            part[max(top(i), top(j))] = min(top(i), top(j))
    return {i: (len(s), top(i)) for i, s in sets}


def near_copies(seed=3, groups=12, size=9):
    """Groups of texts that drift away from each other, and a passage that many share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    shared = [word() for _ in range(60)]
    rows = []
    for g in range(groups):
        base = [word() for _ in range(rng.choice([6, 30, 120, 300]))]
        for _ in range(size):
            base = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                base[rng.randrange(len(base))] = word()
            text = base + shared * rng.randint(0, 1)
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [3, 4])
def test_groups_against_all_pairs(spark, seed):
    rows = near_copies(seed)
    members, links = jaccard_join(given.clashing(given.documents(spark, rows)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()}
    assert got == brute(rows)
    sets = {i: shingles(t) for i, t in rows}
    for r in links.collect():
        assert r.overlap == len(sets[r.a] & sets[r.b]) and linked(sets[r.a], sets[r.b])
    assert len({c for _, c in got.values()}) < len(rows)


def test_order_of_columns_does_not_matter(spark):
    rows = near_copies(5)
    for most in (1, 50):
        members, _ = jaccard_join(given.documents(spark, rows), frequent=most)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()} == brute(rows)


def test_other_similarity(spark):
    rows = near_copies(6)
    members, _ = jaccard_join(given.documents(spark, rows), percent=60)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()} == brute(rows, 60)


def test_hot_group_in_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 4)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 3)
    rows = near_copies(7, groups=2, size=40)
    members, _ = jaccard_join(given.documents(spark, rows))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()} == brute(rows)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(9, text), (4, text.upper()), (None, text), (5, None), (6, ""), (7, " \n"), (8, "a b"), (3, "a  B"),
            (8, "a b"), (2, "a b c"), (9, "other words " + text)]
    members, links = jaccard_join(given.documents(spark, rows))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in members.collect())
    assert got == Counter([(9, 36, 4), (4, 36, 4), (None, 36, None), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 3),
                           (3, 1, 3), (8, 1, 3), (2, 1, 2), (9, 38, 4)])
    members, links = jaccard_join(given.documents(spark, rows).limit(0))
    assert members.count() == links.count() == 0


def test_texts_of_one_id_are_linked_each_by_itself(spark):
    """An unrelated text of the same id, long and all its own, does not hide the near copy of the other."""
    text = [f"w{i}" for i in range(404)]
    near = " ".join(text[:200] + ["changed"] + text[201:])
    rows = [(7, " ".join(text)), (3, near), (7, " ".join(f"v{i}" for i in range(900)))]
    members, _ = jaccard_join(given.documents(spark, rows))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in members.collect()) == Counter(
        [(7, 400, 3), (3, 400, 3), (7, 896, 3)])


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(9, text), (4, text + " more"), (5, None), (6, ""), (8, "a b"), (8, "a b"), (3, "c"), (None, text)]
    docs = given.clashing(given.documents(spark, rows))
    kept = keep_one(docs)
    assert kept.schema.fieldNames() == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([4, 5, 6, 8, 3, None])


def test_overlaps_are_exact_or_dropped():
    rng = np.random.default_rng(1)
    for n in (1, 5, 200):
        row = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
        others = []
        for share in (0, 0.3, 0.7, 0.8, 0.9, 0.95, 1):
            more = rng.integers(0, 2**64 - 1, int((1 - share) * n) + 1, dtype=np.uint64)
            others.append(np.unique(np.concatenate([rng.permutation(row)[:int(share * n)], more])))
        found = overlaps(row, others, 80)
        for other, got in zip(others, found, strict=True):
            true = len(np.intersect1d(row, other))
            assert got == (true if true >= least_overlap(len(row), len(other), 80) else -1)


def test_bounds():
    for a in range(1, 40):
        assert prefix_size(a, 80) == a - min(i for i in range(a + 1) if 100 * i >= 80 * a) + 1
        for b in range(1, 40):
            need = least_overlap(a, b, 80)
            assert 100 * need >= 80 * (a + b - need) and 100 * (need - 1) < 80 * (a + b - need + 1)


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(1, 70)] + [(200, 100), (100, 300), (5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()))
    assert got == {**dict.fromkeys(range(1, 71), 1), 100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query_against_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{given.SMALL}/documents.parquet'")
    wanted = connection.execute(ORACLES["op2_jaccard_join"])
    columns = [c[0] for c in wanted.description]
    got = QUERIES["op2_jaccard_join"](spark, given.SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(wanted.fetchall())
