import random
from collections import Counter

import llm_helpers as given
import numpy as np
from pyspark import SparkContext

from docledger.llm.toxicity import CATEGORIES, Known, drop_toxic, features, fit_chain, score, train


def corpus(seed=1, n=600):
    """Texts of made-up words; toxic ones hold insults, or words of one of two stems."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("aeioustnrl", k=rng.randint(3, 9)))
    rows, labels = [], []
    for i in range(n):
        text = [word() for _ in range(60)]
        if toxic := rng.random() < 0.2:
            kind = rng.randrange(3)
            for _ in range(rng.randint(2, 6)):
                bad = rng.choice(["zork", "blug"]) if kind == 0 else ("krampf" if kind == 1 else "wuzzel") + word()[:3]
                text[rng.randrange(60)] = bad
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_features_are_words_and_stems():
    assert features("Abcd, ÉTÉ x1y") == {"abcd$", "abc", "été$", "x$", "y$"}
    text = "Loremipsum dolor, dolores LOREM"
    names = sorted(features(text))
    assert Known(names)(text) == list(range(len(names)))
    assert Known(names)("other words") == []


def test_held_out_rows(spark):
    rows, labels = corpus()
    docs = given.clashing(given.documents(spark, rows))
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    chain = train(docs, table.where("doc_id < 400"))
    got = given.by_id(score(docs, chain))
    truth = {i: bool(t) for i, _, t in labels}
    held = [i for i in truth if i >= 400]
    assert sum(got[i].toxic == truth[i] for i in held) >= 0.98 * len(held)
    assert not any(got[i].toxic for i in held if not truth[i])
    # The kinds of toxic texts are told apart.
    stems = [i for i in truth if "krampf" in rows[i][1] or "wuzzel" in rows[i][1]]
    words = [i for i in truth if "zork" in rows[i][1] or "blug" in rows[i][1]]
    assert np.mean([got[i].p_stem for i in stems]) > 0.7 > 0.3 > np.mean([got[i].p_stem for i in words])
    assert np.mean([got[i].p_word for i in words]) > 0.7 > 0.3 > np.mean([got[i].p_word for i in stems])
    kept = drop_toxic(docs, chain)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {i for i in truth if not got[i].toxic}


def test_given_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    chain = train(docs, labels.where("doc_id % 3 != 0"))
    rows = score(docs, chain).join(labels.select("doc_id", labels["toxic"].alias("truth")), "doc_id").where(
        "doc_id % 3 = 0").collect()
    seen = Counter((r.truth, r.toxic) for r in rows)
    # About 6 of 100 toxic labels lie on texts without a toxic word.
    assert seen[1, True] >= 0.87 * (seen[1, True] + seen[1, False])
    assert seen[0, True] <= 0.002 * (seen[0, True] + seen[0, False])


def test_links_see_the_links_before():
    rng = np.random.default_rng(1)
    first = rng.random(800) < 0.5
    # The second answer is the first's, which one feature tells; the last feature is noise.
    found = [[0] * int(a) + [1] * int(rng.random() < 0.5) for a in first]
    wanted = np.column_stack([first, first]).astype(float)
    chain = fit_chain(["a$", "b$"], found, wanted, np.arange(800) % 5)
    assert len(chain.links[1].before) == 1 and chain.links[1].before[0] > 0
    p = chain.predict([[0], [1], []])
    assert (p[0] > 0.9).all() and (p[1:] < 0.1).all()


def test_odd_rows(spark):
    rows, labels = corpus(2, 200)
    odd = [(None, "zork blug zork"), (900, None), (901, ""), (0, rows[0][1]), (902, "a " * 30_000)]
    docs = given.documents(spark, rows + odd)
    table = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None), (3, 0, labels[3][2]), (903, 1, 1)],
                                  "doc_id bigint, quality int, toxic int")
    got = score(docs, train(docs, table)).collect()
    assert len(got) == len(rows) + len(odd)
    assert [r.toxic for r in got if r.doc_id is None] == [True]
    assert not any(r.toxic for r in got if r.doc_id in (900, 901, 902))
    assert train(docs, table.limit(0)).names == []
    nothing = score(docs, train(docs, table.limit(0)))
    assert nothing.where("toxic").count() == 0 and [f"p_{c}" in nothing.columns for c in CATEGORIES] == [True] * 4
    assert score(docs.limit(0), train(docs.limit(0), table)).count() == 0


def test_documents_that_repeat_a_labelled_id_count_once(spark):
    """As many rows as you like under one id teach the chain no more than one of them."""
    rows, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    toxic = next(i for i, _, label in labels if label)
    text = dict(rows)[toxic]
    once = train(given.documents(spark, rows), marks)
    often = train(given.documents(spark, rows + [(toxic, text)] * 500), marks)
    assert once.names == often.names
    assert all((a.weights == b.weights).all() and a.bias == b.bias for a, b in zip(once.links, often.links, strict=True))


def test_training_sends_no_rows_through_python_workers_of_another_kind(spark, monkeypatch):
    rows, labels = corpus()
    sent, plain = [], SparkContext.parallelize

    def parallelize(self, rows, *args):
        sent.extend(rows := list(rows))
        return plain(self, rows, *args)

    docs, marks = given.documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    monkeypatch.setattr(SparkContext, "parallelize", parallelize)
    chain = train(docs, marks)
    assert any(not name.endswith("$") for name in chain.names) and sent == []


def test_no_stems_at_all(spark):
    """Words of three letters have no beginnings of their own."""
    rows = [(i, f"aaa bbb {'zok' if i % 5 == 0 else 'ccc'}") for i in range(200)]
    labels = [(i, 1, int(i % 5 == 0)) for i in range(200)]
    docs = given.documents(spark, rows)
    chain = train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert chain.names == ["zok$"]
    assert {r.doc_id for r in score(docs, chain).where("toxic").collect()} == set(range(0, 200, 5))


def test_long_words_are_whole():
    long = "a" * 100
    assert long + "$" in features(long) and Known([long + "$"])(f"x {long} y") == [0]
    assert Known([long + "$"])("a" * 64) == Known([long + "$"])("a" * 101) == []
