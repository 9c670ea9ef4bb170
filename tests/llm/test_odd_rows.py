"""Odd rows that the tests of the single operators leave out."""

import hashlib

import corpus_pipeline
import llm_helpers as given

from docledger.llm.jaccard import jaccard_join
from docledger.llm.secret_scan import EXAMPLES, find_secrets, learn

PROSE = " ".join(f"word{i % 97}x{i % 13}" for i in range(400)) + "."


def saved(spark, folder, docs, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_over_empty_tables(spark, tmp_path):
    sf_dir = saved(spark, tmp_path, given.documents(spark, [(1, "a")]).where("doc_id < 0"), [])
    assert corpus_pipeline.run(spark, sf_dir).collect() == []


def test_pipeline_over_odd_documents(spark, tmp_path):
    """Repeated ids and rows, nulls, columns that bear the operators' own names, and a text of a megabyte."""
    small = [(i, t) for i, t in given.small(120) if t]
    long = " ".join(t for _, t in given.small() if t)[:1_000_000]
    again = small[10]
    rows = [*small, again, again, (small[11][0], small[12][1] + " and more."), (None, PROSE), (None, None), (7_000, long),
            (7_001, ""), (7_002, None)]
    docs = given.clashing(given.documents(spark, rows))
    sf_dir = saved(spark, tmp_path, docs, [(i, 1, int(i % 9 == 0)) for i, _ in small])
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = out
        out = corpus_pipeline.stored(stage(spark, out, sf_dir), "stage")
        assert out.columns == docs.columns, name
        assert out.count() <= before.count()
    kept = [r.doc_id for r in out.collect()]
    assert {i for i in kept if i is not None} <= {i for i, _ in rows} and not {7_001, 7_002} & set(kept)
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(kept)


def test_secrets_of_repeated_rows(spark):
    rows = [(1, "password = abcdef123"), (1, "password = abcdef123"), (1, "token: zzzzzz9"), (None, "password = abcdef123")]
    docs = given.documents(spark, rows)
    found = find_secrets(docs, learn(docs, EXAMPLES))
    seen = sorted((r.doc_id or 0, r.n_assign, r.base_sha256) for r in found.collect())
    of = {text: hashlib.sha256(spans.encode()).hexdigest() for text, spans in (("password", "assign:0:20"), ("token", "assign:0:14"))}
    assert seen == sorted([(1, 1, of["password"]), (1, 1, of["password"]), (1, 1, of["token"]), (0, 1, of["password"])])


def test_long_texts_are_joined_whole(spark):
    """Texts of more than a block of bytes that differ in their last words only, and far apart."""
    body = " ".join(f"w{i}" for i in range(250_000))
    rows = [(1, body), (2, body + " the end"), (3, body.replace("w249999", "other")), (4, " ".join(f"v{i}" for i in range(250_000)))]
    members, _ = jaccard_join(given.documents(spark, rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()}
    assert got == {1: (249_996, 1), 2: (249_998, 1), 3: (249_996, 1), 4: (249_996, 4)}
