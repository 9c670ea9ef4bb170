"""The stages against plain versions of their rules, on the smallest given table and planted rows."""

from collections import Counter, defaultdict

import corpus_pipeline
import llm_helpers as given
import pytest
from test_jaccard import brute

from docledger.llm.pii import Feistel, pseudonymise
from docledger.llm.queries import PII_KEY
from docledger.llm.quality import quality
from docledger.llm.text import table
from docledger.llm.toxicity import score, train


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, the documents first."""
    docs = table(spark, given.SMALL, "documents")
    extra = spark.createDataFrame([(90_000, None, "en", "s", None), (90_001, "", None, None, 0)], given.SCHEMA)
    out = [docs.unionByName(extra)]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], given.SMALL), "stage"))
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_toxic_documents_go(spark, stages):
    verdicts = score(stages[0], train(stages[0], table(spark, given.SMALL, "labels")))
    assert set(rows(stages[1])) == {r.doc_id for r in verdicts.collect() if not r.toxic}


def test_low_quality_goes(stages):
    kept = {r.doc_id for r in quality(stages[1]).collect() if r.kept}
    assert set(rows(stages[2])) == kept and 90_000 not in kept


def test_one_of_each_group_stays(stages):
    before = rows(stages[2])
    found = brute(list(before.items()))
    assert set(rows(stages[3])) == {i for i, (_, component) in found.items() if component == i}


def test_texts_are_pseudonymised(stages):
    before, after = rows(stages[3]), rows(stages[4])
    feistel = Feistel(PII_KEY)
    assert after == {i: pseudonymise(t, feistel)[0] for i, t in before.items()}
    assert all(r.n_chars == len(r.text) for r in stages[4].collect())


def test_all_that_is_left_is_packed(stages):
    texts, sizes = rows(stages[4]), defaultdict(int)
    for r in stages[5].collect():
        sizes[r.doc_id] += r.n_tokens
    assert set(sizes) == set(texts)


def test_columns_stay(stages):
    for out in stages[1:5]:
        assert out.columns == stages[0].columns
    assert Counter(r.doc_id for r in stages[4].collect()).most_common(1)[0][1] == 1


def test_run(spark, stages):
    packed = corpus_pipeline.run(spark, given.SMALL)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in stages[5].collect()}
    assert packed.columns == stages[5].columns
