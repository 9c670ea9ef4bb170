import math
import zlib
from collections import Counter
from functools import partial

import llm_helpers as given
import numpy as np
import pytest

from docledger.llm import lm
from docledger.llm.graph import stored

ODD = [(90_001, None), (90_002, ""), (None, "the of and"), (90_003, "zzz unseen words \x00"), (3, "the the"),
       (90_004, "the " * 5000)]


def plain(rows):
    """Base score, known words and all words of each text, and the number of training words."""
    texts = [(i, [*given.words(t), None]) for i, t in rows]
    counts = Counter()
    for i, w in texts:
        if not lm.held_out(i):
            counts.update(w)
    total, below = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    return [(i, lm.held_out(i), len(w), sum(counts[x] > 0 for x in w), total,
             sum(math.log10((counts[x] + 0.1) / below) for x in w)) for i, w in texts]


def test_held_out():
    assert [lm.held_out(i) for i in range(30)] == [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(30)]
    assert lm.held_out(None)


@pytest.mark.parametrize("head", [lm.HEAD, 50])
def test_base_against_counting(spark, monkeypatch, head):
    """Also where most words are joined instead of known to all tasks."""
    monkeypatch.setattr(lm, "HEAD", head)
    rows = given.small() + ODD
    got = lm.lm_scores(given.clashing(given.documents(spark, rows)), stride=1).collect()
    key = lambda r: (str(r[0]), r[2])
    wanted = sorted(plain(rows), key=key)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got),
                 key=key)
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    for g, w in zip(got, wanted, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] < 0 and math.isfinite(g[6])


@pytest.mark.parametrize("sizes", [[1], [1, 1, 2], [3, 1, 2, 4, 1, 9, 200, 2], [2] * 50, [7]])
def test_run_sums(sizes):
    """To the last bit those of ``np.add.reduceat``, whatever the lengths of the runs."""
    rng = np.random.default_rng(len(sizes))
    rows = rng.permutation(np.repeat(np.arange(len(sizes)), sizes))
    values = rng.normal(size=(len(rows), 5)).astype(np.float32)
    order, starts, of = lm._runs(rows)
    assert of.tolist() == list(range(len(sizes)))
    assert np.array_equal(lm._run_sums(values, order, starts), np.add.reduceat(values[order], starts, axis=0))


@pytest.mark.parametrize("scale", [0.1, 20.0])
def test_step_against_plain(scale):
    """One step with all slopes added up row by row, also where scores are so large that they are cut off."""
    rng = np.random.default_rng(5)
    n, outputs = 40, 30
    noise = rng.random(outputs)
    noise /= noise.sum()
    shapes = (lm.CONTEXT_WORDS + lm.CONTEXT_CLASSES + 1, lm.WIDTH), (lm.BEFORE, lm.WIDTH), (outputs, lm.WIDTH), (outputs,)
    model = lm.Model(*[rng.normal(0, scale, size).astype(np.float32) for size in shapes])
    before, wanted = rng.integers(0, 12, (n, lm.BEFORE)), rng.integers(0, outputs, n)
    trainer = lm.Trainer(model, noise, 3)
    picked = np.minimum(np.searchsorted(np.cumsum(noise), np.random.default_rng(3).random(lm.NOISE)), outputs - 1)
    trainer.batch(before, wanted)
    contexts, places, out, bias = (part.astype(float) for part in model.parts())
    slopes = [np.zeros(size) for size in shapes]
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for i in range(n):
        q = (contexts[before[i]] * places).sum(0)
        dq = np.zeros(lm.WIDTH)
        for o, true in [(wanted[i], 1), *((o, 0) for o in picked)]:
            off = sigmoid(q @ out[o] + bias[o] - np.log(lm.NOISE * noise[o])) - true
            dq += off * out[o]
            slopes[2][o] += off * q / n
            slopes[3][o] += off / n
        for j in range(lm.BEFORE):
            slopes[0][before[i, j]] += dq * places[j] / n
            slopes[1][j] += dq * contexts[before[i, j]] / n
    for got, old, slope in zip(trainer.model.parts(), model.parts(), slopes, strict=True):
        assert np.allclose(got, old - lm.RATE * slope / np.sqrt(1e-6 + slope * slope), atol=2e-3)


def test_counts_of_words(spark):
    """Each word once for its task, with its last two bytes, however often it occurs."""
    rows = [(1, "the a \u00e9x the"), (2, "A"), (4, None), (5, "of " * 70_000)]
    assert not any(lm.held_out(i) for i, _ in rows)
    got = {(r.h, r.tail): r.n for r in lm.word_counts(given.documents(spark, rows, 1)).collect()}
    wanted = {}
    for word, n in {"the": 2, "a": 2, "\u00e9x": 1, "of": 70_000}.items():
        h, _ = lm.word_hashes([word.encode()], tails=True)
        wanted[tuple(h.view(np.int64)[0].tolist())] = n
    wanted[int(lm.END.view(np.int64)), 0] = len(rows)
    assert got == wanted


def test_model_beats_frequencies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm.lm_scores(docs).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)


def test_probabilities_add_up(spark):
    """Over all known words and one unknown word of each class, whatever comes before."""
    rows = given.small()
    counts = stored(lm.word_counts(given.documents(spark, rows)), "counts")
    words = lm.known_words(counts)
    trainer = lm.Trainer(lm.new_model(words), words.noise, 1)
    before, output, *_ = lm.positions(words, [t.encode() for _, t in rows[:50]])
    trainer.learn(before, output)
    model = trainer.model
    n_out = len(words.noise)
    context = before[[0, 40, 700]]
    for row in context:
        logs = lm.log_probabilities(model, np.repeat(row[None], n_out, 0), np.arange(n_out))
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)
    # Inside each class: smoothed counts of its words and of one unknown word.
    table = counts.collect()
    inside = np.zeros(n_out)
    _, out, _, _ = words.look_up(np.array([r.h for r in table], np.int64).view(np.uint64),
                                 np.array([r.tail for r in table]))
    for r, o in zip(table, out, strict=True):
        inside[o] += 1 if words.log_class[o] == 0 else (r.n + 0.1) / math.exp(words.log_class[o])
    classes = words.log_class != 0
    inside[classes] += 0.1 / np.exp(words.log_class[classes])
    used = classes | (inside > 0)
    assert inside[used] == pytest.approx(1)


def test_batches_agree(spark):
    words = lm.known_words(stored(lm.word_counts(given.documents(spark, given.small())), "counts"))
    model = lm.new_model(words)
    before, output, *_ = lm.positions(words, [t.encode() for _, t in given.small(20)])
    assert lm.log_probabilities(model, before, output, 7) == pytest.approx(
        lm.log_probabilities(model, before, output, 4096), abs=1e-4)


def test_empty_table(spark):
    assert lm.lm_scores(given.documents(spark, [(1, "a")]).limit(0)).count() == 0
    assert [r.n_known for r in lm.lm_scores(given.documents(spark, [(None, "a")])).collect()] == [0]


def test_all_training_texts_are_learned(spark, monkeypatch):
    """Words of the later groups of a partition reach the model too, though the start sample lacks them."""
    monkeypatch.setattr(lm, "start_model", partial(lm.start_model, texts=1))
    rows = [(i, "one two three four " * 5) for i in range(256)] + [(i, "red green blue " * 5) for i in range(256, 400)]
    docs = given.documents(spark, rows, 1).coalesce(1).sortWithinPartitions("doc_id").localCheckpoint()
    words = lm.known_words(lm.word_counts(docs).localCheckpoint())
    start, _ = lm.start_model(docs, words)
    learned = lm.fit(docs, words)
    at = {w: int(words.look_up(*(x.astype(t) for x, t in zip(lm.word_hashes([w.encode()], tails=True)[0].T,
                                                              (np.uint64, np.int64), strict=True)))[1][0])
          for w in ("one", "red", "green")}
    gain = {w: float(np.abs(learned.outputs[i] - start.outputs[i]).max()) for w, i in at.items()}
    assert gain["red"] > 0.3 * gain["one"] and gain["green"] > 0.3 * gain["one"]


def test_a_step_against_loops():
    """Rows that occur several times in a batch get the sum of their slopes, each parameter its own rate."""
    rng = np.random.default_rng(5)
    outputs, rows = 7, lm.CONTEXT_WORDS + lm.CONTEXT_CLASSES + 1
    shares = rng.random(outputs)
    shares /= shares.sum()
    model = lm.Model(rng.normal(0, 0.1, (rows, lm.WIDTH)).astype(np.float32), np.ones((lm.BEFORE, lm.WIDTH), np.float32),
                     rng.normal(0, 0.1, (outputs, lm.WIDTH)).astype(np.float32), np.log(shares).astype(np.float32))
    before, wanted = rng.integers(0, 5, (40, lm.BEFORE)) * 1_280, rng.integers(0, outputs, 40)
    trainer = lm.Trainer(model, shares, 3)
    noise = np.searchsorted(np.cumsum(shares), np.random.default_rng(3).random(lm.NOISE))
    slopes = [np.zeros(p.shape) for p in model.parts()]
    shift = np.log(lm.NOISE * shares)
    for ids, w in zip(before, wanted, strict=True):
        q = sum(model.contexts[i].astype(float) * p for i, p in zip(ids, model.places, strict=True))
        dq = np.zeros(lm.WIDTH)
        for o, true in [(w, 1), *((o, 0) for o in noise)]:
            g = 1 / (1 + math.exp(-(q @ model.outputs[o] + model.bias[o] - shift[o]))) - true
            dq += g * model.outputs[o]
            slopes[2][o] += g * q / 40
            slopes[3][o] += g / 40
        for j, i in enumerate(ids):
            slopes[0][i] += dq * model.places[j] / 40
            slopes[1][j] += dq * model.contexts[i] / 40
    trainer.batch(before, wanted)
    for got, old, slope in zip(trainer.model.parts(), model.parts(), slopes, strict=True):
        assert got == pytest.approx(old - lm.RATE * slope / np.sqrt(1e-6 + slope ** 2), abs=2e-3)


def test_counts_leave_the_tasks_as_batches(spark, monkeypatch):
    """Not as a Python row for each word."""
    docs, taken = given.documents(spark, given.small()), []

    def seen(docs, schema, each, **names):
        taken.extend(each(iter([(1, b"a b a"), (2, b"")])))
        return spark.createDataFrame([], schema)
    monkeypatch.setattr(lm, "map_documents", seen)
    lm.word_counts(docs)
    assert [b.column("n").to_pylist() for b in taken] and sum(sum(b.column("n").to_pylist()) for b in taken) == sum(
        n + 1 for i, n in ((1, 3), (2, 0)) if not lm.held_out(i))
