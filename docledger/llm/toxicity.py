"""Toxicity by a chain of linear classifiers.

The given label says only whether a text is toxic, so three categories are derived from it on the
labelled rows: ``word`` (toxic, with a word that is typical of toxic texts by itself), ``stem``
(toxic, with a stem that typical words share) and ``severe`` (toxic, with several of them). The chain
predicts them in this order and the given label last; every link sees the words of the text and the
probabilities of the links before it. Links are fitted on out-of-fold probabilities, so a link never
learns from predictions that have seen their own answer.

Features are whole words and the first 3 to 8 letters of words, lower-case, present or not. Kept are
those that toxic texts hold more often, by more than chance explains, the clearest first; so a text
without any of them, an empty one too, is never toxic.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.graph import stored
from docledger.llm.text import keep_rows, map_documents

CATEGORIES = ("word", "stem", "severe", "toxic")
#: Labelled rows, those with the smallest hash of their id, that the chain is fitted on.
EXAMPLES = 20_000
#: Features kept.
FEATURES = 4_096
#: Least chi-squared of presence against label.
CHANCE = 30.0
#: Least ratio of the share of toxic texts that hold a feature to that of clean ones.
RATIO = 3
FOLDS = 5
#: A feature is typical of toxic texts from this ratio of the two shares on.
TYPICAL = 20.0
#: Words of toxic texts that make a typical beginning of words a stem.
FAMILY = 3
#: Typical words and stems from which a text is severe.
SEVERE = 4
THRESHOLD = 0.4
LETTERS = re.compile(r"[^\W\d_]+")
STEMS = range(3, 9)


def features(text: str) -> set[str]:
    """Whole words, marked by a final ``$``, and stems."""
    out = set()
    for word in set(LETTERS.findall(text.lower())):
        out.add(word + "$")
        out.update(word[:n] for n in STEMS if n < len(word))
    return out


class Known:
    """Finds known features in a text; most words end after one look-up."""

    def __init__(self, names: list[str]):
        self.at = {name: i for i, name in enumerate(names)}
        self.heads = {name.rstrip("$")[:3] for name in names}
        self.lengths = sorted({len(n) for n in names if not n.endswith("$")})

    def __call__(self, text: str) -> list[int]:
        found, at, heads = set(), self.at, self.heads
        for word in set(LETTERS.findall(text.lower())):
            if word[:3] not in heads:
                continue
            if (i := at.get(word + "$")) is not None:
                found.add(i)
            for n in self.lengths:
                if n >= len(word):
                    break
                if (i := at.get(word[:n])) is not None:
                    found.add(i)
        return sorted(found)


@dataclass
class Link:
    weights: np.ndarray
    before: np.ndarray
    bias: float


@dataclass
class Chain:
    names: list[str]
    links: list[Link]

    def predict(self, found: list[list[int]]) -> np.ndarray:
        """Probabilities, a row for each text and a column for each category."""
        flat, starts = _flat(found)
        out = np.zeros((len(found), len(self.links)))
        for c, link in enumerate(self.links):
            out[:, c] = _sigmoid(_sums(link.weights[flat], starts) + _logit(out[:, :c]) @ link.before
                                 + link.bias)
        return out


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=starts[1:])
    return np.array([i for r in rows for i in r], np.int64), starts


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4


def _fit(found: list[list[int]], before: np.ndarray, wanted: np.ndarray, size: int,
         turns: int = 300, rate: float = 0.5, decay: float = 3e-5) -> Link:
    """Logistic regression by full steps with per-weight rates (Adagrad).

    Rows of the rarer answer weigh more, by the root of the ratio of the two.
    """
    flat, starts = _flat(found)
    owner = np.repeat(np.arange(len(found)), np.diff(starts))
    share = np.clip(wanted.mean(), 1e-4, 1 - 1e-4)
    weight = np.where(wanted > 0, math.sqrt((1 - share) / share), 1.0)
    weight /= weight.sum()
    w, b, bias = np.zeros(size), np.zeros(before.shape[1]), math.log(share / (1 - share))
    gw, gb, g0 = np.full(size, 1e-8), np.full(len(b), 1e-8), 1e-8
    for _ in range(turns):
        error = (_sigmoid(_sums(w[flat], starts) + before @ b + bias) - wanted) * weight
        dw = np.bincount(flat, error[owner], size) + decay * w
        db, d0 = before.T @ error + decay * b, error.sum()
        gw, gb, g0 = gw + dw ** 2, gb + db ** 2, g0 + d0 ** 2
        w -= rate * dw / np.sqrt(gw)
        b -= rate * db / np.sqrt(gb)
        bias -= rate * d0 / math.sqrt(g0)
    return Link(w, b, bias)


def fit_chain(names: list[str], found: list[list[int]], wanted: np.ndarray, folds: np.ndarray) -> Chain:
    """``wanted``: a column for each category; ``folds``: a fold number for each row."""
    links, before = [], np.zeros((len(found), 0))
    for c in range(wanted.shape[1]):
        links.append(_fit(found, _logit(before), wanted[:, c], len(names)))
        held = np.zeros(len(found))
        for fold in range(FOLDS):
            out, rest = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
            if not len(out):
                continue
            if not len(rest):
                rest = out
            link = _fit([found[i] for i in rest], _logit(before[rest]), wanted[rest, c], len(names))
            flat, starts = _flat([found[i] for i in out])
            held[out] = _sigmoid(_sums(link.weights[flat], starts) + _logit(before[out]) @ link.before
                                 + link.bias)
        before = np.column_stack([before, held])
    return Chain(names, links)


def categories(names: list[str], ratios: list[float], under: dict[str, int], found: list[list[int]],
               toxic: np.ndarray) -> np.ndarray:
    """The derived categories and the label itself, a column each.

    ``under`` has the number of words of toxic texts that begin with a stem.
    """
    typical = {i for i, ratio in enumerate(ratios) if ratio >= TYPICAL}
    stems = {i for i in typical if under.get(names[i], 0) >= FAMILY}
    heads = {names[i] for i in stems}
    alone = {i for i in typical if names[i].endswith("$")
             and not any(names[i][:n] in heads for n in STEMS)}
    whole = {i for i in typical if names[i].endswith("$")}
    out = np.zeros((len(found), len(CATEGORIES)))
    for row, has in enumerate(found):
        out[row] = (any(i in alone for i in has), any(i in stems for i in has),
                    sum(i in whole or i in stems for i in has) >= SEVERE, 1)
    return out * toxic[:, None]


def train(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, most: int = FEATURES,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Chain:
    """The chain, fitted on at most ``examples`` labelled rows.

    Rows without an id or label do not count; a repeated id counts once, toxic if any label says so, and so do
    documents that repeat an id: of their texts the one with the smallest hash is learned from.
    Only counts of features and the chosen features of the examples reach the driver. Without
    labelled rows the chain finds nothing toxic.
    """
    spark = docs.sparkSession
    chosen = stored(
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.when(F.max(label_col) > 0, 1).otherwise(0).alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(examples), "labelled")
    # The examples are bounded, so this broadcast is; of the documents with one id a single text counts.
    texts = stored(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"))
                   .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
                   .groupBy("label_id", "label").agg(F.min_by("body", F.struct(F.xxhash64("body"), "body")).alias("body"))
                   .select("label_id", F.concat(F.col("label").cast("string"), "body").alias("text"))
                   .repartition(12), "examples")
    names = {"id_col": "label_id", "text_col": "text"}

    def count(wanted: bool, only: set[str] | None = None):
        """Texts of one label that hold a feature; all features, or those given."""
        def each(documents):
            seen = Counter()
            for _, raw in documents:
                text = raw.decode()
                if (text[0] != "0") == wanted:
                    seen.update(features(text[1:]) if only is None else features(text[1:]) & only)
                if len(seen) > 300_000:
                    yield from seen.items()
                    seen = Counter()
            yield from seen.items()

        found = map_documents(texts, "name string, n bigint", each, batch_rows=20_000, **names)
        return found.groupBy("name").agg(F.sum("n").alias("n"))

    totals = texts.groupBy(F.substring("text", 1, 1) != "0").count().collect()
    n = {bool(r[0]): r[1] for r in totals}
    clean_rows, toxic_rows = n.get(False, 0), n.get(True, 0)
    if not clean_rows or not toxic_rows:
        return Chain([], [Link(np.zeros(0), np.zeros(c), -30.0) for c in range(len(CATEGORIES))])
    in_toxic = stored(count(True), "toxic")
    total = clean_rows + toxic_rows
    # What even without a clean text would be chance is not looked for in clean ones.
    least = next((n for n in range(3, toxic_rows + 1) if CHANCE <= n * clean_rows * total / (
        toxic_rows * (total + 1 - n))), toxic_rows + 1)
    often = in_toxic.where(F.col("n") >= least)
    in_clean = count(False, {r["name"] for r in often.collect()})
    counted = often.withColumnRenamed("n", "toxic").join(in_clean, "name", "left").select(
        "name", "toxic", F.coalesce("n", F.lit(0)).alias("clean"))
    # Chi-squared of presence against label.
    counted = counted.where(f"toxic * {clean_rows}D > {RATIO} * clean * {toxic_rows}D").withColumn(
        "chi", F.expr(f"power(toxic * {clean_rows}D - clean * {toxic_rows}D, 2) * {total / clean_rows / toxic_rows}D"
                      f" / ((clean + toxic) * ({total + 1}D - clean - toxic))")).where(f"chi >= {CHANCE}")
    whole = in_toxic.where("endswith(name, '$')").select(F.expr("rtrim('$', name)").alias("word"))
    rows = counted.orderBy(F.desc("chi"), "name").limit(most).collect()
    kept = [r["name"] for r in rows]
    # An Arrow table needs no Python on the executors, rows would start workers of another kind there.
    beginnings = spark.createDataFrame(pa.table({"stem": pa.array([n for n in kept if not n.endswith("$")], pa.string())}))
    sizes = F.array(*[F.lit(n) for n in STEMS])
    under = {r["stem"]: r["count"] for r in whole.select(
        F.explode(F.filter(sizes, lambda n: n < F.length("word"))).alias("n"), "word").select(
        F.expr("substring(word, 1, n)").alias("stem")).join(F.broadcast(beginnings), "stem")
        .groupBy("stem").count().collect()}
    ratios = [(r.toxic / toxic_rows) / ((r.clean + 0.5) / clean_rows) if r.toxic >= 3 else 0.0
              for r in rows]
    known = Known(kept)

    def reduce(documents):
        for doc_id, raw in documents:
            text = raw.decode()
            yield doc_id, int(text[0] != "0"), zlib.crc32(str(doc_id).encode()) % FOLDS, known(text[1:])

    rows = map_documents(texts, "doc_id bigint, label int, fold int, found array<int>", reduce,
                         **names).collect()
    rows.sort(key=lambda r: (str(r.doc_id), r.found))
    found = [list(r.found) for r in rows]
    wanted = categories(kept, ratios, under, found, np.array([r.label for r in rows], float))
    return fit_chain(kept, found, wanted, np.array([r.fold for r in rows]))


def _judged(texts: list[str], chain: Chain, known: Known) -> np.ndarray:
    return chain.predict([known(text) for text in texts])


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id``, a probability for each category and ``toxic``, one row for each row of ``docs``.

    A null or empty text has no words, its probabilities are those of the bias; a null id stays
    null; repeated rows get the same result; other columns are not read. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def each(documents):
        model = shared.value
        known, group = Known(model.names), []

        def judged():
            p = model.predict([found for _, found in group])
            for (doc_id, _), row in zip(group, p.tolist(), strict=True):
                yield (doc_id, *row, row[-1] >= threshold)

        for doc_id, raw in documents:
            group.append((doc_id, known(raw.decode())))
            if len(group) == 1000:
                yield from judged()
                group = []
        yield from judged()

    kinds = ", ".join(f"p_{c} double" for c in CATEGORIES)
    return map_documents(docs, f"doc_id bigint, {kinds}, toxic boolean", each, id_col, text_col)


def drop_toxic(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD,
               text_col: str = "text") -> DataFrame:
    """The rows below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def verdicts(texts):
        model = shared.value
        p = _judged([raw.decode() for raw in texts], model, Known(model.names))
        return (p[:, -1] < threshold).tolist()

    return keep_rows(docs, verdicts, text_col)
