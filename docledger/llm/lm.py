"""Language-model scores by a log-bilinear model that is trained with noise-contrastive estimation.

The vectors of the four words before, each weighted by its distance, add up to a prediction; its
products with the vectors of all outputs give their scores. Outputs are the most frequent words, the
end of a text, and classes of all other words by their last two bytes. Training never normalises: it
tells the true output from noise drawn from the output frequencies. Scoring does: one matrix product
for a batch of positions, and a sum over all outputs. Within a class words have their smoothed
frequencies, so the probabilities of all words known to the training texts and of one unknown word
for each class add up to one.

Every text is read: counts of all training words are gathered by a shuffle, the most frequent words
are known to every task, and the counts of all others are joined to the texts that hold them. The
model is initialised by a bounded start sample and then learns every training text once, each task
those it reads; the parameters of all tasks are averaged by a shuffle.

Words are 64-bit hashes of lower-cased words; the end of a text is a word of its own.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.graph import stored
from docledger.llm.text import map_documents, word_hashes

END = np.uint64(0x454E444F46544558)
#: Words whose count all tasks hold (about 13 bytes each).
HEAD = 262_144
#: Words with a vector of their own as context, and as output.
CONTEXT_WORDS, OUTPUT_WORDS = 4_096, 320
#: Classes of the other words by their last two bytes.
CONTEXT_CLASSES, OUTPUT_CLASSES = 1_024, 64
BEFORE, WIDTH = 4, 24
_FEW_ROWS = max(CONTEXT_WORDS + CONTEXT_CLASSES + 1, OUTPUT_WORDS + OUTPUT_CLASSES + 1) <= 1 << 16
#: Training texts of the start sample, those with the smallest hash of their id.
START_TEXTS = 2_000
NOISE, BATCH, RATE = 64, 1_024, 0.15
#: Tasks learn from one in so many groups of their texts: all of them.
STRIDE = 1
_GROUP = 128
#: Parameters of a block in which tasks hand over what they have learned.
PARAMETERS = 8_192


def held_out(doc_id) -> bool:
    """One text in ten is not learned from; one without an id neither."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


@dataclass
class Words:
    """What all tasks know about words: the most frequent ones, and the classes of the others."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray
    context: np.ndarray  # row of the context vectors
    output: np.ndarray  # row of the outputs
    context_class: np.ndarray  # by last two bytes
    output_class: np.ndarray
    noise: np.ndarray  # share of each output
    log_class: np.ndarray  # natural log of the smoothed total of each output, 0 for single words
    total: int
    distinct: int

    def __post_init__(self) -> None:
        """Where the hashes with the same leading bits begin; they are spread evenly, so few share them."""
        self.shift = np.uint64(64 - max(1, len(self.hashes).bit_length()))
        edges = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.first = np.searchsorted(self.hashes, edges).astype(np.int32)
        sizes = np.diff(np.append(self.first, len(self.hashes)))
        self.most = int(sizes.max(initial=0))

    def places(self, h: np.ndarray) -> np.ndarray:
        """Where each hash stands, or would stand, among the sorted ones."""
        at = self.first[h >> self.shift]
        left = np.arange(len(h))
        for _ in range(self.most):
            # Only those whose place lies further on are looked at again.
            inside = at[left] < len(self.hashes)
            left = left[inside]
            left = left[self.hashes[at[left]] < h[left]]
            if not len(left):
                break
            at[left] += 1
        return at

    def look_up(self, h: np.ndarray, tail: np.ndarray):
        """Context row, output row, count, and whether the word is among the frequent ones."""
        if not len(self.hashes):
            known = np.zeros(len(h), bool)
            return self.context_class[tail], self.output_class[tail], np.zeros(len(h), np.int64), known
        at = np.minimum(self.places(h), len(self.hashes) - 1)
        known = self.hashes[at] == h
        return (np.where(known, self.context[at], self.context_class[tail]),
                np.where(known, self.output[at], self.output_class[tail]),
                np.where(known, self.counts[at], 0), known)


@dataclass
class Model:
    contexts: np.ndarray
    places: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.contexts, self.places, self.outputs, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def unflat(self, values: np.ndarray) -> "Model":
        out, at = [], 0
        for part in self.parts():
            out.append(values[at:at + part.size].reshape(part.shape).astype(np.float32))
            at += part.size
        return Model(*out)


def new_model(words: Words, seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    rows = CONTEXT_WORDS + CONTEXT_CLASSES + 1
    return Model(
        rng.normal(0, 0.1, (rows, WIDTH)).astype(np.float32),
        np.linspace(1.0, 0.5, BEFORE, dtype=np.float32)[:, None].repeat(WIDTH, 1),
        rng.normal(0, 0.1, (len(words.noise), WIDTH)).astype(np.float32),
        np.log(words.noise).astype(np.float32))


def _runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that brings equal rows together, where each begins in it, and the distinct rows."""
    # Numbers of 16 bits are sorted by their digits.
    order = np.argsort(rows.astype(np.uint16) if _FEW_ROWS else rows, kind="stable")
    rows = rows[order]
    starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    return order, starts, rows[starts]


def _run_sums(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows of each run: those of ``np.add.reduceat`` over ``values[order]``, in the same order.

    That takes its time for each run and column, and most runs have a row or two.
    """
    sizes = np.diff(starts, append=len(order))
    sums = values.take(order.take(starts), axis=0)
    for size in (2, 3):
        of = np.flatnonzero(sizes == size)
        at = starts.take(of)
        rest = values.take(order.take(at + 1), axis=0)
        if size == 3:
            rest += values.take(order.take(at + 2), axis=0)
        sums[of] += rest
    longer = sizes > 3
    of = np.flatnonzero(longer)
    if len(of):
        ends = np.cumsum(sizes.take(of))
        rows = values.take(order[np.repeat(longer, sizes)], axis=0)
        sums[of] = np.add.reduceat(rows, np.concatenate(([0], ends[:-1])), axis=0)
    return sums


def _added(parts: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The sum of the vectors that stand side by side in each row of ``parts``."""
    np.add(parts[:, :WIDTH], parts[:, WIDTH:2 * WIDTH], out=out)
    for j in range(2, BEFORE):
        out += parts[:, j * WIDTH:(j + 1) * WIDTH]
    return out


def _sigmoid(x: np.ndarray, steepest: float = math.inf) -> np.ndarray:
    """Of ``-x``, in place; beyond 30 nothing changes that counts. No ``x`` is larger than ``steepest``, or smaller than its opposite."""
    if not steepest < 30:
        np.clip(x, -30, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Trainer:
    """Noise-contrastive steps with a rate for each parameter (Adagrad)."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int, grown: list | None = None):
        self.model = Model(*[p.copy() for p in model.parts()])
        self.grown = [g.copy() for g in grown] if grown else [np.full(p.shape, 1e-6, np.float32) for p in model.parts()]
        self.rng, self.noise = np.random.default_rng(seed), np.cumsum(noise)
        self.shift = np.log(NOISE * noise).astype(np.float32)

    def _step(self, part: int, rows: np.ndarray, slope: np.ndarray) -> None:
        """Changes ``slope``."""
        value, grown = self.model.parts()[part], self.grown[part]
        now = grown.take(rows, axis=0)
        now += slope * slope
        grown[rows] = now
        slope *= RATE
        slope /= np.sqrt(now, out=now)
        now = value.take(rows, axis=0)
        now -= slope
        value[rows] = now

    def batch(self, before: np.ndarray, wanted: np.ndarray) -> None:
        """``before``: context rows, nearest first; ``wanted``: the true outputs."""
        m, n = self.model, len(wanted)
        noise = np.minimum(np.searchsorted(self.noise, self.rng.random(NOISE)), len(self.noise) - 1)
        vectors = m.contexts.take(before.ravel(), axis=0).reshape(n, BEFORE * WIDTH)
        weight = m.places.ravel()
        # The last coordinate of 1 takes the bias.
        ones = np.ones((n, WIDTH + 1), np.float32)
        q = _added(vectors * weight, ones[:, :WIDTH])
        of_true, of_noise = m.outputs.take(wanted, axis=0), m.outputs.take(noise, axis=0)
        ahead = m.bias - self.shift
        true = _sigmoid(-(np.einsum("ij,ij->i", q, of_true) + ahead.take(wanted))) - 1
        ahead = ahead.take(noise)
        # No product can be larger than that of the lengths.
        longest = math.sqrt(float(np.einsum("ij,ij->i", q, q).max()) * float((of_noise * of_noise).sum(1).max()))
        false = _sigmoid(ones @ np.concatenate([-of_noise.T, -ahead[None]]), 1.01 * longest + float(np.abs(ahead).max()))
        dq = true[:, None] * of_true
        dq += false @ of_noise
        # Slopes of the outputs, and of their bias in the last column.
        values = np.empty((n + NOISE, WIDTH + 1), np.float32)
        np.multiply(true[:, None], ones, out=values[:n])
        values[n:, :-1] = false.T @ q
        values[n:, -1] = false.sum(0)
        order, starts, at = _runs(np.concatenate([wanted, noise]))
        slope = np.add.reduceat(values.take(order, axis=0), starts, axis=0)
        given = np.concatenate([dq] * BEFORE, axis=1)
        places = np.einsum("ik,ik->k", given, vectors).reshape(BEFORE, WIDTH) / n
        given *= weight
        order, starts, of = _runs(before.ravel())
        given = _run_sums(given.reshape(-1, WIDTH), order, starts)
        slope /= n
        given /= n
        self._step(2, at, slope[:, :-1].copy())
        self._step(3, at, slope[:, -1].copy())
        self._step(0, of, given)
        self._step(1, np.arange(BEFORE), places)

    def learn(self, before: np.ndarray, wanted: np.ndarray) -> None:
        order = self.rng.permutation(len(wanted))
        # Numbers of rows as numpy looks them up.
        before, wanted = before.astype(np.intp).take(order, axis=0), wanted.astype(np.intp).take(order)
        for at in range(0, len(order), BATCH):
            self.batch(before[at:at + BATCH], wanted[at:at + BATCH])


def positions(words: Words, texts: list[bytes]):
    """All words and ends of the texts: context rows before each, output, count, known, and more.

    Returns (before, output, count, known, hashes, owner); ``owner`` is the number of the text.
    """
    h, bounds = word_hashes(texts, tails=True)
    sizes = np.diff(bounds)
    places = sizes + BEFORE + 1
    starts = np.concatenate(([0], np.cumsum(places)))
    hashes = np.full(starts[-1], END)
    tail = np.zeros(starts[-1], np.int64)
    inside = np.arange(len(h)) + np.repeat(starts[:-1] + BEFORE - bounds[:-1], sizes)
    hashes[inside], tail[inside] = h[:, 0], h[:, 1].astype(np.int64)
    context, output, count, known = words.look_up(hashes, tail)
    ahead = (starts[:-1, None] + np.arange(BEFORE)).ravel()
    context[ahead] = CONTEXT_WORDS + CONTEXT_CLASSES  # the row for what comes before a text
    real = np.ones(starts[-1], bool)
    real[ahead] = False
    at = np.flatnonzero(real)
    before = np.stack([context[at - 1 - j] for j in range(BEFORE)], axis=1)
    return before, output[at], count[at], known[at], hashes[at], np.repeat(np.arange(len(texts)), sizes + 1)


def log_probabilities(model: Model, before: np.ndarray, output: np.ndarray,
                      rows: int = 2_048) -> np.ndarray:
    """Natural log of the normalised probability of each output after its context."""
    weight = model.places.ravel()
    # One product gives the scores with their bias: contexts get a last coordinate of 1, outputs their bias.
    outputs = np.concatenate([model.outputs.T, model.bias[None]]).astype(np.float32)
    longest = float(np.sqrt((model.outputs ** 2).sum(1).max(initial=0)))
    steepest = float(np.abs(model.bias).max(initial=0))
    q = np.ones((rows, WIDTH + 1), np.float32)
    scores = np.empty((rows, len(model.outputs)), np.float32)
    out = np.empty(len(output))
    for at in range(0, len(output), rows):
        ids = before[at:at + rows]
        n = len(ids)
        now, table = q[:n, :WIDTH], scores[:n]
        vectors = model.contexts.take(ids.ravel(), axis=0).reshape(n, BEFORE * WIDTH)
        vectors *= weight
        _added(vectors, now)
        np.matmul(q[:n], outputs, out=table)
        picked = table[np.arange(n), output[at:at + rows]].astype(np.float64)
        # No score can be larger than this, so that mostly none has to be looked at.
        if longest * math.sqrt(float(np.einsum("ij,ij->i", now, now).max())) + steepest > 60:
            peak = table.max(1)
            table -= peak[:, None]
        else:
            peak = 0.0
        np.exp(table, out=table)
        # Sums of pairs of pairs: exact to a few units in the last place.
        out[at:at + rows] = picked - peak - np.log(table.sum(1).astype(np.float64))
    return out


def _groups(documents, size: int = _GROUP, most: int = 1 << 20):
    group, held = [], 0
    for doc in documents:
        group.append(doc)
        held += len(doc[1])
        if len(group) >= size or held >= most:
            yield group
            group, held = [], 0
    if group:
        yield group


def word_counts(docs: DataFrame, **names) -> DataFrame:
    """``h, tail, n``: how often the training texts hold each word; counted in the tasks first."""
    def each(documents):
        parts, size = [], 0
        for group in _groups(documents):
            texts = [raw for doc_id, raw in group if not held_out(doc_id)]
            if texts:
                h, _ = word_hashes(texts, tails=True)
                ends = np.tile(np.array([[END, 0]], np.uint64), (len(texts), 1))
                parts.append(np.concatenate([h, ends]))
                size += len(parts[-1])
            if size > 4_000_000:
                yield from counted(parts)
                parts, size = [], 0
        if parts:
            yield from counted(parts)

    def counted(parts):
        h = np.concatenate(parts)
        # Any row of a word will do, so the order need not be stable.
        order = np.argsort(h[:, 0])
        found = h[order, 0]
        starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        found, n = found[starts], np.diff(starts, append=len(h))
        table = pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(h[order[starts], 1].astype(np.int64)), pa.array(n.astype(np.int64))],
            names=["h", "tail", "n"])
        yield from (table.slice(at, 50_000) for at in range(0, len(found), 50_000))

    seen = map_documents(docs, "h bigint, tail bigint, n bigint", each, **names)
    return seen.groupBy("h", "tail").agg(F.sum("n").alias("n"))


def known_words(counts: DataFrame) -> Words:
    """Totals, the most frequent words, and classes by the last two bytes (at most 65,536 rows)."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).collect()[0]
    # Its size is bounded by HEAD; a plain conversion keeps the driver's memory low.
    head = counts.orderBy(F.desc("n"), "h").limit(HEAD).select("h", "n", "tail").toArrow()
    h = head.column("h").to_numpy().view(np.uint64)
    n, tail = head.column("n").to_numpy(), head.column("tail").to_numpy()
    tails = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    mass, kinds = np.zeros(65_536, np.int64), np.zeros(65_536, np.int64)
    for row in tails:
        mass[row.tail], kinds[row.tail] = row.n, row.v
    rank = np.arange(len(h))
    # The end of a text is an output of its own, however rare.
    single = rank < OUTPUT_WORDS - 1
    if (end := np.flatnonzero(h == END)).size:
        single[end[0]] = True
    else:
        h, n, tail = np.append(h, END), np.append(n, 0), np.append(tail, 0)
        rank, single = np.arange(len(h)), np.append(single, True)
    np.subtract.at(mass, tail[single], n[single])
    np.subtract.at(kinds, tail[single], (n[single] > 0).astype(np.int64))
    number = np.cumsum(single) - 1
    n_single = int(single.sum())

    def classes(most):
        of = np.zeros(65_536, np.int64)
        top = np.argsort(-mass, kind="stable")[:most - 1]
        of[top] = np.arange(1, len(top) + 1)
        return of

    by_tail = classes(OUTPUT_CLASSES)
    class_mass = np.bincount(by_tail, mass, OUTPUT_CLASSES)
    class_kinds = np.bincount(by_tail, kinds, OUTPUT_CLASSES)
    output = np.where(single, number, n_single + by_tail[tail])
    shares = np.concatenate([n[single] + 0.1, class_mass + 0.1 * (class_kinds + 1)])
    context = np.where(rank < CONTEXT_WORDS, rank, 0)
    context_class = CONTEXT_WORDS + classes(CONTEXT_CLASSES)
    context = np.where(rank < CONTEXT_WORDS, context, context_class[tail])
    order = np.argsort(h)
    return Words(
        h[order], n[order], context[order].astype(np.int32), output[order].astype(np.int32),
        context_class.astype(np.int32), (n_single + by_tail).astype(np.int32), shares / shares.sum(),
        np.concatenate([np.zeros(n_single), np.log(class_mass + 0.1 * (class_kinds + 1))]),
        int(total), int(distinct))


def start_model(docs: DataFrame, words: Words, texts: int = START_TEXTS, turns: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, list]:
    """A model fitted on the driver, on ``texts`` whole training texts that arrive one by one."""
    rows = docs.select(F.col(f"`{id_col}`").alias("start_id"),
                       F.coalesce(f"`{text_col}`", F.lit("")).alias("start_text"))
    id_text = F.col("start_id").cast("string")
    ids = (rows.where(id_text.isNotNull() & (F.crc32(id_text) % 10 != 0)).select("start_id").distinct()
           .orderBy(F.xxhash64("start_id"), "start_id").limit(texts))
    # At most ``texts`` ids.
    sample = rows.join(F.broadcast(ids), "start_id")
    trainer = Trainer(new_model(words), words.noise, 1)
    rows = ((row.start_id, row.start_text.encode()) for row in stored(sample, "start").toLocalIterator())
    for group in _groups(rows):
        before, output, *_ = positions(words, [raw for _, raw in group])
        for _ in range(turns):
            trainer.learn(before, output)
    return trainer.model, trainer.grown


def fit(docs: DataFrame, words: Words, stride: int = STRIDE, **names) -> Model:
    """The start model, improved by every task on its own texts; the average over all tasks."""
    model, grown = start_model(docs, words, **names)
    shared = docs.sparkSession.sparkContext.broadcast((model, grown, words))

    def each(documents):
        model, grown, words = shared.value
        trainer, seen = Trainer(model, words.noise, 2, grown), 0
        for number, group in enumerate(_groups(documents)):
            texts = [raw for doc_id, raw in group if not held_out(doc_id)]
            if number % stride == 0 and texts:
                before, output, *_ = positions(words, texts)
                trainer.learn(before, output)
                seen += len(output)
        if seen:
            values = trainer.model.flat().astype(np.float64) * seen
            yield from ((i, values[at:at + PARAMETERS].tolist(), seen)
                        for i, at in enumerate(range(0, len(values), PARAMETERS)))

    # A row for each block of parameters of a task; blocks are added up by the tasks that get them.
    trained = map_documents(docs, "i int, v array<double>, w bigint", each, **names, batch_rows=16)
    schema = trained.schema

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for i, v, w in zip(*(batch.column(c) for c in range(3)), strict=True):
                held = sums.setdefault(i.as_py(), [0.0, 0])
                held[0] = held[0] + v.values.to_numpy()
                held[1] += w.as_py()
        for i, (v, w) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([v.tolist()], pa.list_(pa.float64())),
                                              pa.array([w], pa.int64())], names=schema.fieldNames())

    blocks = trained.repartition("i").mapInArrow(summed, schema).toArrow().sort_by("i")
    if not blocks.num_rows:
        return model
    values = [v.values.to_numpy() / w.as_py() for v, w in zip(blocks.column("v"), blocks.column("w"), strict=True)]
    return model.unflat(np.concatenate(values))


def score_texts(docs: DataFrame, counts: DataFrame, words: Words, model: Model, **names) -> DataFrame:
    """Scores of all texts; see ``lm_scores``."""
    shared = docs.sparkSession.sparkContext.broadcast((words, model))
    below = math.log10(words.total + 0.1 * (words.distinct + 1))
    ten = math.log(10)

    def each(documents):
        from pyspark import TaskContext

        words, model = shared.value
        row = TaskContext.get().partitionId() << 40
        for group in _groups(documents):
            before, output, count, known, hashes, owner = positions(words, [raw for _, raw in group])
            size = len(group)
            logs = log_probabilities(model, before, output) / ten
            single = words.log_class[output] == 0
            smooth = np.log10(count + 0.1)
            # Of words that are not among the frequent ones the count is joined later.
            logs += np.where(single, 0, np.where(known, smooth, 0) - words.log_class[output] / ten)
            base = np.where(known, smooth, 0) - below
            sums = [np.bincount(owner, v, size) for v in (base, logs, known & (count > 0))]
            tokens = np.bincount(owner, minlength=size)
            rest = np.flatnonzero(~known)
            cuts = np.searchsorted(owner[rest], np.arange(size + 1))
            rest = hashes[rest].view(np.int64)
            for i, (doc_id, _) in enumerate(group):
                yield (doc_id, row, held_out(doc_id), int(tokens[i]), int(sums[2][i]),
                       float(sums[0][i]), float(sums[1][i]), rest[cuts[i]:cuts[i + 1]])
                row += 1

    part = stored(map_documents(
        docs, "doc_id bigint, row bigint, held_out boolean, n_tokens bigint, n_known bigint, "
        "base_score double, score double, rest array<bigint>", each, **names, batch_rows=1_000), "scored")
    # A word's smoothed count adds the same to both scores: what divides it is in already.
    rare = (part.select("row", F.explode("rest").alias("h")).join(counts.select("h", "n"), "h", "left")
            .groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("more"),
                                F.count("n").alias("found")))
    more = F.coalesce("more", F.lit(0.0))
    return part.drop("rest").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))


def lm_scores(docs: DataFrame, stride: int = STRIDE, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row.

    Scores are log10 probabilities of the whole text with its end, by smoothed word frequencies and
    by the model. A null or empty text is its end alone; a null id stays null and is not learned
    from; repeated rows are scored each by itself and learned from each time; other columns are not
    read; an empty table gives an empty result.
    """
    names = {"id_col": id_col, "text_col": text_col}
    counts = stored(word_counts(docs, **names), "counts")
    words = known_words(counts)
    return score_texts(docs, counts, words, fit(docs, words, stride, **names), **names)
