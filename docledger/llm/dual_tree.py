"""Ranked lexical search of all documents for a batch of items, by two trees at once.

A document's score for an item is the sum, over the item's terms, of a term weight times an impact that grows with
the term's share of the document; both are integers and not negative. Items and documents are vectors of weights
and of impacts, and both are put into a hierarchy whose nodes hold, for each term, the largest coordinate below
them. The product of an item node and a document node bounds the score of every pair below; where it is smaller
than the weakest ``k``-th score that the node's items have already, the whole batch of pairs is left out, which loses
nothing. What is left is scored leaf by leaf, as a product of two small matrices.

Scale: items are searched in blocks of at most about ``MOST_TERMS`` different terms, which is what tasks and the
driver hold. For a block, every task turns its documents into leaves: documents that favour the same items stand
together, with the counts of the block's terms only. Numbers of documents and terms come out of the same pass, over
all documents. A sixteenth of the leaves, by hash, is searched first; the ``k``-th scores found there are where the search of
the others starts. Only each task's ``k`` best of an item are shuffled, in two steps. No document text is shuffled or collected.

Odd rows: null and empty texts have no terms and are not counted as documents; every row is a document, also
where ids repeat; a null document id comes last among equal scores. The rows of an item id are one item with the terms of its
different texts, null ids included; items without a term, or without any document that scores above 0, have no rows.
Other columns are not read. Empty tables give an empty result.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StructField, StructType,
)

from docledger.llm.graph import stored
from docledger.session import ship

#: Different terms of a block of items, about.
MOST_TERMS = 50_000
#: Documents of a leaf, leaves of an inner node and of a branch, items of a leaf.
LEAF, INNER, BRANCH, ITEMS = 128, 8, 32, 8
#: Counts held by a task before it writes a branch.
POSTINGS = 2_000_000
#: The leaves searched first are one in so many.
FIRST = 16
#: Bytes of text that are split into words at once.
BLOCK = 1 << 20
#: An impact is below this; sums of exact doubles stay below ``2 ** 53``.
MOST_IMPACT = 1_000_000

# Bytes of terms; A-Z as a-z, all others as a blank.
_TERM = bytes(b | 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
              for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, part by part: digits, letters in lower case, all that is not ASCII."""
    text, at = text.translate(_TERM), 0
    while len(text) - at > BLOCK:
        end = text.find(b" ", at + BLOCK)
        if end < 0:
            break
        yield text[at:end].split()
        at = end
    yield text[at:].split()


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, term, n``: how often an item has each of its terms."""
    source = items.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where(
        "text IS NOT NULL").distinct().select("item_id", F.col("text").cast("binary").alias("text"))
    schema = StructType([source.schema["item_id"], StructField("term", BinaryType()), StructField("n", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                found: Counter = Counter()
                for part in terms(text):
                    found.update(part)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([i] * len(found))), pa.array(list(found), pa.binary()),
                         pa.array(list(found.values()), pa.int64())], schema=arrow)

    return source.mapInArrow(run, schema).groupBy("item_id", "term").agg(F.sum("n").alias("n"))


class Items:
    """A block of items and its terms, each by a number."""

    def __init__(self, rows: list):
        self.ids = list(dict.fromkeys(r["item_id"] for r in rows))
        number = {item: i for i, item in enumerate(self.ids)}
        self.vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
        held: list[dict] = [{} for _ in self.ids]
        for r in rows:
            held[number[r["item_id"]]][self.vocabulary[bytes(r["term"])]] = r["n"]
        self.terms = [np.array(sorted(h), np.int64) for h in held]
        self.counts = [np.array([h[t] for t in sorted(h)], np.int64) for h in held]
        self.order = self._clustered()

    def _clustered(self, turns: int = 8) -> list[list[int]]:
        """Groups of at most ``ITEMS`` items that share terms, by halving around two centres again and again."""
        holders = np.zeros(len(self.vocabulary))
        for t in self.terms:
            holders[t] += 1
        vectors = [1 / holders[t] for t in self.terms]
        vectors = [v / np.linalg.norm(v) for v in vectors]

        def centre(group: list[int]) -> np.ndarray:
            out = np.zeros(len(self.vocabulary))
            for i in group:
                out[self.terms[i]] += vectors[i]
            return out / max(np.linalg.norm(out), 1e-9)

        def halves(group: list[int]) -> list[list[int]]:
            if len(group) <= ITEMS:
                return [group]

            def likeness(to: np.ndarray) -> np.ndarray:
                return np.array([vectors[i] @ to[self.terms[i]] for i in group])

            one = centre([group[int(likeness(centre(group[:1])).argmin())]])
            other = centre([group[int(likeness(one).argmin())]])
            for _ in range(turns):
                nearer = likeness(one) - likeness(other)
                ranked = [group[i] for i in np.argsort(-nearer, kind="stable")]
                # Where the sign changes, but never far from the middle.
                middle = min(max(int((nearer > 0).sum()), len(group) // 4), len(group) - len(group) // 4)
                one, other = centre(ranked[:middle]), centre(ranked[middle:])
            return halves(ranked[:middle]) + halves(ranked[middle:])

        return halves(list(range(len(self.ids))))

    def favours(self, most: int = 64) -> np.ndarray:
        """Of each term how much it speaks for each of at most ``most`` runs of groups."""
        runs = min(most, len(self.order))
        out = np.zeros((len(self.vocabulary), runs), np.float32)
        for g, group in enumerate(self.order):
            for i in group:
                out[self.terms[i], g * runs // len(self.order)] += 1
        return out / np.maximum(out.sum(1, keepdims=True), 1)


class ItemTree:
    """Nodes of items: the largest weight of each term below, and which items those are."""

    def __init__(self, items: Items, weights: np.ndarray):
        self.weights = [weights[t] * c for t, c in zip(items.terms, items.counts, strict=True)]
        exact = max((int(w.sum()) for w in self.weights), default=0) * MOST_IMPACT < 1 << 53
        self.kind = np.float64 if exact else np.int64
        self.children: list[tuple[int, ...]] = []
        self.items: list[list[int]] = []
        self.bounds: list[tuple[np.ndarray, np.ndarray]] = []
        self.matrices: list[np.ndarray | None] = []
        scratch = np.zeros(len(weights), self.kind)
        level = []
        for group in items.order:
            ids = np.unique(np.concatenate([items.terms[i] for i in group]))
            matrix = np.zeros((len(ids), len(group)), self.kind)
            for j, i in enumerate(group):
                matrix[np.searchsorted(ids, items.terms[i]), j] = self.weights[i]
            level.append(self._node((), group, (ids, matrix.max(1)), matrix))
        while len(level) > 1:
            pairs = [level[i:i + 2] for i in range(0, len(level), 2)]
            level = []
            for pair in pairs:
                if len(pair) == 1:
                    level += pair
                    continue
                for node in pair:
                    ids, most = self.bounds[node]
                    scratch[ids] = np.maximum(scratch[ids], most)
                ids = np.unique(np.concatenate([self.bounds[n][0] for n in pair]))
                bound = ids, scratch[ids].copy()
                scratch[ids] = 0
                level.append(self._node(tuple(pair), sum((self.items[n] for n in pair), []), bound, None))
        self.root = level[0]

    def _node(self, children, items, bound, matrix) -> int:
        self.children.append(children)
        self.items.append(items)
        self.bounds.append(bound)
        self.matrices.append(matrix)
        return len(self.items) - 1


class Leaf:
    """Documents with the impacts of the terms that they have."""

    def __init__(self, ids: list, n: np.ndarray, starts: np.ndarray, of: np.ndarray, tf: np.ndarray, documents: int,
                 total: int, kind):
        m = np.array([25 + 75 * int(x) * documents // total for x in n], np.int64)
        row = np.repeat(np.arange(len(ids)), np.diff(starts))
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])
        self.ids, self.row, self.of, self.impact, self.kind = ids, row, of, impact, kind
        self.distinct, self.column = np.unique(of, return_inverse=True)
        self.most = np.zeros(len(self.distinct), np.int64)
        np.maximum.at(self.most, self.column, impact)
        self._matrix = None

    def scores(self, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Documents by items, from the items' matrix over the terms ``ids``."""
        if self._matrix is None:
            self._matrix = np.zeros((len(self.ids), len(self.distinct)), self.kind)
            self._matrix[self.row, self.column] = self.impact
        at = np.searchsorted(self.distinct, ids)
        at[at == len(self.distinct)] = 0
        held = self.distinct[at] == ids
        return self._matrix[:, at[held]] @ weights[held]


class Search:
    """The best documents so far of each item of a block, and the walk over both trees."""

    def __init__(self, tree: ItemTree, size: int, k: int, floors: np.ndarray):
        self.tree, self.size, self.k = tree, size, k
        self.least = np.maximum(floors, 1)  # a document must reach this to be among the best
        self.best: list[list[tuple]] = [[] for _ in floors]
        self.bounded = self.scored = 0

    def add(self, leaves: list[Leaf]) -> None:
        """Search a branch of documents."""
        if not leaves:
            return
        kind = self.tree.kind
        nodes = []  # largest impacts, children, leaf
        for leaf in leaves:
            most = np.zeros(self.size, kind)
            most[leaf.distinct] = leaf.most
            nodes.append((most, (), leaf))
        level = list(range(len(nodes)))
        while len(level) > 1:
            groups = [level[i:i + INNER] for i in range(0, len(level), INNER)]
            level = []
            for group in groups:
                nodes.append((np.maximum.reduce([nodes[n][0] for n in group]), tuple(group), None))
                level.append(len(nodes) - 1)
        self._walk(self.tree.root, level[0], nodes)

    def _bound(self, item: int, most: np.ndarray):
        ids, weights = self.tree.bounds[item]
        self.bounded += 1
        return weights @ most[ids]

    def _walk(self, item: int, node: int, nodes: list) -> None:
        heap = [(-self._bound(item, nodes[node][0]), item, node)]
        while heap:
            bound, item, node = heapq.heappop(heap)
            if -bound < self.least[self.tree.items[item]].min():
                continue  # no pair below can be among the best
            most, below, leaf = nodes[node]
            halves = self.tree.children[item]
            if below and (not halves or len(below) > 1):
                pairs = [(item, n) for n in below]
            elif halves:
                pairs = [(i, node) for i in halves]
            else:
                self._score(item, leaf)
                continue
            for i, n in pairs:
                value = self._bound(i, nodes[n][0])
                if value >= self.least[self.tree.items[i]].min():
                    heapq.heappush(heap, (-value, i, n))

    def _score(self, item: int, leaf: Leaf) -> None:
        self.scored += 1
        group = self.tree.items[item]
        scores = leaf.scores(self.tree.bounds[item][0], self.tree.matrices[item])
        for row, column in np.argwhere(scores >= self.least[group]).tolist():
            i, document = group[column], leaf.ids[row]
            key = (-int(scores[row, column]), document is None, 0 if document is None else document)
            best = self.best[i]
            if len(best) == self.k and key >= best[-1][0]:
                continue
            bisect.insort(best, (key, document), key=lambda entry: entry[0])
            del best[self.k:]
            if len(best) == self.k:
                self.least[i] = max(self.least[i], -best[-1][0][0])

    def rows(self, ids: list) -> Iterator[tuple]:
        for i, best in enumerate(self.best):
            for key, document in best:
                yield ids[i], document, -key[0]


_LEAF = [StructField("part", IntegerType()), StructField("branch", IntegerType()), StructField("leaf", IntegerType()),
         *[StructField(c, BinaryType()) for c in ("n", "starts", "terms", "tf")]]
_TOTALS = [StructField("documents", LongType()), StructField("total", LongType()), StructField("df", BinaryType())]


def _leaves(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """All documents as leaves of the block's terms; a row without a leaf number holds the counts of a task."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                         F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))
    schema = StructType([StructField("ids", ArrayType(source.schema["doc_id"].dataType)), *_LEAF, *_TOTALS])
    arrow = to_arrow_schema(schema)
    # A block is bounded by MOST_TERMS; broadcast once instead of with each task.
    shared = docs.sparkSession.sparkContext.broadcast((items.vocabulary, items.favours()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, favours = shared.value
        known = vocabulary.__contains__
        part, branch = TaskContext.get().partitionId(), 0
        documents = total = held = 0
        df = np.zeros(len(vocabulary), np.int64)
        waiting: list[tuple] = []  # id, number of terms, the block's terms, their counts

        def written() -> Iterator[pa.RecordBatch]:
            place = []
            for _, _, found, tf in waiting:
                votes = (favours[found] * np.minimum(tf, 3)[:, None]).sum(0)
                best = int(votes.argmax())
                place.append((best, -float(votes[best])))
            order = sorted(range(len(waiting)), key=place.__getitem__)
            for leaf, at in enumerate(range(0, len(order), LEAF)):
                rows = [waiting[i] for i in order[at:at + LEAF]]
                yield pa.RecordBatch.from_pylist([{
                    "ids": [r[0] for r in rows], "part": part, "branch": branch, "leaf": leaf,
                    "n": np.array([r[1] for r in rows], np.int64).tobytes(),
                    "starts": np.cumsum([0] + [len(r[2]) for r in rows]).astype(np.int64).tobytes(),
                    "terms": np.concatenate([r[2] for r in rows]).astype(np.int32).tobytes(),
                    "tf": np.concatenate([r[3] for r in rows]).tobytes()}], schema=arrow)

        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                for document, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    n, counts = 0, Counter()
                    for words in terms(text):
                        n += len(words)
                        counts.update(filter(known, words))
                    if not n:
                        continue
                    documents += 1
                    total += n
                    if counts:
                        found = np.fromiter(map(vocabulary.__getitem__, counts), np.int64, len(counts))
                        df[found] += 1
                        waiting.append((document, n, found, np.fromiter(counts.values(), np.int64, len(counts))))
                        held += len(found)
                    if len(waiting) >= LEAF * BRANCH or held >= POSTINGS:
                        yield from written()
                        waiting, held, branch = [], 0, branch + 1
        if waiting:
            yield from written()
        if documents:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "documents": documents, "total": total, "df": df.tobytes()}], schema=arrow)

    return stored(source.mapInArrow(run, schema), "leaves")


def _totals(leaves: DataFrame) -> tuple[int, int, np.ndarray | None]:
    """Documents, terms of all documents, and the documents that hold each of the block's terms."""
    rows = leaves.where("leaf IS NULL").select("documents", "total", "df")
    arrow = to_arrow_schema(rows.schema)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = total = 0
        df = None
        for batch in batches:
            for row in batch.to_pylist():
                one = np.frombuffer(row["df"], np.int64)
                documents, total, df = documents + row["documents"], total + row["total"], one if df is None else df + one
        if df is not None:
            yield pa.RecordBatch.from_pylist([{"documents": documents, "total": total, "df": df.tobytes()}], schema=arrow)

    # Added up by the tasks that read the counts, and what is left of them by one task.
    row = rows.mapInArrow(summed, rows.schema).repartition(1).mapInArrow(summed, rows.schema).first()
    return (row["documents"], row["total"], np.frombuffer(row["df"], np.int64)) if row else (0, 0, None)


def _best(leaves: DataFrame, items: Items, tree, totals: tuple, floors: np.ndarray, k: int, item_type, id_type) -> DataFrame:
    """``item_id, doc_id, score`` of the best that each task finds."""
    documents, total, _ = totals
    schema = StructType([StructField("item_id", item_type), StructField("doc_id", id_type), StructField("score", LongType()),
                         StructField("part", IntegerType())])
    arrow = to_arrow_schema(schema)
    shared = leaves.sparkSession.sparkContext.broadcast((items.ids, len(items.vocabulary), tree, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, size, tree, floors = shared.value
        search = Search(tree, size, k, floors)

        def stored_leaves():
            for batch in batches:
                for i in range(batch.num_rows):
                    yield batch.slice(i, 1).to_pylist()[0]

        for _, branch in groupby(stored_leaves(), lambda r: (r["part"], r["branch"])):
            held = []
            for row in branch:
                held.append(Leaf(row["ids"], *[np.frombuffer(row[c], np.int64) for c in ("n", "starts")],
                                 np.frombuffer(row["terms"], np.int32).astype(np.int64), np.frombuffer(row["tf"], np.int64),
                                 documents, total, tree.kind))
                if len(held) == BRANCH:
                    search.add(held)
                    held = []
            search.add(held)
        rows = list(search.rows(ids))
        if rows:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip([*zip(*rows, strict=True), [part] * len(rows)], arrow, strict=True)],
                schema=arrow)

    columns = ["ids", *[f.name for f in _LEAF]]
    return leaves.select(*columns).mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item, first among the results of up to 256 tasks, then among what is left."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item_id", F.pmod("part", F.lit(256))).orderBy(*order)
    every = Window.partitionBy("item_id").orderBy(*order)
    return (found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
            .withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, most_terms: int = MOST_TERMS, first: int = FIRST,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the ``k`` documents that score highest, above 0."""
    spark = docs.sparkSession
    ship(spark)
    wanted = stored(_item_terms(items, item_col, item_text), "items")
    blocks = max(1, -(-wanted.count() // most_terms))
    id_type = docs.schema[id_col].dataType
    schema = StructType([wanted.schema["item_id"], StructField("rank", IntegerType()), StructField("doc_id", id_type),
                         StructField("score", LongType())])
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        mine = wanted if blocks == 1 else wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        rows = mine.collect()  # about ``most_terms`` rows
        if not rows:
            continue
        block_items = Items(rows)
        leaves = _leaves(docs, block_items, id_col, text_col)
        totals = _totals(leaves)
        if not totals[0]:
            continue
        weights = np.array([math.floor(1000 * math.log((2 * totals[0] + 2) / (2 * int(d) + 1))) for d in totals[2]], np.int64)
        tree = ItemTree(block_items, weights)
        filled = leaves.where("leaf IS NOT NULL")
        early = F.pmod(F.xxhash64("part", "branch", "leaf"), F.lit(first)) == 0
        arguments = (block_items, tree, totals)
        types = (k, wanted.schema["item_id"].dataType, id_type)
        zero = np.zeros(len(block_items.ids), np.int64)
        begun = stored(_best(filled.where(early), *arguments, zero, *types), "first")
        # The k-th score of each item of the block, where there is one.
        floors = {r["item_id"]: r["score"] for r in _ranked(begun, k).where(F.col("rank") == k).collect()}
        at = np.array([floors.get(i, 0) for i in block_items.ids], np.int64)
        found = _best(filled.where(~early), *arguments, at, *types)
        out = out.unionByName(_ranked(begun.unionByName(found), k))
    return out
