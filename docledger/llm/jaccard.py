"""N-gram Jaccard join: which texts share enough of their word shingles, and the groups they form.

Documents and n-grams form a sparse 0/1 matrix; the overlap of two documents is an entry of its
product with its transpose. That product is never formed whole:

1. Texts with the same set of shingles are one class, its smallest id stands for all.
2. Columns are put in one order for all documents, the rare ones first. Two sets of Jaccard ``t`` or
   more share a column among their first ``n - ceil(t n) + 1``, so only these are joined. Every order
   is right; it decides how many pairs share a column for nothing. Here n-grams whose hash lies in the
   first RANGE of all hashes are counted exactly, which costs a shuffle of that share of the matrix.
   Those that occur once come first: they link nothing and need not be joined at all, their number for
   each document is enough. Then come the others by hash, known frequent ones late, and last what is
   frequent in the range. Few documents have any column left to be joined.
3. In some rounds the documents of a column are put in an order by hash, another one each round, and
   each is compared with the first and the few before it, if they do not belong to one group yet. The
   overlap is accumulated by blocks of columns, and a pair is dropped as soon as overlap so far and
   columns left cannot reach ``ceil(t (a + b) / (1 + t))``. Links found join groups.
4. What still shares a column across two groups is compared too, all of it. Columns of few documents
   are joined to pairs. Documents that crowded columns connect form a cluster; it is cut into blocks,
   and a task multiplies one block with another and returns only links that join groups. So no such
   link is lost, while a group of thousands of near copies is never turned into all its pairs.

Shingles are 64-bit hashes, sets are compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.llm.graph import components, stored
from docledger.llm.text import handing_back, map_documents, shingle_set, word_hashes

#: N-grams known as frequent; all tasks hold this list (16 bytes each).
FREQUENT = 131_072
#: Share of the n-grams, by hash, that are counted exactly.
RANGE = 0.25
#: Rounds of step 3, and how many neighbours are compared in each.
ROUNDS, NEIGHBOURS = 2, 4
#: Documents from which on a column is crowded, and documents of a block.
CROWD, BLOCK_DOCS = 64, 512
#: Ids broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Column blocks end at these shares of the hash range.
BLOCKS = (1 / 8, 1 / 4, 1 / 2, 1)
#: Texts that are compared with one and the same text in one part.
PART = 512
_GROUP = 256


def least_overlap(a, b, percent: int):
    """Smallest overlap with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def sets_of(documents: Iterator[tuple], k: int) -> Iterator[tuple]:
    """Ids and shingle sets."""
    group = []
    for doc in documents:
        group.append(doc)
        if len(group) == _GROUP:
            yield from _sets(group, k)
            group = []
    yield from _sets(group, k)


def _sets(group: list[tuple], k: int) -> Iterator[tuple]:
    h, bounds = word_hashes([raw for _, raw in group])
    for i, (doc_id, _) in enumerate(group):
        yield doc_id, shingle_set(h[bounds[i]:bounds[i + 1]], k)


def set_hash(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def survey(docs: DataFrame, k: int, most: int, **names) -> DataFrame:
    """In one reading: ``doc_id, n, set_hash`` of each text, and ``gram, times`` of repeated n-grams.

    Every task counts all its texts and passes on the n-grams it saw four times or more, at most
    ``most``; so what is known of frequencies is approximate, and bounded. It only orders columns.
    """
    def fold(parts):
        grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(where, np.concatenate([c for _, c in parts]), len(grams)).astype(np.int64)

    def each(documents):
        parts, waiting, size = [], [], 0
        for doc_id, grams in sets_of(documents, k):
            yield (doc_id, len(grams), set_hash(grams), None, None)
            waiting.append(grams)
            size += len(grams)
            if size > 1_000_000:
                parts = [trimmed(*fold([*parts, once(waiting)]), 8 * most)]
                waiting, size = [], 0
        if waiting:
            parts = [fold([*parts, once(waiting)])]
        if parts:
            grams, counts = trimmed(*parts[0], most)
            often = counts >= 4
            for gram, n in zip(grams[often].view(np.int64).tolist(), counts[often].tolist(), strict=True):
                yield None, None, None, gram, n

    def once(waiting):
        grams, counts = np.unique(np.concatenate(waiting), return_counts=True)
        twice = counts > 1
        return grams[twice], counts[twice]

    def trimmed(grams, counts, size):
        if len(grams) <= size:
            return grams, counts
        kept = np.sort(np.argsort(-counts, kind="stable")[:size])
        return grams[kept], counts[kept]

    return map_documents(docs, "doc_id bigint, n bigint, set_hash binary, gram bigint, times bigint",
                         each, **names, batch_rows=20_000)


def frequent_grams(surveyed: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, sorted, and how frequent (a power of two)."""
    top = (surveyed.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("times").alias("n"))
           .orderBy(F.desc("n"), "gram").limit(most).toArrow())
    grams = top.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    return grams[order], np.log2(top.column("n").to_numpy()[order].astype(float)).astype(np.int8)


def in_order(grams: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Rare columns first, by hash; frequent ones last, the most frequent at the end."""
    known, levels = frequent
    if not len(known):
        return grams
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    level = np.where(known[at] == grams, levels[at], 0)
    return grams[np.argsort(level, kind="stable")]


def range_end(share: float) -> np.uint64:
    return np.uint64(min(int(share * 2.0 ** 64), 2 ** 64 - 1))


def singles(docs: DataFrame, k: int, **names) -> DataFrame:
    """``text_key, single``: how many n-grams of the counted range a text shares with no other.

    The key is a hash of id and set, as the texts of one id are counted each by itself.
    """
    end = range_end(RANGE)

    def each(documents):
        for doc_id, grams in sets_of(documents, k):
            yield doc_id, set_hash(grams), grams[:np.searchsorted(grams, end)].view(np.int64)

    found = map_documents(docs, "doc_id bigint, set_hash binary, grams array<bigint>", each, **names,
                          batch_rows=500)
    return (found.select(F.xxhash64("doc_id", "set_hash").alias("text_key"), F.explode("grams").alias("gram"))
            .groupBy("gram").agg(F.min("text_key").alias("text_key"), F.count("*").alias("n")).where("n = 1")
            .groupBy("text_key").agg(F.count("*").cast("int").alias("single")))


def first_columns(docs: DataFrame, of: DataFrame, k: int, percent: int, frequent, **names) -> DataFrame:
    """``class_id, n, gram``: the columns to be joined, one in a row, by ``class_id, set_hash, single``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    from docledger.llm.text import columns, id_and_bytes

    shared, end = docs.sparkSession.sparkContext.broadcast(frequent), range_end(RANGE)
    texts = id_and_bytes(docs, **names)
    texts = texts.join(of, texts["doc_id"] == of["class_id"]).select("doc_id", "text", "set_hash", "single")
    schema = docs.sparkSession.createDataFrame([], "doc_id bigint, n int, grams array<bigint>").schema
    schema[0].dataType = texts.schema["doc_id"].dataType
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _GROUP):
                part = batch.slice(start, _GROUP)
                ids, raw, wanted, single = (part.column(i).to_pylist() for i in range(4))
                rows = []
                for (doc_id, grams), of_set, known in zip(
                        sets_of(zip(ids, raw, strict=True), k), wanted, single, strict=True):
                    left = prefix_size(len(grams), percent) - known
                    # A text meets the rows of all texts of its id.
                    if len(grams) and left > 0 and set_hash(grams) == of_set:
                        cut = np.searchsorted(grams, end)
                        chosen = in_order(grams[cut:], shared.value)[:left]
                        if left > len(grams) - cut:  # what is single in the range does no harm
                            chosen = np.concatenate([chosen, grams[:cut]])
                        rows.append((doc_id, len(grams), chosen.view(np.int64)))
                if rows:
                    yield columns(rows, arrow)

    return texts.mapInArrow(handing_back(run), schema).select(
        F.col("doc_id").alias("class_id"), "n", F.explode("grams").alias("gram"))


def overlaps(row: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Overlap of one sorted set with each of the others, -1 for those dropped by a bound.

    One row of the product, accumulated by column blocks.
    """
    sizes = np.array([len(o) for o in others], np.int64)
    need = least_overlap(len(row), sizes, percent)
    overlap, seen, alive = np.zeros(len(others), np.int64), np.zeros(len(others), np.int64), sizes > 0
    flat, owner = np.concatenate(others), np.repeat(np.arange(len(others)), sizes)
    low = 0
    for share in BLOCKS:
        high = len(row) if share == 1 else int(np.searchsorted(row, np.uint64(share * 2.0 ** 64)))
        here = np.ones(len(flat), bool) if share == 1 else flat < np.uint64(share * 2.0 ** 64)
        columns, part, of = row[low:high], flat[here], owner[here]
        if len(columns) and len(part):
            at = np.minimum(np.searchsorted(columns, part), len(columns) - 1)
            overlap += np.bincount(of[columns[at] == part], minlength=len(others))
        seen += np.bincount(of, minlength=len(others))
        alive &= overlap + np.minimum(len(row) - high, sizes - seen) >= need
        rest = ~here & alive[owner]
        flat, owner, low = flat[rest], owner[rest], high
        if not alive.any():
            break
    return np.where(alive, overlap, -1)


def _chosen(docs: DataFrame, ids: DataFrame, id_col: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` by a table of ids: broadcast where their count allows, else by a shuffle."""
    ids = ids.select(F.col(ids.columns[0]).alias("wanted_id"))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[f"`{id_col}`"] == ids["wanted_id"], how)


def compare(docs: DataFrame, pairs: DataFrame, k: int, percent: int, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``a, b, overlap`` of those ``pairs`` (``a, b``) of ids that link, from the whole texts.

    The texts themselves are shuffled, they pack better than hashes do. Each goes to the ``a`` it
    is compared with; one that has many is cut into parts of about PART texts, to each of which
    its own text goes too. A task reads a part as a stream and holds the set of its ``a`` alone.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    from docledger.llm.text import columns, id_and_bytes

    parts = F.ceil(F.count("*") / PART).cast("int").alias("parts")
    hubs = pairs.groupBy("a").agg(parts)
    members = pairs.join(hubs, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"),
        F.col("b").alias("end_id"))
    own = hubs.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                      F.lit(0).alias("role"), F.col("a").alias("end_id"))
    sent = stored(own.union(members), "sent")
    if sent.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        sent = F.broadcast(sent)
    texts = id_and_bytes(docs, id_col, text_col)
    placed = (texts.join(sent, texts["doc_id"] == sent["end_id"])
              .select("a", "part", "role", F.col("end_id").alias("b"), "text")
              .repartition("a", "part").sortWithinPartitions("a", "part", "role"))
    schema = docs.sparkSession.createDataFrame([], "a bigint, b bigint, overlap bigint").schema
    schema[0].dataType = schema[1].dataType = docs.schema[id_col].dataType
    arrow = to_arrow_schema(schema)

    def product(batches):
        key, own, waiting = None, [], []
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                step = batch.slice(start, 64)
                a, part, role, b, texts = (step.column(i).to_pylist() for i in range(5))
                sets = [grams for _, grams in sets_of(zip(b, texts, strict=True), k)]
                for i, grams in enumerate(sets):
                    if (a[i], part[i]) != key:
                        yield from linked(key, own, waiting)
                        key, own, waiting = (a[i], part[i]), [], []
                    (waiting if role[i] else own).append((b[i], grams))
                yield from linked(key, own, waiting)
                waiting = []

    def linked(key, own, waiting):
        for _, row in own if waiting else []:
            found = overlaps(row, [grams for _, grams in waiting], percent)
            rows = [(key[0], waiting[i][0], n) for i, n in enumerate(found.tolist()) if n >= 0]
            if rows:
                yield columns(rows, arrow)

    return placed.mapInArrow(handing_back(product), schema)


def jaccard_join(
    docs: DataFrame, k: int = 5, percent: int = 80, frequent: int = FREQUENT,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Members and links of the join.

    Members: ``doc_id, n_shingles, class_id, component_id`` for each row of ``docs``; ``class_id``
    is the smallest id with the same shingles, ``component_id`` the smallest reachable by links.
    Links: ``a, b, overlap`` between classes, as many as it takes to join every group; further
    links inside a group that is joined already are not listed.

    A text without words, null or empty, has no shingles and links with nothing; fewer than ``k``
    words are one shingle. A row with a null id links with nothing and has null ids. Rows that
    repeat an id are one document, their links are united. Empty tables give empty results. Other
    columns are not read.
    """
    names = {"id_col": id_col, "text_col": text_col}
    surveyed = stored(survey(docs, k, frequent, **names), "survey")
    sets = surveyed.where("n IS NOT NULL").select("doc_id", "n", "set_hash")
    classes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("set_hash").agg(
        F.min("doc_id").alias("class_id"))
    members = stored(sets.join(classes, "set_hash", "left").select(
        "doc_id", "set_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id")), "members")
    copies = members.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("class_id")).alias("first")).where("NOT first").select("doc_id")
    copies = stored(copies, "copies")
    known = _chosen(docs.where(F.col(f"`{id_col}`").isNotNull()), copies, id_col, "left_anti")
    # All texts of an id that is the first of any class, copies of other ids' texts too: they link both.
    counted = _chosen(members.where("n_shingles > 0 AND doc_id IS NOT NULL"), copies, "doc_id", "left_anti").select(
        F.col("doc_id").alias("class_id"), "set_hash", F.xxhash64("doc_id", "set_hash").alias("text_key"),
        F.col("n_shingles").alias("n")).distinct()
    left = stored(
        counted.join(singles(known, k, **names), "text_key", "left")
        .withColumn("single", F.coalesce("single", F.lit(0)))
        .where(f"n - ceil({percent} * n / 100) + 1 > single").select("class_id", "set_hash", "single"), "left")
    chosen = F.broadcast(left) if left.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else left
    column = first_columns(known, chosen, k, percent, frequent_grams(surveyed, frequent), **names).distinct()
    several = column.groupBy("gram").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high"))
    shared = stored(stored(column, "columns").join(
        several.where("low != high").select("gram"), "gram", "left_semi"), "shared")
    links, joined, done = None, None, None
    for number in range(ROUNDS + 1):
        entry = shared.withColumn("component", F.col("class_id"))
        if joined is not None:
            entry = shared.join(joined, F.col("class_id") == F.col("id"), "left").select(
                "gram", "class_id", "n", F.coalesce("component", "class_id").alias("component"))
        if number < ROUNDS:
            pairs = _neighbours(entry, number)
        else:
            entry = _apart(entry)
            pairs = _across(entry.where(f"docs < {CROWD}"))
            clusters = _clusters(entry.where(f"docs >= {CROWD}"))
        fits = f"100 * least(n, other_n) >= {percent} * greatest(n, other_n) AND component != other_component"
        larger = F.expr("n > other_n OR n = other_n AND class_id < other_id")
        pairs = pairs.where(fits).select(
            F.when(larger, F.col("class_id")).otherwise(F.col("other_id")).alias("a"),
            F.when(larger, F.col("other_id")).otherwise(F.col("class_id")).alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = stored(compare(known, pairs, k, percent, **names), "overlaps")
        links = found if links is None else links.union(found)
        done = pairs if done is None else done.union(pairs)
        if number == ROUNDS:
            links = links.union(stored(multiply(known, clusters, k, percent, **names), "overlaps"))
        joined = components(links)
    members = members.join(joined, F.col("class_id") == F.col("id"), "left").select(
        "doc_id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    return members, links.distinct()


def _neighbours(entry: DataFrame, number: int) -> DataFrame:
    """Each document of a column with the first and the few before it, in the order of this round."""
    order = Window.partitionBy("gram").orderBy(F.xxhash64(F.lit(number), "class_id"), "class_id")
    other = F.struct(F.col("class_id").alias("other_id"), F.col("n").alias("other_n"),
                     F.col("component").alias("other_component"))
    entry = entry.withColumn("other", other)
    near = {"first": F.first("other").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))}
    near |= {f"before_{i}": F.lag("other", i).over(order) for i in range(1, NEIGHBOURS)}
    return entry.withColumns(near).select(
        "class_id", "n", "component", F.explode(F.array(*near)).alias("near")).select(
        "class_id", "n", "component", "near.*")


def _apart(entry: DataFrame) -> DataFrame:
    """Columns whose documents belong to several groups, and how many documents they have."""
    several = entry.groupBy("gram").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("docs"))
    return stored(entry.join(several.where("low != high").select("gram", "docs"), "gram"), "apart")


def _across(entry: DataFrame) -> DataFrame:
    """All pairs of one column whose documents belong to two groups."""
    entry = entry.drop("docs")
    other = entry.toDF("gram", "other_id", "other_n", "other_component")
    return entry.join(other, "gram").where(
        "component != other_component AND (n > other_n OR n = other_n AND class_id < other_id)")


def _clusters(entry: DataFrame) -> DataFrame:
    """``id, component, cluster, block, blocks`` of the documents that crowded columns connect."""
    entry = entry.select("gram", "class_id", "component")
    first = entry.groupBy("gram").agg(F.min("class_id").alias("a"))
    cluster = components(entry.join(first, "gram").select("a", F.col("class_id").alias("b")).distinct())
    ids = entry.select(F.col("class_id").alias("id"), F.col("component").alias("group")).distinct().join(
        cluster, "id").select("id", "group", F.col("component").alias("cluster"))
    sizes = ids.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK_DOCS).cast("int").alias("blocks"))
    return stored(ids.join(sizes, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")), "clusters")


def multiply(docs: DataFrame, clusters: DataFrame, k: int, percent: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Links ``a, b, overlap`` that join groups inside a cluster, by blocks of the matrix product.

    Each block goes to a task with each other block of its cluster. The task holds one of them as
    an inverted index and streams the other.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    from docledger.llm.text import columns, id_and_bytes

    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    sent = clusters.select("id", "group", "cluster", "block", other).select(
        F.col("id").alias("end_id"), "group", "cluster", F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"), F.expr("block > other").cast("int").alias("role"))
    sent = stored(sent, "sent")
    few = sent.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    texts = id_and_bytes(docs, id_col, text_col)
    placed = (texts.join(F.broadcast(sent) if few else sent, texts["doc_id"] == sent["end_id"])
              .select("cluster", "low", "high", "role", F.col("end_id").alias("id"), "group", "text")
              .repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high", "role", "id"))
    schema = docs.sparkSession.createDataFrame([], "a bigint, b bigint, overlap bigint").schema
    schema[0].dataType = schema[1].dataType = docs.schema[id_col].dataType
    arrow = to_arrow_schema(schema)

    def product(batches):
        key, tile = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, _GROUP):
                step = batch.slice(start, _GROUP)
                cluster, low, high, role, ids, groups, texts = (step.column(i).to_pylist() for i in range(7))
                sets = [grams for _, grams in sets_of(zip(ids, texts, strict=True), k)]
                for i, grams in enumerate(sets):
                    if (cluster[i], low[i], high[i]) != key:
                        if tile and tile.alone:
                            yield from emitted(tile.within())
                        key = (cluster[i], low[i], high[i])
                        tile = Tile(percent, low[i] == high[i])
                    if role[i]:
                        yield from emitted(tile.times(ids[i], groups[i], grams))
                    else:
                        tile.hold(ids[i], groups[i], grams)
        if tile and tile.alone:
            yield from emitted(tile.within())

    def emitted(links):
        if rows := list(links):
            yield columns(rows, arrow)

    return placed.mapInArrow(handing_back(product), schema)


class Tile:
    """One block of documents as an inverted index, and the groups that links found so far join."""

    def __init__(self, percent: int, alone: bool):
        self.percent, self.alone = percent, alone
        self.ids, self.groups, self.sets, self.top = [], [], [], {}
        self.index = None

    def hold(self, doc_id, group, grams: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.groups.append(group)
        self.sets.append(grams)

    def _group(self, group):
        while (above := self.top.get(group, group)) != group:
            group = above
        return group

    def times(self, doc_id, group, grams: np.ndarray, before: int | None = None) -> Iterator[tuple]:
        """Links of one more document with those held (the first ``before``) that join two groups."""
        if self.index is None:
            sizes = np.array([len(s) for s in self.sets], np.int64)
            flat = np.concatenate(self.sets)
            order = np.argsort(flat, kind="stable")
            self.index = flat[order], np.repeat(np.arange(len(sizes)), sizes)[order], sizes
        flat, owner, sizes = self.index
        first = np.searchsorted(flat, grams)
        counts = np.searchsorted(flat, grams, side="right") - first
        at = np.repeat(first - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        overlap = np.bincount(owner[at], minlength=len(sizes))
        for i in np.flatnonzero(overlap[:before] >= least_overlap(len(grams), sizes[:before], self.percent)):
            mine, other = self._group(group), self._group(self.groups[i])
            if mine != other:
                self.top[max(mine, other)] = min(mine, other)
                yield doc_id, self.ids[i], int(overlap[i])

    def within(self) -> Iterator[tuple]:
        for i, grams in enumerate(self.sets):
            if i:
                yield from self.times(self.ids[i], self.groups[i], grams, i)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row with the smallest id of each group, with all its columns.

    Texts without words and rows without an id stay. Of rows that repeat an id one stays.
    """
    members, _ = jaccard_join(docs, id_col=id_col, text_col=text_col, **options)
    members = stored(members.select("doc_id", "component_id"), "members")
    gone = members.where("doc_id != component_id").select("doc_id").distinct()
    kept = _chosen(docs, gone, id_col, "left_anti")
    again = stored(members.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
                   .select("doc_id"), "again")
    if again.isEmpty():
        return kept
    of = Window.partitionBy(f"`{id_col}`").orderBy(F.xxhash64(f"`{text_col}`"), f"`{text_col}`")
    number = "_row_of_id"
    while number in docs.columns:
        number += "_"
    one = (_chosen(kept, again, id_col).withColumn(number, F.row_number().over(of))
           .where(F.col(number) == 1).drop(number))
    return _chosen(kept, again, id_col, "left_anti").union(one)
