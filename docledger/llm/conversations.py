"""Repair of the turn structure of conversations by a Viterbi search that runs in parallel chunks.

The rows of a conversation become a sequence of roles that ``(system? (user assistant)+)?`` allows, by the
cheapest edits: keep a row (0), give it another role (2), delete it (3; blank rows and repetitions must go),
insert an empty turn (2); a truncated row that stays costs 1. Of edits of equal cost the one whose letters
``D I K R`` come first in the alphabet is taken.

Method (rank convergence): the costs of all endings, one for each of the four states of that pattern, form a
vector that is carried backwards over the rows. Every chunk of rows starts from a speculative vector. Fix-up
passes give a chunk the vector that the chunk behind it really has and run it again, only until the new vector
differs from the old one by a constant, because from there on nothing changes; passes end when no vector changes.
The stitched vectors then lead the forward trace, chunk by chunk. Should ``PASSES`` passes not be enough, which takes
rows that hardly tell states apart, what is left is settled in order, chunk after chunk.

Scale: rows are dealt out by ranges of (conversation, turn, role, text), so a conversation of any length lies in
many tasks, in chunks of at most ``CHUNK_ROWS`` runs of rows. Equal rows are collapsed before any shuffle, each
different text of a conversation travels once. Fix-up passes read a byte or two for each row, neighbours find each
other by an equi-join of vectors. A conversation that lies in one chunk, as most do, needs none of this. What stays
sequential for a conversation of many chunks is the chain of entry states (a row for each chunk) and, in ``sums``, its
SHA-256, which is a stream over sorted pieces in bounded memory.

Odd rows: null conversations are one conversation; a null turn comes first; null roles and texts are one space. Equal
turns are ordered by role, then by the first ``HEAD`` characters of the text, then by its SHA-256. Rows that repeat a
role and text of their conversation are duplicates, also under the same turn. A role that is empty or does not
start with s, u or a fits nowhere and is given another role or deleted. Empty tables give no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, ByteType, IntegerType, LongType, StringType, StructField, StructType,
)

from docledger.llm.graph import stored
from docledger.session import ship

#: Runs of rows, and bytes of text, of a chunk.
CHUNK_ROWS, CHUNK_BYTES = 4_096, 4 << 20
#: Fix-up passes in parallel before the rest is settled in order.
PASSES = 6
#: Characters of a text that order rows of equal turn and role.
HEAD = 64

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANKS = b" \t\n\x0b\x0c\r"
# States: nothing yet, after a system row, after a user row, after an assistant row (which may end).
# _INSERT is where a user or assistant turn leads, the one that fits; _KEEP where a role leads, or None.
_INSERT = (2, 2, 3, 2)
_ROLES = {2: "user", 3: "assistant"}
_KEEP = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by role: system, user, assistant, any other
_END = (0, 2 * INSERT, INSERT, 0)
_FORCED = 8  # a row that must be deleted; else its role, and 4 more where it is truncated
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_FIRST = {"s": 0, "u": 1, "a": 2}

LINE = StructType([StructField("role", StringType()), StructField("text", StringType())])
_COUNTS = [StructField(c, LongType()) for c in
           ("n_rows", "blank", "duplicate", "truncated", "illegal", "n_turns", "min_turn", "max_turn")]
_EDGES = [StructField("first_role", ByteType()), StructField("last_role", ByteType())]


class Costs:
    """The backward vectors, each distinct one (up to a constant) by a number, and the steps between them."""

    def __init__(self):
        self.vectors: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[tuple[int, int], int] = {}
        self.choices: dict[tuple[int, int, int], tuple[str, int, int]] = {}

    def number(self, vector) -> int:
        least = min(vector)
        vector = tuple(v - least for v in vector)
        if vector not in self.numbers:
            self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.numbers[vector]

    def before(self, behind: tuple, code: int) -> tuple:
        """Costs before a row, insertions there included, from those behind it."""
        if code == _FORCED:
            return tuple(DELETE + v for v in behind)
        role, extra = code & 3, TRUNCATED if code & 4 else 0
        at = []
        for state in range(4):
            ways = [DELETE + behind[state], REROLE + extra + behind[_INSERT[state]]]
            if state in _KEEP[role]:
                ways.append(KEEP + extra + behind[_KEEP[role][state]])
            at.append(min(ways))
        at[2], at[3] = min(at[2], INSERT + at[3]), min(at[3], INSERT + at[2])
        at[0], at[1] = min(at[0], INSERT + at[2]), min(at[1], INSERT + at[2])
        return tuple(at)

    def step(self, behind: int, code: int) -> int:
        if code == _FORCED:
            return behind  # a constant more
        found = self.steps.get((behind, code))
        if found is None:
            found = self.steps[behind, code] = self.number(self.before(self.vectors[behind], code))
        return found

    def backward(self, codes: bytes, right: int) -> list[int]:
        """The vector before each row, and ``right`` at the end."""
        out = [right] * (len(codes) + 1)
        for i in range(len(codes) - 1, -1, -1):
            right = out[i] = self.step(right, codes[i])
        return out

    def again(self, codes: bytes, old: int, new: int, left: int) -> tuple[int, int]:
        """The vector before the first row from ``new``, and how many rows that took; from ``old`` it was ``left``."""
        for done, code in enumerate(reversed(codes)):
            if old == new:
                return left, done
            old, new = self.step(old, code), self.step(new, code)
        return new, len(codes)

    def choose(self, behind: int, code: int, state: int) -> tuple[str, int, int]:
        """Letters of the cheapest edits at a row, the least ones, with their cost and the state they lead to."""
        found = self.choices.get((behind, code, state))
        if found is None:
            found = self.choices[behind, code, state] = self._choose(self.vectors[behind], code, state)
        return found

    def _choose(self, behind: tuple, code: int, state: int) -> tuple[str, int, int]:
        if code == _FORCED:
            return "D", DELETE, state
        here, letters, cost = self.before(behind, code), "", 0
        role, extra = code & 3, TRUNCATED if code & 4 else 0
        while True:
            if DELETE + behind[state] == here[state]:
                return letters + "D", cost + DELETE, state
            if INSERT + here[_INSERT[state]] == here[state]:
                letters, cost, state = letters + "I", cost + INSERT, _INSERT[state]
            elif state in _KEEP[role] and extra + behind[_KEEP[role][state]] == here[state]:
                return letters + "K", cost + KEEP + extra, _KEEP[role][state]
            else:
                return letters + "R", cost + REROLE + extra, _INSERT[state]

    def trace(self, codes: bytes, runs: list[int], vectors: list[int], state: int,
              last: bool) -> tuple[list[str], int, int]:
        """Letters for each run (and, behind the last row of all, one entry more), their cost and the state reached."""
        letters, total = [], 0
        for i, code in enumerate(codes):
            chosen, cost, state = self.choose(vectors[i + 1], code, state)
            letters.append(chosen)
            total += cost * runs[i]
        if last:
            steps = _END[state] // INSERT
            letters.append("I" * steps)
            total += INSERT * steps
            state = 3 if state else 0
        return letters, total, state


def _role(role: str) -> int:
    return _FIRST.get(role[:1], 3)


class _Chunk:
    """Rows of one conversation that follow one another in a task; runs of forced deletions are one entry."""

    def __init__(self, conv, seq: int, first: bool):
        self.conv, self.seq, self.first = conv, seq, first
        self.codes, self.runs, self.lines = bytearray(), [], []
        self.size = 0
        self.counts = dict.fromkeys(("n_rows", "blank", "duplicate", "truncated", "illegal", "n_turns"), 0)
        self.min_turn = self.max_turn = self.first_role = self.last_role = None

    def add(self, turn, role: str, n: int, fault: str | None, text: str | None) -> None:
        """``n`` equal rows with one fault; all of them, but for a live row, must be deleted."""
        kind, counts = _role(role), self.counts
        counts["n_rows"] += n
        counts["illegal"] += n - 1 + (self.last_role is not None and (self.last_role, kind) not in _LEGAL)
        if self.first_role is None:
            self.first_role = kind
        self.last_role = kind
        if turn is not None and turn != self.max_turn:
            counts["n_turns"] += 1
            self.min_turn = turn if self.min_turn is None else self.min_turn
            self.max_turn = turn
        if fault:
            counts[fault] += n
        if text is None:
            if self.codes and self.codes[-1] == _FORCED:
                self.runs[-1] += n
                return
            self.codes.append(_FORCED)
            self.runs.append(n)
        else:
            self.codes.append(kind + (4 if fault == "truncated" else 0))
            self.runs.append(1)
            self.lines.append({"role": role, "text": text})
            self.size += len(text)

    def full(self, rows: int) -> bool:
        return len(self.codes) >= rows or self.size >= CHUNK_BYTES

    def facts(self) -> dict:
        return {"conv_id": self.conv, "seq": self.seq, **self.counts, "min_turn": self.min_turn,
                "max_turn": self.max_turn, "first_role": self.first_role, "last_role": self.last_role}


def written(codes: bytes, runs, lines: list[dict], letters: list[str], state: int) -> tuple[str, list[dict]]:
    """The audit and the lines that a trace from ``state`` leaves of a chunk."""
    audit, out, line = [], [], 0
    for i, chosen in enumerate(letters):
        for letter in chosen:
            if letter == "I":
                state = _INSERT[state]
                out.append({"role": _ROLES[state], "text": ""})
            elif letter == "K":
                state = _KEEP[codes[i] & 3][state]
                out.append(lines[line])
            elif letter == "R":
                state = _INSERT[state]
                out.append({"role": _ROLES[state], "text": lines[line]["text"]})
        if i < len(codes) and codes[i] != _FORCED:
            line += 1
        audit.append("D" * runs[i] if i < len(codes) and codes[i] == _FORCED else chosen)
    return "".join(audit), out


def _rows_of(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from batch.slice(at, step).to_pylist()


def _parcels(rows: Iterator[tuple[dict, int]], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, given with their sizes, in batches of some MB."""
    held, size = [], 0
    for row, bytes_of in rows:
        held.append(row)
        size += bytes_of + 200
        if size >= CHUNK_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=arrow)


def _mapped(df: DataFrame, schema: StructType, each) -> DataFrame:
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: _parcels(each(batches), arrow), schema)


def _timeline(rows: DataFrame, everyone: DataFrame | None) -> DataFrame:
    """Rows in order: a marker for each conversation, each different text once, and counts of equal rows.

    A ``text`` stands where its conversation has it first; the row behind it with the same key tells how many
    equal rows there are.
    """
    plain = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    key = (F.substring("text", 1, HEAD).alias("head"), F.sha2("text", 256).alias("digest"))
    first = (plain.groupBy("conv_id", "role", "text")
             .agg(F.max(F.col("turn").isNull()).alias("before_all"), F.min("turn").alias("least"))
             .select("conv_id", F.when(~F.col("before_all"), F.col("least")).alias("turn"), "role", *key, "text"))
    blank = (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank")
    equal = plain.select("conv_id", "turn", "role", *key, blank).groupBy(
        "conv_id", "turn", "role", "head", "digest", "blank").agg(F.count("*").alias("n"))
    known = plain.select("conv_id")
    if everyone is not None:
        known = known.union(everyone.select("conv_id"))
    table = (equal.withColumn("kind", F.lit(2))
             .unionByName(first.withColumn("kind", F.lit(1)), allowMissingColumns=True)
             .unionByName(known.distinct().withColumn("kind", F.lit(0)), allowMissingColumns=True)
             .select("conv_id", (F.col("kind") > 0).alias("row"), "turn", "role", "head", "digest", "kind", "text",
                     "blank", "n"))
    order = ["conv_id", "row", "turn", "role", "head", "digest"]
    return table.repartitionByRange(*order).sortWithinPartitions(*order, "kind")


def _chunks(timeline: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunks with the vectors that the speculative start gives; conversations that lie in one are finished."""
    schema = StructType([
        timeline.schema["conv_id"], StructField("part", IntegerType()), StructField("seq", IntegerType()),
        StructField("whole", BooleanType()), StructField("last_here", BooleanType()), StructField("codes", BinaryType()),
        StructField("runs", BinaryType()), StructField("lines", ArrayType(LINE)), StructField("left", ArrayType(LongType())),
        StructField("audit", StringType()), StructField("cost", LongType()), *_COUNTS, *_EDGES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        part, costs = TaskContext.get().partitionId(), Costs()
        end = costs.number(_END)

        def closed(chunk: _Chunk, ends: bool, last_here: bool) -> tuple[dict, int]:
            codes = bytes(chunk.codes)
            vectors = costs.backward(codes, end)
            out = {**chunk.facts(), "part": part, "whole": chunk.first and ends and chunk.seq == 0,
                   "last_here": last_here, "lines": chunk.lines, "left": costs.vectors[vectors[0]]}
            if out["whole"]:
                letters, out["cost"], _ = costs.trace(codes, chunk.runs, vectors, 0, True)
                out["audit"], out["lines"] = written(codes, chunk.runs, chunk.lines, letters, 0)
            else:
                out |= {"codes": codes, "runs": np.asarray(chunk.runs, np.int64).tobytes()}
            return out, chunk.size + 10 * len(codes)

        chunk, live = None, None
        for row in _rows_of(batches):
            if chunk is None or row["conv_id"] != chunk.conv:
                if chunk is not None:
                    yield closed(chunk, True, True)
                chunk, live = _Chunk(row["conv_id"], 0, not row["row"]), None
            if not row["row"]:
                continue
            if row["kind"] == 1:
                live = row
                continue
            if chunk.full(chunk_rows):
                yield closed(chunk, False, False)
                chunk = _Chunk(chunk.conv, chunk.seq + 1, chunk.first)
            n = row["n"]
            if row["blank"]:
                chunk.add(row["turn"], row["role"], n, "blank", None)
            else:
                if live is not None and live["digest"] == row["digest"] and live["role"] == row["role"]:
                    bare = live["text"].encode().rstrip(BLANKS)
                    chunk.add(row["turn"], row["role"], 1, None if bare[-1:] in (b".", b"!", b"?") else "truncated",
                              live["text"])
                    n -= 1
                if n:
                    chunk.add(row["turn"], row["role"], n, "duplicate", None)
            live = None
        if chunk is not None:
            yield closed(chunk, False, True)

    return _mapped(timeline, schema, run)


_KEY = ("conv_id", "part", "seq")


def _same(a: str, b: str):
    condition = F.lit(True)
    for c in _KEY:
        condition &= F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return condition


def _settled(chunks: DataFrame, passes: int) -> DataFrame:
    """``conv_id, part, seq, last, right, passes``: for each chunk the vector behind it, and whether it ends its conversation."""
    # The chunk behind one is the next of its task, or the first that the next task has of the conversation: ranges that
    # follow one another are never empty.
    places = chunks.select(*_KEY, "last_here")
    behind = chunks.select(
        "conv_id", "part", "seq", (F.col("seq") - 1).alias("front_seq"),
        F.when(F.col("seq") > 0, F.col("part")).otherwise(F.col("part") - 1).alias("front_part"))
    links = places.withColumn("front", F.when(F.col("last_here"), F.lit(-1)).otherwise(F.col("seq"))).alias("a").join(
        behind.alias("b"), F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
        & (F.col("a.part") == F.col("b.front_part")) & (F.col("a.front") == F.col("b.front_seq")), "left")
    end = F.lit(list(_END)).cast("array<long>")
    known = stored(links.select(
        *[F.col(f"a.{c}").alias(c) for c in _KEY], F.col("b.part").alias("next_part"), F.col("b.seq").alias("next_seq")),
        "links")
    vectors = stored(chunks.select(*_KEY, end.alias("right"), "left"), "vectors")

    def wanted() -> DataFrame:
        """Every chunk with the vector it has started from and the one it should have started from."""
        return known.alias("k").join(vectors.alias("v"), _same("k", "v")).join(
            vectors.alias("n"), F.col("k.conv_id").eqNullSafe(F.col("n.conv_id"))
            & (F.col("k.next_part") == F.col("n.part")) & (F.col("k.next_seq") == F.col("n.seq")), "left").select(
            *[F.col(f"k.{c}").alias(c) for c in _KEY], F.col("k.next_part").isNull().alias("last"), "v.left", "v.right",
            F.coalesce(F.col("n.left"), end).alias("wanted"))

    done = 0
    for done in range(passes + 1):
        state = stored(wanted(), "fix-up")
        wrong = state.where("right != wanted")
        if wrong.isEmpty():
            break
        if done < passes:
            again = _rerun(wrong, chunks)
        else:
            again = _in_order(state, chunks)
            wrong = state
        kept = state.alias("s").join(wrong.select(*_KEY).alias("w"), _same("s", "w"), "left_anti")
        vectors = stored(kept.select(*_KEY, "right", "left").unionByName(again.select(*_KEY, "right", "left")), "vectors")
        if done == passes:
            state = wanted()
    return state.select(*_KEY, "last", F.col("wanted").alias("right"), F.lit(done).alias("passes"))


_VECTORS = [StructField("right", ArrayType(LongType())), StructField("left", ArrayType(LongType()))]


def _with_codes(state: DataFrame, chunks: DataFrame, *columns: str) -> DataFrame:
    body = chunks.select(*_KEY, "codes", *columns)
    return state.alias("s").join(body.alias("b"), _same("s", "b")).select(
        "s.*", "b.codes", *[f"b.{c}" for c in columns])


def _rerun(wrong: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks run again from the vectors they should have started from, until old and new differ by a constant."""
    schema = StructType([*[wrong.schema[c] for c in _KEY], *_VECTORS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        costs = Costs()
        for row in _rows_of(batches):
            old, new = costs.number(row["right"]), costs.number(row["wanted"])
            left, _ = costs.again(row["codes"], old, new, costs.number(row["left"]))
            yield {**{c: row[c] for c in _KEY}, "right": row["wanted"], "left": costs.vectors[left]}, 100

    return _mapped(_with_codes(wrong, chunks), schema, run)


def _in_order(state: DataFrame, chunks: DataFrame) -> DataFrame:
    """All chunks from the last one of each conversation to its first, each read once."""
    schema = StructType([*[state.schema[c] for c in _KEY], *_VECTORS])
    sorted_ones = (_with_codes(state, chunks).repartition("conv_id")
                   .sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        costs, vector = Costs(), 0
        for row in _rows_of(batches):
            old = costs.number(row["right"])
            vector = costs.number(_END) if row["last"] else vector
            right = costs.vectors[vector]
            vector, _ = costs.again(row["codes"], old, vector, costs.number(row["left"]))
            yield {**{c: row[c] for c in _KEY}, "right": right, "left": costs.vectors[vector]}, 100

    return _mapped(sorted_ones, schema, run)


def _entries(settled: DataFrame, chunks: DataFrame) -> DataFrame:
    """The state in which the trace enters each chunk, from where each chunk leads each state."""
    exits = StructType([*[settled.schema[c] for c in (*_KEY, "last", "right")], StructField("exits", ArrayType(IntegerType()))])

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        costs = Costs()
        for row in _rows_of(batches):
            codes = row["codes"]
            vectors = costs.backward(codes, costs.number(row["right"]))
            states = {s: s for s in range(4)}
            for i, code in enumerate(codes):
                if len(set(states.values())) == 1:
                    # All traces have met.
                    state = states[0]
                    for j in range(i, len(codes)):
                        state = costs.choose(vectors[j + 1], codes[j], state)[2]
                    states = dict.fromkeys(range(4), state)
                    break
                states = {s: costs.choose(vectors[i + 1], code, at)[2] for s, at in states.items()}
            yield {**{c: row[c] for c in (*_KEY, "last", "right")}, "exits": [states[s] for s in range(4)]}, 100

    schema = StructType([*exits.fields[:5], StructField("state", IntegerType())])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        state, begins = 0, True
        for row in _rows_of(batches):
            state = 0 if begins else state
            yield {**{c: row[c] for c in schema.fieldNames()[:5]}, "state": state}, 100
            state, begins = row["exits"][state], row["last"]

    led = _mapped(_with_codes(settled, chunks).drop("passes"), exits, leads)
    return _mapped(led.repartition("conv_id").sortWithinPartitions(*_KEY), schema, chain)


def repair(rows: DataFrame, everyone: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS, passes: int = PASSES) -> DataFrame:
    """Repaired conversations, in pieces that follow one another by ``part`` and ``seq``.

    ``rows`` has conv_id, turn, role and text; conversations that only ``everyone`` has get a piece without
    rows. A piece has the audit of its rows, the cost of these edits, the repaired ``lines``, counts of its faults and what
    is needed to join it to the pieces beside it; ``whole`` ones are all of their conversation.
    """
    ship(rows.sparkSession)
    chunks = stored(_chunks(_timeline(rows, everyone), chunk_rows), "chunks")
    open_ones = chunks.where("NOT whole")
    columns = [*_KEY, "whole", "audit", "cost", "lines", *[f.name for f in _COUNTS + _EDGES]]
    entries = stored(_entries(_settled(open_ones, passes), open_ones), "entries")
    facts = [f.name for f in _COUNTS + _EDGES]
    schema = StructType([chunks.schema[c] for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        costs = Costs()
        for row in _rows_of(batches, 8):
            codes = row["codes"]
            vectors = costs.backward(codes, costs.number(row["right"]))
            runs = np.frombuffer(row["runs"], np.int64).tolist()
            letters, cost, _ = costs.trace(codes, runs, vectors, row["state"], row["last"])
            audit, lines = written(codes, runs, row["lines"], letters, row["state"])
            out = {c: row[c] for c in (*_KEY, *facts)}
            yield {**out, "whole": False, "audit": audit, "cost": cost, "lines": lines}, sum(len(x["text"]) for x in lines)

    traced = _mapped(_with_codes(entries, open_ones, "runs", "lines", *facts), schema, run)
    return chunks.where("whole").select(*columns).unionByName(traced)


def repaired_rows(pieces: DataFrame) -> DataFrame:
    """The turns of ``repair``'s result as rows: conv_id, part, seq, place, role, text, in this order."""
    return pieces.select(*_KEY, F.posexplode("lines").alias("place", "line")).select(*_KEY, "place", "line.role", "line.text")


def sums(pieces: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair``'s result: its faults, cost, audit and a digest of its repaired turns."""
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = StructType([pieces.schema["conv_id"], *[StructField(c, LongType()) for c in names],
                         StructField("audit", StringType()), StructField("repaired_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        now, sha, audit, begun, last_role, turns, least, most = None, None, [], False, None, 0, None, None

        def closed():
            gaps = most - least + 1 - turns if turns else 0
            text = "".join(audit)
            return {**now, "gaps": gaps, "audit": text, "repaired_sha256": sha.hexdigest()}, len(text)

        for row in _rows_of(batches, 8):
            if now is None or row["conv_id"] != now["conv_id"]:
                if now is not None:
                    yield closed()
                now = {"conv_id": row["conv_id"], **dict.fromkeys(names, 0)}
                sha, audit, begun, last_role, turns, least, most = hashlib.sha256(), [], False, None, 0, None, None
            for name in names[1:]:
                now[name] += row[name]
            if last_role is not None and row["first_role"] is not None:
                now["illegal"] += (last_role, row["first_role"]) not in _LEGAL
            last_role = last_role if row["last_role"] is None else row["last_role"]
            if row["n_turns"]:
                turns += row["n_turns"] - (most is not None and most == row["min_turn"])
                least = row["min_turn"] if least is None else least
                most = row["max_turn"]
            audit.append(row["audit"])
            for line in row["lines"]:
                sha.update((f"\n{line['role']}:{line['text']}" if begun else f"{line['role']}:{line['text']}").encode())
                begun = True
        if now is not None:
            yield closed()

    def of(df: DataFrame) -> DataFrame:
        return _mapped(df.drop("whole"), schema, run)

    return of(pieces.where("whole")).unionByName(
        of(pieces.where("NOT whole").repartition("conv_id").sortWithinPartitions(*_KEY)))


def damage(rows: DataFrame) -> DataFrame:
    """Rows with a twentieth each dropped, emptied, without ends of sentences, repeated, or given the role user.

    Which, follows the CRC-32 of ``conv_id:turn``. Nulls become one space, but for the ids and turns of the result.
    """
    def text(column):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    role, said = text("role"), text("text")
    return (rows.select(
        "conv_id", "turn", F.when(fate == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias("text"),
        F.when(fate == 0, F.lit(0)).when(fate == 3, F.lit(2)).otherwise(F.lit(1)).alias("_times"))
        .where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).drop("_times", "_copy"))
