"""The parallel search against a search over whole conversations, row by row."""

import hashlib
import heapq
import random
import re
from collections import defaultdict

import pytest
from llm_helpers import SMALL

from docledger.llm import conversations as co
from docledger.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def search(rows):
    """Cheapest edits, the least ones: rows are (initial, must go, truncated)."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit
        for role in "ua":
            if (state, role) in NEXT:
                heapq.heappush(heap, (cost + 2, audit + "I", i, role))
        if i < len(rows):
            first, forced, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
            if not forced:
                for role in "ua":
                    if (state, role) in NEXT:
                        heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, role))
                if (state, first) in NEXT:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, first))


def plain(rows):
    """What is wanted of a conversation's rows: (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    counts, judged, seen = dict.fromkeys(("blank", "duplicate", "truncated"), 0), [], set()
    for _, role, text in rows:
        fault = ("blank" if not re.search(r"[^\x20\x09-\x0D]", text) else "duplicate" if (role, text) in seen
                 else "truncated" if not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        judged.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
    cost, audit = search(judged)
    out, i = [], 0
    for letter in audit:
        if letter in "KI" or letter == "R":
            out.append((letter, rows[i] if letter != "I" else None))
        i += letter != "I"
    lines = []
    for place, (letter, row) in enumerate(out):
        role = "user" if (place + len(out)) % 2 == 0 else "assistant"
        lines.append(f"{row[1] if letter == 'K' else role}:{row[2] if row else ''}")
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def of(rows):
    out = defaultdict(list)
    for conv, *row in rows:
        out[conv].append(row)
    return {conv: plain(r) for conv, r in out.items()}


def got(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def test_costs_against_search():
    rng, costs = random.Random(5), co.Costs()
    end = costs.number(co._END)
    for _ in range(3000):
        codes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rng.randrange(9)))
        vectors = costs.backward(codes, end)
        letters, cost, _ = costs.trace(codes, [1] * len(codes), vectors, 0, True)
        rows = [("suax"[c & 3], c == 8, int(c < 8 and c & 4 > 0)) for c in codes]
        assert (cost, "".join(letters)) == search(rows)


def test_again_stops_where_vectors_are_parallel():
    rng, costs = random.Random(6), co.Costs()
    stopped = 0
    for _ in range(500):
        codes = bytes(rng.choice([1, 2, 1, 2, 0, 8, 5, 6]) for _ in range(40))
        old, new = costs.number(co._END), costs.number([rng.randrange(5) for _ in range(4)])
        left, rows = costs.again(codes, old, new, costs.backward(codes, old)[0])
        assert left == costs.backward(codes, new)[0]
        stopped += rows < 40
    assert stopped > 400


def test_given_table(spark):
    duckdb = pytest.importorskip("duckdb")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    cursor = duck.execute(ORACLES["op12_conversation_repair"])
    names = [c[0] for c in cursor.description]
    wanted = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in (dict(zip(names, row)) for row in cursor.fetchall())}
    assert got(QUERIES["op12_conversation_repair"](spark, SMALL)) == wanted


def random_rows(rng, conversations=12, most=40):
    texts = ["Yes.", "No", "Well?", " ", "", "Go on!", "a.b", "so. \n", "x"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(most)):
            rows.append((conv if conv else None, turn // rng.choice([1, 1, 1, 3]) if rng.random() < 0.9 else None,
                         rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "User"]),
                         rng.choice([*texts, f"unlike {rng.random()}", f"unlike {rng.random()}.", None])))
    return rows


@pytest.mark.parametrize("chunk_rows,passes", [(4096, 6), (2, 6), (1, 0), (3, 1)])
def test_chunks_and_passes(spark, chunk_rows, passes):
    rows = random_rows(random.Random(chunk_rows))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(co.sums(co.repair(df, chunk_rows=chunk_rows, passes=passes))) == of(rows)


def test_long_conversation(spark, conf):
    """One conversation with most of the rows lies in several tasks and many chunks; parity runs through all of it."""
    conf(spark__sql__shuffle__partitions="6", spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [(1, t, "tool" if t % 50 else "user", f"t{t}{'.' if t % 3 else ''}") for t in range(700)]
    rows += [(1, 900 + t, "user", "same.") for t in range(40)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, SCHEMA)
    pieces = co.repair(df, chunk_rows=16)
    assert pieces.where("conv_id = 1").select("part").distinct().count() > 3
    assert got(co.sums(pieces)) == of(rows)
    turns = [r.role for r in co.repaired_rows(pieces).where("conv_id = 1").orderBy("part", "seq", "place").collect()]
    assert re.fullmatch("s?(ua)+", "".join(r[0] for r in turns))


def test_many_equal_rows_are_one_run(spark):
    rows = [(1, 1, "user", "Hi.")] * 3000 + [(1, 2, "assistant", "Yes.")] + [(1, 3, "user", " ")] * 2000
    pieces = co.repair(spark.createDataFrame(rows, SCHEMA).repartition(4), chunk_rows=8)
    assert pieces.count() == 1
    assert got(co.sums(pieces)) == {1: (0, 2000, 2999, 0, 5000 - 2, 3 * 4999, "K" + "D" * 2999 + "K" + "D" * 2000,
                                        hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest())}


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert got(co.sums(co.repair(co.damage(empty), everyone=empty))) == {}
    rows = [(7, 0, "user", "A."), (7, 1, "assistant", "B.")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS part", "2 AS seq", "3 AS kind", "4 AS n", "5 AS row", "6 AS blank", "7 AS digest", "8 AS _times")
    assert got(co.sums(co.repair(df))) == of(rows)
    assert co.damage(df).columns == ["conv_id", "turn", "role", "text"]
    assert got(co.sums(co.repair(df.where("turn < 0"), everyone=df))) == {
        7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_long_texts_cut_chunks(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t} " + "word " * 300_000 + ".") for t in range(8)]
    pieces = co.repair(spark.createDataFrame(rows, SCHEMA))
    assert pieces.count() > 1
    assert got(co.sums(pieces)) == of(rows)


def test_damage(spark):
    import zlib

    rows = [(c, t if t else None, "assistant", None if t == 3 else "a. b! c?") for c in range(30) for t in range(8)] + [(None, 1, None, "x.")]
    wanted = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()
        fate = zlib.crc32(key) % 20
        role, text = role or " ", " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        wanted += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    found = [tuple(r) for r in co.damage(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
