"""Secrets by fixed patterns, and by probabilistic automata inferred from labelled credentials.

Grammar inference: the credentials that the fixed patterns find are the labelled examples. For each
kind a prefix tree is built over character classes; states whose futures are statistically alike
(Hoeffding bound on every outgoing frequency, recursively) are merged, and the result is a
probabilistic deterministic automaton. Every candidate string of every text is then scored by how
much likelier its format is under an automaton than under one inferred from ordinary words; those
above the threshold that no fixed pattern covers become further spans. All fixed spans stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.text import map_documents
from docledger.session import fresh_dir

#: Fixed patterns: kind, expression, group whose length counts, its least length.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
ORDER = {kind: i for i, (kind, _, _, _) in enumerate(BASE)} | {"format": len(BASE)}
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Labelled credentials of a kind that an automaton is fitted on, the first by a hash of the text.
EXAMPLES = 4000
ALPHA = 0.05
#: A labelled string teaches with its first characters; scoring reads all of a candidate.
MOST_CHARS = 256
#: Log probability of a symbol that a state has not seen, alike in all automata.
UNSEEN = math.log(1e-5)
#: Mean log likelihood ratio per character (natural logarithm) from which a candidate is a secret.
THRESHOLD = 0.5
SPAN = "struct<kind:string,start:int,end:int,score:double>"


def symbols(text: str) -> str:
    """Character classes: a-f, other lower case, A-F, other upper case, digit, and each sign itself."""
    return "".join("h" if "a" <= c <= "f" else "l" if "g" <= c <= "z" else "H" if "A" <= c <= "F" else
                   "L" if "G" <= c <= "Z" else "9" if c.isdigit() else c for c in text)


class Automaton:
    """Transitions ``state -> symbol -> (state, log probability)`` and log end probabilities."""

    def __init__(self, steps: list[dict], ends: list[float], unknown: float):
        self.steps, self.ends, self.unknown = steps, ends, unknown

    def score(self, word: str) -> float:
        state, total = 0, 0.0
        for c in word:
            state, p = self.steps[state].get(c, (0, self.unknown))
            total += p
        return total + self.ends[state]


def infer(words: list[str], alpha: float = ALPHA, alphabet: int = 68) -> Automaton:
    """State merging over the prefix tree of ``words`` (red-blue order, Hoeffding compatibility)."""
    step: list[dict[str, int]] = [{}]
    passed, ended, used = [0], [0], [defaultdict(int)]
    for word in words:
        at = 0
        for c in word:
            passed[at] += 1
            used[at][c] += 1
            if c not in step[at]:
                step[at][c] = len(step)
                step.append({})
                passed.append(0)
                ended.append(0)
                used.append(defaultdict(int))
            at = step[at][c]
        passed[at] += 1
        ended[at] += 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(a: int, n: int, b: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(a / n - b / m) > bound * (n ** -0.5 + m ** -0.5)

    def alike(a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            if a == b:
                continue
            if differ(ended[a], passed[a], ended[b], passed[b]):
                return False
            for c in used[a].keys() | used[b].keys():
                if differ(used[a].get(c, 0), passed[a], used[b].get(c, 0), passed[b]):
                    return False
                if c in step[a] and c in step[b]:
                    pairs.append((step[a][c], step[b][c]))
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree below ``b`` to state ``a``."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            if a == b:
                continue
            passed[a] += passed[b]
            ended[a] += ended[b]
            for c, n in used[b].items():
                used[a][c] += n
            for c, to in step[b].items():
                if c in step[a]:
                    pairs.append((step[a][c], to))
                else:
                    step[a][c] = to

    red, seen = [0], {0}
    blue = [(0, c, to) for c, to in sorted(step[0].items())]
    while blue:
        # The most frequent first: its statistics are the surest.
        blue.sort(key=lambda x: (-passed[x[2]], x[0], x[1]))
        source, c, state = blue.pop(0)
        into = next((r for r in red if alike(r, state)), None)
        if into is None:
            red.append(state)
            seen.add(state)
        else:
            step[source][c] = into
            fold(into, state)
        blue = [(r, c, to) for r in red for c, to in sorted(step[r].items()) if to not in seen]
    number = {state: i for i, state in enumerate(red)}
    steps, ends = [], []
    for state in red:
        total = passed[state] + 0.1 * (alphabet + 1)
        steps.append({c: (number[to], math.log((used[state][c] + 0.1) / total))
                      for c, to in step[state].items()})
        ends.append(math.log((ended[state] + 0.1) / total))
    return Automaton(steps, ends, UNSEEN)


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Kind, start and end of each fixed match, and the credential itself."""
    return [(kind, found.start(), found.end(), found[group])
            for kind, pattern, group, least in BASE for found in pattern.finditer(text)
            if len(found[group]) >= least]


def _candidates(text: str, found: list[tuple]) -> list[tuple[int, int, str]]:
    """Long strings that no fixed match touches."""
    taken = sorted((start, end) for _, start, end, _ in found)
    out, i, reach = [], 0, -1
    for m in CANDIDATE.finditer(text):
        while i < len(taken) and taken[i][0] < m.end():
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= m.start():
            out.append((m.start(), m.end(), m[0]))
    return out


def _rank(word: str) -> bytes:
    return hashlib.blake2b(word.encode(), digest_size=8).digest()


def _smallest(words: set[str], most: int) -> set[str]:
    return words if len(words) <= most else set(sorted(words, key=_rank)[:most])


def labelled(docs: DataFrame, examples: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``kind, word, rank``: of each task, the credentials and ordinary strings of smallest rank."""
    def each(documents):
        kept: dict[str, set[str]] = defaultdict(set)
        for _, raw in documents:
            text = raw.decode()
            found = base_spans(text)
            for kind, _, _, value in found:
                kept[kind].add(value[:MOST_CHARS])
            for _, _, value in _candidates(text, found):
                kept["plain"].add(value[:MOST_CHARS])
            for kind, words in kept.items():
                if len(words) > 4 * examples:
                    kept[kind] = _smallest(words, examples)
        for kind, words in kept.items():
            for word in _smallest(words, examples):
                yield kind, word, _rank(word)

    return map_documents(docs, "kind string, word string, rank binary", each, id_col, text_col)


def learn(docs: DataFrame, examples: int = EXAMPLES, id_col: str = "doc_id",
          text_col: str = "text") -> dict[str, Automaton]:
    """An automaton for each kind, and ``plain``, each from at most ``examples`` distinct strings.

    The sample is the strings with the smallest hash, whatever the size of the corpus: every task
    reads all its texts and keeps its smallest, and of these the smallest overall reach the driver.
    """
    spark = docs.sparkSession
    path = fresh_dir(spark, "labelled")
    labelled(docs, examples, id_col, text_col).write.parquet(path)
    found = spark.read.parquet(path)
    models = {}
    for kind in [kind for kind, _, _, _ in BASE] + ["plain"]:
        rows = (found.where(F.col("kind") == kind).select("rank", "word").distinct()
                .orderBy("rank").limit(examples).collect())
        words = sorted(symbols(row.word) for row in rows)
        if kind == "plain":  # a prior, so that there is an ordinary model without any example
            words += ["l" * n for n in range(16, 32)] + ["L" + "l" * n for n in range(15, 31)]
        if words:
            models[kind] = infer(words)
    return models


def format_score(word: str, models: dict[str, Automaton]) -> float:
    """Log likelihood ratio per character of the best credential automaton against ``plain``."""
    classes = symbols(word)
    kinds = [m for kind, m in models.items() if kind != "plain"]
    if not kinds:
        return -math.inf
    return (max(m.score(classes) for m in kinds) - models["plain"].score(classes)) / len(classes)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in
                    sorted(spans, key=lambda s: (s[1], ORDER[s[0]], s[2])))


def find_secrets(docs: DataFrame, models: dict[str, Automaton], threshold: float = THRESHOLD,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the spans with their score, counts and digests.

    Columns: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, found``; ``found`` holds the
    spans as an array, fixed matches with a null score. A span is the whole match, in code points,
    end exclusive. A null or empty text has none; a null id stays null; repeated rows get the same
    result; other columns are not read. No shuffle; the automata are bounded by their examples.
    """
    known = docs.sparkSession.sparkContext.broadcast(models)

    def each(documents):
        automata = known.value
        for doc_id, raw in documents:
            text = raw.decode()
            found = base_spans(text)
            fixed = [span[:3] for span in found]
            scored = [(start, end, format_score(value, automata))
                      for start, end, value in _candidates(text, found)]
            more = [("format", start, end, score) for start, end, score in scored if score >= threshold]
            kinds = [kind for kind, _, _ in fixed]
            spans = sorted([(*span, None) for span in fixed] + more, key=lambda s: (s[1], ORDER[s[0]]))
            yield (doc_id, kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                   hashlib.sha256(digest(fixed).encode()).hexdigest(),
                   digest([span[:3] for span in spans]),
                   [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans])

    return map_documents(
        docs, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
        f"spans string, found array<{SPAN}>", each, id_col, text_col)


def scan(docs: DataFrame, examples: int = EXAMPLES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``find_secrets`` with automata learned from the same texts."""
    models = learn(docs, examples, id_col, text_col)
    return find_secrets(docs, models, threshold, id_col, text_col)
