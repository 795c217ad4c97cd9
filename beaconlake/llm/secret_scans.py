"""Secrets: three base patterns, and a grammar of credentials inferred from examples.

The grammar is a probabilistic automaton over character classes, inferred as by ALERGIA: labelled
credentials build a prefix tree with counts; states whose endings and continuations are
statistically compatible (Hoeffding bound, recursively) are merged, red-blue order. A second one is
inferred from all strings of the corpus that no base rule marks. A candidate is a run of LEAST
or more token characters with a digit and a letter in it; a bare number is none. Its format likelihood
is the difference of the mean log-probabilities per character under both. Candidates that reach the
threshold and overlap no base span become spans of kind `format`.

Labelled credentials are the values of base matches that would be candidates themselves, of which a
documented, bounded sample (EXAMPLES, the first by hash) is learned from; unmarked strings are the
other distinct candidates, and all count. An unmarked string that is as likely as the labelled ones
may be a credential and is set aside, unless its format is common: a format is the string with each
run of letters and digits as its length and sort, and a common one has over COMMON times as many
unmarked strings as labelled ones. Of the others Spark counts the prefixes, to a depth of
LONGEST_EXAMPLE; a prefix that less than one in RESOLUTION of them have is a leaf of the tree. The
threshold lets at most FALSE_SHARE of them pass, by a histogram of all their scores. Every candidate
of every whole text is scored.

Cases: a null or empty text has no spans. Without examples of either sort nothing is added. Rows
that repeat are scanned alike. Only `doc_id` and `text` are read. Offsets are code points.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import saved

# The base patterns, on UTF-8 bytes, where only ASCII letters have two cases.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KEYWORDS = (b"passw", b"secret", b"token", b"api")
KINDS = ("assign", "access", "hex", "format")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

LEAST = 16
EXAMPLES = 400
ALPHA = 0.05
FALSE_SHARE = 0.002
LONGEST_EXAMPLE = 256
RESOLUTION = 1000
COMMON = 20
# Scores are counted in steps of this width for the threshold.
STEP = 0.001
# Distinct prefixes that a task holds before it passes their counts on.
HELD = 200_000
_END = -1
_DIGIT, _LETTER = re.compile(rb"[0-9]"), re.compile(rb"[A-Za-z]")
_RUN, _BEYOND_HEX = re.compile(rb"[A-Za-z0-9]+"), re.compile(rb"[^0-9a-f]")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def _token_bytes() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
    return inside


def _classes() -> bytes:
    """Digits, a-f, other small letters, A-F, other capitals; other signs stand for themselves."""
    table = bytearray(range(256))
    for low, high, sign in (("0", "9", "9"), ("a", "f", "h"), ("g", "z", "l"),
                            ("A", "F", "H"), ("G", "Z", "L")):
        for c in range(ord(low), ord(high) + 1):
            table[c] = ord(sign)
    return bytes(table)


CLASSES = _classes()


def long_runs(batch_texts: pa.Array) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """The bytes of each text, and its runs of LEAST or more token characters with a digit."""
    inside = _token_bytes()
    for chunk in tb.chunks(batch_texts):
        runs = tb.words(chunk, inside)
        digits = np.concatenate([[0], np.cumsum((chunk.buf >= 48) & (chunk.buf <= 57))])
        letters = np.concatenate([[0], np.cumsum((chunk.buf >= 65) & (chunk.buf <= 122))])
        size = runs.end - runs.start
        # Runs of a-f alone are hexadecimal as well.
        wanted = (size >= LEAST) & ((digits[runs.end] > digits[runs.start])
                                    | (letters[runs.end] - letters[runs.start] >= LEAST_ACCESS))
        doc, start, end = runs.doc[wanted], runs.start[wanted], runs.end[wanted]
        first = np.searchsorted(doc, np.arange(len(chunk.offsets)))
        raw, at = chunk.buf.tobytes(), chunk.offsets.tolist()
        for i in range(len(at) - 1):
            own = slice(first[i], first[i + 1])
            yield raw[at[i]: at[i + 1]], list(zip((start[own] - at[i]).tolist(),
                                                  (end[own] - at[i]).tolist()))


def base_spans(raw: bytes, runs: list[tuple[int, int]]) -> tuple[list[Span], list[bytes]]:
    """Base spans in bytes, and the values that they mark."""
    spans, values = [], []
    low = raw.lower()
    if any(word in low for word in KEYWORDS):
        for m in ASSIGN.finditer(raw):
            if m.end(2) - m.start(2) >= LEAST_VALUE:
                spans.append(Span("assign", m.start(), m.end()))
                values.append(m.group(2))
    for start, end in runs:
        for kind, pattern, least in (("access", ACCESS, LEAST_ACCESS), ("hex", HEX, LEAST_HEX)):
            for m in pattern.finditer(raw, start, end):
                if m.end() - m.start() >= least:
                    spans.append(Span(kind, m.start(), m.end()))
                    values.append(m.group())
    return spans, values


def is_candidate(value: bytes) -> bool:
    return len(value) >= LEAST and _DIGIT.search(value) is not None and _LETTER.search(value) is not None


def free_candidates(raw: bytes, runs: list[tuple[int, int]], spans: list[Span]) -> list[tuple[int, int]]:
    return [(a, b) for a, b in runs if is_candidate(raw[a:b])
            and not any(s.start < b and a < s.end for s in spans)]


def format_of(value: bytes) -> bytes:
    """Each run of letters and digits as its length and sort: digits, letters, hexadecimal, mixed."""
    def run(m: re.Match) -> bytes:
        x = m.group()
        sort = b"9" if x.isdigit() else b"l" if x.isalpha() else b"h" if not _BEYOND_HEX.search(x) else b"m"
        return str(len(x)).encode() + sort
    return _RUN.sub(run, value)


_ROOT = 0


def _below(name: int, sign: int) -> int:
    """The name of the prefix that is one sign longer; alike in all processes."""
    return hash((name, sign))


class Automaton:
    """States with counts: how often each was reached, left by each class, or was the last."""

    def __init__(self, examples: list[bytes], alpha: float = ALPHA):
        self.next: list[dict[int, int]] = [{}]
        self.seen: list[dict[int, int]] = [{}]
        for example in examples:
            self._add(example.translate(CLASSES)[:LONGEST_EXAMPLE])
        self.spread = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()

    @classmethod
    def of_counts(cls, counts: dict[int, dict[int, int]]) -> Automaton:
        """From how often each sign follows each prefix, by the prefix's name."""
        tree = cls([])
        tree.seen[0] = dict(counts.get(_ROOT, {}))
        todo = [(0, _ROOT)]
        while todo:
            state, name = todo.pop()
            for sign in sorted(tree.seen[state].keys() - {_END}):
                tree.next[state][sign] = len(tree.next)
                below = _below(name, sign)
                todo.append((len(tree.next), below))
                tree.next.append({})
                tree.seen.append(dict(counts.get(below, {})))
        tree._merge_states()
        return tree

    def _add(self, signs: bytes) -> None:
        state = 0
        for sign in signs:
            self.seen[state][sign] = self.seen[state].get(sign, 0) + 1
            if sign not in self.next[state]:
                self.next[state][sign] = len(self.next)
                self.next.append({})
                self.seen.append({})
            state = self.next[state][sign]
        self.seen[state][_END] = self.seen[state].get(_END, 0) + 1

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the two may be one state, and so what follows them."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = sum(self.seen[a].values()), sum(self.seen[b].values())
            if not n or not m:
                continue
            bound = self.spread * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            for sign in self.seen[a].keys() | self.seen[b].keys():
                if abs(self.seen[a].get(sign, 0) / n - self.seen[b].get(sign, 0) / m) > bound:
                    return False
            # What few examples follow cannot differ from anything.
            todo += [(self.next[a][s], self.next[b][s]) for s in self.next[a].keys() & self.next[b].keys()
                     if (self.next[a][s], self.next[b][s]) != (a, b) and bound < 1]
        return True

    def _fold(self, into: int, state: int) -> None:
        """Add the tree below `state` to the automaton from `into` on."""
        todo = [(into, state)]
        while todo:
            into, state = todo.pop()
            for sign, count in self.seen[state].items():
                self.seen[into][sign] = self.seen[into].get(sign, 0) + count
            for sign, target in self.next[state].items():
                if sign in self.next[into]:
                    todo.append((self.next[into][sign], target))
                else:
                    self.next[into][sign] = target

    def _merge_states(self) -> None:
        red, settled = [0], {0}
        while True:
            blue = [(r, sign, t) for r in red for sign, t in sorted(self.next[r].items()) if t not in settled]
            if not blue:
                return
            parent, sign, state = max(blue, key=lambda x: sum(self.seen[x[2]].values()))
            for r in red:
                if self._compatible(r, state):
                    self.next[parent][sign] = r
                    self._fold(r, state)
                    break
            else:
                red.append(state)
                settled.add(state)

    def mean_log(self, value: bytes) -> float:
        """Mean log-probability per class; what was never seen has half an observation."""
        state, total, kinds = 0, 0.0, 64
        signs = [*value.translate(CLASSES), _END]
        for i, sign in enumerate(signs):
            seen = self.seen[state] if state >= 0 else {}
            total += math.log((seen.get(sign, 0) + 0.5) / (sum(seen.values()) + 0.5 * kinds))
            state = self.next[state].get(sign, -1) if state >= 0 and sign != _END else -1
        return total / len(signs)


class Grammar(NamedTuple):
    credentials: Automaton
    others: Automaton
    threshold: float

    def score(self, value: bytes) -> float:
        return self.credentials.mean_log(value) - self.others.mean_log(value)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: set[tuple[bool, bytes]] = set()
        for raw, runs in long_runs(batch.column("text")):
            spans, values = base_spans(raw, runs)
            rows |= {(True, v) for v in values if is_candidate(v)}
            rows |= {(False, raw[a:b]) for a, b in free_candidates(raw, runs, spans)}
        ordered = sorted(rows)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in ordered], pa.bool_()),
                                          pa.array([r[1] for r in ordered], pa.binary()),
                                          pa.array([format_of(r[1]) for r in ordered], pa.binary())],
                                         names=["secret", "value", "format"])


def _prefixes(credentials: Automaton, usual: float):
    """How often each sign follows each prefix of the strings that are unlike credentials."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[int, int]] = Counter()
        for batch in batches:
            for value, common in zip(batch.column("value").to_pylist(), batch.column("common").to_pylist()):
                if not common and credentials.mean_log(value) >= usual:
                    continue
                name = _ROOT
                for sign in [*value.translate(CLASSES), _END][:LONGEST_EXAMPLE]:
                    counts[name, sign] += 1
                    name = _below(name, sign)
                if len(counts) > HELD:
                    yield _rows(counts)
                    counts.clear()
        yield _rows(counts)

    def _rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.int64()), pa.array([k[1] for k in counts], pa.int32()),
             pa.array(list(counts.values()), pa.int64())], names=["name", "sign", "n"])
    return run


def _steps(grammar: Grammar, usual: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for value, common in zip(batch.column("value").to_pylist(), batch.column("common").to_pylist()):
                likely = grammar.credentials.mean_log(value)
                if common or likely < usual:
                    counts[math.floor((likely - grammar.others.mean_log(value)) / STEP)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()),
                                          pa.array(list(counts.values()), pa.int64())], names=["step", "n"])
    return run


def infer(docs: DataFrame, examples: int = EXAMPLES) -> Grammar | None:
    """The grammar, or None without examples of both sorts."""
    found = saved(docs.select("text").mapInArrow(
        _examples, "secret boolean, value binary, format binary").distinct())
    labelled = [bytes(r["value"]) for r in found.where("secret").orderBy(
        F.xxhash64("value"), "value").limit(examples).select("value").collect()]
    if not labelled:
        return None
    credentials = Automaton(labelled)
    # An unmarked string that is as likely as labelled credentials is no counter-example.
    usual = sorted(credentials.mean_log(v) for v in labelled)[len(labelled) // 20]
    formats = found.groupBy("format").agg((
        F.count_if(~F.col("secret")) > COMMON * (F.count_if("secret") + 1)).alias("common"))
    others = saved(found.where("not secret").join(formats, "format").select("value", "common"))
    counts = saved(others.mapInArrow(_prefixes(credentials, usual), "name long, sign int, n long").groupBy(
        "name", "sign").agg(F.sum("n").alias("n")))
    total = counts.where(F.col("name") == _ROOT).agg(F.sum("n")).first()[0]
    if not total:
        return None
    kept = counts.groupBy("name").agg(F.sum("n").alias("n"), F.collect_list(F.struct("sign", "n")).alias("after")).where(
        F.col("n") * RESOLUTION >= total).collect()
    free = Grammar(credentials, Automaton.of_counts(
        {r["name"]: {s["sign"]: s["n"] for s in r["after"]} for r in kept}), 0.0)
    steps = others.mapInArrow(_steps(free, usual), "step long, n long").groupBy("step").agg(
        F.sum("n").alias("n")).orderBy(F.desc("step")).collect()
    passed = 0
    for r in steps:
        passed += r["n"]
        if passed > int(total * FALSE_SHARE):
            return free._replace(threshold=max(0.0, (r["step"] + 1) * STEP))
    return free


def _places(raw: bytes, spans: list[Span]) -> list[Span]:
    """The spans in code points."""
    if raw.isascii() or not spans:
        return spans
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [Span(s.kind, int(points[s.start]), int(points[s.end])) for s in spans]


def _written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in sorted(
        spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end)))


def _scanner(grammar: Grammar | None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw, runs in long_runs(batch.column("text")):
                base, _ = base_spans(raw, runs)
                added = [] if grammar is None else [
                    Span("format", a, b) for a, b in free_candidates(raw, runs, base)
                    if grammar.score(raw[a:b]) > grammar.threshold]
                known, more = _places(raw, base), _places(raw, added)
                counts = [sum(s.kind == kind for s in known) for kind in KINDS]
                rows.append((*counts, hashlib.sha256(_written(known).encode()).hexdigest(),
                             _written(known + more)))
            columns = list(zip(*rows)) or [[]] * 6
            columns[3] = [len(s.split("format:")) - 1 for s in columns[5]]
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans"])
    return scan


def scanned(docs: DataFrame) -> DataFrame:
    """One row per row of docs: `doc_id`, `n_assign`, `n_access`, `n_hex`, `n_format`,
    `base_sha256`, `spans`."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_scanner(infer(texts)), (
        "doc_id long, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, "
        "spans string"))
