"""Personal data: four base patterns, and a linear-chain conditional random field.

The field tags tokens (runs of anything but white space) as O or as one of the kinds, from hashed
word-shape features: the token's shape and squeezed shape, its length, and the shapes beside it.
Its chain is a stretch of text: the tokens that hold a digit or `@` with NEAR tokens on either
side, overlapping ones joined; what is outside is O, as personal data of these kinds cannot do
without either sign. It is trained by gradient descent on the conditional likelihood of a small
labelled table of two parts. LABELLED is written by hand: spellings that the base patterns miss, and
numbers that look like them. The distinct chains of the corpus, tagged by the base spans, are dealt by
the set of kinds in them, of each set the first CHAINS by hash are taken, and each weighs as many as
it stands for; the hand-written part weighs LABELLED_SHARE of them together. Chains with a token
that has an `@` or a card's checksum but no base span are not learned from, as nobody labelled them. All chains of all texts are
decoded by Viterbi, in numpy over many chains at once. Tagged runs that overlap no base span are
added if they hold what their kind needs: a card number its checksum, an address four numbers up
to 255, a phone 8 to 15 digits, an e-mail a sign before its domain.

Cases: a null or empty text has no spans. Tokens count whole, and chains of any length are decoded
whole; only to learn from they are cut into stretches of LONGEST tokens. Without
any chain in the corpus nothing is added. Rows that repeat are scanned alike. Only `doc_id` and
`text` are read. Offsets are code points.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import saved

KINDS = ("email", "ip", "card", "phone")
# The base patterns, on UTF-8 bytes. A digit run is looked at from its start only,
# as a match that fails there fails inside it as well.
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")

NEAR = 2
LONGEST = 64
CHAINS = 600
FEATURES = 1 << 13
TAGS = len(KINDS) + 1
STEPS = 120
RATE = 0.1
SHRINK = 1e-3
CELLS = 1 << 17
LABELLED_SHARE = 1.0
# The hand-labelled part of the table. Marked is what the kind before it means.
LABELLED = """
call me at phone[0171 2345678] tomorrow
my number is phone[0049 30 12345678] thanks
phone[030 / 123 456 78] is the office
reach us under phone[(030) 123-45678] or
tel phone[0171/2345678] abends
ring phone[555-867-5309] after six
fax phone[040-1234567] und
mobile phone[0664 123 45 67] bitte
the card is card[4111.1111.1111.1111] and
paid with card[4111 / 1111 / 1111 / 1111] today
card number card[5500_0000_0000_0004] valid
visa card[4012  8888  8888  1881] ok
amex and card[6011.1111.1111.1117] both
write to email[anna @ example.org] please
mail email[jan.berg @ post.example.com] now
contact email[info@ example.net] or
send it to email[kontakt @haus.example] bald
host ip[10 . 0 . 0 . 12] answers
from ip[192. 168. 0. 17] again
at ip[172 .16 .254 .1] port
order 2023-1234567 was sent
invoice 4711 0815 from may
paid 1234.50 for 12 items
on 2024-05-17 at 10.30 we met
version 3.14.159 is out
pages 120 to 345 of 1024
isbn 978-3-16-148410-0 in stock
between 1914 and 1918 there
he scored 21 of 25 points
room 12 . 4 on floor 3
code 0000 1111 2222 3333 is void
number 1234567890123456 is a lot
serial 9876543210987654 on it
meet @ 10 or @ 12 today
about 30 000 people in 2021
see table 4 . 2 and 4 . 3
"""


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def _emails(raw: bytes) -> Iterator[Span]:
    """Leftmost matches, found from their `@`."""
    done, at = 0, raw.find(b"@")
    while at >= 0:
        start = at
        while start > done and raw[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(raw, at + 1) if start < at else None
        if m:
            yield Span("email", start, m.end())
            done = m.end()
        at = raw.find(b"@", max(at + 1, done))


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(value: bytes) -> bytes:
    return bytes(c for c in value if 48 <= c <= 57)


def base_spans(raw: bytes) -> list[Span]:
    """Base spans in bytes, by kind and start."""
    spans = list(_emails(raw)) if b"@" in raw else []
    spans += [Span("ip", m.start(), m.end()) for m in IP.finditer(raw)
              if all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in m.group().split(b"."))]
    for m in CARD.finditer(raw):
        digits = _digits(m.group()) if m.end() - m.start() >= 16 else b""
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(Span("card", m.start(), m.end()))
    if b"+" in raw:
        spans += [Span("phone", m.start(), m.end()) for m in PHONE.finditer(raw)
                  if 8 <= len(_digits(m.group())) <= 15]
    return spans


def _signs() -> tuple[np.ndarray, bytes]:
    telling = np.zeros(256, bool)
    telling[list(b"0123456789@")] = True
    shape = bytearray(range(256))
    for low, high, sign in ((48, 57, "9"), (65, 90, "A"), (97, 122, "a"), (128, 255, "u")):
        for c in range(low, high + 1):
            shape[c] = ord(sign)
    return telling, bytes(shape)


SQUEEZE = re.compile(rb"(.)\1+", re.S)


def chains(texts: pa.Array) -> Iterator[tuple[bytes, list[list[tuple[int, int]]]]]:
    """The bytes of each text, and its chains: lists of tokens (start, end)."""
    telling, _ = _signs()
    for chunk in tb.chunks(texts):
        words = tb.words(chunk)
        signs = np.concatenate([[0], np.cumsum(telling[chunk.buf])])
        near = np.flatnonzero(signs[words.end] > signs[words.start])
        doc = words.doc
        raw, at = chunk.buf.tobytes(), chunk.offsets.tolist()
        spots: list[list[int]] = [[] for _ in range(len(at) - 1)]
        for d, i in zip(doc[near].tolist(), near.tolist()):
            spots[d].append(i)
        for d, own in enumerate(spots):
            found: list[list[tuple[int, int]]] = []
            low, high = int(words.first[d]), int(words.first[d + 1])
            reach = -1
            for i in own:
                a, b = max(low, i - NEAR), min(high, i + NEAR + 1)
                if a > reach or not found:
                    found.append([])
                    reach = a
                for j in range(max(a, reach), b):
                    found[-1].append((int(words.start[j]) - at[d], int(words.end[j]) - at[d]))
                reach = max(reach, b)
            yield raw[at[d]: at[d + 1]], found


PER_TOKEN = 6


def _token_features(raw: bytes, tokens: list[tuple[int, int]], shape: bytes) -> np.ndarray:
    """(tokens, PER_TOKEN) hashed features."""
    shapes = [raw[a:b].translate(shape) for a, b in tokens]
    short = [SQUEEZE.sub(rb"\1", s) for s in shapes]
    out = np.zeros((len(tokens), PER_TOKEN), np.int64)
    for i, s in enumerate(shapes):
        before = short[i - 1] if i else b"^"
        after = short[i + 1] if i + 1 < len(short) else b"$"
        digits = s.count(b"9")
        sums = 16 <= digits <= 19 and luhn(_digits(raw[tokens[i][0]: tokens[i][1]]))
        names = (b"s" + s, b"q" + short[i], b"p" + before, b"n" + after,
                 b"l%d,%d,%d" % (min(len(s), 24), digits, sums), b"b" + before + b" " + short[i])
        out[i] = [zlib.crc32(n) % FEATURES for n in names]
    return out


class Field(NamedTuple):
    weights: np.ndarray  # (FEATURES, TAGS)
    moves: np.ndarray  # (TAGS, TAGS), from and to


def _padded(chains_: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(c) for c in chains_])
    whole = np.zeros((len(chains_), sizes.max(), PER_TOKEN), np.int64)
    for row, c in zip(whole, chains_):
        row[: len(c)] = c
    return whole, sizes


def viterbi(field: Field, chains_: list[np.ndarray]) -> list[np.ndarray]:
    """Best tags of each chain, all chains of the batch step by step."""
    features, sizes = _padded(chains_)
    score = sum(field.weights[features[:, :, k]] for k in range(PER_TOKEN))
    best, back = score[:, 0], np.zeros(score.shape, np.int8)
    for t in range(1, score.shape[1]):
        ways = best[:, :, None] + field.moves
        back[:, t] = ways.argmax(axis=1)
        on = (t < sizes)[:, None]
        best = np.where(on, ways.max(axis=1) + score[:, t], best)
    tags = np.zeros(score.shape[:2], np.int8)
    tag = best.argmax(axis=1)
    rows = np.arange(len(sizes))
    for t in range(score.shape[1] - 1, -1, -1):
        on = t < sizes
        tags[on, t] = tag[on]
        tag = np.where(on & (t > 0), back[rows, t, tag], tag)
    return [row[:n] for row, n in zip(tags, sizes)]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _gradient(field: Field, features: np.ndarray, sizes: np.ndarray, tags: np.ndarray,
              weight: np.ndarray | None = None):
    """Of the mean log-likelihood: expected less observed counts, by forward and backward sums."""
    n, length = features.shape[:2]
    each = np.full(n, 1 / n) if weight is None else weight / weight.sum()
    score = field.weights[features].sum(axis=2)
    ahead, behind = np.zeros_like(score), np.zeros_like(score)
    ahead[:, 0] = score[:, 0]
    for t in range(1, length):
        step = _log_sum(ahead[:, t - 1, :, None] + field.moves, 1) + score[:, t]
        ahead[:, t] = np.where((t < sizes)[:, None], step, ahead[:, t - 1])
    whole = _log_sum(ahead[:, -1], 1)
    for t in range(length - 2, -1, -1):
        step = _log_sum(field.moves + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where((t + 1 < sizes)[:, None], step, 0.0)
    on = np.arange(length) < sizes[:, None]
    own = np.exp(ahead + behind - whole[:, None, None]) * on[:, :, None]
    held = np.eye(TAGS)[tags] * on[:, :, None]
    slope = (own - held) * each[:, None, None]
    weights = np.stack([np.bincount(
        features.reshape(-1), np.repeat(slope[:, :, k].reshape(-1), PER_TOKEN), FEATURES)
        for k in range(TAGS)], axis=1)
    moves = np.zeros((TAGS, TAGS))
    for t in range(1, length):
        there = (t < sizes)
        pair = np.exp(ahead[:, t - 1, :, None] + field.moves + (score[:, t] + behind[:, t])[:, None, :]
                      - whole[:, None, None])
        moves += (pair[there] * each[there, None, None]).sum(axis=0)
        np.add.at(moves, (tags[there, t - 1], tags[there, t]), -each[there])
    return weights, moves


def fit(chains_: list[np.ndarray], tags: list[np.ndarray], weight: np.ndarray) -> Field:
    features, sizes = _padded(chains_)
    held = np.zeros(features.shape[:2], np.int64)
    for row, t in zip(held, tags):
        row[: len(t)] = t
    field = Field(np.zeros((FEATURES, TAGS)), np.zeros((TAGS, TAGS)))
    sums = [np.zeros_like(x) for x in field]
    for _ in range(STEPS):  # AdaGrad
        slopes = _gradient(field, features, sizes, held, weight)
        moved = []
        for x, g, s in zip(field, slopes, sums):
            g = g + SHRINK * x / 100
            s += g * g
            moved.append(x - RATE * 5 * g / (np.sqrt(s) + 1e-8))
        field = Field(*moved)
    return field


def _tags(tokens: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    out = np.zeros(len(tokens), np.int64)
    ends = [b for _, b in tokens]
    for s in spans:
        i = bisect_right(ends, s.start)
        while i < len(tokens) and tokens[i][0] < s.end:
            out[i] = KINDS.index(s.kind) + 1
            i += 1
    return out


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _, shape = _signs()
    for batch in batches:
        rows: set[tuple[bytes, bytes]] = set()
        for raw, found in chains(batch.column("text")):
            spans = base_spans(raw) if found else []
            for tokens in found:
                features = _token_features(raw, tokens, shape).astype(np.int16)
                tags = _tags(tokens, spans).astype(np.int8)
                if any(t == 0 and (b"@" in raw[a:b] or b - a >= 16 and holds("card", raw[a:b]))
                       for t, (a, b) in zip(tags, tokens)):
                    continue
                for at in range(0, len(tokens), LONGEST):
                    rows.add((features[at: at + LONGEST].tobytes(), tags[at: at + LONGEST].tobytes()))
        ordered = sorted(rows)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in ordered], pa.binary()),
                                          pa.array([r[1] for r in ordered], pa.binary())],
                                         names=["features", "tags"])


def _first_of_sides(limit: int):
    """Of each set of kinds the task's first `limit` chains by hash, and how many it has (`n`, in
    one of the rows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, list[tuple]] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("hash", "features", "tags"))):
                side = sum(1 << tag for tag in set(row[2]) - {0})
                counts[side] = counts.get(side, 0) + 1
                own = sides.setdefault(side, [])
                own.append(row)
                if len(own) >= 2 * limit:
                    own[:] = sorted(own)[:limit]
        rows = [(side, counts[side] if i == 0 else 0, *row) for side, own in sorted(sides.items())
                for i, row in enumerate(sorted(own)[:limit])]
        columns = list(zip(*rows)) or [[]] * 5
        types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         names=["side", "n", "hash", "features", "tags"])
    return run


def training_sample(docs: DataFrame, limit: int = CHAINS) -> list[tuple[bytes, bytes, float]]:
    """Features, tags and weight of the sampled chains."""
    rows = docs.select("text").mapInArrow(_training_rows, "features binary, tags binary").distinct()
    first = saved(rows.select(F.xxhash64("features").alias("hash"), "features", "tags").mapInArrow(
        _first_of_sides(limit), "side int, n long, hash long, features binary, tags binary"))
    out = []
    for side, n in sorted(first.groupBy("side").agg(F.sum("n")).collect()):
        own = first.where(F.col("side") == side).orderBy("hash", "features", "tags").limit(limit).collect()
        out += [(bytes(r["features"]), bytes(r["tags"]), n / len(own)) for r in own]
    return out


_MARKED = re.compile(r"(\w+)\[([^\]]*)\]")


def labelled_chains() -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and tags of the hand-labelled part of the table."""
    _, shape = _signs()
    out = []
    for line in LABELLED.strip().splitlines():
        text, spans, at = "", [], 0
        for m in _MARKED.finditer(line):
            text += line[at: m.start()]
            spans.append(Span(m.group(1), len(text), len(text) + len(m.group(2))))
            text, at = text + m.group(2), m.end()
        raw = (text + line[at:]).encode()
        (_, found), = chains(pa.array([raw.decode()]))
        for tokens in found:
            out.append((_token_features(raw, tokens, shape), _tags(tokens, sorted(spans, key=lambda s: s.start))))
    return out


def train(docs: DataFrame, limit: int = CHAINS) -> Field | None:
    rows = training_sample(docs, limit)
    if not rows:
        return None
    by_hand = labelled_chains()
    weights = np.array([w for _, _, w in rows])
    each = weights.sum() * LABELLED_SHARE / len(by_hand)
    return fit([np.frombuffer(f, np.int16).astype(np.int64).reshape(-1, PER_TOKEN) for f, _, _ in rows]
               + [f for f, _ in by_hand],
               [np.frombuffer(t, np.int8) for _, t, _ in rows] + [t.astype(np.int8) for _, t in by_hand],
               np.concatenate([weights, np.full(len(by_hand), each)]))


_NUMBER = re.compile(rb"[0-9]+")
_SIGN_AND_DOMAIN = re.compile(rb"[A-Za-z0-9._%+-]\x20*@\x20*[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def holds(kind: str, value: bytes) -> bool:
    """Whether a tagged run has what its kind cannot be without."""
    digits = _digits(value)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "ip":
        numbers = _NUMBER.findall(value)
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    return _SIGN_AND_DOMAIN.search(value) is not None


def _runs(tokens: list[tuple[int, int]], tags: np.ndarray) -> Iterator[Span]:
    """Tokens in a row with the same tag, without the punctuation around them."""
    i = 0
    while i < len(tags):
        j = i
        while j < len(tags) and tags[j] == tags[i]:
            j += 1
        if tags[i]:
            yield Span(KINDS[tags[i] - 1], tokens[i][0], tokens[j - 1][1])
        i = j


def _places(raw: bytes, spans: list[Span]) -> list[Span]:
    if raw.isascii() or not spans:
        return spans
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [Span(s.kind, int(points[s.start]), int(points[s.end])) for s in spans]


def _written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in sorted(
        spans, key=lambda s: (KINDS.index(s.kind), s.start, s.end)))


def _tagged(field: Field | None, features: list[np.ndarray]) -> list[np.ndarray]:
    if field is None:
        return [np.zeros(len(f), np.int8) for f in features]
    out: list = [None] * len(features)
    order = sorted(range(len(features)), key=lambda i: len(features[i]))
    at = 0
    while at < len(order):
        # Chains of much the same length, with at most CELLS tokens when padded, or one chain.
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(features[order[end]]) <= CELLS:
            end += 1
        part, at = order[at:end], end
        for i, tags in zip(part, viterbi(field, [features[i] for i in part])):
            out[i] = tags
    return out


def _scanner(field: Field | None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, shape = _signs()
        for batch in batches:
            texts, features = [], []
            for raw, found in chains(batch.column("text")):
                texts.append((raw if found or b"@" in raw else b"", found))
                features += [_token_features(raw, tokens, shape) for tokens in found]
            tags = iter(_tagged(field, features))
            rows = []
            for raw, found in texts:
                base = base_spans(raw)
                added = [s for tokens in found for s in _runs(tokens, next(tags))
                         if holds(s.kind, raw[s.start:s.end])
                         and not any(b.start < s.end and s.start < b.end for b in base)]
                known, more = _places(raw, base), _places(raw, added)
                rows.append((*[sum(s.kind == kind for s in known) for kind in KINDS],
                             hashlib.sha256(_written(known).encode()).hexdigest(),
                             _written(known + more), len(more)))
            columns = list(zip(*rows)) or [[]] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])
    return scan


def scanned(docs: DataFrame) -> DataFrame:
    """One row per row of docs: `doc_id`, `n_email`, `n_ip`, `n_card`, `n_phone`, `base_sha256`,
    `spans`, `n_added`."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_scanner(train(texts)), (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, n_added long"))
