"""Repeated passages, found from difference-cover anchors.

A passage is WINDOW consecutive words that also start anywhere else. Hashing every window of a
corpus would shuffle one row per word. Instead only positions i with i modulo PERIOD in COVER are
hashed, as anchors of ANCHOR words. COVER is a difference cover: for any two positions there is a
shift below PERIOD that puts both on the cover, and shift + ANCHOR <= WINDOW, so two equal windows
always share an aligned anchor. Anchors that occur once are dropped; only windows around repeated
anchors are then extended: they are hashed whole (127 bits), and those that occur twice are
repeats.

Counting is by (hash, block): a block is a bounded set of documents, so a passage in a third of
all rows sends one row per block, not one per copy. Texts are dealt to blocks once.

Cases: a null or empty text has no words; a text shorter than WINDOW words keeps them all; windows
never cross documents; a window repeated inside one document counts, overlapping or not. Windows
are judged on the input. Rows that repeat a doc_id are documents of their own and each comes out.
Only `doc_id` and `text` are read; other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textbytes as tb

WINDOW = 35
PERIOD = 21
# A perfect difference set modulo 21 (every remainder is a difference of two).
COVER = (0, 1, 4, 14, 16)
ANCHOR = WINDOW - PERIOD + 1
BLOCK_BYTES = 4 << 20
# More blocks than these (200 GB of text) share partitions, and follow each other in a task.
PARTITIONS = 50_000


def _short(h: np.ndarray) -> np.ndarray:
    """48 bits of an anchor's hash: two anchors that agree by chance cost a look, not the result."""
    return h >> np.uint64(16)


class Passages:
    """Hashes of a batch of texts, chunk by chunk."""

    def __init__(self):
        self.one, self.two = tb.Hasher(11), tb.Hasher(12)

    def anchors(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for chunk in tb.chunks(texts):
            words = tb.words(chunk)
            h = self.one.ranges(chunk.buf, words.start, words.end)
            whole, at = tb.window_hashes(h, ANCHOR), _anchor_places(words)
            yield _short(whole[at])

    def windows(self, texts: pa.Array, repeated: np.ndarray) -> Iterator[np.ndarray]:
        """(n, 2) hashes of the windows that hold a repeated anchor."""
        for chunk in tb.chunks(texts):
            words = tb.words(chunk)
            one = self.one.ranges(chunk.buf, words.start, words.end)
            at = _anchor_places(words)
            at = at[_in_sorted(_short(tb.window_hashes(one, ANCHOR)[at]), repeated)]
            first = np.zeros(len(one) + 1, np.int64)  # a window may start PERIOD - 1 words before
            np.add.at(first, np.maximum(at - PERIOD + 1, 0), 1)
            np.add.at(first, at + 1, -1)
            places = np.flatnonzero((np.cumsum(first)[:-1] > 0) & _fits(words, WINDOW))
            yield self._pairs(chunk, words, one, places)

    def covered(self, texts: pa.Array, repeated: np.ndarray):
        """For each chunk: chunk, words and whether each word is in a repeated window."""
        for chunk in tb.chunks(texts):
            words = tb.words(chunk)
            gone = np.zeros(len(words.start), bool)
            if len(repeated) and len(gone) >= WINDOW:
                one = self.one.ranges(chunk.buf, words.start, words.end)
                places = np.flatnonzero(_fits(words, WINDOW))
                pairs = self._pairs(chunk, words, one, places)
                places = places[_pair_in(pairs, repeated)]
                steps = np.zeros(len(gone) + 1, np.int64)
                steps[places] += 1
                np.add.at(steps, places + WINDOW, -1)
                gone = np.cumsum(steps)[:-1] > 0
            yield chunk, words, gone

    def _pairs(self, chunk, words, one, places) -> np.ndarray:
        if len(places) == 0:
            return np.zeros((0, 2), np.uint64)
        two = self.two.ranges(chunk.buf, words.start, words.end)
        return np.stack([tb.window_hashes(one, WINDOW)[places],
                         tb.window_hashes(two, WINDOW)[places] >> np.uint64(1)], axis=1)


def _fits(words: tb.Words, k: int) -> np.ndarray:
    """Whether k words of the same document start at each word."""
    last = np.repeat(words.first[1:], words.counts)
    return np.arange(len(words.start)) + k <= last


def _anchor_places(words: tb.Words) -> np.ndarray:
    inside = np.arange(len(words.start)) - np.repeat(words.first[:-1], words.counts)
    on_cover = np.zeros(PERIOD, bool)
    on_cover[list(COVER)] = True
    return np.flatnonzero(on_cover[inside % PERIOD] & _fits(words, ANCHOR))


def _in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if len(table) == 0:
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _pair_in(pairs: np.ndarray, table: np.ndarray) -> np.ndarray:
    """table: (n, 2) sorted by its first column; equal first halves are looked through."""
    found = np.zeros(len(pairs), bool)
    at = np.searchsorted(table[:, 0], pairs[:, 0])
    open_ = np.flatnonzero(at < len(table))
    while len(open_):
        same = table[at[open_], 0] == pairs[open_, 0]
        open_ = open_[same]
        hit = table[at[open_], 1] == pairs[open_, 1]
        found[open_[hit]] = True
        open_ = open_[~hit]
        at[open_] += 1
        open_ = open_[at[open_] < len(table)]
    return found


def _once_and_more(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of (n, k) and how often each occurs."""
    order = np.lexsort(pairs.T[::-1])
    ordered = pairs[order]
    new = np.ones(len(ordered), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    lead = np.flatnonzero(new)
    return ordered[lead], np.diff(np.append(lead, len(ordered)))


def _rows(block: int, keys: np.ndarray, names: list[str]) -> pa.Table:
    """Distinct keys of a block; the lowest bit of the last one, which is free, becomes whether the
    key occurs more than once in it."""
    distinct, counts = _once_and_more(keys)
    distinct[:, -1] |= (counts > 1).astype(np.uint64)
    columns = [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in distinct.T]
    return pa.table([pa.array(np.full(len(distinct), block, np.int32)), *columns], names=["block", *names])


def _anchor_rows(table: pa.Table) -> pa.Table:
    found = [np.zeros(0, np.uint64), *Passages().anchors(table.column("text"))]
    return _rows(_block(table), np.concatenate(found).reshape(-1, 1) << np.uint64(1), ["one"])


def _block(table: pa.Table) -> int:
    return table.column("block")[0].as_py() if table.num_rows else 0


def _window_rows(texts: pa.Table, anchors: pa.Table) -> pa.Table:
    repeated = np.sort(anchors.column("one").to_numpy().astype(np.int64).view(np.uint64))
    found = [np.zeros((0, 2), np.uint64),
             *Passages().windows(texts.column("text"), repeated)]
    pairs = np.concatenate(found)
    pairs[:, 1] <<= np.uint64(1)
    return _rows(_block(texts), pairs, ["one", "two"])


def _repeated_pairs(table: pa.Table) -> np.ndarray:
    pairs = np.stack([table.column(c).to_numpy().astype(np.int64).view(np.uint64)
                      for c in ("one", "two")], axis=1)
    return pairs[np.argsort(pairs[:, 0], kind="stable")]


def _kept_words(chunk: tb.Chunk, words: tb.Words, gone: np.ndarray) -> Iterator[bytes]:
    """The kept words of each document of a chunk, joined by one space."""
    start, size = words.start[~gone], (words.end - words.start)[~gone] + 1
    ends = np.cumsum(size)
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
    text = np.append(chunk.buf, np.uint8(0x20))[source]
    text[ends - 1] = 0x20
    kept = np.concatenate([[0], np.cumsum(~gone)])[words.first]
    place = np.concatenate([[0], ends])[kept].tolist()
    whole = text.tobytes()
    for a, b in zip(place[:-1], place[1:]):
        yield whole[a: b - 1] if b > a else b""


def _results(texts: pa.Table, windows: pa.Table, with_text: bool) -> pa.Table:
    repeated = _repeated_pairs(windows)
    n_words, n_removed, sha, kept = [], [], [], []
    for chunk, words, gone in Passages().covered(texts.column("text"), repeated):
        n_words.append(words.counts)
        sums = np.concatenate([[0], np.cumsum(gone)])
        n_removed.append(sums[words.first[1:]] - sums[words.first[:-1]])
        for text in _kept_words(chunk, words, gone):
            sha.append(hashlib.sha256(text).hexdigest())
            if with_text:
                kept.append(text.decode())
    none = [np.zeros(0, np.int64)]
    columns = {"doc_id": texts.column("doc_id"), "n_words": pa.array(np.concatenate(none + n_words)),
               "n_removed": pa.array(np.concatenate(none + n_removed)),
               "kept_sha256": pa.array(sha, pa.string())}
    if with_text:
        columns["kept_text"] = pa.array(kept, pa.string())
    return pa.table(columns)


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """(`block`, keys) of keys that occur at least twice. There is one row per block and key, so
    the largest group has as many rows as there are blocks."""
    *first, last = keys
    bare = F.shiftrightunsigned(last, 1)
    split = rows.repartition(*first, bare).select(
        "block", *first, bare.alias(last), (F.col(last).bitwiseAND(1) + 1).alias("copies"))
    copies = F.sum("copies").over(Window.partitionBy(*keys))
    return split.withColumn("copies", copies).where("copies > 1").select("block", *keys)


def block_count(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, round(total / block_bytes))


def repeated_passages(docs: DataFrame, with_text: bool = False,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs: `doc_id`, `n_words`, `n_removed`, `kept_sha256` and, if asked for,
    `kept_text` (the kept words, one space between them)."""
    blocks = block_count(docs, block_bytes)
    # The length deals copies of a doc_id and neighbours apart as well.
    block = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)).cast("int")
    texts = docs.select("doc_id", "text", block.alias("block")).repartition(
        min(blocks, PARTITIONS), "block")
    grouped: Callable = texts.groupBy("block")
    # One plan, so that the exchange of the texts is run once and read three times.
    anchors = _repeated(grouped.applyInArrow(
        _anchor_rows, "block int, one long"), "one")
    windows = _repeated(grouped.cogroup(anchors.groupBy("block")).applyInArrow(
        _window_rows, "block int, one long, two long"), "one", "two")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return grouped.cogroup(windows.groupBy("block")).applyInArrow(
        lambda left, right: _results(left, right, with_text),
        schema + (", kept_text string" if with_text else ""))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
n AS (
  SELECT r, i, count(*) OVER (PARTITION BY array_to_string(list_slice(w, i, i + 34), ' ')) AS times
  FROM s),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS place FROM n WHERE times > 1),
word AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM d),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY place) AS text FROM word ANTI JOIN gone USING (r, place)
  GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(lost.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)
"""
