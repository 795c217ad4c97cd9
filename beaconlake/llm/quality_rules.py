"""Quality rules: base counts, and a log-likelihood ratio between two hashed n-gram models.

Tokens are runs of letters and digits or runs of other signs; uni- and bigrams fall into BUCKETS
hash buckets. Two multinomials over the buckets are counted: one over all documents, one over
every trusted one (quality 1). A document's score is the mean over its n-grams of
log p(trusted) - log p(raw), so that length does not matter. One threshold, the one that best
separates all labelled rows, decides for every document alike.

Counts are summed in each task first, so BUCKETS numbers per task are shuffled, and the two vectors
that come to the driver have BUCKETS entries at any size. To find the trusted documents, those
that an id filter lets through are shuffled with their texts and met with the ids.

Cases: a null or empty text has no words, score 0 and fails the base rules. Labels without
quality are ignored; without any trusted label all scores are 0 and the base rules decide alone.
Rows that repeat are judged alike; a doc_id that is labelled twice is trusted if one label says
so. Only `doc_id` and `text` of the documents are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import hash_slot, id_filter, in_filter, saved

BUCKETS = 1 << 15
BLOCK = 256
SMOOTHING = 1.0
MIN_WORDS = 50
# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
# Scores are compared in steps of this width when the threshold is chosen.
STEP = 0.01
# A trusted document that is rejected weighs as much as so many bad ones that are kept.
CLEAN_WEIGHT = 4.0


def _token_edges(chunk: tb.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and first-of-document of the tokens."""
    kind = np.full(256, 2, np.uint8)
    kind[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kind[low:high] = 1
    k = kind[chunk.buf]
    change = np.ones(len(k) + 1, bool)
    change[1:-1] = k[1:] != k[:-1]
    change[chunk.offsets] = True
    edges = np.flatnonzero(change)
    start, end = edges[:-1], edges[1:]
    real = k[start] > 0 if len(start) else np.zeros(0, bool)
    start, end = start[real], end[real]
    return start, end, np.searchsorted(start, chunk.offsets)


def ngrams(hasher: tb.Hasher, chunk: tb.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each uni- and bigram, and the number of n-grams before each document."""
    start, end, first = _token_edges(chunk)
    h = hasher.ranges(chunk.buf, start, end)
    grams = np.zeros((len(h), 2), np.uint64)
    grams[:, 0] = h
    grams[:-1, 1] = tb.combine(h[:-1], h[1:])
    held = np.ones((len(h), 2), bool)
    last = first[1:][np.diff(first) > 0] - 1
    held[last, 1] = False
    sums = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
    return (grams[held] >> np.uint64(40)).astype(np.int64) % BUCKETS, sums[first]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, sums = tb.Hasher(7), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for chunk in tb.chunks(batch.column("text")):
            sums += np.bincount(ngrams(hasher, chunk)[0], minlength=BUCKETS)
    yield _blocks(sums)


_BLOCKS = "block int, n array<long>"


def _blocks(sums: np.ndarray) -> pa.RecordBatch:
    """One row per BLOCK buckets that are not all 0."""
    rows = sums.reshape(-1, BLOCK)
    some = np.flatnonzero(rows.any(axis=1))
    return pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), pa.array(rows[some].tolist(), pa.list_(pa.int64()))],
        names=["block", "n"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((BUCKETS // BLOCK, BLOCK), np.int64)
    for batch in batches:
        part = batch.column("n").flatten().to_numpy().reshape(-1, BLOCK)
        np.add.at(sums, batch.column("block").to_numpy(), part)
    yield _blocks(sums.reshape(-1))


def counts(texts: DataFrame) -> np.ndarray:
    """N-grams in each bucket over all rows of `text`."""
    rows = texts.mapInArrow(_counts, _BLOCKS).repartition("block").mapInArrow(_added, _BLOCKS)
    sums = np.zeros((BUCKETS // BLOCK, BLOCK))
    for r in rows.collect():
        sums[r["block"]] += r["n"]
    return sums.reshape(-1)


def _passing(words: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = batch.filter(pa.array(in_filter(words, batch.column("slot").to_numpy())))
            yield hit.select(["doc_id", "text"])
    return run


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`text` of every row of docs whose id is trusted."""
    good = labels.where("quality = 1 and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id")).distinct()
    near = docs.select("doc_id", "text", hash_slot()).mapInArrow(
        _passing(id_filter(good)), "doc_id long, text string")
    # The ids of a partition are hashed, so texts are neither sorted nor sent everywhere, whatever the size.
    return near.join(good.hint("shuffle_hash"), "doc_id", "left_semi").select("text")


def fit_ratio(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each bucket."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sums = np.stack([counts(texts.select("text")), counts(trusted_texts(texts, labels))])
    if not sums[1].any():
        return np.zeros(BUCKETS)
    shares = (sums + SMOOTHING) / (sums.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(shares[1]) - np.log(shares[0])


def _dup_lines(text: str) -> int:
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen: set[str] = set()
    found = 0
    for line in lines:
        if line in seen:
            found += 1
        elif line.strip(" \t\n\x0b\x0c\r"):
            seen.add(line)
    return found


def _repeat_words(h: np.ndarray, words: tb.Words) -> np.ndarray:
    """Words of each document that lie in a three-word window found twice in it."""
    n = len(h)
    docs = len(words.first) - 1
    if n < 3:
        return np.zeros(docs, np.int64)
    doc = words.doc
    whole = doc[:-2] == doc[2:]
    places = np.flatnonzero(whole)
    keys = tb.combine(tb.window_hashes(h, 3)[places], doc[places].astype(np.uint64))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(places), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[places[twice] + shift] = True
    sums = np.concatenate([[0], np.cumsum(covered)])
    return sums[words.first[1:]] - sums[words.first[:-1]]


def _scorer(ratio: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, plain = tb.Hasher(7), tb.Hasher(8)
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        for batch in batches:
            out = []
            for chunk in tb.chunks(batch.column("text")):
                words = tb.words(chunk)
                h = plain.ranges(chunk.buf, words.start, words.end)
                points = np.concatenate([[0], np.cumsum((chunk.buf & 0xC0) != 0x80)])
                signs = np.concatenate([[0], np.cumsum(symbol[chunk.buf])])
                chars = np.concatenate([[0], np.cumsum(points[words.end] - points[words.start])])
                raw = chunk.buf.tobytes()
                ends = chunk.offsets.tolist()
                lines = [_dup_lines(raw[a:b].decode()) for a, b in zip(ends[:-1], ends[1:])]
                buckets, first = ngrams(grams, chunk)
                sums = np.concatenate([[0.0], np.cumsum(ratio[buckets])])
                total = sums[first[1:]] - sums[first[:-1]]
                out.append(np.stack([
                    words.counts, chars[words.first[1:]] - chars[words.first[:-1]],
                    signs[chunk.offsets[1:]] - signs[chunk.offsets[:-1]], lines,
                    _repeat_words(h, words), total / np.maximum(np.diff(first), 1)]))
            values = np.concatenate(out, axis=1) if out else np.zeros((6, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(v.astype(np.int64)) for v in values[:5]],
                 pa.array(np.round(values[5], 9))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "score"])
    return score


def choose_threshold(scored: DataFrame, labels: DataFrame) -> float:
    """The score that best separates labelled rows of quality 1 (kept) and 0, over all of them.
    Scores lie within the range of the ratios, so the steps are bounded."""
    steps = scored.select("doc_id", F.floor(F.col("score") / STEP).alias("step")).join(
        labels.where("quality is not null").select("doc_id", "quality"), "doc_id").groupBy("step").agg(
        F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("bad"))
    table: pd.DataFrame = steps.toPandas().sort_values("step")
    if table.good.sum() == 0 or table.bad.sum() == 0:
        return -np.inf
    lost = table.good.cumsum() / table.good.sum()
    caught = table.bad.cumsum() / table.bad.sum()
    gain = (caught - CLEAN_WEIGHT * lost).to_numpy()
    return float((table.step.iloc[int(gain.argmax())] + 1) * STEP) if gain.max() > 0 else -np.inf


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of docs: the base counts, `base_failed`, `score`, `kept`."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ratio = fit_ratio(texts, labels)
    scored = saved(texts.mapInArrow(_scorer(ratio), (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, score double")))
    threshold = choose_threshold(scored, labels)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumns({
        "base_failed": failed, "kept": ~failed & (F.col("score") >= F.lit(threshold))})
