"""Toxicity by multiple-instance learning: labels are on documents, scores are on sentences.

A sentence is the tokens between two of `.`, `!`, `?` or line breaks; a token is a run of letters
and digits, A-Z read as a-z. A sentence's probability is logistic in the weights of its hashed
uni- and bigrams; a document's is the noisy-or of its sentences, 1 - product of (1 - p): one
toxic sentence is enough. The weights are fitted to document labels by gradient descent through
the noisy-or, so sentences are scored, and found, without a sentence label.

The fit reads a documented, bounded sample of labelled documents: of each label the TRAIN_DOCS
first ones by hash, until they hold TRAIN_BYTES together, from rows whose crc32(doc_id as text)
modulo FOLDS is not 0. Texts are whole and of any length. Each sampled row weighs as many rows as
it stands for, so that the share of toxic rows is that of all training labels at any size.
Scoring reads every whole text, without label, language, source or id.

Cases: a null, empty or blank text has no sentence; its noisy-or is 0. Without labels of both
kinds every score is 0. A doc_id that is labelled twice counts as toxic if one label says so.
Rows that repeat are scored alike. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import id_crc, saved

FEATURES = 1 << 20
TRAIN_DOCS = 4000
TRAIN_BYTES = 1 << 25
FOLDS = 5
# A feature takes part if so many documents hold it and its chi-square against the labels is so
# high; of the invented or rare words of a document most would else be learned by heart.
LEAST_DOCS = 5
LEAST_CHI2 = 20.0
STEPS = 600
RATE = 0.1
SHRINK = 1e-6
# A sentence from this probability on is reported.
OFFENDING = 0.5
# A longer text is read in pieces of about so many bytes, cut between sentences.
PIECE_BYTES = 1 << 20
_STOP = re.compile(rb"[.!?\n]")


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


class Sentences(NamedTuple):
    """Hashed features of a chunk, in order; where sentences begin in them, documents in sentences;
    byte range of each sentence."""
    features: np.ndarray
    start: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def _letters() -> np.ndarray:
    inside = np.zeros(256, bool)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        inside[low:high] = True
    return inside


def _stops() -> np.ndarray:
    stop = np.zeros(256, bool)
    stop[list(b".!?\n")] = True
    return stop


class Reader:
    def __init__(self):
        self.hasher, self.inside, self.stop = tb.Hasher(21, lower=True), _letters(), _stops()

    def sentences(self, chunk: tb.Chunk) -> Sentences:
        words = tb.words(chunk, self.inside)
        h = self.hasher.ranges(chunk.buf, words.start, words.end)
        n = len(h)
        stops = np.concatenate([[0], np.cumsum(self.stop[chunk.buf])])[words.start]
        opens = np.ones(n, bool)
        opens[1:] = stops[1:] != stops[:-1]
        opens[words.first[:-1][words.counts > 0]] = True
        lead = np.flatnonzero(opens)
        # A bigram belongs to its second word; the first word of a sentence has none.
        grams = np.empty((n, 2), np.uint64)
        grams[:, 0] = h
        grams[1:, 1] = tb.combine(h[:-1], h[1:])
        held = np.ones((n, 2), bool)
        held[lead, 1] = False
        before = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
        last = np.append(lead[1:], n) - 1
        return Sentences(
            (grams[held] >> np.uint64(44)).astype(np.int32), before[lead],
            np.searchsorted(lead, words.first), words.start[lead], words.end[last] if n else lead)


class Piece(NamedTuple):
    """A chunk of whole sentences: for each of its documents, which of the given texts it is (or is
    a part of)."""
    chunk: tb.Chunk
    owner: np.ndarray


def _cut(text: bytes) -> Iterator[bytes]:
    begin = 0
    while len(text) - begin > PIECE_BYTES:
        stop = _STOP.search(text, begin + PIECE_BYTES)
        if stop is None:
            break
        yield text[begin: stop.end()]
        begin = stop.end()
    yield text[begin:]


def pieces(texts: pa.Array) -> Iterator[Piece]:
    """All texts in order, about a megabyte at a time; no sentence is in two pieces."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    long = pc.greater(pc.binary_length(texts), PIECE_BYTES).to_numpy(zero_copy_only=False)
    at = 0
    for stop in [*np.flatnonzero(long).tolist(), len(texts)]:
        for chunk in tb.chunks(texts[at:stop]):
            yield Piece(chunk, at + chunk.first_row + np.arange(len(chunk.offsets) - 1))
        if stop < len(texts):
            for part in _cut(texts[stop].as_py().encode()):
                for chunk in tb.chunks(pa.array([part], pa.large_binary()).cast(pa.large_string())):
                    yield Piece(chunk, np.array([stop]))
        at = stop + 1


def _sums(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sum of each run of values that begins at `start`; no run is empty."""
    return np.add.reduceat(values, start) if len(start) else np.zeros(0, values.dtype)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _log_clean(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Logarithm of the chance that none of the sentences between two entries of `first` is toxic."""
    logs = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-12)))])
    return logs[first[1:]] - logs[first[:-1]]


def _noisy_or(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of the sentences between each two entries of `first`; 0 where there are none."""
    return -np.expm1(_log_clean(p, first))


class Telling:
    """Which features differ between the labels by more than chance, by documents they are in;
    counted piece by piece."""

    def __init__(self, toxic: np.ndarray):
        self.toxic = toxic
        self.in_any, self.in_toxic = np.zeros(FEATURES), np.zeros(FEATURES)
        self.open, self.seen = -1, np.zeros(0, np.int64)

    def add(self, owner: np.ndarray, features: np.ndarray) -> None:
        """Documents (in order) and the features in them; the last one may go on."""
        if not len(owner):
            return
        held = np.unique(owner.astype(np.int64) * FEATURES + features)
        if self.open >= 0:
            held = np.union1d(held, self.seen)
        self.open = int(held[-1] // FEATURES)
        ready = int(np.searchsorted(held, self.open * FEATURES))
        self._count(held[:ready])
        self.seen = held[ready:].copy()

    def _count(self, held: np.ndarray) -> None:
        names = held % FEATURES
        self.in_any += np.bincount(names, minlength=FEATURES)
        self.in_toxic += np.bincount(names, self.toxic[held // FEATURES], FEATURES)

    def chosen(self) -> np.ndarray:
        self._count(self.seen)
        self.open, self.seen = -1, self.seen[:0]
        n, share = len(self.toxic), self.toxic.mean()
        expected = self.in_any * share
        spread = expected * (1 - share) * np.maximum(1 - self.in_any / n, 1 / n)
        chi2 = (self.in_toxic - expected) ** 2 / np.maximum(spread, 1e-9)
        return (self.in_any >= LEAST_DOCS) & (chi2 >= LEAST_CHI2)


def fit(names: np.ndarray, features: np.ndarray, sentence: np.ndarray, doc: np.ndarray,
        toxic: np.ndarray, weight: np.ndarray) -> Model:
    """Gradient descent (Adam) on the documents' weighted cross-entropy with a small weight decay.
    `features` are places in `names`, each in its `sentence`; `doc` is the document of a sentence."""
    weights, bias = np.zeros(len(names)), -5.0
    first = np.searchsorted(doc, np.arange(len(toxic) + 1))
    each = weight / weight.sum()
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, STEPS + 1):
        p = _logistic(np.bincount(sentence, weights[features], len(doc)) + bias)
        whole = np.clip(_noisy_or(p, first), 1e-9, 1 - 1e-9)
        # d loss / d logit of a sentence: p for a clean document, -p (1 - P) / P for a toxic one.
        slope = np.where(toxic, -(1 - whole) / whole, 1.0) * each
        by_sentence = slope[doc] * p
        g = np.append(np.bincount(features, by_sentence[sentence], len(names)), by_sentence.sum())
        g[:-1] += SHRINK * weights
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    whole = np.zeros(FEATURES)
    whole[names] = weights
    return Model(whole, bias)


def fit_texts(texts: pa.Array, toxic: np.ndarray, weight: np.ndarray) -> Model:
    """Read twice: to count in how many documents each feature is, and to keep the few features
    that tell the labels apart. So memory follows those and the number of sentences."""
    reader, counts = Reader(), Telling(toxic)
    for piece in pieces(texts):
        s = reader.sentences(piece.chunk)
        doc = piece.owner[np.searchsorted(s.first, np.arange(len(s.start)), "right") - 1]
        counts.add(np.repeat(doc, np.diff(np.append(s.start, len(s.features)))), s.features)
    chosen = counts.chosen()
    names = np.flatnonzero(chosen)
    features, sentence, docs, n = [], [], [], 0
    for piece in pieces(texts):
        s = reader.sentences(piece.chunk)
        docs.append(piece.owner[np.searchsorted(s.first, np.arange(len(s.start)), "right") - 1].astype(np.int32))
        part = chosen[s.features]
        features.append(np.searchsorted(names, s.features[part]).astype(np.int32))
        of = np.repeat(np.arange(len(s.start)), np.diff(np.append(s.start, len(s.features))))
        sentence.append((of[part] + n).astype(np.int32))
        n += len(s.start)
    none = [np.zeros(0, np.int32)]
    return fit(names, *(np.concatenate(none + x) for x in (features, sentence, docs)), toxic, weight)


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows of a partition; texts in a fixed order, so that sums do not depend on
    the order in which tasks answered."""
    rows, of_label = [], {}
    for batch in batches:
        toxic, labelled = (batch.column(c).to_pylist() for c in ("toxic", "labelled"))
        rows += zip(toxic, batch.column("text").cast(pa.binary()).to_pylist())
        of_label.update(zip(toxic, labelled))
    rows.sort()
    toxic = np.array([t for t, _ in rows]) == 1
    if len(rows) == 0 or toxic.all() or not toxic.any():
        return
    texts = pa.array([t for _, t in rows], pa.large_binary()).cast(pa.large_string())
    rows.clear()
    weight = np.where(toxic, of_label[1] / toxic.sum(), of_label[0] / (~toxic).sum())
    model = fit_texts(texts, toxic, weight)
    names = np.flatnonzero(model.weights)
    yield pa.RecordBatch.from_arrays([
        pa.array([names.tolist()], pa.list_(pa.int32())),
        pa.array([model.weights[names].tolist()], pa.list_(pa.float64())),
        pa.array([model.bias], pa.float64())], names=["names", "weights", "bias"])


def training_ids(labels: DataFrame, per_label: int) -> DataFrame:
    """Labelled ids of the training folds: at most `per_label` of each label, the first by hash;
    `labelled` is how many there are of the label."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).where(id_crc() % FOLDS != 0)
    sides = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
             for t in (0, 1)]
    counts = known.groupBy("toxic").agg(F.count(F.lit(1)).alias("labelled"))
    return sides[0].unionByName(sides[1]).join(F.broadcast(counts), "toxic")


def training_rows(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS,
                  total_bytes: int = TRAIN_BYTES) -> DataFrame:
    """`toxic`, `labelled` and `text` of the sample."""
    # At most 2 * per_label rows of a few numbers: small enough to be sent to every task.
    ids = saved(training_ids(labels, per_label))
    texts = docs.select("doc_id", "text").where("text is not null")
    sizes = texts.select("doc_id", F.octet_length("text").alias("bytes")).join(
        F.broadcast(ids), "doc_id").groupBy("toxic", "labelled", "doc_id").agg(F.sum("bytes").alias("bytes"))
    before = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(
        Window.unboundedPreceding, -1)
    chosen = sizes.withColumn("before", F.coalesce(F.sum("bytes").over(before), F.lit(0))).where(
        F.col("before") < total_bytes).select("doc_id", "toxic", "labelled")
    return texts.join(F.broadcast(chosen), "doc_id").select("toxic", "labelled", "text")


def train(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS) -> Model:
    # The sample is bounded by its two parameters, so one task can fit it.
    found = training_rows(docs, labels, per_label).repartition(1).mapInArrow(
        _fitted, "names array<int>, weights array<double>, bias double").collect()
    if not found:
        return Model(np.zeros(FEATURES), -50.0)
    weights = np.zeros(FEATURES)
    weights[found[0]["names"]] = found[0]["weights"]
    return Model(weights, found[0]["bias"])


def _scorer(model: Model):
    weights, bias = model.weights.astype(np.float32), model.bias

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            n = batch.num_rows
            clean, counts, read = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
            spans: list[list[dict]] = [[] for _ in range(n)]
            for piece in pieces(batch.column("text")):
                chunk, owner = piece
                s = reader.sentences(chunk)
                p = _logistic(_sums(weights[s.features].astype(np.float64), s.start) + bias)
                clean[owner] += _log_clean(p, s.first)
                counts[owner] += np.diff(s.first)
                points = np.concatenate([[0], np.cumsum((chunk.buf & 0xC0) != 0x80)])
                for i in np.flatnonzero(p >= OFFENDING).tolist():
                    part = int(np.searchsorted(s.first, i, "right")) - 1
                    base = points[chunk.offsets[part]] - read[owner[part]]
                    spans[owner[part]].append({
                        "start": int(points[s.begin[i]] - base), "end": int(points[s.end[i]] - base),
                        "score": round(float(p[i]), 9)})
                read[owner] += np.diff(points[chunk.offsets])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.round(-np.expm1(clean), 9)), pa.array(counts),
                 pa.array(spans, _SPANS)], names=["doc_id", "score", "n_sentences", "offending"])
    return score


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs: `doc_id`, `held_out`, `score`, `predicted`, `n_sentences` and the
    `offending` sentences (code points from `start`, `end` exclusive)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scorer(model), ("doc_id long, score double, n_sentences long, "
                         "offending array<struct<start: long, end: long, score: double>>"))
    return rows.select(
        "doc_id", F.coalesce(id_crc() % FOLDS == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "offending")


def _flagger(model: Model):
    weights, bias = model.weights.astype(np.float32), model.bias

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            logs = np.zeros(batch.num_rows)
            for chunk, owner in pieces(batch.column(batch.schema.names.index("text"))):
                s = reader.sentences(chunk)
                p = _logistic(_sums(weights[s.features].astype(np.float64), s.start) + bias)
                logs[owner] += _log_clean(p, s.first)
            yield batch.filter(pa.array(np.round(-np.expm1(logs), 9) < 0.5))
    return clean


def clean_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Documents that are not predicted toxic, with all their columns."""
    return docs.mapInArrow(_flagger(model), docs.schema)
