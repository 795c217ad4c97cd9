"""Best-fit-decreasing packing of tokenised documents into sequences of fixed length.

A document longer than a sequence is cut into full pieces and a first piece with what is over;
full pieces are sequences of their own. The first pieces are packed best-fit decreasing: longest
first, each into the open sequence with the least room that suffices. A segment tree over the
remaining capacities finds that sequence in logarithmic time.

Only lengths matter to best fit, and there are at most SEQUENCE of them. So the plan is made for
lengths and counts: equal pieces in a row fill equal sequences in a row, and one look-up places a
whole run of them, with the very result of placing them one by one. The plan is a table of runs
(length, from which piece, into which sequences, at which place). Its size is bounded by the
square of SEQUENCE, whatever the corpus; pieces are numbered within their length by Spark and
look their run up inside the tasks.

Cases: a null or empty text is its end token alone. Rows that repeat are pieces of their own. An
empty table gives an empty result. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SEQUENCE = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k"
ROWS_PER_BUCKET = 4096
# Longer runs of letters or of blanks go to the tokenizer whose time does not grow with their square.
LONG_RUN = 1000


class Tokenizer:
    """Ids of the byte-level vocabulary. Both libraries give the same ids to texts without an added
    token; the one that reads the vocabulary as ranks is several times as fast, the other copes with
    very long words. Texts with an added token (`<|endoftext|>`) go to the latter, which knows it."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken

        path = public_tokenizers.path(f"{vocabulary}.tiktoken")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.vocabulary, self.steady = vocabulary, None
        with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as file:
            self.added = [token["content"] for token in json.load(file).get("added_tokens") or []]

    def ids(self, text: str) -> list[int]:
        if any(token in text for token in self.added):
            return self._steady().encode(text, add_special_tokens=False).ids
        words = text.split()
        longest = max(map(len, words), default=0)
        blanks = len(text) - sum(map(len, words)) - len(words)
        if longest > LONG_RUN or blanks > LONG_RUN:
            return self._steady().encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def _steady(self):
        if self.steady is None:
            import public_tokenizers
            from tokenizers import Tokenizer as Steady

            self.steady = Steady.from_file(public_tokenizers.path(f"{self.vocabulary}.json"))
        return self.steady


def cut(n: int, sequence: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: what is over comes first."""
    over = n % sequence or sequence
    ends = range(over, n + 1, sequence)
    return [(0, over)] + [(e - sequence, sequence) for e in ends[1:]]


def _pieces(vocabulary: str, sequence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for row, doc_id, text in zip(*(batch.column(c).to_pylist()
                                           for c in ("row", "doc_id", "text"))):
                ids = np.array(tokenizer.ids(text or "") + [END_ID], "<u4")
                rows += [(row, doc_id, i, start, length, zlib.crc32(ids[start: start + length]))
                         for i, (start, length) in enumerate(cut(len(ids), sequence))]
            columns = list(zip(*rows)) or [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["row", "doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, sequence: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """`row`, `doc_id`, `piece`, `start`, `length`, `ids_crc32`; `row` tells repeated rows apart."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"),
                        F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_pieces(vocabulary, sequence), (
        "row long, doc_id long, piece int, start long, length long, ids_crc32 long"))


class Capacities:
    """Segment tree over capacities 0 .. size: which is the least one, from a given one on, that
    an open sequence has left."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = np.zeros(2 * self.leaves, bool)

    def set(self, capacity: int, there: bool) -> None:
        at = capacity + self.leaves
        self.any[at] = there
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, length: int) -> int:
        """The least capacity >= length that is there, or -1."""
        at = length + self.leaves
        if self.any[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return -1


def plan(counts: dict[int, int], sequence: int = SEQUENCE) -> np.ndarray:
    """Runs (length, from piece, pieces, sequence, pieces per sequence, offset), best-fit
    decreasing. Pieces from, from + 1, .. go to sequence, in groups of `pieces per sequence`,
    first at `offset`."""
    tree, runs, opened = Capacities(sequence), [], 0
    left: dict[int, list[tuple[int, int]]] = {}  # capacity -> runs of sequences (first, how many)

    def put(capacity: int, first: int, many: int) -> None:
        if capacity and many:
            left.setdefault(capacity, []).append((first, many))
            tree.set(capacity, True)

    for length in sorted(counts, reverse=True):
        rest, at = counts[length], 0
        while rest:
            room = tree.tightest(length)
            if room < 0:
                room, first, many = sequence, opened, -(-rest // (sequence // length))
                opened += many
            else:
                first, many = left[room].pop()
                if not left[room]:
                    tree.set(room, False)
            each = room // length
            used = min(many, -(-rest // each))
            placed = min(rest, used * each)
            runs.append((length, at, placed, first, each, sequence - room))
            full, some = divmod(placed, each)
            put(room - each * length, first, full)
            put(room - some * length, first + full, bool(some))
            put(room, first + used, many - used)
            rest, at = rest - placed, at + placed
    return np.array(runs, np.int64).reshape(-1, 6)


def _placer(runs: np.ndarray):
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    runs = runs[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = int(runs[:, 1].max(initial=0)) + 1
        keys = runs[:, 0] * step + runs[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            r = runs[np.searchsorted(keys, length * step + np.minimum(rank, step - 1), "right") - 1]
            inside = rank - r[:, 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [
                    pa.array(r[:, 3] + inside // r[:, 4]),
                    pa.array(r[:, 5] + inside % r[:, 4] * length)],
                names=[*names, "sequence_id", "offset"])
    return run


def ranked(cuts: DataFrame) -> DataFrame:
    """`rank` from 0 of each piece within its length. A length may hold any share of all pieces:
    they are numbered in hashed buckets, each of which starts where those before it end."""
    buckets = max(1, -(-cuts.count() // ROWS_PER_BUCKET))
    bucketed = cuts.withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket")
    starts = bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "bucket", (F.sum("n").over(before) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row", "piece"))
    return bucketed.withColumn("place", place).join(starts, ["length", "bucket"]).withColumn(
        "rank", F.col("before") + F.col("place") - 1)


def packed(docs: DataFrame, sequence: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: `doc_id`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`,
    `offset`."""
    cuts = saved(pieces(docs, sequence, vocabulary))
    # At most `sequence` rows.
    counts = {r["length"]: r["n"] for r in
              cuts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    return ranked(cuts).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        _placer(plan(counts, sequence)), (
            "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
            "offset long"))


def _joined(vocabulary: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        tokenizer, ids = Tokenizer(vocabulary), []
        table = table.sort_by("offset")
        for text, start, length in zip(*(table.column(c).to_pylist()
                                         for c in ("text", "start", "length"))):
            ids += (tokenizer.ids(text or "") + [END_ID])[start: start + length]
        return pa.table({"sequence_id": pa.array([key[0].as_py()], pa.int64()),
                         "ids": pa.array([ids], pa.list_(pa.int32()))})
    return run


def sequences(docs: DataFrame, placed: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """`sequence_id` and its `ids`, for documents whose doc_id is unique."""
    met = placed.join(docs.select("doc_id", "text"), "doc_id").select(
        "sequence_id", "offset", "start", "length", "text")
    return met.groupBy("sequence_id").applyInArrow(
        _joined(vocabulary), "sequence_id long, ids array<int>")
