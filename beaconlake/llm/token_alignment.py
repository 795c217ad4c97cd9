"""Tokens of two tokenizers over the same bytes, cut into groups where both end.

A reads a space and the text, B the text (it adds that space itself), so the tokens of both spell
the same bytes. Where a token of A and a token of B end at the same byte, a group ends; each pair of
an A and a B token of one group is a link. Corpus-wide, a pair of ids counts the documents that hold
it linked.

The ends of A and of B are two sorted lists, and groups come from merging them. Merge path: the
merge is a walk through a grid of A and B; a binary search on each PIECE-th diagonal finds where the
walk crosses it, and so cuts it into pieces of equal work that do not need each other, whatever the
documents' lengths. A piece yields the cuts in it and its tokens' groups counted from its own
beginning; cuts of the pieces before are added, which stitches a group that runs over a border. An
end whose A token closes one piece and whose B token opens the next is seen by the latter.

Texts are tokenized once. The distinct linked pairs of a document, with how often each is linked,
are written as numbers; tasks add them up before they are shuffled. The counts of the pairs that
most documents hold (at most HELD of them) go to every task, and all other pairs meet their counts
in a shuffled join, where none is frequent. The highest count of each A id is bounded by the
vocabulary.

Cases: a text that is null, empty, or not spelled byte by byte by the tokens of both (for B: one
that has U+2581, which it reads as a space) has no tokens; its numbers are 0 and its digest is
empty. Each row is a document of its own to the counts, also where a doc_id repeats or is null.
Very long texts are tokenized in segments that end before a single space, where neither
vocabulary has a token across; a text without such places is one segment. An empty table gives an
empty result. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .packing import Tokenizer

VOCABULARY_A = "byte_bpe_50k"
VOCABULARY_B = "piece_bpe_32k"
SEGMENT = 1 << 18
CHUNK_TOKENS = 1 << 20
PIECE = 1 << 14
EXPANDED = 1 << 21
HELD = 1 << 18
META = "▁"
_CUT = re.compile(rf"(?<=[^\s{META}]) (?=[^\s{META}])")


class PlainTokenizer(Tokenizer):
    """Special tokens' strings are ordinary text."""

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        self.added = []

    def _steady(self):
        steady = super()._steady()
        steady.encode_special_tokens = True
        return steady


class Encoders:
    """Ids of both tokenizers, and the bytes of each id."""

    def __init__(self, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B):
        import public_tokenizers
        import sentencepiece

        self.a = PlainTokenizer(vocabulary_a)
        self.b = sentencepiece.SentencePieceProcessor(
            model_file=public_tokenizers.path(f"{vocabulary_b}.model"))
        fast = self.a.fast
        self.bytes_a = [fast.decode_single_token_bytes(i) for i in range(fast.n_vocab)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(META, " ").encode()
                        for i, p in enumerate(pieces)]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Only if no piece goes on after a space may a text be cut before one.
        self.cuts = not any(META in p.lstrip(META) for p in pieces)

    def segments(self, text: str) -> Iterator[str]:
        begin = 0
        while self.cuts and len(text) - begin > SEGMENT:
            cut = _CUT.search(text, begin + SEGMENT)
            if cut is None:
                break
            yield text[begin: cut.start()]
            begin = cut.start()
        yield text[begin:]

    def both(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and of B; none if they do not spell the same bytes."""
        all_a, all_b = [], []
        for i, segment in enumerate(self.segments(text) if text else ()):
            spaced, bare = (segment, segment[1:]) if i else (" " + segment, segment)
            a, b = self.a.ids(spaced), self.b.encode(bare, num_threads=1)
            whole = spaced.encode()
            if (b"".join(map(self.bytes_a.__getitem__, a)) != whole
                    or b"".join(map(self.bytes_b.__getitem__, b)) != whole):
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            all_a.append(np.array(a, np.int64))
            all_b.append(np.array(b, np.int64))
        none = [np.zeros(0, np.int64)]
        return np.concatenate(none + all_a), np.concatenate(none + all_b)


def crossings(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of `a` and of `b` come before each `piece`-th step of their merge (of equals, a
    first), from step 0 to the last: a binary search on all these diagonals at once."""
    total = len(a) + len(b)
    steps = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(steps - len(b), 0), np.minimum(steps, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low, steps - low
        middle = (low[open_] + high[open_]) // 2
        further = a[middle] <= b[steps[open_] - 1 - middle]
        low[open_[further]] = middle[further] + 1
        high[open_[~further]] = middle[~further]


def _piece(a: np.ndarray, b: np.ndarray, i: int, i_end: int, j: int, j_end: int):
    """Number of cuts in one piece, and the group of each of its tokens from its beginning on."""
    ends_a, ends_b = a[i:i_end], b[j:j_end]
    at = np.searchsorted(ends_b, ends_a)
    inside = at < len(ends_b)
    inside[inside] = ends_b[at[inside]] == ends_a[inside]
    cuts = ends_a[inside]
    if i and j < j_end and a[i - 1] == b[j]:
        cuts = np.append(a[i - 1], cuts)
    return len(cuts), np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)


def groups(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, whose ends are `a` and `b`."""
    i, j = crossings(a, b, piece)
    group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    before = 0
    for k in range(len(i) - 1):
        n, in_a, in_b = _piece(a, b, i[k], i[k + 1], j[k], j[k + 1])
        group_a[i[k]: i[k + 1]] = in_a + before
        group_b[j[k]: j[k + 1]] = in_b + before
        before += n
    return group_a, group_b


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of `times` of each."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    return keys[first], np.add.reduceat(times, first) if len(keys) else times


class Links(NamedTuple):
    """Distinct (document, pair of ids) in order: document and pair as one key, and how often."""
    key: np.ndarray
    times: np.ndarray


def links(ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray,
          doc_of_group: np.ndarray, size_a: int, size_b: int) -> Links:
    """All links of the groups. Ids that repeat inside a group are taken together first, so a long
    group costs its distinct pairs; EXPANDED pairs at a time (or those of one A id) are laid out."""
    one = np.ones(1, np.int64)
    a, times_a = _summed(group_a * size_a + ids_a, np.repeat(one, len(ids_a)))
    b, times_b = _summed(group_b * size_b + ids_b, np.repeat(one, len(ids_b)))
    of_a, n = a // size_a, len(doc_of_group)
    begin_b = np.searchsorted(b // size_b, np.arange(n + 1))
    many = np.diff(begin_b)[of_a]
    laid, found = np.concatenate([[0], np.cumsum(many)]), []
    begin = 0
    while begin < len(a):
        end = max(begin + 1, int(np.searchsorted(laid, laid[begin] + EXPANDED, "right")) - 1)
        left = np.repeat(np.arange(begin, end), many[begin:end])
        right = np.arange(len(left)) - (laid[left] - laid[begin]) + begin_b[of_a[left]]
        key = (doc_of_group[of_a[left]] * size_a + a[left] % size_a) * size_b + b[right] % size_b
        found.append(_summed(key, times_a[left] * times_b[right]))
        begin = end
    if not found:
        return Links(np.zeros(0, np.int64), np.zeros(0, np.int64))
    if len(found) == 1:
        return Links(*found[0])
    return Links(*_summed(np.concatenate([k for k, _ in found]), np.concatenate([t for _, t in found])))


class _Written:
    """Groups as text, `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, size_a: int, size_b: int):
        self.a = np.array([f"{i}{s}".encode() for i in range(size_a) for s in ",|"], object)
        self.b = np.array([f"{i}{s}".encode() for i in range(size_b) for s in ",;"], object)

    def digest(self, ids_a, group_a, ids_b, group_b) -> str:
        if not len(ids_a):
            return ""
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
        both = np.concatenate([self.a[2 * ids_a + last_a], self.b[2 * ids_b + last_b]])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        return hashlib.sha256(b"".join(both[order].tolist())[:-1]).hexdigest()


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _aligner(vocabulary_a: str, vocabulary_b: str, tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoders(vocabulary_a, vocabulary_b)
        size_a, size_b = len(coder.bytes_a), len(coder.bytes_b)
        text_of = _Written(size_a, size_b)

        def finished(rows: list[tuple]) -> pa.RecordBatch:
            ids_a = np.concatenate([a for *_, a, _ in rows])
            ids_b = np.concatenate([b for *_, b in rows])
            first_a = np.cumsum([0] + [len(a) for *_, a, _ in rows])
            first_b = np.cumsum([0] + [len(b) for *_, b in rows])
            group_a, group_b = groups(np.cumsum(coder.length_a[ids_a]), np.cumsum(coder.length_b[ids_b]))
            n = int(group_a[-1]) + 1 if len(group_a) else 0
            # Tokens of both end with each document, so its groups are its own.
            first = np.searchsorted(group_a, np.arange(n + 1))
            doc_of_group = np.searchsorted(first_a, first[:-1], "right") - 1
            in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
            found = links(ids_a, group_a, ids_b, group_b, doc_of_group, size_a, size_b)
            doc, pair = np.divmod(found.key, size_a * size_b)
            offsets = np.searchsorted(doc, np.arange(len(rows) + 1))
            inside = np.ones(len(pair), bool)
            inside[offsets[:-1][offsets[:-1] < len(pair)]] = False
            steps = np.where(inside, np.diff(pair, prepend=0), pair)
            group_first = np.searchsorted(doc_of_group, np.arange(len(rows) + 1))
            linked = np.concatenate([[0], np.cumsum(in_a * in_b)])[group_first]
            digests = [text_of.digest(
                ids_a[i:i_end], group_a[i:i_end], ids_b[j:j_end], group_b[j:j_end])
                for i, i_end, j, j_end in zip(first_a, first_a[1:], first_b, first_b[1:])]
            def listed(where: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(where, pa.int32()), pa.array(values, kind))

            columns = {
                "row": pa.array([r[0] for r in rows], pa.int64()),
                "doc_id": pa.array([r[1] for r in rows], pa.int64()),
                "n_a": pa.array(np.diff(first_a), pa.int64()),
                "n_b": pa.array(np.diff(first_b), pa.int64()),
                "n_groups": pa.array(np.diff(group_first), pa.int64()),
                "n_links": pa.array(np.diff(linked), pa.int64()),
                "groups_sha256": pa.array(digests, pa.string()),
                "steps": listed(offsets, steps, pa.int64()),
                "times": listed(offsets, found.times, pa.int64()),
            }
            if tokens:
                columns |= {"ids_a": listed(first_a, ids_a, pa.int32()),
                            "ids_b": listed(first_b, ids_b, pa.int32()),
                            "sizes_a": listed(group_first, in_a, pa.int32()),
                            "sizes_b": listed(group_first, in_b, pa.int32())}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            rows, held = [], 0
            for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text"))):
                a, b = coder.both(text.as_py() or "")
                rows.append((row.as_py(), doc_id.as_py(), a, b))
                held += len(a) + len(b)
                if held >= CHUNK_TOKENS:
                    yield finished(rows)
                    rows, held = [], 0
            if rows:
                yield finished(rows)
    return run


def aligned(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
            tokens: bool = True) -> DataFrame:
    """One row per row of docs: `row`, `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`,
    `groups_sha256`; the distinct linked pairs (A id times the size of B, plus B id) in order, as
    `steps` from one to the next, and `times` each is linked. With `tokens`, also `ids_a`, `ids_b`
    and how many of them each group takes, `sizes_a` and `sizes_b`."""
    schema = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, steps array<long>, times array<long>")
    if tokens:
        schema += ", ids_a array<int>, ids_b array<int>, sizes_a array<int>, sizes_b array<int>"
    texts = docs.select(F.monotonically_increasing_id().alias("row"),
                        F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_aligner(vocabulary_a, vocabulary_b, tokens), schema)


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each row's pairs begin, the pairs, and how often each is linked."""
    steps, times = batch.column("steps"), batch.column("times")
    offsets = steps.offsets.to_numpy().astype(np.int64)
    offsets, begin = offsets - offsets[0], int(offsets[0])
    values = steps.values.to_numpy()[begin: begin + offsets[-1]]
    before = int(times.offsets[0].as_py())
    sums = np.concatenate([[0], np.cumsum(values)])
    pairs = sums[1:] - np.repeat(sums[offsets[:-1]], np.diff(offsets))
    return offsets, pairs, times.values.to_numpy()[before: before + offsets[-1]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def summed() -> tuple[np.ndarray, np.ndarray]:
        return _summed(np.concatenate([p for p, _ in held]), np.concatenate([c for _, c in held]))

    def out(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    for batch in batches:
        _, pairs, _ = _pairs(batch)
        held.append(_summed(pairs, np.ones(len(pairs), np.int64)))
        n += len(held[-1][0])
        if n > 2 * EXPANDED:
            held = [summed()]
            n = len(held[0][0])
            if n > EXPANDED:
                yield out(*held[0])
                held, n = [], 0
    if held:
        yield out(*summed())


def pair_counts(alignments: DataFrame) -> DataFrame:
    """`pair` and how many documents hold it linked, `n`."""
    return alignments.select("steps", "times").mapInArrow(_count, "pair long, n long").groupBy(
        "pair").agg(F.sum("n").alias("n"))


def most_held(counts: DataFrame, most: int = HELD) -> DataFrame:
    """The pairs with the highest counts, at most `most`: counts are taken in classes of an eighth
    of a power of two, whole classes from the highest down."""
    class_ = F.floor(F.log2("n") * 8)
    sizes = sorted(((r["class"], r["many"]) for r in counts.groupBy(class_.alias("class")).agg(
        F.count(F.lit(1)).alias("many")).collect()), reverse=True)
    least, taken = None, 0
    for value, many in sizes:
        taken += many
        if taken > most:
            break
        least = value
    return counts.where(F.lit(False) if least is None else class_ >= least)


def _scorer(pairs: np.ndarray, counts: np.ndarray, best: np.ndarray, size_b: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, pair, times = _pairs(batch)
            at = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            known = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            n = np.where(known, counts[at] if len(pairs) else 0, 0)
            top = known & (n == best[pair // size_b])
            sums = [np.concatenate([[0], np.cumsum(x)])[offsets] for x in (times * top, times * n, ~known)]
            rest = pa.array(sums[2], pa.int32())
            names = ["row", "doc_id", *_NUMBERS, "groups_sha256"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [
                    pa.array(np.diff(sums[0])), pa.array(np.diff(sums[1])),
                    pa.ListArray.from_arrays(rest, pa.array(pair[~known])),
                    pa.ListArray.from_arrays(rest, pa.array(times[~known]))],
                names=[*names, "held_best", "held_sum", "pairs", "times"])
    return run


def scored(alignments: DataFrame, size_b: int, held: int = HELD) -> DataFrame:
    """Adds to written alignments `n_best`, links whose pair has the highest count of its A id, and
    `count_sum`, the sum of the counts over the links."""
    counts = written(pair_counts(alignments))
    a = F.floor(F.col("pair") / size_b)
    # One row per id of A at most.
    tops = counts.groupBy(a.alias("a")).agg(F.max("n").alias("best"))
    listed = tops.toPandas()
    best = np.zeros(int(listed.a.max()) + 1 if len(listed) else 1, np.int64)
    best[listed.a.to_numpy(np.int64)] = listed.best.to_numpy(np.int64)
    # At most `held` rows.
    often = most_held(counts, held).toPandas().sort_values("pair")
    known = often.pair.to_numpy(np.int64), often.n.to_numpy(np.int64)
    parts = alignments.mapInArrow(_scorer(*known, best, size_b), (
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, held_best long, held_sum long, pairs array<long>, times array<long>"))
    rest = parts.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    marked = counts.join(F.broadcast(tops), a == F.col("a")).select(
        "pair", "n", (F.col("n") == F.col("best")).alias("top"))
    sums = rest.join(marked, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("rest_best"),
        F.sum(F.col("times") * F.col("n")).alias("rest_sum"))
    return parts.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", *_NUMBERS,
        (F.col("held_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
        (F.col("held_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def alignment_report(docs: DataFrame, vocabulary_a: str = VOCABULARY_A,
                     vocabulary_b: str = VOCABULARY_B, held: int = HELD) -> DataFrame:
    """One row per row of docs: `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`,
    `count_sum`, `groups_sha256`."""
    import public_tokenizers
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path(f"{vocabulary_b}.model")).get_piece_size()
    return scored(written(aligned(docs, vocabulary_a, vocabulary_b, tokens=False)), size_b, held)
