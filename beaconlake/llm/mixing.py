"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. Raking scales the tokens of all cells
until they meet the target share of each source, each language and each topic at once, in turns of
one margin after the other. A cell's scaled tokens over the tokens it has is the probability of
its documents; it cannot pass 1, so a full cell stays full and the others make up for it in the
next turn. A document is drawn if the hash of its id is below that probability: a draw repeats,
and does not depend on how rows are dealt.

Only cells are raked, never documents: tasks add up the tokens of their documents per cell before
anything is shuffled. The cells stay a DataFrame, and a turn is a window over the cells of each
margin. A source with a third of all rows is a few cells like any other. Cells are counted and
measured first: up to FEW_CELLS of at most FEW_BYTES are raked in one task and sent to the
documents, whose texts then stay where they are; more are raked and joined by shuffles.

The topic of a document is where its hashed word profile lies to TOPIC_BITS random directions;
texts with similar vocabulary share it. Any column can take its place: `rake` and `sample` work on
the names they are given.

Targets by default: the shares of today to the powers in POWERS, which lifts what is rare, and a
budget of BUDGET of all tokens.

Cases: a null source or language is a value of its own; a null or empty text has no token, topic 0
and, as it costs nothing, the probability of its cell, or BUDGET in a cell without tokens. Rows
that repeat are drawn alike. A null doc_id is drawn as a value of its own. Other columns may
have any name that does not begin with `_mix_`, which are the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import saved

DIMENSIONS = ("source", "lang", "topic")
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
BUDGET = 0.5
TOPIC_BITS = 3
MAX_TURNS = 40
TURNS_PER_CHECK = 4
CLOSE = 1e-3
FEW_CELLS = 65_536
FEW_BYTES = 16 << 20
SEED = 42
_PROFILE = "_mix_profile"


def _profiles(texts: pa.Array) -> pa.Array:
    hasher = tb.Hasher(31, lower=True)
    tokens, topics = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for chunk in tb.chunks(texts):
        words = tb.words(chunk)
        h = hasher.ranges(chunk.buf, words.start, words.end)
        code = np.zeros(len(words.first) - 1, np.int64)
        for bit in range(TOPIC_BITS):
            side = (h >> np.uint64(bit) & np.uint64(1)).astype(np.int64) * 2 - 1
            sums = np.concatenate([[0], np.cumsum(side)])
            code += (sums[words.first[1:]] > sums[words.first[:-1]]).astype(np.int64) << bit
        tokens.append(words.counts)
        topics.append(code)
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(tokens)), pa.array(np.concatenate(topics).astype(np.int32))],
        names=["tokens", "topic"])


def profile(docs: DataFrame) -> Column:
    """Words of each text, and its topic."""
    @F.arrow_udf("tokens long, topic int")
    def read(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            yield _profiles(text)
    return read(docs["text"])


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """`value`, `target`: share of the tokens of each value, to this power and scaled to 1."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("t")).where("t > 0")
    total = sums.agg(F.sum(F.pow("t", F.lit(power)))).first()[0] or 1.0
    return sums.select("value", (F.pow("t", F.lit(power)) / F.lit(total)).alias("target"))


def _margin(dimension: str) -> Column:
    """What the cells of the same value take together. A value has as many cells as there are
    combinations of the other dimensions, however many documents it has."""
    return F.sum("weight").over(Window.partitionBy(dimension))


def are_few(cells: DataFrame) -> bool:
    """Whether there are at most FEW_CELLS cells, with at most FEW_BYTES of values."""
    values = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in cells.columns]
    count, size = cells.agg(F.count(F.lit(1)), F.sum(sum(values, F.lit(0)))).first()
    return count <= FEW_CELLS and (size or 0) <= FEW_BYTES


def rake(cells: DataFrame, targets: dict[str, DataFrame], budget: float) -> DataFrame:
    """Cells (the dimensions and `tokens`) with `weight`: tokens to take from each, at most all.
    It ends when all margins are met to CLOSE of the budget, or when full cells keep them from
    coming closer. A value without a target gets nothing."""
    names = [*cells.columns]
    for d, target in targets.items():
        cells = cells.join(target.withColumnsRenamed({"value": f"{d}_value", "target": f"{d}_target"}),
                           F.col(d).eqNullSafe(F.col(f"{d}_value")), "left").drop(f"{d}_value")
        cells = cells.withColumn(f"{d}_target", F.coalesce(f"{d}_target", F.lit(0.0)) * budget)
    cells = saved(cells.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double")))
    # Windows over one partition need no exchange.
    few = are_few(cells)
    cells = cells.coalesce(1) if few else cells
    worst = np.inf
    for _ in range(0, MAX_TURNS, TURNS_PER_CHECK):
        for _ in range(TURNS_PER_CHECK):
            for d in targets:
                scaled = F.col("weight") * F.col(f"{d}_target") / F.greatest(_margin(d), F.lit(1e-9))
                cells = cells.withColumn("weight", F.least(F.col("tokens").cast("double"), scaled))
        cells = saved(cells)
        cells = cells.coalesce(1) if few else cells
        off = [F.abs(_margin(d) - F.col(f"{d}_target")) / budget for d in targets]
        before, worst = worst, cells.select(
            F.greatest(*off, F.lit(0.0)).alias("off")).agg(F.max("off")).first()[0] or 0.0
        if worst <= CLOSE or before - worst < CLOSE / 10:
            break
    return cells.select(*names, "weight")


def drawn(probability: Column, seed: int = SEED) -> Column:
    """Whether the hash of the id, as a number in [0, 1), is below the probability."""
    spot = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return spot < probability


def probabilities(docs: DataFrame, powers: dict[str, float] = POWERS,
                  budget: float = BUDGET) -> DataFrame:
    """docs with the struct `_mix_profile` (tokens, topic) and `_mix_probability`. The name of a
    dimension is `topic` or that of a column."""
    read = docs.withColumn(_PROFILE, profile(docs))
    columns = {d: F.col(f"{_PROFILE}.topic") if d == "topic" else F.col(d) for d in powers}
    cells = saved(read.select(*[c.alias(d) for d, c in columns.items()],
                              F.col(f"{_PROFILE}.tokens").alias("tokens")).groupBy(*powers).agg(
        F.sum("tokens").alias("tokens")))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    targets = {d: saved(tempered(cells, d, power)) for d, power in powers.items()}
    raked = rake(cells, targets, max(total * budget, 1e-9)).select(
        *[F.col(d).alias(f"_mix_{d}") for d in powers],
        (F.col("weight") / F.col("tokens")).alias("_mix_probability"))
    if are_few(cells):
        raked = F.broadcast(raked)
    same = [columns[d].eqNullSafe(F.col(f"_mix_{d}")) for d in powers]
    met = read.join(raked, on=_all(same), how="left").drop(*[f"_mix_{d}" for d in powers])
    return met.withColumn("_mix_probability", F.coalesce("_mix_probability", F.lit(budget)))


def _all(conditions: list[Column]) -> Column:
    whole = conditions[0]
    for c in conditions[1:]:
        whole = whole & c
    return whole


def mixed(docs: DataFrame) -> DataFrame:
    """One row per row of docs: `doc_id`, `source`, `lang`, `topic`, `tokens`, `probability`,
    `sampled`."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text")
    return probabilities(slim).select(
        "doc_id", "source", "lang", f"{_PROFILE}.topic", f"{_PROFILE}.tokens",
        F.round("_mix_probability", 9).alias("probability"),
        drawn(F.round("_mix_probability", 9)).alias("sampled"))


def sampled_documents(docs: DataFrame) -> DataFrame:
    """The documents that are drawn, with all their columns."""
    return probabilities(docs).where(drawn(F.round("_mix_probability", 9))).select(
        *[docs[c] for c in docs.columns])
