"""The trie of conversations' prefixes, with sums over its subtrees by centroid decomposition.

A conversation is its turns in order; conversations that begin with the same turns share the nodes
of those prefixes. A node is named by a 127-bit polynomial hash of its turns' SHA-256 digests. Such
hashes put together: turns are sorted by range over all tasks, each task hashes the stretches it
has, and what came before a stretch is added afterwards, so a conversation with a third of all turns
is many tasks' work. `rebuilt` swaps the first turns of each conversation for those of another one by
the same arithmetic, without shuffling a text.

Sums over subtrees (`subtree_sums`) follow the centroid decomposition of the parent edges. The
weight of a node is its number of members, which makes every subtree's weight known beforehand. In
each component the deepest node whose subtree has over half of the weight is its centroid. What its
subtree holds in the component is added to it and to all nodes on the path from it to the
component's top; then it is taken out, and its children's subtrees and the part above are
components of at most half the weight. After a logarithmic number of rounds all nodes are out, and
each has been given every part of its subtree exactly once, whatever the shape of the trie.

The root is the first centroid; its children's subtrees are the components. Those of over PART rows
are split in DataFrames, all at once in each round, until the parts are small; a part is settled
inside a task, with numpy, in the same way.

Cases: turns go by `turn`, null first; equal ones by role, then text. A null role or text is empty;
rows that repeat are turns of their own. Rows without a conv_id belong to no conversation and are
left out. Remainders of negative ids are negative, as in SQL. Without conversations there is no
node, not even the root. Other columns may have any name: only `conv_id`, `turn`, `role` and `text`
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"turns of a conversation").digest()[:15], "big")
DONORS = 5
HEADS = 9
PART = 1 << 16
CHUNK_ROWS = 1 << 16
IDS_PER_CHUNK = 4096


def _whole(high: int, low: int) -> int:
    return high << 64 | low & 0xFFFFFFFFFFFFFFFF


def _halves(values: list[int]) -> tuple[pa.Array, pa.Array]:
    return (pa.array([v >> 64 for v in values], pa.int64()),
            pa.array(np.array([v & 0xFFFFFFFFFFFFFFFF for v in values], np.uint64).view(np.int64)))


# Turns in order, and their hashes

def ordered_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `digest`, `bytes` of each turn, sorted by range over all tasks. Role and text are
    carried along for turns only that another text claims the same place as."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat_ws(":", F.octet_length(role).cast("string"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), role.alias("role"), text.alias("text"))
    tied = saved(turns.groupBy("conv_id", "turn").agg(
        F.min(F.xxhash64("digest")).alias("a"), F.max(F.xxhash64("digest")).alias("b")).where(
        "a <> b").select("conv_id", "turn"))
    slim = turns.select("conv_id", "turn", "digest", "bytes", F.lit("").alias("role"), F.lit("").alias("text"))
    if not tied.isEmpty():
        t = tied.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"))
        met = turns.join(t, (F.col("conv_id") == F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left")
        slim = met.select("conv_id", "turn", "digest", "bytes", *(
            F.when(F.col("c").isNotNull(), F.col(x)).otherwise("").alias(x) for x in ("role", "text")))
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(),
             F.col("text").asc(), F.col("digest").asc()]
    return slim.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "bytes")


_HASHED = "part int, conv_id long, place long, high long, low long, up_high long, up_low long, bytes long"


def _hash_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and hash of each turn within the stretch of its conversation in this task; `up` is the
    hash before the turn."""
    from pyspark import TaskContext

    part, conv, n, h = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        convs, places, hashes, before = batch.column("conv_id").to_pylist(), [], [], []
        for c, digest in zip(convs, batch.column("digest").to_pylist()):
            if c != conv:
                conv, n, h = c, 0, 0
            before.append(h)
            n, h = n + 1, (h * BASE + int.from_bytes(digest, "big")) % PRIME
            places.append(n)
            hashes.append(h)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(convs), pa.int32()), batch.column("conv_id"),
             pa.array(places, pa.int64()), *_halves(hashes), *_halves(before), batch.column("bytes")],
            names=["part", "conv_id", "place", "high", "low", "up_high", "up_low", "bytes"])


def _carried(stretches: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """(part, conversation) -> turns and hash before it. Only the first and the last conversation
    of a task can go on in another one: two rows a task."""
    edges = stretches.groupBy("part").agg(F.min("conv_id").alias("a"), F.max("conv_id").alias("b"))
    ends = stretches.join(F.broadcast(edges), "part").where("conv_id = a or conv_id = b").groupBy(
        "part", "conv_id").agg(F.max_by(F.struct("place", "high", "low"), "place").alias("end"))
    carried, reached = {}, {}
    for row in sorted(ends.collect(), key=lambda r: r["part"]):
        n, h = reached.get(row["conv_id"], (0, 0))
        if n:
            carried[row["part"], row["conv_id"]] = n, h
        end = row["end"]
        reached[row["conv_id"]] = (
            n + end["place"], (h * pow(BASE, end["place"], PRIME) + _whole(end["high"], end["low"])) % PRIME)
    return carried


def _continued(carried: dict):
    parts = {part for part, _ in carried}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or batch.column("part")[0].as_py() not in parts:
                yield batch
                continue
            rows, hashes, before, places = batch.to_pylist(), [], [], []
            for r in rows:
                n, h = carried.get((r["part"], r["conv_id"]), (0, 0))
                shift = h * pow(BASE, r["place"] - 1, PRIME) if n else 0
                before.append((shift + _whole(r["up_high"], r["up_low"])) % PRIME)
                hashes.append((shift * BASE + _whole(r["high"], r["low"])) % PRIME)
                places.append(r["place"] + n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("conv_id"), pa.array(places, pa.int64()),
                 *_halves(hashes), *_halves(before), batch.column("bytes")], names=batch.schema.names)
    return run


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `place` from 1, the hash of the turns up to it (`high`, `low`) and before it
    (`up_high`, `up_low`), and the `bytes` of its text."""
    stretches = saved(ordered_turns(conversations).mapInArrow(_hash_stretches, _HASHED))
    return stretches.mapInArrow(_continued(_carried(stretches)), _HASHED).drop("part")


# Conversations with the first turns of others

def _shifts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What to add (times a power of BASE) to a conversation's own hashes, and its first node."""
    for batch in batches:
        shifts, tops = [], []
        for r in batch.to_pylist():
            head = [_whole(x["high"], x["low"]) for x in r["head"]]
            own = _whole(r["own_high"] or 0, r["own_low"] or 0)
            shifts.append(((head[-1] if head else 0) - own) % PRIME)
            tops.append(head[0] if head else
                        (_whole(r["next_high"] or 0, r["next_low"] or 0) + shifts[-1] * BASE) % PRIME)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("length"), batch.column("cut"),
             *_halves(shifts), *_halves(tops), batch.column("head")],
            names=["conv_id", "length", "cut", "shift_high", "shift_low", "top_high", "top_low", "head"])


def _shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "length", "depth", "high", "low", "up_high", "up_low", "bytes", "top_high", "top_low"]
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (
            "after", "shift_high", "shift_low", "high", "low", "up_high", "up_low")]
        hashes, before = [], []
        for after, s_high, s_low, high, low, up_high, up_low in zip(*columns):
            shift = _whole(s_high, s_low) * pow(BASE, after - 1, PRIME)
            before.append((_whole(up_high, up_low) + shift) % PRIME)
            hashes.append((_whole(high, low) + shift * BASE) % PRIME)
        made = dict(zip(["high", "low", "up_high", "up_low"], [*_halves(hashes), *_halves(before)]))
        yield pa.RecordBatch.from_arrays(
            [made[n] if n in made else batch.column(n) for n in names], names=names)


_PATHS = ("conv_id long, length long, depth long, high long, low long, up_high long, up_low long, "
          "bytes long, top_high long, top_low long")


def rebuilt(turns: DataFrame, donor: Column, cut: Column, most: int) -> DataFrame:
    """One row per conversation and depth, from depth 0 (the root, hash 0): the first `cut` turns of
    the conversation `donor` (all if it has fewer), then its own turns after its first `cut`. Both
    are expressions of conv_id; no cut is over `most`. Adds `length`, and the node of depth 1."""
    own = turns.withColumn("cut", cut)
    at, after = F.col("place") == F.col("cut"), F.col("place") == F.col("cut") + 1
    picked = own.groupBy("conv_id", "cut").agg(F.max("place").alias("n"), *(
        F.max(F.when(where, F.col(half))).alias(f"{name}_{half}")
        for where, name in ((at, "own"), (after, "next")) for half in ("high", "low")))
    # At most `most` turns a donor.
    entry = F.struct("place", "high", "low", "up_high", "up_low", "bytes")
    heads = turns.where(F.col("place") <= most).groupBy(F.col("conv_id").alias("donor")).agg(
        F.sort_array(F.collect_list(entry)).alias("head"))
    met = picked.withColumn("donor", donor).join(heads, "donor", "left").withColumn("head", F.when(
        F.col("head").isNotNull() & (F.col("cut") > 0), F.slice("head", 1, F.greatest("cut", F.lit(1)).cast("int"))
    ).otherwise(F.array().cast(heads.schema["head"].dataType)))
    kind = heads.schema["head"].dataType.simpleString()
    # Each conversation's numbers; its own turns, if any are left, come `cut` places too late.
    lengths = met.withColumn("length", F.size("head") + F.greatest(F.col("n") - F.col("cut"), F.lit(0)))
    known = saved(lengths.select(
        "conv_id", F.col("length").cast("long"), F.col("cut").cast("long"), "own_high", "own_low", "next_high",
        "next_low", "head").mapInArrow(_shifts, (
            "conv_id long, length long, cut long, shift_high long, shift_low long, top_high long, "
            f"top_low long, head {kind}")))
    fixed = known.select("conv_id", "length", "top_high", "top_low", F.explode("head").alias("e")).select(
        "conv_id", "length", F.col("e.place").alias("depth"), "e.high", "e.low", "e.up_high", "e.up_low",
        "e.bytes", "top_high", "top_low")
    rest = turns.join(known, "conv_id").where("place > cut").select(
        "conv_id", "length", (F.size("head") + F.col("place") - F.col("cut")).cast("long").alias("depth"),
        (F.col("place") - F.col("cut")).alias("after"), "shift_high", "shift_low", "high", "low",
        "up_high", "up_low", "bytes", "top_high", "top_low").mapInArrow(_shifted, _PATHS)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = known.select("conv_id", "length", zero.alias("depth"), zero.alias("high"), zero.alias("low"),
                         none.alias("up_high"), none.alias("up_low"), zero.alias("bytes"),
                         none.alias("top_high"), none.alias("top_low"))
    return fixed.unionByName(rest).unionByName(roots)


# Digests of the conversations that end at a node

def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each node in pieces of text, in the order in which they come."""
    def out(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
            names=["high", "low", "first", "ids"])

    node, ids = None, []
    for batch in batches:
        rows = []
        for high, low, conv in zip(*(batch.column(c).to_pylist() for c in ("high", "low", "conv_id"))):
            if (high, low) != node or len(ids) == IDS_PER_CHUNK:
                if ids:
                    rows.append((*node, ids[0], ",".join(map(str, ids))))
                node, ids = (high, low), []
            ids.append(conv)
        yield out(rows)
    if ids:
        yield out([(*node, ids[0], ",".join(map(str, ids)))])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, fed in one after the other: none is held."""
    def out(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
            names=["high", "low", "ends_sha256"])

    node, digest = None, None
    for batch in batches:
        rows = []
        for high, low, ids in zip(*(batch.column(c).to_pylist() for c in ("high", "low", "ids"))):
            if (high, low) == node:
                digest.update(b"," + ids.encode())
                continue
            if node:
                rows.append((*node, digest.hexdigest()))
            node, digest = (high, low), hashlib.sha256(ids.encode())
        yield out(rows)
    if node:
        yield out([(*node, digest.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """`ends_sha256` of each node (`high`, `low`): its `conv_id`s in order, comma-joined. Ids are
    sorted by range over all tasks and joined to pieces there; only pieces meet in one task."""
    order = ["high", "low", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _joined_ids, "high long, low long, first long, ids string")
    return pieces.repartition("high", "low").sortWithinPartitions("high", "low", "first").mapInArrow(
        _digests, "high long, low long, ends_sha256 string")


# Sums over subtrees

def decomposed(parent: np.ndarray, part: np.ndarray, weight: np.ndarray, subtree: np.ndarray,
               values: np.ndarray) -> np.ndarray:
    """Sums of the columns of `values` over each node's subtree, for a forest whose nodes know their
    parent (-1 at a top), part (one tree each), weight and the weight of their subtree."""
    n = len(parent)
    # Intervals: a node's begins where its parent's does, after the parent and its elder siblings.
    top = parent < 0
    siblings = np.argsort(np.where(top, -1, parent), kind="stable")
    before = np.empty(n, np.int64)
    sums = np.cumsum(subtree[siblings]) - subtree[siblings]
    fresh = np.flatnonzero(np.append(True, np.diff(np.where(top, -1, parent)[siblings]) != 0)) if n else []
    before[siblings] = sums - np.repeat(sums[fresh], np.diff(np.append(fresh, n)).astype(np.int64))
    begin = np.where(top, 0, before + weight[parent])
    up = np.where(top, np.arange(n), parent)
    while True:
        begin, further = begin + begin[up], up[up]
        if (further == up).all():
            break
        up = further
    begin = begin + before[up]
    order = np.argsort(begin, kind="stable")
    total = np.zeros_like(values)
    label = part.astype(np.int64).copy()
    span = int((begin + subtree).max(initial=0)) + 1
    while len(order):
        o = order[np.argsort(label[order], kind="stable")]
        first = np.flatnonzero(np.append(True, np.diff(label[o]) != 0))
        size = np.diff(np.append(first, len(o)))
        rank = np.repeat(np.arange(len(first)), size)
        at, end = begin[o], begin[o] + subtree[o]
        place = rank * span + at
        after = np.searchsorted(place, rank * span + end)
        held = np.concatenate([[0], np.cumsum(weight[o])])
        inside = held[after] - held[:-1]
        whole = (held[first + size] - held[first])[rank]
        # Subtrees with over half of the weight are nested; the deepest begins last.
        here = np.maximum.reduceat(np.where(2 * inside > whole, np.arange(len(o)), -1), first)
        added = np.concatenate([np.zeros((1, values.shape[1]), values.dtype), np.cumsum(values[o], axis=0)])
        gain = added[after[here]] - added[here]
        center = at[here][rank]
        path = (at <= center) & (center < end)
        total[o[path]] += gain[rank[path]]
        child = parent[o] == o[here][rank]
        under = (center < at) & (at < end[here][rank])
        label[o] = np.where(under, len(first) + np.cumsum(child), rank)
        gone = np.zeros(n, bool)
        gone[o[here]] = True
        order = order[~gone[order]]
    return total


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole parts, CHUNK_ROWS or more at a time; rows come sorted by part."""
    def solved(table: pa.Table) -> pa.RecordBatch:
        c = {name: table.column(name).to_numpy() for name in (
            "part_high", "part_low", "n_convs", "weight", "leaf", "tokens", "conv_id")}
        new = np.append(True, (np.diff(c["part_high"]) != 0) | (np.diff(c["part_low"]) != 0))
        part = np.cumsum(new) - 1
        nodes, ups = (list(zip(table.column(a).to_pylist(), table.column(b).to_pylist()))
                      for a, b in (("high", "low"), ("up_high", "up_low")))
        index = {node: i for i, node in enumerate(nodes)}
        parent = np.array([index.get(up, -1) for up in ups], np.int64)
        parent[(parent >= 0) & (part[parent] != part)] = -1
        total = decomposed(parent, part, c["n_convs"], c["weight"],
                           np.stack([c["leaf"], c["tokens"]], axis=1).astype(np.int64))
        children = np.bincount(parent[parent >= 0], minlength=len(parent))
        upper = pa.array(c["conv_id"][parent], pa.int64(), mask=parent < 0)
        kept = table.select(["high", "low", "conv_id", "depth", "n_convs"]).combine_chunks()
        known_children, known_parent = (table.column(x).combine_chunks() for x in ("children", "parent_conv_id"))
        from pyarrow import compute as pc

        columns = [*(kept.column(i).combine_chunks() for i in range(5)),
                   pc.coalesce(known_parent, upper),
                   pc.coalesce(known_children, pa.array(children, pa.int64())),
                   pa.array(total[:, 0] + table.column("add_leaves").to_numpy()),
                   pa.array(total[:, 1] + table.column("add_tokens").to_numpy())]
        return pa.RecordBatch.from_arrays(columns, names=_SETTLED_NAMES)

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < CHUNK_ROWS:
            continue
        table = pa.Table.from_batches(held)
        high, low = table.column("part_high").to_numpy(), table.column("part_low").to_numpy()
        open_ = int(np.argmax((high == high[-1]) & (low == low[-1])))
        if open_:
            yield solved(table.slice(0, open_))
        held, rows = table.slice(open_).combine_chunks().to_batches(), table.num_rows - open_
    if rows:
        yield solved(pa.Table.from_batches(held))


_SETTLED_NAMES = ["high", "low", "conv_id", "depth", "n_convs", "parent_conv_id", "n_children",
                  "n_leaves", "saved_tokens"]
_SETTLED = ("high long, low long, conv_id long, depth long, n_convs long, parent_conv_id long, "
            "n_children long, n_leaves long, saved_tokens long")
_PART = ["part_high", "part_low"]


def _split(nodes: DataFrame, paths: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Parts of at most `most` rows, and the centroids that were taken out between them."""
    children = nodes.groupBy(F.col("up_high").alias("high"), F.col("up_low").alias("low")).agg(
        F.count(F.lit(1)).alias("children"))
    above = nodes.select(F.col("high").alias("up_high"), F.col("low").alias("up_low"),
                         F.col("conv_id").alias("parent_conv_id"))
    now = saved(nodes.drop("children", "parent_conv_id").join(children, ["high", "low"], "left").join(
        above, ["up_high", "up_low"], "left").withColumn("children", F.coalesce("children", F.lit(0).cast("long"))))
    small, taken = [], []
    while True:
        heavy = saved(now.groupBy(*_PART).agg(F.sum("n_convs").alias("part_weight")).where(
            F.col("part_weight") > most))
        small.append(now.join(heavy, _PART, "left_anti"))
        if heavy.isEmpty():
            break
        now = now.join(heavy, _PART)
        # The subtrees with over half of a part's weight are nested, so their weights differ.
        center = saved(now.where(2 * F.col("weight") > F.col("part_weight")).groupBy(*_PART).agg(
            F.min_by(F.struct("high", "low", "depth", "conv_id", "weight"), "weight").alias("c")))
        met = now.drop("part_weight").join(center, _PART)
        child = met.where("up_high = c.high and up_low = c.low").select(
            *_PART, F.col("high").alias("child_high"), F.col("low").alias("child_low"))
        through = paths.join(child, (F.col("high") == F.col("child_high")) & (F.col("low") == F.col("child_low"))
                             ).select("conv_id", *_PART, "child_high", "child_low")
        on_path = paths.alias("p").join(center.alias("k"), (F.col("p.conv_id") == F.col("k.c.conv_id"))
                                        & (F.col("p.depth") < F.col("k.c.depth"))).select(
            "p.high", "p.low", *_PART, F.lit(True).alias("on_path"))
        itself = (F.col("high") == F.col("c.high")) & (F.col("low") == F.col("c.low"))
        placed = saved(met.join(through, ["conv_id", *_PART], "left").join(
            on_path, ["high", "low", *_PART], "left").withColumns({
                "itself": itself, "on_path": F.coalesce("on_path", F.lit(False)),
                "under": F.col("child_high").isNotNull() & (F.col("depth") > F.col("c.depth"))}))
        gains = placed.where("itself or under").groupBy(*_PART).agg(
            F.sum("leaf").alias("gain_leaves"), F.sum("tokens").alias("gain_tokens"))
        given = placed.join(gains, _PART)
        lift = F.col("itself") | F.col("on_path")
        next_ = saved(given.select(
            *(c for c in now.columns if c not in (*_PART, "weight", "add_leaves", "add_tokens", "part_weight")),
            *(F.when(F.col("under"), F.col(f"child_{x}")).otherwise(F.col(f"part_{x}")).alias(f"part_{x}")
              for x in ("high", "low")),
            (F.col("weight") - F.when(F.col("on_path"), F.col("c.weight")).otherwise(0)).alias("weight"),
            *((F.col(f"add_{x}") + F.when(lift, F.col(f"gain_{x}")).otherwise(0)).alias(f"add_{x}")
              for x in ("leaves", "tokens")), "itself"))
        taken.append(next_.where("itself"))
        now = next_.where("not itself").drop("itself")
    names = small[0].columns
    parts = small[0]
    for x in small[1:]:
        parts = parts.unionByName(x.select(*names))
    out = None
    for x in taken:
        x = x.select("high", "low", "conv_id", "depth", "n_convs", "parent_conv_id",
                     F.col("children").alias("n_children"), F.col("add_leaves").alias("n_leaves"),
                     F.col("add_tokens").alias("saved_tokens"))
        out = x if out is None else out.unionByName(x)
    return parts, out


def subtree_sums(nodes: DataFrame, paths: DataFrame, most: int = PART) -> DataFrame:
    """Adds parent's conv_id, number of children, leaves and saved tokens to all nodes but the root."""
    long = F.lit(0).cast("long")
    start = nodes.where("depth > 0").select(
        "high", "low", "up_high", "up_low", "conv_id", "depth", "n_convs", F.col("below").alias("weight"),
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("tokens"),
        F.col("top_high").alias("part_high"), F.col("top_low").alias("part_low"),
        long.alias("add_leaves"), long.alias("add_tokens"), F.lit(None).cast("long").alias("children"),
        F.lit(None).cast("long").alias("parent_conv_id"))
    large = saved(start.where((F.col("weight") > most) & (F.col("depth") == 1)).select(*_PART))
    parts, taken = start, None
    if not large.isEmpty():
        tops = large.select(F.col("part_high").alias("top_high"), F.col("part_low").alias("top_low"))
        inside = saved(paths.join(tops, ["top_high", "top_low"], "left_semi").select(
            "conv_id", "depth", "high", "low"))
        split, taken = _split(start.join(large, _PART, "left_semi"), inside, most)
        parts = start.join(large, _PART, "left_anti").unionByName(split.select(*start.columns))
    settled = parts.repartition(*_PART).sortWithinPartitions(*_PART).mapInArrow(_settle, _SETTLED)
    return settled if taken is None else settled.unionByName(taken)


def trie(conversations: DataFrame, donor: Column | None = None, cut: Column | None = None,
         heads: int = 0, most: int = PART) -> DataFrame:
    """One row per node: `conv_id`, `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`,
    `saved_tokens`, `ends_sha256`. With `donor` and `cut` (below `heads`), conversations are rebuilt
    first."""
    zero = F.lit(0)
    paths = saved(rebuilt(hashed_turns(conversations), F.col("conv_id") if donor is None else donor,
                          zero if cut is None else cut, max(heads - 1, 0)))
    nodes = saved(paths.groupBy("high", "low").agg(
        F.max("depth").alias("depth"), F.max("up_high").alias("up_high"), F.max("up_low").alias("up_low"),
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("below"),
        F.sum((F.col("length") == F.col("depth")).cast("long")).alias("n_ends"),
        F.max("top_high").alias("top_high"), F.max("top_low").alias("top_low")))
    sums = subtree_sums(nodes, paths, most)
    # One row: the root is where all components meet.
    root = nodes.agg(
        F.min("conv_id").alias("root_id"), F.max("n_convs").alias("n_convs"),
        F.sum((F.col("depth") == 1).cast("long")).alias("n_children"),
        F.sum((F.col("n_ends") == F.col("n_convs")).cast("long")).alias("n_leaves"),
        F.sum((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")).where("root_id is not null")
    long = F.lit(0).cast("long")
    root_row = root.select(long.alias("high"), long.alias("low"), F.col("root_id").alias("conv_id"), long.alias("depth"),
                           "n_convs", F.lit(None).cast("long").alias("parent_conv_id"), "n_children",
                           "n_leaves", "saved_tokens")
    first = root.first()
    known = sums.withColumn("parent_conv_id", F.coalesce(
        "parent_conv_id", F.lit(first["root_id"] if first else None).cast("long")))
    ends = end_digests(paths.where("depth = length").select("high", "low", "conv_id"))
    return known.unionByName(root_row).join(ends, ["high", "low"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, most: int = PART) -> DataFrame:
    """The trie of conversations that begin as their group's first one does: conversation
    c - c % DONORS gives its first crc32(c) % HEADS turns."""
    c = F.col("conv_id")
    return trie(conversations, c - c % DONORS, F.crc32(c.cast("string").cast("binary")) % HEADS, HEADS, most)


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
bits AS (SELECT b, CASE WHEN k = 8 THEN v END AS v FROM (
  WITH RECURSIVE r AS (
    SELECT b, b AS v, 0 AS k FROM range(256) AS g(b)
    UNION ALL
    SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM r WHERE k < 8)
  SELECT * FROM r WHERE k = 8)),
tab AS (SELECT list(v ORDER BY b) AS l FROM bits),
h AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda crc, byte: xor(crc // 256, l[xor(crc, byte) % 256 + 1]::BIGINT)), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM t), tab),
turns AS (
  SELECT h.c, d.i, d.role, d.text, 0 AS own FROM h JOIN t d ON d.c = h.c - h.c % 5 AND d.i <= h.h
  UNION ALL
  SELECT h.c, t.i, t.role, t.text, 1 FROM h JOIN t ON t.c = h.c AND t.i > h.h),
s AS (SELECT c, list({'r': role, 't': text} ORDER BY own, i) AS seq FROM turns GROUP BY c),
whole AS (SELECT h.c, coalesce(s.seq, []) AS seq FROM h LEFT JOIN s USING (c)),
p AS (SELECT c, len(seq) AS n, unnest(range(len(seq) + 1)) AS d, seq FROM whole),
n AS (
  SELECT d, list_slice(seq, 1, d) AS node, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM p GROUP BY ALL),
k AS (SELECT d - 1 AS d, list_slice(node, 1, d - 1) AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
v AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children,
         CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.node[n.d].t) END AS own
  FROM n LEFT JOIN k ON k.d = n.d AND k.node = n.node),
a AS (SELECT unnest(range(d + 1)) AS up, node, n_children, own FROM v),
u AS (
  SELECT up AS d, list_slice(node, 1, up) AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         sum(own)::BIGINT AS saved_tokens
  FROM a GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, u.n_leaves,
       u.saved_tokens, v.ends_sha256
FROM v JOIN u ON u.d = v.d AND u.node = v.node
LEFT JOIN n q ON q.d = v.d - 1 AND q.node = list_slice(v.node, 1, v.d - 1)
"""
