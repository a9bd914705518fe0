"""Merkle manifest of a dataset, its trees stored in the van Emde Boas layout.

Leaves are digests of rows. Per group (a source) they ascend by an order column; every ``RUN``
consecutive nodes of a level become the digest of their digests until one is left, the group's
subroot; the subroots, in group order, make the tree of the whole in the same way.

A tree is cut into aligned blocks of ``RUN ** height`` leaves. A block is one row: its nodes lie in
one array, laid out by halving the height again and again: the top half of the levels first, then the
subtrees below it, each laid out in the same way (``address``). Construction and the search for
siblings work by these addresses alone, and whatever the size of a page or a cache line, the nodes of
a path lie in few of them. The blocks' roots are the leaves of the next round, until a group has one
block. Paths come down the same way: a block adds its own siblings to what the round above gave its
root.

Rows are numbered without gathering a group: they are sorted by ranges of (group, order, digest, row),
each task counts its own, and the counts of the tasks are added up. So a group, an id or a row with a
third of all rows is cut over many tasks; a task holds one block.

Edge rows: null fields are part of the digest (``-``); the null group comes first; rows without an
order value come first in their group, equal ones are ordered by digest, and fully equal rows are
leaves of their own; an empty table has no rows and no root; a lone leaf is its subroot, a lone
subroot the root; other columns are ignored. Very long texts are digested where they are read; only
digests go on from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.session import run_dir

RUN, HEIGHT = 16, 3
# Leaves whose paths go out in one Arrow batch.
EMITTED = 1_024
PATH = "array<struct<place:int,others:string>>"
_WIDTH = 32


# ---- digests ------------------------------------------------------------------------------------

def digest(*fields: Column) -> Column:
    """Hex SHA-256 of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                                F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def path_digest(path: Column) -> Column:
    """Digest of all siblings on a path, from the leaf's to the root's."""
    return F.sha2(F.array_join(F.transform(path, lambda s: s["others"]), ""), 256)


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    def up(node: Column, step: Column) -> Column:
        left = step["place"] * F.lit(2 * _WIDTH)
        return F.sha2(F.concat(F.substring(step["others"], F.lit(1), left), node,
                               F.substring(step["others"], left + 1, F.length(step["others"]))), 256)
    return F.aggregate(path, leaf, up)


# ---- one block ----------------------------------------------------------------------------------

def _above(leaves: int, levels: int) -> int:
    """Nodes so many levels above so many leaves."""
    return -(-leaves // RUN ** levels)


def size(levels: int, leaves: int) -> int:
    """Nodes of a tree with that many levels, its leaves filled from the left."""
    return sum(_above(leaves, level) for level in range(levels))


def address(levels: int, leaves: int, level: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` of a level (0: leaves) lie in the layout of the tree. Subtrees are
    full but for the last one, so that nothing has to be looked up and no place is left empty."""
    if levels == 1:
        return np.zeros_like(index)
    low = levels - levels // 2
    if level >= low:
        return address(levels - low, _above(leaves, low), level - low, index)
    width = RUN ** (low - 1)
    per_tree = RUN ** (low - 1 - level)
    tree = index // per_tree
    inside = index - tree * per_tree
    last = _above(leaves, low - 1) - 1
    within = np.where(tree == last, address(low, leaves - last * width, level, inside),
                      address(low, width, level, inside))
    return size(levels - low, _above(leaves, low)) + tree * size(low, width) + within


def _level(store: np.ndarray, levels: int, leaves: int, level: int) -> str:
    """The digests of a level from left to right, as hex."""
    return store[address(levels, leaves, level, np.arange(_above(leaves, level)))].tobytes().hex()


def build(digests: np.ndarray, levels: int) -> np.ndarray:
    """All nodes over the given leaves (rows of 32 bytes), in layout order."""
    leaves = len(digests)
    store = np.empty((size(levels, leaves), _WIDTH), np.uint8)
    store[address(levels, leaves, 0, np.arange(leaves))] = digests
    step = RUN * 2 * _WIDTH
    for level in range(levels - 1):
        below = _level(store, levels, leaves, level)
        nodes = b"".join(hashlib.sha256(below[at:at + step].encode()).digest()
                         for at in range(0, len(below), step))
        above = np.arange(_above(leaves, level + 1))
        store[address(levels, leaves, level + 1, above)] = np.frombuffer(nodes, np.uint8).reshape(-1, _WIDTH)
    return store


def siblings(store: np.ndarray, levels: int, leaves: int) -> list[list[tuple[int, str]]]:
    """Per level below the root and per node: its place in its run, and the others of the run."""
    found, hexed, step = [], 2 * _WIDTH, RUN * 2 * _WIDTH
    for level in range(levels - 1):
        line, nodes = _level(store, levels, leaves, level), []
        for at in range(0, len(line), step):
            run = line[at:at + step]
            nodes += [(n, run[:n * hexed] + run[(n + 1) * hexed:]) for n in range(len(run) // hexed)]
        found.append(nodes)
    return found


# ---- blocks as tables ---------------------------------------------------------------------------

def _stored(rows: DataFrame, name: str) -> DataFrame:
    path = run_dir(rows.sparkSession, f"merkle-{name}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _numbered(rows: DataFrame) -> DataFrame:
    """``grp``, ``digest``, ``carried`` with ``pos``, the place in the group, and its ``total``."""
    by = ["grp", "ord", "digest", "nth"]
    line = (rows.withColumn("nth", F.monotonically_increasing_id())
            .repartitionByRange(*by).sortWithinPartitions(*by))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = (f"grp {kinds['grp']}, digest binary, carried {kinds['carried']}, part int, local long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, reached = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            groups = batch["grp"].to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]][:len(groups)])
            local = np.arange(len(groups)) - np.repeat(first, np.diff(np.r_[first, len(groups)]))
            if len(groups) and groups[0] == last:
                local[:first[1] if len(first) > 1 else len(groups)] += reached
            if len(groups):
                last, reached = groups[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch["grp"], batch["digest"], batch["carried"],
                 pa.array(np.full(len(groups), part, np.int32)), pa.array(local, pa.int64())],
                ["grp", "digest", "carried", "part", "local"])

    line = _stored(line.mapInArrow(count, out), "order")
    # A group has as many rows here as tasks have met it.
    sums = line.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("grp")
    before = F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("grp", "part", F.coalesce(before, F.lit(0)).alias("before"),
                       F.sum("n").over(group).alias("total"))
    return line.join(sums, ["grp", "part"]).select(
        "grp", (F.col("before") + F.col("local")).alias("pos"), "total", "digest", "carried")


_BLOCK = "grp string, block long, total long, levels int, leaves int, root string, nodes binary"


def _blocks(rows: DataFrame, height: int, name: str) -> DataFrame:
    """One row per aligned block of the rows (``grp``, ``pos``, ``total``, ``digest``, ``carried``)."""
    width = RUN ** height
    carried = rows.schema["carried"].dataType.simpleString()
    dealt = (rows.withColumn("block", F.floor(F.col("pos") / width))
             .repartition("grp", "block").sortWithinPartitions("grp", "block", "pos"))

    def made(table: pa.Table) -> pa.RecordBatch:
        total, leaves, levels = table["total"][0].as_py(), table.num_rows, height + 1
        if total <= width:
            levels = next(h for h in range(height + 1) if RUN ** h >= total) + 1
        raw = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, _WIDTH)
        store = build(raw, levels)
        top = store[address(levels, leaves, levels - 1, np.zeros(1, np.int64))]
        held = table["carried"].combine_chunks()
        held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
        return pa.RecordBatch.from_arrays(
            [table["grp"].chunk(0)[:1], table["block"].chunk(0)[:1], pa.array([total], pa.int64()),
             pa.array([levels], pa.int32()), pa.array([leaves], pa.int32()),
             pa.array([top.tobytes().hex()]), pa.array([store.tobytes()], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, leaves], pa.int32()), held)],
            ["grp", "block", "total", "levels", "leaves", "root", "nodes", "carried"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            groups = batch["grp"].to_numpy(zero_copy_only=False)
            blocks = batch["block"].to_numpy()
            new = (groups[1:] != groups[:-1]) | (blocks[1:] != blocks[:-1])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(groups)]
            for begin, end in zip(cuts[:-1], cuts[1:]):
                if begin == end:
                    continue
                here = groups[begin], blocks[begin]
                if pending and here != at:
                    yield made(pa.Table.from_batches(pending))
                    pending = []
                at = here
                pending.append(batch.slice(begin, end - begin))
        if pending:
            yield made(pa.Table.from_batches(pending))

    return _stored(dealt.mapInArrow(run, f"{_BLOCK}, carried array<{carried}>"), name)


def _rounds(rows: DataFrame, height: int, name: str) -> list[DataFrame]:
    """Blocks over the rows, blocks over the roots of groups that have several, and so on."""
    rounds, width = [_blocks(rows, height, f"{name}-0")], RUN ** height
    while True:
        open_ = rounds[-1].where(F.col("total") > width)
        if open_.isEmpty():
            return rounds
        roots = open_.select("grp", F.col("block").alias("pos"),
                             F.ceil(F.col("total") / width).alias("total"),
                             F.unhex("root").alias("digest"), F.struct(F.lit(0).alias("_")).alias("carried"))
        rounds.append(_blocks(roots, height, f"{name}-{len(rounds)}"))


@dataclass(frozen=True)
class Manifest:
    """Stored blocks of the groups' trees and of the tree over their subroots, round by round."""

    groups: list[DataFrame]
    tops: list[DataFrame]
    height: int

    @property
    def subroots(self) -> DataFrame:
        """``grp`` (see ``manifest``), ``rows`` and ``subroot`` of every group."""
        return self.tops[0].select(F.inline("carried"))


def manifest(rows: DataFrame, group: str, order: str, leaf: str, height: int = HEIGHT) -> Manifest:
    """Trees over ``rows``: ``leaf`` holds their digests (hex), every column is carried along. The key
    ``grp`` of a group is its name as text behind an ``s``; that of the null group is empty."""
    width = RUN ** height
    slim = rows.select(F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("")).alias("grp"),
                       F.col(order).alias("ord"), F.unhex(leaf).alias("digest"),
                       F.struct(*rows.columns).alias("carried"))
    groups = _rounds(_numbered(_stored(slim, "leaves")), height, "groups")
    done = None
    for n, blocks in enumerate(groups):
        whole = blocks.where(F.col("total") <= width).select(
            "grp", "root", F.col("total").alias("rows"), F.lit(n).alias("round"))
        done = whole if done is None else done.unionAll(whole)
    sizes = groups[0].groupBy("grp").agg(F.sum("leaves").alias("rows"))
    roots = done.drop("rows").join(sizes, "grp").select(
        F.lit("").alias("grp"), F.col("grp").alias("ord"), F.unhex("root").alias("digest"),
        F.struct("grp", "rows", F.col("root").alias("subroot"), "round").alias("carried"))
    return Manifest(groups, _rounds(_numbered(roots), height, "tops"), height)


# ---- paths --------------------------------------------------------------------------------------

def _unfolded(blocks: DataFrame, tails: DataFrame | None, height: int) -> DataFrame:
    """The leaves of blocks: ``grp``, ``pos``, ``leaf``, ``path`` to the root, ``crown`` (the root of
    the group's tree), what the tail says lies ``over`` that, and ``carried``. ``tails`` gives
    ``path``, ``crown`` and ``over`` of the blocks' own roots; a block without is its tree's top."""
    bare = ["grp", "block", "levels", "leaves", "nodes", "carried"]
    if tails is None:
        met = blocks.selectExpr(*bare, f"CAST(array() AS {PATH}) AS path", "root AS crown",
                                "CAST(NULL AS STRING) AS over")
    else:
        met = blocks.join(tails, ["grp", "block"], "left").selectExpr(
            *bare, f"coalesce(path, CAST(array() AS {PATH})) AS path",
            "coalesce(crown, root) AS crown", "over")
    held = blocks.schema["carried"].dataType.elementType.simpleString()

    def leaves_of(row: dict, carried: pa.Array) -> Iterator[pa.RecordBatch]:
        store = np.frombuffer(row["nodes"], np.uint8).reshape(-1, _WIDTH)
        levels, leaves, digits = row["levels"], row["leaves"], 2 * _WIDTH
        near, line = siblings(store, levels, leaves), _level(store, levels, leaves, 0)
        tail = [(step["place"], step["others"]) for step in row["path"]]
        length = levels - 1 + len(tail)
        for low in range(0, leaves, EMITTED):
            some = range(low, min(leaves, low + EMITTED))
            steps = [step for i in some for step in
                     (*(near[k][i // RUN ** k] for k in range(levels - 1)), *tail)]
            path = pa.ListArray.from_arrays(
                pa.array(np.arange(len(some) + 1) * length, pa.int32()),
                pa.StructArray.from_arrays([pa.array([place for place, _ in steps], pa.int32()),
                                            pa.array([others for _, others in steps], pa.string())],
                                           ["place", "others"]))
            yield pa.RecordBatch.from_pydict({
                "grp": pa.array([row["grp"]] * len(some), pa.string()),
                "pos": pa.array(np.arange(low, low + len(some)) + row["block"] * RUN ** height, pa.int64()),
                "leaf": pa.array([line[i * digits:(i + 1) * digits] for i in some], pa.string()),
                "path": path,
                "crown": pa.array([row["crown"]] * len(some), pa.string()),
                "over": pa.array([row["over"]] * len(some), pa.string()),
                "carried": carried.slice(low, len(some))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch[c][n].as_py() for c in batch.schema.names if c != "carried"}
                yield from leaves_of(row, batch["carried"][n].values)

    return met.mapInArrow(run, f"grp string, pos long, leaf string, path {PATH}, crown string, "
                               f"over string, carried {held}")


def _come_down(rounds: list[DataFrame], height: int, given: Callable[[int], DataFrame | None]) -> DataFrame:
    """The leaves of the first round with their paths. ``given`` has the tails of the blocks of a
    round that are their groups' tops."""
    from_above = None
    for n in reversed(range(len(rounds))):
        tails = [t for t in (from_above, given(n)) if t is not None]
        met = None
        if tails:
            met = _stored(tails[0] if len(tails) == 1 else tails[0].unionAll(tails[1]), "tails")
        leaves = _unfolded(rounds[n], met, height)
        from_above = leaves.select("grp", F.col("pos").alias("block"), "path", "crown", "over")
    return leaves


def prove(made: Manifest) -> DataFrame:
    """Every row (``row``, a struct of its columns) with its ``leaf``, ``subroot`` and ``root``, and
    the ``path`` between leaf and root: per level the place in the run and the other nodes, as hex."""
    tops = _stored(_come_down(made.tops, made.height, lambda n: None), "subroots")
    none = F.lit(None).cast("string")

    def given(n: int) -> DataFrame:
        return tops.where(F.col("carried.round") == n).select(
            F.col("carried.grp").alias("grp"), F.lit(0).cast("long").alias("block"), "path",
            none.alias("crown"), F.col("crown").alias("over"))

    return _come_down(made.groups, made.height, given).select(
        F.col("carried").alias("row"), "leaf", F.col("crown").alias("subroot"),
        F.col("over").alias("root"), "path")
