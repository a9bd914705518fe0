"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes of ``BITS`` bits: they are extended by one component so that inner product
becomes an angle, projected on principal components, and rotated so that signs lose least
(iterative quantisation, learnt on a sample of some ``SAMPLE`` rows). A block of the index files its codes under
each of ``len(PARTS)`` substrings. To find every code within radius r of a query's code, substring j
is probed within radius r_j, where the r_j + 1 add up to r + 1: a code that is further in every
substring is further than r in all. What the probes bring up is verified against r and reranked by
the inner product of the original vectors in double precision.

The radius is learnt as well: it is the distance within which ``target`` of the true neighbours of
sampled vectors lie, measured inside the sample. A whole table is denser than its sample, so its
neighbours lie closer and recall is higher than ``target``. A query that finds fewer than it asked
for in a block probes again, ``WIDEN`` bits further, until it has enough or has seen the block.

Queries and rows are dealt by hash into blocks of bounded size; every pair of a query block and an
index block is a task of its own, which returns the best of its block, and these are merged. All
rows are indexed and nothing is broadcast but the rotation.

Edge rows: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, neither do rows without id; an empty table gives no rows; fewer candidates
than asked for are all returned; repeated rows are candidates of their own, but of a repeated query
id one vector, the smallest, asks; equal scores go to the smaller id; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

BITS, PARTS = 64, (16, 16, 16, 16)
SAMPLE, SAMPLE_QUERIES, TARGET = 8_192, 256, 0.97
BLOCK_ROWS, QUERY_ROWS = 16_384, 16_384
WIDEN = 4
_NEARLY = 1e-9
_FACES = 1 << 40


@dataclass
class Coder:
    """Codes of vectors, and the radius to search."""

    longest: float
    mean: np.ndarray
    project: np.ndarray
    radius: int

    def _extended(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        norms = np.einsum("ij,ij->i", vectors, vectors)
        if query:
            return np.c_[vectors / np.sqrt(norms)[:, None], np.zeros(len(vectors))]
        rest = np.sqrt(np.maximum(0, self.longest ** 2 - norms))
        return np.c_[vectors, rest] / self.longest

    def codes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        bits = (self._extended(vectors, query) - self.mean) @ self.project > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def _rotation(data: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Orthogonal matrix under which the signs of the rows are closest to the rows."""
    size = data.shape[1]
    turn = np.linalg.qr(np.random.default_rng(6).normal(size=(size, size)))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.sign(data @ turn).T @ data)
        turn = (left @ right).T
    return turn


def fit(sample: np.ndarray, longest: float, neighbours: int = 20, target: float = TARGET) -> Coder:
    """Learn codes and radius from sampled vectors; ``longest``: the largest norm in the table."""
    width = sample.shape[1] + 1
    coder = Coder(longest, np.zeros(width), np.eye(width)[:, :1], BITS)
    extended = coder._extended(sample, False)
    coder.mean = extended.mean(axis=0)
    centred = extended - coder.mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :BITS]
    parts, left = [], BITS
    while left > 0:  # fewer components than bits: the next bits turn the same components again
        turn = _rotation(centred @ axes, 40 + len(parts))
        parts.append((axes @ turn)[:, :left])
        left -= parts[-1].shape[1]
        axes = axes @ np.linalg.qr(np.random.default_rng(left).normal(size=turn.shape))[0]
    coder.project = np.concatenate(parts, axis=1)
    asked = sample[:: max(1, len(sample) // SAMPLE_QUERIES)][:SAMPLE_QUERIES]
    step = max(1, len(sample) // SAMPLE_QUERIES)
    scores = asked @ sample.T
    scores[np.arange(len(asked)), np.arange(len(asked)) * step] = -np.inf
    count = min(neighbours, len(sample) - 1)
    if count > 0:
        best = np.argpartition(-scores, count - 1, axis=1)[:, :count]
        apart = np.bitwise_count(coder.codes(asked, True)[:, None] ^ coder.codes(sample)[best])
        coder.radius = int(np.ceil(np.quantile(apart, target)))
    return coder


class Index:
    """Codes of a block, filed under each substring."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables, low = [], 0
        for bits in PARTS:
            keys = (codes >> np.uint64(low)) & np.uint64((1 << bits) - 1)
            order = np.argsort(keys, kind="stable")
            filed, first = np.unique(keys[order], return_index=True)
            self.tables.append((np.uint64(low), np.uint64((1 << bits) - 1), filed, first,
                                np.diff(np.r_[first, len(codes)]), order))
            low += bits

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """All rows whose code is at most ``radius`` bits away."""
        seen = np.zeros(len(self.codes), bool)
        for j, (low, mask, filed, first, sizes, order) in enumerate(self.tables):
            own = (radius + 1 + len(PARTS) - 1 - j) // len(PARTS) - 1
            if own < 0:
                continue
            near = np.flatnonzero(np.bitwise_count(filed ^ ((code >> low) & mask)) <= own)
            runs = sizes[near]
            ends = np.cumsum(runs)
            if len(ends):
                at = np.arange(ends[-1]) + np.repeat(first[near] - (ends - runs), runs)
                seen[order[at]] = True
        rows = np.flatnonzero(seen)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= radius]


def _best(query: np.ndarray, own: int, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray,
          neighbours: int) -> tuple[np.ndarray, np.ndarray]:
    rows = rows[ids[rows] != own]
    rough = vectors[rows] @ query
    if len(rows) > neighbours:
        least = np.partition(rough, len(rough) - neighbours)[len(rough) - neighbours]
        rows = rows[rough >= least - _NEARLY * max(1.0, abs(least))]
    # Summed row by row, so equal vectors have equal scores wherever they stand.
    exact = (vectors[rows] * query).sum(axis=1)
    order = np.lexsort((ids[rows], -exact))[:neighbours]
    return ids[rows][order], exact[order]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def nearest(table: DataFrame, every: int = 20, neighbours: int = 20, id_column: str = "vec_id",
            vector_column: str = "embedding", block_rows: int = BLOCK_ROWS,
            query_rows: int = QUERY_ROWS, target: float = TARGET,
            radius: int | None = None) -> DataFrame:
    """``query_id``, ``rank`` from 1, the id and ``score`` of the nearest found, for every row
    whose id is divisible by ``every``. The radius is learnt for ``target``, or given: ``BITS`` finds
    the exact neighbours."""
    out = f"query_id long, {id_column} long, score double"
    spark = table.sparkSession
    number = F.col("vector")
    sound = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (table.select(F.col(id_column).cast("long").alias("id"),
                         F.col(vector_column).cast("array<double>").alias("vector"))
            .where(F.col("id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
            .where(sound & F.exists(number, lambda x: x != 0)))
    common = (rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.desc("width")).first())
    if common is None:
        empty = spark.createDataFrame([], out)
        return empty.select("query_id", F.lit(0).alias("rank"), id_column, "score")
    rows = rows.where(F.size("vector") == common["width"])
    norm = F.sqrt(F.aggregate(number, F.lit(0.0), lambda s, x: s + x * x))
    longest = rows.agg(F.max(norm)).first()[0]
    # Row by row, so that neither an id nor a vector that comes without end fills sample or block.
    each = F.xxhash64("id", "vector", F.monotonically_increasing_id())
    dice = F.pmod(F.xxhash64(each, F.lit("sample")), F.lit(_FACES)) / _FACES
    sample = (rows.withColumn("dice", dice).where(F.col("dice") < SAMPLE / common["n"]).drop("dice")
              .toPandas().sort_values("id"))
    coder = fit(np.array(sample["vector"].tolist(), np.float64).reshape(len(sample), -1),
                float(longest), neighbours, target)
    if radius is not None:
        coder.radius = radius

    blocks = -(-int(common["n"]) // block_rows)
    asked = (rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vector").alias("vector")))
    parties = -(-int(common["n"]) // (every * query_rows)) or 1

    def dealt(frame: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        return (frame.withColumn(own, F.pmod(F.xxhash64(each, F.lit(own)), F.lit(parts)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))))

    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        if queries.num_rows and block.num_rows:
            vectors, ids = _matrix(block["vector"]), block["id"].to_numpy()
            index, wanted = Index(coder.codes(vectors)), _matrix(queries["vector"])
            for own, query, code in zip(queries["id"].to_numpy(), wanted, coder.codes(wanted, True)):
                radius = coder.radius
                rows = index.within(code, radius)
                while radius < BITS and (ids[rows] != own).sum() < neighbours:
                    radius = min(BITS, radius + WIDEN)
                    rows = index.within(code, radius)
                found.append((own, *_best(query, own, vectors, ids, rows, neighbours)))
        lengths = [len(ids) for _, ids, _ in found]
        return pa.table({
            "query_id": np.repeat(np.array([own for own, _, _ in found], np.int64), lengths),
            id_column: np.concatenate([np.empty(0, np.int64), *[ids for _, ids, _ in found]]),
            "score": np.concatenate([np.empty(0), *[s for _, _, s in found]])})

    pairs = dealt(asked, "party", parties, "block", blocks).groupBy("party", "block").cogroup(
        dealt(rows, "block", blocks, "party", parties).groupBy("party", "block"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), id_column)
    return (pairs.applyInArrow(search, out).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= neighbours).select("query_id", "rank", id_column, "score"))
