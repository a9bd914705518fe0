"""Hard negatives by a cover tree over norm-augmented candidates.

Candidates get one more component, so that all have the length of the longest; a larger inner product
with an anchor is then a smaller distance, and a node whose members lie within r of its centre c bounds
their inner products with an anchor q by q.c - |q|r and q.c + |q|r. Every level of a tree covers its
node's members by centres further apart than the radius they leave (``FAN`` centres at most; the radii are
measured, so the bounds hold anyway). A search keeps a queue of nodes by their upper bound, opens the
best first, skips nodes outside of what is asked for, and scores the members of leaves exactly, in
integers, until no open node can reach the worst result kept.

Rows are dealt into blocks by the nearest of a few pivots, and by hash where a pivot has more than
``BLOCK_ROWS``: so near rows lie together, and equal ones, be they a third of all, are cut over many
blocks. Each block is a task with a tree of its own. Anchors travel in parties, one per block they come
from, past a list of the blocks' centres and radii, and visit only blocks that can hold what they ask
for: first their own, which gives a floor for the positives' scores, then those that may reach it; with
the positives known, those that reach into the windows of the negatives. A block stays where it is, while
the parties sent to it stream by. What the blocks return is merged by a window per question, of at most a
few rows a block.

Edge rows: rows with a null id, label, vector or component, and vectors of another length than most (the
longest of these if lengths tie), take no part; nor do components beyond ``MOST`` in size, whose
products might leave 64 bits. Rows that share an id are candidates of their own, but none is another
row to an anchor of that id; each anchor row asks for itself, so repeated anchors give repeated
results. Ties go to the smaller id, then the smaller positive. A negative positive score has an empty
window. An empty table, or no anchor, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.session import run_dir

BLOCK_ROWS, PIVOTS, SAMPLE = 16_384, 1_024, 4_096
# Anchors that score a leaf together.
PARTY = 256
# Blocks whose centres and radii are looked through together.
PAGE = 4_096
# Children of a node at most, and rows that are scored together.
FAN, LEAF = 64, 512
MOST = 1 << 20
_SLACK = 1e-9
_BELOW, _ABOVE = -(1 << 62), 1 << 62


# ---- the tree of a block --------------------------------------------------------------------------

@dataclass
class CoverTree:
    """Rows in tree order; node k covers rows ``first[k]:stop[k]`` within ``radius[k]`` of the row
    ``centre[k]``, and its children are nodes ``down[k]:last[k]`` (none: a leaf)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    stop: np.ndarray
    down: np.ndarray
    last: np.ndarray

    FIELDS = ("ids", "labels", "vectors", "centre", "radius", "first", "stop", "down", "last")
    KINDS = {"vectors": "<i4", "radius": "<f8"}

    def packed(self) -> list[bytes]:
        return [getattr(self, f).astype(self.KINDS.get(f, "<i8")).tobytes() for f in self.FIELDS]

    @classmethod
    def unpacked(cls, parts: list[bytes]) -> CoverTree:
        numbers = [np.frombuffer(part, cls.KINDS.get(f, "<i8")) for f, part in zip(cls.FIELDS, parts)]
        numbers[2] = numbers[2].reshape(len(numbers[0]), -1)
        return cls(*numbers)


def augmented(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component, all as long as the longest (given as a square)."""
    real = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(0, longest - np.einsum("ij,ij->i", real, real)))
    return np.c_[real, rest]


def _net(points: np.ndarray, fan: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres (the first row, then ever the furthest row) that cover the points within half the
    radius of the first alone, or ``fan`` of them; each point's centre and its squared distance."""
    chosen, mine = [0], np.zeros(len(points), np.int64)
    apart = points - points[0]
    gap = np.einsum("ij,ij->i", apart, apart)
    enough = gap.max() / 4
    while len(chosen) < fan:
        far = int(gap.argmax())
        if gap[far] <= enough or gap[far] == 0:
            break
        apart = points - points[far]
        near = np.einsum("ij,ij->i", apart, apart)
        closer = near < gap
        mine[closer], gap[closer] = len(chosen), near[closer]
        chosen.append(far)
    return chosen, mine, gap


def build(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, longest: float,
          fan: int = FAN, leaf: int = LEAF) -> CoverTree:
    """The cover tree of some rows (at least one)."""
    points, order = augmented(vectors, longest), np.arange(len(ids))
    centre, first, stop, down, last = [0], [0], [len(ids)], [0], [0]
    spread = points - points[0]
    radius = [float(np.sqrt(np.einsum("ij,ij->i", spread, spread).max()))]
    todo = [0]
    while todo:
        node = todo.pop()
        low, high = first[node], stop[node]
        if high - low <= leaf or radius[node] == 0:
            continue
        members = order[low:high]
        at = np.flatnonzero(members == centre[node])[0]  # a centre goes on to be its own child
        members[0], members[at] = members[at], members[0]
        chosen, mine, gap = _net(points[members], min(fan, 2 * -(-len(members) // leaf)))
        if len(chosen) < 2:
            continue
        by = np.argsort(mine, kind="stable")
        counts = np.bincount(mine, minlength=len(chosen))
        reach = np.sqrt(np.maximum.reduceat(gap[by], np.cumsum(counts) - counts))
        heads = members[chosen].tolist()
        order[low:high] = members[by]
        down[node], last[node] = len(centre), len(centre) + len(chosen)
        for head, count, far in zip(heads, counts.tolist(), reach.tolist()):
            todo.append(len(centre))
            centre.append(head)
            radius.append(far)
            first.append(low)
            stop.append(low + count)
            down.append(0)
            last.append(0)
            low += count
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return CoverTree(ids[order], labels[order], vectors[order], place[centre],
                     np.array(radius), *(np.array(a, np.int64) for a in (first, stop, down, last)))


class Search:
    """Best-first descents of a tree."""

    def __init__(self, tree: CoverTree, longest: float):
        self._tree, self._reach = tree, np.sqrt(longest)
        self._rows = tree.vectors.astype(np.float64)
        self._heads = self._rows[tree.centre]
        self._largest = float(np.abs(self._rows).max())

    def attend(self, party: np.ndarray) -> None:
        """Take up a party of anchors: a leaf that one of them opens is scored for all of them."""
        self._party, self._real = party, party.astype(np.float64)
        # Products of doubles are exact as long as no sum can reach 2**53.
        most = self._largest * float(np.abs(self._real).max()) * self._real.shape[1]
        self._exact, self._seen = most < 1 << 53, {}

    def _scores(self, node: int) -> tuple[np.ndarray, np.ndarray]:
        """Every anchor's scores with the members of a leaf, and the best of each anchor."""
        if node not in self._seen:
            rows = slice(self._tree.first[node], self._tree.stop[node])
            if self._exact:
                scores = (self._real @ self._rows[rows].T).astype(np.int64)
            else:
                scores = self._party @ self._tree.vectors[rows].astype(np.int64).T
            self._seen[node] = scores, scores.max(axis=1)
        return self._seen[node]

    def best(self, anchor: int, own: int, label: int, same: bool, low: np.ndarray,
             high: np.ndarray, count: int) -> list[list[tuple[int, int]]]:
        """For the party's anchor of that number, per window ``low[w]`` to ``high[w]``: the ``count``
        best (score, id) among rows of the same or of another label that are not the anchor's own."""
        tree, real = self._tree, self._real[anchor]
        norm = float(np.sqrt(real @ real))
        slack = _SLACK * (norm * self._reach + 1)
        floors, kept = low.copy(), [[] for _ in low]
        start = float(self._heads[0] @ real) + norm * tree.radius[0] + slack
        queue = [(-start, 0)]
        while queue:
            upper, node = heappop(queue)
            if -upper < floors.min():
                break
            if tree.last[node]:
                down, last = tree.down[node], tree.last[node]
                scores, spread = self._heads[down:last] @ real, norm * tree.radius[down:last] + slack
                above, below = scores + spread, scores - spread
                open_ = ((above[:, None] >= floors) & (below[:, None] <= high)).any(axis=1)
                for child in np.flatnonzero(open_).tolist():
                    heappush(queue, (-above[child], int(down) + child))
                continue
            start, (scores, most) = tree.first[node], self._scores(node)
            if most[anchor] < floors.min():
                continue
            scores = scores[anchor]
            maybe = np.flatnonzero((scores >= floors.min()) & (scores <= high.max()))
            maybe = maybe[((tree.labels[start + maybe] == label) == same) & (tree.ids[start + maybe] != own)]
            if not len(maybe):
                continue
            scores, ids = scores[maybe], tree.ids[start + maybe]
            for w in range(len(low)):
                inside = np.flatnonzero((scores >= floors[w]) & (scores <= high[w]))
                if not len(inside):
                    continue
                if len(inside) > count:
                    inside = inside[np.lexsort((ids[inside], -scores[inside]))[:count]]
                merged = kept[w] + list(zip((-scores[inside]).tolist(), ids[inside].tolist()))
                kept[w] = sorted(merged)[:count]
                if len(kept[w]) == count:
                    floors[w] = max(floors[w], -kept[w][-1][0])
        return [[(-score, found) for score, found in some] for some in kept]


# ---- tables ---------------------------------------------------------------------------------------

def _stored(rows: DataFrame, name: str) -> DataFrame:
    path = run_dir(rows.sparkSession, f"negatives-{name}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1) if len(values) else flat.reshape(0, 1)


def _pivots(rows: DataFrame, wanted: int) -> np.ndarray:
    """Rows far from each other, out of a sample of at most ``SAMPLE`` rows: they decide where rows
    lie, never what is found."""
    dice = F.xxhash64("id", "vector", F.monotonically_increasing_id())
    sample = rows.select("vector", dice.alias("dice")).orderBy("dice").limit(SAMPLE).collect()
    points = np.array([r["vector"] for r in sample], np.float64)
    chosen, gap = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < wanted and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _dealt(rows: DataFrame, pivots: np.ndarray, block_rows: int) -> DataFrame:
    """Rows (stored) with the ``block`` they belong to."""
    lengths = (pivots ** 2).sum(axis=1)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch["vector"]).astype(np.float64)
            pivot = (lengths - 2 * points @ pivots.T).argmin(axis=1) if len(points) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot, pa.int32())],
                                             [*batch.schema.names, "pivot"])

    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = _stored(rows.mapInArrow(near, f"{out}, pivot int"), "rows")
    # At most PIVOTS numbers: how many blocks each pivot's rows make, and the first of them.
    sizes = {r["pivot"]: r["count"] for r in placed.groupBy("pivot").count().collect()}
    parts = [-(-sizes.get(p, 0) // block_rows) for p in range(len(pivots))]
    starts = np.cumsum([0, *parts]).tolist()
    part, start = (F.array(*map(F.lit, some)) for some in ([max(1, n) for n in parts], starts[:-1]))
    salt = F.xxhash64("id", "vector", F.monotonically_increasing_id())
    at = F.col("pivot") + 1
    block = F.element_at(start, at) + F.pmod(salt, F.element_at(part, at)).cast("int")
    return placed.withColumn("block", block).drop("pivot")


def _trees(rows: DataFrame, longest: float) -> DataFrame:
    """One row per block: centre and radius of all its members, and its packed tree."""
    def plant(table: pa.Table) -> pa.Table:
        tree = build(table["id"].to_numpy(), table["label"].to_numpy(), _matrix(table["vector"]), longest)
        return pa.table({"block": table["block"].slice(0, 1),
                         "middle": pa.array([tree.vectors[tree.centre[0]].tolist()], pa.list_(pa.int64())),
                         "radius": [float(tree.radius[0])],
                         "parts": pa.array([tree.packed()], pa.list_(pa.binary()))})

    return _stored(rows.select("block", "id", "label", "vector").groupBy("block").applyInArrow(
        plant, "block int, middle array<bigint>, radius double, parts array<binary>"), "trees")


_FIELDS = ("key", "own", "label", "low", "high")
Handler = Callable[[list], Callable[[int, pa.Array], pa.RecordBatch]]


def _streamed(kept: DataFrame, parties: DataFrame, handler: Handler, out: str) -> DataFrame:
    """Hand every party (``target``, ``home``, ``asked``) to what is kept under its target (``parts``):
    a task loads that once and then takes the parties sent to it one after the other."""
    asked = parties.schema["asked"].dataType.simpleString()
    both = kept.selectExpr("target", "0 AS turn", "-1 AS home", "parts", f"CAST(NULL AS {asked}) AS asked").unionAll(
        parties.selectExpr("target", "1 AS turn", "home", "CAST(NULL AS array<binary>) AS parts", "asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answer = None
        for batch in batches:
            for n in range(batch.num_rows):
                if batch["turn"][n].as_py() == 0:
                    answer = handler(batch["parts"][n].as_py())
                else:
                    yield answer(batch["home"][n].as_py(), batch["asked"][n].values)

    return (both.repartition("target").sortWithinPartitions("target", "turn")
            .mapInArrow(run, out))


def _asked(party: pa.Array) -> dict[str, np.ndarray]:
    vector = _matrix(party.field("vector"))
    found = {f: party.field(f).to_numpy() for f in ("key", "own", "label")}
    return found | {"vector": vector, "low": party.field("low").to_pylist(),
                    "high": party.field("high").to_pylist()}


def _targets(parties: DataFrame, trees: DataFrame, blocks: int, longest: float,
             at_home: bool) -> DataFrame:
    """The parties with each block that can hold what one of their members asks for."""
    summary = F.struct("block", "middle", "radius")
    page = F.floor(F.col("block") / PAGE).cast("int").alias("target")
    pages = (trees.groupBy(page).agg(F.sort_array(F.collect_list(summary)).alias("s"))
             .select("target", F.array(F.to_json("s").cast("binary")).alias("parts")))
    reach = float(np.sqrt(longest))

    def look(parts: list) -> Callable[[int, pa.Array], pa.RecordBatch]:
        known = json.loads(parts[0])
        numbers = np.array([k["block"] for k in known])
        middles = np.array([k["middle"] for k in known], np.float64).T
        radii = np.array([k["radius"] for k in known])

        def answer(home: int, party: pa.Array) -> pa.RecordBatch:
            asked, met = _asked(party), np.zeros(len(numbers), bool)
            for vector, low, high in zip(asked["vector"].astype(np.float64), asked["low"], asked["high"]):
                norm = float(np.sqrt(vector @ vector))
                score, spread = vector @ middles, norm * radii + _SLACK * (norm * reach + 1)
                for l, h in zip(low, high):
                    met |= (score + spread >= l) & (score - spread <= h)
            if not at_home:
                met &= numbers != home
            return pa.RecordBatch.from_pydict({
                "home": pa.array(np.full(met.sum(), home), pa.int32()),
                "target": pa.array(numbers[met], pa.int32())})

        return answer

    sent = parties.withColumn("target", F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // PAGE))))
    return parties.join(_streamed(pages, sent, look, "home int, target int"), "home")


def _found(parties: DataFrame, trees: DataFrame, longest: float, same: bool, count: int) -> DataFrame:
    """What the targets of parties hold: ``key``, window number ``w``, ``score`` and ``id``."""
    def load(parts: list) -> Callable[[int, pa.Array], pa.RecordBatch]:
        search = Search(CoverTree.unpacked(parts), longest)

        def answer(home: int, party: pa.Array) -> pa.RecordBatch:
            rows, asked = [], _asked(party)
            for n, (key, own, label, low, high) in enumerate(zip(*(asked[f] for f in _FIELDS))):
                if n % PARTY == 0:
                    search.attend(asked["vector"][n:n + PARTY])
                best = search.best(n % PARTY, own, label, same, np.array(low, np.int64),
                                   np.array(high, np.int64), count)
                rows += [(key, w, *one) for w, some in enumerate(best) for one in some]
            columns = np.array(rows, np.int64).reshape(-1, 4).T
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0]), pa.array(columns[1], pa.int32()), pa.array(columns[2]),
                 pa.array(columns[3])], ["key", "w", "score", "id"])

        return answer

    return _streamed(trees.select(F.col("block").alias("target"), "parts"), parties, load,
                     "key long, w int, score long, id long")


def _top(found: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("key", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(table: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, least: int = 80,
         most: int = 100, id_column: str = "vec_id", label_column: str = "label",
         vector_column: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For each row that ``anchors`` marks and each of its ``positives`` best rows of the same label,
    the ``negatives`` best rows of another label whose inner product is ``least`` to ``most`` per cent
    of the positive's: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.
    Vectors hold integers."""
    out = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
           "negative_score long")
    spark = table.sparkSession
    sound = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) <= MOST))
    rows = (table.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"),
                         F.col(vector_column).cast("array<bigint>").alias("vector"),
                         anchors.alias("asks"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & sound))
    common = (rows.groupBy(F.size("vector").alias("width")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate(
            "vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("longest"))
        .orderBy(F.desc("n"), F.desc("width")).first())
    if common is None:
        return spark.createDataFrame([], out)
    longest = float(common["longest"])
    rows = rows.where(F.size("vector") == common["width"])
    pivots = _pivots(rows, min(PIVOTS, -(-common["n"] // block_rows)))
    dealt = _stored(_dealt(rows, pivots, block_rows), "dealt")
    trees = _trees(dealt, longest)
    blocks = dealt.agg(F.max("block")).first()[0] + 1
    keyed = _stored(dealt.where("asks").select(F.monotonically_increasing_id().alias("key"), "id", "label",
                                               "vector", F.col("block").alias("home")), "anchors")

    def parties(asking: DataFrame) -> DataFrame:
        """Anchors with ``low`` and ``high``, those of a block as one row."""
        one = F.struct("key", F.col("id").alias("own"), "label", "vector", "low", "high")
        return _stored(asking.groupBy("home").agg(F.collect_list(one).alias("asked")), "parties")

    def windows(low: Column, high: Column) -> list[Column]:
        return [F.array(low.cast("long")).alias("low"), F.array(high.cast("long")).alias("high")]

    anywhere = keyed.select("*", *windows(F.lit(_BELOW), F.lit(_ABOVE)))
    near = _top(_found(parties(anywhere).withColumn("target", F.col("home")), trees, longest, True,
                       positives), positives)
    near = _stored(near, "near")
    floor = (near.where(F.col("rank") == positives)
             .select("key", F.col("score").alias("floor")))
    rest = keyed.join(floor, "key", "left").select(
        *keyed.columns, *windows(F.coalesce("floor", F.lit(_BELOW)), F.lit(_ABOVE)))
    far = _found(_targets(parties(rest), trees, blocks, longest, False), trees, longest, True, positives)
    best = _stored(_top(near.drop("rank").unionAll(far), positives)
                   .select("key", F.col("rank").alias("w"), F.col("score").alias("positive_score"),
                           F.col("id").alias("positive_id")), "positives")

    scaled = [F.col("positive_score") * F.lit(share) for share in (least, most)]
    low = F.call_function("div", scaled[0] + F.pmod(-scaled[0], F.lit(100)), F.lit(100))
    high = F.call_function("div", scaled[1] - F.pmod(scaled[1], F.lit(100)), F.lit(100))
    asked = (best.withColumns({"low": low, "high": high}).groupBy("key")
             .agg(F.sort_array(F.collect_list(F.struct("w", "low", "high"))).alias("s"))
             .select("key", F.col("s.low").alias("low"), F.col("s.high").alias("high")))
    hard = _found(_targets(parties(keyed.join(asked, "key")), trees, blocks, longest, True),
                  trees, longest, False, negatives)
    hard = _top(hard.withColumn("w", F.col("w") + 1), negatives)
    return (hard.join(best, ["key", "w"]).join(keyed.select("key", F.col("id").alias("anchor_id")), "key")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
