"""Sharding along a Hilbert curve, by DataFrame operations only.

Several metadata dimensions are quantised to ``BITS`` bits each; a row's cell is named by its place
on the Hilbert curve through the grid, so neighbours on the curve are neighbours in every dimension.
Rows are sorted by that place and the sequence is cut into runs of equal length (the ``rows`` law:
counts at most one apart). A shard then spans a small box of the grid, and a filter on any of the
dimensions skips most shards by their minima and maxima.

No row is ranked globally in one task. Rows of a cell are dealt over ``SUBCELLS`` slices by a hash,
so a cell holding a third of all rows is as many small groups. Cells (at most 2**(3 * BITS), whatever
the input) are counted and their first ranks summed up along the curve; likewise the slices of each
cell; and rows are ranked inside their slice. The three ranks add up to the row's place in the whole.
Rows alike in id, size and CRC would all lie in one slice: they are counted before the shuffle and
written out again in shares of ``EQUAL_ROWS``.

Edge rows: a null text has size 8 and the CRC of no bytes; null metadata counts as the text "" or the
number 0; repeated rows, and repeated or null ids, are rows of their own and take neighbouring places;
an empty table has no shards; other columns are ignored by ``assign`` and kept by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.llm.names import fresh

SHARDS, BITS, SUBCELLS = 24, 5, 4096
_DIMENSIONS = 3
ROW_BYTES = 8
ROWS_PER_FILE = 1_000_000
# Equal rows that one task writes out again.
EQUAL_ROWS = 4096


def hashed_level(column: str, bits: int = BITS) -> Column:
    """A value without order, spread over the levels by its hash."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit(""))),
                  F.lit(1 << bits)).cast("int")


def size_level(column: str, bits: int = BITS) -> Column:
    """The binary order of magnitude of a number."""
    number = F.greatest(F.coalesce(F.col(column).cast("long"), F.lit(0)), F.lit(0))
    return F.least(F.floor(F.log2(number + F.lit(1))), F.lit((1 << bits) - 1)).cast("int")


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _turn(value: Column, by: Column, n: int = _DIMENSIONS) -> Column:
    """Rotate an n-bit number left by ``by`` (0 <= by <= n)."""
    wide = F.expr(f"1 << {n}") - 1
    return (F.call_function("shiftleft", value, by)
            .bitwiseOR(F.call_function("shiftright", value, F.lit(n) - by))).bitwiseAND(wide)


def hilbert_index(levels: list[Column], bits: int = BITS) -> Column:
    """Place of a grid cell on the Hilbert curve.

    From the highest bit down, the sub-cube's corner number (one bit of each level) is seen in the
    current orientation, given by the corner where the curve enters and the axis along which it
    runs; its rank in Gray-code order is the next digit, and the orientation of the sub-cube follows
    from that rank."""
    n = len(levels)
    if n != _DIMENSIONS:
        raise ValueError(f"the curve runs through {_DIMENSIONS} dimensions")

    def descend(state: Column, bit: Column) -> Column:
        corner = F.lit(0)
        for axis, level in enumerate(levels):
            digit = F.call_function("shiftright", level, bit).bitwiseAND(F.lit(1))
            corner = corner.bitwiseOR(F.call_function("shiftleft", digit, F.lit(axis)))
        # Turn right by axis + 1, which is left by n - axis - 1.
        seen = _turn(corner.bitwiseXOR(state["entry"]), F.lit(n - 1) - state["axis"])

        def rank(gray: Column) -> Column:
            return gray.bitwiseXOR(F.call_function("shiftright", gray, F.lit(1))) \
                .bitwiseXOR(F.call_function("shiftright", gray, F.lit(2)))

        def step(w: Column) -> Column:
            even = F.greatest(w - 1, F.lit(0)).bitwiseAND(F.lit(~1))
            entry = even.bitwiseXOR(F.call_function("shiftright", even, F.lit(1)))
            # The axis moves by the number of trailing ones of w, or of w - 1 if w is even.
            odd = F.when(w % 2 == 1, w).otherwise(w - 1)
            ones = F.when(w == 0, 0).when(odd % 8 == 7, 3).when(odd % 4 == 3, 2).otherwise(1)
            return F.struct(
                state["entry"].bitwiseXOR(_turn(entry, state["axis"] + 1)).alias("entry"),
                ((state["axis"] + ones + 1) % n).cast("int").alias("axis"),
                F.call_function("shiftleft", state["place"], F.lit(n)).bitwiseOR(w).alias("place"))

        return _let(rank(seen), step)

    start = F.struct(F.lit(0).alias("entry"), F.lit(0).alias("axis"), F.lit(0).alias("place"))
    levels = [level.cast("int") for level in levels]
    packed = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.aggregate(packed, start, descend, lambda s: s["place"])


def assign(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id",
           text_column: str = "text", dimensions: tuple[str, str, str] = ("lang", "source", "n_chars"),
           bits: int = BITS) -> DataFrame:
    """Id, ``size``, ``text_crc32``, ``curve`` (place of the row's cell), ``shard`` and ``slot``
    (gapless from 0 inside the shard, in curve order). The first two dimensions are names, the third
    a number."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        *[level.alias(f"level{i}") for i, level in enumerate(
            [hashed_level(dimensions[0], bits), hashed_level(dimensions[1], bits),
             size_level(dimensions[2], bits)])])
    placed = rows.select("id", "size", "crc", F.xxhash64("id", "crc").alias("dice"),
                         hilbert_index([F.col(f"level{i}") for i in range(3)], bits).alias("cell"))
    placed = placed.withColumn("slice", F.pmod("dice", F.lit(SUBCELLS)).cast("int"))
    slices = placed.groupBy("cell", "slice").agg(F.count(F.lit(1)).alias("n"))
    cells = slices.groupBy("cell").agg(F.sum("n").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    along = before.orderBy("cell")
    ranked = cells.select(F.col("cell").alias("at"), F.coalesce(F.sum("n").over(along), F.lit(0))
                          .alias("cell_first"), F.sum("n").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("cell").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (slices.withColumn("slice_first", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(ranked, F.col("cell") == F.col("at"))
              .select(F.col("cell").alias("c"), F.col("slice").alias("s"), "total",
                      (F.col("cell_first") + F.col("slice_first")).alias("first")))
    # Rows alike in all that is used here take consecutive places, so they are counted, not sorted.
    alike = placed.groupBy("cell", "slice", "dice", "id", "crc", "size").agg(F.count(F.lit(1)).alias("n"))
    own = (Window.partitionBy("cell", "slice").orderBy("dice", "id", "crc", "size")
           .rowsBetween(Window.unboundedPreceding, -1))
    numbered = alike.withColumn("own", F.coalesce(F.sum("n").over(own), F.lit(0).cast("long")))
    joined = numbered.join(firsts, (F.col("cell") == F.col("c")) & (F.col("slice") == F.col("s")))
    # Many equal rows are dealt out in shares, so that no task writes them all.
    share = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("n - 1"), F.lit(EQUAL_ROWS).cast("long")))
    shared = joined.withColumn("share", share).select(
        "id", "size", "crc", "cell", "total", (F.col("first") + F.col("own") + F.col("share")).alias("from"),
        F.least(F.col("n") - F.col("share"), F.lit(EQUAL_ROWS).cast("long")).alias("n")).repartition("from")
    rank = shared.withColumn("rank", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)))
    shard = F.expr(f"rank * {shards} div total")
    return (rank.withColumn("shard", shard.cast("int"))
            # A shard begins at the first rank r with r * shards >= shard * total.
            .withColumn("slot", F.col("rank") - F.expr(
                f"(shard * total + {shards - 1}) div {shards}"))
            .select(F.col("id").alias(id_column), "size", F.col("crc").alias("text_crc32"),
                    F.col("cell").alias("curve"), "shard", "slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_column: str = "doc_id",
                 text_column: str = "text",
                 dimensions: tuple[str, str, str] = ("lang", "source", "n_chars")) -> str:
    """Write all columns of the rows as Parquet, one folder per shard, rows in slot order, so that
    readers prune files by any dimension. Returns the folders' column: ``shard``, underscored if the
    table has a column of that name. Rows alike in id and text share a shard's number only by
    chance: each is written once, under one of the slots these rows were given."""
    shard, slot, row = (fresh(docs, n) for n in ("shard", "slot", "row_number"))
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    alike = Window.partitionBy(f"`{id_column}`", F.crc32(text))
    slots = assign(docs, shards, id_column, text_column, dimensions).select(
        F.col(id_column).alias("own_id"), F.col("text_crc32").alias("own_crc"), F.col("shard").alias(
            "own_shard"), F.col("slot").alias("own_slot"))
    slots = slots.withColumn("own_row", F.row_number().over(
        Window.partitionBy("own_id", "own_crc").orderBy("own_shard", "own_slot")))
    numbered = docs.withColumn(row, F.row_number().over(
        alike.orderBy(*[F.col(f"`{d}`") for d in dimensions])))
    one, two = numbered.alias("l"), slots.alias("r")
    same = (F.col(f"l.`{id_column}`").eqNullSafe(F.col("r.own_id"))
            & (F.crc32(F.coalesce(F.col(f"l.`{text_column}`"), F.lit(""))) == F.col("r.own_crc"))
            & (F.col(f"l.`{row}`") == F.col("r.own_row")))
    (one.join(two, same)
     .select(*[F.col(f"l.`{c}`") for c in docs.columns], F.col("r.own_shard").alias(shard),
             F.col("r.own_slot").alias(slot))
     .repartition(F.col(shard), F.floor(F.col(slot) / ROWS_PER_FILE))
     .sortWithinPartitions(shard, slot).drop(slot).write.partitionBy(shard).parquet(path))
    return shard
