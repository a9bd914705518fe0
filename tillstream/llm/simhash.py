"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has 64 bits: bit i is set if over half of the text's shingle hashes have it set. Equal
fingerprints are merged first (an aggregate reduced before the shuffle), so copies cost nothing
further on. Fingerprints within ``distance`` bits agree on at least ``blocks - distance`` of
``blocks`` blocks of bits: each is filed under every choice of that many blocks, and only
fingerprints filed together are compared. With 6 blocks and 3 bits a drawer is named by some 32
bits, so among N unrelated fingerprints some 20 * N * N / 2**33 pairs are compared by chance: few up
to 10**9 fingerprints; ``blocks=7`` or ``8`` names drawers by 36 or 40 bits for more.

A drawer that more than ``CELL`` fingerprints share is cut by a hash into parts, and every pair of
parts is a task-sized cell, so a drawer of any size is compared whole without any task holding it
whole. One that would have more parts than there are choices of blocks is filed again by the bits it
does not fix, in the same way: a drawer inside it fixes some 48 bits, so it holds 2**16 fingerprints
at most, and the copies of a fingerprint have a bound whatever lies around it. A cell returns a spanning forest of its close pairs, not the pairs: at most as many links as
it has fingerprints. Components of these links are the groups.

Edge rows: null, empty and blank texts have fingerprint zero and link like any other; a text of one
or two words is one shingle; a very long text is read whole, some megabyte at a time; repeated rows or ids give one output row each; a null id belongs to its
group, whose component id is the smallest id that is not null (null if there is none); other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.components import components, spanning_forest
from tillstream.llm.names import fresh
from tillstream.llm.texts import steps, strings
from tillstream.operators.keyed import same_key
from tillstream.session import run_dir

SHINGLE, SEED, DISTANCE, BLOCKS = 3, 42, 3, 6
# Fingerprints in a part of a drawer; a cell holds two parts and compares all with all.
CELL = 1024
# Cells of up to so many are compared together by shifting, larger ones some rows at a time.
_SHIFTS, _ROWS = 32, 256
_VOTE_ROWS = 1 << 15
# Bytes of a text whose words are held at once.
_PART, _BLANK = 1 << 20, re.compile(rb"[ \t-\r]")


def _runs(data: bytes) -> Iterator[list[bytes]]:
    """The words in runs of some ``_PART`` bytes; a run begins with the last words of the one before,
    so that every shingle lies in exactly one."""
    at, carried = 0, []
    while at < len(data):
        # bytes.split() splits at blank and \x09-\x0D, as the pattern does.
        blank = _BLANK.search(data, at + _PART)
        end = blank.start() if blank else len(data)
        words = carried + data[at:end].split()
        yield words
        carried, at = words[1 - SHINGLE:], end


def _shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    joined, at, starts, ends = b" ".join(words), 0, [], []
    for word in words:
        starts.append(at)
        ends.append(at + len(word))
        at += len(word) + 1
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:z], SEED) for a, z in zip(starts, ends[width - 1:])], "<u8")


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of a text's word shingles."""
    votes, seen, words = np.zeros(64, np.int64), 0, []

    def count(hashes: np.ndarray) -> int:
        for part in range(0, len(hashes), _VOTE_ROWS):
            bits = np.unpackbits(hashes[part:part + _VOTE_ROWS].view(np.uint8).reshape(-1, 8), axis=1,
                                 bitorder="little")
            votes[:] += bits.sum(axis=0, dtype=np.int64)
        return len(hashes)

    for words in _runs(text.encode().lower()):  # bytes.lower() touches A-Z only
        if len(words) >= SHINGLE:
            seen += count(_shingle_hashes(words, SHINGLE))
    if not seen and words:
        seen = count(_shingle_hashes(words, len(words)))
    return sum(1 << int(i) for i in np.flatnonzero(2 * votes > seen))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 *more: str) -> DataFrame:
    """``id``, ``print`` (the fingerprint as a signed long) and ``more`` columns of every row."""
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), *more)
    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in slim.schema
                       if c.name != "text") + ", print long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            prints = np.array([fingerprint(t) for t in strings(step["text"])], np.uint64)
            kept = step.drop_columns(["text"])
            yield kept.append_column("print", pa.array(prints.view(np.int64)))

    return slim.mapInArrow(run, schema)


def _drawers(distance: int, blocks: int, places: list[int]) -> list[int]:
    """Bit masks of all choices of ``blocks - distance`` out of ``blocks`` near-equal blocks of the
    bits at ``places``."""
    cuts = [len(places) * b // blocks for b in range(blocks + 1)]
    block = [sum(1 << p for p in places[a:z]) for a, z in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(block, blocks - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _close_pairs(prints: np.ndarray, cell: np.ndarray, distance: int):
    """Index pairs of close fingerprints in the same cell; equal cells stand together."""
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    sizes = np.diff(np.r_[first, len(cell)])
    small = np.repeat(sizes <= _SHIFTS, sizes)
    at = np.flatnonzero(small)
    for shift in range(1, _SHIFTS):
        at = at[at + shift < len(cell)]
        at = at[cell[at] == cell[at + shift]]
        if not len(at):
            break
        near = np.bitwise_count(prints[at] ^ prints[at + shift]) <= distance
        yield at[near], at[near] + shift
    for begin, size in zip(first[sizes > _SHIFTS].tolist(), sizes[sizes > _SHIFTS].tolist()):
        own = prints[begin:begin + size]
        for start in range(0, size, _ROWS):
            near = np.bitwise_count(own[start:start + _ROWS, None] ^ own[None, :]) <= distance
            a, b = np.nonzero(near)
            yield begin + start + a, begin + b


def _compare(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Forests of the close pairs of cells; a cell may go on in the next batch."""
    def forest(prints, cell):
        found = [(prints[a], prints[b]) for a, b in _close_pairs(prints, cell, distance)]
        sides = [np.concatenate([np.empty(0, np.uint64), *side]).view(np.int64)
                 for side in (zip(*found) if found else ((), ()))]
        node, least = spanning_forest(*sides)
        return pa.RecordBatch.from_pydict({"left": node, "right": least})

    prints, cell = np.empty(0, np.uint64), np.empty(0, np.int64)
    for batch in batches:
        prints = np.concatenate([prints, batch["print"].to_numpy().view(np.uint64)])
        cell = np.concatenate([cell, batch["cell"].to_numpy()])
        whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
        if whole:
            yield forest(prints[:whole], cell[:whole])
            prints, cell = prints[whole:], cell[whole:]
    if len(cell):
        yield forest(prints, cell)


def _sizes(filed: DataFrame, name: str) -> DataFrame:
    """How many parts each drawer has that several fingerprints share, as a written table."""
    spark, path = filed.sparkSession, run_dir(filed.sparkSession, name)
    (filed.groupBy("drawer").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
     .select(F.col("drawer").alias("shared"), F.ceil(F.col("n") / CELL).cast("int").alias("parts"))
     .write.parquet(path))
    return spark.read.schema("shared long, parts int").parquet(path)


def _in(filed: DataFrame, sizes: DataFrame) -> DataFrame:
    return filed.join(sizes, same_key(F.col("drawer"), F.col("shared")))


def _cells(shared: DataFrame) -> DataFrame:
    """Fingerprints of shared drawers in cells that together hold every pair of a drawer."""
    part = F.pmod(F.xxhash64("print", F.lit(1)), F.col("parts")).cast("int")
    # A part meets every other part in a cell of the two; what shares a part meets there too.
    other = F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.filter(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda o: o != F.col("part"))))
    return (shared.withColumn("part", part).withColumn("other", other)
            .select(F.xxhash64("drawer", F.least("part", "other"), F.greatest("part", "other"))
                    .alias("cell"), "print"))


def close_links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Links (``left``, ``right``) that connect exactly what pairs of distinct fingerprints within
    ``distance`` bits connect. ``prints`` has one column ``print`` without repeats."""
    masks = _drawers(distance, blocks, list(range(64)))
    names = F.array(*[F.struct(F.lit(i).alias("choice"), F.xxhash64(
        F.lit(i), F.col("print").bitwiseAND(F.lit(_signed(m)))).alias("drawer"))
        for i, m in enumerate(masks)])
    filed = prints.select("print", F.inline(names))
    sizes = _sizes(filed, "drawers")
    few = F.col("parts") <= len(masks)
    cells = _cells(_in(filed, sizes.where(few)))
    crowded = sizes.where(~few)
    if crowded.limit(1).count():
        # What lies in one drawer agrees on its bits; the others are cut into blocks once more.
        inner = [[_signed(m) for m in _drawers(distance, blocks, [p for p in range(64) if not mask >> p & 1])]
                 for mask in masks]
        chosen = F.element_at(F.array(*[F.array(*map(F.lit, row)) for row in inner]), F.col("choice") + 1)
        again = F.transform(chosen, lambda m, j: F.xxhash64("drawer", j, F.col("print").bitwiseAND(m)))
        refiled = _in(filed, crowded).select("print", F.explode(again).alias("drawer"))
        cells = cells.unionByName(_cells(_in(refiled, _sizes(refiled, "inner-drawers"))))
    return (cells.repartition("cell").sortWithinPartitions("cell")
            .mapInArrow(lambda batches: _compare(batches, distance), "left long, right long"))


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
           distance: int = DISTANCE, blocks: int = BLOCKS, *more: str) -> DataFrame:
    """Per row ``id``, ``print``, ``more`` columns, ``root`` (smallest fingerprint of the group) and
    ``component`` (smallest id of the group)."""
    spark = docs.sparkSession
    path = run_dir(spark, "fingerprints")
    fresh = fingerprints(docs, id_column, text_column, *more)
    fresh.write.parquet(path)
    rows = spark.read.schema(fresh.schema).parquet(path)
    distinct = rows.groupBy("print").agg(F.min("id").alias("id"))
    member = components(close_links(distinct.select("print"), distance, blocks), "left", "right")
    rooted = (distinct.join(member, distinct["print"] == member["node"], "left")
              .select("print", "id", F.coalesce("least", "print").alias("root")))
    least = rooted.groupBy("root").agg(F.min("id").alias("component"))
    named = (rooted.join(least.withColumnRenamed("root", "top"), same_key(F.col("root"), F.col("top")))
             .select(F.col("print").alias("known"), "root", "component"))
    return (rows.join(named, same_key(F.col("print"), F.col("known")))
            .drop("known"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group with all its columns: the one with the smallest id (null last), then
    the smallest hash of the row; of rows alike in every column, one."""
    spark = docs.sparkSession
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    mark, kept_id, kept_row = (fresh(docs, n) for n in ("row_hash", "kept_id", "kept_row"))
    rows = groups(docs.withColumn(mark, row_hash), id_column, text_column, DISTANCE, BLOCKS, mark)
    order = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"), F.col(mark).alias("row"))
    first = (rows.groupBy("root", order.alias("o")).agg(F.count(F.lit(1)).alias("n"))
             .groupBy("root").agg(F.min(F.struct("o", "n")).alias("best")))
    path = run_dir(spark, "kept")
    (first.select(F.col("best.o.id").alias(kept_id), F.col("best.o.row").alias(kept_row),
                  F.col("best.n").alias("copies")).write.parquet(path))
    kept = spark.read.parquet(path)
    copies = kept.where("copies > 1").limit(1).count()
    chosen = docs.join(kept.drop("copies"), F.col(f"`{id_column}`").eqNullSafe(F.col(kept_id))
                       & (row_hash == F.col(kept_row)), "left_semi")
    return chosen.dropDuplicates() if copies else chosen


def near_duplicates(docs: DataFrame, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """Id, ``fingerprint`` as 16 hex digits and ``component_id`` of every row."""
    found = groups(docs, id_column, text_column)
    return found.select(F.col("id").alias(id_column),
                        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
