"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` reads the training texts once and stores, for each block of documents, the postings
of all terms that the benchmark uses: per term the sorted positions at which it occurs. A position
counts words through the block, with a gap between documents wider than any window, so offset
arithmetic never runs from one document into the next. Blocks hold a bounded amount of text and are
written as a table in the shared folder, one row per block. Document frequencies of the terms come
from the stored lists, over all blocks.

A phrase is searched block by block: its terms are taken from the globally rarest to the most
frequent, each list is shifted by the term's offset in the phrase, and the surviving start positions
are intersected. Nothing is shuffled, no list leaves its block, and common terms' lists are only
probed at the few positions that rarer terms left over. Proximity search keeps the same order but
intersects ranges instead of single positions.

The phrases travel with the tasks. They come from the benchmark, whose size is checked:
``slice_words`` words are searched at a time, and a larger benchmark is searched in several passes
over one index of all its words (an index per pass beyond ``MOST_TERMS`` distinct ones). A block looks
only at windows whose rarest term it holds. The matches of the passes are merged per row: rows are told
apart by id and digest of the text, and rows equal in both are counted and written out again as often.

Edge rows: a null text has no words; a very long text is a block of its own; documents without words have no hits and are clean; null or
repeated ids give one output row per input row, whatever the number of passes; benchmark items that are null or without words match nothing; an empty benchmark leaves
every document clean. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillstream.llm.names import fresh
from tillstream.llm.texts import ASCII_LOWER, steps, utf8, word_hashes, word_spans
from tillstream.session import run_dir

WINDOW = 13
# Words of benchmark searched in one pass; a window of each, about 1 KB, travels with a task.
SLICE_WORDS = 50_000
# Distinct words of a larger benchmark, 8 bytes each, that one index over the corpus serves.
MOST_TERMS = 1 << 21
# Equal rows that one task writes out again after several passes.
EQUAL_ROWS = 4096
_BLOCK = "docs array<struct<id:{0},words:int>>, terms array<int>, counts array<int>, places array<int>"


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text the number of its first word."""
    data, bounds = utf8(texts)
    lowered = ASCII_LOWER[data]
    starts, ends, firsts = word_spans(lowered, bounds)
    return word_hashes(lowered, starts, ends), firsts


def _known(hashes: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are in the vocabulary, and their numbers there."""
    if not len(vocabulary):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    term = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = np.flatnonzero(vocabulary[term] == hashes)
    return known, term[known]


class Phrases:
    """Benchmark windows over numbered terms. ``items``: (item id, its words' hashes)."""

    def __init__(self, items: list[tuple[object, np.ndarray]], width: int = WINDOW):
        self.width = width
        self.vocabulary = np.unique(np.concatenate([np.empty(0, np.uint64), *[w for _, w in items]]))
        self.items = [(str(name), np.searchsorted(self.vocabulary, words))
                      for name, words in items if len(words)]

    def over(self, vocabulary: np.ndarray) -> Phrases:
        """The same items numbered in a vocabulary that holds this one."""
        number = np.searchsorted(vocabulary, self.vocabulary)
        other = Phrases([], self.width)
        other.vocabulary, other.items = vocabulary, [(name, number[terms]) for name, terms in self.items]
        return other

    def windows(self) -> list[tuple[tuple[int, ...], list[str]]]:
        """Distinct windows, each with the items that hold it."""
        held: dict[tuple[int, ...], dict[str, None]] = {}
        for name, terms in self.items:
            for start in range(max(1, len(terms) - self.width + 1)):
                held.setdefault(tuple(terms[start:start + self.width].tolist()), {})[name] = None
        return [(window, list(names)) for window, names in held.items()]


def phrases_of(items: DataFrame, id_column: str, text_column: str, width: int,
               slice_words: int) -> Iterator[Phrases]:
    """The benchmark in slices of bounded size, streamed to the driver one partition at a time."""
    held, size = [], 0
    rows = items.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    for row in rows.toLocalIterator():
        hashes, _ = _words(pa.array([row["text"]], pa.string()))
        if held and size + len(hashes) > slice_words:
            yield Phrases(held, width)
            held, size = [], 0
        held.append((row["id"], hashes))
        size += len(hashes)
    yield Phrases(held, width)


def whole_vocabulary(items: DataFrame, text_column: str) -> np.ndarray | None:
    """Hashes of all words of the benchmark, in order; None if there are more than ``MOST_TERMS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            hashes = np.unique(_words(step["text"])[0])
            yield pa.RecordBatch.from_pydict({"word": pa.array(hashes.view(np.int64))})

    words = items.select(F.col(text_column).alias("text")).mapInArrow(run, "word long").distinct()
    found = words.limit(MOST_TERMS + 1).toPandas()["word"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64)) if len(found) <= MOST_TERMS else None


def build_index(docs: DataFrame, vocabulary: np.ndarray, path: str, gap: int = WINDOW,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write and return the postings of ``vocabulary`` (sorted word hashes), a row per block:
    ``docs`` (id and number of words), ``terms`` (numbers in the vocabulary), ``counts`` (postings
    of each) and ``places`` (all postings, by term and position)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            hashes, firsts = _words(step["text"])
            words = np.diff(firsts)
            shift = np.repeat(np.arange(len(words)) * gap, words)
            known, term = _known(hashes, vocabulary)
            # Narrow numbers are sorted by radix; the order keeps the positions of a term ascending.
            narrow = term.astype(np.uint16 if len(vocabulary) <= 1 << 16 else np.int32)
            order = np.argsort(narrow, kind="stable")
            places = (known + shift[known])[order].astype(np.int32)
            counts = np.bincount(term)
            present = np.flatnonzero(counts)
            listed = pa.StructArray.from_arrays(
                [step["id"], pa.array(words, pa.int32())], ["id", "words"])

            def one(values):
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            yield pa.RecordBatch.from_pydict({
                "docs": one(listed), "terms": one(pa.array(present, pa.int32())),
                "counts": one(pa.array(counts[present], pa.int32())), "places": one(pa.array(places)),
            })

    id_type = docs.schema[id_column].dataType.simpleString()
    blocks = (docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
              .mapInArrow(run, _BLOCK.format(id_type)))
    blocks.write.parquet(path)
    return docs.sparkSession.read.schema(blocks.schema).parquet(path)


def document_frequencies(index: DataFrame, terms: int) -> np.ndarray:
    """Occurrences of every term of the vocabulary, counted over the whole index."""
    rows = (index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
            .groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("n")).toPandas())
    found = np.zeros(terms, np.int64)
    found[rows["term"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return found


class _Block:
    """One row of the index: its posting lists and documents."""

    def __init__(self, docs: list[dict], terms: np.ndarray, counts: np.ndarray, places: np.ndarray,
                 gap: int):
        self.ids = [d["id"] for d in docs]
        self.words = np.array([d["words"] for d in docs], np.int64)
        self.firsts = np.concatenate([[0], np.cumsum(self.words + gap)])
        ends = np.cumsum(counts)
        self.lists = {t: places[e - n:e].astype(np.int64) for t, n, e in zip(terms, counts, ends)}

    def phrase(self, ordered: list[tuple[int, int]]) -> np.ndarray:
        """Start positions of a phrase given as (term, offset), rarest term first."""
        lists = [self.lists.get(term) for term, _ in ordered]
        if any(found is None for found in lists):
            return np.empty(0, np.int64)
        starts = lists[0] - ordered[0][1]
        for found, (_, offset) in zip(lists[1:], ordered[1:]):
            at = np.searchsorted(found, starts + offset)
            at[at == len(found)] = 0
            starts = starts[found[at] == starts + offset]
            if not len(starts):
                break
        return starts

    def near(self, terms: list[int], within: int) -> np.ndarray:
        """Documents holding all terms, in any order, inside some ``within`` consecutive words;
        rarest term first."""
        lists = [self.lists.get(term) for term in terms]
        if any(found is None for found in lists):
            return np.empty(0, np.int64)
        # Some smallest stretch begins at a posting p of one of the terms; it fits if the next
        # posting of every term, from p on, is less than ``within`` words away.
        around = lists[0]
        begins = np.unique(np.concatenate(
            [f[_close(f, around, within)] for f in lists]))
        furthest = begins.copy()
        for found in lists:
            at = np.searchsorted(found, begins)
            beyond = at == len(found)
            at[beyond] = 0
            furthest = np.maximum(furthest, np.where(beyond, np.iinfo(np.int64).max, found[at]))
        hit = begins[furthest - begins < within]
        return np.unique(np.searchsorted(self.firsts, hit, "right") - 1)


def _close(places: np.ndarray, anchors: np.ndarray, within: int) -> np.ndarray:
    """Which places have an anchor fewer than ``within`` words ahead, or at the same place."""
    at = np.searchsorted(anchors, places)
    inside = at < len(anchors)
    return inside & (anchors[np.minimum(at, len(anchors) - 1)] - places < within)


def _blocks(batches: Iterator[pa.RecordBatch], gap: int) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            one = [batch[name][i].values for name in ("terms", "counts", "places")]
            yield _Block(batch["docs"][i].as_py(), one[0].to_numpy().tolist(),
                         one[1].to_numpy(), one[2].to_numpy(), gap)


def phrase_matches(index: DataFrame, phrases: Phrases, frequency: np.ndarray,
                   gap: int = WINDOW) -> DataFrame:
    """Per document: ``id``, ``n_words``, the merged ``hits`` (word spans, end exclusive) of all
    phrase matches, and ``items``, the benchmark items with a match, sorted as strings."""
    rarest: dict[int, list[tuple]] = {}
    for window, names in phrases.windows():
        offsets = sorted(((t, i) for i, t in enumerate(window)), key=lambda x: (frequency[x[0]], x))
        if frequency[offsets[0][0]]:
            rarest.setdefault(int(offsets[0][0]), []).append((offsets, len(window), names))
    id_type = index.schema["docs"].dataType.elementType["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, gap):
            cover = np.zeros(block.firsts[-1] + 1, np.int32)
            items: dict[int, set[str]] = {}
            # Only windows whose rarest term the block holds can be in it.
            for ordered, width, names in chain.from_iterable(rarest.get(t, ()) for t in block.lists):
                starts = block.phrase(ordered)
                if len(starts):
                    cover[starts] += 1
                    cover[starts + width] -= 1
                    for doc in np.unique(np.searchsorted(block.firsts, starts, "right") - 1):
                        items.setdefault(int(doc), set()).update(names)
            inside = np.cumsum(cover) > 0
            edges = np.diff(np.r_[False, inside, False].astype(np.int8))
            opens, closes = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            owner = np.searchsorted(block.firsts, opens, "right") - 1
            hits: list[list[dict]] = [[] for _ in block.ids]
            for doc, start, end in zip(owner.tolist(), opens.tolist(), closes.tolist()):
                first = int(block.firsts[doc])
                hits[doc].append({"start": start - first, "end": end - first})
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(block.ids, batch_type),
                "n_words": pa.array(block.words, pa.int64()),
                "hits": pa.array(hits, pa.list_(pa.struct([("start", pa.int32()),
                                                           ("end", pa.int32())]))),
                "items": pa.array([sorted(items.get(d, ())) for d in range(len(block.ids))],
                                  pa.list_(pa.string())),
            })

    batch_type = _arrow_type(index)
    return index.mapInArrow(run, f"id {id_type}, n_words long, "
                                 "hits array<struct<start:int,end:int>>, items array<string>")


def _arrow_type(index: DataFrame) -> pa.DataType:
    return to_arrow_type(index.schema["docs"].dataType.elementType["id"].dataType)


def proximity_matches(index: DataFrame, phrases: Phrases, frequency: np.ndarray,
                      within: int, gap: int = WINDOW) -> DataFrame:
    """(id, item): documents in which all words of an item lie, in any order, inside ``within``
    consecutive words. ``within`` may be at most ``gap`` of the index, so that no stretch runs from
    one document into the next."""
    if within > gap + 1:
        raise ValueError("within exceeds the gap between documents that the index was built with")
    queries = [(name, sorted(set(terms.tolist()), key=lambda t: (frequency[t], t)))
               for name, terms in phrases.items]
    id_type = index.schema["docs"].dataType.elementType["id"].dataType.simpleString()
    batch_type = _arrow_type(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, gap):
            found = [(block.ids[doc], name) for name, terms in queries
                     for doc in block.near(terms, within).tolist()]
            yield pa.RecordBatch.from_pydict({
                "id": pa.array([f[0] for f in found], batch_type),
                "item": pa.array([f[1] for f in found], pa.string())})

    return index.mapInArrow(run, f"id {id_type}, item string")


_MERGED = """aggregate(array_sort(flatten(collect_set(hits))),
  cast(array() as array<struct<start:int,end:int>>),
  (kept, h) -> if(size(kept) > 0 and element_at(kept, -1).end >= h.start,
    concat(slice(kept, 1, size(kept) - 1), array(named_struct('start', element_at(kept, -1).start,
      'end', greatest(element_at(kept, -1).end, h.end)))),
    concat(kept, array(h))))"""


def matches(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
            text_column: str = "text", item_id: str = "item_id", item_text: str = "text",
            width: int = WINDOW, slice_words: int = SLICE_WORDS) -> DataFrame:
    """Exact matches of all windows of ``width`` words of the benchmark in all documents, as
    ``phrase_matches`` gives them, with the id column under its own name."""
    slices = phrases_of(benchmark, item_id, item_text, width, slice_words)
    first, second = next(slices), next(slices, None)
    if second is None:
        found = _one_pass(docs, first, width, id_column, text_column)
        return found.withColumnRenamed("id", id_column)
    digest = F.unhex(F.sha2(F.col(text_column), 256))
    rows = docs.select(F.struct(F.col(id_column).alias("id"), digest.alias("digest")).alias("id"),
                       F.col(text_column).alias("text"))
    passes = chain([first, second], slices)
    vocabulary = whole_vocabulary(benchmark, item_text)
    if vocabulary is None:
        parts = [_one_pass(rows, phrases, width, "id", "text") for phrases in passes]
    else:
        index = build_index(rows, vocabulary, run_dir(docs.sparkSession, "postings"), width, "id", "text")
        frequency = document_frequencies(index, len(vocabulary))
        parts = [phrase_matches(index, phrases.over(vocabulary), frequency, width) for phrases in passes]
    return _merged(parts).withColumnRenamed("id", id_column)


def _one_pass(docs: DataFrame, phrases: Phrases, width: int, id_column: str,
              text_column: str) -> DataFrame:
    index = build_index(docs, phrases.vocabulary, run_dir(docs.sparkSession, "postings"), width,
                        id_column, text_column)
    return phrase_matches(index, phrases, document_frequencies(index, len(phrases.vocabulary)), width)


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Matches of several passes over the same rows, whose ``id`` is a struct that holds the id; a
    row per row of each pass. Equal rows match alike, so sets keep a group as small as one row's."""
    found = reduce(DataFrame.unionByName, parts).groupBy("id").agg(
        F.max("n_words").alias("n_words"), F.expr(_MERGED).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        (F.count(F.lit(1)) / len(parts)).cast("long").alias("n"))
    # Many equal rows are dealt out in shares, so that no task writes them all.
    shares = F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {EQUAL_ROWS}"))
    found = found.withColumn("share", F.explode(shares)).repartition("id", "share")
    copies = F.least(F.lit(EQUAL_ROWS).cast("long"), F.col("n") - F.col("share") * EQUAL_ROWS)
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return found.select(F.col("id.id").alias("id"), "n_words", "hits", "items")


def contamination(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The verdict per document: contaminated if words are hit and hits are a twentieth or more."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return (found.withColumn("n_hit", n_hit)
            .select(id_column, "n_words", "n_hit",
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
                    .alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
                      text_column: str = "text", **options) -> DataFrame:
    """The clean rows with all their columns. Rows are told apart by a hash of id and text."""
    spark = docs.sparkSession
    row = F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text_column}`"))
    found = contamination(matches(docs.select(row.alias("row"), F.col(text_column).alias("text")),
                                  benchmark, "row", "text", **options), "row")
    path = run_dir(spark, "contaminated")
    dropped = fresh(docs, "dropped")
    found.where("contaminated").select(F.col("row").alias(dropped)).write.parquet(path)
    # As a stored table its size is known, so a short list is broadcast and texts stay in place.
    return docs.join(spark.read.parquet(path), row == F.col(dropped), "left_anti")
