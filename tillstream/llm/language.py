"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram of letters is bound into one vector: the
letters' vectors, each permuted (rotated) by its place from the end, are multiplied element by
element, so the same letters in another order give an unrelated vector. A text is bundled into the
sum of the vectors of all its n-grams, a language into the sum of its texts' unit vectors. A text
gets the language whose prototype has the largest cosine with it; equal cosines go to the
alphabetically first language.

Letters are lower-cased characters that are alphabetic; any run of others is one boundary, which has
a vector as well. Letters above U+024F share ``SLOTS`` vectors by their number.

Prototypes come from at most some ``most`` texts per language among the rows that are not held out,
chosen by a hash of the id against a share computed from the language's row count.

Edge rows: null texts and texts without a letter are ``und`` with score 0, and so is everything if no
language could be learnt; rows without language are not learnt from; repeated rows or ids give one
output row each; a null id counts as the text "" for the held-out rule; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.texts import steps, strings
from tillstream.session import run_dir

GRAM, SIZE, SLOTS = 3, 1024, 1024
MOST = 2_000
UNKNOWN = "und"
_DIRECT = 0x250
# Entries of a dense text-by-n-gram matrix multiplied at once.
_DENSE = 4 << 20


def held_out(doc_id: str | Column, folds: int = 3, fold: int = 1) -> Column:
    """Rows that must not be learnt from, by the CRC of the id as text."""
    name = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(name.cast("string"), F.lit(""))) % folds == fold


@lru_cache(maxsize=1)
def _slot_table() -> np.ndarray:
    """Slot of every code point: 0 for what is no letter, a letter's lower-case slot else."""
    table = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            small = ord(char.lower()[0])
            table[point] = 1 + (small if small < _DIRECT else _DIRECT + small % (SLOTS - _DIRECT - 1))
    return table


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """A random +1/-1 vector per slot, the same on every machine."""
    return np.random.default_rng(20).choice(np.array([-1, 1], np.int8), (SLOTS + 1, SIZE))


def bind(slots: np.ndarray) -> np.ndarray:
    """Vectors of n-grams given as rows of slots."""
    letters, bound = _letters(), None
    for place in range(slots.shape[1]):
        turned = np.roll(letters, slots.shape[1] - 1 - place, axis=1)[slots[:, place]]
        bound = turned if bound is None else bound * turned
    return bound.astype(np.float32)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, n-gram code) pairs with counts, sorted by text, and which texts have
    letters."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    slots = _slot_table()[points]
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    # One boundary between words, one at each end of every text that has letters.
    letter = slots > 0
    inner = np.flatnonzero(letter)
    slots, owner = slots[inner], owner[inner]
    breaks = np.r_[True, (np.diff(inner) > 1) | (np.diff(owner) > 0)][:len(inner)]
    gaps = np.flatnonzero(breaks)
    slots, owner = np.insert(slots, gaps, 0), np.insert(owner, gaps, owner[gaps])
    ends = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True][:len(owner)]) + 1
    slots, owner = np.insert(slots, ends, 0), np.insert(owner, ends, owner[ends - 1])
    code = np.zeros(max(0, len(slots) - GRAM + 1), np.int64)
    for place in range(GRAM):
        code = code * (SLOTS + 1) + slots[place:place + len(code)]
    same = owner[:len(code)] == owner[GRAM - 1:GRAM - 1 + len(code)]
    base = (SLOTS + 1) ** GRAM
    pairs, counts = np.unique(owner[:len(code)][same] * base + code[same], return_counts=True)
    has_letter = np.zeros(len(texts), bool)
    has_letter[owner] = True
    return pairs // base, pairs % base, counts, has_letter


def bundles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Unit bundle of each text (zero without letters), and which texts have letters."""
    text, code, counts, has_letter = grams(texts)
    out = np.zeros((len(texts), SIZE), np.float32)
    start = 0
    while start < len(text):
        # Texts are taken while their n-grams, all different, would fit the dense matrix.
        stop = start
        first = text[start]
        while stop < len(text):
            upto = int(np.searchsorted(text, text[stop], "right"))
            if stop > start and (text[stop] - first + 1) * (upto - start) > _DENSE:
                break
            stop = upto
        seen, at = np.unique(code[start:stop], return_inverse=True)
        places = np.stack([seen // (SLOTS + 1) ** k % (SLOTS + 1) for k in range(GRAM - 1, -1, -1)],
                          axis=1)
        rows = int(text[stop - 1] - first + 1)
        dense = np.zeros((rows, len(seen)), np.float32)
        dense[text[start:stop] - first, at] = counts[start:stop]
        for part in range(0, len(seen), 8192):
            out[first:first + rows] += dense[:, part:part + 8192] @ bind(places[part:part + 8192])
        start = stop
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1), has_letter


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language the sum of a step's unit bundles."""
    for step in steps(batches, "text"):
        vectors, _ = bundles(strings(step["text"]))
        names, at = np.unique(np.array(step["lang"].to_pylist(), object).astype(str),
                              return_inverse=True)
        sums = np.zeros((len(names), SIZE))
        np.add.at(sums, at, vectors)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(names.tolist(), pa.string()),
            "total": pa.array(list(sums), pa.list_(pa.float64()))})


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        lang_column: str = "lang", most: int = MOST) -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order, and their unit prototypes as rows."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                       F.col(lang_column).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id"))
    spark, path = docs.sparkSession, run_dir(docs.sparkSession, "language-shares")
    (rows.groupBy(F.col("lang").alias("known")).agg((F.lit(most) / F.count(F.lit(1))).alias("share"))
     .write.parquet(path))
    # As a stored table its size is known: a few languages are broadcast, any number is joined.
    shares = spark.read.parquet(path)
    dice = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) / (1 << 30)
    chosen = rows.join(shares, F.col("lang") == F.col("known")).where(dice < F.col("share"))
    sums = (chosen.select("lang", "text").mapInArrow(_sums, "lang string, total array<double>")
            .select("lang", F.posexplode("total").alias("place", "value"))
            .groupBy("lang", "place").agg(F.sum("value").alias("value"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value")))["value"]
                                 .alias("total"))
            .orderBy("lang").toPandas())
    prototypes = np.array(sums["total"].tolist(), np.float32).reshape(len(sums), SIZE)
    norm = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return sums["lang"].tolist(), prototypes / np.where(norm > 0, norm, 1)


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """Id, ``held_out``, ``lang_pred`` and ``score`` (the cosine, not below 0) of every row."""
    slim = docs.select(F.col(id_column).alias("id"), held_out(id_column).alias("held_out"),
                       F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            vectors, has_letter = bundles(strings(step["text"]))
            names = [UNKNOWN] * len(vectors)
            score = np.zeros(len(vectors))
            if languages:
                cosines = vectors @ prototypes.T
                best = cosines.argmax(axis=1)
                score = np.where(has_letter, np.clip(cosines.max(axis=1), 0, 1), 0.0)
                names = [languages[b] if h else UNKNOWN for b, h in zip(best, has_letter)]
            yield pa.RecordBatch.from_pydict({
                "id": step["id"], "held_out": step["held_out"],
                "lang_pred": pa.array(names, pa.string()), "score": pa.array(score, pa.float64())})

    id_type = slim.schema["id"].dataType.simpleString()
    return (slim.mapInArrow(run, f"id {id_type}, held_out boolean, lang_pred string, score double")
            .withColumnRenamed("id", id_column))
