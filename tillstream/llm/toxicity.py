"""Toxicity by non-negative positive-unlabelled learning.

The learner sees confirmed toxic texts (P) and texts of unknown kind (U), never confirmed clean
ones. With the class prior p, the risk of a linear scorer z under the logistic loss l is

    p * mean_P l(z) + max(0, mean_U l(-z) - p * mean_P l(-z)).

The second term estimates the risk on clean texts; it cannot be negative, so where it becomes
negative the scorer has started to fit its sample, and the step goes back up on that term instead.
Confirmed labels of either kind serve only to estimate p, their share of toxic rows.

Features are presences of words and of word beginnings (``PREFIXES`` bytes) after lower-casing A-Z.
The fit runs on a bounded sample: some ``MOST_POSITIVE`` toxic and ``MOST_UNLABELLED`` other texts,
drawn by a hash of the id against a share computed from the row counts; if the drawn ids have more rows
than that by a quarter, as an id repeated without end has, rows are drawn among them. Spark counts in how many of them each feature occurs; the
``FEATURES`` that lean most to P go to numpy on the driver, a few tens of indices per text. Scoring
covers every whole text, in tasks, with the fitted weights.

Edge rows: null and empty texts have no features and get the score of the intercept; without toxic
examples or without any text to learn from every score is the class prior (0 if unknown); repeated
rows or ids give one output row each; a null id counts as the text "" for the held-out rule; repeated
label rows count once; null labels are unknown; other columns are ignored by ``score`` and kept by
``drop_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.texts import ASCII_LOWER, steps, utf8, word_hashes, word_spans
from tillstream.session import run_dir

PREFIXES = (4, 5, 6)
MOST_POSITIVE, MOST_UNLABELLED, FEATURES = 4_000, 16_000, 4_096
# Standard errors by which a feature must lean to P: beyond what chance gives millions of features.
LEAST_LEAN = 4
_WHOLE = np.uint64(0x5851F42D4C957F2D)
_SIEVE_BITS = 20
_FACES = 1 << 40


def held_out(doc_id: str | Column, folds: int = 5, fold: int = 0) -> Column:
    """Rows that labels must not be learnt from, by the CRC of the id as text."""
    name = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(name.cast("string"), F.lit(""))) % folds == fold


def _features(lowered: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of one kind of feature at a time, and the text each occurs in."""
    starts, ends, firsts = word_spans(lowered, bounds)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(firsts))
    yield word_hashes(lowered, starts, ends) ^ _WHOLE, text
    for width in PREFIXES:
        long = ends - starts > width
        yield word_hashes(lowered, starts[long], starts[long] + width), text[long]


def _distinct_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every feature of every text once: hashes (as signed) and text numbers."""
    data, bounds = utf8(texts)
    hashes, text = map(np.concatenate, zip(*_features(ASCII_LOWER[data], bounds)))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])][:len(hashes)]
    return hashes[new].view(np.int64), text[new]


@dataclass
class Model:
    """Weights of known feature hashes (sorted), and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float

    def __post_init__(self):
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)

    def present(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
        """Which known features (numbers) occur in which texts, each pair once."""
        data, bounds = utf8(texts)
        known, owners = [], []
        for hashes, text in _features(ASCII_LOWER[data], bounds):
            maybe = np.flatnonzero(self.sieve[self._slot(hashes)])
            hashes, text = hashes[maybe], text[maybe]
            at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
            same = self.hashes[at] == hashes if len(self.hashes) else np.zeros(0, bool)
            known.append(at[same])
            owners.append(text[same])
        pairs = np.unique(np.concatenate(owners) * max(1, len(self.hashes)) + np.concatenate(known))
        width = max(1, len(self.hashes))
        return pairs % width, pairs // width, len(bounds) - 1

    def scores(self, texts: pa.Array) -> np.ndarray:
        feature, text, rows = self.present(texts)
        z = self.intercept + np.bincount(text, self.weights[feature], rows)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-z))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit_nnpu(feature: np.ndarray, text: np.ndarray, positive: np.ndarray, features: int,
             prior: float, rounds: int = 400, rate: float = 0.05,
             decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept minimising the non-negative risk by Adam steps. ``feature`` and
    ``text`` list the ones of a sparse matrix; ``positive`` tells the rows of P from those of U."""
    rows = len(positive)
    share = np.where(positive, 1 / max(1, positive.sum()), 1 / max(1, (~positive).sum()))
    theta = np.zeros(features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        z = np.bincount(text, theta[feature], rows) + theta[-1]
        p = _sigmoid(z)
        as_clean = np.logaddexp(0, z)
        clean_risk = (share * as_clean)[~positive].sum() - prior * (share * as_clean)[positive].sum()
        # d l(z)/dz = p - 1 and d l(-z)/dz = p.
        slope_toxic = np.where(positive, prior * share * (p - 1), 0)
        slope_clean = np.where(positive, -prior, 1) * share * p
        slope = slope_toxic + slope_clean if clean_risk >= 0 else -slope_clean
        gradient = np.append(np.bincount(feature, slope[text], features) + decay * theta[:-1],
                             slope.sum())
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient ** 2
        theta -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _row_share(most: int, rows: int) -> float:
    """The share of drawn rows to keep: all, unless ids with many rows make them far too many."""
    return 1.0 if rows <= 1.25 * most else most / rows


def _sample(docs: DataFrame, labels: DataFrame, most_positive: int,
            most_unlabelled: int) -> tuple[DataFrame, float]:
    """The stored sample (``text``, ``positive``) and the class prior."""
    spark = docs.sparkSession
    marks = (labels.where(F.col("toxic").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    counts = marks.agg(F.count(F.lit(1)), F.sum((F.col("toxic") == 1).cast("long"))).first()
    prior = (counts[1] or 0) / counts[0] if counts[0] else 0.0

    others = docs.where(F.col("id").isNotNull() & ~held_out("id"))

    def drawn(ids: DataFrame, rows: int, most: int, positive: bool) -> DataFrame:
        dice = F.pmod(F.xxhash64("id", F.lit(positive)), F.lit(_FACES)) / _FACES
        return (ids.where(dice < most / max(rows, 1)).select("id").distinct()
                .select(F.col("id").alias("chosen"), F.lit(positive).alias("positive")))

    chosen = (drawn(marks.where("toxic = 1"), counts[1] or 0, most_positive, True)
              .unionAll(drawn(others, others.count(), most_unlabelled, False)))
    path = run_dir(spark, "toxicity-sample")
    # The ids are as many as the two bounds allow, whatever the input: safe to broadcast.
    chosen = F.broadcast(chosen)
    rows = docs.join(chosen, F.col("id") == F.col("chosen"))
    # An id may have any number of rows, so these are counted and drawn once more, row by row.
    sizes = {r["positive"]: r["count"] for r in rows.groupBy("positive").count().collect()}
    share = F.when(F.col("positive"), F.lit(_row_share(most_positive, sizes.get(True, 0)))).otherwise(
        F.lit(_row_share(most_unlabelled, sizes.get(False, 0))))
    numbered = docs.withColumn("nth", F.monotonically_increasing_id()).join(chosen, F.col("id") == F.col("chosen"))
    dice = F.pmod(F.xxhash64("id", "nth", "positive", F.lit("row")), F.lit(_FACES)) / _FACES
    numbered.where(dice < share).select("text", "positive").write.parquet(path)
    return spark.read.schema("text string, positive boolean").parquet(path), prior


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for step in steps(batches, "text"):
        hashes, text = _distinct_features(step["text"])
        positive = step["positive"].to_numpy(zero_copy_only=False)[text]
        seen, at = np.unique(hashes, return_inverse=True)
        yield pa.RecordBatch.from_pydict({
            "hash": seen, "in_p": np.bincount(at, positive, len(seen)).astype(np.int64),
            "in_u": np.bincount(at, ~positive, len(seen)).astype(np.int64)})


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        toxic_column: str = "toxic", most_positive: int = MOST_POSITIVE,
        most_unlabelled: int = MOST_UNLABELLED, features: int = FEATURES) -> Model:
    """Learn from the texts of ``docs`` and the toxic rows of ``labels`` that are not held out."""
    sample, prior = _sample(
        docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")),
        labels.select(F.col(id_column).alias("id"), F.col(toxic_column).alias("toxic")),
        most_positive, most_unlabelled)
    sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    nothing = Model(np.empty(0, np.uint64), np.empty(0), np.log(prior / (1 - prior))
                    if 0 < prior < 1 else (np.inf if prior else -np.inf))
    if not n_p or not n_u or not 0 < prior < 1:
        return nothing
    # How far the share of toxic texts with a feature lies above its share of all texts.
    both = (F.col("in_p") + F.col("in_u")) / F.lit(n_p + n_u)
    lean = ((F.col("in_p") / n_p - F.col("in_u") / n_u)
            / F.sqrt(both * (1 - both) * F.lit(1 / n_p + 1 / n_u) + F.lit(1e-9)))
    chosen = (sample.mapInArrow(_occurrences, "hash long, in_p long, in_u long")
              .groupBy("hash").agg(F.sum("in_p").alias("in_p"), F.sum("in_u").alias("in_u"))
              .where(F.col("in_p") >= max(3, n_p // 200)).withColumn("lean", lean)
              .where(F.col("lean") > LEAST_LEAN).orderBy(F.desc("lean"), "hash").limit(features).toPandas())
    if chosen.empty:
        return nothing
    hashes = np.sort(chosen["hash"].to_numpy(np.int64).view(np.uint64))
    blank = Model(hashes, np.zeros(len(hashes)), 0.0)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            feature, text, rows = blank.present(step["text"])
            cuts = np.searchsorted(text, np.arange(rows + 1))
            yield pa.RecordBatch.from_pydict({
                "positive": step["positive"],
                "features": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()),
                                                     pa.array(feature, pa.int32()))})

    rows = sample.mapInArrow(listed, "positive boolean, features array<int>").toPandas()
    text = np.repeat(np.arange(len(rows)), rows["features"].map(len).to_numpy())
    feature = np.concatenate(rows["features"].to_numpy()).astype(np.int64)
    weights, intercept = fit_nnpu(feature, text, rows["positive"].to_numpy(bool), len(hashes), prior)
    return Model(hashes, weights, intercept)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """Id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.5) of every row."""
    slim = docs.select(F.col(id_column).alias("id"), held_out(id_column).alias("held_out"),
                       F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            scores = model.scores(step["text"])
            yield pa.RecordBatch.from_pydict({
                "id": step["id"], "held_out": step["held_out"], "score": scores,
                "predicted": pa.array(scores >= 0.5, pa.bool_()).cast(pa.int32())})

    id_type = slim.schema["id"].dataType.simpleString()
    return (slim.mapInArrow(run, f"id {id_type}, held_out boolean, score double, predicted int")
            .withColumnRenamed("id", id_column))


def drop_toxic(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows predicted clean, all columns kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, text_column):
            yield step.filter(pc.less(pa.array(model.scores(step[text_column])), 0.5))

    return docs.mapInArrow(run, docs.schema)
