"""Ranked full-text search over stored postings.

An index is two tables in hash folders: ``terms`` holds a posting per document and word (how often,
how long the document), in folders by the word's hash, ``docs`` the current length of every document,
in folders by the document's hash. Documents come in batches and replace older ones by their id: a
posting counts only if it is of its document's latest batch. A search opens the folders of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillstream.operators.keyed import same_key
from tillstream.sinks import tables as sink_tables

SLOTS = 64
# The usual constants of the ranking formula: how fast repeats wear off, how much length counts.
K1, B = 1.2, 0.75
TERMS = T.StructType([T.StructField("term", T.StringType()), T.StructField("id", T.LongType()),
                      T.StructField("n", T.IntegerType()), T.StructField("length", T.IntegerType())])
DOCS = T.StructType([T.StructField("id", T.LongType()), T.StructField("length", T.IntegerType())])


def words(text: Column) -> Column:
    """Words of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def index(docs: DataFrame, field: str, path: str, batch_id: int, id_column: str = "id",
          slots: int = SLOTS) -> None:
    """Add documents, or replace those with the same id; the same batch again replaces itself. Of an id
    that comes twice in a batch the larger text counts."""
    rows = (docs.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("long").alias("id"))
            .agg(F.max(field).alias("text")).select("id", words(F.coalesce("text", F.lit(""))).alias("w"))
            .withColumn("length", F.size("w")))
    sink_tables.append_slots(rows.select("id", "length", sink_tables.slot_of(F.col("id"), slots).alias("slot")),
                             f"{path}/docs", batch_id)
    postings = (rows.select("id", "length", F.explode("w").alias("term")).groupBy("term", "id", "length")
                .agg(F.count(F.lit(1)).cast("int").alias("n")))
    sink_tables.append_slots(postings.withColumn("slot", sink_tables.slot_of(F.col("term"), slots)),
                             f"{path}/terms", batch_id)


def search(spark: SparkSession, path: str, text: str, slots: int = SLOTS) -> DataFrame:
    """``id`` and ``score`` of the documents that hold a word of ``text``: per word its rarity times how
    often it is in the document, in proportion to the document's length."""
    asked = spark.range(1).select(F.explode(F.array_distinct(words(F.lit(text)))).alias("term"))
    found = [(r["term"], r["slot"]) for r in
             asked.select("term", sink_tables.slot_of(F.col("term"), slots).alias("slot")).collect()]
    docs = (sink_tables.read_slots(spark, f"{path}/docs", DOCS).groupBy("id")
            .agg(F.max(F.struct("batch", "length")).alias("last")).select("id", "last.*"))
    sizes = docs.agg(F.count(F.lit(1)).alias("docs"), F.avg("length").alias("mean")).first()
    hits = (sink_tables.read_slots(spark, f"{path}/terms", TERMS, sorted({slot for _, slot in found}))
            .where(F.col("term").isin([term for term, _ in found])))
    # A word may be in a third of all documents: postings meet their document by a join that can be split.
    last = docs.select(F.col("id").alias("_id"), F.col("batch").alias("_batch"))
    hits = hits.join(last, same_key(F.col("id"), F.col("_id")) & (F.col("batch") == F.col("_batch")), "left_semi")
    # As many rows as the search has words.
    rarity = hits.groupBy(F.col("term").alias("_term")).agg(F.count(F.lit(1)).alias("df")).select(
        "_term", F.log(1 + (sizes["docs"] - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    wear = F.col("n") + K1 * (1 - B + B * F.col("length") / (sizes["mean"] or 1.0))
    weight = F.col("idf") * F.col("n") * (K1 + 1) / wear
    return (hits.join(rarity, F.col("term") == F.col("_term")).groupBy("id")
            .agg(F.sum(weight).alias("score")))
