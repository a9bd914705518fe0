"""URL filtering by listed rules and mined association rules.

A URL is cut into tokens: the words of its host, its top-level domain, the segments of its path and
the keys of its query; rules combine any number of them. Labelled pages are the transactions of an FP-growth
run in Spark: the tokens of a page plus, if its label is bad, the item ``BLOCK``. Rules ``tokens =>
BLOCK`` are kept if they hold often enough (support), surely enough (confidence) and more often than
chance (lift), and dropped if a rule with fewer of the same tokens is at least as sure.

A rule is filed under its rarest token only; URLs look up their tokens in this inverted index and the
few rules that come up are checked whole. Each distinct URL is judged once, so a URL, host or token
that many pages share costs no more than one row per distinct URL, and rules are joined by size, not
broadcast by hint.

Listed rules (host, path, verdict) come first: a rule fits its host and all subdomains if the path
starts with the rule's; of those that fit, the one with the longest host and path wins.

Edge rows: a null URL and one without ``://`` have empty host and path, no tokens and the verdict
allow; without labelled pages, or if no rule passes, everything not listed is allowed; labels that
are null are unknown, of several labels of an id the worst counts; repeated rows or ids give one
output row each; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.operators.keyed import same_key
from tillstream.session import run_dir

BLOCK = "=block"
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.002, 0.5, 1.5
# Bad pages that a rule must cover however few pages are labelled.
LEAST_PAGES = 5


@dataclass(frozen=True)
class Listed:
    """A rule of the operator's own list."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


LISTED = (Listed("com", "/", "allow"), Listed("example.com", "/en/", "block"),
          Listed("www.example.com", "/en/", "allow"), Listed("net", "/es/", "block"),
          Listed("net", "/fr/", "block"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty if null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr({u}, instr({u}, '://') + 3)".format(u="url")))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def listed_rule(host: Column, path: Column, rules: tuple[Listed, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name = verdict = F.lit(None).cast("string")
    # Longest last, so that it is tested first.
    for rule in sorted(rules, key=lambda r: (len(r.host), len(r.path))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL."""
    words = F.filter(F.split(host, r"[.:@]"), lambda w: w != "")
    top = F.element_at(words, -1)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\A[^#?]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1)),
                    lambda k: k != "")
    return F.array_distinct(F.concat(
        F.transform(words, lambda w: F.concat(F.lit("host:"), w)),
        F.when(F.size(words) > 0, F.array(F.concat(F.lit("top:"), top))).otherwise(F.array()),
        F.transform(F.filter(F.split(path, "/"), lambda s: s != ""),
                    lambda s: F.concat(F.lit("path:"), s)),
        F.transform(keys, lambda k: F.concat(F.lit("key:"), k))))


def parse(pages: DataFrame, id_column: str, url_column: str) -> DataFrame:
    """``id``, ``url``, ``host``, ``path`` and ``tokens`` of every page."""
    slim = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"))
    host, path = host_and_path(F.col("url"))
    return (slim.withColumn("host", host).withColumn("path", path)
            .withColumn("tokens", _tokens(F.col("url"), F.col("host"), F.col("path"))))


_RULES = "antecedent array<string>, confidence double, support double"


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules from ``tokens`` and ``bad`` (boolean) of labelled URLs: ``antecedent``,
    ``confidence``, ``support``."""
    spark = labelled.sparkSession
    counts = labelled.agg(F.count(F.lit(1)), F.sum(F.col("bad").cast("long"))).first()
    if not counts[1]:
        return spark.createDataFrame([], _RULES)
    # Tokens too rare beside BLOCK to be in a rule are left out, so transactions stay short.
    least = max(LEAST_PAGES, min_support * counts[0])
    frequent = (labelled.where("bad").select(F.explode("tokens").alias("token"))
                .groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
                .select(F.col("token").alias("kept")))
    row = labelled.select(F.monotonically_increasing_id().alias("row"), "bad", "tokens")
    path = run_dir(spark, "url-transactions")
    row.write.parquet(path)
    row = spark.read.schema(row.schema).parquet(path)
    items = (row.select("row", F.explode("tokens").alias("token"))
             .join(frequent, same_key(F.col("token"), F.col("kept")))
             .groupBy("row").agg(F.collect_set("token").alias("items")))
    baskets = (row.select(F.col("row").alias("r"), "bad")
               .join(items, F.col("r") == F.col("row"), "left")
               .select(F.concat(F.coalesce("items", F.array().cast("array<string>")),
                                F.when(F.col("bad"), F.array(F.lit(BLOCK)))
                                .otherwise(F.array().cast("array<string>"))).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / counts[0]),
                     minConfidence=min_confidence).fit(baskets)
    rules = (model.associationRules.where((F.size("consequent") == 1)
                                          & (F.element_at("consequent", 1) == BLOCK)
                                          & (F.col("lift") >= min_lift))
             .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"))
    path = run_dir(spark, "url-rules")
    rules.write.parquet(path)
    rules = spark.read.schema(_RULES).parquet(path)
    return _needed(rules)


def _filed(rules: DataFrame, frequency: DataFrame) -> DataFrame:
    """Rules (``antecedent``) with the ``rarest`` of their tokens by ``frequency`` (``token``,
    ``n``); a rule none of whose tokens occurs there is left out."""
    return (rules.select("antecedent", F.explode("antecedent").alias("own"))
            .join(frequency, F.col("own") == F.col("token"))
            .groupBy("antecedent").agg(F.min(F.struct("n", "own"))["own"].alias("rarest")))


def _needed(rules: DataFrame) -> DataFrame:
    """Rules no part of which is a rule that is at least as sure. By number of tokens, so that longer
    rules, of whatever length, are compared with the needed shorter ones only."""
    spark = rules.sparkSession
    kept, rest = rules.limit(0), rules
    while (size := rest.agg(F.min(F.size("antecedent"))).first()[0]) is not None:
        level = rest.where(F.size("antecedent") == size)
        longer = rest.where(F.size("antecedent") > size)
        kept = kept.unionByName(level)
        posted = longer.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
        frequency = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        known = (_filed(level, frequency).withColumnRenamed("antecedent", "known")
                 .join(level.select("antecedent", F.col("confidence").alias("sure")),
                       F.col("known") == F.col("antecedent")).drop("antecedent"))
        needless = (posted.join(known, same_key(F.col("token"), F.col("rarest")))
                    .where((F.size(F.array_except("known", "antecedent")) == 0)
                           & (F.col("sure") >= F.col("confidence")))
                    .select(F.col("antecedent").alias("dropped")).distinct())
        path = run_dir(spark, "url-rules-left")
        (longer.join(needless, F.col("antecedent") == F.col("dropped"), "left_anti")
         .write.parquet(path))
        rest = spark.read.schema(_RULES).parquet(path)
    return kept


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``url``s of ``urls`` (``url``, ``tokens``) to which a rule applies."""
    distinct = urls.where(F.size("tokens") > 0).select("url", "tokens").distinct()
    posted = distinct.select("url", "tokens", F.explode("tokens").alias("token"))
    frequency = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    hit = (posted.join(_filed(rules, frequency), same_key(F.col("token"), F.col("rarest")))
           .where(F.size(F.array_except("antecedent", "tokens")) == 0))
    return hit.select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, id_column: str = "page_id", url_column: str = "url",
          label_id: str = "doc_id", good_column: str = "quality",
          listed: tuple[Listed, ...] = LISTED, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """Id, ``host``, ``path``, ``rule`` (the listed rule, or null) and ``verdict`` of every page.
    ``labels`` rates pages by id: ``good_column`` 0 is bad, 1 good."""
    parsed = parse(pages, id_column, url_column)
    marks = (labels.where(F.col(label_id).isNotNull() & F.col(good_column).isNotNull())
             .groupBy(F.col(label_id).alias("rated"))
             .agg((F.min(good_column) == 0).alias("bad")))
    labelled = parsed.join(marks, F.col("id") == F.col("rated")).select("tokens", "bad")
    rules = mine(labelled, min_support, min_confidence, min_lift)
    blocked = match(parsed, rules).select(F.col("url").alias("bad_url"))
    judged = parsed.join(blocked, same_key(F.col("url"), F.col("bad_url")), "left")
    name, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    mined = F.when(F.col("bad_url").isNotNull(), "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_column), "host", "path", name.alias("rule"),
                         F.coalesce(verdict, mined).alias("verdict"))
