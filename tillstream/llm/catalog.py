"""Queries of the training-data operators over the test tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm import (bpe, decontaminate, hard_negatives, language, merkle, secret_scan,
                            sharding, simhash, token_counts, toxicity, url_rules, vectors,
                            word_bpe)
from tillstream.session import tune

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(_table(spark, sf_dir, "documents"),
                                  _table(spark, sf_dir, "benchmark"))
    return decontaminate.contamination(found)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op6_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(_table(spark, sf_dir, "embeddings"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.predict(docs, *language.fit(docs))


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (sharding.assign(_table(spark, sf_dir, "documents"))
            .selectExpr("doc_id", "size", "text_crc32", "'rows' AS law", "shard", "slot",
                        "CAST(NULL AS INT) AS grown_shard", "curve"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents")).drop("found")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"),
                      public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                      with_ids=False)


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = word_bpe.encode(_table(spark, sf_dir, "documents"),
                              public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = merkle.digest(*fields, F.translate("text", upper, lower))
    rows = docs.select("doc_id", "source", merkle.digest(*fields, F.col("text")).alias("leaf"),
                       F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, tampered)
                       .alias("tampered"))
    proved = merkle.prove(merkle.manifest(rows, "source", "doc_id", "leaf"))
    folded = proved.select(
        "row.doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"),
        merkle.fold(F.col("path"), F.coalesce("row.tampered", "leaf")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table.select("vec_id", moved.alias("label"), F.transform(
        "embedding", lambda x: F.when(F.abs(x) < float("inf"), F.floor(F.lit(256.0) * x.cast("double"))))
        .alias("embedding"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_simhash": op2_simhash,
    "op3_toxicity": op3_toxicity,
    "op4_url_rules": op4_url_rules,
    "op5_token_counts": op5_token_counts,
    "op6_multi_index_hashing": op6_multi_index_hashing,
    "op7_language": op7_language,
    "op8_hilbert_shards": op8_hilbert_shards,
    "op9_secret_scan": op9_secret_scan,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_word_bpe": op11_word_bpe,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hard_negatives": op13_hard_negatives,
}

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# Unsigned CRC-32 of the decimal id, byte by byte and bit by bit (-1: shift).
_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""
_LEAF = "sha256(" + " || ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
# One level up: the own digest in its place among the others, and the others behind the proof.
_STEP = """sha256(list_aggregate(list_concat(hs[:i % 16], [acc], hs[i % 16 + 2:]), 'string_agg', '')),
            proof || coalesce(list_aggregate(list_concat(hs[:i % 16], hs[i % 16 + 2:]), 'string_agg', ''), '')"""

SQL: dict[str, str] = {
    "op1_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, list_slice(w, s + 1, s + 13) AS q
                FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS s
                      FROM b WHERE len(w) > 0)),
        size AS (SELECT DISTINCT len(q) AS n FROM win),
        place AS (SELECT r, n, s, list_slice(w, s + 1, s + n) AS q
                  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS s
                        FROM d JOIN size ON len(w) >= n)),
        hit AS (SELECT r, n, s, item_id FROM place JOIN win USING (q)),
        word AS (SELECT r, count(DISTINCT p) AS n_hit
                 FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
        item AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
                 FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)""",
    "op12_merkle_manifest": f"""
        WITH RECURSIVE d AS (
          SELECT row_number() OVER () AS r, *, {_CRC} % 5 = 0 AS hit,
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
          FROM documents),
        leaf AS (SELECT r, doc_id, source, hit, {_LEAF.format(text='text')} AS h,
          {_LEAF.format(text='lowered')} AS low FROM d),
        placed AS (SELECT *, row_number() OVER (PARTITION BY source
          ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaf),
        node AS (
          SELECT source, 0 AS lvl, i, h, count(*) OVER (PARTITION BY source) AS n FROM placed
          UNION ALL
          SELECT source, lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16
          FROM node WHERE n > 1 GROUP BY source, lvl, i // 16, n),
        sub AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i
          FROM node WHERE n = 1),
        top AS (
          SELECT 0 AS lvl, i, subroot AS h, count(*) OVER () AS n FROM sub
          UNION ALL
          SELECT lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16
          FROM top WHERE n > 1 GROUP BY lvl, i // 16, n),
        run AS (SELECT source, lvl, i // 16 AS run, list(h ORDER BY i) AS hs FROM node WHERE n > 1
          GROUP BY source, lvl, i // 16),
        top_run AS (SELECT lvl, i // 16 AS run, list(h ORDER BY i) AS hs FROM top WHERE n > 1
          GROUP BY lvl, i // 16),
        up AS (
          SELECT r, source, 0 AS lvl, i, CASE WHEN hit THEN low ELSE h END AS acc, '' AS proof
          FROM placed
          UNION ALL
          SELECT r, up.source, up.lvl + 1, i // 16, {_STEP}
          FROM up JOIN run ON run.source IS NOT DISTINCT FROM up.source AND run.lvl = up.lvl
            AND run = i // 16),
        mid AS (SELECT up.r, up.acc, up.proof, s.i, subroot FROM up JOIN sub s
          ON s.source IS NOT DISTINCT FROM up.source WHERE up.lvl =
            (SELECT max(lvl) FROM node WHERE node.source IS NOT DISTINCT FROM up.source)),
        fin AS (
          SELECT r, 0 AS lvl, i, acc, proof FROM mid
          UNION ALL
          SELECT r, fin.lvl + 1, i // 16, {_STEP}
          FROM fin JOIN top_run ON top_run.lvl = fin.lvl AND run = i // 16)
        SELECT doc_id, placed.h AS leaf, subroot, top.h AS root, sha256(fin.proof) AS proof_sha256,
          fin.acc AS folded_root, fin.acc = top.h AS verified
        FROM fin JOIN placed USING (r) JOIN mid USING (r) JOIN top ON top.n = 1
        WHERE fin.lvl = top.lvl""",
    "op13_hard_negatives": """
        WITH e AS (SELECT row_number() OVER () AS r, vec_id,
            CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pair AS (SELECT a.r, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
            CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
          FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        pos AS (SELECT r, anchor_id, id AS positive_id, score AS positive_score,
            row_number() OVER (PARTITION BY r ORDER BY score DESC, id) AS w
          FROM pair WHERE same QUALIFY w <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.r, w
            ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score,
            score AS negative_score
          FROM pos p JOIN pair n ON n.r = p.r AND NOT same AND 80 * positive_score <= 100 * score
            AND 100 * score <= 100 * positive_score
          QUALIFY rank <= 5""",
}
