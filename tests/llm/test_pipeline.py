"""The corpus pipeline, its registration, and life without it."""

import shutil
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests import check
from tillstream.llm import bpe, catalog, decontaminate, secret_scan, simhash, toxicity

REPO = Path(__file__).resolve().parents[2]


def test_every_stage_decides_on_what_it_was_given(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        seen[name] = docs, spark.read.parquet(str(tmp_path / name))
        docs = seen[name][1]
        if name != "encoding":
            assert docs.columns == seen["toxicity"][0].columns

    def ids(frame):
        return sorted(r.doc_id for r in frame.select("doc_id").collect())

    given, kept = seen["toxicity"]
    scores = toxicity.score(given, toxicity.fit(given, labels))
    assert ids(kept) == ids(scores.where("predicted = 0"))
    given, kept = seen["near_duplicates"]
    assert ids(kept) == ids(simhash.near_duplicates(given).where("doc_id = component_id"))
    given, kept = seen["decontamination"]
    judged = decontaminate.contamination(decontaminate.matches(given, benchmark))
    assert ids(kept) == ids(judged.where("NOT contaminated")) and kept.count() < given.count()
    given, kept = seen["secrets"]
    before = {r.doc_id: r.text for r in given.collect()}
    for r in kept.collect():
        text = before.pop(r.doc_id)
        spans = secret_scan.base_spans(text) + secret_scan.confirmed_spans(text)
        assert r.text == secret_scan.blank_out(text, spans) and r.n_chars == len(r.text)
    assert not before
    given, kept = seen["encoding"]
    again = bpe.encode(given, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)
    assert sorted(kept.select("doc_id", "ids").collect()) == sorted(
        again.select("doc_id", "ids").collect())
    decoded = given.join(kept, "doc_id").where(F.sha2("text", 256) == F.col("decoded_sha256"))
    assert decoded.count() == given.count()


@pytest.mark.parametrize("rows", ["none", "odd"])
def test_stages_take_odd_rows(spark, make_docs, edge_rows, sf_dir, rows):
    docs = make_docs(edge_rows if rows == "odd" else [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() <= docs.count()
        if name != "encoding":
            assert out.columns == docs.columns


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_sql_twins(spark, sf_dir, name):
    con = check.connect(sf_dir)
    assert check.compare(spark, con, catalog.QUERIES[name], catalog.SQL[name], sf_dir) is None


def test_the_rest_stands_alone(tmp_path):
    """Without the subpackage and the pipeline the entry module offers the other queries."""
    code = ("import __spark_entry__ as e; q = set(e.queries()); s = set(e.oracle_sql());"
            "print(len([n for n in q if n.startswith('op') and n[2:3].isdigit()]), 'pipeline' in q,"
            " len(q) > 40, s <= q)")

    def run(folder):
        return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True,
                              text=True, timeout=120, check=True).stdout.split()

    assert run(REPO) == ["13", "True", "True", "True"]
    rest = tmp_path / "rest"
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(REPO, rest, ignore=skip)
    assert run(rest) == ["0", "False", "True", "True"]
