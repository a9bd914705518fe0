import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillstream.llm import word_bpe

FILE = public_tokenizers.path("word_bpe_49k.json")
WORDS = "the quick brown fox it's we'll naïve café Straße ΣΑΣ 中文 🙂 12 3.50 -- (x) ſ İ ǅ".split()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def same(library, texts):
    ours = word_bpe.tokenizer_of(FILE).encode(texts)
    for text, (packed, decoded), theirs in zip(texts, ours,
                                               library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(packed, np.int32).tolist() == theirs.ids, text[:80]
        assert decoded == library.decode(theirs.ids, skip_special_tokens=False)


def test_random_texts_equal_the_library(library):
    rng = random.Random(11)
    pool = [chr(c) for c in [*range(0x250), *range(0x300, 0x400), *range(0x890, 0x8E0), *range(0x1E00, 0x2100),
                             0x3000, 0x4E2D, 0xA7CB, 0x1F600, 0x1F468, 0x200D, 0x105C0, 0x32700]]
    signs = ["".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(3000)]
    words = ["".join(rng.choice(WORDS).swapcase() + rng.choice([" ", "", "\n", "́"])
                     for _ in range(rng.randint(1, 12))) for _ in range(1000)]
    same(library, signs + words)


def test_every_character_of_the_basic_plane(library):
    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x10000)]]
    same(library, ["".join(points[n:n + 7]) for n in range(0, len(points), 7)])


def test_special_strings_are_tokens_of_their_own(library):
    same(library, ["a<|endoftext|>B", "<|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|"])


@pytest.mark.parametrize("size", [3, 1000, 100_000])
def test_unbroken_words(library, size):
    rng = random.Random(size)
    same(library, ["".join(rng.choices("etaoinshr", k=size)), "x" * size, "ab" * size, "é" * size])


def test_long_texts_go_in_parts(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "LONG_TEXT", 100)
    monkeypatch.setattr("tillstream.llm.recent.PART", 7)
    same(library, ["many small words " * 50 + "<|endoftext|> and é more", "short"])


def test_a_vocabulary_used_out_of_order_is_refused():
    signs = word_bpe.byte_signs().values()
    vocabulary = {s: n for n, s in enumerate([*signs, *(f"{s}_" for s in signs), "ab", "abc_"])}
    word_bpe.PairMerges(vocabulary, [("a", "b"), ("ab", "c_")], "_")
    with pytest.raises(ValueError, match="before it is made"):
        word_bpe.PairMerges(vocabulary, [("ab", "c_"), ("a", "b")], "_")


def test_rows(spark, make_docs, edge_rows, library):
    got = word_bpe.encode(make_docs(edge_rows), FILE).collect()
    assert len(got) == len(edge_rows)
    texts = {}
    for doc_id, text in edge_rows:
        texts.setdefault(doc_id, []).append(library.encode(text or "", add_special_tokens=False).ids)
    found = {}
    for row in got:
        found.setdefault(row["doc_id"], []).append(row["ids"])
        assert row["decoded"] == library.decode(row["ids"], skip_special_tokens=False)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in texts.items()}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert word_bpe.encode(empty, FILE).collect() == []


def test_query_equals_the_library(spark, sf_dir, library):
    from hashlib import sha256
    from tillstream.llm import catalog
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = catalog.QUERIES["op11_word_bpe"](spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for row in got:
        ids = library.encode(docs[row["doc_id"]], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (
            len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            sha256(text.encode()).hexdigest())
