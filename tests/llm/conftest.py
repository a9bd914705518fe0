import pytest

DOC_FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
# Names the operators use inside, in documents of their own.
CLASHING = ("id", "print", "root", "key", "row", "hits", "n", "score", "cell", "slice", "shard",
            "dropped", "kept_id", "row_hash", "own_id", "known")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with clashing extra columns."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1])) + ("x",) * len(CLASHING) for r in rows]
        return spark.createDataFrame(full, DOC_FIELDS + "".join(f", {c} string" for c in CLASHING))
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, tiny, very long, repeated and non-Latin texts; null and repeated ids."""
    return [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "word " * 60_000), (6, "x" * 300_000),
            (7, "same text here again"), (8, "same text here again"), (8, "same text here again"),
            (None, "no id at all"), (None, None), (9, "ÄÖ ß 中文 🙂 \u0000 end"), (10, "Hello, World! 42")]
