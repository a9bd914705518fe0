import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstream.llm import hard_negatives as hard

SCHEMA = "vec_id long, label int, embedding array<bigint>, key string, block string"


def brute(rows, positives=5, negatives=5, least=80, most=100):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[2] and None not in r[2]]
    widths = [len(r[2]) for r in rows]
    width = max(set(widths), key=lambda w: (widths.count(w), w)) if rows else 0
    rows = [r for r in rows if len(r[2]) == width and max(map(abs, r[2])) <= hard.MOST]
    found = []
    for own, label, vector in rows:
        if own % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i, l) for i, l, v in rows if i != own)
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(n, s) for s, n, l in scored if l != label and least * -score <= 100 * -s <= most * -score]
            found += [(own, positive, k + 1, n, -score, -s) for k, (n, s) in enumerate(fits[:negatives])]
    return sorted(found)


def mined(spark, rows, **how):
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in hard.mine(table, F.col("vec_id") % 100 == 0, **how).collect())


def cloud(n, seed, spread=256, width=6, centres=8):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    points = middle[rng.integers(0, centres, n)] + 0.2 * rng.normal(size=(n, width))
    return [(i, int(rng.integers(0, 4)), [int(x) for x in p]) for i, p in enumerate(points * spread)]


@pytest.mark.parametrize("block_rows", [64, 10_000])
def test_clusters_equal_brute_force(spark, block_rows):
    rows = cloud(900, 1)
    assert mined(spark, rows, block_rows=block_rows) == brute(rows)


def test_copies_ties_and_rows_that_take_no_part(spark):
    rows = cloud(300, 2, spread=4)  # few distinct scores
    rows += [(1000 + i, i % 3, [3, 1, -2, 0, 4, 1]) for i in range(300)]
    rows += [(200, 1, [1, 2, 3, 4, 5, 6]), (200, 1, [1, 2, 3, 4, 5, 6]), (7, 2, [0] * 6), (400, 0, [0] * 6)]
    rows += [(None, 1, [1] * 6), (500, None, [1] * 6), (600, 1, None), (700, 1, []), (800, 1, [1, 2]),
             (900, 1, [1, None, 1, 1, 1, 1]), (1100, 1, [hard.MOST + 1, 0, 0, 0, 0, 0])]
    assert mined(spark, rows, block_rows=50) == brute(rows)


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 2)), rng.integers(-hard.MOST, hard.MOST, 9000).tolist()) for i in range(60)]
    rows += [(100, 0, rows[3][2]), (101, 0, rows[3][2][:-1] + [rows[3][2][-1] - 1])]
    assert mined(spark, rows, block_rows=20) == brute(rows)


def test_other_numbers_of_rows_and_windows(spark):
    rows = cloud(400, 4)
    assert (mined(spark, rows, positives=2, negatives=3, least=50, most=90, block_rows=100)
            == brute(rows, 2, 3, 50, 90))


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, 1, [1, 2])]) == []
    assert mined(spark, [(1, 1, [1, 2]), (2, 2, [1, 2])]) == []


def test_tree_covers_its_rows_and_searches_little():
    rows = cloud(4000, 5)
    ids, labels, vectors = (np.array(c) for c in zip(*rows))
    longest = float((vectors.astype(float) ** 2).sum(axis=1).max())
    tree = hard.build(ids, labels, vectors, longest, fan=8, leaf=16)
    points = hard.augmented(tree.vectors, longest)
    for node in range(len(tree.centre)):
        members = points[tree.first[node]:tree.stop[node]]
        assert (np.linalg.norm(members - points[tree.centre[node]], axis=1) <= tree.radius[node] + 1e-6).all()
        if tree.last[node]:
            below = range(tree.down[node], tree.last[node])
            assert tree.first[below[0]] == tree.first[node] and tree.stop[below[-1]] == tree.stop[node]
            assert tree.radius[list(below)].max() <= tree.radius[node] * 2
    assert sorted(tree.ids) == sorted(ids)
    search = hard.Search(tree, longest)
    search.attend(vectors[:1])
    low, high = np.array([hard._BELOW]), np.array([hard._ABOVE])
    best = search.best(0, 0, int(labels[0]), True, low, high, 5)[0]
    exact = sorted((-int(vectors[0] @ v), i) for i, l, v in zip(ids, labels, vectors) if l == labels[0] and i)
    assert best == [(-s, i) for s, i in exact[:5]]
    assert sum(scores.shape[1] for scores, _ in search._seen.values()) < len(rows) / 4


def test_blocks_that_cannot_hold_an_answer_get_no_party(spark, monkeypatch):
    """Anchors of one far cluster ask in few blocks, and what they find is whole."""
    rows = [(i, i % 3, [1000 + i % 7, i % 5, 0]) for i in range(300)]
    rows += [(1001 + i, i % 3, [-1000 - i % 7, i % 11, 3]) for i in range(0, 900) if (1001 + i) % 100]
    sent, streamed = [], hard._streamed

    def counted(kept, parties, handler, out):
        if out.startswith("key"):
            sent.append((parties.select("target").distinct().count(), kept.count()))
        return streamed(kept, parties, handler, out)

    monkeypatch.setattr(hard, "_streamed", counted)
    assert mined(spark, rows, block_rows=100) == brute(rows)
    assert len(sent) == 3 and all(targets <= blocks / 2 for targets, blocks in sent)
