from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.check import compare, connect
from tillstream.llm import catalog, merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """All levels from the leaves up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][n:n + 16]) for n in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, i):
    found = []
    for level in levels[:-1]:
        run = level[i // 16 * 16:i // 16 * 16 + 16]
        found.append((i % 16, "".join(run[:i % 16] + run[i % 16 + 1:])))
        i //= 16
    return found


@pytest.mark.parametrize("levels, leaves", [(1, 1), (2, 1), (2, 16), (3, 17), (4, 1), (4, 16 ** 3), (4, 4095),
                                            (4, 257), (5, 4097), (6, 70_000)])
def test_layout_has_one_place_for_every_node(levels, leaves):
    places = np.concatenate([merkle.address(levels, leaves, level, np.arange(-(-leaves // 16 ** level)))
                             for level in range(levels)])
    assert sorted(places) == list(range(merkle.size(levels, leaves)))


def test_layout_halves_the_height():
    """Four levels: the upper two first, then the lower two, subtree by subtree."""
    leaves = 16 ** 3
    assert merkle.address(4, leaves, 3, np.arange(1)) == [0]
    assert merkle.address(4, leaves, 2, np.arange(16)).tolist() == list(range(1, 17))
    assert merkle.address(4, leaves, 1, np.array([0, 1, 255])).tolist() == [17, 34, 17 + 255 * 17]
    assert merkle.address(4, leaves, 0, np.array([0, 15, 16])).tolist() == [18, 33, 35]


@pytest.mark.parametrize("leaves", [1, 2, 16, 17, 300])
def test_blocks_equal_a_plain_tree(leaves):
    nodes = [h(str(n)) for n in range(leaves)]
    plain = tree(nodes)
    raw = np.frombuffer(bytes.fromhex("".join(nodes)), np.uint8).reshape(-1, 32)
    store = merkle.build(raw, len(plain))
    near = merkle.siblings(store, len(plain), leaves)
    for i in range(leaves):
        assert [near[k][i // 16 ** k] for k in range(len(plain) - 1)] == path(plain, i)


def expected(rows):
    """(id, group, leaf) to (subroot, root, path)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for group in order:
        groups[group].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[group] = tree([r[2] for r in groups[group]])
    top = tree([trees[g][-1][0] for g in order])
    found = []
    for n, group in enumerate(order):
        for i, row in enumerate(groups[group]):
            found.append((*row, trees[group][-1][0], top[-1][0],
                          tuple(path(trees[group], i) + path(top, n))))
    return found


def key(row):
    return tuple(str(c) for c in row)


@pytest.mark.parametrize("height", [1, 2, 3])
def test_rounds_over_block_roots(spark, height):
    """Groups of one to many blocks, a null group, repeated and null ids, equal rows; and copies of
    one row make a third of everything."""
    rows = [(i, "big", h(f"big{i}")) for i in range(700)]
    rows += [(i, f"g{g}", h(f"{g}-{i}")) for g in range(20) for i in range(g)]
    rows += [(None, "ids", h(f"null{i}")) for i in range(3)] + [(5, "ids", h("five"))] * 2
    rows += [(1, None, h("none")), (2, "", h("empty")), (3, "ä", h("umlaut")), (4, "Z", h("z"))]
    rows += [(9, "copies", h("copy"))] * 450
    table = spark.createDataFrame(rows, "id long, grp string, leaf string").repartition(7)
    proved = merkle.prove(merkle.manifest(table, "grp", "id", "leaf", height))
    got = [(r["row"]["id"], r["row"]["grp"], r["leaf"], r["subroot"], r["root"],
            tuple((s["place"], s["others"]) for s in r["path"])) for r in proved.collect()]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)
    assert {(r["grp"], r["rows"]) for r in merkle.manifest(table, "grp", "id", "leaf", height).subroots.collect()} \
        >= {("sbig", 700), ("", 1), ("s", 1), ("scopies", 450)}


def test_folds_tell_tampered_rows(spark):
    rows = [(i, "s", h(str(i))) for i in range(40)]
    proved = merkle.prove(merkle.manifest(spark.createDataFrame(rows, "id long, s string, leaf string"),
                                          "s", "id", "leaf"))
    own, other = merkle.fold(F.col("path"), F.col("leaf")), merkle.fold(F.col("path"), F.lit(h("x")))
    for r in proved.select("root", own.alias("own"), other.alias("other")).collect():
        assert r["own"] == r["root"] != r["other"]


@pytest.mark.parametrize("rows", [[], [(1, "s", h("a"))]])
def test_nothing_and_a_lone_leaf(spark, rows):
    table = spark.createDataFrame(rows, "id long, s string, leaf string")
    got = merkle.prove(merkle.manifest(table, "s", "id", "leaf")).collect()
    assert [(r["leaf"], r["subroot"], r["root"], r["path"]) for r in got] == [(h("a"), h("a"), h("a"), [])][:len(rows)]


def test_query_on_edge_rows_equals_its_sql(spark, make_docs, edge_rows, tmp_path):
    rows = [(*r, lang, source) for r in edge_rows for lang, source in (("en", "a"), (None, None))]
    make_docs(rows).drop("id").write.parquet(str(tmp_path / "documents.parquet"))
    import duckdb
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    name = "op12_merkle_manifest"
    assert compare(spark, con, catalog.QUERIES[name], catalog.SQL[name], str(tmp_path)) is None


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_hard_negatives"])
def test_query_equals_its_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), catalog.QUERIES[name], catalog.SQL[name], sf_dir) is None
