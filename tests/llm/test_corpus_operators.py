"""Decontamination, near-duplicates and shards against brute force."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillstream.llm import components, decontaminate, sharding, simhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def plain_contamination(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[s:s + 13]), set()).add(str(item))
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for s in range(len(w) - size + 1):
                names = windows.get(tuple(w[s:s + size]))
                if names:
                    hit |= set(range(s, s + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield (doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))


def by_id(row):
    return row[0] is None, row[0] or 0, row[1:]


@pytest.fixture(scope="module")
def bench(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    items = [(1, passage), (2, "Tiny ITEM here"), (10, passage + " more"), (3, None), (4, "..."),
             (5, "the the the the the the the the the the the the the the"), (6, "ﬁne ÄÖ straße 42")]
    return items, spark.createDataFrame([(*i, "x") for i in items],
                                        "item_id long, text string, id string")


@pytest.fixture(scope="module")
def suspects(edge_rows):
    some = " ".join(f"w{i}" for i in range(5, 22))
    return edge_rows + [
        (20, f"before {some} after"), (21, " ".join(f"W{i}," for i in range(12))),
        (22, "a tiny item here, a TINY-item/here."), (23, "the " * 40), (24, "filler " * 400 + some),
        (25, f"{some} {some}"), (26, "ﬁne ÄÖ straße 42"), (27, "ﬁne äö straße 42"),
        (28, "tiny item"), (29, "here tiny item")]


def test_contamination_equals_brute_force(make_docs, bench, suspects):
    items, table = bench
    docs = make_docs(suspects)
    wanted = sorted(plain_contamination(suspects, items), key=by_id)
    assert any(w[5] for w in wanted) and any(w[2] and not w[5] for w in wanted)
    got = decontaminate.contamination(decontaminate.matches(docs, table))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=by_id) == wanted


@pytest.mark.parametrize("most_terms, indices", [(1 << 21, 1), (3, 2)])
def test_several_passes_give_the_same(make_docs, bench, suspects, monkeypatch, most_terms, indices):
    monkeypatch.setattr(decontaminate, "MOST_TERMS", most_terms)
    built, build = [], decontaminate.build_index
    monkeypatch.setattr(decontaminate, "build_index", lambda *a: built.append(1) or build(*a))
    items, table = bench
    unique = {r[0]: r for r in suspects if r[0] is not None}
    got = decontaminate.contamination(
        decontaminate.matches(make_docs(list(unique.values())), table, slice_words=20))
    wanted = sorted(plain_contamination(unique.values(), items), key=by_id)
    assert sorted(map(tuple, got.collect()), key=by_id) == wanted
    assert min(len(built), 2) == indices


@pytest.mark.parametrize("equal_rows", [2, 4096])
def test_several_passes_keep_every_row(make_docs, bench, suspects, monkeypatch, equal_rows):
    monkeypatch.setattr(decontaminate, "EQUAL_ROWS", equal_rows)
    items, table = bench
    passage = " ".join(f"w{i}" for i in range(30))
    rows = suspects + [(20, passage), (20, "other " * 900), (20, None), (None, passage),
                       (None, "tiny item here"), *[(None, passage)] * 3, *[(24, suspects[-6][1])] * 4]
    got = decontaminate.contamination(decontaminate.matches(make_docs(rows), table, slice_words=20))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    wanted = sorted(plain_contamination(rows, items), key=by_id)
    assert sorted(map(tuple, got.collect()), key=by_id) == wanted
    kept = decontaminate.drop_contaminated(make_docs(rows), table, slice_words=20)
    assert kept.count() == sum(not w[5] for w in wanted)


def test_contamination_of_nothing(make_docs, bench, suspects):
    _, table = bench
    none = decontaminate.contamination(decontaminate.matches(make_docs(suspects), table.limit(0)))
    assert {(r.n_hit, r.contaminated) for r in none.collect()} == {(0, False)}
    assert decontaminate.matches(make_docs([]), table).count() == 0


def test_drop_contaminated_keeps_columns(make_docs, bench, suspects):
    items, table = bench
    docs = make_docs(suspects)
    kept = decontaminate.drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    wanted = [w[0] for w in plain_contamination(suspects, items) if not w[5]]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, wanted))


def test_proximity_is_order_free(spark, make_docs, tmp_path):
    items = [("near", "alpha beta gamma"), ("absent", "alpha omega")]
    texts = ["gamma x alpha x beta", "alpha x x x x x x beta gamma", "beta alpha gamma",
             "alpha beta", "beta beta gamma x x x x gamma alpha beta", "alpha"]
    table = spark.createDataFrame(items, "item_id string, text string")
    phrases = next(decontaminate.phrases_of(table, "item_id", "text", 13, 1000))
    docs = make_docs(list(enumerate(texts)))
    index = decontaminate.build_index(docs, phrases.vocabulary, str(tmp_path / "index"))
    frequency = decontaminate.document_frequencies(index, len(phrases.vocabulary))
    assert frequency.sum() == sum(w in words(" ".join(i[1] for i in items))
                                  for t in texts for w in words(t))
    for within in (3, 5, 9):
        got = {tuple(r) for r in decontaminate.proximity_matches(index, phrases, frequency,
                                                                 within).collect()}
        wanted = {(d, name) for d, t in enumerate(texts) for name, q in items
                  if any(set(words(q)) <= set(words(t)[s:s + within]) for s in range(len(words(t))))}
        assert got == wanted
    with pytest.raises(ValueError):
        decontaminate.proximity_matches(index, phrases, frequency, 50)


NEAR = [sum(1 << b for b in bits) for n in (1, 2, 3) for bits in combinations(range(16), n)]


def plain_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_near_duplicates_equal_brute_force(make_docs, edge_rows):
    base = " ".join(f"token{i % 37}x{i}" for i in range(150))
    rows = edge_rows + [(100 + i, base.replace(f"x{i} ", f"y{i} ", i % 4)) for i in range(40)]
    rows += [(200 + i, base.upper()) for i in range(5)] + [(300, "one two"), (301, "ONE\ttwo")]
    got = simhash.near_duplicates(make_docs(rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    prints = [plain_print(t) for _, t in rows]
    groups = plain_groups(prints)
    least = {}
    for (doc_id, _), g in zip(rows, groups):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    wanted = [(r[0], f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, groups)]
    assert sorted(map(tuple, got.collect()), key=by_id) == sorted(wanted, key=by_id)
    assert simhash.near_duplicates(make_docs([])).count() == 0


@pytest.mark.parametrize("cell", [4, 1024])
def test_links_connect_what_pairs_connect(spark, monkeypatch, cell):
    """Many fingerprints a few bits apart, with drawers cut into parts and not."""
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.int64).view(np.uint64)
    prints = {int(c) for c in centres}
    for c in centres[:4].tolist():
        for _ in range(60):
            flips = rng.choice(64, rng.integers(1, 7), replace=False)
            prints.add(int(c) ^ sum(1 << int(f) for f in flips))
    prints = sorted(prints)
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    links = simhash.close_links(table).collect()
    number = {p: i for i, p in enumerate(prints)}
    for a, b in links:
        assert ((a ^ b) & (2**64 - 1)) != 0
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(number[a % (1 << 64)])] = find(number[b % (1 << 64)])
    ours, true = [find(i) for i in range(len(prints))], plain_groups(prints)
    assert len(set(zip(ours, true))) == len(set(true)) == len(set(ours))


@pytest.mark.parametrize("part", [1, 7, 64])
def test_long_texts_are_read_in_parts(monkeypatch, part):
    monkeypatch.setattr(simhash, "_PART", part)
    rng = np.random.default_rng(part)
    for size in (0, 1, 2, 3, 4, 40):
        words = ["".join(rng.choice(list("aB\u00e9\u00a0"), rng.integers(1, 30))) for _ in range(size)]
        text = "\t " + "".join(w + rng.choice([" ", "\n", " \x0b "]) for w in words)
        assert simhash.fingerprint(text) == simhash.fingerprint(text.strip(" ")) == plain_print(text)


def test_crowded_drawers_are_filed_again(spark, monkeypatch):
    """Many fingerprints that agree on 48 bits: each is copied within the bound, and all meet."""
    monkeypatch.setattr(simhash, "CELL", 16)
    made, cells = [], simhash._cells
    monkeypatch.setattr(simhash, "_cells", lambda shared: made.append(cells(shared)) or made[-1])
    prints = np.random.default_rng(4).choice(1 << 16, 3_000, replace=False).tolist()
    links = simhash.close_links(spark.createDataFrame([(p,) for p in prints], "print long")).collect()
    assert len(made) == 2
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    known, true = set(prints), {}
    for start in prints:  # flood over up to three flipped bits, straight from the definition
        todo = [] if start in true else [start]
        while todo:
            p = todo.pop()
            if p in true:
                continue
            true[p] = start
            todo += [q for q in (p ^ m for m in NEAR) if q in known and q not in true]
    assert len({(find(p), true[p]) for p in prints}) == len(set(true.values())) == len(
        {find(p) for p in prints})


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)]
    edges += [(5000, 5000), (7001, 7002), (7002, 7001), (7003, 7001), (300, 1000)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(6)
    got = {r.node: r.least for r in components.components(table, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{i: 0 for i in range(1000, 1400)},
                   7002: 7001, 7003: 7001}
    assert components.components(table.limit(0), "a", "b").count() == 0


def test_keep_one_of_each_group(make_docs, edge_rows):
    rows = edge_rows + [(40, "some words that are new"), (41, "SOME words that are new")]
    docs = make_docs(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # 1, 2, 3 and a null text have fingerprint zero; 7 and both 8s are copies; 40 and 41 too.
    assert ids == [(False, i) for i in (1, 4, 5, 6, 7, 9, 10, 40)] + [(True, 0)]
    twice = simhash.keep_one(make_docs([(8, "alike"), (8, "alike"), (9, "alike")]))
    assert [r.doc_id for r in twice.collect()] == [8]
    assert simhash.keep_one(make_docs([])).count() == 0


def test_hilbert_curve_visits_neighbours(spark):
    bits = 3
    grid = spark.range(1 << 3 * bits).select(*[
        F.shiftright("id", bits * i).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias(f"x{i}")
        for i in range(3)])
    place = sharding.hilbert_index([F.col(f"x{i}") for i in range(3)], bits)
    path = [r[:3] for r in sorted(grid.withColumn("h", place).collect(), key=lambda r: r.h)]
    assert len(set(path)) == 512 and {r.h for r in grid.withColumn("h", place).collect()} == set(
        range(512))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


@pytest.mark.parametrize("equal_rows", [7, 4096])
def test_shards_are_even_and_gapless(make_docs, edge_rows, monkeypatch, equal_rows):
    monkeypatch.setattr(sharding, "EQUAL_ROWS", equal_rows)
    rows = edge_rows + [(100 + i, "t" * (i % 50), "de" if i % 3 else "en", f"s{i % 7}")
                        for i in range(500)] + [(700, "hot")] * 300 + [(None, None)] * 40
    got = sharding.assign(make_docs(rows)).collect()
    texts = [(r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(texts)
    # A plain sort and cut: along all shards the curve ascends, and a row's place tells its shard.
    along = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.shard for r in along] == [i * 24 // len(rows) for i in range(len(rows))]
    assert all(a.curve <= b.curve for a, b in zip(along, along[1:]))
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    sizes = [len(s) for s in shards.values()]
    assert set(shards) == set(range(24)) and max(sizes) - min(sizes) <= 1
    for held in shards.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
        in_order = sorted(held, key=lambda r: r.slot)
        assert all(a.curve <= b.curve for a, b in zip(in_order, in_order[1:]))
    assert max(r.curve for r in shards[3]) <= min(r.curve for r in shards[4])
    wanted = sorted((d is None, d or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
                    for d, t, *_ in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == wanted
    assert sharding.assign(make_docs([])).count() == 0


def test_written_shards_are_pruned(spark, make_docs, tmp_path):
    rows = [(i, "t" * (1 << i % 8), ("de", "en", "fr", "es")[i % 4], f"s{i % 5}")
            for i in range(2000)] + [(5, None)] * 3
    docs = make_docs(rows)
    column = sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert column == "_shard" and back.count() == len(rows)  # the documents have a "shard"
    assert sorted(back.columns) == sorted([*docs.columns, column])
    touched = back.where("lang = 'de' AND n_chars = 128").select(column).distinct().count()
    assert touched <= 8  # of 24


def test_sharding_runs_no_python(spark, make_docs, edge_rows):
    plan = sharding.assign(make_docs(edge_rows))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExternalRDD", plan.replace("ExistingRDD", ""))
