"""Learned operators: held-out quality, exact searches, and edge rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstream.llm import catalog, language, toxicity, url_rules, vectors


def crc(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def filler(rng, n=40):
    return " ".join(rng.choice(["the", "of", "river", "stone", "cloud", "paper", "green"], n))


@pytest.fixture(scope="module")
def toxic_case(spark, make_docs, edge_rows):
    rng = np.random.default_rng(1)
    rows, marks = list(edge_rows), []
    for i in range(1000, 2200):
        bad = i % 9 == 0
        text = filler(rng) + (" you vile" + rng.choice(["toad", "toadish", "toadling"]) if bad else "")
        rows.append((i, text))
        if i % 2:
            marks.append((i, int(bad), "x"))
    marks += [(None, 1, "x"), (1001, None, "x"), (1009, 0, "x"), (1009, 0, "x"), (99999, 1, "x")]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, text string")
    return make_docs(rows), labels, rows


def test_toxicity_finds_held_out_texts(toxic_case):
    docs, labels, rows = toxic_case
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
        if r.doc_id and r.doc_id >= 1000:
            assert r.predicted == int(r.doc_id % 9 == 0)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.schema == docs.schema
    assert kept.count() == sum(1 - r.predicted for r in found)


def test_labels_of_held_out_rows_are_not_learnt(spark, toxic_case):
    docs, labels, _ = toxic_case
    held = toxicity.held_out("doc_id")
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert (one.hashes == two.hashes).all() and np.allclose(one.weights, two.weights)


def test_toxicity_without_examples(make_docs, toxic_case, edge_rows):
    docs, labels, _ = toxic_case
    clean = toxicity.score(docs, toxicity.fit(docs, labels.where("toxic = 0"))).collect()
    assert {(r.score, r.predicted) for r in clean} == {(0.0, 0)}
    model = toxicity.fit(make_docs([]), labels)
    assert toxicity.score(make_docs([]), model).count() == 0
    assert len({r.score for r in toxicity.score(make_docs(edge_rows), model).collect()}) == 1


def test_nnpu_separates_with_the_prior_only():
    """Positives and unlabelled rows, no negatives: clean unlabelled rows end below one half."""
    rng = np.random.default_rng(2)
    hidden = rng.random(4000) < 0.2  # which of U are toxic
    positive = np.r_[np.ones(500, bool), np.zeros(4000, bool)]
    marked = np.flatnonzero(np.r_[np.ones(500, bool), hidden])
    noise = np.flatnonzero(rng.random(4500) < 0.3)
    feature = np.r_[np.zeros(len(marked), int), np.ones(len(noise), int)]
    weights, intercept = toxicity.fit_nnpu(feature, np.r_[marked, noise], positive, 2, 0.2)
    assert weights[0] + intercept > 1 and intercept < -1 and abs(weights[1]) < 1


def test_language_on_held_out_texts(make_docs, edge_rows):
    rng = np.random.default_rng(4)
    syllables = {"aa": ["la", "mi", "ro", "vi"], "bb": ["sch", "ung", "ein", "ät"],
                 "cc": ["the", "ing", "wh", "ou"], "ру": ["при", "вет", "ска", "ось"]}
    rows = [(d, t, "cc") for d, t in edge_rows]
    for i in range(600):
        lang = sorted(syllables)[i % 4]
        rows.append((1000 + i, " ".join("".join(rng.choice(syllables[lang], 3)) for _ in range(20)),
                     lang))
    rows += [(2000, "unlabelled lami", None), (2001, "12 34 !?", "aa")]
    docs = make_docs(rows)
    got = language.predict(docs, *language.fit(docs))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1
        if r.doc_id and 1000 <= r.doc_id < 1600:
            assert r.lang_pred == sorted(syllables)[(r.doc_id - 1000) % 4]
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3, 2001))


def test_language_profiles_are_exact_bundles():
    """A text's bundle is the sum over its n-grams of the permuted, multiplied letter vectors."""
    text = "Ab, c"
    slots = [int(s) for s in language._slot_table()[[ord(c) for c in "abc"]]]
    a, b, c = slots
    path = [0, a, b, 0, c, 0]
    letters = language._letters().astype(int)
    total = np.zeros(language.SIZE, int)
    for x, y, z in zip(path, path[1:], path[2:]):
        total += np.roll(letters[x], 2) * np.roll(letters[y], 1) * letters[z]
    got, has = language.bundles([text, "", "123", text.upper()])
    assert has.tolist() == [True, False, False, True]
    assert np.allclose(got[0], total / np.linalg.norm(total), atol=1e-6)
    assert not got[1].any() and not got[2].any() and np.allclose(got[0], got[3])


def test_language_of_empty_tables(make_docs, edge_rows):
    languages, prototypes = language.fit(make_docs([]))
    assert languages == []
    got = language.predict(make_docs(edge_rows), languages, prototypes).collect()
    assert {r.lang_pred for r in got} == {"und"} and len(got) == len(edge_rows)


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(7)
    data = rng.normal(size=(700, 24)) + 3 * rng.normal(size=(10, 24))[rng.integers(0, 10, 700)]
    rows = [(i, [float(x) for x in v], "x", "x") for i, v in enumerate(data)]
    rows += [(1000 + i, rows[40][1], "x", "x") for i in range(60)]  # copies: ties by id
    rows += [(2000, None, "x", "x"), (2020, [0.0] * 24, "x", "x"), (2040, [float("nan")] * 24, "x", "x"),
             (2060, [1.0] * 23 + [None], "x", "x"), (2080, [1.0], "x", "x"), (None, rows[1][1], "x", "x"),
             (2100, [float("inf")] + [1.0] * 23, "x", "x"), (20, rows[20][1], "x", "x")]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, "
                                             "score string")


def plain_nearest(rows, count=20):
    kept = [(i, np.array(v)) for i, v, *_ in rows if i is not None and v is not None
            and len(v) == 24 and None not in v and np.isfinite(v).all() and any(v)]
    for q in sorted({i for i, _ in kept if i % 20 == 0}):
        own = next(v for i, v in kept if i == q)
        others = sorted((-(v * own).sum(), i) for i, v in kept if i != q)
        yield q, others[:count]


def test_search_of_full_radius_is_exact(monkeypatch, cloud):
    rows, table = cloud
    fit = vectors.fit

    def wide(*args):
        coder = fit(*args)
        coder.radius = vectors.BITS
        return coder

    monkeypatch.setattr(vectors, "fit", wide)
    got = {}
    for r in vectors.nearest(table, block_rows=200, query_rows=16).collect():
        got.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    wanted = dict(plain_nearest(rows))
    assert set(got) == set(wanted)
    for q, found in got.items():
        assert [(s, i) for _, s, i in sorted(found)] == wanted[q]


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(8)
    codes = rng.integers(0, 1 << 63, 500, dtype=np.int64).view(np.uint64)
    codes = np.concatenate([codes, codes[:50] ^ np.uint64(0x8000400020001007)])
    index = vectors.Index(codes)
    for radius in (0, 1, 2, 3, 5, 8, 20, 27, 64):
        for code in codes[:40]:
            wanted = np.flatnonzero(np.bitwise_count(codes ^ code) <= radius)
            assert index.within(code, radius).tolist() == wanted.tolist()


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    data = table.toPandas()
    every, ids = np.array(data["embedding"].tolist(), np.float64), data["vec_id"].to_numpy()
    found = vectors.nearest(table).toPandas().groupby("query_id")["vec_id"].agg(set)
    hits = total = 0
    for q, got in found.items():
        scores = every @ every[ids == q][0]
        scores[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]])
        hits, total = hits + len(best & got), total + len(best)
    assert len(found) == sum(ids % 20 == 0) and hits / total >= 0.95


def test_search_of_small_tables(spark, cloud):
    _, table = cloud
    assert vectors.nearest(table.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (20, [2.0, 1.0]), (3, [1.0, 1.0])],
                                "vec_id long, embedding array<float>")
    got = [tuple(r) for r in vectors.nearest(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 4.0), (0, 2, 3, 3.0), (20, 1, 0, 4.0), (20, 2, 3, 3.0)]
    assert vectors.nearest(few.where("vec_id = 0")).count() == 0


def plain_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
    fit = [(len(h + p), h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fit)[1:] if fit else (None, None))


@pytest.fixture(scope="module")
def pages(spark):
    urls = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?q=1#f",
            "http://a.b.net/es/", "http://net/fr/x", "http://xnet/fr/", "http://example.com?x",
            "http://example.com/EN/", "http://Ünï.example.com/en/ä", "a://b://c.net/es/",
            "http://user@x.com:80/p#://", "http://x.org/en/\n/y", "http://x.org/en/\n/y"]
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(None, "http://x.com/", "h")]
    for i in range(100, 1300):
        bad = i % 6 == 0
        rows.append((i, f"https://{'casino' if bad else 'news'}{i % 3}.site.org/"
                        f"{'win' if bad else 'read'}/{i}?ref={i}", "h"))
    return rows, spark.createDataFrame(rows, "page_id long, url string, host string")


def test_url_verdicts(spark, pages):
    rows, table = pages
    marks = [(i, int(i % 6 > 0)) for i in range(100, 800)] + [(None, 0), (101, None), (103, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = url_rules.judge(table, labels)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    wanted = []
    for i, url, _ in rows:
        host, path, rule, verdict = plain_rule(url)
        mined = "block" if i and i >= 100 and i % 6 == 0 else "allow"
        wanted.append((i, host, path, rule, verdict or mined))
    key = lambda r: (r[0] is None, r[0] or 0, tuple(map(str, r)))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)


def test_mined_rules_keep_support_confidence_and_brevity(spark):
    rows = [(["a", "b", "x"], True)] * 30 + [(["a", "x"], False)] * 60 + [(["b", "x"], False)] * 2
    rows += [(["x"], False)] * 100 + [(["rare"], True)] * 3 + [([], False)]
    table = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    rules = {tuple(r.antecedent): r for r in url_rules.mine(table).collect()}
    # a => 30/90 is too unsure, rare too rare, b => 30/32 holds, a+b => 30/30 is surer than b.
    assert set(rules) == {("b",), ("a", "b")}
    assert rules["b",].confidence == pytest.approx(30 / 32)
    assert rules["b",].support == pytest.approx(30 / 196)


def test_rules_may_need_many_tokens(spark):
    # a+b+c+d is sure as a whole only: each three of them hold in 30 of 70. x adds nothing; of p to s
    # each is sure alone.
    rows = [(["a", "b", "c", "d", "x"], True)] * 30 + [(list("pqrs"), True)] * 20
    rows += [([t for t in "abcdx" if t != out], False) for out in "abcd"] * 40
    rows += [(["x"], False)] * 300
    table = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    rules = url_rules.mine(table)
    assert {tuple(r.antecedent) for r in rules.collect()} == {("a", "b", "c", "d"), *zip("pqrs")}
    urls = spark.createDataFrame([("all", list("abcdz")), ("three", list("abcz"))],
                                 "url string, tokens array<string>")
    assert [r.url for r in url_rules.match(urls, rules).collect()] == ["all"]


def test_urls_without_labels(spark, pages):
    rows, table = pages
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = url_rules.judge(table, labels).collect()
    assert len(got) == len(rows)
    assert all(r.verdict == "allow" for r in got if r.rule is None)
    assert url_rules.judge(table.limit(0), labels).count() == 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_queries_cover_their_tables(spark, sf_dir, name):
    table = {"op4": "pages", "op6": None}.get(name.split("_")[0], "documents")
    rows = catalog.QUERIES[name](spark, sf_dir)
    if table:
        assert rows.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    else:
        assert rows.count() > 0


def test_samples_are_bounded_whatever_an_id_repeats(spark):
    """One id with most of the rows, drawn or not: samples stay near their bounds."""
    docs = spark.range(20_000).selectExpr("IF(id < 16000, 7, id) AS id", "concat('text ', id) AS text")
    labels = spark.createDataFrame([(7, 1), (16_001, 1), (16_002, 0), (16_003, 0)], "id long, toxic int")
    sample, prior = toxicity._sample(docs, labels, 400, 1_000)
    sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    assert sizes[True] <= 600 and sizes[False] <= 1_500 and 0 < prior < 1
    few = docs.where("id <> 7")
    sample, _ = toxicity._sample(few, labels, 400, 100_000)
    assert sample.where("NOT positive").count() == few.where(~toxicity.held_out("id")).count()


def test_gradient_of_the_risk_is_its_slope():
    """One step of the fit from a known point against finite differences of the plain risk."""
    rng = np.random.default_rng(4)
    rows, features = 60, 5
    dense = rng.random((rows, features)) < 0.4
    text, feature = np.nonzero(dense)
    positive, prior = np.arange(rows) < 25, 0.3

    def risk(theta):
        z = dense @ theta[:-1] + theta[-1]
        toxic = np.logaddexp(0, -z)
        clean = np.logaddexp(0, z)
        last = clean[~positive].mean() - prior * clean[positive].mean()
        return prior * toxic[positive].mean() + max(0, last)

    weights, intercept = toxicity.fit_nnpu(feature, text, positive, features, prior, rounds=2000, rate=0.02,
                                           decay=0)
    theta = np.append(weights, intercept)
    start = np.append(np.zeros(features), np.log(prior / (1 - prior)))
    assert risk(theta) < risk(start)
    for k in range(features + 1):  # no single weight can be moved to lower the risk by much
        for step in (-0.05, 0.05):
            moved = theta.copy()
            moved[k] += step
            assert risk(moved) > risk(theta) - 2e-3


def test_vectors_that_share_an_id_and_exact_radius(spark):
    """A third of the rows has one id; a given radius of all bits finds the exact neighbours."""
    rng = np.random.default_rng(6)
    points = rng.normal(size=(600, 8))
    rows = [(20 if i < 200 else i, points[i].tolist()) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vectors.nearest(table, neighbours=5, radius=vectors.BITS, block_rows=100, query_rows=10).collect()
    own = min(points[:200].tolist())
    for query in {r["query_id"] for r in got}:
        asked = np.array(own if query == 20 else points[query])
        scored = sorted((-float((points[i] * asked).sum()), rows[i][0]) for i in range(600) if rows[i][0] != query)
        found = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == query)
        assert [i for _, i in found] == [i for _, i in scored[:5]]
    assert {r["query_id"] for r in got} == {20, *range(200, 600, 20)}
