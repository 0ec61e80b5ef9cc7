"""Ranked search, nearest neighbours and whitening against brute force, on awkward rows and through the registered queries."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxseries.llm import crosspolytope, maxscore, queries, whitening

DOCS = "doc_id long, text string, score long, item_id string, rank string, id string"
VECTORS = "vec_id long, embedding array<double>, rank string, cls string, x int, whitened string"


def ranked(docs, items, k):
    """The k best documents of each item, by the formula alone."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    found = [(i, Counter(cut(t))) for i, t in docs]
    n_docs, size = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in found:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // max(size, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(cut(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return Counter(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "日本", "A1", "it's", "x_y"]
    body = [" ".join(rng.choice(words[: rng.randrange(5, 65)]) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    docs = list(enumerate(body)) + [(900, None), (901, ""), (902, " .,!"), (None, body[4]), (7, body[4]), (7, body[4]), (7, body[4]),
                                    (903, " ".join(words) * 3000), (904, "é" * 70000)]
    items = [(i, " ".join(rng.sample(words, rng.randrange(1, 25)))) for i in range(12)]
    return docs, items + [(50, None), (51, ""), (None, body[4]), (0, body[5]), (52, "nowhere"), (53, body[4] + " nowhere")]


def test_ranked_search(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(maxscore, "BLOCK", 16)
    table = spark.createDataFrame([(i, t, 5, "i", "r", "x") for i, t in docs], DOCS)
    asked = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id int")
    got = maxscore.rank(table, asked, 10).collect()
    assert Counter(tuple(r) for r in got) == ranked(docs, items, 10)
    monkeypatch.setattr(maxscore, "ASKED", 300)  # several rounds
    assert Counter(tuple(r) for r in maxscore.rank(table, asked, 3).collect()) == ranked(docs, items, 3)
    assert maxscore.rank(table.limit(0), asked, 10).count() == 0
    assert maxscore.rank(table, asked.limit(0), 10).count() == 0


def test_pair_bounds_pass_over_documents(corpus):
    """What the search opens reaches the floor, and pair bounds open fewer documents than single maxima would."""
    rng = np.random.default_rng(3)
    lists = {t: np.sort(rng.choice(400, 60, replace=False)).astype(np.int32) for t in range(8)}
    ends = np.cumsum([0] + [60] * 8)
    docs, impacts = np.concatenate(list(lists.values())), rng.integers(1, 1000, 480)
    block = maxscore.Block(400, {t: (ends[t], ends[t + 1]) for t in range(8)}, docs, impacts)
    query = [(0, 1), (2, 3), (4, 5), (6, 7)]
    joint = {p: block.both(*p) for p in query}
    total = np.zeros(400, np.int64)
    np.add.at(total, docs, impacts)
    for k in (1, 10, 100):
        floor = int(np.sort(total)[-k])
        d, s = maxscore.search(block, joint, query, floor)
        assert dict(zip(d, s)) == {i: v for i, v in enumerate(total) if v >= floor}
    single = sum(block.most(t) for t in range(8))
    paired = sum(max(block.most(a), block.most(b), joint[a, b][1]) for a, b in query)
    assert total.max() <= paired < single
    assert not len(maxscore.search(block, joint, query, paired + 1)[0])


def test_registered_ranked_search(spark, scratch):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{scratch}/{t}.parquet")
    docs = [tuple(r) for r in spark.read.parquet(f"{scratch}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{scratch}/benchmark.parquet").select("item_id", "text").collect()]
    got = queries.op11_ranked_search(spark, scratch)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == ranked(docs, items, 10)


def near(rows, is_query, k):
    """Exact answers: (query, rank, id, score), each id's queries once."""
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
            and np.all(np.isfinite(np.array(v, float))) and any(v)]
    asks = {}
    for i, v in rows:
        if is_query(i) and (i not in asks or list(v) < list(asks[i])):
            asks[i] = v
    out = []
    for q, v in asks.items():
        best = sorted((-float((v * w).sum()), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def odd_vectors():
    rng = np.random.default_rng(2)
    v = rng.integers(-4, 5, (300, 12)).astype(float).tolist()
    rows = [(i, x) for i, x in enumerate(v)]
    rows += [(400 + i, v[3]) for i in range(60)] + [(20, v[3]), (20, v[3]), (40, v[8])]
    rows += [(500, None), (501, []), (502, [0.0] * 12), (503, [float("nan")] * 12), (504, [1.0] * 11 + [None]), (None, v[1]),
             (505, [float("inf")] + [1.0] * 11), (520, [1e200] * 12), (540, [1e-200] * 12), (560, [1.0, 2.0]), (561, [2.0, 1.0])]
    return rows


def test_nearest(spark):
    rows = odd_vectors()
    table = spark.createDataFrame([(i, v, "r", "c", 1, "w") for i, v in rows], VECTORS)
    got = [tuple(r) for r in crosspolytope.nearest(table, F.col("vec_id") % 20 == 0, k=5, bucket=16).collect()]
    want = near(rows, lambda i: i % 20 == 0, 5)
    assert len(got) == len(want)
    exact = defaultdict(set)
    for i, v in rows:
        if i is not None and v and len(v) == 12 and None not in v and np.all(np.isfinite(v)):
            exact[i].add(tuple(v))
    hits = Counter(got) & Counter(want)
    assert sum(hits.values()) >= 0.9 * len(want)
    for q, r, i, s in got:
        assert i != q and 1 <= r <= 5
        if i in exact and q in exact:
            assert any(s == float((np.array(a) * np.array(b)).sum()) for a in exact[q] for b in exact[i])
    assert crosspolytope.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_few_candidates_are_searched_exactly(spark):
    """One probe of many buckets meets too few rows: such queries are compared with all."""
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((200, 8)).tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = crosspolytope.nearest(table, F.col("vec_id") % 20 == 0, k=150, tables=1, probes=1, bucket=2).collect()
    want = near(rows, lambda i: i % 20 == 0, 150)
    assert [r[:3] for r in sorted(tuple(x) for x in got)] == [r[:3] for r in sorted(want)]
    tiny = crosspolytope.nearest(table.filter("vec_id < 3"), F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted(r["vec_id"] for r in tiny) == [1, 2]


def test_pseudo_rotation_and_deeper_buckets():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((50, 16))
    assert np.allclose(np.linalg.norm(crosspolytope.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    tables = crosspolytope.Tables(10, 1 << 14, 3, 16, 5)  # more bits than one turn gives
    assert tables.bits == 10 and len(tables.axes) == 2
    v = rng.standard_normal((40, 10))
    own, ranked_ = tables.buckets(v), tables.ranked(v, 30)
    assert own.max() < 3 << 10 and all(set(own[i]) <= set(ranked_[i]) for i in range(40))


def test_registered_nearest_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    got = queries.op12_nearest(spark, sf).collect()
    at = {i: n for n, i in enumerate(ids.tolist())}
    hit = 0
    for q in ids[ids % 20 == 0].tolist():
        scores = x @ x[at[q]]
        scores[at[q]] = -np.inf
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert all(abs(r["score"] - scores[at[r["vec_id"]]]) < 1e-12 for r in mine)
        assert all(a["score"] >= b["score"] for a, b in zip(mine, mine[1:]))
        hit += len({r["vec_id"] for r in mine} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hit >= 0.9 * len(got)


def check_whitened(rows, got, k, dim):
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for _, v in rows], object)
    n = len(x)
    off = x * n - x.sum(axis=0)
    a = (off / n).astype(float)
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    cells = defaultdict(list)
    for r in got:
        cells[r["vec_id"], r["deviation"]].append(r)
        assert abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-8 and r["identity_error"] < 1e-8
    assert set(cells) == {(i, int((o ** 2).sum())) for (i, _), o in zip(rows, off)}
    y = np.array([[next(r["whitened"] for r in cells[i, int((o ** 2).sum())] if r["component"] == c + 1) for c in range(k)]
                  for (i, _), o in zip(rows, off)])
    want = a @ vectors[:, :k] / np.sqrt(values[:k])
    signs = np.sign((y * want).sum(axis=0))
    assert np.abs(y * signs - want).max() < 1e-6
    assert np.abs(np.cov(y.T, bias=True) - np.eye(k)).max() < 1e-8


def test_whitening(spark):
    rng = np.random.default_rng(4)
    v = (rng.standard_normal((90, 6)) * [5, 3, 2, 1, 1, 0.5]).tolist()
    rows = [(i, x) for i, x in enumerate(v)] + [(3, v[3]), (3, v[4]), (None, v[5])]
    bad = [(200, None), (201, []), (202, [float("nan")] * 6), (203, [1.0] * 5 + [None]), (204, [float("inf")] * 6), (205, [1e300] * 6),
           (300, [1.0, 2.0]), (301, [2.0, 7.0]), (302, [5.0])]
    table = spark.createDataFrame([(i, x, "r", "c", 1, "w") for i, x in rows + bad], VECTORS)
    got = whitening.whiten(table, 4).collect()
    check_whitened(rows, [r for r in got if r["n"] == len(rows)], 4, 6)
    # Two vectors have one direction, a single one has none.
    assert {(r["vec_id"], r["component"], r["n"]) for r in got if r["n"] != len(rows)} == {(300, 1, 2), (301, 1, 2)}
    assert whitening.whiten(table.limit(0), 4).count() == 0
    assert whitening.whiten(table.filter("vec_id = 7"), 4).count() == 0


def test_bidiagonalisation_with_equal_values_and_missing_directions():
    """A single start vector sees one direction of each value: others follow it."""
    rng = np.random.default_rng(6)
    q = np.linalg.qr(rng.standard_normal((40, 8)))[0]
    a = q[:, :5] * [3.0, 3.0, 3.0, 1.0, 1.0] @ np.linalg.qr(rng.standard_normal((8, 8)))[0][:5]

    class Held:
        dim = 8

        def sum(self, of):
            return sum(of(part).ravel() for part in np.array_split(a, 3))

    vectors, values = whitening.bidiagonalise(Held(), 8)
    assert np.allclose(values, [3, 3, 3, 1, 1]) and np.allclose(vectors @ vectors.T, np.eye(5))
    assert np.allclose(a.T @ a @ vectors.T, vectors.T * values ** 2)


def test_large_whole_numbers_stay_exact():
    x = np.array([[1 << 51, 5], [-(1 << 51), 6]], np.int64)
    off = whitening._offsets(x, 5000, [7, 11])
    assert off.tolist() == [[(1 << 51) * 5000 - 7, 25000 - 11], [-(1 << 51) * 5000 - 7, 30000 - 11]]
    assert whitening._deviation(off) == [None, None]
    assert whitening._deviation(np.array([[3, 4]], object)) == [25]


def test_registered_whitening(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op13_whitening(spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened(rows, got.collect(), 32, 64)
