import dataclasses

import numpy as np
import pytest

from docmill.llm import similar

MODELS = "id long, name string, dimensions int"
ROWS = "id long, chunk_id long, model long, embedding array<float>, created_at timestamp, list int"
SMALL = similar.Settings(list_size=24, block=64, probe=1.6, probes=40, beam=48, rounds=16, least_probes=8)


def brute(vectors, k, at_least=-2.0):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = x @ x.T
    np.fill_diagonal(c, -9)
    out, number = {}, np.array(ids)
    for n, i in enumerate(ids):
        order = np.lexsort((number, -np.round(c[n], 5)))[:k]
        out[i] = [ids[j] for j in order if c[n, j] >= at_least and j != n]
    return out


def tables(spark, vectors, extra=(), chunks=None):
    rows = [(n, i, 1, [float(v) for v in x], None, 0) for n, (i, x) in enumerate(vectors.items(), 1)] + list(extra)
    ids = sorted(vectors) if chunks is None else chunks
    return (spark.createDataFrame(rows, ROWS).repartition(3), spark.createDataFrame([(1, "m", 16), (2, "n", 8)], MODELS), spark.createDataFrame([(i, "x") for i in ids], "id long, text string"))


def clusters(n=700, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(30, dim))
    return {int(i): (centre[rng.integers(30)] + 0.35 * rng.normal(size=dim)).astype(np.float32) for i in rng.choice(5000, n, replace=False) + 1}


def test_recall_and_mutual_pairs(spark):
    vectors = clusters()
    table = similar.usable_vectors(*tables(spark, vectors))
    want = brute(vectors, 10)
    got = {}
    for r in similar.most_similar(table, SMALL).collect():
        got.setdefault(r.chunk_id, set()).add(r.neighbour)
    recall = np.mean([len(got[i] & set(w)) / len(w) for i, w in want.items()])
    assert recall >= 0.97 and set(got) == set(vectors) and all(len(g) == 10 for g in got.values())
    asked = {r.chunk_id for r in similar.most_similar(table, SMALL, queries="chunk_id % 100 = 0").collect()}
    assert asked == {i for i in vectors if i % 100 == 0}
    high = brute(vectors, 10, 0.75)
    pairs = {(a, b) for a in high for b in high[a] if a < b and a in high[b]}
    found = {(r.a, r.b) for r in similar.mutual_pairs(table, SMALL).collect()}
    assert len(found & pairs) >= 0.98 * len(pairs) and len(found - pairs) <= 0.01 * len(pairs)


def test_which_vectors_count(spark):
    ok = np.eye(16, dtype=np.float32)[0]
    vectors = {n: ok + 0.01 * n for n in range(1, 6)}
    nan = float("nan")
    bad = [(50, 6, 1, [nan] * 16, None, 0), (51, 7, 1, [0.0] * 16, None, 0), (52, 8, 1, [1.0] * 15, None, 0), (53, 9, 1, None, None, 0), (54, 10, 1, [1.0] * 15 + [None], None, 0),
           (55, 11, 7, [1.0] * 16, None, 0), (56, 999, 1, [1.0] * 16, None, 0), (57, None, 1, [1.0] * 16, None, 0), (58, 1, 1, [nan] * 16, None, 0), (59, 2, 1, [5.0] * 16, None, 0), (60, 12, 1, [float("inf")] * 16, None, 0), (61, 13, 1, [], None, 0), (59, 2, 1, [5.0] * 16, None, 0)]
    table = similar.usable_vectors(*tables(spark, vectors, bad, chunks=range(1, 20)))
    rows = {r.chunk_id: r for r in table.collect()}
    assert set(rows) == {1, 2, 3, 4, 5, 12}
    assert np.allclose(similar.unpack([rows[2].vec], 16), 0.25)  # the greater id of equal times
    got = {r.chunk_id for r in similar.most_similar(table, SMALL).collect()}
    assert got == {1, 2, 3, 4, 5}
    empty = similar.usable_vectors(*[t.limit(0) for t in tables(spark, vectors)])
    assert similar.most_similar(empty).count() == 0 and similar.mutual_pairs(empty).count() == 0


def test_hot_copies(spark):
    vectors = {n: np.ones(16, np.float32) for n in range(1, 300)} | {n: np.eye(16, dtype=np.float32)[n % 16] + 0.2 for n in range(300, 320)}
    table = similar.usable_vectors(*tables(spark, vectors))
    got = {}
    for r in similar.most_similar(table, SMALL).collect():
        got.setdefault(r.chunk_id, []).append((r.rank, r.neighbour))
    want = brute(vectors, 10)
    for i in list(range(1, 300, 7)) + [299, 310]:
        assert [n for _, n in sorted(got[i])] == want[i]


def test_packing_loses_nothing():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20, 16)).astype(np.float32)
    x[:10] = (x[:10].view(np.uint32) & 0xFFFF0000).view(np.float32)
    rows = similar.pack(x)
    assert [len(r) for r in rows] == [32] * 10 + [64] * 10
    assert np.array_equal(similar.unpack(rows, 16), similar.normal(x))


@pytest.mark.parametrize("n", [1, 2, 11])
def test_few_vectors(spark, n):
    vectors = {i: np.eye(16, dtype=np.float32)[i % 16] + 0.1 for i in range(n)}
    table = similar.usable_vectors(*tables(spark, vectors))
    rows = similar.most_similar(table, SMALL).collect()
    assert len(rows) == n * min(10, n - 1)


def test_copies_do_not_take_the_lists(spark):
    rng = np.random.default_rng(11)
    hot = rng.normal(size=16)
    copies = {i: hot.astype(np.float32) for i in range(1, 2001)}
    families = lambda first: (first + 0.2 * rng.normal(size=(166, 12, 16))).reshape(-1, 16)
    near = dict(enumerate(families(hot + 0.6 * rng.normal(size=(166, 1, 16))).astype(np.float32), 2001))
    far = dict(enumerate(families(rng.normal(size=(166, 1, 16))).astype(np.float32), 4001))
    table = similar.usable_vectors(*tables(spark, copies | near | far))
    s = dataclasses.replace(similar.CLEAR, list_size=128)
    ids = [*range(1, 12), *near, *far]  # of the copies only the eleven smallest ids can be in a pair
    high = brute({i: (copies | near | far)[i] for i in ids}, 10, 0.75)
    pairs = {(a, b) for a in high for b in high[a] if a < b and a in high[b]}
    found = {(r.a, r.b) for r in similar.mutual_pairs(table, s).collect()}
    assert len(found & pairs) >= 0.996 * len(pairs)
    crowd = similar._crowded(table, s.k)
    compared = similar.without_surplus(table, crowd)
    centre = similar.fit(compared, s)[1][1].centre
    assert compared.count() == 11 + len(near) + len(far) and len(np.unique(centre, axis=0)) == len(centre)


def test_centres_are_distinct_and_used():
    rng = np.random.default_rng(4)
    x = similar.normal(np.concatenate([np.tile(rng.normal(size=(1, 16)), (400, 1)), rng.normal(size=(800, 16))]).astype(np.float32))
    centre = similar._kmeans(x, 120, 7)
    assert len(np.unique(centre, axis=0)) == len(centre) >= 110
    assert len(np.unique((x @ centre.T).argmax(1))) >= 0.97 * len(centre)
    assert len(similar._kmeans(x[:400], 50, 7)) == 1


def test_a_second_level_keeps_the_recall(spark):
    vectors = clusters(1500, seed=5)
    table = similar.usable_vectors(*tables(spark, vectors))
    s = dataclasses.replace(SMALL, max_lists=12, fine=16, fine_probes=6, probes=10, replicas=3)
    dim, lists = similar.fit(table, s)[1]
    assert len(lists.centre) <= 2 * s.max_lists and len(lists.fine) > 4
    x = similar.normal(np.array([vectors[i] for i in sorted(vectors)]))
    row, which, role = lists.assign(x, s)
    assert set(row[role & 1 > 0]) == set(row[role & 2 > 0]) == set(range(len(x)))  # every vector is held and asks somewhere
    assert len(np.unique(which)) > 3 * len(lists.centre)
    want, got = brute(vectors, 10), {}
    for r in similar.most_similar(table, s).collect():
        got.setdefault(r.chunk_id, set()).add(r.neighbour)
    assert np.mean([len(got[i] & set(w)) / len(w) for i, w in want.items()]) >= 0.9


def test_a_list_that_holds_half_of_all_vectors(spark, monkeypatch):
    """Near copies, none of them exact: groups stay under their bound and nothing is lost."""
    rng = np.random.default_rng(6)
    hot = rng.normal(size=16)
    near = {i: (hot + 1e-3 * rng.normal(size=16)).astype(np.float32) for i in range(1, 801)}
    far = dict(enumerate(rng.normal(size=(800, 16)).astype(np.float32), 801))
    table = similar.usable_vectors(*tables(spark, near | far))
    s = dataclasses.replace(SMALL, list_size=64, block=40)
    sizes, plain = [], similar._spread_over_blocks
    monkeypatch.setattr(similar, "_spread_over_blocks", lambda *a: sizes.append(plain(*a).groupBy("model", "list", "block", "asked").agg({"*": "count"}).collect()) or plain(*a))
    found = {(r.a, r.b) for r in similar.mutual_pairs(table, s).collect()}
    assert max(r["count(1)"] for r in sizes[0]) <= 3.5 * s.block  # data and queries of a block, hashed
    high = brute(far, 10, 0.75)
    pairs = {(a, b) for a in high for b in high[a] if a < b and a in high[b]}
    assert len(found & pairs) >= 0.98 * len(pairs)
    assert any(a <= 800 for a, _ in found)


def test_clusters_are_balanced():
    rng = np.random.default_rng(8)
    x = similar.normal(np.concatenate([rng.normal(size=(1, 16)) + 0.05 * rng.normal(size=(3000, 16)), rng.normal(size=(1000, 16))]).astype(np.float32))
    centre = similar._kmeans(x, 40, 7)
    assert np.bincount((x @ centre.T).argmax(1)).max() <= 3 * len(x) / 40


def test_the_threshold_is_the_cosine_itself(spark):
    a = np.zeros(16, np.float32)
    a[0] = 1
    at = lambda c: np.array([c, np.sqrt(1 - c * c)] + [0.0] * 14)
    vectors = {1: a, 2: at(0.75 + 2e-7).astype(np.float32), 3: at(0.75 - 4e-7).astype(np.float32)}
    exact = lambda i: float(vectors[1].astype(np.float64) @ vectors[i].astype(np.float64) / np.linalg.norm(vectors[i].astype(np.float64)))
    assert exact(2) >= 0.75 > exact(3) > 0.7499995
    found = {(r.a, r.b) for r in similar.mutual_pairs(similar.usable_vectors(*tables(spark, vectors)), SMALL).collect()}
    assert found == {(1, 2), (2, 3)}
