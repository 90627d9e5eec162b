import random
from collections import Counter, defaultdict

import pytest

from docmill.llm import packing


def contents(rows):
    """Containers as lists of sizes, from a plan."""
    out = defaultdict(list)
    for size, first, end, container, per in rows.tolist():
        for rank in range(first, end):
            out[container + (rank - first) // per].append(size)
    return out


@pytest.mark.parametrize("choose", ["residual", "dot"])
@pytest.mark.parametrize("documents,attention", [(None, None), (6, None), (None, 200 * 200)])
def test_plan(choose, documents, attention):
    rng = random.Random(7)
    for _ in range(12):
        capacity = 256
        largest = 200 if attention else capacity
        histogram = Counter(min(largest, max(1, int(rng.lognormvariate(3.5, 1)))) for _ in range(rng.randint(1, 900)))
        rows, n = packing.plan(histogram, capacity, documents=documents, attention=attention, choose=choose)
        bins = contents(rows)
        assert Counter(s for b in bins.values() for s in b) == histogram
        assert set(bins) == set(range(n))
        assert all(sum(b) <= capacity and len(b) <= (documents or capacity) and sum(s * s for s in b) <= (attention or capacity**2) for b in bins.values())
        if choose == "residual" and not documents and not attention:
            assert n <= 1.02 * -(-sum(s * c for s, c in histogram.items()) // capacity) + 1 or n <= best_fit(histogram, capacity)
        assert n <= best_fit(histogram, capacity, documents, attention) * (1.3 if choose == "dot" else 1.03) + 1


def best_fit(histogram, capacity, documents=None, attention=None):
    """Plain item-by-item best-fit decreasing."""
    bins = []
    for size in sorted(histogram.elements(), reverse=True):
        fits = [b for b in bins if sum(b) + size <= capacity and len(b) < (documents or capacity) and sum(s * s for s in b) + size * size <= (attention or capacity**2)]
        if fits:
            max(fits, key=sum).append(size)
        else:
            bins.append([size])
    return len(bins)


def test_item_too_large():
    with pytest.raises(ValueError):
        packing.plan({5: 1}, 10, attention=20)


@pytest.mark.parametrize("rank_block", [200_000, 40])
def test_pack(spark, rank_block):
    rng = random.Random(9)
    sizes = [(n, rng.choice([7, 7, 7, rng.randint(1, 64), rng.randint(60, 500)])) for n in range(1, 500)] + [(900, 0), (901, 64), (902, 128), (903, 129), (1, 5), (None, 3)]
    got = packing.pack(spark.createDataFrame(sizes, "doc_id long, n_tokens int"), 64, rank_block=rank_block).collect()
    load, pieces = Counter(), defaultdict(list)
    for r in got:
        load[r.container_id] += r.n_tokens
        pieces[r.doc_id].append((r.piece, r.token_start, r.n_tokens))
    assert max(load.values()) <= 64 and set(load) == set(range(len(load)))
    assert len(load) <= 1.02 * sum(n for _, n in sizes) / 64 + 1
    for doc, n in sizes:
        if doc == 1 or n == 0:
            continue
        parts = sorted(pieces[doc])
        assert len(parts) == -(-n // 64) and [p[1] for p in parts] == [64 * k for k in range(len(parts))] and sum(p[2] for p in parts) == n
    assert 900 not in pieces and len(pieces[1]) >= 2
    assert packing.pack(spark.createDataFrame([], "doc_id long, n_tokens int"), 64).count() == 0


@pytest.mark.parametrize("choose", ["residual", "dot"])
def test_all_three_capacities_bind(spark, choose):
    rng = random.Random(3)
    sizes = spark.createDataFrame([(n, rng.choice([2, 3, rng.randint(1, 60), rng.randint(40, 300)])) for n in range(600)], "doc_id long, n_tokens int")
    limits = {"documents": 6, "attention": 64 * 64 // 2}
    packed = packing.pack(sizes, 64, choose=choose, **limits)
    row = packing.invariants(sizes, packed, 64, **limits).first()
    assert row.documents == 600 and row.whole and row.kept and row.gapless
    loads = packed.groupBy("container_id").agg({"n_tokens": "sum", "doc_id": "count"}).collect()
    squares = Counter()
    for r in packed.collect():
        squares[r.container_id] += r.n_tokens**2
    assert max(r["count(doc_id)"] for r in loads) == 6 and max(squares.values()) > 0.97 * limits["attention"]
    histogram = Counter(r.n_tokens for r in packed.collect())
    assert len(loads) <= 1.15 * packing.lower_bound(histogram, 64, **limits) + 1
    assert not packing.invariants(sizes, packed.where("piece > 0 or doc_id <> 5"), 64, **limits).first().whole
    assert not packing.invariants(sizes, packed, 64, documents=5, attention=limits["attention"]).first().kept
    assert packing.invariants(sizes.limit(0), packed.limit(0), 64).first().whole
