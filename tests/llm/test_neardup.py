import random
from itertools import combinations

import numpy as np
import pytest

from docmill.llm import neardup

VOCAB = [f"w{n}" for n in range(400)]


def similar(x, y, numerator=7, denominator=10):
    sets = [set(zip(w, w[1:], w[2:])) for w in (neardup.words_of(x), neardup.words_of(y))]
    common = len(sets[0] & sets[1])
    return common * denominator >= (len(sets[0]) + len(sets[1]) - common) * numerator


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + rng.choice([0, 1])] = [rng.choice(VOCAB)]
    return words


def fixture(rng, families=12):
    texts = {}
    for f in range(families):
        base = [rng.choice(VOCAB) for _ in range(rng.randint(40, 160))]
        for k in range(rng.randint(1, 9)):
            texts[len(texts) + 1] = " ".join(edited(rng, base, rng.randint(0, 8)))
    return texts


def brute(texts):
    long = {i: t for i, t in texts.items() if t and len(neardup.words_of(t)) >= 40}
    return {(a, b) for a, b in combinations(sorted(long), 2) if similar(long[a], long[b])}


def frame(spark, texts):
    rows = [(i, t, "clash", 1) for i, t in texts.items()]
    return spark.createDataFrame(rows + rows[:3], "id long, text string, rep string, class int")


def test_masks_cover_two_differences():
    kept = neardup.masks()
    assert kept.shape == (7, 7) and (kept.sum(1) == 4).all()
    for pair in combinations(range(7), 2):
        assert (~kept[:, pair].any(1)).any()


def test_sketches_within_the_radius_collide():
    rng = np.random.default_rng(1)
    sketch = rng.integers(0, 2**63, (1, 42)).astype(np.uint64)
    for _ in range(300):
        other = sketch.copy()
        other[0, rng.choice(42, 17, replace=False)] += np.uint64(1)
        assert (neardup.table_keys(sketch) == neardup.table_keys(other)).any()


@pytest.mark.parametrize("block", [16, 3])
def test_pairs_equal_brute_force(spark, block):
    texts = fixture(random.Random(block))
    texts |= {900: None, 901: "", 902: "too short", 903: texts[1], 904: texts[1].upper() + " !", 905: "é " * 60, 906: "語 " * 45}
    near = neardup.NearDuplicates(frame(spark, texts), block=block, crowd=4)
    assert {tuple(r) for r in near.pairs().collect()} == brute(texts)
    # large classes: the star keeps every copy reachable
    star = {tuple(r) for r in near.pairs(expand=1).collect()}
    assert star <= brute(texts) and {(1, 903), (1, 904)} <= star
    rows = {r.id: r for r in near.classes().collect()}
    assert rows[1].class_id == rows[903].class_id == rows[904].class_id == 1
    assert set(rows) == {i for i, t in texts.items() if t and len(neardup.words_of(t)) >= 40}


def test_an_id_with_two_texts_counts_once(spark):
    a, b = " ".join(VOCAB[:60]), " ".join(VOCAB[100:160])
    rows = [(1, a), (1, b), (2, a), (3, b), (None, a)]
    pairs = {tuple(r) for r in neardup.NearDuplicates(spark.createDataFrame(rows, "id long, text string")).pairs().collect()}
    assert pairs in ({(1, 2)}, {(1, 3)})


def test_hot_copies_and_empty_table(spark):
    text = " ".join(VOCAB[:60])
    texts = {n: text for n in range(1, 400)} | {1000: text + " tail", 1001: " ".join(VOCAB[100:160])}
    near = neardup.NearDuplicates(frame(spark, texts))
    pairs = {tuple(r) for r in near.pairs().collect()}
    assert pairs == {(1, n) for n in range(2, 400)} | {(1, 1000)}
    assert {r.id: r.links for r in near.classes().collect()} == {n: 1 for n in range(1, 400)} | {1000: 399, 1001: 0}
    every = {tuple(r) for r in near.pairs(expand=None).collect()}
    assert every == set(combinations(range(1, 400), 2)) | {(n, 1000) for n in range(1, 400)}
    empty = neardup.NearDuplicates(frame(spark, texts).limit(0))
    assert empty.pairs().count() == 0 and empty.classes().count() == 0


def test_a_template_that_half_of_all_rows_share(spark, monkeypatch):
    """Keys of tens of thousands of members: none is gathered, and members that share the template only are not compared."""
    rng = random.Random(11)
    template = [rng.choice(VOCAB) for _ in range(100)]
    texts = {}
    for n in range(100_000):
        own = [f"{n}x{k}" for k in range(45)]
        texts[n] = " ".join(template + own if n % 2 else own)
    linked = {(n, n + 200_000) for n in range(1, 100_000, 400)}
    for n, m in linked:
        words = texts[n].split()
        texts[m] = " ".join(words[:120] + ["edit"] + words[121:])
    groups = []
    plain = neardup._blockwise
    monkeypatch.setattr(neardup, "_blockwise", lambda *a: groups.append(a[1]) or plain(*a))
    near = neardup.NearDuplicates(spark.createDataFrame(list(texts.items()), "id long, text string").repartition(8))
    assert {tuple(r) for r in near.links.collect()} == linked
    assert not groups  # no group of more than BLOCK members was left


def test_a_crowd_of_similar_passages(spark):
    """Thousands of distinct texts that are all similar: compared in blocks, every pair found."""
    rng = random.Random(12)
    base = [rng.choice(VOCAB) for _ in range(120)]
    rows = [(n, " ".join([*base, f"tail{n}"])) for n in range(1500)]
    near = neardup.NearDuplicates(spark.createDataFrame(rows, "id long, text string"))
    assert near.links.count() == 1500 * 1499 // 2
