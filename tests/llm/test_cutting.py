import random

import pytest

from docmill.llm import cutting

CAP, LAP = 400, 40


def check(text, capacity=CAP, overlap=LAP):
    pieces = cutting.cut(text, capacity, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for a, b, natural in pieces:
        assert 0 < b - a <= capacity
    for (a, b, natural), (c, d, _) in zip(pieces, pieces[1:]):
        assert a < c <= b < d  # nothing lost, always forward
        if natural:
            assert text[b - 1] in cutting.BOUNDARIES
        else:  # forced only where no boundary was in reach
            assert not any(x in cutting.BOUNDARIES for x in text[c:b][overlap * 2 :])
    return pieces


def prose(rng, n):
    return "".join(rng.choice(["word ", "cable ", "line.\n", "end. ", "節。", "ab　", "x" * rng.randint(1, 30)]) for _ in range(n))


def test_pieces_cover_and_fit():
    rng = random.Random(1)
    for _ in range(60):
        check(prose(rng, rng.randint(120, 900)))
    for text in ("x" * 5000, "語" * 3000, " " * 3000, "a\n" * 1500, "é" * 2000, "👩‍👩‍👧" * 400, "x" * 1000 + " y " + "z" * 1000):
        check(text)
    pieces = check(prose(rng, 4000))
    overlaps = [b - c for (_, b, _), (c, _, _) in zip(pieces, pieces[1:])]
    assert all(LAP // 2 <= x <= 2 * LAP for x in overlaps)


def test_an_edit_changes_only_its_neighbours():
    rng = random.Random(2)
    text = prose(rng, 9000)
    at = len(text) // 2
    changed = text[:at] + "a small insertion " + text[at:]
    before = {text[a:b] for a, b, _ in check(text)}
    after = {changed[a:b] for a, b, _ in check(changed)}
    assert len(before - after) <= 12 and len(before) > 60


def test_a_short_head_keeps_its_words():
    for text in ("hello brave world " + "x" * 5000, "a b " + "y" * 900 + " c d " + "z" * 900, "w " * 30 + "q" * 700):
        for (a, b, _), (c, _, _) in zip(cutting.cut(text, CAP, LAP), cutting.cut(text, CAP, LAP)[1:]):
            assert text[c - 1] in cutting.BOUNDARIES or not any(x in cutting.BOUNDARIES for x in text[b - LAP * 3 // 2 : b - LAP // 2])
    assert cutting.cut("hello brave world " + "x" * 5000, 1800, 200)[1][0] == len("hello ")


def stretches(text, capacity):
    out, start = [], 0
    for n, x in enumerate(text + " "):
        if x in cutting.BOUNDARIES:
            if n - start > capacity:
                out.append(start)
            start = n + 1
    return out


def test_stretches_from_the_forced_cuts():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["word ", "節。", "x" * rng.randint(1, 900), "👩‍👩‍👧" * rng.randint(1, 200), " ", "e\u0301" * rng.randint(1, 300)]) for _ in range(rng.randint(1, 14)))
        if len(text) > CAP:
            assert cutting.unbroken(text, cutting.cut(text, CAP, LAP), CAP) == stretches(text, CAP)


def test_no_split_inside_a_character():
    text = "é" * 2000
    assert all(not cutting._attached(ord(text[a])) for a, _, _ in cutting.cut(text, 399, 41))


def test_items(spark):
    long = "word " * 500
    rows = [(1, long, "k"), (2, None, "k"), (3, "", "k"), (4, "x" * 3000 + " " + "y" * 2001 + "。z", "k"), (5, "x" * 2000, "k"), (6, "🙂" * 2001, "k"), (None, long, "k")]
    sources = spark.createDataFrame(rows, "source_id long, content string, item_kind string")
    chunks = spark.createDataFrame([(1, long), (1, long), (9, "ok")], "id long, text string")
    items = cutting.oversized_items(sources, chunks, 2000)
    got = cutting.cut_items(items, capacity=2000, overlap=200).collect()
    runs = sorted((r.item_kind, r.item_id, r.start_char) for r in got if r.piece is None)
    assert runs == [("source", 4, 0), ("source", 4, 3001), ("source", 6, 0)]
    for key in {(r.item_kind, r.item_id) for r in got}:
        pieces = sorted((r for r in got if (r.item_kind, r.item_id) == key and r.piece is not None), key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        whole = ""
        for p in pieces:
            assert len(p.text) == p.end_char - p.start_char <= 2000
            whole += p.text[len(whole) - p.start_char :]
        assert whole == (long if key[1] in (1, None) else dict((r[0], r[1]) for r in rows)[key[1]])
    assert {(r.item_kind, r.item_id) for r in got} == {("source", 1), ("source", 4), ("source", 6), ("source", None), ("chunk", 1)}
    assert cutting.cut_items(items.limit(0), capacity=2000, overlap=200).count() == 0
    known = items.where("item_id is not null")
    rows = cutting.invariants(known, cutting.cut_items(known, capacity=2000, overlap=200).where("piece is not null"), 2000, 200).collect()
    assert len(rows) == 4 and all(r.within and r.natural and r.shared and r.digest for r in rows)
    broken = cutting.cut_items(known, capacity=2000, overlap=200).where("piece is not null and not (piece = 1 and item_id = 4)")
    assert [r.item_id for r in cutting.invariants(known, broken, 2000, 200).collect() if not r.digest] == [4]


def test_budget(spark):
    frame = spark.createDataFrame([(1, "piece", "chars", 2000, 200)], "budget_id int, purpose string, unit string, capacity long, overlap long")
    assert cutting.budget(frame, "piece") == (2000, 200)
    with pytest.raises(ValueError):
        cutting.budget(frame, "none")
