from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docmill.errors import ConflictError
from docmill.operators.incremental import ChangeState, process_changed, readable_time, replay

T0 = datetime(2030, 1, 1)
DOCS = "doc_id long, path string, updated_at timestamp, last_modified timestamp, extra string"
META = "meta_id long, doc_id long, processing struct<ingested_at:string,source_hash:string,docling_version:string>"
RUNS = "run_id long, started_at timestamp, finished_at timestamp, status string"


def day(n):
    return T0 + timedelta(days=n)


def test_time_forms(spark):
    forms = {
        "2031-04-07T21:47:15.000000+00:00": "2031-04-07 21:47:15", "2031-02-22T23:55:29Z": "2031-02-22 23:55:29", "2031-04-07 02:16:08": "2031-04-07 02:16:08",
        "2031-01-12T03:43:04+09:00": "2031-01-11 18:43:04", "1925910073": "2031-01-11 15:01:13", "20310205T214110Z": "2031-02-05 21:41:10", "20310205T214110-0800": "2031-02-06 05:41:10",
        "0000-00-00": None, "n/a": None, "pending": None, "": None, None: None, "2031-13-07T00:00:00Z": None,
    }
    got = spark.createDataFrame([(k,) for k in forms], "t string").select("t", readable_time(F.col("t")).cast("string").alias("x")).collect()
    assert {r.t: r.x for r in got} == forms


def brute(docs, meta, runs):
    ok = sorted({(r[1], r[0]) for r in runs if r[3] == "completed"})
    seen = {}
    hashes = {}
    for _, d, p in meta:
        if p and p[0]:
            seen[d] = min(seen.get(d, p[0]), p[0])
        if p and p[1]:
            hashes[d] = p[1]
    out, last = [], {}
    for start, run in ok:
        for path in {d[1] for d in docs}:
            rows = [d for d in docs if d[1] == path and d[0] in seen and datetime.fromisoformat(seen[d[0]]) <= start]
            if not rows:
                continue
            new = max(rows, key=lambda d: ((d[2] or d[3]) is not None, d[2] or d[3] or T0, d[0]))
            old = last.get(path)
            if old is None or (new[0] != old and (hashes.get(new[0]) is None or hashes.get(old) is None or hashes[new[0]] != hashes[old])):
                out.append((run, new[0]))
                last[path] = new[0]
    return sorted(out)


def test_replay_equals_brute_force(spark):
    import random

    rng = random.Random(5)
    docs, meta = [], []
    for i in range(1, 160):
        path = rng.choice(["hot", "a", "b", "c", None, "hot"])
        docs.append((i, path, rng.choice([None, day(rng.randint(0, 30))]), rng.choice([None, day(rng.randint(0, 30))]), "x"))
        if rng.random() < 0.9:
            meta.append((i, i, rng.choice([None, (day(rng.randint(0, 34)).isoformat(), rng.choice(["h1", "h2", None]), None)])))
    runs = [(n, day(3 * n), None, rng.choice(["completed", "failed"])) for n in range(1, 12)] + [(1, day(3), None, "started")]
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(meta, META), spark.createDataFrame(runs, RUNS)
    for size in (1, 4, 16):
        got = sorted(tuple(r) for r in replay(*frames, runs_per_commit=size).collect())
        assert got == brute(docs, meta, runs)


def test_empty_tables(spark):
    docs, meta, runs = (spark.createDataFrame([], s) for s in (DOCS, META, RUNS))
    assert replay(docs, meta, runs).count() == 0
    assert replay(docs, meta, spark.createDataFrame([(1, day(1), None, "completed")], RUNS)).count() == 0


def test_state_survives_a_failed_run(spark, tmp_path):
    state = ChangeState(spark, str(tmp_path / "s"))
    rows = lambda data: spark.createDataFrame(data, "id long, k string, at timestamp, body string")
    run = lambda df, n: sorted(r.row_id for r in process_changed(state, df, key="k", row_id="id", version="at", hash_of=["body"], run=n).collect())
    assert run(rows([(1, "a", day(1), "x"), (2, "b", day(1), "y")]), 1) == [1, 2]
    assert run(rows([(1, "a", day(1), "x"), (2, "b", day(1), "y")]), 2) == []
    # a run that dies before the swap leaves half-written folders behind
    spark.range(3).write.parquet(f"{state.root}/cases/half")
    spark.range(3).write.parquet(f"{state.root}/state/half")
    assert state.current() == 2
    assert run(rows([(3, "a", day(2), "x"), (4, "b", day(2), "z"), (5, None, None, None)]), 3) == [4, 5]
    assert sorted(r.row_id for r in state.results().collect()) == [1, 2, 4, 5]


def test_two_writers(spark, tmp_path):
    first, second = (ChangeState(spark, str(tmp_path / "s")) for _ in range(2))
    rows = lambda data: spark.createDataFrame(data, "id long, k string, at timestamp, body string")
    run = lambda state, df, n: sorted(r.row_id for r in process_changed(state, df, key="k", row_id="id", version="at", hash_of=["body"], run=n).collect())
    assert run(first, rows([(1, "a", day(1), "x")]), 1) == [1]
    swap = second.pointer.swap

    def overtaken(text, after=None):
        run(first, rows([(2, "b", day(1), "y")]), 2)
        return swap(text, after)

    second.pointer.swap = overtaken
    with pytest.raises(ConflictError):
        run(second, rows([(2, "b", day(1), "y"), (3, "c", day(1), "z")]), 2)
    second.pointer.swap = swap
    assert sorted(r.row_id for r in first.results().collect()) == [1, 2]  # nothing of the loser counts
    assert run(second, rows([(2, "b", day(1), "y"), (3, "c", day(1), "z")]), 3) == [3]


def test_commits_write_their_own_part(spark, tmp_path):
    state = ChangeState(spark, str(tmp_path / "s"))
    rows = lambda data: spark.createDataFrame(data, "id long, k string, at timestamp, body string")
    run = lambda df, n: sorted(r.row_id for r in process_changed(state, df, key="k", row_id="id", version="at", hash_of=["body"], run=n).collect())
    run(rows([(n, f"k{n}", day(1), "x") for n in range(500)]), 0)
    for n in range(1, 14):
        assert run(rows([(1000 + n, f"k{n}", day(1 + n), "y")]), n) == [1000 + n]
    parts = state._manifest()[1]["state"]
    assert parts[0][1] == 500 and len(parts) <= 6 and len(state._manifest()[1]["cases"]) <= 10  # the large part was written once
    kept = {r.key: r.newest.row_id for r in state.state().collect()}
    assert len(kept) == 500 and all(kept[f"k{n}"] == 1000 + n for n in range(1, 14)) and kept["k400"] == 400
    assert state.results().count() == 513


def test_many_runs_are_searched(spark):
    from docmill.operators import incremental

    starts = [(n, day(n)) for n in range(incremental.TREE + 40)]
    times = [day(0) - timedelta(1), day(3), day(3) + timedelta(microseconds=1), day(len(starts) - 1), day(len(starts)), None]
    f = spark.createDataFrame([(n, t) for n, t in enumerate(times)], "n int, t timestamp")
    pick = lambda s: [r.x for r in f.select("n", incremental.first_run_at(F.col("t"), s).alias("x")).orderBy("n").collect()]
    assert pick(starts) == [0, 3, 4, len(starts) - 1, None, None] and pick(starts[:10]) == [0, 3, 4, None, None, None]
