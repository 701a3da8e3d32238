"""History, intervals, snapshots and incremental runs against plain Python."""

import datetime as dt
import json
import random
import unicodedata
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lexgrain.operators import history, incremental, intervals, snapshots

VERSIONS = "doc_id string, version_id long, valid_from date, valid_to date, checksum_text string, loaded_at timestamp_ntz, key string, s string"
DAY = dt.timedelta(1)
FAR = dt.date(9999, 12, 31)


def when(k):
    return dt.datetime(2020, 1, 1) + dt.timedelta(hours=k)


def versions(rng, n):
    date = lambda: rng.choice([None, FAR, *[dt.date(2000, 1, 1) + dt.timedelta(rng.randrange(60)) for _ in range(12)]])
    return [(rng.choice(["a", "b", "hot", "hot", "hot", None]), rng.randrange(9), date(), date(), rng.choice(["x", "y", None]), rng.choice([None, when(rng.randrange(5))]), "k", "s") for _ in range(n)]


def test_history(spark):
    rng = random.Random(3)
    rows = versions(rng, 300)
    got = {tuple(r) for r in history.periods(spark.createDataFrame(rows, VERSIONS)).collect()}
    best = {}
    low = lambda x, least: (x is not None, least if x is None else x)
    for d, v, a, b, c, t, *_ in rows:
        if d and a:
            rank = (low(t, dt.datetime.min), low(v, 0), low(b, dt.date.min), low(c, ""))
            best[d, a] = max(best.get((d, a), (rank, b, c)), (rank, b, c), key=lambda x: x[0])
    want = set()
    for d in {k[0] for k in best}:
        seq = sorted((a, *best[d, a][1:]) for a in (k[1] for k in best if k[0] == d))
        islands = []
        for a, b, c in seq:
            if islands and islands[-1][1] == c:
                islands[-1][2] = b
            else:
                islands.append([a, c, b])
        for i, (a, c, b) in enumerate(islands):
            end = islands[i + 1][0] - DAY if i + 1 < len(islands) else (None if b in (None, FAR) else b)
            want.add((d, c, a, end, i + 1 == len(islands)))
    assert got == want


def test_intervals(spark):
    rng = random.Random(5)
    rows = versions(rng, 120)
    got = {tuple(r) for r in intervals.periods_and_gaps(spark.createDataFrame(rows, VERSIONS)).collect()}
    by = defaultdict(list)
    for d, _, a, b, *_ in rows:
        a, b = a or dt.date.min, b or FAR
        if d and a <= b:
            by[d].append((a, b))
    want = set()
    for d, spans in by.items():
        merged = []
        for a, b in sorted(spans):
            if merged and (merged[-1][1] == FAR or a <= merged[-1][1] + DAY):
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for i, (a, b) in enumerate(merged):
            want.add((d, "period", None if a == dt.date.min else a, None if b == FAR else b))
            if i + 1 < len(merged):
                want.add((d, "gap", b + DAY, merged[i + 1][0] - DAY))
    assert got == want


@pytest.mark.parametrize("f", [history.periods, intervals.periods_and_gaps])
def test_empty_versions(spark, f):
    assert f(spark.createDataFrame([], VERSIONS)).count() == 0


NODES = "doc_id string, version_id long, canonical_path string, text_content string, loaded_at timestamp_ntz, pair string, side int"


def test_snapshots(spark):
    rng = random.Random(9)
    texts = [None, "", "  ", "è a", "è a", "è a\n", "b", "B"]
    rows = [("hot", v, f"p{k}", rng.choice(texts), when(rng.randrange(4)), "x", 1) for v in range(6) for k in range(500) if rng.random() > 0.05]
    rows += [(rng.choice(["a", None]), rng.randrange(10, 14), f"p{rng.randrange(5)}", rng.choice(texts), when(rng.randrange(4)), "x", 1) for _ in range(60)]
    rows += [("a", None, "p", "t", when(1), "x", 1), ("a", 10, None, "t", when(1), "x", 1), ("same", 20, "p", "t", when(1), "x", 1), ("same", 21, "p", " t", when(1), "x", 1)]
    # equal load times with different texts are decided by digest; keep them out of this comparison
    seen, kept = {}, []
    for r in rows:
        k = (r[0], r[1], r[2], r[4])
        if seen.setdefault(k, r[3]) == r[3]:
            kept.append(r)
    got = sorted((tuple(r) for r in snapshots.changes(spark.createDataFrame(kept, NODES)).collect()), key=str)
    plain = lambda t: "".join(unicodedata.normalize("NFC", t or "").split())
    snap = defaultdict(dict)
    for d, v, p, t, at, *_ in kept:
        if v is not None and p is not None and (p not in snap[d, v] or at > snap[d, v][p][0]):
            snap[d, v][p] = (at, plain(t))
    want = []
    for d in {k[0] for k in snap}:
        order = sorted(v for e, v in snap if e == d)
        for old, new in zip(order, order[1:], strict=False):
            x, y = snap[d, old], snap[d, new]
            want += [(new, p, "added") for p in y.keys() - x.keys()] + [(new, p, "removed") for p in x.keys() - y.keys()]
            want += [(new, p, "changed") for p in x.keys() & y.keys() if x[p][1] != y[p][1]]
    assert got == sorted(want, key=str)
    assert snapshots.changes(spark.createDataFrame([], NODES)).count() == 0


FILES = "raw_id long, sha256 string, arrived_at timestamp_ntz, status string, run_id long"
RUNS = "run_id long, started_at timestamp_ntz, status string"


def history_of(rng, n):
    files = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["a", "b", None]), rng.choice([None, *[when(k) for k in range(90)]]), rng.choice(["new", "new", "error", None]), 7) for _ in range(n)]
    files = list({(r[0], r[2]): r for r in files}.values())
    runs = [(k, when(6 * k + rng.randrange(5)), rng.choice(["finished", "failed", "running"])) for k in range(1, 14)]
    return files + files[:5], runs + runs[:3] + [(None, when(1), "finished"), (20, None, "finished")]


def replay(files, runs):
    done = sorted((s, r) for r, s in {(r, min(s for q, s, _ in runs if q == r and s)) for r, s, st in runs if r and s and st == "finished"})
    held, want = {}, set()
    for start, run in [*done, (None, 0)]:
        newest = {}
        for f, h, at, st, _ in files:
            if f and h and at and st == "new" and (start is None or at < start) and at >= newest.get(f, (at,))[0]:
                newest[f] = (at, h)
        for f, (_, h) in newest.items():
            if held.get(f) != h:
                want.add((run, f))
                held[f] = h
    return want


@pytest.mark.parametrize("step", ["plan", "staged", "moved", "committed", "state"])
def test_feed_survives_a_crash_at_every_step(spark, tmp_path, monkeypatch, step):
    files, _ = history_of(random.Random(11), 60)
    log = spark.createDataFrame(files, FILES)
    feed = incremental.Feed(spark, f"file://{tmp_path}/feed", 4, compact=2)
    times = [when(k) for k in (20, 45, 70)]
    runs = [(k + 1, t, "finished") for k, t in enumerate(times)]
    write, move, died = incremental.Store.write, incremental.Store.move, []

    def dies_before(store, kind, call, *args):
        if not died and kind == step and store.exists("commits/0000000000.json"):
            died.append(kind)
            raise RuntimeError("lost")
        return call(store, *args)

    monkeypatch.setattr(incremental.Store, "write", lambda s, name, value: dies_before(s, "plan" if name.startswith("plans") else "moved", write, name, value))
    monkeypatch.setattr(incremental.Store, "move", lambda s, a, b: dies_before(s, "state" if b.startswith("state") else "staged", move, a, b))
    for t in [*times, None]:
        while True:
            try:
                feed.run(log, str(t) if t else None)
            except RuntimeError:
                continue
            if step != "committed" or died:
                break
            died.append(step)  # as if the answer was lost: the caller asks again
    assert died == [step]
    got = {(r["batch"], r["raw_id"]) for r in feed.batches().collect()}
    if step == "committed":  # asking again took what was new by then, which was nothing
        assert {k for _, k in got} == {k for _, k in replay(files, runs)} and feed.taken().count() == len(replay(files, runs))
    elif step == "state":  # the batch was committed, only its answer was lost
        assert feed.taken().count() == len(replay(files, runs))
    else:
        assert {(b + 1 if b < 3 else 0, k) for b, k in got} == replay(files, runs)


def test_state_is_compacted_and_a_backlog_is_taken_at_once(spark, tmp_path, monkeypatch):
    files, runs = history_of(random.Random(3), 80)
    log = spark.createDataFrame(files, FILES)
    one, many = (incremental.Feed(spark, f"file://{tmp_path}/{x}", 4, compact=2) for x in "ab")
    times = [str(when(k)) for k in (10, 20, 30, 60)]
    for t in times:
        one.run(log, t)
    assert one._store.names("state") == ["0000000001", "0000000003"]
    held = {(r["raw_id"], r["sha256"]) for r in one.held(9).collect()}
    best = {}
    for r in one.taken().collect():
        best[r["raw_id"]] = max(best.get(r["raw_id"], (0, "")), (r["offset"], r["sha256"]))
    assert held == {(k, h) for k, (_, h) in best.items()} and held
    monkeypatch.setattr(incremental, "BACKLOG", 3)
    many.plan(log, times)
    assert list(many.pending()) == [0, 1, 2, 3] and many.replay(log) == 3 and not many.pending()
    rows = lambda feed: sorted(tuple(r) for r in feed.batches().collect())
    assert rows(one) == rows(many) != []


def test_feed_survives_failures(spark, tmp_path):
    files = [(k % 4, f"h{k}", when(k), "new", 0) for k in range(20)] + [(1, "h17", when(30), "new", 0)]
    log = spark.createDataFrame(files, FILES)
    feed = incremental.Feed(spark, f"file://{tmp_path}/feed", 4)
    seen = []

    def fail(batch):
        raise RuntimeError("lost")

    assert feed.run(log, "2020-01-01 08:00:00", lambda b: seen.append({tuple(r)[::2] for r in b.collect()})) == 0
    with pytest.raises(RuntimeError):
        feed.run(log, "2020-01-01 12:00:00", fail)
    assert feed.run(log, "2020-01-01 20:00:00", lambda b: seen.append({tuple(r)[::2] for r in b.collect()})) == 1  # the failed plan first
    assert feed.run(log, "2020-01-03 00:00:00", lambda b: seen.append({tuple(r)[::2] for r in b.collect()})) == 2
    assert seen[0] == {(k % 4, f"h{k}") for k in range(4, 8)}
    assert seen[1] == {(k % 4, f"h{k}") for k in range(8, 12)}
    assert seen[2] == {(k % 4, f"h{k}") for k in range(16, 20)}  # h17 again is no change
    assert feed.run(log, "2020-01-03 00:00:00") == 3
    assert feed.taken().count() == 12


def test_feed_survives_failure_between_move_and_commit(spark, tmp_path, monkeypatch):
    log = spark.createDataFrame([(k % 4, f"h{k}", when(k), "new", 0) for k in range(12)] + [(1, "h9", when(14), "new", 0)], FILES)
    feed = incremental.Feed(spark, f"file://{tmp_path}/feed", 4)
    assert feed.run(log, "2020-01-01 08:00:00") == 0
    write, worked = incremental.Store.write, []

    def dies(store, name, value):
        if name.startswith("commits/"):
            raise RuntimeError("lost")
        write(store, name, value)

    with monkeypatch.context() as m:
        m.setattr(incremental.Store, "write", dies)
        with pytest.raises(RuntimeError):
            feed.run(log, "2020-01-01 12:00:00", lambda b: worked.append(b.count()))
    assert not (tmp_path / "feed/commits/0000000001.json").exists() and (tmp_path / "feed/sink/batch=0000000001").exists()
    assert feed.run(log, "2020-01-02 00:00:00", lambda b: worked.append(b.count())) == 1
    assert {tuple(r)[::2] for r in feed.taken().collect()} == {(k % 4, f"h{k}") for k in range(4, 12)}
    assert feed.run(log, "2020-01-02 00:00:00", lambda b: worked.append(b.count())) == 2  # h9 again is no change
    assert worked == [4]


class Refusing:
    """A file system that renames nothing into the sink."""

    def __init__(self, fs):
        self._fs = fs

    def __getattr__(self, name):
        return getattr(self._fs, name)

    def rename(self, path, to):
        return "/sink/" not in to.toString() and self._fs.rename(path, to)


def test_feed_does_not_commit_a_failed_rename(spark, tmp_path):
    log = spark.createDataFrame([(1, "a", when(1), "new", 0)], FILES)
    feed = incremental.Feed(spark, f"file://{tmp_path}/feed", 4)
    fs = feed._store._fs
    feed._store._fs = Refusing(fs)
    with pytest.raises(OSError, match="renamed"):
        feed.run(log, "2020-01-02 00:00:00")
    feed._store._fs = fs
    assert not feed._store.names("commits") and feed.taken().count() == 0
    assert feed.run(log, "2020-01-02 00:00:00") == 0 and feed.taken().count() == 1


def test_feed_runs_by_offsets_of_each_partition(spark, tmp_path):
    files, runs = history_of(random.Random(7), 60)
    runs = runs[:6] + runs[-2:]
    got = {tuple(r) for r in incremental.feed_runs(spark.createDataFrame(files, FILES), spark.createDataFrame(runs, RUNS), f"file://{tmp_path}/feed", 4).collect()}
    assert got == replay(files, runs) and {r for r, _ in got} > {0}
    plans = [json.loads(p.read_text()) for p in sorted((tmp_path / "feed/commits").glob("0*.json"))]
    assert len(plans) == 1 + len({r for r, s, st in runs if r and s and st == "finished"})
    assert all(x["until"] == y["after"] for x, y in zip(plans, plans[1:], strict=False))
    part = {r["k"]: r["p"] for r in spark.createDataFrame([(1,), (2,), (3,)], "k long").select("k", incremental.log_partition(F.col("k"), 4).alias("p")).collect()}
    last = {}
    for f, h, at, st, _ in files:
        if f and h and at and st == "new":
            last[part[f]] = max(last.get(part[f], at), at)
    micros = lambda t: (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    assert plans[-1]["until"] == [micros(last[k]) if k in last else None for k in range(4)] and len(set(plans[-1]["until"])) > 1


def test_feed_runs_of_empty_tables(spark, tmp_path):
    log, runs = spark.createDataFrame([(1, "a", when(1), "new", 0)], FILES), spark.createDataFrame([], RUNS)
    assert [tuple(r) for r in incremental.feed_runs(log, runs, f"file://{tmp_path}/a", 4).collect()] == [(0, 1)]
    assert incremental.feed_runs(log.limit(0), runs, f"file://{tmp_path}/b", 4).count() == 0
