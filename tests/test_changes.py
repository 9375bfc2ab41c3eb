import datetime as dt
import random

import pytest

from movelane.operators import changes

ITEMS = "item_id long, campaign_id long, url string, content_hash binary, arrived_at timestamp"
RUNS = "run_id string, campaign_id long, stage string, status string, started_at timestamp, logged_at timestamp"


def at(hours):
    return dt.datetime(2025, 1, 1) + dt.timedelta(hours=hours) if hours is not None else None


def brute(items, runs):
    last = {}
    for r in runs:
        if r[0] is not None and (r[0] not in last or (r[5] or dt.datetime.min) > (last[r[0]][5] or dt.datetime.min)):
            last[r[0]] = r
    good = sorted((r for r in last.values() if r[2] == "ingest" and r[3] == "succeeded" and r[4] and r[1] is not None), key=lambda r: (r[4], r[0]))
    out, seen = set(), {}
    changed = []
    for i in sorted((i for i in items if i[4] and i[1] is not None), key=lambda i: (i[4], i[0])):
        key = (i[1], i[2])
        if key not in seen or seen[key] != i[3]:
            changed.append(i)
        seen[key] = i[3]
    before = {}
    for r in good:
        for i in changed:
            if i[1] == r[1] and i[4] <= r[4] and (r[1] not in before or i[4] > before[r[1]]):
                out.add((r[0], i[0]))
        before[r[1]] = r[4]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    items = [(i, rng.choice([1, 1, 1, 2, None]), rng.choice(["hot"] * 6 + [f"u{j}" for j in range(8)] + [None]), rng.choice([b"a", b"b", b"c", None]), at(rng.choice([None] + list(range(0, 900, 7))))) for i in range(300)]
    runs = []
    for r in range(25):
        start = at(rng.randrange(0, 900))
        state = (f"r{r}", rng.choice([1, 1, 2, None]), rng.choice(["ingest"] * 4 + ["extract"]), rng.choice(["succeeded", "failed", "running"]), start, start + dt.timedelta(hours=1))
        runs += [state] * rng.choice([1, 1, 2])
        if rng.random() < 0.4:
            runs.append((*state[:3], "succeeded", start, start + dt.timedelta(hours=2)))
    frames = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as p", "2 as k", "3 as id", "4 as at", "5 as day", "6 as low", "7 as after"), spark.createDataFrame(runs, RUNS)
    got = [(r.run_id, r.item_id) for r in changes.ingested_by_run(*frames).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(items, runs)


def test_empty_tables(spark):
    items, runs = spark.createDataFrame([(1, 1, "u", b"a", at(1))], ITEMS), spark.createDataFrame([("r", 1, "ingest", "succeeded", at(2), at(3))], RUNS)
    assert changes.ingested_by_run(items, runs).count() == 1
    assert changes.ingested_by_run(items.limit(0), runs).count() == 0
    assert changes.ingested_by_run(items, runs.limit(0)).count() == 0


def test_a_hot_url_is_spread_over_tasks(spark):
    items = [(i, 1, "hot", bytes([i // 3 % 5]), at(i // 10)) for i in range(500)]
    runs = [("r", 1, "ingest", "succeeded", at(1000), at(1001))]
    frame = spark.createDataFrame(items, ITEMS)
    for parts in (1, 2, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {(r.run_id, r.item_id) for r in changes.ingested_by_run(frame.repartition(3), spark.createDataFrame(runs, RUNS)).collect()}
        assert got == brute(items, runs)
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert {r.reason: r.rows for r in changes.unplaced(spark.createDataFrame([(1, 1, "u", b"a", None), (2, None, "u", b"a", at(1)), (3, 1, "u", b"a", at(1))], ITEMS)).collect()} == {"no arrival": 1, "no partition": 1}


def test_run_ranges_survive_a_failure_between_sink_and_commit(spark, tmp_path, monkeypatch):
    items = spark.createDataFrame([(1, 1, "a", b"x", at(1)), (2, 1, "a", b"y", at(2)), (3, 1, "a", b"y", at(3))], ITEMS)
    runs = spark.createDataFrame([("r", 1, "ingest", "succeeded", at(5), at(6))], RUNS)
    folder, whole = str(tmp_path / "b"), changes.DurableBatches._commit

    def lost(self, batch):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(changes.DurableBatches, "_commit", lost)
    with pytest.raises(RuntimeError):
        changes.ingested_by_run(items, runs, folder)
    monkeypatch.setattr(changes.DurableBatches, "_commit", whole)
    # A run logged since is not part of the plan that was written; the replay sinks each row once.
    more = runs.unionByName(spark.createDataFrame([("s", 1, "ingest", "succeeded", at(2), at(9))], RUNS))
    assert sorted((r.run_id, r.item_id) for r in changes.ingested_by_run(items, more, folder).collect()) == [("r", 1), ("r", 2)]
    assert spark.read.parquet(folder + "/sink").count() == 2


def test_reader_replays_its_plan_after_a_failure(spark, tmp_path):
    log = changes.ChangeLog(spark, str(tmp_path / "log"))
    rows = lambda *r: spark.createDataFrame(list(r), ITEMS)
    reader = lambda: changes.IncrementalReader(log, str(tmp_path / "state"))
    assert reader().run() is None
    log.append(rows((1, 1, "a", b"x", at(1)), (2, 1, "b", b"x", at(2)), (3, 2, "c", b"x", at(2))))
    assert {r.item_id for r in reader().run().collect()} == {1, 2, 3}
    # Written late with an early time, of no campaign, without a time: positions order them all.
    log.append(rows((4, 1, "d", b"x", at(0)), (5, 3, "e", b"x", at(1)), (6, None, "f", b"x", None)))

    def broken(frame):
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        reader().run(broken)
    log.append(rows((7, 2, "g", b"x", at(9)), (7, 2, "g", b"x", at(9))))
    # The plan was written ahead: what arrived since the failure waits for the next batch.
    assert {r.item_id for r in reader().run().collect()} == {4, 5, 6}
    assert [r.item_id for r in reader().run().collect()] == [7, 7]
    assert reader().run().count() == 0
    assert sorted(r.item_id for r in spark.read.parquet(str(tmp_path / "state" / "sink")).collect()) == [1, 2, 3, 4, 5, 6, 7, 7]


def test_a_failure_between_sink_and_commit_repeats_nothing(spark, tmp_path, monkeypatch):
    log = changes.ChangeLog(spark, str(tmp_path / "log"))
    log.append(spark.createDataFrame([(1, 1, "a", b"x", at(1))], ITEMS))
    reader = changes.IncrementalReader(log, str(tmp_path / "state"))
    reader.run()
    log.append(spark.createDataFrame([(2, 1, "b", b"x", at(0))], ITEMS))
    whole = changes.DurableBatches._commit
    monkeypatch.setattr(changes.DurableBatches, "_commit", lambda self, batch: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        reader.run()
    monkeypatch.setattr(changes.DurableBatches, "_commit", whole)
    assert [r.item_id for r in changes.IncrementalReader(log, str(tmp_path / "state")).run().collect()] == [2]
    assert sorted(r.item_id for r in spark.read.parquet(str(tmp_path / "state" / "sink")).collect()) == [1, 2]


def test_only_new_segments_are_opened(spark, tmp_path):
    log = changes.ChangeLog(spark, str(tmp_path / "log"))
    for i in range(4):
        log.append(spark.createDataFrame([(i, 1, "a", b"x", at(1))], ITEMS))
    assert {f.rsplit("/", 2)[1] for f in log.read(1, 2).inputFiles()} == {"segment=00000002"}
