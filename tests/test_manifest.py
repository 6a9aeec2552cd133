"""The commit log: order, conflicts, crashes, replays, snapshots, compaction and the cost of a commit."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from vigil.operators import manifest, store
from vigil.operators.manifest import Manifest


def scored(spark, ids, score=0.3):
    return spark.createDataFrame([(int(i), float(score), "allow") for i in ids], "TransactionID long, score double, decision string")


def rows(spark, path, **how):
    return sorted((r.TransactionID, r.score, r.batch_id) for r in store.read_store(spark, path, **how).collect())


def test_staged_rows_are_in_no_snapshot(spark, scratch):
    path = f"{scratch}/store"
    store.stage_scores(scored(spark, [1, 2]), path)
    assert rows(spark, path) == [] and store.row_count(spark, path) == 0
    assert store.append_scores(scored(spark, [3]), path) == 1
    assert rows(spark, path) == [(3, 0.3, 0)]


def test_replays_by_writer(spark, scratch):
    path = f"{scratch}/store"
    for writer in "ab":
        assert store.append_scores(scored(spark, [1]), path, writer=writer, micro_batch=0) == 1
        assert store.append_scores(scored(spark, [1]), path, writer=writer, micro_batch=0) == 0
    assert store.append_scores(scored(spark, []), path, writer="a", micro_batch=1) == 0
    assert Manifest(spark, path).committed("a", 1) and not Manifest(spark, path).committed("b", 1)
    assert store.append_scores(scored(spark, [9]), path, writer="a", micro_batch=1) == 0
    assert store.row_count(spark, path) == 2


def test_writers_that_meet_both_commit(spark, scratch, monkeypatch):
    """A writer that read the newest entry before another committed takes the next number."""
    path = f"{scratch}/store"
    log, seen = Manifest(spark, path), []
    real = Manifest.latest

    def late(self):
        found = real(self)
        if not seen:
            seen.append(found)
            store.append_scores(scored(spark, [1], 0.1), path, writer="other", micro_batch=0)
        return found

    monkeypatch.setattr(Manifest, "latest", late)
    folder, n = store.stage_scores(scored(spark, [1], 0.9), path)
    entry = log.commit(folder, n, "mine", 0)
    assert entry.version == 1 and entry.total == 2 and entry.writers == {"other": 0, "mine": 0}
    assert store.latest_scores(store.read_store(spark, path)).first().score == 0.9


def test_parallel_appends_lose_nothing(spark, scratch):
    path = f"{scratch}/store"
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: store.append_scores(scored(spark, [i]), path, writer=f"w{i % 4}", micro_batch=i // 4), range(12)))
    got = rows(spark, path)
    assert [r[0] for r in got] == list(range(12))
    assert sorted(r[2] for r in got) == list(range(12))


def test_snapshots_and_compaction(spark, scratch):
    path = f"{scratch}/store"
    for i in range(7):
        store.append_scores(scored(spark, [i, 100], i / 10), path, compact_every=3)
    log = Manifest(spark, path)
    parts, fresh = log.snapshot()
    assert parts and len(fresh) < 3
    got = store.read_store(spark, path)
    assert got.count() == store.row_count(spark, path) == 14
    assert store.latest_scores(got).filter("TransactionID = 100").first().score == 0.6
    # numbers stay in order and old snapshots stay readable
    assert [r[0] for r in sorted(((b, i) for i, _, b in rows(spark, path) if i < 100))] == sorted(b for i, _, b in rows(spark, path) if i < 100)
    assert [r[0] for r in rows(spark, path, version=1) if r[0] < 100] == [0, 1]
    with pytest.raises(ValueError, match="no version 99"):
        store.read_store(spark, path, version=99)
    # folders that were merged or never committed go, the newest snapshot stays
    store.stage_scores(scored(spark, [5]), path)
    before = rows(spark, path)
    assert len(log.vacuum(0)) >= 7
    assert rows(spark, path) == before


def test_rows_are_merged_once(spark, scratch):
    path = f"{scratch}/store"
    for i in range(9):
        store.append_scores(scored(spark, [i]), path, compact_every=3)
    parts, _ = Manifest(spark, path).snapshot()
    assert len(parts) >= 2
    counts = [spark.read.parquet(f"{path}/{p}").count() for p in parts]
    assert max(counts) <= 3


def test_concurrent_compactions_keep_one(spark, scratch, monkeypatch):
    path = f"{scratch}/store"
    for i in range(4):
        store.append_scores(scored(spark, [i]), path)
    log = Manifest(spark, path)

    def slow(fresh):
        if not seen:
            seen.append(1)
            assert store.compact(spark, path)
            store.append_scores(scored(spark, [50]), path)
        return store._rows_of(spark, path, [], fresh)

    seen = []
    assert log.compact(slow) is None
    assert [r[0] for r in rows(spark, path)] == [0, 1, 2, 3, 50]
    assert not store.compact(spark, f"{scratch}/nothing")


def test_a_commit_reads_a_few_entries_whatever_the_size(spark, scratch, monkeypatch):
    path = f"{scratch}/store"
    reads = []
    real = Manifest._read
    monkeypatch.setattr(Manifest, "_read", lambda self, file: reads.append(file) or real(self, file))
    log, costs = Manifest(spark, path), []
    for i in range(30):
        del reads[:]
        log.commit(f"rows-{i}", 1, "w", i)
        costs.append(len(reads))
    assert max(costs[5:]) <= 3
    # without the hint the newest entry is found in the listing
    log._fs.delete(log._at(f"{path}/{manifest.LOG}/_newest"), False)
    assert Manifest(spark, path).latest().version == 29


def test_compacted_and_fresh_rows_have_one_schema(spark, scratch):
    path = f"{scratch}/store"
    store.append_scores(scored(spark, [1]), path)
    store.compact(spark, path)
    store.append_scores(scored(spark, [2]), path)
    got = store.read_store(spark, path)
    assert got.schema == store.STORE_SCHEMA or [f.name for f in got.schema] == [f.name for f in store.STORE_SCHEMA]
    assert got.filter(F.col("batch_id").isNull()).count() == 0
