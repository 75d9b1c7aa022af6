import os
import threading

import pytest
from pyspark.sql import functions as F

from tarn.operators import store
from tarn.operators.snapshots import SnapshotTable, wider
from pyspark.sql import types as T

TS = [f"2024-0{i}-01 00:00:00" for i in range(1, 10)]
REC = "id string, value string, council string"


def batch(spark, *records, schema=REC):
    return spark.createDataFrame(list(records), schema)


def rows(df, *cols):
    cols = cols or ("id", "value", "council", "created_at", "updated_at")
    return sorted((tuple(str(r[c]) if r[c] is not None else None for c in cols) for r in df.collect()), key=str)


def files(path, folder="data"):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(os.path.join(path, folder)) for f in names if f.startswith("part-"))


@pytest.fixture()
def table(spark, tmpdir_path):
    return SnapshotTable(spark, os.path.join(tmpdir_path, "t"), buckets=4)


BATCHES = [[("a", "1", "X"), ("b", "2", "x"), ("c", None, "y"), ("d", "<4", "y")],
           [("a", "1", "x"), ("b", "9", "z"), ("c", "3", "y"), ("e", ">5", None)],
           [("b", None, "z"), ("e", "6", "q")],
           [("b", "7", "z"), ("e", "6", "q"), ("f", "1", "f"), ("a", "2", "x")]]


@pytest.mark.parametrize("compact", [False, True, "every"])
def test_equals_the_upsert_in_place(spark, table, tmpdir_path, compact):
    path, hist = os.path.join(tmpdir_path, "old"), os.path.join(tmpdir_path, "hist")
    for i, records in enumerate(BATCHES):
        table.upsert(batch(spark, *records), TS[i], compact=bool(compact))
        if compact == "every":
            table.compact(every=True)
        store.write_upsert(spark, batch(spark, *records), path, hist, TS[i])
        assert rows(table.read()) == rows(store.read(spark, path))
        assert rows(table.history()) == (rows(store.read(spark, hist)) if store.exists(spark, hist) else [])
    if compact is False:
        before = rows(table.read()), rows(table.history())
        table.compact(every=True)
        assert (rows(table.read()), rows(table.history())) == before


def test_a_reader_keeps_its_version(spark, table):
    table.upsert(batch(spark, *BATCHES[0]), TS[0])
    opened, at = table.read(), table.version()
    before = rows(opened)
    for i in (1, 2, 3):
        table.upsert(batch(spark, *BATCHES[i]), TS[i])
    table.compact(every=True)
    table.replace(batch(spark, ("z", "0", "z")), TS[5])
    assert rows(opened) == before == rows(table.read(at))
    assert [r[0] for r in rows(table.read())] == ["z"]


def test_of_two_writers_none_is_lost(spark, table):
    table.upsert(batch(spark, *BATCHES[0]), TS[0])
    errors = []

    def write(n):
        try:
            for i in range(3):
                SnapshotTable(spark, table.path, buckets=4).upsert(batch(spark, (f"w{n}-{i}", str(i), "x"), ("a", f"{n}{i}", "x")), TS[1 + i], f"{n}-{i}")
        except Exception as error:
            errors.append(error)
    threads = [threading.Thread(target=write, args=(n,)) for n in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    got = {r["id"]: r["value"] for r in table.read().collect()}
    assert set(got) == {"a", "b", "c", "d"} | {f"w{n}-{i}" for n in range(3) for i in range(3)}
    assert got["a"].endswith("2") and len(table.manifest()["tags"]) == 10


def test_a_lost_writer_publishes_on_top(spark, table, monkeypatch):
    table.upsert(batch(spark, ("a", "1", "x")), TS[0])
    publish, lost = SnapshotTable._publish, []

    def first_lose(self, manifest):
        if not lost:
            lost.append(1)
            SnapshotTable(spark, table.path, buckets=4).upsert(batch(spark, ("a", "5", "x"), ("q", "1", "x")), TS[1], compact=False)
        return publish(self, manifest)
    monkeypatch.setattr(SnapshotTable, "_publish", first_lose)
    table.upsert(batch(spark, ("a", "2", "x")), TS[2], compact=False)
    assert [r[:2] for r in rows(table.read())] == [("a", "2"), ("q", "1")]
    assert [r[1] for r in rows(table.history())] == ["1", "5"]
    assert publish(table, dict(table.manifest())) is False       # a version is published once


def test_replays_and_unchanged_rows_write_no_file(spark, table):
    table.upsert(batch(spark, *BATCHES[0]), TS[0], "t0")
    table.upsert(batch(spark, *BATCHES[1]), TS[1], "t1")
    n, before = files(table.path), rows(table.read())
    table.upsert(batch(spark, *BATCHES[1]), TS[2], "t1")                               # same tag
    table.upsert(batch(spark, *BATCHES[1]), TS[2], "t2", skip_unchanged=True)          # same rows, new tag
    assert files(table.path) == n and rows(table.read()) == before and "t2" in table.manifest()["tags"]
    table.upsert(batch(spark, ("a", "1", "x"), ("b", "10", "z")), TS[3], "t3", skip_unchanged=True, compact=False)
    new = [f for f in files(table.path) if f not in n]
    assert len(new) == 1 and spark.read.parquet(new[0]).count() == 1
    assert table.manifest()["commits"][new[0].split("commit=")[1].split("/")[0]]["batch"]


def test_without_a_tag_the_same_batch_of_one_time_is_one(spark, table):
    for _ in range(2):
        table.upsert(batch(spark, *BATCHES[0]), TS[0])
    table.upsert(batch(spark, ("x", "1", "x")), TS[0])
    assert len(table.manifest()["tags"]) == 2 and table.read().count() == 5


def test_bytes_written_follow_the_batch(spark, tmpdir_path):
    t = SnapshotTable(spark, os.path.join(tmpdir_path, "t"), buckets=4)
    t.upsert(spark.range(20_000).select(F.col("id").cast("string"), F.sha2(F.col("id").cast("string"), 256).alias("value"), F.lit("x").alias("council")), TS[0])
    before = {f: os.path.getsize(f) for f in files(t.path)}
    t.upsert(batch(spark, *[(str(i), "new", "x") for i in range(40)]), TS[1])
    new = {f: os.path.getsize(f) for f in files(t.path) if f not in before}
    assert set(before) <= set(files(t.path)) and sum(new.values()) < 0.05 * sum(before.values())
    assert t.read().where("value = 'new'").count() == 40 and t.read().count() == 20_000


def test_compaction_touches_only_heavy_buckets(spark, table):
    table.upsert(batch(spark, *[(str(i), "1", "x") for i in range(400)]), TS[0])
    for i in range(1, 5):
        table.upsert(batch(spark, ("7", str(i), "x")), TS[i], compact=False)
    m = table.manifest()
    table.most_commits = 3
    table.compact()
    after = table.manifest()
    changed = [b for b in after["buckets"] if after["buckets"][b] != m["buckets"][b]]
    assert len(changed) == 1 and len(after["buckets"][changed[0]]) == 1
    assert [r[1] for r in rows(table.history())] == ["1", "2", "3"]      # the first correction changed nothing


def test_missing_new_and_wider_columns(spark, table):
    table.upsert(batch(spark, ("a", 1, 5), ("b", 2, 6), schema="id string, value int, depth int"), TS[0], compact=False)
    table.upsert(batch(spark, ("a", 10_000_000_000, "lake"), schema="id string, value long, kind string"), TS[1], compact=False)
    table.upsert(batch(spark, ("b", "n/a", "pond"), schema="id string, value string, kind string"), TS[2], compact=False)
    want = [("a", "10000000000", "5", "lake"), ("b", "n/a", "6", "pond")]
    assert rows(table.read(), "id", "value", "depth", "kind") == want
    assert rows(table.history(), "id", "value", "depth", "kind") == [("a", "1", "5", None), ("b", "2", "6", None)]
    table.compact(every=True)
    assert rows(table.read(), "id", "value", "depth", "kind") == want
    assert rows(table.history(), "id", "value", "depth", "kind") == [("a", "1", "5", None), ("b", "2", "6", None)]


def test_wider_types():
    assert wider(T.IntegerType(), T.LongType()) == T.LongType()
    assert wider(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.LongType(), T.DoubleType()) == T.StringType()        # 2^63 - 1 is no double
    assert wider(T.DateType(), T.LongType()) == T.StringType()


def test_null_keys_match_nothing(spark, table):
    for i in range(2):
        table.upsert(batch(spark, (None, str(i), "x"), ("a", str(i), "x")), TS[i], compact=False)
    assert [r[:2] for r in rows(table.read())] == [("a", "1"), (None, "0"), (None, "1")]
    table.compact(every=True)
    assert [r[:2] for r in rows(table.read())] == [("a", "1"), (None, "0"), (None, "1")]


def test_changes_between_versions(spark, table):
    v0 = table.upsert(batch(spark, *BATCHES[0]), TS[0])
    first = {r["id"]: (r["old"], r["new"]) for r in table.changes(0, v0).collect()}
    assert set(first) == {"a", "b", "c", "d"} and all(old is None for old, _ in first.values())
    table.upsert(batch(spark, *BATCHES[1]), TS[1])
    table.compact(every=True)
    v2 = table.upsert(batch(spark, *BATCHES[2]), TS[2])
    got = {r["id"]: (r["old"], r["new"]) for r in table.changes(v0, v2).collect()}
    assert set(got) == {"a", "b", "c", "e"}
    assert got["b"][0]["value"] == "2" and got["b"][1]["value"] is None and got["e"][0] is None
    table.replace(batch(spark, ("z", "0", "z")), TS[5])
    with pytest.raises(ValueError):
        table.changes(v0)


def test_rebuild_reads_itself_and_keeps_history(spark, table):
    for i in range(3):
        table.upsert(batch(spark, *BATCHES[i]), TS[i], f"t{i}", compact=False)
    history = rows(table.history())
    table.replace(table.read().where("id <> 'b'"), TS[4])
    assert [r[0] for r in rows(table.read())] == ["a", "c", "d", "e"] and rows(table.history()) == history
    table.upsert(batch(spark, ("d", "9", "y")), TS[5], compact=False)
    assert len(rows(table.history())) == len(history) + 1


def test_vacuum_and_empty(spark, table):
    assert table.version() == 0 and table.read().columns == ["id", "created_at", "updated_at"]
    for i in range(3):
        table.upsert(batch(spark, *BATCHES[i]), TS[i], f"t{i}")
    table.compact(every=True)
    want = rows(table.read()), rows(table.history())
    assert table.vacuum() and (rows(table.read()), rows(table.history())) == want
    table.upsert(batch(spark, *BATCHES[3]), TS[4], "t3")
    table.upsert(batch(spark, schema=REC), TS[5], "t4")
    assert len(table.manifest()["tags"]) == 5 and len(rows(table.read())) == 6


def test_grouping_and_joining_tasks_grow_with_the_stored_bytes(spark, table, monkeypatch):
    from tarn.operators import joins
    v1 = table.upsert(batch(spark, *BATCHES[0]), TS[0], compact=False)
    v2 = table.upsert(batch(spark, *BATCHES[1]), TS[1], compact=False)
    plain = rows(table.read()), rows(table.history()), sorted(map(str, table.changes(v1, v2).collect()))
    monkeypatch.setattr(joins, "TASK_BYTES", 1 + table._bytes(table.manifest()) // 7)
    monkeypatch.setattr(joins, "FEW_TASKS", 2)
    for df in (table.read(), table.history()):
        assert "RepartitionByExpression [id" in df._jdf.queryExecution().optimizedPlan().toString()
    assert (rows(table.read()), rows(table.history()), sorted(map(str, table.changes(v1, v2).collect()))) == plain
    table.compact(every=True)
    assert (rows(table.read()), rows(table.history())) == plain[:2]
