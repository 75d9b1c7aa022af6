import os

import pytest
from pyspark.sql import functions as F

from tarn.operators import store

TS1, TS2, TS3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
REC = "id string, value string, council string"


def rows(df, *cols):
    return sorted((tuple(str(r[c]) if r[c] is not None else None for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))


def whole(spark, path):
    """Every column of a stored table but the internal ones."""
    return rows(store.read(spark, path), "id", "value", "council", "created_at", "updated_at")


@pytest.fixture()
def paths(tmpdir_path):
    return os.path.join(tmpdir_path, "lwq"), os.path.join(tmpdir_path, "hist")


def batch(spark, *records):
    return spark.createDataFrame(list(records), REC)


def test_upsert_cases(spark):
    target = batch(spark, ("a", "1", "x"), ("b", "2", "x"), ("c", None, "x"), ("d", "4", "y")).withColumn(
        "created_at", F.lit(TS1).cast("timestamp_ntz"))
    source = batch(spark, ("a", "1", "x"), ("b", "9", "x"), ("c", "3", "x"), ("e", "5", "y"))
    up = store.upsert(target, source, "id", TS2, "t2")
    got = {r["id"]: (r["value"], str(r["created_at"]), str(r["updated_at"])) for r in up.collect()}
    assert got["a"] == ("1", TS1, TS2) and got["b"] == ("9", TS1, TS2)
    assert got["d"] == ("4", TS1, "None") and got["e"] == ("5", TS2, "None")
    hist = store.history_rows(target, source, "id", "value", TS2)
    # only a changed, non-null value writes history (NULL-unsafe compare)
    assert rows(hist, "id", "value") == [("b", "2")]
    # upsert twice = once, in every column
    again = store.upsert(up, source, "id", TS3, "t2")
    assert rows(again, *up.columns) == rows(up, *up.columns)
    assert store.history_rows(up, batch(spark, ("b", "7", "x")), "id", "value", TS3, "t2").collect() == []


def test_insert_missing_and_evolve(spark):
    target, source = batch(spark, ("a", "1", "x")), batch(spark, ("a", "7", "x"), ("b", "2", "y"))
    assert rows(store.insert_missing(target, source), "id", "value") == [("a", "1"), ("b", "2")]
    ev = store.evolve(target, source.withColumn("extra", F.lit("e")))
    assert rows(ev, "id", "value", "extra") == [("a", "1", None), ("a", "7", "e"), ("b", "2", "e")]


def test_replace_slice_frame(spark):
    latest = spark.createDataFrame([("1", "ecan"), ("2", "ES"), ("3", "gw"), ("4", None)], "s string, council string")
    new = spark.createDataFrame([("9", "es"), ("8", "Ecan"), ("7", None)], "s string, council string")
    out = store.replace_slice(latest, new)
    assert rows(out, "s") == [("3",), ("7",), ("8",), ("9",)]
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_two_batches_history_and_replay(spark, paths):
    path, hist = paths
    store.write_upsert(spark, batch(spark, ("a", "<1", "x"), ("b", "2", "y")), path, hist, TS1)
    second = batch(spark, ("a", "5", "x"), ("c", "3", "x"))
    store.write_upsert(spark, second, path, hist, TS2)
    want = [("a", "5", "x", TS1, TS2), ("b", "2", "y", TS1, None), ("c", "3", "x", TS2, None)]
    want_hist = [("a", "less_than_1", "x", TS1, TS2)]
    assert whole(spark, path) == want and whole(spark, hist) == want_hist
    store.write_upsert(spark, second, path, hist, TS2)               # the same batch again
    assert whole(spark, path) == want and whole(spark, hist) == want_hist
    store.write_upsert(spark, batch(spark, ("a", "6", "x")), path, hist, TS2)   # another batch of the same time
    assert whole(spark, path)[0] == ("a", "6", "x", TS1, TS2)
    assert [r[1] for r in whole(spark, hist)] == ["5", "less_than_1"]


def test_retry_after_a_crash_between_history_and_table(spark, paths):
    path, hist = paths
    store.write_upsert(spark, batch(spark, ("a", "1", "x"), ("b", "2", "x")), path, hist, TS1, batch_tag="q-0")
    new = batch(spark, ("a", "7", "x"), ("b", "8", "x"))
    target = store.read(spark, path, internal=True)
    # the first attempt got as far as the history of one row
    store.append(store.history_rows(target, new, "id", "value", TS2, "q-1").filter("id = 'a'").drop(store.BUCKET), hist, TS2, None)
    store.write_upsert(spark, new, path, hist, TS2, batch_tag="q-1")
    assert rows(store.read(spark, hist), "id", "value") == [("a", "1"), ("b", "2")]
    assert rows(store.read(spark, path), "id", "value") == [("a", "7"), ("b", "8")]


def test_null_council_case_and_move_lose_nothing(spark, paths):
    path, hist = paths
    store.write_upsert(spark, batch(spark, ("a", "1", None), ("b", "2", None), ("c", "3", "ECan"), ("d", "4", "es")), path, hist, TS1)
    store.write_upsert(spark, batch(spark, ("b", "9", None), ("c", "8", "ecan"), ("d", "7", "gw")), path, hist, TS2)
    assert rows(store.read(spark, path), "id", "value", "council") == [("a", "1", None), ("b", "9", None), ("c", "8", "ecan"), ("d", "7", "gw")]


def test_only_touched_buckets_are_rewritten(spark, paths):
    path, _ = paths
    many = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit("1").alias("value"), F.lit("x").alias("council"))
    store.write_upsert(spark, many, path, None, TS1)

    def files():
        return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = files()
    assert len(before) <= 2 * store.BUCKETS
    store.write_upsert(spark, batch(spark, ("k7", "2", "x")), path, None, TS2)
    after = files()
    assert len(set(before) - set(after)) == 1 and len(set(after) - set(before)) == 1
    assert store.read(spark, path).count() == 2000
    plan = store.read(spark, path, internal=True).filter(F.col(store.BUCKET) == "0003")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_staging_is_removed_and_session_untouched(spark, paths):
    path, hist = paths
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    folder = os.path.join(spark.conf.get("spark.checkpoint.dir"), "staging")
    count = lambda: len(os.listdir(folder)) if os.path.isdir(folder) else 0
    before = count()
    store.write_upsert(spark, batch(spark, ("a", "1", "x")), path, hist, TS1)
    assert count() == before and spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_schema_evolves_on_the_stored_table(spark, paths):
    path, _ = paths
    store.write_upsert(spark, batch(spark, ("a", "1", "x"), ("b", "2", "x")), path, None, TS1)
    store.write_upsert(spark, batch(spark, ("a", "3", "x")).withColumn("extra", F.lit("e")), path, None, TS2)
    assert rows(store.read(spark, path), "id", "value", "extra") == [("a", "3", "e"), ("b", "2", None)]


def test_full_rebuild_drops_old_partitions(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    store.full_rebuild(batch(spark, ("a", "1", "x"), ("b", "2", "y")), path, "council")
    store.full_rebuild(store.read(spark, path).filter("council = 'y'"), path, "council")     # reads itself
    assert rows(store.read(spark, path), "id", "value", "council") == [("b", "2", "y")]


def test_create_if_absent(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    schema = spark.createDataFrame([], "id string, t string, council string").schema
    assert store.create_if_absent(spark, path, schema, ["t"]) and not store.create_if_absent(spark, path, schema)
    empty = store.read(spark, path)
    assert empty.count() == 0 and dict(empty.dtypes) == {"id": "string", "t": "timestamp_ntz", "council": "string", "created_at": "timestamp_ntz"}
    store.append(spark.createDataFrame([("a", TS1, "x")], "id string, t string, council string"), path, TS2)
    assert rows(store.read(spark, path), "id", "t", "created_at") == [("a", TS1, TS2)]


def test_load_dispatch_and_latest(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "wfs")
    s = "s string, council string"
    assert store.load(spark, spark.createDataFrame([], s), path, TS1) is False
    with pytest.raises(ValueError):
        store.load(spark, spark.createDataFrame([], s), path, TS1, "merge")
    store.load(spark, spark.createDataFrame([("1", "Ecan"), ("2", "es"), ("3", "gw")], s), path, TS1)
    store.load(spark, spark.createDataFrame([("9", "ECAN"), ("8", "es")], s), path, TS2)
    assert store.read(spark, path).count() == 5
    latest = store.read(spark, path + "_latest")
    assert rows(latest, "s", "council", "created_at") == [("3", "gw", TS1), ("8", "es", TS2), ("9", "ecan", TS2)]
    up = os.path.join(tmpdir_path, "up")
    assert store.load(spark, batch(spark, ("a", "1", "x")), up, TS1, "upsert")
    assert rows(store.read(spark, up), "id", "created_at") == [("a", TS1)]


def test_insert_if_absent_write(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    store.write_insert_missing(spark, batch(spark, ("a", "1", "x")), path, TS1)
    store.write_insert_missing(spark, batch(spark, ("a", "2", "x"), ("b", "3", "x")), path, TS2)
    assert rows(store.read(spark, path), "id", "value") == [("a", "1"), ("b", "3")]


def test_keep_first_is_an_aggregate_not_a_window(spark):
    from tarn.operators.dedup import keep_first
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z")], "k string, o int, v string")
    out = keep_first(df, ["k"], ["o"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan and "min_by" not in plan
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1, "y"), ("b", 1, "z")]
    with_map = df.withColumn("m", F.create_map(F.lit("v"), "v"))
    assert sorted((r["k"], r["m"]["v"]) for r in keep_first(with_map, ["k"], [-F.col("o")]).collect()) == [("a", "x"), ("b", "z")]
