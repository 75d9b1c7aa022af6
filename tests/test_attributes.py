import os

import pytest

from tarn.operators import attributes as A
from tarn.operators.snapshots import SnapshotTable

KV = "id string, name string, value string"


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), KV)


@pytest.mark.parametrize("values, kind", [
    (["1", "-20", "0"], "int"), (["1", "1234567890"], "bigint"), (["1", "2.50"], "double"), (["2.5", "1234567890"], "string"),
    (["1", "007"], "string"), (["1", "+1"], "string"), (["1", "1e5"], "string"), (["-0"], "string"), (["1", "x"], "string"), (["1", "", None], "int"),
    (["", None], "string"), (["123456789012345678"], "bigint"), (["1234567890123456789"], "string"), (["0.1234567890123456"], "string"),
    (["1\n"], "string"), (["٣"], "string")])
def test_kinds(spark, values, kind):
    rows = kv(spark, *[("r", "a", v) for v in values], ("r", None, "zzz"))
    assert A.typed_names(A.attribute_profile(rows)) == {"a": kind}


def test_profiles_add_up(spark):
    one, two = kv(spark, ("r", "a", "1"), ("r", "b", "x")), kv(spark, ("s", "a", "1.5"), ("s", "c", None))
    merged = A.merge_profiles(A.attribute_profile(one).unionByName(A.attribute_profile(two)))
    assert sorted(merged.collect()) == sorted(A.attribute_profile(one.unionByName(two)).collect())


def test_nothing_is_lost_beside_the_columns(spark):
    rows = kv(spark, ("r", "Depth", "1"), ("r", "depth", "2"), ("r", "id", "3"), ("r", "rare", "4"), ("s", "Depth", ""), ("s", "x", "5"),
              ("t", "x", "6"), ("t", "x", "7"), ("t", "x", None), (None, "x", "8"), ("u", None, "9"))
    types = A.typed_names(A.attribute_profile(rows), most=3)
    assert types == {"x": "int", "Depth": "int"}                # the third most frequent differs in case only
    got = {r["id"]: r.asDict() for r in A.pivot_typed(rows, types).collect()}
    assert got == {"r": {"id": "r", "x": None, "Depth": 1, "other": '{"depth":"2","id":"3","rare":"4"}'},
                   "s": {"id": "s", "x": 5, "Depth": None, "other": None}, "t": {"id": "t", "x": 7, "Depth": None, "other": None}}
    assert A.pivot_typed(rows.limit(0), types).count() == 0
    assert A.typed_names(A.attribute_profile(rows.limit(0))) == {}


def test_later_batches_widen_the_stored_columns(spark, tmpdir_path):
    table = SnapshotTable(spark, os.path.join(tmpdir_path, "t"), buckets=4)
    profiles = A.profile_table(spark, os.path.join(tmpdir_path, "p"))
    load = lambda n, *rows: A.load_attributes(kv(spark, *rows), table, profiles, f"2024-01-0{n} 00:00:00", f"b{n}", most=3)
    read = lambda: {r["id"]: r.asDict() for r in table.read().drop("created_at", "updated_at").collect()}
    load(1, ("r", "a", "1"), ("r", "b", "2"))
    assert read() == {"r": {"id": "r", "a": 1, "b": 2, "other": None}}
    load(2, ("s", "a", "1.5"), ("s", "b", "two"), ("s", "c", "12345678901"))
    load(2, ("s", "a", "9"))
    want = {"r": {"id": "r", "a": 1.0, "b": "2", "c": None, "other": None}, "s": {"id": "s", "a": 1.5, "b": "two", "c": 12345678901, "other": None}}
    assert read() == want
    # other names are more frequent now: the columns that exist stay
    load(3, *[(f"n{i}", "d", "1") for i in range(9)], ("u", "a", "4"), ("u", "d", "5"))
    got = read()
    assert {k: got[k] for k in "rs"} == want and got["u"] == {"id": "u", "a": 4.0, "b": None, "c": None, "other": '{"d":"5"}'}
    table.compact(every=True)
    assert read() == got
