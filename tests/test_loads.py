import os

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from tarn.operators.quality import check_dim_variables, violations
from tarn.operators.records import build_records, prepare_for_load, request_counts
from tarn.operators.snapshots import SnapshotTable
from tarn.plans import loads
from tarn.sources import testdata as td
from tarn.sources.landing import explode_responses

DIM = "id string, variable string, agency string"
RULES = {"not_null": ("id", "variable"), "accepted": {"agency": ["ac", "es"]}}


def dim(spark, *rows):
    return spark.createDataFrame(list(rows), DIM)


def held(table, *cols):
    return sorted((tuple(r[c] for c in cols) for r in table.read().collect()), key=str)


@pytest.fixture()
def tables(spark, tmpdir_path):
    return (SnapshotTable(spark, os.path.join(tmpdir_path, "dim"), buckets=4),
            SnapshotTable(spark, os.path.join(tmpdir_path, "bad"), key="row_id", buckets=4))


def test_violations_are_the_rows_behind_the_counts(spark):
    rows = dim(spark, ("a", "x", "ac"), ("a", "y", "zz"), (None, "x", None), (None, None, "es"), ("b", None, "es"), ("c", "z", "ac"))
    got = violations(rows, "id", **RULES)
    found = {(r["id"], r["variable"]): r["reasons"] for r in got.collect()}
    assert found == {("a", "x"): ["id repeats"], ("a", "y"): ["agency not accepted", "id repeats"], (None, "x"): ["id is null"],
                     (None, None): ["id is null", "variable is null"], ("b", None): ["variable is null"], ("c", "z"): []}
    counts = check_dim_variables(rows, "id", **RULES).first().asDict()
    flat = [x for r in found.values() for x in r]
    assert (counts["id_nulls"], counts["variable_nulls"], counts["agency_rejected"]) == (
        flat.count("id is null"), flat.count("variable is null"), flat.count("agency not accepted"))
    assert violations(rows.limit(0), "id", **RULES).count() == 0


def test_a_hot_key_is_reported_once_a_row(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
                                    F.lit("v").alias("variable"), F.lit("ac").alias("agency"))
    got = violations(rows, "id", **RULES)
    assert got.count() == 5000
    assert {r["id"] for r in got.where(F.size("reasons") > 0).select("id").distinct().collect()} == {"hot"}
    assert got.where(F.size("reasons") > 0).count() == 1667


def test_bad_rows_stay_out_and_are_kept(spark, tables):
    table, bad = tables
    loads.load_checked(dim(spark, ("a", "x", "ac"), ("b", "x", "zz"), ("c", "x", None)), table, bad, "2024-01-01 00:00:00", "one", **RULES)
    second = dim(spark, ("a", "new", "ac"), ("d", "x", "es"), ("e", "x", "es"), ("e", "x", "es"), (None, "x", "es"), (None, "x", "es"))
    version = loads.load_checked(second, table, bad, "2024-01-02 00:00:00", "two", **RULES)
    assert held(table, "id", "variable") == [("a", "x"), ("c", "x"), ("d", "x")]
    want = [("one", "b", "agency not accepted", 1), ("two", "a", "id is stored", 1), ("two", "e", "id repeats", 2), ("two", None, "id is null", 2)]
    assert held(bad, "batch_tag", "bad_key", "reasons", "n_rows") == sorted(want, key=str)
    assert loads.load_checked(second, table, bad, "2024-01-03 00:00:00", "two", **RULES) == version
    assert held(bad, "batch_tag", "bad_key", "reasons", "n_rows") == sorted(want, key=str)


def test_a_load_that_failed_half_way_ends_the_same(spark, tables, monkeypatch):
    table, bad = tables
    batch = dim(spark, ("a", "x", "ac"), ("b", None, "es"))
    whole = table.upsert
    monkeypatch.setattr(table, "upsert", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        loads.load_checked(batch, table, bad, "2024-01-01 00:00:00", "one", **RULES)
    assert bad.read().count() == 1 and table.version() == 0
    monkeypatch.setattr(table, "upsert", whole)
    loads.load_checked(batch, table, bad, "2024-01-01 00:00:00", "one", **RULES)
    assert held(table, "id") == [("a",)] and bad.read().count() == 1


def test_corrections_pass_where_inserts_are_not_asked_for(spark, tables):
    table, bad = tables
    loads.load_checked(dim(spark, ("a", "x", "ac")), table, bad, "2024-01-01 00:00:00", "one", **RULES)
    loads.load_checked(dim(spark, ("a", "y", "ac")), table, bad, "2024-01-02 00:00:00", "two", insert_only=False, **RULES)
    assert held(table, "id", "variable") == [("a", "y")] and bad.read().count() == 0


def test_stored_keys_are_read_from_the_buckets_of_the_batch(spark, tables):
    table, _ = tables
    many = spark.range(400).select(F.col("id").cast("string").alias("id"), F.lit("v").alias("variable"), F.lit("ac").alias("agency"))
    table.upsert(many, "2024-01-01 00:00:00", "one")
    known = table.known_keys(dim(spark, ("7", "v", "ac"), (None, "v", "ac")))
    assert known.where("id = '7'").count() == 1 and 1 < known.count() < 250
    files = {f.rsplit("/", 2)[1] for f in known.inputFiles()}
    scan = known._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string" in scan and "variable" not in scan.partition("ReadSchema")[2], files


def test_counts_are_those_of_the_load(spark, tmpdir_path):
    landed = td.landed_responses(spark, SF_SMALL)
    sites, transfer = td.sites_latest(spark, SF_SMALL), td.transfer_table(spark, SF_SMALL)
    table = SnapshotTable(spark, os.path.join(tmpdir_path, "lwq"))
    got = loads.load_responses(landed, sites, transfer, table, "2024-01-01 00:00:00", "one")
    obs = explode_responses(landed)
    assert got == request_counts(obs).first().asDict()
    want = prepare_for_load(build_records(obs, sites, transfer))
    assert table.read().select("id", "value").exceptAll(want.select("id", "value")).count() == 0
    assert table.read().count() == want.count()
    assert loads.load_responses(landed, sites, transfer, table, "2024-01-02 00:00:00", "one") is None
    empty = loads.load_responses(landed.limit(0), sites, transfer, table, "2024-01-02 00:00:00", "two")
    assert empty == {"n_requests": 0, "n_failed": 0}
