import datetime as dt

from pyspark.sql import functions as F

from tarn.operators.quality import check_dim_variables, validate_backfill
from tarn.plans import marts
from tarn.plans.serving import distinct_rows, load_log, map_centre, map_points

TS = dt.datetime(2024, 1, 2, 6, 0)


def records(spark):
    return spark.createDataFrame(
        [("r1", "20240101T000000", "100", "TN", "less_than_0.5", None, "u", "ecan", TS),
         ("r2", "2024-01-01T01:00:00", "100", "TN", "7", None, "u", "gw", TS),
         ("r3", "missing", "200", "TP", None, "HTTP error: 500", "u", "ecan", TS)],
        "id string, t string, site string, lawaname string, value string, error string, url string, "
        "council string, created_at timestamp_ntz").withColumn("variable", F.col("lawaname"))


def sites(spark):
    cols = ["councilsiteid", "siteid", "lawasiteid", "latitude", "longitude", "council"]
    df = spark.createDataFrame([("100", "S1", "L1", "-41", "174", "ecan"),
                                ("100", "S9", "L9", "-40", "175", "gw")], ", ".join(c + " string" for c in cols))
    from tarn import schemas as S
    for c in S.SITE_VARS + ["lawa_site"]:
        if c not in cols:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.withColumn("created_at", F.lit(dt.datetime(2023, 1, 1)).cast("timestamp_ntz"))


def test_site_join_compat_fans_out(spark):
    sound = marts.fact_records(records(spark), sites(spark), with_clock=False)
    compat = marts.fact_records(records(spark), sites(spark), compat=True, with_clock=False)
    assert sound.count() == 3
    assert compat.count() == 5          # site 100 exists in two councils
    r1 = sound.filter("id = 'r1'").first()
    assert r1["siteid"] == "S1" and r1["value_numeric"] == 0.5 and r1["adjusted_value"] == 0.25
    assert r1["censored"] == "less_than_."


def test_summary_and_errors(spark):
    facts = marts.fact_records(records(spark), sites(spark), with_clock=False)
    s = {r["siteid"]: r for r in marts.fact_summary(facts, sites(spark)).collect()}
    assert set(s) == {"S1", "S9"} and s["S1"]["total_records"] == 1 and s["S9"]["average_value"] == 7.0
    e = {(r["council"], r["error"]): r for r in marts.fact_summary_errors(facts).collect()}
    assert e[("ecan", "None")]["variables"] == ["TN"]
    # site 200 is not in the catalog: the council (the site's) is unknown
    assert e[(None, "HTTP error: 500")]["council_count"] == 0
    log = load_log(marts.fact_summary_errors(facts), "ecan").collect()
    assert [r["error"] for r in log] == ["None"]


def test_variables_compat_fans_out(spark):
    tr = spark.createDataFrame([("ecan", "TN"), ("gw", "TN")], "agency string, callname string")
    recs = records(spark)
    assert marts.dim_variables(recs, tr).count() == 3
    # r1 and r2 (TN) match both agencies; r3 (TP) matches none
    assert marts.dim_variables(recs, tr, compat=True).count() == 5
    chk = check_dim_variables(marts.dim_variables(recs, tr, compat=True)).first()
    assert chk["id_duplicates"] == 2 and chk["agency_nulls"] == 1 and chk["agency_rejected"] == 0


def test_distinct_rows_counts_nulls(spark):
    df = spark.createDataFrame([(None, "a", "b"), (None, "a", "b"), ("x", None, "b")],
                               "siteid string, lawasiteid string, councilsiteid string")
    assert distinct_rows(df).count() == 2


def test_backfill_rules(spark):
    d = dt.date
    req = spark.createDataFrame([
        ("ok", "ecan", d(2024, 1, 1), d(2024, 1, 31), ["TN"], ["a", "b"]),
        ("31d", "ecan", d(2024, 1, 1), d(2024, 2, 1), ["TN"], ["a"]),
        ("3sites", "ecan", d(2024, 1, 1), d(2024, 1, 2), ["TN", "TP"], ["a", "b", "c"]),
        ("empty", "ecan", d(2024, 1, 1), d(2024, 1, 2), [], ["a"]),
        ("back", "ecan", d(2024, 1, 5), d(2024, 1, 2), ["TN"], ["a"]),
    ], "request_id string, council string, start_date date, end_date date, params array<string>, sites array<string>")
    got = {r["request_id"]: (r["accepted"], r["reasons"]) for r in validate_backfill(req).collect()}
    assert got["ok"] == (True, [])
    assert got["31d"] == (False, ["more than 30 days"])
    assert got["3sites"] == (False, ["more than 2 sites"])
    assert got["empty"] == (False, ["missing field"])
    assert got["back"] == (False, ["end before start"])


def test_increment_null_mark_takes_all(spark):
    recs = records(spark)
    empty = marts.fact_records(recs.limit(0), sites(spark), with_clock=False)
    assert marts.new_since(recs, empty).count() == 3
    full = marts.fact_records(recs, sites(spark), with_clock=False)
    # rows of the mark's own time are taken again, later ones too, earlier ones not
    assert marts.new_since(recs, full).count() == 3
    late = recs.withColumn("created_at", F.when(F.col("id") == "r1", F.lit(dt.datetime(2024, 1, 1))).otherwise(F.col("created_at")).cast("timestamp_ntz"))
    assert marts.new_since(late, full).count() == 2
    assert marts.new_since(late, full, full_refresh=True).count() == 3


def test_corrections_reach_the_mart(spark):
    recs = records(spark).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    mart = marts.fact_records(recs, sites(spark), with_clock=False)
    fixed = (recs.withColumn("value", F.when(F.col("id") == "r2", F.lit("9")).otherwise(F.col("value")))
             .withColumn("updated_at", F.when(F.col("id") == "r2", F.lit(dt.datetime(2024, 3, 1))).cast("timestamp_ntz")))
    merged = marts.merge_mart(mart, marts.fact_records(marts.new_since(fixed, mart), sites(spark), with_clock=False))
    assert sorted((r["id"], r["raw_value"]) for r in merged.collect()) == [("r1", "less_than_0.5"), ("r2", "9"), ("r3", None)]
    again = marts.merge_mart(merged, marts.fact_records(marts.new_since(fixed, merged), sites(spark), with_clock=False))
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_daily_diagnostics_accumulate(spark):
    day = lambda d, n: (dt.date(2024, 1, d) if d else None, "ecan", n)
    schema = "created_at_date date, council string, error_count long"
    old = spark.createDataFrame([day(1, 1), day(2, 2), day(None, 3)], schema)
    out = marts.accumulate_daily(old, spark.createDataFrame([day(2, 5), day(None, 7)], schema))
    assert sorted((str(r[0]), r[2]) for r in out.collect()) == [("2024-01-01", 1), ("2024-01-02", 5), ("None", 7)]


def test_checks_after_a_build(spark):
    import pytest
    from tarn.operators.quality import checked
    tr = spark.createDataFrame([("ecan", "TN")], "agency string, callname string")
    dim = marts.dim_variables(records(spark), tr)
    _, failed = checked(dim, check_dim_variables(dim))
    assert failed == ["agency_nulls", "callname_nulls"]
    with pytest.raises(ValueError):
        checked(dim, check_dim_variables(dim), strict=True)


def test_map_points_and_centre(spark):
    df = spark.createDataFrame([("b", "x", "y", "-41.5", "174", 2.0), ("a", "x", "y", "-99999", "abc", None)],
                               "councilsiteid string, siteid string, lawasiteid string, latitude string, "
                               "longitude string, average_value double")
    pts = map_points(df).collect()
    assert len(pts) == 1 and pts[0]["average_size"] == 20.0 and pts[0]["latitude"] == -41.5
    assert map_centre(map_points(df)).first()["longitude"] == 174.0
    assert map_centre(map_points(df.limit(0))).count() == 0


def test_unpivot(spark):
    df = spark.createDataFrame([(1, "a", 3)], "id int, x string, n int")
    got = sorted(tuple(r) for r in marts.unpivot_metadata(df).collect())
    assert got == [(1, "n", "3"), (1, "x", "a")]


def test_call_names_alone_are_joined_without_a_distinct_of_the_many_rows(spark):
    from tarn.plans.marts import dim_variables
    rec = spark.createDataFrame([("a", "tn", "x", 1), ("a", "tn", "y", 1), ("a", "tn", "x", 1), ("b", None, None, 2), ("b", None, "x", 2), (None, "zz", "x", None)],
                                "id string, variable string, council string, created_at long")
    transfer = spark.createDataFrame([("x", "tn"), ("y", "tn"), ("x", "tn"), (None, "tn"), ("x", None)], "agency string, callname string")
    out = dim_variables(rec, transfer, compat=True)
    tn = [("a", "tn", 1, agency, "tn") for agency in ("x", "y", None)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([*tn, ("b", None, 2, None, None), (None, "zz", None, None, None)], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not plan.lstrip().startswith("Aggregate")      # the distinct rows are made before the join
    assert sorted(map(tuple, dim_variables(rec, transfer).collect()), key=str) == sorted(
        [("a", "tn", 1, "x", "tn"), ("a", "tn", 1, "y", "tn"), ("b", None, 2, None, None), (None, "zz", None, None, None)], key=str)


def test_summary_states_are_merged_without_the_joins_that_made_them(spark):
    from tarn.plans import increments as inc
    facts = marts.fact_records(records(spark), sites(spark), with_clock=False)
    before = inc.summary_state(facts, sites(spark))
    out = inc.update_summary(before, facts, facts, sites(spark), facts)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, out.collect())) == sorted(map(str, before.select(*out.columns).collect()))
