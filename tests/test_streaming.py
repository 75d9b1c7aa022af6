import os

from pyspark.sql import functions as F

from paths import SF_SMALL
from tarn.operators.store import read
from tarn.operators.records import build_records, prepare_for_load
from tarn.sources import testdata as td
from tarn.sources.landing import explode_responses
from tarn.streaming.ingest import ingest


def test_ingest_keeps_late_data(spark, tmpdir_path):
    landed = td.landed_responses(spark, SF_SMALL)
    sites, transfer = td.sites_latest(spark, SF_SMALL), td.transfer_table(spark, SF_SMALL)
    land = os.path.join(tmpdir_path, "landing")
    table, hist, ck = (os.path.join(tmpdir_path, n) for n in ("lwq", "hist", "ck"))
    late = F.col("date_start") < "2024-01-15"
    # first run: only recent responses; second run: older ones arrive late
    landed.filter(~late).write.mode("append").parquet(land)
    ingest(spark, land, table, hist, ck, sites, transfer, batch_ts="2024-02-01 00:00:00")
    first = read(spark, table).count()
    landed.filter(late).write.mode("append").parquet(land)
    ingest(spark, land, table, hist, ck, sites, transfer, batch_ts="2024-02-02 00:00:00")
    got = read(spark, table)
    want = prepare_for_load(build_records(explode_responses(landed), sites, transfer))
    assert got.count() > first
    assert got.select("id", "value").exceptAll(want.select("id", "value")).count() == 0
    assert want.select("id", "value").exceptAll(got.select("id", "value")).count() == 0
    # a third run with nothing new changes nothing
    ingest(spark, land, table, hist, ck, sites, transfer, batch_ts="2024-02-03 00:00:00")
    assert read(spark, table).count() == got.count()


def test_a_new_checkpoint_loses_no_history(spark, tmpdir_path):
    """Batch numbers start at 0 again; history and corrections stay."""
    landed = td.landed_responses(spark, SF_SMALL).filter("status_code = 200 AND variable <> 'error'").orderBy("url").limit(20)
    sites, transfer = td.sites_latest(spark, SF_SMALL), td.transfer_table(spark, SF_SMALL)
    table, hist = (os.path.join(tmpdir_path, n) for n in ("lwq", "hist"))
    for n, value in enumerate(["<Value>1</Value>", "<Value>2</Value>", "<Value>3</Value>"]):
        land = os.path.join(tmpdir_path, f"landing{n}")
        landed.withColumn("body", F.regexp_replace("body", "<Value>[^<]*</Value>", value)).write.parquet(land)
        ingest(spark, land, table, hist, os.path.join(tmpdir_path, f"ck{n}"), sites, transfer, batch_ts=f"2024-02-0{n + 1} 00:00:00")
    ids = read(spark, table).count()
    assert {r["value"] for r in read(spark, table).collect()} == {"3"}
    assert read(spark, hist).groupBy("value").count().orderBy("value").collect() == [("1", ids), ("2", ids)]


def test_diagnostics_of_a_stateful_stream(spark, tmpdir_path, monkeypatch):
    """Two loads, the older periods second, some responses landed twice,
    one file a trigger; a batch that fails after its write, and restarts."""
    import pytest
    from tarn.plans import increments as inc
    from tarn.plans.marts import fact_records, fact_summary_errors
    from tarn.streaming import diagnostics as D

    sites, transfer = td.sites_latest(spark, SF_SMALL), td.transfer_table(spark, SF_SMALL)
    landed = td.landed_responses(spark, SF_SMALL).repartition(2, "url").cache()
    late, again = F.col("date_start") < "2024-01-15", F.col("site").endswith("7")
    at = lambda df, day: df.withColumn("created_at", F.lit(f"2024-03-0{day} 06:00:00").cast("timestamp_ntz"))
    loads = [at(landed.where(~late), 1), at(landed.where(late | again), 2)]
    land, ck = (os.path.join(tmpdir_path, n) for n in ("landing", "ck"))
    table, numbers = D.diagnostics_table(spark, os.path.join(tmpdir_path, "a2")), inc.number_sites(sites)
    run = lambda: D.stream_diagnostics(spark, land, table, ck, sites, transfer, numbers, "2024-03-05 00:00:00", max_files=1)

    def rows(df):
        return sorted((tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=str)

    def want(df):
        firsts = prepare_for_load(build_records(explode_responses(df), sites, transfer))
        return rows(fact_summary_errors(fact_records(firsts, sites, with_clock=False)))

    loads[0].write.mode("append").parquet(land)
    run()
    assert rows(D.read_diagnostics(table)) == want(loads[0])

    loads[1].write.mode("append").parquet(land)
    whole = table.upsert

    def written_then_lost(*args, **kw):
        whole(*args, **kw)
        raise RuntimeError("driver lost")
    monkeypatch.setattr(table, "upsert", written_then_lost)
    with pytest.raises(Exception, match="driver lost"):
        run()
    monkeypatch.setattr(table, "upsert", whole)
    run()
    # a record keeps the day of its first load
    everything = loads[0].unionByName(at(landed.where(late), 2))
    assert rows(D.read_diagnostics(table)) == want(everything)
    before = rows(table.read())
    run()
    assert rows(table.read()) == before
