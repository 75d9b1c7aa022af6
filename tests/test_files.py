import os

from tarn.operators.projection import TRADE_FIELDS, WEATHER_FIELDS, select_rename
from tarn.sources.files import read_csv_column


def test_csv_column(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "cities.csv")
    with open(path, "w") as f:
        f.write("city_name\nnelson\ntimaru\ngore\n")
    assert [r[0] for r in read_csv_column(spark, path, "city_name").collect()] == ["nelson", "timaru", "gore"]


def test_select_rename(spark):
    df = spark.createDataFrame([(7, 1700000000, "Timaru", 11.25, "unused")],
                               "id long, dt long, name string, `main.temp` double, extra string")
    assert [r.asDict() for r in select_rename(df, WEATHER_FIELDS).collect()] == [
        {"id": 7, "datetime": 1700000000, "name": "Timaru", "temperature": 11.25}]
    t = spark.createDataFrame([("kea", 5, "2024-06-01 10:00:00Z", "N", 3.75, 400, "unused")],
                              "stock_ticker string, i int, t string, x string, p double, s int, extra string")
    assert list(select_rename(t, TRADE_FIELDS).first().asDict()) == \
        ["stock_ticker", "id", "timestamp", "exchange", "price", "size"]


def test_named_sources(spark, tmpdir_path):
    import pytest
    from tarn.operators.store import append
    from tarn.sources.registry import RAW_TABLES, Sources
    sources = Sources(tmpdir_path, RAW_TABLES, {"raw.list_of_urls": os.path.join(tmpdir_path, "elsewhere")})
    append(spark.createDataFrame([("a", "x")], "id string, council string"), sources.path("raw", "lwq_data"), "2024-01-01 00:00:00")
    assert [r["id"] for r in sources.read(spark, "raw", "lwq_data").collect()] == ["a"]
    assert sources.path("raw", "list_of_urls").endswith("elsewhere")
    with pytest.raises(KeyError):
        sources.path("raw", "nothing")


def test_csv_of_one_site_list_caps_and_case(spark):
    from tarn.operators.manifest import cap_sites
    from tarn.operators.sites import in_councils, lower_columns
    df = spark.createDataFrame([("b", "ECan"), ("a", "ECan"), ("c", "gw")], "councilsiteid string, council string")
    assert sorted(r[0] for r in cap_sites(df, 1).collect()) == ["a", "c"] and cap_sites(df, None).count() == 3
    assert in_councils(df, ["ecan"]).count() == 2
    assert lower_columns(df.toDF("CouncilSiteID", "COUNCIL")).columns == ["councilsiteid", "council"]
    with __import__("pytest").raises(ValueError):
        lower_columns(df.toDF("A", "a"))


def test_two_councils_with_one_site_id(spark):
    """An unmatched site id that two councils use gives two records."""
    from tarn.operators.records import build_records
    obs = spark.createDataFrame([("u1", 200, None, "100", "TN", c, "20240101T000000", "1", "2024-01-01", "2030-01-01") for c in ("ecan", "gw")],
                                "url string, status_code int, error string, site string, variable string, council string, t string, value string, date_start string, date_end string")
    sites = spark.createDataFrame([], "councilsiteid string, lawasiteid string, council string")
    transfer = spark.createDataFrame([], "agency string, callname string, lawaname string")
    assert sorted(r["id"] for r in build_records(obs, sites, transfer).collect()) == [
        "unknown-ecan_100_TN_20240101T000000", "unknown-gw_100_TN_20240101T000000"]


def test_an_agency_with_two_roots(spark):
    from tarn.operators.manifest import build_manifest
    sites = spark.createDataFrame([("ecan", "1")], "council string, councilsiteid string")
    transfer = spark.createDataFrame([("ecan", "TN", "TN")], "agency string, callname string, lawaname string")
    urls = spark.createDataFrame([("ecan", "w", "https://b"), ("ecan", "w", "https://a")], "agency string, wfs string, soslwq string")
    assert [r["url"][:9] for r in build_manifest(sites, transfer, urls, "2024-01-01").collect()] == ["https://a"]
