"""Adaptors: deterministic lake-monitoring tables derived from the testdata.

No lake data ships with the reference, so every rule runs on projections
of the TPC-H-like tables (FIXTURES.md section 3):

* sites   = customer x nation x region (c_custkey is the council site id,
            the nation is the council),
* variables each council measures = the event types seen at its sites,
* observations = events (user_id is the site, event_type the variable),
  one daily load per event day,
* upsert batches = lineitem keyed by (orderkey, linenumber), split by
  ship date into an older and a newer, overlapping batch.

Every adaptor is a lazy DataFrame over whole tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn import schemas as S
from tarn.functions.values import is_true_flag
from tarn.operators.joins import dim_join
from tarn.session import stored_table

# Site-catalog load time (a batch parameter of the catalog load).
SITE_LOAD_TS = "2024-01-01 00:00:00"
# Upsert adaptor: target holds rows shipped before TARGET_END, the new
# batch rows shipped from SOURCE_START on; the overlap gives matches.
TARGET_END = "1999-01-01"
SOURCE_START = "1998-01-01"
UPSERT_BATCH_TS = "2002-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def council_col(n_name="n_name"):
    return F.lower(F.col(n_name))


def sos_root(council):
    return F.concat(F.lit("https://"), council,
                    F.lit(".example.org/sos?service=SOS&request=GetObservation"))


def wfs_root(council):
    return F.concat(F.lit("https://"), council,
                    F.lit(".example.org/wfs?service=WFS&request=GetFeature"))


def list_of_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX3: agency -> WFS and SOS endpoints; some agencies list a second,
    later root."""
    agency = council_col()
    nation = table(spark, sf_dir, "nation")
    return nation.select(agency.alias("agency"), wfs_root(agency).alias("wfs"), sos_root(agency).alias("soslwq")).unionByName(
        nation.filter("n_nationkey % 4 = 0").select(agency.alias("agency"), wfs_root(agency).alias("wfs"),
                                                    F.concat(F.lit("https://zz-mirror-"), agency, F.lit("/sos?")).alias("soslwq")))


def site_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed site catalog of every council (FX5 columns, all text)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    geo = dim_join(nation, region, nation.n_regionkey == region.r_regionkey, "inner")
    cust = table(spark, sf_dir, "customer")
    # Some site ids are in the catalog of a second council too, and some
    # sites stand twice in their own council's catalog.
    second = cust.filter("c_custkey % 10 = 0").withColumn("c_nationkey", (F.col("c_nationkey") + 1) % 25)
    cust = (cust.withColumn("copy", F.lit(0)).unionByName(second.withColumn("copy", F.lit(0)))
            .unionByName(cust.filter("c_custkey % 15 = 0").withColumn("copy", F.lit(1))))
    c = dim_join(cust, geo, cust.c_nationkey == geo.n_nationkey, "inner")
    key = F.col("c_custkey").cast("string")
    council = council_col()
    frac = F.lpad(key, 6, "0")
    return c.select(
        key.alias("councilsiteid"),
        F.concat(F.lit("site-"), key).alias("siteid"),
        F.concat(F.lit("lawa-"), council, F.lit("-"), key).alias("lawasiteid"),
        (F.col("c_custkey") + F.lit(40000)).cast("string").alias("lfenzid"),
        F.col("c_mktsegment").alias("ltype"),
        F.when(F.col("c_acctbal") < 0, F.lit("Riverine")).otherwise(F.lit("Glacial")).alias("geomorphicltype"),
        F.col("r_name").alias("region"),
        council.alias("agency"),
        F.concat(F.col("c_name"), F.when(F.col("copy") == 1, F.lit(" (old)")).otherwise(F.lit(""))).alias("catchment"),
        F.when(F.col("c_acctbal") > 0, F.lit("Yes")).otherwise(F.lit("No")).alias("lwquality"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("yes")).otherwise(F.lit("no")).alias("macro"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("TRUE")).otherwise(F.lit("false")).alias("swquality"),
        F.concat(F.lit("-"), (F.col("c_nationkey") + F.lit(35)).cast("string"), F.lit("."), frac).alias("latitude"),
        F.concat((F.col("n_regionkey") + F.lit(166)).cast("string"), F.lit("."), frac).alias("longitude"),
        council.alias("council"),
        wfs_root(council).alias("url"),
        F.lit("success").alias("status"),
        council.alias("partition_key"),
    )


def build_sites_latest(spark: SparkSession, sf_dir: str, module: str = "lwq") -> DataFrame:
    from tarn.operators.sites import route_module
    return route_module(site_catalog(spark, sf_dir), module,
                        loaded_at=F.lit(SITE_LOAD_TS).cast("timestamp_ntz"))


def sites_latest(spark: SparkSession, sf_dir: str, module: str = "lwq") -> DataFrame:
    """FX5 `{module}_wfs_table_latest`: the module's sites, one per key
    (kept as a table, as the site job stores it)."""
    return stored_table(spark, f"{module}_wfs_table_latest",
                        lambda: build_sites_latest(spark, sf_dir, module), sf_dir)


def _site_of_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the council of their site (NULL for a site in no catalog)."""
    ev = table(spark, sf_dir, "events")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", council_col().alias("council"))
    sites = dim_join(cust, nat, cust.c_nationkey == nat.n_nationkey, "inner").select("c_custkey", "council")
    return dim_join(ev, sites, ev.user_id == sites.c_custkey, "left")


def transfer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4 (kept as a table)."""
    return stored_table(spark, "transfer_table", lambda: build_transfer_table(spark, sf_dir), sf_dir)


def build_transfer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4: (agency, callname) -> lawaname for every variable a council measures."""
    pairs = (_site_of_event(spark, sf_dir)
             .select(F.col("council").alias("agency"), F.col("event_type").alias("callname"))
             .distinct())
    return pairs.select("agency", "callname", F.upper("callname").alias("lawaname"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1 after explode and classification: one row per measurement or
    per failed request; one daily load per event day."""
    ev = _site_of_event(spark, sf_dir)
    site = F.col("user_id").cast("string")
    day = F.date_format("ts", "yyyy-MM-dd")
    failed = F.col("event_type") == "error"
    empty = failed & (F.col("value") < 5)
    eid = F.col("event_id")
    num = F.col("value").cast("decimal(18,2)").cast("string")
    value = (F.when(eid % 11 == 0, F.concat(F.lit("<"), num))
             .when(eid % 13 == 0, F.concat(F.lit(">"), num))
             .when(eid % 17 == 0, F.lit("None"))
             .when(eid % 19 == 0, F.lit("NA"))
             .when(eid % 23 == 0, F.lit("*"))
             .when(eid % 29 == 0, F.lit(""))
             .otherwise(num))
    t = (F.when(eid % 37 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
         .when(eid % 2 == 0, F.date_format("ts", S.TIME_FORMAT_COMPACT))
         .otherwise(F.date_format("ts", S.TIME_FORMAT_ISO)))
    url = F.concat(sos_root(F.col("council")), F.lit("&From="), day, F.lit("&To="),
                   F.lit(S.DEFAULT_DATE_END), F.lit("&Site="), site,
                   F.lit("&Measurement="), F.col("event_type"))
    return ev.select(
        url.alias("url"),
        F.when(failed & ~empty, F.lit(500)).otherwise(F.lit(200)).alias("status_code"),
        F.when(empty, F.lit(S.NO_DATA_ERROR))
         .when(failed, F.lit(S.HTTP_ERROR_PREFIX + "500")).alias("error"),
        site.alias("site"),
        F.col("event_type").alias("variable"),
        F.col("council"),
        F.when(failed, F.lit(S.MISSING_TIME)).otherwise(t).alias("t"),
        F.when(failed, F.lit(None).cast("string")).otherwise(value).alias("value"),
        F.when(failed, F.lit(None)).otherwise(
            F.create_map(F.lit("EventId"), eid.cast("string"),
                         F.lit("Props"), F.col("props"))).alias("params"),
        day.alias("date_start"),
        F.lit(S.DEFAULT_DATE_END).alias("date_end"),
        (F.to_timestamp_ntz(day) + F.expr("INTERVAL 30 HOURS")).alias("created_at"),
    )


def build_raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX6 `lwq_data` as the records pipeline loads it from the daily runs."""
    from tarn.operators.records import build_records, prepare_for_load
    recs = build_records(observations(spark, sf_dir), sites_latest(spark, sf_dir),
                         transfer_table(spark, sf_dir))
    return prepare_for_load(recs)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX6 `lwq_data` (kept as a table; the marts read it)."""
    return stored_table(spark, "lwq_data", lambda: build_raw_records(spark, sf_dir), sf_dir)


# --- lineitem upsert adaptor -------------------------------------------------

def _line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_returnflag").alias("council"),
        "l_quantity", "l_shipdate")


def upsert_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing table: one row per key from the rows shipped before TARGET_END."""
    v = _line_versions(spark, sf_dir).filter(F.col("l_shipdate") < F.lit(TARGET_END).cast("timestamp_ntz"))
    return (v.groupBy("id")
            .agg(F.max("l_quantity").cast("decimal(18,2)").cast("string").alias("value"),
                 F.min("council").alias("council"),
                 F.max("l_shipdate").alias("created_at")))


def upsert_source(spark: SparkSession, sf_dir: str, bump: float = 0.0) -> DataFrame:
    """New batch: one row per key from the rows shipped from SOURCE_START on."""
    v = _line_versions(spark, sf_dir).filter(F.col("l_shipdate") >= F.lit(SOURCE_START).cast("timestamp_ntz"))
    return (v.groupBy("id")
            .agg((F.min("l_quantity") + F.lit(bump)).cast("decimal(18,2)").cast("string").alias("value"),
                 F.min("council").alias("council")))


# --- landed bodies (round-trip adaptors for S1-S5) ----------------------------

PAGE_EVENTS = 65536    # events per measurement response page
PAGE_SITES = 500       # features per catalog page
CATALOG_TS = "2024-01-01 00:00:00"


def xml_text(c):
    """Escape text for an XML element or attribute ('&' first)."""
    for ch, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(ch), F.lit(ent))
    return c


def landed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1: one landed response per (site, variable, ten days, page) of events.
    Error-type groups are failed requests: HTTP 500, or 200 with an empty
    `Data` block when their smallest value is under 5."""
    ev = _site_of_event(spark, sf_dir).select(
        "event_id", "ts", "user_id", "event_type", "value", "props", "council")
    day = F.date_format(F.date_sub(F.to_date("ts"), (F.dayofmonth("ts") - 1) % 10), "yyyy-MM-dd")
    page = F.floor(F.col("event_id") / F.lit(PAGE_EVENTS))
    eid = F.col("event_id")
    num = F.col("value").cast("decimal(18,2)").cast("string")
    value = (F.when(eid % 11 == 0, F.concat(F.lit("<"), num))
             .when(eid % 13 == 0, F.concat(F.lit(">"), num))
             .when(eid % 17 == 0, F.lit("None"))
             .when(eid % 19 == 0, F.lit("NA"))
             .when(eid % 23 == 0, F.lit("*"))
             .when(eid % 29 == 0, F.lit(""))
             .otherwise(num))
    t = (F.when(eid % 37 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
         .when(eid % 2 == 0, F.date_format("ts", S.TIME_FORMAT_COMPACT))
         .otherwise(F.date_format("ts", S.TIME_FORMAT_ISO)))
    frag = F.concat(
        F.lit("<E><T>"), t, F.lit("</T><Value>"), xml_text(value),
        F.lit('</Value><Parameter Name="EventId" Value="'), eid.cast("string"),
        F.lit('"/><Parameter Name="Props" Value="'), xml_text(F.col("props")), F.lit('"/>'),
        F.when(eid % 5 == 0, F.concat(F.lit('<Parameter Name="Lāke Nō" Value="ō'), eid.cast("string"), F.lit('"/>'))).otherwise(F.lit("")),
        F.lit("</E>"))
    grouped = (ev.select("council", F.col("user_id").cast("string").alias("site"),
                         F.col("event_type").alias("variable"), day.alias("day"), page.alias("page"),
                         "value", F.struct(eid.alias("k"), frag.alias("frag")).alias("e"))
               .groupBy("council", "site", "variable", "day", "page")
               .agg(F.min("value").alias("min_value"),
                    F.array_sort(F.collect_list("e")).alias("es")))
    failed = F.col("variable") == "error"
    empty = failed & (F.col("min_value") < 5)
    data = F.when(failed, F.lit("")).otherwise(F.array_join(F.col("es.frag"), ""))
    body = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><Hilltop><Agency>'), F.col("council"),
        F.lit('</Agency><Measurement SiteName="'), F.col("site"),
        F.lit('"><DataSource Name="'), F.col("variable"),
        F.lit('"/><Data DateFormat="Calendar">'), data, F.lit("</Data></Measurement></Hilltop>"))
    url = F.concat(sos_root(F.col("council")), F.lit("&From="), F.col("day"), F.lit("&To="),
                   F.lit(S.DEFAULT_DATE_END), F.lit("&Site="), F.col("site"),
                   F.lit("&Measurement="), F.col("variable"), F.lit("&Page="), F.col("page").cast("string"))
    return grouped.select(
        url.alias("url"), "site", "variable",
        F.when(failed & ~empty, F.lit(500)).otherwise(F.lit(200)).alias("status_code"),
        F.when(failed & ~empty, F.lit("Service Unavailable")).otherwise(body).alias("body"),
        "council", F.col("day").alias("date_start"), F.lit(S.DEFAULT_DATE_END).alias("date_end"))


def landed_catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2: GML catalog pages of suppliers-as-sites, one per (council, page),
    plus a failed fetch for every council of region 4."""
    sup = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    geo = dim_join(nation, region, nation.n_regionkey == region.r_regionkey, "inner").select(
        "n_nationkey", "n_regionkey", council_col().alias("council"), "r_name")
    s = dim_join(sup, geo, sup.s_nationkey == geo.n_nationkey, "inner")
    key = F.col("s_suppkey").cast("string")
    frac = F.lpad(key, 6, "0")
    lat = F.concat(F.lit("-"), (F.col("s_nationkey") + F.lit(35)).cast("string"), F.lit("."), frac)
    lon = F.concat((F.col("n_regionkey") + F.lit(166)).cast("string"), F.lit("."), frac)
    pos = F.when(F.col("s_suppkey") % 7 == 0, F.concat(lat, F.lit(" "), lon, F.lit(" 0"))) \
           .otherwise(F.concat(lat, F.lit(" "), lon))
    feature = F.concat(
        F.lit('<gml:featureMember><lawa:LakeSites gml:id="s'), key, F.lit('">'),
        F.lit("<lawa:CouncilSiteID>"), key, F.lit("</lawa:CouncilSiteID>"),
        F.lit("<lawa:SiteID>"), xml_text(F.col("s_name")), F.lit("</lawa:SiteID>"),
        F.lit("<lawa:LawaSiteID>lawa-"), F.col("council"), F.lit("-"), key, F.lit("</lawa:LawaSiteID>"),
        F.when(F.col("s_acctbal") > 0, F.lit("<lawa:LType>Shallow</lawa:LType>")).otherwise(F.lit("")),
        F.lit("<lawa:Region>"), xml_text(F.col("r_name")), F.lit("</lawa:Region>"),
        F.lit("<lawa:Agency>"), F.col("council"), F.lit("</lawa:Agency>"),
        F.lit("<lawa:Catchment>"), xml_text(F.concat(F.col("s_name"), F.lit(" & Co"))), F.lit("</lawa:Catchment>"),
        F.lit("<lawa:LWQuality>"), F.when(F.col("s_suppkey") % 3 == 0, F.lit("Yes")).otherwise(F.lit("No")),
        F.lit("</lawa:LWQuality>"),
        F.lit("<lawa:Macro/>"),
        F.when(F.col("s_acctbal") >= 0, F.concat(
            F.lit("<lawa:Shape><gml:Point><gml:pos>"), pos, F.lit("</gml:pos></gml:Point></lawa:Shape>"))
        ).otherwise(F.lit("")),
        F.lit("</lawa:LakeSites></gml:featureMember>"))
    page = F.floor(F.col("s_suppkey") / F.lit(PAGE_SITES))
    pages = (s.select("council", page.alias("page"),
                      F.struct(F.col("s_suppkey").alias("k"), feature.alias("f")).alias("feat"))
             .groupBy("council", "page").agg(F.array_sort(F.collect_list("feat")).alias("fs")))
    body = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><wfs:FeatureCollection '
              'xmlns:wfs="http://www.opengis.net/wfs" xmlns:gml="http://www.opengis.net/gml" '
              'xmlns:lawa="urn:example:lawa"><!-- sites --><gml:boundedBy/>'),
        F.array_join(F.col("fs.f"), ""), F.lit("</wfs:FeatureCollection>"))
    url = F.concat(wfs_root(F.col("council")), F.lit("&startIndex="),
                   (F.col("page") * F.lit(PAGE_SITES)).cast("string"))
    ok = pages.select("council", url.alias("url"), F.lit("success").alias("status"),
                      F.col("council").alias("partition_key"), F.lit(CATALOG_TS).alias("creation_date"),
                      body.alias("raw_data"))
    bad = geo.filter(F.col("n_regionkey") == 4).select(
        "council", wfs_root(F.col("council")).alias("url"), F.lit("failed").alias("status"),
        F.col("council").alias("partition_key"), F.lit(CATALOG_TS).alias("creation_date"),
        F.lit("Service Unavailable").alias("raw_data"))
    return ok.unionByName(bad)
