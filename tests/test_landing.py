from pyspark.sql import functions as F

from tarn.sources.catalog import parse_catalog
from tarn.sources.landing import MALFORMED_ERROR, explode_responses

SCHEMA = "url string, site string, variable string, status_code int, body string, council string"


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = explode_responses(df).orderBy("url", "t")
    return [r.asDict() for r in out.collect()]


def test_measurement_shapes(spark):
    nested = ("<Hilltop><Measurement><Wrap><Data><E><T>20240101T000000</T><Value>&lt;0.5</Value>"
              "<Parameter Name='Lab' Value='A'/><Parameter Name='Lab' Value='B'/><QC>600</QC></E>"
              "<Inner><E><T>20240102T000000</T><Value>007</Value></E></Inner></Data></Wrap></Measurement></Hilltop>")
    outside = "<H><E><T>x</T><Value>1</Value></E><Data><!-- <E><T>c</T><Value>9</Value></E> --></Data></H>"
    cdata = "<H><Data><E><T><![CDATA[2024-01-01T00:00:00]]></T><Value>5</Value></E></Data></H>"
    rows = run(spark, [
        ("u1", "s", "v", 200, nested, "c"),
        ("u2", "s", "v", 200, outside, "c"),
        ("u3", "s", "v", 200, cdata, "c"),
        ("u4", "s", "v", 200, "<H><Data><E><T>1</T><Value>1</Va", "c"),
        ("u5", "s", "v", 200, "not xml at all", "c"),
        ("u6", "s", "v", 404, "Not found", "c"),
        ("u7", "s", "v", None, None, "c"),
        ("u8", "s", "v", 200, "<H><Data/></H>", "c"),
        ("u9", "s", "v", 200, "<H><Data><Data><E><T>1</T><Value>1</Value></E></Data></Data></H>", "c"),
    ])
    by = {}
    for r in rows:
        by.setdefault(r["url"], []).append(r)
    u1 = by["u1"]
    assert [(r["t"], r["value"]) for r in u1] == [("20240101T000000", "<0.5"), ("20240102T000000", "007")]
    assert u1[0]["params"] == {"Lab": "B", "QC": "600"} and u1[0]["error"] is None
    # E outside Data is ignored; a commented-out E is ignored -> no data
    assert by["u2"][0]["error"] == "No data found" and by["u2"][0]["t"] == "missing"
    assert by["u3"][0]["t"] == "2024-01-01T00:00:00"
    assert by["u4"][0]["error"] == MALFORMED_ERROR and by["u4"][0]["status_code"] is None
    assert by["u5"][0]["error"] == MALFORMED_ERROR
    assert by["u6"][0]["error"] == "HTTP error: 404" and by["u6"][0]["status_code"] == 404
    assert by["u7"][0]["error"] == "request failed" and by["u7"][0]["status_code"] is None
    assert by["u8"][0]["error"] == "No data found"
    assert [(r["t"], r["value"], r["error"]) for r in by["u9"]] == [("1", "1", None)]
    assert len(rows) == 10


def test_nested_blocks_give_each_row_once(spark):
    body = ("<H><E><T>out</T></E><Data><E><T>1</T><Value>a</Value></E><Data><E><T>2</T><Value>b</Value></E></Data>"
            "<E><T>3</T><Value>c</Value></E></Data><E><T>out</T></E><Data><E><T>4</T><Value>d</Value></E></Data></H>")
    assert [(r["t"], r["value"]) for r in run(spark, [("u", "s", "v", 200, body, "c")])] == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")]


def test_parameter_without_a_name(spark):
    body = "<H><Data><E><T>1</T><Value>2</Value><Parameter Value='x'/><Parameter Name='k' Value='y'/></E></Data></H>"
    assert run(spark, [("u", "s", "v", 200, body, "c")])[0]["params"] == {"k": "y"}


def test_character_references_and_cdata(spark):
    body = ("<H><Data><E><T>1</T><Value>&#60;5</Value><Lake>Taup&#333; &amp; W&#x101;naka &amp;#333; &#128032;</Lake>"
            "<Note><![CDATA[a <b> & </Data> <!-- c -->]]></Note></E><!-- <![CDATA[ --><E><T>2</T><Value>3</Value></E></Data></H>")
    rows = run(spark, [("u", "s", "v", 200, body, "c")])
    assert [(r["t"], r["value"], r["error"]) for r in rows] == [("1", "<5", None), ("2", "3", None)]
    assert rows[0]["params"] == {"Lake": "Taupō & Wānaka &#333; 🐠", "Note": "a <b> & </Data> <!-- c -->"}


def test_catalog_shapes(spark):
    a = ('<wfs:FeatureCollection xmlns:wfs="w" xmlns:gml="http://www.opengis.net/gml" xmlns:x="x">'
         '<gml:featureMember><x:Site><x:CouncilSiteID>1</x:CouncilSiteID><x:SiteID>A &amp; B</x:SiteID>'
         '<x:SiteID>A2</x:SiteID><x:Catchment/><x:Shape><gml:Point><gml:pos> -41.1 174.2 </gml:pos>'
         '</gml:Point></x:Shape></x:Site></gml:featureMember>'
         '<gml:featureMember><x:Site><x:CouncilSiteID>2</x:CouncilSiteID>'
         '<x:Shape><gml:Point><gml:pos>-41 174 9</gml:pos></gml:Point></x:Shape></x:Site></gml:featureMember>'
         '<gml:featureMember><x:Site><x:CouncilSiteID>3</x:CouncilSiteID><x:Catchment>Waikato</x:Catchment>'
         '</x:Site></gml:featureMember></wfs:FeatureCollection>')
    b = ('<FeatureCollection xmlns:g="http://www.opengis.net/gml"><g:featureMember><Lake>'
         '<COUNCILSITEID>9</COUNCILSITEID><LWQuality>yes</LWQuality></Lake></g:featureMember></FeatureCollection>')
    landed = spark.createDataFrame([
        ("ecan", "ua", "success", "ecan", "2024-01-01 00:00:00", a),
        ("gw", "ub", "success", "gw", "2024-01-01 00:00:00", b),
        ("es", "uc", "failed", "es", "2024-01-01 00:00:00", "oops"),
    ], "council string, url string, status string, partition_key string, creation_date string, raw_data string")
    rows = {r["councilsiteid"]: r.asDict() for r in parse_catalog(landed).collect()}
    assert set(rows) == {"1", "2", "3", "9"}
    assert rows["1"]["siteid"] == "A2"                      # last occurrence wins
    assert rows["1"]["latitude"] == "-41.1" and rows["1"]["longitude"] == "174.2"
    assert rows["1"]["catchment"] == "-99999"               # empty element -> sentinel
    assert rows["2"]["latitude"] == "-99999"                # pos with 3 parts
    assert rows["2"]["siteid"] == "-99999"                  # council has the property elsewhere
    assert rows["3"]["catchment"] == "Waikato" and rows["3"]["latitude"] == "-99999"
    assert rows["2"]["lwquality"] is None                   # no ecan feature has it
    assert rows["9"]["lwquality"] == "yes" and rows["9"]["latitude"] is None
    assert rows["9"]["council"] == "gw" and rows["1"]["status"] == "success"


def test_catalog_entities(spark):
    body = ('<c xmlns:gml="http://www.opengis.net/gml"><gml:featureMember><s><councilsiteid>1</councilsiteid>'
            '<catchment>R &amp;amp; D &lt;x&gt;</catchment></s></gml:featureMember></c>')
    landed = spark.createDataFrame([("c", "u", "success", "c", "d", body)],
                                   "council string, url string, status string, partition_key string, "
                                   "creation_date string, raw_data string")
    assert parse_catalog(landed).first()["catchment"] == "R &amp; D <x>"
