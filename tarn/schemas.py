"""Declared schemas and the fixed values the semantics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for the same results)
# ---------------------------------------------------------------------------
# Site-catalog columns kept after parsing, in this order.
SITE_VARS = [
    "councilsiteid", "siteid", "lawasiteid",
    "lfenzid", "ltype", "geomorphicltype",
    "region", "agency", "catchment", "lwquality", "macro", "swquality",
    "latitude", "longitude", "council", "url", "status", "partition_key",
]
# Core measurement columns (the raw table); everything else is metadata.
CORE_COLUMNS = ["id", "t", "site", "lawasiteid", "lawaname", "variable",
                "value", "error", "status_code", "url"]
# Literals in `value` that mean "no value".
MISSING_VALUE_LITERALS = ["None", "missing", "NA", "*", ""]
# Time text of a failed or empty request.
MISSING_TIME = "missing"
# Observation time formats, tried in this order.
TIME_FORMAT_COMPACT = "yyyyMMdd'T'HHmmss"
TIME_FORMAT_ISO = "yyyy-MM-dd'T'HH:mm:ss"
# Censor prefixes written for a leading '<' / '>'.
LESS_THAN_PREFIX = "less_than_"
GREATER_THAN_PREFIX = "greater_than_"
# Censor adjustment factors.
LESS_THAN_FACTOR = 0.5
GREATER_THAN_FACTOR = 1.1
# Every stored cell is cut to this many characters.
CELL_WIDTH = 253
# Sentinel for a catalog property some features of a council lack.
SITE_SENTINEL = "-99999"
# Flag texts that mean "site belongs to the module".
TRUE_FLAGS = ["y", "yes", "true"]
# Module code -> catalog flag column.
MODULE_FLAGS = {"mac": "macro", "lwq": "lwquality", "swq": "swquality"}
# Failure texts.
NO_DATA_ERROR = "No data found"
HTTP_ERROR_PREFIX = "HTTP error: "
# Default request window end.
DEFAULT_DATE_END = "2030-01-01"
# Accepted agency codes (quality check).
ACCEPTED_AGENCIES = ["ac", "ecan", "es", "gw", "hbrc", "hrc", "nrc", "orc", "wrc"]
# Backfill request limits: days, sites, parameters.
BACKFILL_MAX_DAYS = 30
BACKFILL_MAX_SITES = 2
BACKFILL_MAX_PARAMS = 2
# GML namespace of feature members and positions.
GML_NS = "http://www.opengis.net/gml"
# ---------------------------------------------------------------------------

# Landed measurement response (one row per request).
LANDED_RESPONSE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("site", T.StringType()),
    T.StructField("variable", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("body", T.StringType()),
    T.StructField("council", T.StringType()),
])

# Landed site catalog (one row per council catalog page).
LANDED_CATALOG = T.StructType([
    T.StructField("council", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("partition_key", T.StringType()),
    T.StructField("creation_date", T.StringType()),
    T.StructField("raw_data", T.StringType()),
])

# Observation after explode + classification (input of the records pipeline).
OBSERVATION = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("site", T.StringType()),
    T.StructField("variable", T.StringType()),
    T.StructField("council", T.StringType()),
    T.StructField("t", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("date_start", T.StringType()),
    T.StructField("date_end", T.StringType()),
])

# Raw measurement table (lwq_data).
RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("t", T.StringType()),
    T.StructField("site", T.StringType()),
    T.StructField("lawasiteid", T.StringType()),
    T.StructField("lawaname", T.StringType()),
    T.StructField("variable", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("council", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

SITE = T.StructType(
    [T.StructField(c, T.StringType()) for c in SITE_VARS]
    + [T.StructField("lawa_site", T.StringType()),
       T.StructField("created_at", T.TimestampNTZType())])

TRANSFER = T.StructType([
    T.StructField("agency", T.StringType()),
    T.StructField("callname", T.StringType()),
    T.StructField("lawaname", T.StringType()),
])

URLS = T.StructType([
    T.StructField("agency", T.StringType()),
    T.StructField("wfs", T.StringType()),
    T.StructField("soslwq", T.StringType()),
])

BACKFILL_REQUEST = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("council", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("params", T.ArrayType(T.StringType())),
    T.StructField("sites", T.ArrayType(T.StringType())),
])
