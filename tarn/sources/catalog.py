"""S3-S5 + P19: landed GML site catalogs -> one row per site feature.

Each successful catalog body (one row per council, or per catalog page)
is cut into ``featureMember`` blocks; every leaf element of a feature
gives (local name lower-cased, decoded text), the last occurrence of a
name winning. ``pos`` is split into latitude / longitude unless the
feature has properties of those names. A property that some feature of
the council carries (even empty) and this one lacks is set to the
sentinel '-99999'; properties no feature of the council has stay NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn import schemas as S
from tarn.functions.values import split_position
from tarn.operators.joins import few_rows
from tarn.sources.landing import decode_entities, plain_markup

_FEATURE = r"(?s)<(?:[\w.\-]+:)?featureMember(?:\s[^>]*)?>(.*?)</(?:[\w.\-]+:)?featureMember\s*>"
# Leaf with text: prefix-insensitive local name (group 1) and text (group 2).
_LEAF = r"<(?:[\w.\-]+:)?([A-Za-z_][\w.\-]*)(?:\s[^>]*)?>([^<]*)</(?:[\w.\-]+:)?\1\s*>"
# Self-closing element: its local name (present, no text).
_EMPTY = r"<(?:[\w.\-]+:)?([A-Za-z_][\w.\-]*)(?:\s[^>]*)?/>"
ENVELOPE = ["council", "url", "status", "partition_key"]


def successful(landed: DataFrame) -> DataFrame:
    """Only catalogs fetched with status 'success' are parsed."""
    return landed.filter(F.col("status") == "success")


def explode_features(landed: DataFrame) -> DataFrame:
    """One row per feature: envelope columns + ``props`` map
    (lower-cased local name -> text; NULL text for empty elements)."""
    body = plain_markup(F.col("raw_data"))
    feats = successful(landed).select(
        *ENVELOPE, F.posexplode(F.regexp_extract_all(body, F.lit(_FEATURE), F.lit(1))).alias("feature_no", "f"))
    names = F.regexp_extract_all("f", F.lit(_LEAF), F.lit(1))
    texts = F.regexp_extract_all("f", F.lit(_LEAF), F.lit(2))
    empties = F.regexp_extract_all("f", F.lit(_EMPTY), F.lit(1))
    leaves = F.transform(F.arrays_zip(names.alias("k"), texts.alias("v")), lambda p: F.struct(
        F.lower(p["k"]).alias("key"),
        F.when(p["v"] != "", decode_entities(p["v"])).alias("value")))
    blanks = F.transform(empties, lambda k: F.struct(F.lower(k).alias("key"),
                                                     F.lit(None).cast("string").alias("value")))
    # Empty elements first so a later non-empty one of the same name wins.
    props = F.map_from_entries(F.concat(blanks, leaves))
    return feats.select(*ENVELOPE, "feature_no", props.alias("props"))


def parse_catalog(landed: DataFrame, wanted=S.SITE_VARS) -> DataFrame:
    """S3 + S4 + P4 + P5 + P19: typed site rows with the wanted columns."""
    feats = explode_features(landed)
    # Names present in any feature of the council: one row per council,
    # joined by broadcast when counted to be few (Catalyst's estimate of
    # this derived table is far too large).
    present = (feats.select("council", F.explode(F.map_keys("props")).alias("name"))
               .distinct()
               .groupBy("council").agg(F.collect_set("name").alias("__present")))
    j = feats.join(few_rows(present), "council", "left")
    lat, lon = split_position(F.col("props")["pos"])
    has_pos = F.array_contains("__present", "pos")

    def prop(name):
        v = F.col("props")[name]
        present_in_council = F.array_contains("__present", name)
        if name in ("latitude", "longitude"):
            # A property of that name wins over the split position.
            split = lat if name == "latitude" else lon
            v = F.coalesce(v, F.when(F.map_contains_key("props", "pos"), split))
            present_in_council = present_in_council | has_pos
        return F.coalesce(v, F.when(present_in_council, F.lit(S.SITE_SENTINEL)))

    return j.select(*[F.col(c) if c in ENVELOPE else prop(c).alias(c) for c in wanted])
