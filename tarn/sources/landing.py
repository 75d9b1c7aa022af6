"""S1 + S2: landed measurement responses -> observation rows.

A landed response is one row per request: ``url, site, variable,
status_code, body, council`` (plus optional ``fetch_error``, ``date_start``,
``date_end``, ``created_at``). The whole body is checked for
well-formedness first, then comments are stripped and CDATA is made plain
text, every ``Data`` block is cut out, and every ``E`` element inside one
becomes a row, once also where blocks nest. ``E`` fragments
are parsed with ``from_xml`` against a fixed typed schema (time, value,
repeated ``Parameter`` attributes); any other leaf child is read into the
same open attribute map. Everything runs as JVM expressions, one pass
over the bodies, no Python in the row path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn import schemas as S

# Comments vanish, CDATA becomes escaped text, before anything is cut.
_COMMENT_OR_CDATA = r"(?s)<!--.*?-->|<!\[CDATA\[(.*?)\]\]>"
_CHAR_REF = r"&#(x?[0-9A-Fa-f]+);"
# `Data` blocks and `E` elements; the tag must end at '>' or whitespace, so
# `<Data2>` or `<E-x>` do not count; self-closing tags open nothing.
_DATA = r"(?s)<Data(?:\s[^>]*)?(?<!/)>(.*?)</Data\s*>"
_E = r"(?s)<E(?:\s[^>]*)?(?<!/)>.*?</E\s*>"
_DATA_OR_E = r"(?s)<Data(?:\s[^>]*)?(?<!/)>|</Data\s*>|<E(?:\s[^>]*)?(?<!/)>.*?</E\s*>"
# A leaf element with text only: (tag, text).
_LEAF = r"<([A-Za-z_][\w.\-]*)(?:\s[^>]*)?>([^<]*)</\1\s*>"
E_SCHEMA = "T STRING, Value STRING, Parameter ARRAY<STRUCT<_Name: STRING, _Value: STRING>>"
MALFORMED_ERROR = "Malformed XML body"


def _spliced(text: Column, pattern: str, keep, put) -> Column:
    """``text`` with every match of ``pattern`` replaced by ``put`` of its
    group 1, and ``keep`` applied to what stands between."""
    between = F.split(text, pattern, -1)
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.array_join(F.transform(between, lambda part, i: F.concat(keep(part), F.coalesce(put(F.get(groups, i)), F.lit("")))), "")


def escape_text(c: Column) -> Column:
    for ch, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(ch), F.lit(ent))
    return c


def plain_markup(body: Column) -> Column:
    """The body without comments and with CDATA as escaped text."""
    return F.when(body.contains("<!--") | body.contains("<![CDATA["),
                  _spliced(body, _COMMENT_OR_CDATA, lambda p: p, escape_text)).otherwise(body)


def _named_entities(c: Column) -> Column:
    """The five predefined XML entities; '&amp;' last so '&amp;lt;' stays '&lt;'."""
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'")):
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def _char_of(ref: Column) -> Column:
    """Character of a numeric reference's digits ('333' or 'x14D')."""
    digits = F.when(F.lower(ref).startswith("x"), F.substring(ref, 2, 8)).otherwise(F.conv(ref, 10, 16))
    return F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")


def decode_entities(c: Column) -> Column:
    """Text of an element: named entities and numeric character references."""
    return F.when(c.contains("&#"), _spliced(c, _CHAR_REF, _named_entities, _char_of)).otherwise(_named_entities(c))


def malformed(body: Column) -> Column:
    """True when the whole body does not parse as XML (truncated, not XML)."""
    probe = F.from_xml(body, "_corrupt_record STRING",
                       {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"})
    return probe["_corrupt_record"].isNotNull()


def _inside_data(markup: Column) -> Column:
    """`E` texts inside `Data` blocks that nest: walk the tags in order and
    keep each `E` met while a block is open, once."""
    tags = F.regexp_extract_all(markup, F.lit(_DATA_OR_E), F.lit(0))
    walked = F.aggregate(
        tags, F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("found")),
        lambda s, tag: F.struct(
            F.when(tag.startswith("<Data"), s["depth"] + 1).when(tag.startswith("</Data"), F.greatest(s["depth"] - 1, F.lit(0))).otherwise(s["depth"]).alias("depth"),
            F.when(tag.startswith("<E") & (s["depth"] > 0), F.array_append(s["found"], tag)).otherwise(s["found"]).alias("found")))
    return walked["found"]


def e_fragments(markup: Column, blocks: Column) -> Column:
    """`<E>...</E>` texts inside any `Data` block, each once. ``blocks``:
    the bodies of the blocks; one that opens another is walked tag by tag."""
    nested = F.exists(blocks, lambda d: d.rlike(r"<Data(\s[^>]*)?(?<!/)>"))
    flat = F.flatten(F.transform(blocks, lambda d: F.regexp_extract_all(d, F.lit(_E), F.lit(0))))
    return F.when(nested, _inside_data(markup)).otherwise(flat)


def leaf_map(fragment: Column, drop=("T", "Value", "Parameter")) -> Column:
    """Other leaf children of an `E` as name -> decoded text (last wins)."""
    whole = F.regexp_extract_all(fragment, F.lit(_LEAF), F.lit(0))
    pairs = F.transform(whole, lambda leaf: F.struct(
        F.regexp_extract(leaf, _LEAF, 1).alias("key"), decode_entities(F.regexp_extract(leaf, _LEAF, 2)).alias("value")))
    return F.map_from_entries(F.filter(pairs, lambda p: ~p["key"].isin(*drop)))


def explode_responses(landed: DataFrame) -> DataFrame:
    """S1 + S2: one row per `E` of a good response, one error row for every
    other response (HTTP error, no data, malformed body, failed request)."""
    extra = [c for c in ("date_start", "date_end", "created_at") if c in landed.columns]
    fetch_error = F.col("fetch_error") if "fetch_error" in landed.columns else F.lit(None).cast("string")
    ok = F.col("status_code") == 200
    # Each expensive expression is its own column, computed once per body
    # (CollapseProject does not inline non-cheap expressions used twice).
    checked = landed.select(
        "*", (ok & (F.col("body").isNull() | malformed(F.col("body")))).alias("__bad"))
    checked = checked.select("*", F.when(ok & ~F.col("__bad"), plain_markup(F.col("body"))).alias("__markup"))
    checked = checked.select("*", F.regexp_extract_all("__markup", F.lit(_DATA), F.lit(1)).alias("__blocks"))
    checked = checked.select("*", e_fragments(F.col("__markup"), F.col("__blocks")).alias("__frags"))
    bad_body, frags = F.col("__bad"), F.col("__frags")
    error = (F.when(F.col("status_code").isNull(), F.coalesce(fetch_error, F.lit("request failed")))
             .when(~ok, F.concat(F.lit(S.HTTP_ERROR_PREFIX), F.col("status_code").cast("string")))
             .when(bad_body, F.lit(MALFORMED_ERROR))
             .when(F.size(frags) == 0, F.lit(S.NO_DATA_ERROR)))
    staged = checked.select(
        "url", F.when(bad_body, F.lit(None).cast("int")).otherwise(F.col("status_code")).alias("status_code"),
        error.alias("error"), "site", "variable", "council", *extra,
        F.when(error.isNull(), frags).alias("frags"))
    # explode_outer keeps one row (NULL fragment) for every failed response.
    rows = staged.select("*", F.explode_outer("frags").alias("frag")).drop("frags")
    parsed = F.from_xml("frag", E_SCHEMA, {"mode": "PERMISSIVE"})
    rows = rows.select("*", parsed.alias("__e"))
    params = F.map_concat(leaf_map(F.col("frag")),
                          F.coalesce(F.map_from_entries(F.transform(
                              F.filter("__e.Parameter", lambda p: p["_Name"].isNotNull()),
                              lambda p: F.struct(p["_Name"].alias("key"), p["_Value"].alias("value")))),
                              F.create_map().cast("map<string,string>")))
    return rows.select(
        "url", "status_code", "error", "site", "variable", "council",
        F.when(F.col("frag").isNull(), F.lit(S.MISSING_TIME)).otherwise(F.col("__e.T")).alias("t"),
        F.col("__e.Value").alias("value"),
        F.when(F.col("frag").isNotNull(), params).alias("params"),
        *extra)
