"""Scalar rules as ``Column -> Column`` helpers (all JVM-side, no UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarn import schemas as S

__all__ = [
    "obs_time", "censor_symbols", "numeric_value", "is_strict_numeric",
    "censor_marker", "adjusted_value", "truncate_cell", "strip_specials",
    "sanitise_name", "tolerant_double", "record_key", "split_position",
    "is_true_flag", "sanitise_name_col", "nan_to_null", "is_rejected_value", "as_of_date",
]

# A number as the warehouse would cast it: optional sign, digits with an
# optional decimal part, optional exponent. Rejects '1d', '1,000', 'inf'.
_NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# Trailing number of a censored value (strict decimal point).
_TRAILING_NUMBER = r"[0-9]+(\.[0-9]+)?$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def obs_time(t: Column | str) -> Column:
    """text time in compact or ISO form -> TIMESTAMP_NTZ, else NULL."""
    t = _c(t)
    parsed = F.coalesce(
        F.try_to_timestamp(t, F.lit(S.TIME_FORMAT_COMPACT)),
        F.try_to_timestamp(t, F.lit(S.TIME_FORMAT_ISO)),
    )
    return (F.when(t == F.lit(S.MISSING_TIME), F.lit(None))
            .otherwise(parsed).cast("timestamp_ntz"))


def censor_symbols(v: Column | str) -> Column:
    """leading '<' / '>' -> 'less_than_' / 'greater_than_' prefix."""
    v = _c(v)
    return (F.when(v.startswith("<"),
                   F.concat(F.lit(S.LESS_THAN_PREFIX), v.substr(F.lit(2), F.length(v))))
            .when(v.startswith(">"),
                  F.concat(F.lit(S.GREATER_THAN_PREFIX), v.substr(F.lit(2), F.length(v))))
            .otherwise(v))


def is_strict_numeric(v: Column | str) -> Column:
    return _c(v).rlike(_NUMERIC_TEXT)


def tolerant_double(v: Column | str) -> Column:
    """text -> double; anything that is not a plain number -> NULL."""
    v = _c(v)
    return F.when(is_strict_numeric(v), v.try_cast("double"))


def numeric_value(v: Column | str) -> Column:
    """Censored text -> its trailing number; missing literals -> NULL;
    otherwise the text as a double (NULL when it is not a number)."""
    v = _c(v)
    trailing = F.regexp_substr(v, F.lit(_TRAILING_NUMBER))
    return (F.when(v.like("%than_%"), trailing.try_cast("double"))
            .when(v.isin(*S.MISSING_VALUE_LITERALS), F.lit(None).cast("double"))
            .otherwise(tolerant_double(v)))


def censor_marker(v: Column | str) -> Column:
    """the value with every digit removed."""
    return F.regexp_replace(_c(v), "[0-9]", "")


def adjusted_value(censored: Column | str, value_numeric: Column | str) -> Column:
    """Less-than halves, greater-than scales by 1.1, else as is."""
    censored, value_numeric = _c(censored), _c(value_numeric)
    return (F.when(F.position(F.lit("less"), censored) > 0,
                   value_numeric * F.lit(S.LESS_THAN_FACTOR))
            .when(F.position(F.lit("greater"), censored) > 0,
                  value_numeric * F.lit(S.GREATER_THAN_FACTOR))
            .otherwise(value_numeric))


def truncate_cell(c: Column | str, width: int | None = None) -> Column:
    """P10: keep the first ``width`` characters (code points); without a
    width the cell stays whole."""
    return _c(c) if width is None else F.substring(_c(c), 1, width)


def strip_specials(c: Column | str) -> Column:
    """Delete every character that is neither a word char nor space.
    Unicode-aware, so macrons in lake names survive."""
    return F.regexp_replace(_c(c), r"(?U)[^\w\s]", "")


def sanitise_name(name: str) -> str:
    """Column-name cleanup, ``[^\\w]`` -> ``_`` (Unicode letters stay)."""
    return re.sub(r"[^\w]", "_", name)


def sanitise_name_col(c: Column | str) -> Column:
    """P8 on a column of names."""
    return F.regexp_replace(_c(c), r"(?U)[^\w]", "_")


def nan_to_null(c: Column | str) -> Column:
    """F16: NaN -> NULL for floating-point columns."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def is_rejected_value(v: Column | str) -> Column:
    """a value that is neither missing nor censored nor a number."""
    v = _c(v)
    return v.isNotNull() & ~v.like("%than_%") & ~v.isin(*S.MISSING_VALUE_LITERALS) & tolerant_double(v).isNull()


def as_of_date(run_date: Column | str) -> Column:
    """the day before the run, as text: the date a scheduled load asks for."""
    return F.date_format(F.date_sub(_c(run_date).cast("date"), 1), "yyyy-MM-dd")


def record_key(lawasiteid: Column | str, councilsiteid: Column | str,
               lawaname: Column | str, t: Column | str,
               date_start: Column | str, date_end: Column | str) -> Column:
    """``lawasiteid_councilsiteid_lawaname_`` + time, or
    ``error-{start}-{end}`` when the time is missing. Null parts give a
    null key (``concat`` propagates nulls)."""
    t = _c(t)
    suffix = F.when(F.lower(t) == F.lit(S.MISSING_TIME),
                    F.concat(F.lit("error-"), _c(date_start), F.lit("-"), _c(date_end))
                    ).otherwise(t)
    return F.concat(_c(lawasiteid), F.lit("_"), _c(councilsiteid), F.lit("_"),
                    _c(lawaname), F.lit("_"), suffix)


def split_position(pos: Column | str) -> tuple[Column, Column]:
    """S4: 'lat lon' text -> (latitude, longitude); other shapes -> NULLs."""
    parts = F.split(F.trim(_c(pos)), r"\s+")
    ok = F.size(parts) == 2
    return (F.when(ok, F.get(parts, 0)), F.when(ok, F.get(parts, 1)))


def is_true_flag(c: Column | str) -> Column:
    """lower(flag) in ('y','yes','true')."""
    return F.lower(_c(c)).isin(*S.TRUE_FLAGS)
