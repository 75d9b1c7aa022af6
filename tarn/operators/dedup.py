"""Keep-first deduplication as an aggregate, not a window.

``row_number() over (partition by key order by ...) = 1`` sorts every row
of a key in one task; a hot key then lands whole on one executor. The
minimum of one struct (order columns, then the rest) per key is an
ordinary aggregate: each map task reduces its local duplicates before the
shuffle, so a key holding a third of the rows ships one row per map task.
Every column travels once, inside that struct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(t: T.DataType) -> bool:
    return not isinstance(t, T.VariantType) and "map<" not in t.simpleString()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per ``keys``: the first in ``order`` (ascending, nulls first).

    Remaining ties are broken by the other columns, so the pick is a
    function of the visible row, never of arrival order. NULL keys form one
    group, as in pandas. Columns that cannot be ordered (maps) ride along
    in a ``min_by`` of the same struct.
    """
    keys = list(keys)
    payload = [f for f in df.schema.fields if f.name not in keys]
    named = [o for o in order if isinstance(o, str)]
    parts = [F.col(o).alias(o) if isinstance(o, str) else o.alias(f"__o{i}") for i, o in enumerate(order)]
    parts += [F.col(f.name) for f in payload if f.name not in named and _orderable(f.dataType)]
    rest = [f.name for f in payload if not _orderable(f.dataType)]
    first = F.struct(*parts)
    if rest:
        picked = df.groupBy(*keys).agg(F.min(first).alias("__first"), F.min_by(F.struct(*rest), first).alias("__rest"))
    else:
        picked = df.groupBy(*keys).agg(F.min(first).alias("__first"))
    return picked.select(*[F.col(c) if c in keys else F.col("__rest" if c in rest else "__first")[c].alias(c) for c in df.columns])
