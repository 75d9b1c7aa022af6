"""R2 with K7: typed columns found in the open attributes of records.

Attributes come in long form (``id, name, value``; P7-P9) and no schema
names them. A *profile* counts, per name, the values of each kind; profiles
of batches add up, so a column's type is known without a look at older
values. Records are then pivoted to one typed column per name, and a stored
column widens when a later batch needs it.

Kinds are chosen so that a typed value prints as the text it was read from,
or as the same number: integers without leading zeros or a ``+`` (up to 9
digits int, 18 long), decimals of up to 15 digits double. Anything else,
``007`` and ``1e5`` included, is text. Integers beyond 9 digits beside
decimals make a text column, as a double would not hold them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.operators.snapshots import SnapshotTable

KINDS = ("n_int", "n_long", "n_double", "n_text", "n_empty")
OTHER = "other"


def _kind(value):
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (F.when(value.isNull() | (value == ""), F.lit("n_empty"))
            .when(value.rlike(r"^(0|-?[1-9][0-9]{0,8})\z"), F.lit("n_int"))
            .when(value.rlike(r"^-?[1-9][0-9]{0,17}\z"), F.lit("n_long"))
            .when(value.rlike(r"^-?(0|[1-9][0-9]*)\.[0-9]+\z") & (digits <= 15), F.lit("n_double"))
            .otherwise(F.lit("n_text")))


def attribute_profile(attributes: DataFrame) -> DataFrame:
    """(name, counts of each kind) of long-form attributes. Null names are
    no attributes. One aggregate with map-side partial sums."""
    named = attributes.where(F.col("name").isNotNull()).select("name", _kind(F.col("value")).alias("__kind"))
    return named.groupBy("name").agg(*[F.count_if(F.col("__kind") == k).alias(k) for k in KINDS])


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """One profile of the rows of several."""
    return profiles.groupBy("name").agg(*[F.sum(k).alias(k) for k in KINDS])


def typed_names(profile: DataFrame, most: int = 1000, reserved=("id",)) -> dict[str, str]:
    """Column types by name, for at most ``most`` names (the most frequent,
    ties by name); the others, and names that differ from another column in
    case only, have no column of their own and go to ``other``."""
    n = sum((F.col(k) for k in KINDS), F.lit(0))
    kind = (F.when(F.col("n_text") > 0, "string")
            .when((F.col("n_double") > 0) & (F.col("n_long") > 0), "string")
            .when(F.col("n_double") > 0, "double")
            .when(F.col("n_long") > 0, "bigint")
            .when(F.col("n_int") > 0, "int").otherwise("string"))
    out: dict[str, str] = {}
    taken = {r.lower() for r in (*reserved, OTHER, "created_at", "updated_at")}
    for row in profile.select("name", kind.alias("kind"), n.alias("n")).orderBy(F.desc("n"), "name").limit(most).collect():
        if row["name"].lower() not in taken:
            taken.add(row["name"].lower())
            out[row["name"]] = row["kind"]
    return out


def pivot_typed(attributes: DataFrame, types: dict[str, str], key: str = "id") -> DataFrame:
    """One row per key: a typed column for each of ``types``, and ``other``,
    the rest as JSON (null where there is none). Of several values of one
    name the greatest text is taken; in a typed column that is no text an
    empty value is null. The shuffle carries each key's attributes once,
    whatever the number of columns."""
    pairs = F.array_sort(F.collect_set(F.struct("name", F.coalesce("value", F.lit("")).alias("value"), F.col("value").isNull().alias("none"))))
    own = attributes.where(F.col(key).isNotNull() & F.col("name").isNotNull()).groupBy(key).agg(pairs.alias("__pairs"))
    entries = F.map_from_entries(F.transform("__pairs", lambda p: F.struct(
        p["name"].alias("key"), F.when(~p["none"], p["value"]).alias("value"))))      # last wins
    own = own.select(key, entries.alias("__all"))
    value = lambda name: F.element_at("__all", F.lit(name))
    columns = [(value(n) if t == "string" else F.nullif(value(n), F.lit("")).cast(t)).alias(n) for n, t in types.items()]
    rest = F.map_filter("__all", lambda k, v: ~k.isin(*types)) if types else F.col("__all")
    return own.select(key, *columns, F.when(F.size(rest) > 0, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(rest))), {"ignoreNullFields": "false"})).alias(OTHER))


def profile_table(spark, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, key="profile_id", buckets=4)


def load_attributes(attributes: DataFrame, table: SnapshotTable, profiles: SnapshotTable, batch_ts, batch_tag: str,
                    most: int = 1000) -> int:
    """Store a batch of attributes under the types of all batches so far;
    the table's version. Old rows are not read: their kinds are in
    ``profiles``, and the table widens its columns on read. A column that
    exists stays one, also when its name is no longer among the ``most``
    frequent. A batch of a tag that was loaded changes nothing."""
    if batch_tag in table.manifest()["tags"]:
        return table.version()
    profile = attribute_profile(attributes)
    profile_id = F.to_json(F.struct(F.lit(batch_tag).alias("tag"), "name"))
    profiles.upsert(profile.withColumn("profile_id", profile_id), batch_ts, batch_tag)
    merged = merge_profiles(profiles.read())
    had = [c for c in table._schema(table.manifest()).fieldNames() if c not in (table.key, OTHER)]
    types = typed_names(merged.where(F.col("name").isin(had)), max(len(had), 1), (table.key,)) if had else {}
    types |= {n: t for n, t in typed_names(merged, most, (table.key, *had)).items() if len(types) < most}
    return table.upsert(pivot_typed(attributes, types, table.key), batch_ts, batch_tag)
