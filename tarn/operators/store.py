"""Raw-table maintenance on plain Parquet: create, append, replace-slice,
keyed upsert with change history, insert-if-absent, schema evolution.

Plain Parquet has no MERGE or DELETE, so a change is a join over the key
and a rewrite of the partitions the batch touches.

* An upserted table is partitioned by ``bucket``, a function of the key
  alone (a hash by default, the month for time-keyed records), so a key
  never moves: a council that changes, differs in case or is NULL cannot
  leave a second row behind, and a daily batch reads and rewrites its own
  buckets only.
* Rows carry the tag of the batch that last wrote them. A replayed batch
  finds its tag and changes nothing; history is appended once per
  (key, tag). A retry after a crash completes what was left.
* A table's schema is kept beside it (``_schema``), so reading needs no
  footer merge and added columns read as NULL in older files.
* Rewritten rows go to a staging folder in the shared checkpoint area
  first (the write must not overwrite what its own plan reads); staging is
  removed when the write has succeeded.

The relational part of each operation is a pure ``DataFrame -> DataFrame``
function (``upsert``, ``history_rows``, ``insert_missing``), tested and
registered on its own; the ``write_*`` / ``load`` functions apply them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions.values import censor_symbols
from tarn.session import scratch_dir

PARTITION = "council"
BUCKET = "bucket"
BATCH = "batch_tag"
BUCKETS = 64
# Touched partitions are listed for pruning up to this many; beyond it the
# target is pruned by a semi-join instead.
LISTED_PARTITIONS = 4096


def _ts(batch_ts) -> Column:
    return batch_ts if isinstance(batch_ts, Column) else F.lit(batch_ts).cast("timestamp_ntz")


def key_bucket(key: str, buckets: int = BUCKETS) -> Column:
    """Hash bucket of a key, as fixed-width text."""
    return F.lpad(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(buckets)).cast("string"), 4, "0")


def month_bucket(time: str = "t") -> Column:
    """Month of a record's time text in either format ('none' without one).
    The time is part of the record's key, so the month is a function of it."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_extract(F.col(time), r"^(\d{4}-?\d{2})", 1), "-", ""), F.lit("")), F.lit("none"))


# --- relational cores ---------------------------------------------------------

def align(df: DataFrame, other: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K7: give both frames the union of their columns (missing -> NULL)."""
    a = df
    for f in other.schema.fields:
        if f.name not in a.columns:
            a = a.withColumn(f.name, F.lit(None).cast(f.dataType))
    b = other
    for f in df.schema.fields:
        if f.name not in b.columns:
            b = b.withColumn(f.name, F.lit(None).cast(f.dataType))
    return a, b.select(*a.columns)


def evolve(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target rows then batch rows, by name, missing columns NULL."""
    return target.unionByName(batch, allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, key: str, batch_ts, batch_tag: str | None = None) -> DataFrame:
    """The table after a MERGE of ``source`` (unique by ``key``).

    Matched keys take every source column and keep the target's
    ``created_at``; ``updated_at`` becomes the batch time (X2). New keys get
    ``created_at`` = batch time. Unmatched target rows are unchanged. With
    ``batch_tag`` rows are marked with it, and rows that carry it already
    stay as they are. One full outer join on the key.
    """
    src_cols = set(source.columns) - {"created_at", "updated_at"}
    if batch_tag is not None:
        source = source.withColumn(BATCH, F.lit(batch_tag))
        src_cols.add(BATCH)
    for c in ("created_at", "updated_at"):
        if c not in target.columns:
            target = target.withColumn(c, F.lit(None).cast("timestamp_ntz"))
    target, source = align(target, source)
    t = target.withColumn("__in_t", F.lit(True)).alias("t")
    s = source.withColumn("__in_s", F.lit(True)).alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    in_t, in_s = F.col("t.__in_t").isNotNull(), F.col("s.__in_s").isNotNull()
    done = F.coalesce(F.col(f"t.{BATCH}") == batch_tag, F.lit(False)) if batch_tag is not None else F.lit(False)
    take = in_s & ~done
    out = []
    for c in target.columns:
        if c == key:
            out.append(F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c))
        elif c == "created_at":
            out.append(F.when(in_t, F.col("t.created_at")).otherwise(_ts(batch_ts)).alias(c))
        elif c == "updated_at":
            out.append(F.when(take & in_t, _ts(batch_ts)).when(in_t, F.col("t.updated_at")).alias(c))
        elif c in src_cols:
            out.append(F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return j.select(*out)


def history_rows(target: DataFrame, source: DataFrame, key: str, value: str, batch_ts,
                 batch_tag: str | None = None) -> DataFrame:
    """Target rows about to be replaced by a *different* value, with
    the batch time as ``updated_at``. The compare is NULL-unsafe, as in the
    reference: a NULL on either side writes no history row. Rows that the
    batch (``batch_tag``) has written already are no history."""
    if batch_tag is not None and BATCH in target.columns:
        target = target.filter(~F.coalesce(F.col(BATCH) == batch_tag, F.lit(False)))
    s = source.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    j = target.join(s, target[key] == s["__k"], "inner").filter(F.col(value) != F.col("__v"))
    keep = [c for c in target.columns if c not in ("updated_at", BATCH)]
    tag = [F.lit(batch_tag).alias(BATCH)] if batch_tag is not None else []
    return j.select(*keep, _ts(batch_ts).alias("updated_at"), *tag)


def insert_missing(target: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """The target plus the source rows whose key it lacks."""
    new = source.join(target.select(key), key, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def replace_slice(latest: DataFrame, batch: DataFrame, part: str = PARTITION) -> DataFrame:
    """K3 as a frame: drop every slice the batch carries (compared in lower
    case, X9; NULL is a slice of its own), then add the batch. The slices
    are broadcast when they are counted to be few."""
    from tarn.operators.joins import few_rows

    touched = few_rows(batch.select(F.lower(F.col(part)).alias("__p")).distinct())
    kept = latest.join(touched, F.lower(latest[part]).eqNullSafe(touched["__p"]), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def prepare_values(df: DataFrame) -> DataFrame:
    """Upsert-time value rule (F9) on the ``value`` column, if any."""
    return df.withColumn("value", censor_symbols("value")) if "value" in df.columns else df


# --- files and schemas ----------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _schema_path(path: str) -> str:
    return f"{path.rstrip('/')}/_schema/current.json"


def _stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    fs, p = _fs(spark, _schema_path(path))
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return T.StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """Add the new columns of ``schema`` to the stored one; a column keeps
    the type it had first."""
    old = _stored_schema(spark, path)
    known = set(old.fieldNames()) if old else set()
    fields = (old.fields if old else []) + [T.StructField(f.name, f.dataType) for f in schema.fields if f.name not in known]
    merged = T.StructType(fields)
    if merged != old:
        fs, p = _fs(spark, _schema_path(path))
        out = fs.create(p, True)
        out.write(bytearray(merged.json(), "utf-8"))
        out.close()
    return merged


def _as_stored(df: DataFrame, schema: T.StructType) -> DataFrame:
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) for c in df.columns])


def with_created_at(schema: T.StructType, datetime_columns: Sequence[str] = ()) -> T.StructType:
    """``schema`` plus ``created_at``, the named columns as timestamps."""
    fields = [T.StructField(f.name, T.TimestampNTZType() if f.name in datetime_columns else f.dataType) for f in schema.fields]
    if "created_at" not in schema.fieldNames():
        fields.append(T.StructField("created_at", T.TimestampNTZType()))
    return T.StructType(fields)


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType, datetime_columns: Sequence[str] = ()) -> bool:
    """K1: create an empty table with ``schema`` plus ``created_at``; True
    if it was created. It reads as empty until its first write."""
    if exists(spark, path):
        return False
    _keep_schema(spark, path, with_created_at(schema, datetime_columns))
    return True


def _has_data(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def read(spark: SparkSession, path: str, internal: bool = False) -> DataFrame:
    """A stored table under its kept schema; bucket and batch tag only with
    ``internal``."""
    schema = _stored_schema(spark, path)
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    df = spark.read.schema(schema).parquet(path) if _has_data(spark, path) else spark.createDataFrame([], schema)
    return df if internal else df.drop(BUCKET, BATCH)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, internal: bool = False) -> DataFrame:
    if _stored_schema(spark, path) is not None or _has_data(spark, path):
        return read(spark, path, internal)
    return spark.createDataFrame([], with_created_at(schema))


# --- writes -------------------------------------------------------------------

class _Staging:
    """Copies of frames in the shared area, removed after success."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def save(self, df: DataFrame) -> DataFrame:
        path = scratch_dir(self.spark, f"staging/{uuid.uuid4().hex}")
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self):
        return self

    def __exit__(self, kind, *_):
        if kind is None:
            for path in self.paths:
                _remove(self.spark, path)


def append(df: DataFrame, path: str, batch_ts, partition: str | None = PARTITION) -> None:
    """K2: append the batch (stamped with ``created_at`` if it lacks one)."""
    if "created_at" not in df.columns:
        df = df.withColumn("created_at", _ts(batch_ts))
    df = _as_stored(df, _keep_schema(df.sparkSession, path, df.schema))
    w = df.write.mode("append")
    if partition and partition in df.columns:
        w = w.partitionBy(partition)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str = PARTITION) -> None:
    """K3: replace exactly the partitions present in ``df``. The rebalance
    brings a partition's rows together and splits an oversized one, so
    files are few and no task holds a hot partition alone."""
    df = _as_stored(df, _keep_schema(df.sparkSession, path, df.schema))
    (df.hint("rebalance", F.col(partition)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def write_latest(spark: SparkSession, batch: DataFrame, path: str, partition: str = PARTITION) -> None:
    """K3: the batch replaces its councils' slices; others stay.
    Council values are normalised to lower case first (X9)."""
    overwrite_partitions(batch.withColumn(partition, F.lower(F.col(partition))), path, partition)


def _touched_part(target: DataFrame, source: DataFrame) -> DataFrame:
    """The target's buckets that ``source`` touches."""
    touched = source.select(BUCKET).distinct()
    listed = [r[0] for r in touched.limit(LISTED_PARTITIONS + 1).collect()]
    if len(listed) <= LISTED_PARTITIONS:
        return target.filter(F.col(BUCKET).isin(listed))
    return target.join(touched, BUCKET, "left_semi")


def _digest(df: DataFrame) -> str:
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return f"{row[0]}-{row[1] or 0}"


def write_upsert(spark: SparkSession, source: DataFrame, path: str, history_path: str | None, batch_ts,
                 key: str = "id", bucket: Column | None = None, batch_tag: str | None = None) -> None:
    """K5 then K4 on a stored table; only the batch's buckets are rewritten.

    ``bucket`` must be a function of the key (default: its hash).
    ``batch_tag`` names the batch; by default its time and a digest of its
    rows, so the same batch twice is one, and another batch of the same
    time is not."""
    with _Staging(spark) as staging:
        source = prepare_values(source)
        if PARTITION in source.columns:
            source = source.withColumn(PARTITION, F.lower(F.col(PARTITION)))          # X9
        source = staging.save(source.withColumn(BUCKET, F.coalesce(bucket if bucket is not None else key_bucket(key), F.lit("none"))))
        tag = batch_tag if batch_tag is not None else f"{batch_ts}-{_digest(source)}"
        schema = with_created_at(source.schema)
        target = _touched_part(read_or_empty(spark, path, schema, internal=True), source)
        if history_path is not None and "value" in source.columns:
            hist = history_rows(target, source, key, "value", batch_ts, tag).drop(BUCKET)
            written = read_or_empty(spark, history_path, hist.schema, internal=True)
            if BATCH in written.columns:                              # a retry adds only what is missing
                hist = hist.join(written.filter(F.col(BATCH) == tag).select(F.col(key).alias("__done")), F.col(key) == F.col("__done"), "left_anti")
            hist = staging.save(hist)
            if not hist.isEmpty():
                append(hist, history_path, batch_ts, partition=None)
        merged = staging.save(upsert(target, source, key, batch_ts, tag))
        overwrite_partitions(merged, path, BUCKET)


def write_insert_missing(spark: SparkSession, source: DataFrame, path: str, batch_ts,
                         key: str = "id", partition: str = PARTITION) -> None:
    """K6: append only the source rows whose key is absent."""
    target = read_or_empty(spark, path, source.schema)
    new = source.join(target.select(key), key, "left_anti")
    append(new, path, batch_ts, partition)


def full_rebuild(df: DataFrame, path: str, partition: str | None = None) -> None:
    """K9: replace the whole table, partitions that ``df`` lacks included.
    The rows are staged first, so ``df`` may read the table itself."""
    spark = df.sparkSession
    with _Staging(spark) as staging:
        w = staging.save(df).write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition:
            w = w.partitionBy(partition)
        w.parquet(path)
        _keep_schema(spark, path, df.schema)


def load(spark: SparkSession, df: DataFrame, path: str, batch_ts, method: str = "insert", key: str = "id",
         history_path: str | None = None, partition: str = PARTITION, bucket: Column | None = None,
         batch_tag: str | None = None) -> bool:
    """K11 + K12: dispatch a batch to insert / upsert. Empty batches are a
    no-op (returns False). ``insert`` appends to the log table at ``path``
    and replaces the batch's slices of ``path + '_latest'``. The batch is
    evaluated once and stamped with one time."""
    if method not in ("insert", "upsert"):
        raise ValueError(f"unknown load method: {method}")
    with _Staging(spark) as staging:
        if method == "insert" and "created_at" not in df.columns:
            df = df.withColumn("created_at", _ts(batch_ts))
        df = staging.save(df)
        if df.isEmpty():
            return False
        if method == "insert":
            append(df, path, batch_ts, partition)
            write_latest(spark, df, path.rstrip("/") + "_latest", partition)
        else:
            write_upsert(spark, df, path, history_path, batch_ts, key, bucket, batch_tag)
    return True
