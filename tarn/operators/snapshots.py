"""Keyed tables in versions: upserts, rebuilds and their history, atomically.

A batch (K4) is written once, as files of its own (``data/commit=.../
bucket=...``), and is never changed. A version is one manifest: for each
key bucket the commits it consists of, oldest first. Publishing a version
is creating one file that must not exist yet, so a reader sees all of a
batch or nothing of it, and of two writers one is first; the other reads
the new version and publishes on top of it. Nothing that an open reader
has listed goes away before :meth:`SnapshotTable.vacuum`.

* **Merge on read.** A bucket of one commit is read as it is. In a bucket
  of several the newest row of a key wins (``max_by`` of the commit's
  number); a column that a batch lacked keeps its older value. So a batch
  writes its own rows only, whatever buckets they fall in.
* **History (K5)** needs no join at write time: the versions of a key lie
  side by side in its bucket until they are compacted, and compaction keeps
  the rows that it replaces.
* **Compaction** rewrites the buckets whose later commits weigh more than
  ``ratio`` of their first one (or are more than ``most_commits``), and no
  others. Batches that others published meanwhile stay on top.
* **Replays.** A batch's tag is in the manifest: the same tag again changes
  nothing. With ``skip_unchanged`` rows that equal the stored ones (by a
  sha256 of their columns kept beside the key, so only two columns are
  read) are not written either.
* **Wider types (K7).** A later batch with wider values widens the column
  (integers < double < text); files keep the types they were written with.

Keys are unique within a batch; rows with a null key match nothing and are
kept each. The file system must offer a create or a rename that fails if
the target is there (HDFS does; on a local disk a hard link is used).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators.joins import spread
from tarn.operators.store import BUCKET, PARTITION, _digest, _fs, _remove, _ts, key_bucket, prepare_values
from tarn.session import scratch_dir

COMMIT, SEQ, DIGEST = "commit", "__seq", "__digest"
STAMPS = ("created_at", "updated_at")
_LADDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both (text holds any)."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _LADDER and b in _LADDER:
        at = max(_LADDER.index(a), _LADDER.index(b))
        exact = _LADDER.index(T.IntegerType())
        mixed = (a in _LADDER[:4]) != (b in _LADDER[:4])
        if mixed and min(_LADDER.index(a), _LADDER.index(b)) >= exact:
            return T.DoubleType() if T.LongType() not in (a, b) else T.StringType()
        return _LADDER[at]
    return T.StringType()


def as_read(t: T.DataType) -> T.DataType:
    """The type as files give it back: nested values may be null."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(as_read(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(as_read(t.keyType), as_read(t.valueType))
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, as_read(f.dataType)) for f in t.fields])
    return t


def merged_schema(old: T.StructType | None, new: T.StructType) -> T.StructType:
    fields = {f.name: f.dataType for f in old.fields} if old else {}
    for f in new.fields:
        fields[f.name] = wider(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, key: str = "id", value: str = "value", buckets: int = 64,
                 ratio: float = 1.0, most_commits: int = 8):
        self.spark, self.path, self.key, self.value = spark, path.rstrip("/"), key, value
        self.buckets, self.ratio, self.most_commits = buckets, ratio, most_commits

    # -- versions ------------------------------------------------------------

    def _version_path(self, version: int) -> str:
        return f"{self.path}/_versions/v{version:010d}.json"

    def versions(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.path}/_versions")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def version(self) -> int:
        """The newest version; 0 before the first."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version == 0:
            return {"version": 0, "seq": 0, "schema": None, "commits": {}, "buckets": {}, "history": [], "tags": []}
        fs, p = _fs(self.spark, self._version_path(version))
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> bool:
        """Create the version's file; False if another writer has."""
        jvm = self.spark._jvm
        target, aside = self._version_path(manifest["version"]), f"{self.path}/_versions/.{uuid.uuid4().hex}"
        fs, p = _fs(self.spark, aside)
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        goal = jvm.org.apache.hadoop.fs.Path(target)
        if fs.getScheme() != "file":
            won = not fs.exists(goal) and fs.rename(p, goal)
        else:
            local = lambda x: jvm.java.io.File(x.toUri().getPath()).toPath()
            try:
                jvm.java.nio.file.Files.createLink(local(goal), local(p))
                won = True
            except Exception as error:
                if "FileAlreadyExists" not in str(error):
                    raise
                won = False
        if fs.exists(p):
            fs.delete(p, False)
        return won

    # -- files ---------------------------------------------------------------

    def _write(self, df: DataFrame, folder: str, commit: str) -> dict[str, int]:
        """Write rows with a bucket; bytes by bucket."""
        base = f"{self.path}/{folder}/{COMMIT}={commit}"
        df.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(base)
        fs, p = _fs(self.spark, base)
        files, out = fs.listFiles(p, True), {}
        while files.hasNext():
            f = files.next()
            parent = f.getPath().getParent().getName()
            if f.getPath().getName().startswith("part-") and parent.startswith(f"{BUCKET}="):
                name = parent.partition("=")[2]
                out[name] = out.get(name, 0) + f.getLen()
        return out

    def _scan(self, folder: str, wanted: dict[str, list[str]], m: dict, schema: T.StructType, extra: tuple = ()) -> DataFrame:
        """Rows of the wanted buckets of commits, with commit and bucket:
        one scan for each set of file types, cast to ``schema``."""
        by_types: dict[str, dict[tuple, list[str]]] = {}
        for commit, buckets in wanted.items():
            info = m["commits"][commit]
            whole = info["history_buckets" if folder == "history" else "buckets"]
            some = () if set(buckets) == set(whole) else tuple(sorted(buckets))
            by_types.setdefault(json.dumps(info["schema"]), {}).setdefault(some, []).append(commit)
        names = [*schema.fieldNames(), *extra]
        types = {f.name: f.dataType for f in schema.fields} | {DIGEST: T.BinaryType()} | {s: T.TimestampNTZType() for s in STAMPS}
        out = None
        for own, parts in by_types.items():
            stored = T.StructType.fromJson(json.loads(own))
            there = T.StructType([*stored.fields, *(T.StructField(n, types[n]) for n in (*STAMPS, DIGEST)),
                                  T.StructField(COMMIT, T.StringType()), T.StructField(BUCKET, T.StringType())])
            # whole commits are listed; the buckets not wanted are pruned
            paths = [f"{self.path}/{folder}/{COMMIT}={c}" for commits in parts.values() for c in commits]
            df = self.spark.read.schema(there).option("basePath", f"{self.path}/{folder}").parquet(*paths)
            if any(parts):
                keep = F.lit(False)
                for some, commits in parts.items():
                    keep = keep | (F.col(COMMIT).isin(commits) & (F.col(BUCKET).isin(list(some)) if some else F.lit(True)))
                df = df.where(keep)
            df = df.select(*[(F.col(n) if n in there.fieldNames() else F.lit(None)).cast(types[n]).alias(n) for n in names], COMMIT, BUCKET)
            out = df if out is None else out.unionByName(df)
        return out if out is not None else self.spark.createDataFrame([], T.StructType([*(T.StructField(n, types[n]) for n in names), T.StructField(COMMIT, T.StringType()), T.StructField(BUCKET, T.StringType())]))

    @staticmethod
    def _by_commit(m: dict, value, type_: str) -> Column:
        """A column that looks a commit up, among those that buckets consist
        of (few: compaction joins them)."""
        used = sorted({c for own in m["buckets"].values() for c, _ in own})
        pairs = [x for c in used for x in (F.lit(c), F.lit(value(m["commits"][c])).cast(type_))]
        return F.create_map(*pairs)[F.col(COMMIT)] if pairs else F.lit(None).cast(type_)

    def _wanted(self, m: dict, buckets=None, single: bool | None = None) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for b, entries in m["buckets"].items():
            if (buckets is None or b in buckets) and (single is None or (len(entries) == 1) == single):
                for commit, _ in entries:
                    out.setdefault(commit, []).append(b)
        return out

    @staticmethod
    def _bytes(m: dict, buckets=None) -> int:
        """Stored bytes of the buckets (all)."""
        return sum(size for b, own in m["buckets"].items() if buckets is None or b in buckets for _, size in own)

    # -- reading -------------------------------------------------------------

    def _schema(self, m: dict) -> T.StructType:
        return T.StructType.fromJson(m["schema"]) if m["schema"] else T.StructType([T.StructField(self.key, T.StringType())])

    def _has(self, m: dict, column: str) -> Column | None:
        """Whether a row's batch had the column; None: all had."""
        lacking = [c for c, info in m["commits"].items() if column not in {f["name"] for f in info["schema"]["fields"]}]
        return ~F.col(COMMIT).isin(lacking) if lacking else None

    def _state(self, m: dict, buckets=None, columns: list[str] | None = None, digest: bool = False) -> DataFrame:
        """The rows of a version, with bucket and stamps."""
        schema = self._schema(m)
        data = [c for c in schema.fieldNames() if columns is None or c in columns or c == self.key]
        schema = T.StructType([schema[c] for c in data])
        extra = (*STAMPS, DIGEST) if digest else STAMPS
        time = self._by_commit(m, lambda i: i["ts"], "timestamp_ntz")
        stamped = lambda df: df.withColumn("created_at", F.coalesce("created_at", time))
        tail = ["created_at", "updated_at", *([DIGEST] if digest else []), BUCKET]
        out = [stamped(self._scan("data", self._wanted(m, buckets, single=True), m, schema, extra)).select(*data, *tail)]
        several = self._wanted(m, buckets, single=False)
        if several:
            rows = stamped(self._scan("data", several, m, schema, extra)).withColumn(SEQ, self._by_commit(m, lambda i: i["seq"], "long"))
            out.append(rows.where(F.col(self.key).isNull()).select(*data, *tail))
            rest = [c for c in data if c != self.key]
            partial = {c: h for c in rest if (h := self._has(m, c)) is not None}
            whole = [c for c in rest if c not in partial]
            newest = F.struct(*whole, "updated_at", COMMIT, *([DIGEST] if digest else []))
            size = self._bytes(m, {b for own in several.values() for b in own})
            got = (spread(rows.where(F.col(self.key).isNotNull()), size, self.key).groupBy(BUCKET, self.key)
                   .agg(F.max_by(newest, SEQ).alias("__new"), F.min_by("created_at", SEQ).alias("created_at"), F.count(F.lit(1)).alias("__n"),
                        *[F.max_by(c, F.when(h, F.col(SEQ))).alias(c) for c, h in partial.items()]))
            got = got.withColumn(COMMIT, F.col(f"__new.{COMMIT}"))
            updated = F.when(F.col("__n") > 1, time).otherwise(F.col("__new.updated_at"))
            out.append(got.select(*[F.col(c) if c == self.key or c in partial else F.col(f"__new.{c}").alias(c) for c in data],
                                  "created_at", updated.alias("updated_at"), *([F.col(f"__new.{DIGEST}").alias(DIGEST)] if digest else []), BUCKET))
        whole_table = out[0]
        for df in out[1:]:
            whole_table = whole_table.unionByName(df)
        return whole_table

    def read(self, version: int | None = None, buckets=None) -> DataFrame:
        """The table at a version (the newest): K1 empty before the first."""
        return self._state(self.manifest(version), buckets).drop(BUCKET)

    def known_keys(self, batch: DataFrame) -> DataFrame:
        """The table's keys in the buckets of a batch: no other bucket, and
        no other column, is read."""
        buckets = [r[0] for r in batch.where(F.col(self.key).isNotNull()).select(key_bucket(self.key, self.buckets).cast("string")).distinct().collect()]
        return self._state(self.manifest(), buckets, columns=[]).where(F.col(self.key).isNotNull()).select(self.key)

    def _replaced(self, m: dict, wanted: dict[str, list[str]]) -> DataFrame:
        """K5 rows hidden in these commits: each state that a later one with
        a different value follows, stamped with the later one's time. As in
        SQL a NULL on either side is no difference."""
        schema = self._schema(m)
        data = schema.fieldNames()
        time = self._by_commit(m, lambda i: i["ts"], "timestamp_ntz")
        rows = (self._scan("data", wanted, m, schema, STAMPS).where(F.col(self.key).isNotNull())
                .withColumn(SEQ, self._by_commit(m, lambda i: i["seq"], "long")).withColumn("__ts", time))
        rows = spread(rows, self._bytes(m, {b for own in wanted.values() for b in own}), self.key)
        order = Window.partitionBy(BUCKET, self.key).orderBy(SEQ)
        filled = [(F.col(c) if (h := self._has(m, c)) is None or c == self.key
                   else F.last(F.when(h, F.struct(F.col(c).alias("x"))), ignorenulls=True).over(order)["x"]).alias(c) for c in data]
        rows = rows.select(*filled, F.first(F.coalesce("created_at", "__ts")).over(order).alias("created_at"), "__ts", SEQ, BUCKET)
        before = rows.withColumn("__old", F.lag(F.struct(*data)).over(order)).where(F.col("__old").isNotNull() & (F.col(f"__old.{self.value}") != F.col(self.value)))
        return before.select(*[F.col(f"__old.{c}").alias(c) for c in data], "created_at", F.col("__ts").alias("updated_at"), BUCKET)

    def history(self, version: int | None = None) -> DataFrame:
        """K5: the replaced rows, kept ones and those not yet compacted."""
        m = self.manifest(version)
        if self.value not in self._schema(m).fieldNames():
            return self._state(m, buckets=[]).drop(BUCKET)
        kept = self._scan("history", {c: m["commits"][c]["history_buckets"] for c in m["history"]}, m, self._schema(m), STAMPS).drop(COMMIT)
        return kept.unionByName(self._replaced(m, self._wanted(m, single=False))).drop(BUCKET)

    def changes(self, after: int, until: int | None = None) -> DataFrame:
        """Keys that batches wrote between two versions: (key, ``old``,
        ``new``): the rows before and after, as structs, NULL where absent.
        Reads the touched buckets only. Either side's rows are written to the
        shared folder, and so are the changes: marts read them several times,
        and no task holds all of the joins' sorts at once."""
        old, new = self.manifest(after), self.manifest(until)
        if new.get("rebuilt", 0) > after:
            raise ValueError("the table was rebuilt in between: take all of it")
        batches = {c: i["batch"] for c, i in new["commits"].items() if i.get("batch") and old["seq"] < i["seq"] <= new["seq"]}
        buckets = {b for own in batches.values() for b in own}
        size = self._bytes(new, buckets)
        keys = self._scan("data", batches, new, T.StructType([self._schema(new)[self.key]])).where(F.col(self.key).isNotNull()).select(self.key)
        keys = spread(keys, size, self.key).distinct()
        names = [*self._schema(new).fieldNames(), *STAMPS]
        if not old["schema"]:
            before = self._state(new, buckets=[])
        else:
            before = self._state(old, buckets)
        for f in self._schema(new).fields:
            before = before.withColumn(f.name, (F.col(f.name) if f.name in before.columns else F.lit(None)).cast(f.dataType))
        base = scratch_dir(self.spark, f"changes-{uuid.uuid4().hex}")

        def save(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{base}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{base}/{name}")

        pick = lambda df, name: save(spread(df, size, self.key).join(keys, self.key, "left_semi")
                                     .select(F.col(self.key).alias(f"__{name}"), F.struct(*names).alias(name)), name)
        was, now = pick(before, "old"), pick(self._state(new, buckets), "new")
        joined = spread(was, size, "__old").join(spread(now, size, "__new"), F.col("__old") == F.col("__new"), "full_outer")
        return save(joined.select(F.coalesce("__new", "__old").alias(self.key), "old", "new"), "changes")

    # -- writing -------------------------------------------------------------

    def _row_digest(self, columns) -> Column:
        """sha256 of the columns that are set, each as name, length and text."""
        text = [F.col(c).cast("string") for c in sorted(columns)]
        parts = [F.coalesce(F.concat(F.lit(f"{c}="), F.length(t).cast("string"), F.lit(":"), t), F.lit("")) for c, t in zip(sorted(columns), text)]
        return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))

    def _next(self, m: dict, commit: str, ts, tag: str | None, schema: T.StructType, written: dict[str, int], **more) -> dict:
        seq = m["seq"] + 1
        out = dict(m, version=m["version"] + 1, seq=seq, schema=merged_schema(T.StructType.fromJson(m["schema"]) if m["schema"] else None, schema).jsonValue(),
                   commits=dict(m["commits"]), buckets=dict(m["buckets"]), tags=[*m["tags"], *([tag] if tag is not None else [])])
        if written:
            out["commits"][commit] = {"seq": seq, "ts": str(ts), "schema": schema.jsonValue(), **more}
        return out

    def upsert(self, source: DataFrame, batch_ts, batch_tag: str | None = None, skip_unchanged: bool = False, compact: bool = True) -> int:
        """K4 (and K5): the version that holds the batch. Value and council
        rules as in :func:`tarn.operators.store.write_upsert`; a batch's
        default tag is its time and a digest of its rows."""
        source = prepare_values(source).drop(*STAMPS)
        if PARTITION in source.columns:
            source = source.withColumn(PARTITION, F.lower(F.col(PARTITION)))
        source = source.withColumn(BUCKET, F.coalesce(key_bucket(self.key, self.buckets), F.lit("none")))
        columns = [c for c in source.columns if c != BUCKET]
        schema = T.StructType([T.StructField(f.name, as_read(f.dataType)) for f in source.schema.fields if f.name != BUCKET])
        source = source.withColumn(DIGEST, self._row_digest(columns))
        if batch_tag is not None and batch_tag in self.manifest()["tags"]:
            return self.version()
        while True:
            seen, commit = self.manifest(), uuid.uuid4().hex
            rows = self._changed(source, seen, columns) if skip_unchanged and seen["buckets"] else source
            written = self._write(rows, "data", commit)
            tag = batch_tag if batch_tag is not None else f"{batch_ts}-{self._written_digest(commit, schema, columns, written)}"
            while True:
                m = self.manifest()
                if tag in m["tags"]:
                    self._drop(commit)
                    return m["version"]
                others = {b for c, i in m["commits"].items() if c not in seen["commits"] for b in i.get("batch", i["buckets"])}
                if skip_unchanged and (others & set(written) or (others and not written)):
                    self._drop(commit)                 # what was unchanged may have changed: look again
                    break
                out = self._next(m, commit, batch_ts, tag, schema, written, buckets=sorted(written), batch=sorted(written))
                for b, size in written.items():
                    out["buckets"][b] = [*out["buckets"].get(b, []), [commit, size]]
                if self._publish(out):
                    if not written:
                        self._drop(commit)
                    return self.compact() if compact else out["version"]

    def _changed(self, source: DataFrame, m: dict, columns: list[str]) -> DataFrame:
        """Rows that differ from the stored ones (or are new)."""
        same = set(columns) == set(self._schema(m).fieldNames())
        wanted = [self.key] if same else columns
        known = [c for c in wanted if c in self._schema(m).fieldNames()]
        stored = self._state(m, columns=known, digest=same).where(F.col(self.key).isNotNull())
        stored = stored.select(F.col(self.key).alias("__k"), *([F.col(DIGEST).alias("__d")] if same else [F.col(c).alias(f"__{c}") for c in known]))
        equal = F.col("__d") == F.col(DIGEST) if same else F.lit(True)
        if not same:
            for c in columns:
                equal = equal & (F.col(c).cast("string").eqNullSafe(F.col(f"__{c}").cast("string")) if c in known else F.col(c).isNull())
        return source.join(stored, (F.col(self.key) == F.col("__k")) & equal, "left_anti")

    def _written_digest(self, commit: str, schema: T.StructType, columns: list[str], written: dict[str, int]) -> str:
        if not written:
            return "0-0"
        m = {"commits": {commit: {"schema": schema.jsonValue(), "buckets": sorted(written)}}}
        return _digest(self._scan("data", {commit: sorted(written)}, m, schema).select(*columns))

    def _drop(self, commit: str) -> None:
        for folder in ("data", "history"):
            _remove(self.spark, f"{self.path}/{folder}/{COMMIT}={commit}")

    def compact(self, every: bool = False) -> int:
        """Rewrite buckets whose later commits have grown beyond ``ratio`` of
        the first (``every``: all with more than one); the newest version."""
        m = self.manifest()
        due = [b for b, own in m["buckets"].items() if len(own) > 1 and (every or len(own) > self.most_commits or sum(s for _, s in own[1:]) > self.ratio * own[0][1])]
        if not due:
            return m["version"]
        commit, schema = uuid.uuid4().hex, self._schema(m)
        state = self._state(m, due)
        written = self._write(state.withColumn(DIGEST, self._row_digest(schema.fieldNames())), "data", commit)
        kept: dict[str, int] = {}
        if self.value in schema.fieldNames():
            replaced = self._replaced(m, {c: [b for b in own if b in due] for c, own in self._wanted(m, due).items()})
            kept = self._write(replaced, "history", commit)
        covered = {b: [c for c, _ in m["buckets"][b]] for b in due}
        last = max(m["commits"][c]["seq"] for own in covered.values() for c in own)
        while True:
            now = self.manifest()
            if any([c for c, _ in now["buckets"].get(b, [])][: len(own)] != own for b, own in covered.items()):
                self._drop(commit)                     # another writer compacted or rebuilt
                return now["version"]
            out = self._next(now, commit, m["commits"][covered[due[0]][-1]]["ts"], None, schema, written, buckets=sorted(written), history_buckets=sorted(kept))
            out["seq"] = now["seq"]                    # no batch: later ones stay later
            out["commits"][commit]["seq"] = last
            for b, own in covered.items():
                out["buckets"][b] = [[commit, written[b]], *out["buckets"][b][len(own):]]
            if kept:
                out["history"] = [*out["history"], commit]
            if self._publish(out):
                return out["version"]

    def replace(self, df: DataFrame, batch_ts, batch_tag: str | None = None) -> int:
        """K9: a version of these rows alone, published at once; ``df`` may
        read the table itself. History and the tags of batches stay."""
        rows = df.drop(BUCKET).withColumn(BUCKET, F.coalesce(key_bucket(self.key, self.buckets), F.lit("none")))
        columns = [c for c in df.columns if c not in (BUCKET, *STAMPS)]
        schema = T.StructType([T.StructField(f.name, as_read(f.dataType)) for f in df.schema.fields if f.name in columns])
        for s in STAMPS:
            if s not in rows.columns:
                rows = rows.withColumn(s, (_ts(batch_ts) if s == "created_at" else F.lit(None)).cast("timestamp_ntz"))
        commit = uuid.uuid4().hex
        written = self._write(rows.withColumn(DIGEST, self._row_digest(columns)), "data", commit)
        while True:
            m = self.manifest()
            if batch_tag is not None and batch_tag in m["tags"]:
                self._drop(commit)
                return m["version"]
            if self.value in self._schema(m).fieldNames() and self._wanted(m, single=False):
                self.compact(every=True)               # keeps what the rebuild would forget
                m = self.manifest()
            out = self._next(m, commit, batch_ts, batch_tag, schema, written, buckets=sorted(written))
            kept_history = {c: m["commits"][c] for c in m["history"]}
            out["commits"] = {**kept_history, **({commit: out["commits"][commit]} if written else {})}
            out["schema"] = merged_schema(None, schema).jsonValue()
            for c in m["history"]:
                out["schema"] = merged_schema(T.StructType.fromJson(out["schema"]), T.StructType([])).jsonValue()
            out["buckets"] = {b: [[commit, size]] for b, size in written.items()}
            out["rebuilt"] = out["version"]
            if self._publish(out):
                return out["version"]

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete all but the newest ``keep`` versions and the files that
        none of them names; commits whose rows only an older version needed
        go from the manifest's books as well. For when no reader of an older
        version and no writer is left."""
        versions = self.versions()
        needed: set[str] = set()
        for v in versions[-keep:]:
            m = self.manifest(v)
            needed |= {c for own in m["buckets"].values() for c, _ in own} | set(m["history"])
        for v in versions[:-keep]:
            _remove(self.spark, self._version_path(v))
        newest = self.manifest()
        self._publish(dict(newest, version=newest["version"] + 1, commits={c: i for c, i in newest["commits"].items() if c in needed}))
        gone = []
        for folder in ("data", "history"):
            fs, p = _fs(self.spark, f"{self.path}/{folder}")
            for s in (fs.listStatus(p) if fs.exists(p) else []):
                name = s.getPath().getName().partition("=")[2]
                if name and name not in needed:
                    fs.delete(s.getPath(), True)
                    gone.append(name)
        return gone
