"""Session factory and session-level helpers.

Cluster settings (master, memory, checkpoint dir, shuffle partitions) are
the deployer's; :func:`get_session` only fills in what is unset so that
tests and the bench get a sane local session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library's semantics depend on; applied to every session.
SEMANTIC_CONF = {
    # Observation times carry no zone; all date maths in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Repeated XML/GML names: the last occurrence wins (map_from_entries).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, turn small-side sort-merge joins into broadcasts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_semantic_conf(spark: SparkSession) -> SparkSession:
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app_name: str = "tarn",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, creating a local one when none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return apply_semantic_conf(active)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("TARN_DRIVER_MEMORY", "8g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SEMANTIC_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployer sets it to shared storage and it is used as
    is. Only when it is unset and the master is local (tests) do we point
    it at a fresh scratch folder: elsewhere executors would not share it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tarn-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), name)


def written(df, label: str):
    """``df`` written to the shared folder and read back: what reads it does
    none of its work again, nor in the same tasks."""
    import uuid

    path = scratch_dir(df.sparkSession, f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_table(spark: SparkSession, name: str, build, source_dir: str = ""):
    """Read the table ``name`` from the shared folder, writing it from
    ``build()`` first when it is absent.

    Used for tables the pipeline keeps (site and variable lookups, the raw
    records): reading them back from Parquet gives Catalyst real file
    sizes, so broadcast decisions rest on a measured size, and it cuts the
    lineage of everything built on them. The table's folder is named by the
    code and by the files of ``source_dir`` (names, sizes, times), so
    changed input is read again. It is written aside and moved into place:
    two sessions cannot write into one folder.
    """
    import hashlib
    import uuid

    tag = hashlib.sha1(f"{name}|{source_dir}|{_files_tag(spark, source_dir)}|{_code_tag()}".encode()).hexdigest()[:16]
    path = scratch_dir(spark, f"tables/{name}-{tag}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
        df = build()
        df.write.parquet(aside.toString())
        if fs.exists(target) or not fs.rename(aside, target):
            fs.delete(aside, True)                    # another session was first
    return spark.read.parquet(path)


def _files_tag(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the files under ``folder``."""
    if not folder:
        return ""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return "|".join(sorted(found))


def _code_tag() -> str:
    """Digest of the package sources, so a stored table built by other code
    is never reused."""
    import hashlib
    import pathlib

    root = pathlib.Path(__file__).parent
    h = hashlib.sha1()
    for f in sorted(root.rglob("*.py")):
        h.update(f.read_bytes())
    return h.hexdigest()[:12]
