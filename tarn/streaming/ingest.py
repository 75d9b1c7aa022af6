"""Incremental ingest of landed responses with Structured Streaming.

The file source's checkpointed log replaces the reference's high-water
mark: each run (``availableNow``) picks up exactly the files landed since
the last one, whatever dates they hold. There is deliberately **no
event-time watermark**: councils backfill arbitrarily old periods, and a
watermark would drop those rows as late.

Each micro-batch is exploded and keyed with the same functions as the
batch load, deduplicated inside the batch (T3), then written with the
history-then-upsert of the store (T2). The batch's tag is the id of the
query (kept in its checkpoint) and the batch number: a batch run again
after a failure changes only what the first attempt left, and a new
checkpoint, which counts from 0 again, has tags of its own.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn import schemas as S
from tarn.operators.records import build_records, prepare_for_load
from tarn.operators.store import month_bucket, write_upsert
from tarn.sources.landing import explode_responses

LANDED_STREAM = T.StructType(S.LANDED_RESPONSE.fields + [
    T.StructField("date_start", T.StringType()),
    T.StructField("date_end", T.StringType()),
])


def process_batch(spark: SparkSession, landed: DataFrame, sites: DataFrame, transfer: DataFrame,
                  table_path: str, history_path: str, batch_tag: str, batch_ts) -> bool:
    """One micro-batch: explode, key, dedup, then history + upsert."""
    if landed.isEmpty():                                          # K11
        return False
    records = prepare_for_load(build_records(explode_responses(landed), sites, transfer))
    write_upsert(spark, records, table_path, history_path, batch_ts, bucket=month_bucket("t"), batch_tag=batch_tag)
    return True


def query_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """Id of the query that owns a checkpoint folder."""
    return json.loads("".join(r[0] for r in spark.read.text(f"{checkpoint_dir}/metadata").collect()))["id"]


def ingest(spark: SparkSession, landing_dir: str, table_path: str, history_path: str,
           checkpoint_dir: str, sites: DataFrame, transfer: DataFrame,
           schema: T.StructType = LANDED_STREAM, batch_ts=None, max_files: int | None = None):
    """Run the ingest once over everything landed since the last run."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(landing_dir)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        ts = batch_ts or spark.range(1).select(
            F.current_timestamp().cast("timestamp_ntz")).first()[0].isoformat(sep=" ")
        tag = f"{query_id(spark, checkpoint_dir)}-{batch_id}"
        process_batch(spark, df, sites, transfer, table_path, history_path, tag, ts)

    q = (stream.writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
