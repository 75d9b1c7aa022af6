"""Loads that watch themselves: counts taken while the rows are written
(A4), and declared checks that keep bad rows out of a table (Q1-Q3, X15).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tarn.operators.quality import violations
from tarn.operators.records import build_records, prepare_for_load
from tarn.operators.snapshots import SnapshotTable
from tarn.sources.landing import explode_responses


def load_responses(landed: DataFrame, sites: DataFrame, transfer: DataFrame, table: SnapshotTable,
                   batch_ts, batch_tag: str) -> dict[str, int] | None:
    """The daily load into ``table``, with A4's counts: ``n_requests``
    (responses, one a request) and ``n_failed`` (rows with an error). Both are
    observed in the write itself; no second job reads the responses. None
    when a batch of this tag was loaded before.

    Observed counts are a load's diagnostics: a task that runs again after a
    lost executor may count again. The rows do not depend on them;
    :func:`tarn.operators.records.request_counts` counts exactly."""
    if batch_tag in table.manifest()["tags"]:
        return None
    requests, rows = Observation(), Observation()
    seen = landed.observe(requests, F.count(F.lit(1)).alias("n_requests"))
    exploded = explode_responses(seen).observe(rows, F.count_if(F.col("error").isNotNull()).alias("n_failed"))
    table.upsert(prepare_for_load(build_records(exploded, sites, transfer)), batch_ts, batch_tag, compact=False)
    counts = {**requests.get, **rows.get}
    table.compact()
    return counts


def load_checked(batch: DataFrame, table: SnapshotTable, quarantine: SnapshotTable, batch_ts, batch_tag: str,
                 not_null=("id", "variable", "created_at", "agency", "callname"),
                 accepted: dict | None = None, insert_only: bool = True) -> int:
    """Rows that keep the rules go into ``table``, the others into
    ``quarantine`` (:func:`quarantined`); the table's new version.

    ``insert_only``: a key that is stored already breaks uniqueness; else it
    is corrected. Only the stored keys of the batch's buckets are read.
    ``quarantine`` is written first and both writes carry the batch's tag, so
    a load that is run again after a failure anywhere ends in the same rows:
    until the table has the tag, it holds none of the batch's keys."""
    if batch_tag in table.manifest()["tags"]:
        return table.version()
    stored = table.known_keys(batch) if insert_only else None
    judged = violations(batch, table.key, not_null, accepted, stored)
    quarantine.upsert(quarantined(judged, table.key, batch_tag), batch_ts, batch_tag)
    return table.upsert(judged.where(F.size("reasons") == 0).drop("reasons"), batch_ts, batch_tag)


def quarantined(judged: DataFrame, key: str, batch_tag: str) -> DataFrame:
    """The rows that break a rule: the row as JSON under its key, its reasons
    and how many equal rows the batch had; one row per batch, row and reasons."""
    row = F.to_json(F.struct(*[c for c in judged.columns if c != "reasons"]), {"ignoreNullFields": "false"})
    bad = judged.where(F.size("reasons") > 0).select(F.col(key).cast("string").alias("bad_key"), row.alias("bad_row"),
                                                    F.array_join("reasons", ";").alias("reasons"))
    counted = bad.groupBy("bad_key", "bad_row", "reasons").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.sha2(F.concat_ws("\n", F.lit(batch_tag), "reasons", "bad_row"), 256).alias("row_id"),
                          F.lit(batch_tag).alias("batch_tag"), "*")
