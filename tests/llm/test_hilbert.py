import zlib

import pytest
from pyspark.sql import functions as F

from tarn.llm.hilbert import document_shards, hilbert_index, op2_hilbert_shards, shard_digest, shard_manifest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 4), (3, 3)])
def test_curve_visits_every_cell_by_unit_steps(spark, n, bits):
    side = 1 << bits
    df = spark.range(side ** n).select(*[(F.floor(F.col("id") / side ** i) % side).cast("int").alias(f"d{i}") for i in range(n)])
    rows = df.select("*", hilbert_index([F.col(f"d{i}") for i in range(n)], bits).alias("h")).collect()
    path = [tuple(r[:n]) for r in sorted(rows, key=lambda r: r["h"])]
    assert sorted(r["h"] for r in rows) == list(range(side ** n))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def check_law(rows, docs, shards=24):
    assert sorted(r["doc_id"] for r in rows) == sorted(d[0] for d in docs)
    counts = [0] * shards
    for r in rows:
        counts[r["shard"]] += 1
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_shards_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    out = op2_hilbert_shards(spark, SF).collect()
    check_law(out, docs)
    text = {d["doc_id"]: d["text"] for d in docs}
    for r in out:
        raw = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw)
        assert r["law"] == "rows" and r["grown_shard"] is None
    # the cut follows the curve
    place = sorted(out, key=lambda r: (r["shard"], r["slot"]))
    assert [r["hilbert"] for r in place] == sorted(r["hilbert"] for r in out)


def test_hot_cell_nulls_and_repeats(spark, make_docs):
    rows = [(i, "same text", "en", "hot") for i in range(2000)] + [(3000, None, None, None), (3001, "", "en", "x"), (3001, "", "en", "x"), (3002, "é" * 50000, "fr", "y")]
    out = shard_digest(document_shards(make_docs(rows, extra=True))).collect()
    check_law(out, rows)
    assert [r["size"] for r in out if r["doc_id"] == 3000] == [8]
    again = shard_digest(document_shards(make_docs(list(reversed(rows))))).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_empty_and_manifest(spark, make_docs):
    assert document_shards(make_docs([])).collect() == []
    m = shard_manifest(document_shards(make_docs([(i, "x" * i, "en", f"s{i % 5}") for i in range(100)]))).collect()
    assert sum(r["rows"] for r in m) == 100 and all(r["min_size_bin"] <= r["max_size_bin"] for r in m)
