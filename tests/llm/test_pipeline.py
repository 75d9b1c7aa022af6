import os
import random
import re
import sys
import zlib

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P
from tarn.llm.common import Scratch
from test_decontaminate import brute as passages
from test_hilbert import check_law
from test_jaccard import brute as components
from test_mixing import brute_targets

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    scratch = Scratch(spark, "test-pipeline")
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in P.STAGES:
        before = docs.collect()
        docs = scratch.save(stage(spark, docs, SF), name)
        kept[name] = (before, docs.collect(), docs.columns)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(kept[n][2] == columns for n, _ in P.STAGES[:-1])

    before, after, _ = kept["toxicity"]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    labelled = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    assert gone & toxic and len(gone & labelled) <= 0.02 * len(labelled)

    before, after, _ = kept["near_copies"]
    group = {d: c for d, _, c in components([(r["doc_id"], r["text"]) for r in before], percent=80, k=5)}
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, c in group.items() if d == c)

    before, after, _ = kept["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {d for d, _ in passages([(r["doc_id"], r["text"]) for r in before], items)}
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - found

    before, after, _ = kept["mixing"]
    size = {r["doc_id"]: len(re.findall("[^\x20\x09-\x0d]+", r["text"])) for r in before}
    by_source, taken = {}, {}
    for r in before:
        by_source[r["source"]] = by_source.get(r["source"], 0) + size[r["doc_id"]]
    for r in after:
        taken[r["source"]] = taken.get(r["source"], 0) + size[r["doc_id"]]
    for s, target in brute_targets(by_source).items():
        assert abs(taken.get(s, 0) - target) <= max(size[r["doc_id"]] for r in before if r["source"] == s)

    before, after, _ = kept["sharding"]
    check_law(after, [(r["doc_id"], r["text"]) for r in before])


def table(spark, folder, name, df):
    df.write.parquet(f"{folder}/{name}.parquet")


def test_run_on_nulls_empties_repeats_and_extra_columns(spark, tmp_path, make_docs):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = [" ".join(word() for _ in range(40)) for _ in range(30)]
    rows = [(i, t, "en", "ab"[i % 2]) for i, t in enumerate(texts)]
    near = texts[0].split()
    near[20] = "other"                                      # 31 of 41 shingles: no link; at the end: 35 of 37
    rows += [(100, " ".join(near)), (101, texts[1] + " tail"), (102, texts[2]), (102, texts[2]), (103, None), (104, ""), (105, " \t"),
             (None, texts[3] + " end"), (None, texts[4].upper()), (None, " ".join(word() for _ in range(40))), (7, " ".join(word() for _ in range(50))),
             (106, " ".join(word() for _ in range(60_000)), None, None)]
    for name in ("labels", "benchmark"):
        table(spark, tmp_path, name, spark.read.parquet(f"{SF}/{name}.parquet"))
    table(spark, tmp_path, "documents", make_docs(rows, extra=True))
    out = P.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in out}
    assert ids >= {5, 6, 8, 106} and 101 not in ids and sum(r["doc_id"] == 102 for r in out) == 0      # copies of 1 and 2 are gone
    worded = {r["text_crc32"] for r in out} - {zlib.crc32(t.encode()) for t in ("", " \t")}
    assert len(worded) == 30 + 1 + 1 + 1 + 1     # the other text, an unnamed one, the second 7, the long one
    assert sorted(r["slot"] for r in out if r["shard"] == 0) == list(range(sum(r["shard"] == 0 for r in out)))


def test_run_on_an_empty_table(spark, tmp_path, make_docs):
    for name in ("labels", "benchmark"):
        table(spark, tmp_path, name, spark.read.parquet(f"{SF}/{name}.parquet"))
    table(spark, tmp_path, "documents", make_docs([]))
    assert P.run(spark, str(tmp_path)).collect() == []


def test_run_returns_the_last_stage(spark):
    out = P.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "shard", "slot", "law"} <= set(out.columns) and out.count() > 0
