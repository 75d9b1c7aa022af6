import numpy as np
import pytest

from tarn.llm.common import Scratch
from tarn.llm.hnsw import build, build_index, nearest, op7_hnsw_search, valid_vectors

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, query string, score string, dim string"


def brute(rows, k=10):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.asarray(v, np.float32).astype(np.float64)
    out = {}
    for q, v in ok.items():
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in ok.items() if i != q and len(w) == len(v))
            out[q] = near[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def search(spark, rows, **kw):
    vectors = valid_vectors(spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], SCHEMA))
    scratch = Scratch(spark, "test-hnsw")
    return found(nearest(vectors.where("vec_id % 100 = 0"), build_index(vectors, scratch, **kw), scratch))


def test_recall_and_exact_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, got = brute(rows), found(op7_hnsw_search(spark, SF))
    assert set(got) == set(want)
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    vec = {i: np.asarray(v, np.float64) for i, v in rows}
    for q, near in got.items():
        assert len(near) == 10 and near == sorted(near)
        assert all(abs(s - np.sqrt(((vec[q] - vec[i]) ** 2).sum())) < 1e-12 for s, i in near)


def test_several_shards_copies_and_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(600)]
    same = [0.5] * 8
    rows += [(1000 + i, same) for i in range(400)]                  # a third of all rows, four of them queries
    rows += [(2000, None), (2100, [0.0] * 8), (2200, [None] + [1.0] * 7), (2300, [float("nan")] * 8), (2400, [float("inf")] + [1.0] * 7), (2500, []),
             (None, same), (100, rows[100][1]), (2600, [1.0, 2.0]), (2601, [1.0, 2.5])]
    want, got = brute(rows), search(spark, rows, rows_per_shard=100)
    assert set(got) == set(want)
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hit >= 0.95 * sum(map(len, want.values()))
    for q in (1000, 1100, 1200, 1300):
        assert [i for _, i in got[q]] == [i for i in range(1000, 1012) if i != q][:10] and got[q][0][0] == 0
    assert [i for _, i in got[2600]] == [2601]                      # fewer candidates than k
    assert search(spark, []) == {}


def test_graph_alone():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 16))
    g = build(x, np.arange(800))
    hits = 0
    for q in rng.normal(size=(50, 16)):
        true = np.argsort(((x - q) ** 2).sum(1))[:10]
        hits += len(set(true.tolist()) & set(g.search(q, 80)[:10].tolist()))
    assert hits >= 0.95 * 500


def test_a_search_for_more_than_the_index_keeps_raises(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "vec_id long, embedding array<double>")
    scratch = Scratch(spark, "test-hnsw-k")
    vectors = valid_vectors(rows)
    index = build_index(vectors, scratch, k=3)
    assert nearest(vectors.where("vec_id = 5"), index, scratch, k=3).count() == 3
    with pytest.raises(Exception, match="keeps equal vectors"):
        nearest(vectors.where("vec_id = 5"), index, Scratch(spark, "test-hnsw-k2"), k=4).count()
