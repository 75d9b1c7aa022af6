import hashlib
import math
import random

import pytest

from tarn.llm import codebooks
from tarn.llm.codebooks import Block, codes, cuts, op12_codebook_codes, with_label_error

SCHEMA = "vec_id long, embedding array<double>, label int, dim string, n int, code string, error string"


def brute(rows):
    kept = [(i, [min(max(math.floor(4096 * x), -(1 << 40)), 1 << 40) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for dim in {len(v) for _, v, _ in kept}:
        own = [r for r in kept if len(r[1]) == dim]
        first = {}
        for i, v, _ in own:
            first[i] = min(first.get(i, v), v)
        base = [first[i] for i in sorted(first, key=lambda i: (i is None, i or 0))[:16]]
        at = cuts(dim)
        books = [[b[at[p]: at[p + 1]] for b in base] for p in range(8)]

        def near(part, book):
            d = [sum((x - y) ** 2 for x, y in zip(part, e)) for e in book]
            return d.index(min(d)), min(d)
        for _ in range(6):
            for p in range(8):
                got = [[] for _ in base]
                for _, v, _ in own:
                    part = v[at[p]: at[p + 1]]
                    got[near(part, books[p])[0]].append(part)
                books[p] = [[sum(c) // len(g) for c in zip(*g)] if g else e for g, e in zip(got, books[p])]
        sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for i, v, lab in own:
            found = [near(v[at[p]: at[p + 1]], books[p]) for p in range(8)]
            out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), lab, sha))
    sums = {}
    for _, _, e, lab, _ in out:
        sums[lab] = sums.get(lab, 0) + e
    long = lambda x: x if x < 1 << 63 else None
    return sorted(((i, c, long(e), long(sums[lab]), sha) for i, c, e, lab, sha in out), key=str)


def vectors(dim, n, seed, spread=1.0):
    rng = random.Random(seed)
    return [(rng.randrange(10 * n), [rng.gauss(0, spread) for _ in range(dim)], rng.choice([0, 1, 2, None])) for _ in range(n)]


def coded(spark, rows):
    df = spark.createDataFrame([(i, v, lab, "x", 1, "x", "x") for i, v, lab in rows], SCHEMA)
    out = with_label_error(codes(df)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    return sorted(map(tuple, out), key=str)


def test_against_brute_force_with_odd_rows(spark):
    rows = vectors(16, 150, 1)
    rows += [rows[3], rows[3], (rows[4][0], [0.0] * 16, 1), (None, [0.5] * 16, 2), (None, [-0.25] * 16, None)]
    rows += [(-5, None, 0), (-6, [None] * 16, 0), (-7, [math.nan] * 16, 0), (-8, [math.inf] + [0.0] * 15, 0)]
    rows += [(7000 + i, [float(x)] * 16, None) for i, x in enumerate((0, -0.0, 1 / 4096, -1 / 8192, 3e5))]
    assert coded(spark, rows) == brute(rows)


def test_several_lengths_uneven_parts_and_few_rows(spark):
    rows = vectors(19, 40, 2) + vectors(8, 30, 3) + vectors(3, 5, 4) + [(1, [], 0), (2, [], 0), (3, [1.5], None)]
    assert coded(spark, rows) == brute(rows)


def test_numbers_beyond_64_bits(spark):
    rows = vectors(8, 30, 5) + [(50_000 + i, [x * 1e300] * 8, 9) for i, x in enumerate((1, -1, 2))] + [(60_000, [2e7 * i for i in range(8)], 8)]
    assert coded(spark, rows) == brute(rows)


def test_one_vector_in_a_third_of_the_rows_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "CELLS", 256)
    rows = vectors(8, 100, 6) + [(900_000 + i, [0.125] * 8, 1) for i in range(60)]
    assert coded(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert coded(spark, []) == []
    assert coded(spark, [(1, None, 0)]) == []


@pytest.mark.parametrize("table", ["embeddings"])
def test_given_table(spark, table):
    rows = [(r["vec_id"], list(r["embedding"]) if r["embedding"] is not None else None, r["label"]) for r in spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").collect()]
    assert sorted(map(tuple, op12_codebook_codes(spark, "/root/testdata/sf0.001").collect()), key=str) == brute(rows)


def test_block_distances_use_each_distinct_number_once():
    import numpy as np
    x = np.random.default_rng(1).integers(-50, 50, (500, 6))
    block = Block.of(x)
    assert [len(d) for d in block.dictionaries] == [len(set(c)) for c in x.T.tolist()]
    entries = np.random.default_rng(2).integers(-50, 50, (5, 3))
    assert np.array_equal(block.distances(2, 5, entries), ((x[:, None, 2:5] - entries[None]) ** 2).sum(axis=2))
