import hashlib
import random

import numpy as np
import pytest

from tarn.llm.substrings import SPAN, op9_suffix_dedup, remove_repeats
from tarn.llm.suffix import concatenate, permuted_lcp, suffix_array

SF = "/root/testdata/sf0.001"


def brute(docs):
    """doc index -> (removed mask) with documents in order."""
    seen, out = set(), {}
    for d, raw in docs:
        mask = np.zeros(len(raw), bool)
        for i in range(len(raw) - SPAN + 1):
            s = raw[i:i + SPAN]
            if s in seen:
                mask[i:i + SPAN] = True
            seen.add(s)
        out[d] = mask
    return out


def digest(raw, mask):
    kept = bytes(b for b, m in zip(raw, mask) if not m)
    runs = int(np.sum(mask & ~np.append(False, mask[:-1]))) if len(mask) else 0
    return (len(raw), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest())


def spans_digest(r):
    return (r["n_bytes"], sum(s["hi"] - s["lo"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest())


def test_suffix_array_against_sorting():
    rng = random.Random(5)
    for it in range(150):
        strs = [bytes(rng.choice(b"ab" if it % 2 else b"abc\x00\xff") for _ in range(rng.randint(1, 14))) for _ in range(rng.randint(1, 6))]
        strs = strs * 2 if it % 5 == 0 else strs
        t, seps = concatenate(strs)
        place = {int(s): i for i, s in enumerate(seps)}
        key = [[(0, place[j]) if j in place else (1, int(t[j])) for j in range(i, len(t))] for i in range(len(t))]
        want = sorted(range(len(t)), key=lambda i: key[i])
        sa = suffix_array(t, seps)
        assert sa.tolist() == want
        plcp, _ = permuted_lcp(t, sa, seps)
        for a, b in zip(want, want[1:]):
            n = 0
            while n < min(len(key[a]), len(key[b])) and key[a][n] == key[b][n]:
                n += 1
            assert plcp[b] == n


def test_documents_against_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"].encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want = brute(docs)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op9_suffix_dedup(spark, SF).collect()}
    assert got == {d: digest(raw, want[d]) for d, raw in docs}


@pytest.mark.parametrize("hot", [50_000, 2])
def test_partial_overlaps_and_hot_anchors(spark, make_docs, hot):
    rng = random.Random(3)
    line = "".join(rng.choice("abcdefgh ") for _ in range(160))
    rows = [(100 - i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 60))) + line[rng.randint(0, 20):160 - rng.randint(0, 20)]
             + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [(200, "é" * 400), (201, "a" * 99), (202, "ab" * 300), (203, "same" * 40), (204, "same" * 40)]
    out = remove_repeats(make_docs(rows, extra=True), hot=hot).collect()
    docs = sorted((d, t.encode()) for d, t in rows)
    want = brute(docs)
    assert {r["doc_id"]: spans_digest(r) for r in out} == {d: digest(raw, want[d]) for d, raw in docs}


def test_edge_rows(spark, make_docs):
    rows = [(None, "x" * 150), (1, None), (2, ""), (3, "x" * 150), (4, "pq" * 45), (4, "pq" * 45), (7, "".join(map(str, range(200)))), (7, "".join(map(str, range(200)))), (5, "w" * 120), (5, "w" * 130), (6, "Long " * 60000)]
    out = remove_repeats(make_docs(rows)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(spans_digest(r))
    assert by[None][0][1] == 149                        # the first string stands, its later starts cover all but one byte
    assert by[1][0][:3] == (0, 0, 0) and by[2][0][:3] == (0, 0, 0)
    assert by[3][0][1] == 150
    assert [d[1] for d in by[4]] == [0, 0] and [d[1] for d in by[7]] == [0, 0]
    assert sorted(d[1] for d in by[5]) in ([119, 130], [120, 129])
    assert by[6][0][1] == 300000 - 5
    assert remove_repeats(make_docs([])).collect() == []
