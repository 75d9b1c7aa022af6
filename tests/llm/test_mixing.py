import random
import re

from tarn.llm import mixing
from tarn.llm.mixing import document_mix, mix, op10_pivotal_mix, pivot

SF = "/root/testdata/sf0.001"


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        share = {s: left * w[s] / sum(w[t] for t in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s] + 1e-9}
        if not over:
            return {**share, **{s: float(cap * sizes[s]) for s in capped}}
        capped |= over


def check(rows, docs):
    sizes, biggest = {}, {}
    count = {d[0]: len(re.findall("[^\x20\x09-\x0d]+", d[1] or "")) for d in docs}
    for r in rows:
        assert r["size"] == count[r["doc_id"]]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        biggest[r["source"]] = max(biggest.get(r["source"], 0), r["size"])
    targets = brute_targets(sizes)
    for s in sizes:
        own = [r for r in rows if r["source"] == s]
        assert all(abs(r["target"] - targets[s]) < 1e-6 * max(1, targets[s]) for r in own)
        assert all(r["source_size"] == sizes[s] for r in own)
        assert all(0 <= r["copies"] <= 3 for r in own)
        assert abs(sum(r["copies"] * r["size"] for r in own) - targets[s]) <= biggest[s] / 2 + 1e-6


def test_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = op10_pivotal_mix(spark, SF).collect()
    assert len(out) == len(docs)
    check(out, docs)
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, op10_pivotal_mix(spark, SF).collect()), key=str)


def test_tree_of_many_levels(spark, make_docs):
    rows = [(i, "w " * (1 + i * 7 % 23), "en", f"s{min(i % 9, 3)}") for i in range(900)]
    out = mix(make_docs(rows, extra=True), fan_in=4).collect()
    check(out, rows)


def test_edge_rows(spark, make_docs):
    rows = [(1, None, "en", None), (2, "", "en", "a"), (3, "a b c", "en", "a"), (3, "a b c", "en", "a"), (None, "d e", "en", "b"), (5, "x " * 40000, "en", "b")]
    out = mix(make_docs(rows)).collect()
    assert sorted(r["size"] for r in out) == sorted([0, 0, 3, 3, 2, 40000])
    kept = document_mix(make_docs(rows)).collect()
    assert len(kept) == sum(r["copies"] for r in out)
    assert mix(make_docs([])).collect() == [] and document_mix(make_docs([])).collect() == []


def test_a_repeated_row_is_dealt_into_many_groups(spark, make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 64)
    rows = [(7, "same words here", "en", "a")] * 1000 + [(i, "w " * (1 + i % 5), "en", "b") for i in range(100, 400)]
    docs = make_docs(rows, extra=True)
    numbered = mixing.number_repeats(docs.select("doc_id", "text"))
    assert sorted(r["number"] for r in numbered.where("doc_id = 7").collect()) == list(range(1000))
    out = mix(docs, fan_in=50).collect()
    assert len(out) == len(rows)
    for s in ("a", "b"):
        own = [r for r in out if r["source"] == s]
        assert abs(sum(r["copies"] * r["size"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1e-6
    kept = document_mix(docs, fan_in=50)
    assert kept.columns == docs.columns and kept.count() == sum(r["copies"] for r in out)


def test_pivot_keeps_mass_and_expectation():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 12)
        sizes, probs = [rng.randint(1, 50) for _ in range(n)], [rng.random() for _ in range(n)]
        out = pivot(list(range(n)), sizes, probs, rng.randint(0, 10**9))
        assert sum(1 for p in out if 1e-9 < p < 1 - 1e-9) <= 1
        assert abs(sum(s * p for s, p in zip(sizes, probs)) - sum(s * p for s, p in zip(sizes, out))) < 1e-6
    mean = [0.0] * 4
    for seed in range(4000):
        for i, p in enumerate(pivot([1, 2, 3, 4], [3, 1, 2, 2], [0.3, 0.6, 0.5, 0.2], seed)):
            mean[i] += p / 4000
    assert all(abs(m - e) < 0.03 for m, e in zip(mean, [0.3, 0.6, 0.5, 0.2]))
