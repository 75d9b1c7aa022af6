import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarn.llm import decontaminate
from tarn.llm.decontaminate import RADIUS, THRESHOLD, _blocks, drop_contaminated, find_passages, op4_decontaminate, simhash

SF = "/root/testdata/sf0.001"
BENCH = "item_id long, text string, fp string"


def tokens(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def grams(w, k):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def brute(docs, items, threshold=THRESHOLD):
    """(doc, item) -> best similarity over all windows of the item's size."""
    words = {i: tokens(t) for i, t in items if tokens(t)}
    spread = Counter(g for i, w in words.items() for g in set(grams(w, min(5, len(w)))))
    out = {}
    for d, text in docs:
        w = tokens(text)
        has = {k: set(grams(w, k)) for k in range(1, 6)}
        for i, item in words.items():
            k = min(5, len(item))
            want = Counter(grams(item, k))
            if not has[k].intersection(want):
                continue
            total = sum(n / spread[g] for g, n in want.items())
            n = min(len(item), len(w))
            best = 0
            for s in range(len(w) - n + 1):
                own = Counter(grams(w[s:s + n], k))
                best = max(best, sum(min(c, own[g]) / spread[g] for g, c in want.items()) / total)
            if round(best, 9) >= threshold:
                out[(d, i)] = round(best, 9)
    return out


def test_documents_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in op4_decontaminate(spark, SF).collect()}
    assert got == pytest.approx(brute(docs, items)) and got


@pytest.mark.parametrize("literals", [50_000, 0])
def test_edits_edges_and_joined_benchmark(spark, make_docs, literals):
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    items = [(i, " ".join(words(30 + i))) for i in range(20)] + [(50, "one two three"), (51, None), (52, ""), (53, "Solo"), (54, None)]
    items += [(60, items[0][1]), (None, " ".join(words(25)))]
    rows = []
    for i in range(20):
        own = items[i][1].split()
        if i % 4 == 1:
            own[rng.randrange(len(own))] = "changed"
        if i % 4 == 2:
            own.insert(3, "extra")
        if i % 4 == 3:
            own = own[: len(own) * 6 // 10]
        rows.append((i, " ".join(words(40) + own + words(30))))
    rows += [(100, items[5][1].upper().replace(" ", ", ")), (101, None), (102, ""), (103, "so one two three go"), (104, "solo"), (105, "x " * 60000 + items[6][1]),
             (106, items[-1][1]), (None, items[7][1]), (107, items[8][1]), (107, items[8][1]), (108, "two three")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], BENCH)
    docs = make_docs(rows, extra=True)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in find_passages(docs, bench, literals=literals).collect()}
    want = brute(rows, items)
    # a fingerprint farther than the radius may lose a window near the threshold, never add one
    assert set(got) <= set(want) and all(abs(got[k] - want[k]) < 0.2 for k in got)
    assert {k for k, s in want.items() if s >= 0.82} <= set(got)
    left = sorted(str(r["doc_id"]) for r in drop_contaminated(docs, bench).collect())
    assert left == sorted(str(d) for d, _ in rows if d not in {k[0] for k in got})


def test_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([(1, "a b c d e f", "x")], BENCH)
    assert find_passages(make_docs([]), bench).collect() == []
    assert find_passages(make_docs([(1, "a b c d e f")]), bench.where("false")).collect() == []


def test_blocks_meet_within_the_radius(spark):
    rng = random.Random(2)
    for _ in range(500):
        flips = rng.sample(range(64), RADIUS)
        per = Counter(b // 8 for b in flips)
        assert min(per[b] for b in range(8)) <= 1
    row = spark.createDataFrame([([(5, 3), (6, 1), (7, 1)],)], "w array<struct<shingle:bigint,w:bigint>>").select(simhash(F.col("w")).alias("fp")).select("fp", _blocks(F.col("fp")).alias("b")).first()
    assert sum(b["value"] << (8 * b["block"]) for b in row["b"]) == row["fp"] % (1 << 64)


def test_rows_of_null_and_repeated_ids_go_by_their_own_text(spark, make_docs):
    item = " ".join(f"q{i}" for i in range(30))
    clean = [f"clean text number {i} stays here" for i in range(4)]
    rows = [(None, "so " + item), (None, clean[0]), (None, clean[1]), (None, None), (7, clean[2]), (7, item + " end"), (7, item + ", end!"), (8, clean[3])]
    bench = spark.createDataFrame([(1, item, "x")], BENCH)
    left = [(r["doc_id"], r["text"]) for r in drop_contaminated(make_docs(rows, extra=True), bench).collect()]
    assert sorted(left, key=str) == sorted([(None, clean[0]), (None, clean[1]), (None, None), (7, clean[2]), (8, clean[3])], key=str)


@pytest.mark.parametrize("literals", [50_000, 0])
def test_items_of_one_template_are_found_without_it(spark, make_docs, literals):
    rng = random.Random(11)
    words = lambda n: [f"t{rng.randrange(100_000)}" for _ in range(n)]
    template, own = words(20), [words(30) for _ in range(60)]
    items = [(i, " ".join(template + w)) for i, w in enumerate(own)]
    rows = [(i, " ".join(words(40) + w + words(10))) for i, w in enumerate(own[:30])] + [(100, " ".join(template + words(40)))]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], BENCH)
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["distance"]) for r in find_passages(make_docs(rows), bench, literals=literals).collect()}
    want = brute(rows, items)
    assert {k for k in want} == {(i, i) for i in range(30)} and {k: s for k, (s, _) in got.items()} == pytest.approx(want)
    assert all(d <= RADIUS for _, d in got.values())


def test_fingerprints_decide_and_seldom_miss(spark, make_docs, monkeypatch):
    """Items of templates, documents with a window near the threshold."""
    rng = random.Random(23)
    words = lambda n: [f"m{rng.randrange(1_000_000)}" for _ in range(n)]
    templates = [words(20) for _ in range(10)]
    items = [(i, " ".join(templates[i % 10] + words(40))) for i in range(500)]
    rows = []
    for i, text in items:
        own = text.split()
        at = rng.randrange(25, 45)
        own[at:at + 4] = words(4)           # eight shingles of about forty
        rows.append((i, " ".join(words(30) + own + words(10))))
    want = brute(rows, items)
    assert len(want) > 400 and sum(s < 0.85 for s in want.values()) > 400
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], BENCH)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in find_passages(make_docs(rows), bench).collect()}
    assert set(got) <= set(want) and all(got[k] == pytest.approx(want[k]) for k in got)
    assert len(got) >= 0.99 * len(want)
    monkeypatch.setattr(decontaminate, "RADIUS", -1)
    assert find_passages(make_docs(rows[:20]), bench).collect() == []
