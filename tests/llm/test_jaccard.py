import random
import re

import numpy as np
import pytest

from tarn.llm.jaccard import _bits, _schemes, bands, drop_near_copies, far_apart, hamming, op6_jaccard_join, plan, set_keys, similar_components, sketch

SF = "/root/testdata/sf0.001"


def shingles(text, k=4):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, percent=85, k=4):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    comp = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            comp[find(i)] = min(comp.get(find(i), d), d)
    return sorted((d, len(sets[i]), comp.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def test_documents_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, op6_jaccard_join(spark, SF).collect())) == brute(rows)


def mutants(seed=1, families=12):
    rng, rows = random.Random(seed), []
    for _ in range(families):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([1, 3, 5, 6, 8, 12, 30, 90, 300]))]
        for _ in range(rng.randint(1, 7)):
            own = list(words)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                i = rng.randrange(len(own))
                rng.choice([lambda: own.__setitem__(i, "edit"), lambda: own.insert(i, "new"), lambda: own.pop(i) if len(own) > 1 else None])()
            rows.append((len(rows) * 3 + 1, " ".join(own)))
    return rows


def test_mutated_families_and_a_large_group(spark, make_docs):
    rows = [r for s in range(6) for r in [(d + 10_000 * s, t) for d, t in mutants(s)]]
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    for i in range(150):
        own = list(base)
        own[rng.randrange(120)] = f"edit{rng.randrange(40)}"
        rows.append((900_000 + i, " ".join(own)))
    rows += [(990_000 + i, "same words in every copy here") for i in range(60)]
    assert sorted(map(tuple, similar_components(make_docs(rows, extra=True)).collect())) == brute(rows)


def test_keys_compared_block_by_block(spark, make_docs):
    rng, rows = random.Random(3), []
    for g in range(3):                              # chains of sets that link to some others only
        base = [f"g{g}w{i}" for i in range(60)]
        for i in range(40):
            own = list(base)
            for j in range(i % 12):
                own[(j * 5 + i) % 60] = f"e{g}{j}{i // 12}"
            rows.append((g * 100 + i, " ".join(own)))
    rng.shuffle(rows)
    assert sorted(map(tuple, similar_components(make_docs(rows), block_rows=5, small_rows=3).collect())) == brute(rows)


def test_edge_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "two words"), (7, "a " * 30000), (7, "a " * 30000), (None, "one"), (8, " ".join(map(str, range(20000))))]
    got = sorted(map(tuple, similar_components(make_docs(rows)).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (None, 1, 4), (6, 1, 6), (7, 1, 7), (7, 1, 7), (8, 19997, 8)], key=str)
    kept = sorted(str(r["doc_id"]) for r in drop_near_copies(make_docs(rows)).collect())
    assert kept == sorted(["1", "2", "3", "4", "6", "7", "8"])
    assert similar_components(make_docs([])).collect() == [] and drop_near_copies(make_docs([])).collect() == []


@pytest.mark.parametrize("n", [6, 7, 13, 14, 20, 40, 97, 400, 1500])
def test_every_linked_pair_shares_a_probed_key(n):
    rng, tops = np.random.default_rng(n), bands(4000)
    for trial in range(min(60, max(4, 4000 // n))):
        big = rng.integers(1, 1 << 63, 2 * n, dtype=np.uint64)
        r = np.unique(big[:n])
        for gone in range(n):                       # the most different partner that still links
            added = int(rng.integers(0, gone + 1))
            if 100 * (n - gone) < 85 * (n + added):
                break
            s = np.unique(np.concatenate([r[gone:], big[n: n + added]]))
            keys = {}
            for own, side in ((r, 0), (s, 1)):
                for scheme in _schemes(len(own), tops, 85):
                    k, p = set_keys(own, *scheme)
                    for key, probed in zip(k.tolist(), p.tolist()):
                        keys.setdefault(key, {}).setdefault(side, False)
                        keys[key][side] |= probed
            assert any(len(v) == 2 and (v[0] or v[1]) for v in keys.values()) or np.array_equal(r, s)


def test_plan_reaches_the_distance():
    for top in bands(30_000):
        m, d = plan(top)
        assert m + d >= hamming(top, top * 100 // 85) + 1


def test_sketches_rule_out_no_linked_pair():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n, extra = int(rng.integers(1, 400)), int(rng.integers(0, 60))
        a = np.unique(rng.integers(1, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[int(rng.integers(0, max(1, n // 6))):], rng.integers(1, 1 << 63, extra, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        linked = len(b) and 100 * both >= 85 * (len(a) + len(b) - both)
        if linked:
            assert not far_apart(*_bits(sketch(a)), len(a), *_bits(sketch(b)), len(b), 85)


def test_rows_of_null_and_repeated_ids_are_told_apart(spark, make_docs):
    text = [" ".join(f"{g}x{i}" for i in range(60)) for g in "abcdef"]
    near = [t + " tail" for t in text]
    rows = [(None, text[0]), (None, near[0]), (None, text[1]), (1, near[1]),      # no id: copies of each other, a copy of document 1
            (2, text[2]), (2, text[3]), (2, text[3]), (3, near[2]), (0, near[3]),   # one id in two components, in one of them not the first
            (4, text[4]), (4, near[4]), (None, text[5]), (5, " \n"), (5, " \n"), (None, ""), (None, "")]
    kept = [(r["doc_id"], r["text"]) for r in drop_near_copies(make_docs(rows, extra=True)).collect()]
    of = lambda g: [(d, t) for d, t in kept if t in (text[g], near[g])]
    assert of(1) == [(1, near[1])] and of(2) == [(2, text[2])] and of(3) == [(0, near[3])] and of(5) == [(None, text[5])]
    assert len(of(0)) == 1 and [d for d, _ in of(4)] == [4]
    assert sorted((r for r in kept if not r[1].strip()), key=str) == sorted([(5, " \n")] * 2 + [(None, "")] * 2, key=str) and len(kept) == 10


def test_only_keys_with_pairs_left_are_looked_at_again():
    import pyarrow as pa
    from tarn.llm.jaccard import _MORE, _large_groups
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(1, 1 << 63, 200, dtype=np.uint64))
    near = [np.unique(np.append(base, rng.integers(1, 1 << 63, 2, dtype=np.uint64))) for _ in range(5)]
    far = [np.unique(rng.integers(1, 1 << 63, 200, dtype=np.uint64)) for _ in range(5)]
    rows = [(group, key, 0, 10 * group + i, 1, 10 * group + i, len(own), sketch(own))
            for group, key, sets in ((1, 71, near), (2, 72, far)) for i, own in enumerate(sets)]
    names = ("group", "key", "side", "sid", "probed", "root", "n", "sketch")
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=list(names))

    def found(nearest):
        return {p for b in _large_groups(85, nearest)[0]([batch]) for p in zip(*(c.to_pylist() for c in b.columns))}
    every = {(10 + i, 10 + j) for j in range(5) for i in range(j)}
    first = found(1)
    assert (_MORE, 71) in first and (_MORE, 72) not in first and first - {(_MORE, 71)} < every
    assert found(None) == every


def test_sketches_take_two_bits_a_shingle_at_most():
    for n in (1, 50, 400, 3000):
        assert 8 * len(sketch(np.arange(1, n + 1, dtype=np.uint64))) <= max(64, 2 * n)


def near_copies_of(base, count, most, seed=5):
    rng = np.random.default_rng(seed)
    return [np.unique(np.append(base[int(rng.integers(0, most + 1)):], rng.integers(1, 1 << 63, int(rng.integers(0, most + 1)), dtype=np.uint64))) for _ in range(count)]


def test_a_group_gives_fewer_links_than_members():
    import pyarrow as pa
    from tarn.llm.jaccard import _link, _settled_groups
    base = np.unique(np.random.default_rng(6).integers(1, 1 << 63, 120, dtype=np.uint64))
    sets = near_copies_of(base, 60, 14)
    for sides in ([0] * 60, [i % 2 for i in range(60)]):
        rows = [(1, sides[i], i, int(i % 3 > 0), i, own.tobytes()) for i, own in enumerate(sets)]
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["group", "side", "sid", "probed", "root", "shingles"])
        found = [p for b in _settled_groups(85)[0]([batch]) for p in zip(*(c.to_pylist() for c in b.columns))]
        every = [(i, j) for j in range(60) for i in range(j)
                 if (i % 3 or j % 3) and (len(set(sides)) == 1 or sides[i] != sides[j]) and _link(sets[i], sets[j], 85)]

        def parts(pairs):
            of = list(range(60))
            for a, b in pairs:
                of = [of[a] if c == of[b] else c for c in of]
            return {frozenset(i for i in range(60) if of[i] == c) for c in of}
        assert len(every) > 60 > len(found) and set(found) <= set(every) and parts(found) == parts(every)


def test_keys_of_one_hub_are_one_group(spark):
    from tarn.llm.common import Scratch
    from tarn.llm.jaccard import _merged
    same = [(key, 1, sid, sid, 1, 30) for key in range(40) for sid in range(1, 31)]        # 40 keys of the same members
    apart = [(100 + key, 2, 1000 * key + i, 1000 * key + i, i % 2, 30) for key in range(40) for i in range(30)]
    got = _merged(spark.createDataFrame(same + apart, "key long, hub long, sid long, root long, probed long, size long"), Scratch(spark, "test-merged")).collect()
    assert len(got) == 30 + 1200 and len({r["key"] for r in got}) == 1 + 40


def test_blocks_of_the_largest_component_are_held_against_those_outside(spark):
    from tarn.llm.jaccard import _cells
    rows = [(7, i, 0 if i < 300 else i, 1, 10) for i in range(303)]
    cells = _cells(spark.createDataFrame(rows, "key long, sid long, root long, probed long, n long"), 10).collect()
    assert len(cells) == 300 + 3 * 31                  # 30 blocks inside, one outside
    met = {}
    for r in cells:
        met.setdefault(r["group"], []).append((r["sid"], r["side"]))
    pairs = {tuple(sorted((x, y))) for g in met.values() for x, s in g for y, t in g if x != y and (s != t or not any(u for _, u in g))}
    assert pairs == {(x, y) for y in range(300, 303) for x in range(y)}
    assert len(_cells(spark.createDataFrame(rows[:10], "key long, sid long, root long, probed long, n long"), 10).collect()) == 10


def test_groups_that_left_pairs_are_settled_by_sets(spark, make_docs, monkeypatch):
    import tarn.llm.jaccard as jaccard
    monkeypatch.setattr(jaccard, "NEAREST", 1)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 2000)
    rng, rows = random.Random(8), []
    for g in range(2):
        base = [f"g{g}w{i}" for i in range(70)]
        for i in range(60):
            own = list(base)
            for j in rng.sample(range(70), rng.randint(0, 4)):
                own[j] = f"e{rng.randrange(6)}"
            rows.append((g * 100 + i, " ".join(own)))
    assert sorted(map(tuple, similar_components(make_docs(rows), block_rows=20, small_rows=3).collect())) == brute(rows)
