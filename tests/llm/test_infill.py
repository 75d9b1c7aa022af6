import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarn.llm.infill import ERROR, RankIndex, boundary_index, fill_in_middle, read_index, restore

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def rows():
    rng = random.Random(5)
    marks = ["a", "Zebra", " ", "\n", "é", "日本", "🙂", "<", ">", "<P", "P>", "S", "\x00", "0", "́", "[", "`", "{", "@"]
    out = [(i, "".join(rng.choice(marks) for _ in range(rng.randrange(60)))) for i in range(400)]
    out += [(500, None), (501, ""), (502, "x"), (503, "has <S> inside"), (None, "no id at all"), (None, None), (504, "same"), (504, "same")]
    out.append((505, "word " * 200_000 + "日" * 50_000 + "z" * 300_000 + " 1" * 100_000))
    return out


def test_documents_against_brute_force(spark, make_docs):
    given_rows = rows()
    got = fill_in_middle(make_docs(given_rows, extra=True))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((brute(*r) for r in given_rows), key=key)
    assert {r["form"] for r in got.collect()} == {"plain", "psm", "spm"}
    back = got.select("doc_id", restore(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted(map(tuple, back), key=key) == sorted(((d, t or "") for d, t in given_rows), key=key)
    assert fill_in_middle(make_docs([])).collect() == []


def test_index_table_is_exact_and_bounded(spark, make_docs):
    given_rows = [r for r in rows() if r[0] is not None and r[0] != 504]
    texts = dict(given_rows)
    for row in boundary_index(make_docs(given_rows)).collect():
        text = texts[row["doc_id"]] or ""
        ends = np.cumsum([0, *(len(u.encode()) for u in UNIT.findall(text))])
        index = read_index(row)
        assert row["n"] == len(ends) - 1
        assert np.array_equal(index.offset(np.arange(len(ends))), ends)
        assert np.abs(ends - index.predict(np.arange(len(ends)))).max() <= ERROR
        if row["doc_id"] == 505:                  # 550,001 units; the parts are straight lines
            assert len(index.first) <= 8


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=3000), st.integers(0, 40))
def test_fit_keeps_its_bound(steps, error):
    ends = np.cumsum([0, *steps])
    index = RankIndex.fit(ends, error)
    ranks = np.arange(len(ends))
    assert np.array_equal(index.offset(ranks), ends)
    assert np.abs(ends - index.predict(ranks)).max() <= error
