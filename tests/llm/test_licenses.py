import re

from tarn.llm.licenses import normal_words, op1_license_scan, scan_licenses, seeds

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BASE = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    hits = sorted((i, label) for label, phrase in BASE.items() for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
    return len(words), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, ",".join(sorted({h[1] for h in hits}))


def base(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


def test_base_against_brute_force(spark):
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = op1_license_scan(spark, SF).collect()
    assert {r["doc_id"]: base(r) for r in out} == {d: brute(t) for d, t in text.items()}
    for r in out:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_errors_spans_and_edges(spark, make_docs):
    rows = [
        (1, "Released under the MIT  Licence."), (2, "the mti lcinese"), (3, "GNU Lesser General Publik License"),
        (4, "mit license MIT-License, apache\nlicense mit license"), (5, None), (6, ""), (7, "permit license limit licenses"),
        (8, "Redistribution and use in sourcce and binary form, with"), (9, "Apache License " * 30000), (10, "mit"), (11, "license"),
        (12, "é mit license é"), (None, "bsd license"), (12, "é mit license é"),
    ]
    out = scan_licenses(make_docs(rows, extra=True)).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    for d, t in rows:
        assert base(by[d]) == brute(t)
    assert by[1]["labels"] == "mit" and by[1]["base_labels"] == "" and 0 < by[1]["score"] < 1
    span = by[1]["spans"][0]
    assert (span["first_word"], span["n_words"], span["text"], span["errors"]) == (3, 2, "mit licence", 1)
    assert by[2]["labels"] == "" and by[2]["score"] == 0
    assert {"lgpl", "gpl"} <= set(by[3]["labels"].split(","))
    assert by[8]["labels"] == "bsd" and by[9]["n_base"] == 30000 and by[9]["last_word"] == 59998
    assert by[10]["labels"] == by[11]["labels"] == ""
    assert by[None]["labels"] == "bsd"
    assert scan_licenses(make_docs([])).collect() == []


def test_seeds_meet_every_match():
    import random

    rng, phrase = random.Random(1), "general public license"
    for _ in range(300):
        t = list(phrase)
        for _ in range(2):
            i = rng.randrange(len(t))
            rng.choice([lambda: t.__setitem__(i, "x"), lambda: t.insert(i, "x"), lambda: t.pop(i)])()
        assert any(s in "".join(t).encode() for _, s in seeds(phrase, 2))


def test_a_better_match_behind_hides_no_earlier_one():
    from tarn.llm.licenses import Scanner

    def found(text, label):
        raw = f"\n{text}\n".encode()
        return sorted((raw[a:b].decode(), e) for a, b, e, x in Scanner().fuzzy(raw, [1]) if x == label)
    assert found("all right reserved all rights reserved", "proprietary") == [("all right reserved", 1), ("all rights reserved", 0)]
    assert found("mit licence mit license mit licens", "mit") == [("mit licence", 1), ("mit licens", 1), ("mit license", 0)]
    assert found("all rights reserve all rights reserved all right reserved all rights reserved all rigths all rights reservd", "proprietary") == [
        ("all right reserved", 1), ("all rights reservd", 1), ("all rights reserve", 1), ("all rights reserved", 0), ("all rights reserved", 0)]


def test_spans_of_repeated_notices(spark, make_docs):
    row = scan_licenses(make_docs([(1, "All right reserved. All rights reserved.")])).first()
    assert [(s["first_word"], s["n_words"], s["errors"]) for s in row["spans"]] == [(0, 3, 1), (3, 3, 0)]


def edits_to(words, phrase):
    """Smallest number of edits between a phrase and any run of whole words."""
    text, best = " ".join(words), None
    ends = {i for i, c in enumerate(text) if c == " "} | {len(text)}
    for start in [0, *(i + 1 for i in ends if i < len(text))]:
        row = list(range(len(phrase) + 1))
        for j in range(start, min(len(text), start + len(phrase) + 8)):
            new = [row[0] + 1]
            for i, c in enumerate(phrase):
                new.append(min(new[-1] + 1, row[i + 1] + 1, row[i] + (c != text[j])))
            row = new
            if j + 1 in ends and (best is None or row[-1] < best):
                best = row[-1]
    return best


def test_labels_against_edit_distances(spark, make_docs):
    import random

    from tarn.llm.licenses import BASE, NOTICES
    rng, rows = random.Random(8), []
    for i in range(60):
        notice = rng.choice(NOTICES)
        own = list(notice.phrase)
        for _ in range(rng.randint(0, notice.errors + 2)):
            at = rng.randrange(len(own))
            rng.choice([lambda: own.__setitem__(at, "q"), lambda: own.insert(at, "z"), lambda: own.pop(at)])()
        rows.append((i, " ".join([*(f"w{rng.randrange(50)}" for _ in range(4)), "".join(own), "tail"])))
    for r in scan_licenses(make_docs(rows)).collect():
        words = normal_words(dict(rows)[r["doc_id"]].encode())
        text = [w.decode() for w in words]
        want = {n.label for n in NOTICES if (d := edits_to(text, n.phrase)) is not None and d <= n.errors}
        want |= {label for label, phrase in BASE if f" {phrase} " in f" {' '.join(text)} "}
        assert set(filter(None, r["labels"].split(","))) == want
        for s in r["spans"]:
            assert " ".join(text[s["first_word"]: s["first_word"] + s["n_words"]]) == s["text"]


def test_work_grows_with_the_text(spark, make_docs):
    import time
    start = time.time()
    out = scan_licenses(make_docs([(1, "mit licence " * 90_000), (2, "licence" * 150_000 + " mit licens")])).collect()
    assert time.time() - start < 120
    by = {r["doc_id"]: r for r in out}
    assert len(by[1]["spans"]) == 90_000 and {s["errors"] for s in by[1]["spans"]} == {1}
    assert "mit" in by[2]["labels"] or by[2]["spans"] == []
