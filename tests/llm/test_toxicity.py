import zlib

from tarn.llm.toxicity import CODE, _dictionary, coded, Model, Scorer, drop_toxic, learn, normal, op5_compression_toxicity, score_documents, train, windows

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    out = {r["doc_id"]: r for r in op5_compression_toxicity(spark, SF).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(out) == set(docs)
    bad = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for d, r in out.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for one in ["en", "de", "fr", "es", None]:
        held = [d for d in bad if out[d]["held_out"] and one in (None, lang[d])]
        ranked = [(out[d]["score"], bad[d]) for d in held]
        pairs = [(a > b) + 0.5 * (a == b) for a, x in ranked if x for b, y in ranked if not y]
        toxic = sum(bad[d] for d in held)
        assert sum(pairs) / len(pairs) > 0.9          # some labels are on texts without any mark
        assert sum(out[d]["predicted"] for d in held if bad[d]) >= (0.8 if toxic >= 10 else 0.5) * toxic
        assert sum(out[d]["predicted"] for d in held if not bad[d]) <= 0.02 * len(held)


def corpus():
    rows, labels = [], []
    for i in range(600):
        text = " ".join(f"{'abcdefghij'[(i * 7 + j * j) % 10]}word{(i * 31 + j * 17) % 97}" for j in range(60))
        if i % 5 == 0:
            text += " vilegrot snarkbane " + text[:80] + " vilegrot"
        rows.append((i, text))
        labels.append((i, 0, int(i % 5 == 0)))
    return rows, labels


def test_learns_from_marks_and_filters(spark, make_docs):
    rows, labels = corpus()
    rows += [(9001, None), (9002, ""), (9003, "clean aword5 " * 9000), (9004, "clean aword5 " * 9000 + "vilegrot snarkbane "), (None, "vilegrot snarkbane"), (3, rows[3][1])]
    labels += [(None, 0, 1), (7, 0, None), (11, 0, 0), (11, 0, 0)]
    docs, marks = make_docs(rows, extra=True), spark.createDataFrame(labels, LABELS)
    model = learn(docs, marks)
    out = score_documents(docs, model).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r["predicted"] for r in out}
    right = sum(by[i] == int(i % 5 == 0) for i in range(600))
    assert right >= 590
    assert by[9001] == by[9002] == by[9003] == 0 and by[9004] == 1 and by[None] == 1
    kept = drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in out if not r["predicted"])


def test_without_labels_and_empty(spark, make_docs):
    none = spark.createDataFrame([], LABELS)
    assert [r["predicted"] for r in score_documents(make_docs([(1, "x")]), learn(make_docs([(1, "x")]), none)).collect()] == [0]
    assert score_documents(make_docs([]), Model()).collect() == []
    rows, labels = corpus()
    assert learn(make_docs([]), spark.createDataFrame(labels, LABELS)) == Model()


def test_windows_hold_every_word_once():
    words = [f"word{i}".encode() for i in range(500)] + [b"x" * 9, b"x" * 10_000]
    codes = b"".join(windows(coded(b" ".join(words))))
    assert len(codes) == CODE * len(words) and codes == coded(b"  ".join(words))
    assert codes[-CODE:] == codes[-2 * CODE: -CODE] and len({codes[i: i + CODE] for i in range(0, len(codes), CODE)}) == 501
    assert windows(coded(b"")) == [b""]


def test_dictionaries_are_two_and_larger_ones_are_trained():
    rows, _ = corpus()
    toxic, ordinary = [normal(t.encode()) for i, t in rows if i % 5 == 0], [normal(t.encode()) for i, t in rows if i % 5]
    m = train(toxic, ordinary, 0.2)
    marks = {coded(w.encode()) for w in ("vilegrot", "snarkbane")}
    assert {m.toxic[i: i + CODE] for i in range(0, len(m.toxic), CODE)} == marks and not any(x in m.ordinary for x in marks)
    many = [coded(" ".join(f"w{(i * 37 + j * 11) % 5000}" for j in range(90)).encode()) for i in range(300)]
    assert 0 < len(_dictionary(many, 4096)) <= 4096


def test_scores_do_not_depend_on_fold_or_id():
    rows, labels = corpus()
    m = train([normal(t.encode()) for i, t in rows if i % 5 == 0], [normal(t.encode()) for i, t in rows if i % 5], 0.2)
    s = Scorer(m)
    assert s.score(b"vilegrot snarkbane") == s.score(b"vilegrot snarkbane") > 0.5 > s.score(b"")


def test_learns_from_long_documents(spark, make_docs):
    rows, labels = corpus()
    long = [(i, f"{t} " * 60) for i, t in rows]                      # all beyond the sample's bytes
    assert min(len(t) for _, t in long) > 16 << 10
    model = learn(make_docs(long), spark.createDataFrame(labels, LABELS))
    assert model != Model()
    by = {r["doc_id"]: r["predicted"] for r in score_documents(make_docs(long), model).collect()}
    assert sum(by[i] == int(i % 5 == 0) for i in range(600)) >= 590
    short = [*rows, *((i, "é" * 9000) for i in range(600, 4000))]    # labels without a document take no place
    marks = spark.createDataFrame(labels + [(i, 0, i % 2) for i in range(10_000, 60_000)], LABELS)
    assert learn(make_docs(rows), marks) != Model() and learn(make_docs(short), marks) != Model()


def test_a_long_text_takes_part_in_pieces(spark):
    from pyspark.sql import functions as F

    from tarn.llm.toxicity import PIECE, PIECES, sampled
    texts = ["", "short", "x" * (16 << 10), "".join(chr(97 + i % 26) for i in range(100_000))]
    got = [bytes(r[0]) for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(sampled(F.col("t"))).collect()]
    assert got[:3] == [t.encode() for t in texts[:3]]
    at = [i * (100_000 - PIECE) // (PIECES - 1) for i in range(PIECES)]
    assert got[3].decode() == "".join(texts[3][a: a + PIECE] + " " for a in at)
