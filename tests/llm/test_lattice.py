import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import public_tokenizers
from tarn.llm import lattice
from tarn.llm.common import Scratch
from tarn.llm.lattice import MARK, Lattice, op13_lattice_score, score_documents, train, vocabulary, words_of

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocab():
    return vocabulary(PATH)


def segmentations(text, pieces):
    """All ways to cut a text into pieces, characters without one by bytes."""
    if not text:
        yield ()
    for i in range(1, len(text) + 1):
        if text[:i] in pieces:
            own = (pieces[text[:i]],)
        elif i == 1:
            own = tuple(text[0].encode())
        else:
            continue
        for rest in segmentations(text[i:], pieces):
            yield own + rest


def test_marginals_and_uses_against_all_segmentations(vocab):
    pieces, prior = vocab
    index = {p: i for i, p in enumerate(pieces) if i >= 256}
    words = ["cat", "achlich", "x", "日本龘", "lorem", "", "sam" + MARK + "e", "😀a", "cat"]
    model = Lattice(pieces, np.log(prior))
    counts, uses, want = np.arange(1, len(words) + 1), np.zeros(len(pieces)), []
    for w, c in zip(words, counts):
        paths = list(segmentations(MARK + w, index))
        weight = [math.prod(prior[p] for p in path) for path in paths]
        want.append(math.log(sum(weight)))
        for path, x in zip(paths, weight):
            np.add.at(uses, list(path), c * x / sum(weight))
    assert np.allclose(model.marginals(words), want, rtol=1e-12)
    assert np.allclose(model.expected(words, counts), uses, atol=1e-9)


def test_long_words_in_blocks(vocab, monkeypatch):
    pieces, prior = vocab
    words = ["antidisestablishmentarianism" * 5, "日x" * 40]
    whole = Lattice(pieces, np.log(prior))
    a, b = whole.marginals(words), whole.expected(words, np.ones(2))
    monkeypatch.setattr(lattice, "CELLS", 16 * 20)
    assert np.allclose(whole.marginals(words), a, rtol=1e-12) and np.allclose(whole.expected(words, np.ones(2)), b, atol=1e-9)


def test_words_are_cut_at_the_given_bytes_only():
    text = "A\x1cb\x85c\xa0d E\x0bf\x0cg\x09h\x0ai\x0dj\x00k ÀB"
    want = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    assert [w.decode() for w in words_of(text.encode())] == want


def out_of_fold(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows, pieces, prior, rounds=2):
    """Base and lattice scores, document by document and character by character."""
    texts = [(d, [w.decode() for w in words_of((t or "").encode())]) for d, t in rows]
    count = Counter(w for d, ws in texts if not out_of_fold(d) for w in [*ws, None])
    n, v = sum(count.values()), len(count)
    index = {p: i for i, p in enumerate(pieces) if i >= 256}
    logp = np.log(prior)
    end = 0.0

    def arcs(s, j):
        for i in range(max(0, j - 20), j):
            if s[i:j] in index:
                yield i, [index[s[i:j]]]
            elif j - i == 1:
                yield i, list(s[i].encode())

    def forward(w):
        s = MARK + w
        a = [0.0]
        for j in range(1, len(s) + 1):
            a.append(np.logaddexp.reduce([a[i] + sum(logp[q] for q in p) for i, p in arcs(s, j)]))
        return s, a
    mass = len(pieces)

    def fitted(uses):
        total = uses.sum() + mass + count[None] + 1
        return np.log((uses + mass * prior) / total), math.log((count[None] + 1) / total)
    logp, end = fitted(np.zeros(len(pieces)))
    for _ in range(rounds if n > count[None] else 0):
        uses = np.zeros(len(pieces))
        for w, c in count.items():
            if w is not None:
                s, a = forward(w)
                b = [0.0] * (len(s) + 1)
                for i in range(len(s) - 1, -1, -1):
                    b[i] = np.logaddexp.reduce([sum(logp[q] for q in p) + b[j] for j in range(i + 1, len(s) + 1) for k, p in arcs(s, j) if k == i])
                for j in range(1, len(s) + 1):
                    for i, p in arcs(s, j):
                        np.add.at(uses, p, c * math.exp(a[i] + sum(logp[q] for q in p) + b[j] - a[-1]))
        logp, end = fitted(uses)
    memo = {}

    def word(w):
        if w not in memo:
            memo[w] = forward(w)[1][-1]
        return memo[w]
    base = lambda w: math.log10((count[w] + 1) / (n + v + 1))
    return [(d, out_of_fold(d), len(ws) + 1, sum(count[w] > 0 for w in [*ws, None]), n, sum(map(base, [*ws, None])),
             (sum(map(word, ws)) + end) / math.log(10)) for d, ws in texts]


def close(got, want):
    key = lambda r: (str(r[:5]), round(r[5], 6), round(r[6], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


ROWS = [(i, f"The Cat{i % 3} sat\non  mat {'x' * (i % 4)} ünïcode 日本") for i in range(20)]
ROWS += [(30, None), (31, ""), (32, " \t\n"), (None, "the cat0"), (None, None), (33, "the " * 5000 + "z" * 90), (34, "same"), (34, "same"), (34, "other words")]


@pytest.mark.parametrize("hot", [lattice.HOT, 2, 0])
def test_documents_against_brute_force(spark, make_docs, vocab, hot):
    docs = make_docs(ROWS, extra=True)
    scratch = Scratch(spark, "test-lattice")
    close(score_documents(docs, train(docs, scratch, PATH), scratch, hot).collect(), brute(ROWS, *vocab))


def test_tasks_that_pass_on_their_counts_early(spark, make_docs, vocab, monkeypatch):
    monkeypatch.setattr(lattice, "FLUSH", 5)
    docs = make_docs(ROWS)
    scratch = Scratch(spark, "test-lattice")
    close(score_documents(docs, train(docs, scratch, PATH), scratch).collect(), brute(ROWS, *vocab))


def test_without_training_rows_and_empty(spark, make_docs, vocab):
    none = [(i, "a few words") for i in range(60) if out_of_fold(i)] + [(None, "more")]
    scratch = Scratch(spark, "test-lattice")
    docs = make_docs(none)
    close(score_documents(docs, train(docs, scratch, PATH), scratch).collect(), brute(none, *vocab))
    docs, scratch = make_docs([]), Scratch(spark, "test-lattice")
    assert score_documents(docs, train(docs, scratch, PATH), scratch).collect() == []


def test_training_helps_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    untrained, trained = ({r["doc_id"]: r for r in score_documents(docs, train(docs, scratch, PATH, rounds), scratch).collect()} for rounds, scratch in ((0, Scratch(spark, "untrained")), (2, Scratch(spark, "trained"))))
    held = [d for d, r in trained.items() if r["held_out"]]
    assert held and all(trained[d]["score"] < 0 for d in trained)
    assert sum(trained[d]["score"] for d in held) > 0.9 * sum(untrained[d]["score"] for d in held)      # log10 of a probability
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    count = Counter(w for d, t in rows if not out_of_fold(d) for w in [*words_of((t or "").encode()), None])
    n, v = sum(count.values()), len(count)
    for d, t in rows:
        ws = [*words_of((t or "").encode()), None]
        r = trained[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)


def test_query_is_the_operator(spark):
    out = op13_lattice_score(spark, SF)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"] and out.count() == 200
