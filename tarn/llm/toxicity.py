"""Toxicity by compression distance (operator 5).

A text is a sequence of words, each written as 16 bytes: a hash of its first
``PREFIX`` bytes, so that a match is a whole word's beginning and never a
syllable that other words share. Two zstandard dictionaries are trained
apart, one on ordinary text, one on the words of toxic text that ordinary
text does not explain (those that are ``RATIO`` times as frequent in toxic
documents as in ordinary ones). A text is cut into windows of ``WINDOW``
bytes of codes; each is compressed without a dictionary, with the toxic and
with the ordinary one. What either saves is the window's distance to that
kind. A document's score is a logistic function of the toxic savings (the largest of
a window, and their sum up to ``ENOUGH``) and of their share in the savings of
both dictionaries, calibrated on labelled documents that the dictionaries have not seen.

Without that choice of words a toxic dictionary is mostly filled with the
ordinary words that toxic text also consists of, and the compared lengths
hardly rank held-out documents (README has the figures).

Learning uses a bounded sample of labelled rows whose crc32(doc_id as
text) mod 5 is not 0: at most ``SAMPLE_TOXIC`` toxic and
``SAMPLE_ORDINARY`` other labelled documents that have a text, those with
the smallest id hashes, near copies among them reduced to one. A document
takes part whole up to ``SAMPLE_BYTES`` bytes; a longer one with
``PIECES`` pieces of ``PIECE`` bytes, dealt evenly from its start to its
end. Every document is scored, over its whole text; labels, language,
source and id are no inputs of a score.

Nulls: a null or empty text scores as one without any saving; labels with
a null id or null toxic are ignored, of contradicting labels the toxic one
holds; a null id is held out. Without labels of both kinds every score is
0. Repeated rows score alike. Empty table: no rows. Extra columns are
ignored. Scoring moves no text between tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, text_bytes

FOLDS = 5
SAMPLE_TOXIC = 2500
SAMPLE_ORDINARY = 4000
SAMPLE_BYTES = 16 << 10
PIECE = 256
PIECES = SAMPLE_BYTES // PIECE
PREFIX = 9                # bytes of a word that its code stands for
CODE = 16                 # bytes of a code
WINDOW = 16 * CODE
SHARE = 0.01              # a word must be in this share of the toxic documents
RATIO = 15.0              # and so many times as frequent as in ordinary ones
TOXIC_DICT = 32 << 10
ORDINARY_DICT = 64 << 10
LEVEL = 3
ENOUGH = 4.0              # codes saved in all, beyond which more say nothing new

_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else 32 if 9 <= c <= 13 else c for c in range(256))


def normal(raw: bytes) -> bytes:
    return b" " + raw.translate(_TABLE) + b" "


def coded(text: bytes) -> bytes:
    """The codes of a text's words."""
    return b"".join([xxhash.xxh3_128_digest(w[:PREFIX]) for w in text.split()])


def windows(codes: bytes) -> list[bytes]:
    return [codes[i: i + WINDOW] for i in range(0, max(1, len(codes)), WINDOW)]


_KIND = np.dtype((np.void, CODE))


def _distinct(codes: bytes) -> np.ndarray:
    return np.unique(np.frombuffer(codes, _KIND).view(">u8").reshape(-1, 2)[:, 0])      # a code's first half names it


def _toxic_words(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """Names of the codes that toxic texts have and ordinary ones do not
    explain; texts are counted one by one."""
    names, count = np.unique(np.concatenate([_distinct(t) for t in toxic]), return_counts=True)
    often = count >= max(2, SHARE * len(toxic))
    names, count, other = names[often], count[often], np.zeros(int(often.sum()), np.int64)
    for t in ordinary:
        own = _distinct(t)
        at = np.searchsorted(names, own)
        there = at < len(names)
        there[there] = names[at[there]] == own[there]
        other[at[there]] += 1
    return names[count / len(toxic) >= RATIO * (other + 1) / (len(ordinary) + 1)]


def _only(codes: bytes, names: np.ndarray) -> bytes:
    """The codes of those names, in the text's order."""
    rows = np.frombuffer(codes, _KIND)
    return rows[np.isin(rows.view(">u8").reshape(-1, 2)[:, 0], names)].tobytes()


def _no_copies(texts: list[bytes]) -> list[bytes]:
    """Texts of which none shares one of its four smallest 8-word hashes
    with an earlier one."""
    seen, out = set(), []
    for t in texts:
        w = t.split()
        sketch = sorted({xxhash.xxh64_intdigest(b" ".join(w[i: i + 8])) for i in range(max(1, len(w) - 7))})[:4]
        if not seen.intersection(sketch):
            out.append(t)
        seen.update(sketch)
    return out


@dataclass(frozen=True)
class Model:
    """``toxic`` and ``ordinary``: dictionary contents; ``weights`` of
    (1, largest toxic saving of a window, all toxic savings up to ``ENOUGH``,
    in codes, and their share in all savings)."""
    toxic: bytes = b""
    ordinary: bytes = b""
    weights: tuple[float, float, float, float] = (-50.0, 0.0, 0.0, 0.0)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.plain, self.toxic, self.ordinary = (self._compressor(d) for d in (b"", model.toxic, model.ordinary))

    @staticmethod
    def _compressor(content: bytes):
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=WINDOW, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False)
        if not content:
            return zstandard.ZstdCompressor(compression_params=params).compress
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress

    def features(self, text: bytes) -> tuple[float, float, float]:
        plain, toxic, ordinary = self.plain, self.toxic, self.ordinary
        most = total = known = 0
        cut = windows(coded(text))
        for w in cut:
            size = len(plain(w))
            saved = size - len(toxic(w))
            known += size - len(ordinary(w))
            if saved > 0:
                most, total = max(most, saved), total + saved
        return most / CODE, min(total / CODE, ENOUGH), total / (total + max(0, known) + 1)

    def score(self, raw: bytes) -> float:
        z = sum(w * x for w, x in zip(self.model.weights, (1.0, *self.features(normal(raw)))))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (y - p)) - ridge * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(toxic: list[bytes], ordinary: list[bytes], prevalence: float) -> Model:
    """Model from normalised texts; every third text calibrates."""
    toxic, ordinary = _no_copies(toxic), _no_copies(ordinary)
    learn_t, learn_o = [coded(t) for i, t in enumerate(toxic) if i % 3], [coded(t) for i, t in enumerate(ordinary) if i % 3]
    tune_t, tune_o = toxic[::3], ordinary[::3]
    if not learn_t or not learn_o:
        return Model()
    names = _toxic_words(learn_t, learn_o)
    samples = [s for t in learn_t if (s := _only(t, names))]
    toxic_dict = _dictionary(samples, TOXIC_DICT)
    pieces = [w for t in learn_o for w in windows(t)]
    ordinary_dict = _dictionary(pieces[:: max(1, len(pieces) // 30_000)], ORDINARY_DICT)
    scorer = Scorer(Model(toxic_dict, ordinary_dict))
    x = np.array([[1.0, *scorer.features(t)] for t in [*tune_t, *tune_o]])
    y = np.array([1.0] * len(tune_t) + [0.0] * len(tune_o))
    w = np.where(y == 1, prevalence / max(1, len(tune_t)), (1 - prevalence) / max(1, len(tune_o))) * len(x)
    return Model(toxic_dict, ordinary_dict, tuple(_logistic(x, y, w).tolist()))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary trained on samples of codes; where their distinct codes
    fit they are all of it, the most frequent last (nearest)."""
    rows, count = np.unique(np.frombuffer(b"".join(samples), np.uint8).reshape(-1, CODE), axis=0, return_counts=True)
    if rows.size <= size or len(samples) < 16:
        return rows[np.argsort(count, kind="stable")].tobytes()[-size:]
    return zstandard.train_dictionary(size, samples, k=4 * CODE, d=8).as_bytes()


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def sampled(text: F.Column) -> F.Column:
    """The bytes of a text that training sees."""
    raw, size = text.cast("binary"), F.octet_length(text)
    pieces = F.aggregate(
        F.sequence(F.lit(0), F.lit(PIECES - 1)), F.lit(b""),
        lambda acc, i: F.concat(acc, F.substring(raw, (F.floor(i.cast("long") * (size - PIECE) / (PIECES - 1)) + 1).cast("int"), F.lit(PIECE)), F.lit(b" ")))
    return F.when(size <= SAMPLE_BYTES, raw).otherwise(pieces)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    usable = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
              .where(F.col("_id").isNotNull() & F.col("_toxic").isNotNull() & ~held_out(F.col("_id")))
              .groupBy("_id").agg(F.max("_toxic").alias("_toxic")))
    counts = {r["_toxic"]: r["n"] for r in usable.groupBy((F.col("_toxic") > 0).cast("int").alias("_toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return Model()
    # only documents that are there, of any length, take places of the sample
    usable = usable.join(docs.where(F.col("text").isNotNull()).select("doc_id"), F.col("_id") == F.col("doc_id"), "left_semi")
    picked = None
    for toxic, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        own = usable.where((F.col("_toxic") > 0) == bool(toxic)).orderBy(F.xxhash64("_id"), "_id").limit(most)
        picked = own if picked is None else picked.unionByName(own)
    # at most SAMPLE_TOXIC + SAMPLE_ORDINARY ids
    rows = (docs.where(F.col("text").isNotNull()).select("doc_id", sampled(F.col("text")).alias("text"))
            .join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("_toxic").alias("_toxic")).collect())     # a row per picked id at most
    rows.sort(key=lambda r: xxhash.xxh64_intdigest(str(r["doc_id"])))
    texts = {kind: [normal(bytes(r["text"])) for r in rows if (r["_toxic"] > 0) == kind] for kind in (True, False)}
    return train(texts[True], texts[False], counts[1] / (counts[0] + counts[1]))


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _score(model: Model):
    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            off, raw = text_bytes(batch.column(1))
            raw, off = raw.tobytes(), off.tolist()
            scores = [scorer.score(raw[a:b]) for a, b in zip(off, off[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], schema=_SCORES)
    return run


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return (rows.mapInArrow(_score(model), "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents whose own score is below one half, with all columns."""
    model = learn(docs, labels)

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            off, raw = text_bytes(batch.column(batch.schema.get_field_index("text")))
            raw, off = raw.tobytes(), off.tolist()
            yield batch.filter(pa.array([scorer.score(raw[a:b]) < 0.5 for a, b in zip(off, off[1:])], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def op5_compression_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_documents(docs, learn(docs, read_table(spark, sf_dir, "labels")))
