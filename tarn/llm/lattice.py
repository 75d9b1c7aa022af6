"""Language-model scores from a subword lattice (operator 13).

The model is a unigram over the pieces of an existing vocabulary. Every
way to cut a text into pieces is a path of a lattice, weighted by the sum
of its pieces' log probabilities; the forward recursion, in log space, adds
up all paths, so a score is the text's marginal probability and not that of
one segmentation. Pieces do not reach over white space (each word begins
with the vocabulary's word mark, runs of white space are one boundary), so a
document's marginal is the product of its words' marginals and that of the
end piece: words are scored once, however often they stand.

Piece scores: the vocabulary's own scores order its pieces and give a prior
(``1 / (rank + 2)``, normalised); the expected number of uses of each piece
over all segmentations of all training words (forward and backward
recursion, ``ROUNDS`` times over the whole training corpus) is added to
``PRIOR`` pieces' worth of it. A character without a piece of its own is
spelled by its UTF-8 byte pieces, so every text has a probability. Pieces
that a lower-cased word can't hold (capitals, inner word marks, control
pieces) are left out, and the rest sums to one with the end piece.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, then one
end. Words with at least a ``HOT``-th of all tokens (so at most ``HOT`` of
them, of at most ``HOT_BYTES`` bytes each) are scored where the documents
are; all others meet their scores in a join, in which no such word has more
rows than that share.

Nulls: a null text is empty: its tokens are the end alone; a null id is held
out. Very long texts and words are read whole (a word in blocks). Repeated
rows are scored each, and each counts in training. Without training rows
N and V are 0 and pieces have their prior. Empty table: no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, read_table, splitmix, text_bytes, text_slices

FOLDS, HELD_OUT = 7, 2
ROUNDS = 2
PRIOR = 1.0                # pseudo counts of the prior, per piece
HOT = 1 << 18
HOT_BYTES = 32
FLUSH = 200_000            # distinct words that a task gathers before it passes them on
CELLS = 1 << 20            # arcs that are held at once
MARK = "▁"
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(raw: bytes) -> list[bytes]:
    """The words of a text; bytes.split cuts at \\x20 and \\x09-\\x0D only."""
    return raw.translate(_LOWER).split()


def vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """(pieces, weights) of a sentencepiece file that a lower-cased word can
    hold: 256 byte pieces first (as ``<0xAB>``), then the others, by score.
    The weights are the prior, without the end piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled, held = {}, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            spelled[int(piece[1:-1], 16)] = piece
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if MARK not in piece[1:] and not any("A" <= c <= "Z" or c in " \t\n\r\x0b\x0c" for c in piece):
                held.append((-model.get_score(i), i, piece))
    held.sort()
    pieces = [f"<0x{b:02X}>" for b in range(256)] + [p for _, _, p in held]
    ranks = np.concatenate([np.full(256, len(held), np.float64), np.arange(len(held), dtype=np.float64)])
    weights = 1.0 / (ranks + 2.0)
    return pieces, weights / weights.sum()


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, their ends)."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.cumsum([len(t) for t in texts], dtype=np.int64)


class Lattice:
    """Marginals and expected piece uses of words under log probabilities
    ``logp`` (natural logarithms) of ``pieces`` (:func:`vocabulary`)."""

    def __init__(self, pieces: list[str], logp: np.ndarray):
        self.pieces, self.logp = pieces, np.asarray(logp, np.float64)
        self.longest = max([1, *(len(p) for p in pieces[256:])])
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, _BASE)]), dtype=np.uint64)
        self._index()

    def _index(self) -> None:
        """An open-addressed table from the hash of a piece to its number."""
        self.bits = max(10, int(math.ceil(math.log2(len(self.pieces)))) + 5)
        table = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros(len(self.pieces) + 1, np.uint64)
        self.probes = 1
        flat, ends = _codes(self.pieces[256:])
        for number, (a, b) in enumerate(zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()), 256):
            key = 0
            for c in flat[a:b].tolist():
                key = (key * int(_BASE) + c + 1) & (1 << 64) - 1
            self.keys[number] = key
            slot, tried = int(splitmix(np.array([key], np.uint64))[0]) >> 64 - self.bits, 1
            while table[slot] >= 0:
                slot, tried = slot + 1 & (1 << self.bits) - 1, tried + 1
            table[slot] = number
            self.probes = max(self.probes, tried)
        self.table = table

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes; -1: none."""
        slot = (splitmix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(keys.shape, -1, np.int32)
        for probe in range(self.probes):
            number = self.table[slot + probe & (1 << self.bits) - 1]
            np.copyto(out, number, where=(self.keys[number] == keys) & (number >= 0))
        return out

    def _spelled(self, code: int) -> list[int]:
        return list(chr(code).encode("utf-8", "surrogatepass"))

    def arcs(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(piece numbers, log probabilities, spelled characters) of rows of
        equally many code points: [l - 1, row, start] is the arc of length l;
        numbers from ``len(pieces)`` on are characters spelled by bytes."""
        rows, n = codes.shape
        most = min(self.longest, n)
        found = np.full((most, rows, n), -1, np.int32)
        prefix = np.zeros((rows, n + 1), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(n):
                prefix[:, j + 1] = prefix[:, j] * _BASE + codes[:, j] + np.uint64(1)
            for size in range(1, most + 1):
                found[size - 1, :, : n - size + 1] = self._find(prefix[:, size:] - prefix[:, : n - size + 1] * self.power[size])
        bare = found[0] < 0
        chars, which = np.unique(codes[bare], return_inverse=True)
        found[0][bare] = len(self.pieces) + which
        spelled = np.array([self.logp[self._spelled(c)].sum() for c in chars.tolist()], np.float64)
        return found, np.concatenate([self.logp, spelled, [-np.inf]])[found], chars

    def _forward(self, codes: np.ndarray, block: int) -> np.ndarray:
        """alpha [position, row]: log of the weight of all ways to there."""
        rows, n = codes.shape
        alpha = np.full((n + 1, rows), -np.inf)
        alpha[0] = 0.0
        for start in range(0, n, block):
            first = max(0, start - self.longest + 1)
            _, weight, _ = self.arcs(codes[:, first: start + block])
            for end in range(start + 1, min(n, start + block) + 1):
                most = min(end - first, len(weight))
                sizes = np.arange(1, most + 1)
                terms = alpha[end - sizes] + weight[sizes - 1, :, end - first - sizes]
                top = terms.max(axis=0)
                alpha[end] = top + np.log(np.exp(terms - top).sum(axis=0))
        return alpha

    def _grouped(self, words: list[str]):
        """(positions among the words, code points, block) of marked words of
        equal length, few enough to be held at once."""
        marked = [MARK + w for w in words]
        flat, ends = _codes(marked)
        size = np.diff(ends, prepend=0)
        order = np.argsort(size, kind="stable")
        for length in np.unique(size).tolist():
            own = order[np.searchsorted(size[order], length): np.searchsorted(size[order], length, "right")]
            block = max(self.longest, min(length, CELLS // self.longest))
            many = max(1, CELLS // (self.longest * min(length, block)))
            for at in range(0, len(own), many):
                some = own[at: at + many]
                yield some, flat[(ends[some] - length)[:, None] + np.arange(length)], block

    def marginals(self, words: list[str]) -> np.ndarray:
        """Natural log of each word's probability over all segmentations."""
        out = np.zeros(len(words))
        for some, codes, block in self._grouped(words):
            out[some] = self._forward(codes, block)[-1]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of the words."""
        out = np.zeros(len(self.pieces))
        for some, codes, block in self._grouped(words):
            alpha, n = self._forward(codes, block), codes.shape[1]
            total, count = alpha[-1], np.asarray(counts, np.float64)[some]
            beta = np.full((n + 1, len(some)), -np.inf)
            beta[n] = 0.0
            for start in range((n - 1) // block * block, -1, -block):
                last = min(n, start + block)
                found, weight, chars = self.arcs(codes[:, start: min(n, last + self.longest - 1)])
                for at in range(last - 1, start - 1, -1):
                    sizes = np.arange(1, min(n - at, len(weight)) + 1)
                    terms = weight[sizes - 1, :, at - start] + beta[at + sizes]
                    top = terms.max(axis=0)
                    beta[at] = top + np.log(np.exp(terms - top).sum(axis=0))
                for size in range(1, len(weight) + 1):
                    use = min(last, n - size + 1) - start
                    if use > 0:
                        log_use = alpha[start: start + use] + weight[size - 1, :, :use].T + beta[start + size: start + size + use] - total
                        number = found[size - 1, :, :use].T
                        there = number >= 0
                        uses = np.bincount(number[there], (np.exp(log_use) * count)[there], len(self.pieces) + len(chars))
                        out += uses[: len(self.pieces)]
                        for c, n_c in zip(chars.tolist(), uses[len(self.pieces):].tolist()):
                            if n_c:
                                np.add.at(out, self._spelled(c), n_c)
        return out


# -- corpus passes -----------------------------------------------------------

_COUNTS = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("n", pa.int64())])


def _rows(schema: pa.Schema, columns, most: int = 1 << 16):
    for at in range(0, len(columns[0]), most):
        yield pa.RecordBatch.from_arrays([pa.array(c[at: at + most], t) for c, t in zip(columns, schema.types)], schema=schema)


def _count_words(batches):
    """(word, uses in training documents, uses); columns train, text."""
    learned, rest = Counter(), Counter()

    def passed():
        words = list(learned.keys() | rest.keys())
        yield from _rows(_COUNTS, [words, [learned[w] for w in words], [learned[w] + rest[w] for w in words]]) if words else ()
        learned.clear()
        rest.clear()
    for batch in batches:
        for part in text_slices(batch, 1):
            off, raw = text_bytes(part.column(1))
            raw, off = raw.tobytes(), off.tolist()
            for train, a, b in zip(part.column(0).to_pylist(), off, off[1:]):
                (learned if train else rest).update(words_of(raw[a:b]))
                if len(learned) + len(rest) >= FLUSH:
                    yield from passed()
    yield from passed()


_USES = pa.schema([("piece", pa.int32()), ("uses", pa.float64())])


def _expected(pieces: list[str], logp: np.ndarray):
    def run(batches):
        lattice, out = Lattice(pieces, logp), np.zeros(len(pieces))
        for batch in batches:
            out += lattice.expected([w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()], batch.column(1).to_numpy())
        there = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(out[there], pa.float64())], schema=_USES)
    return run


_SCORED = pa.schema([("word", pa.binary()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])


def _score_words(pieces: list[str], logp: np.ndarray, base_total: float):
    def run(batches):
        lattice = Lattice(pieces, logp)
        for batch in batches:
            c = batch.column(1).to_numpy()
            score = lattice.marginals([w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]) / math.log(10)
            base = np.log10((c + 1) / base_total)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array((c > 0).astype(np.int64)), pa.array(base), pa.array(score)], schema=_SCORED)
    return run


_PARTS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
_PARTS_SQL = "row long, doc_id long, word binary, n long, known long, base double, score double"


def _sum_words(hot: dict[bytes, tuple[int, float, float]], end: tuple[int, float, float]):
    """For each document one row with its tokens, and the sums of its hot
    words and its end; and a row for each other word of it."""
    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in text_slices(batch, 1):
                off, raw = text_bytes(part.column(1))
                raw, off = raw.tobytes(), off.tolist()
                docs, rare = [[] for _ in _PARTS], [[] for _ in _PARTS]
                for doc_id, a, b in zip(part.column(0).to_pylist(), off, off[1:]):
                    tokens = words_of(raw[a:b])
                    known, base, score = end
                    for word, n in Counter(tokens).items():
                        if (own := hot.get(word)) is not None:
                            known, base, score = known + n * own[0], base + n * own[1], score + n * own[2]
                        else:
                            for column, value in zip(rare, (row, None, word, n, None, None, None)):
                                column.append(value)
                    for column, value in zip(docs, (row, doc_id, None, len(tokens) + 1, known, base, score)):
                        column.append(value)
                    row += 1
                yield from _rows(_PARTS, docs)
                yield from _rows(_PARTS, rare)
    return run


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


class Model:
    """Counts and piece probabilities of a training corpus. ``words``:
    (word, c, n) of all documents; ``tokens`` (N), ``distinct`` (V),
    ``ends``: training documents; ``logp`` of ``pieces``, ``end``: of the
    end piece (natural logarithms)."""

    def __init__(self, words: DataFrame, pieces: list[str], prior: np.ndarray, tokens: int, distinct: int, ends: int, all_tokens: int):
        self.words, self.pieces, self.prior = words, pieces, prior
        self.tokens, self.distinct, self.ends, self.all_tokens = tokens, distinct, ends, all_tokens
        self.set_uses(np.zeros(len(pieces)))

    def set_uses(self, uses: np.ndarray) -> None:
        mass = PRIOR * len(self.pieces)
        total = uses.sum() + mass + self.ends + 1
        self.logp, self.end = np.log((uses + mass * self.prior) / total), math.log((self.ends + 1) / total)


def train(docs: DataFrame, scratch: Scratch, vocabulary_path: str, rounds: int = ROUNDS) -> Model:
    """Counts of all words and piece probabilities, from the documents whose
    id is not held out."""
    pieces, prior = vocabulary(vocabulary_path)
    rows = docs.select((~held_out(F.col("doc_id"))).alias("train"), F.col("text").alias("text"))
    counted = rows.mapInArrow(_count_words, "word binary, c long, n long")
    words = scratch.save(counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "words")
    ends = rows.where("train").count()
    sums = words.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum("n")).first()
    model = Model(words, pieces, prior, (sums[0] or 0) + ends, (sums[1] or 0) + (ends > 0), ends, sums[2] or 0)
    for _ in range(rounds if sums[0] else 0):
        got = (words.where("c > 0").select("word", "c").mapInArrow(_expected(pieces, model.logp), "piece int, uses double")
               .groupBy("piece").agg(F.sum("uses").alias("uses")).collect())       # a row per piece at most
        uses = np.zeros(len(pieces))
        uses[[r["piece"] for r in got]] = [r["uses"] for r in got]
        model.set_uses(uses)
    return model


def score_documents(docs: DataFrame, model: Model, scratch: Scratch, hot: int = HOT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    base_total = model.tokens + model.distinct + 1
    scored = scratch.save(model.words.select("word", "c", "n").mapInArrow(_score_words(model.pieces, model.logp, base_total), "word binary, n long, known long, base double, score double"), "scored")
    # sum(n) = all_tokens: at most ``hot`` words reach that share
    often = scored.where((F.col("n") * hot >= model.all_tokens) & (F.octet_length("word") <= HOT_BYTES)).drop("n").collect()
    terms = {bytes(r["word"]): (r["known"], r["base"], r["score"]) for r in often}
    end = (int(model.ends > 0), math.log10((model.ends + 1) / base_total), model.end / math.log(10))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    parts = scratch.save(rows.mapInArrow(_sum_words(terms, end), _PARTS_SQL), "parts")
    n = F.col("n")
    rare = (parts.where("word IS NOT NULL").select("row", "word", "n").join(scored.drop("n"), "word")
            .groupBy("row").agg(F.sum(n * F.col("known")).alias("known"), F.sum(n * F.col("base")).alias("base"), F.sum(n * F.col("score")).alias("score")))
    docs_part = parts.where("word IS NULL")
    whole = (docs_part.select("row", "doc_id", "n", "known", "base", "score")
             .unionByName(rare.select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n"), "known", "base", "score"))
             .groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n_tokens"), F.sum("known").alias("n_known"),
                                 F.sum("base").alias("base_score"), F.sum("score").alias("score")))
    return whole.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op13_lattice_score(spark, sf_dir: str, vocabulary_path: str | None = None) -> DataFrame:
    if vocabulary_path is None:
        import public_tokenizers

        vocabulary_path = public_tokenizers.path("piece_bpe_32k.model")
    scratch = Scratch(spark, "lattice")
    docs = read_table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, scratch, vocabulary_path), scratch)
