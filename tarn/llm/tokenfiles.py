"""Token-id files with a shared zstandard dictionary (operator 8).

Documents are put in ascending id order by a range shuffle, encoded, and
packed into blocks. Every document is a zstandard frame of its own,
compressed against one dictionary trained on serialized id arrays, so a
short document can be read without its neighbours. A block is one binary
value of a table (Spark's writers commit them, a lost executor costs its
tasks only), laid out little-endian as

    magic "TKF1" | id width u8 (2 or 4) | 3 zero bytes | n u32 | 4 zero bytes
    sha256 of the dictionary, 32 bytes
    doc ids, n x i64 | null flags of the ids, n x u8
    token counts, n x u32
    frame offsets, (n + 1) x u64, from the first frame
    frames

Nulls: a null text is empty (the end id alone); a null id sorts first and
is kept as null. Repeated rows are documents of their own, in the order of
their text's hash. Very long texts are encoded whole and may exceed the
block's byte target alone. Empty table: no blocks, no rows. Extra columns
are ignored.

The vocabulary file's path is a parameter; every worker reads it there.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table, text_slices

END_ID = 1
MAGIC = b"TKF1"
HEADER = struct.Struct("<4sB3xI4x32s")
BLOCK_DOCS = 1024
BLOCK_BYTES = 4 << 20
DICT_BYTES = 64 << 10
#: The dictionary is trained on documents of at most so many bytes, in the
#: order of their ids' hashes, up to so many bytes and documents together.
#: A smaller sample gives a smaller dictionary, an eighth of its ids.
SAMPLE_BYTES = 1 << 20
SAMPLE_DOCS = 2000
SAMPLE_DOC_BYTES = 32 << 10
LEAST_TRAINED = 4 << 10
LEVEL = 3
CACHE_PIECES = 1_000_000
#: New pieces are learned for so many bytes of texts at once (one text at least).
LEARN_BYTES = 256 << 10

_LETTERS = "a-zß-öø-ÿ"
# UTF-8 of the characters where the cut is made here: printable ASCII, tab,
# line ends, and the letters of Latin-1 from U+00C0 on.
_SAFE_ASCII = bytes([9, 10, 13, *range(0x20, 0x7F)])
_SAFE_REST = re.compile(rb"(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*+")
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")
_SPACE = re.compile("[ \\t\\n\\r]+")


def _safe(text: str) -> bool:
    raw = text.encode()
    return b"<|" not in raw and _SAFE_REST.fullmatch(raw.translate(None, _SAFE_ASCII)) is not None


class PieceEncoder:
    """``tokenizers`` with a memory of pieces.

    The vocabulary lower-cases, drops white space and merges only within a
    piece (a letter run, a digit, a run of signs), so a text's ids are the
    ids of its pieces one after another, and every distinct piece needs the
    library once. The cut into pieces is made here only for characters
    where it cannot differ from the library's (printable ASCII and Latin-1
    letters); a white-space-delimited stretch with any other character, or
    with a possible special token, goes to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if len(vocabulary) <= 1 << 16 else 4
        self.dtype = "<u2" if self.width == 2 else "<u4"
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)     # ids that end a piece
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.place: dict[str, bytes] = {}                                       # ids of a piece, in the files' width

    def _learn(self, missing: list[str]) -> None:
        """``missing``: pieces, or stretches marked by a leading NUL."""
        plain = [m for m in missing if m[0] != "\0"]
        for at in range(0, len(plain), 512):
            part = plain[at: at + 512]
            # no offsets are asked for: they cost more than the ids
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                ends = self._ends(part, ids)
            raw, ends = ids.astype(self.dtype).tobytes(), (ends * self.width).tolist()
            self.place.update(zip(part, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends))))
        odd = [m for m in missing if m[0] == "\0"]
        for m, e in zip(odd, self.tokenizer.encode_batch([m[1:] for m in odd], add_special_tokens=False)):
            self.place[m] = np.array(e.ids, self.dtype).tobytes()

    def _ends(self, part: list[str], ids: np.ndarray) -> np.ndarray:
        """Where the pieces end, of a vocabulary that does not mark it."""
        e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
        words = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
        if len(words) != len(ids) or len(words) and words[-1] != len(part) - 1:
            raise ValueError("the vocabulary does not keep pieces apart")
        return np.searchsorted(words, np.arange(len(part)), side="right")

    def _pieces(self, text: str) -> list[str]:
        if _safe(text):
            return _PIECE.findall(text.lower())
        out: list[str] = []
        for stretch in _SPACE.split(text):
            if stretch:
                if _safe(stretch):
                    out += _PIECE.findall(stretch.lower())
                else:
                    out.append("\0" + stretch)
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, in the files' width; pieces not met before are
        learned for all texts at once."""
        pieces = [self._pieces(t) for t in texts]
        distinct = set().union(*pieces)
        missing = distinct.difference(self.place)
        if missing:
            if len(self.place) + len(missing) > CACHE_PIECES:
                self.place.clear()
                missing = distinct
            self._learn(sorted(missing))
        return [b"".join(map(self.place.__getitem__, p)) for p in pieces]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as uint32."""
        return np.frombuffer(self.encode_all([text])[0], self.dtype).astype(np.uint32)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder; its memory of pieces lives on between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def train_dictionary(docs: DataFrame, tokenizer_path: str) -> bytes:
    """Dictionary from a bounded sample, shrunk to what the sample gives.
    Where even that is too little to train one, the sample's ids are the
    dictionary; it is empty only where no document short enough has a text."""
    short = docs.where(F.col("doc_id").isNotNull() & F.octet_length("text").between(1, SAMPLE_DOC_BYTES))
    # ids first: a task's share of an ordered limit goes to the driver
    ids = short.select(F.col("doc_id").alias("_id")).distinct().orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCS)
    texts = short.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(F.min("text").alias("text"))
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)   # SAMPLE_DOCS rows
    sample = texts.withColumn("_before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)))
    rows = sample.where(F.col("_before") < SAMPLE_BYTES).select("doc_id", "text").collect()
    enc = encoder(tokenizer_path)
    return dictionary_of(enc.encode_all([r["text"] for r in sorted(rows)]))


def dictionary_of(samples: list[bytes]) -> bytes:
    """A dictionary of at most ``DICT_BYTES``, an eighth of ``samples`` at most
    where it is trained."""
    have = sum(map(len, samples))
    size = min(DICT_BYTES, have // 8)
    if size >= LEAST_TRAINED and len(samples) >= 32:
        return zstandard.train_dictionary(size, samples, k=512, d=8).as_bytes()
    return b"".join(samples)[:DICT_BYTES]


def _dictionary(raw: bytes):
    # of raw ids unless it begins with zstandard's mark of a trained one
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_AUTO) if len(raw) >= 8 else None


def pack_block(ids: list[int | None], counts: list[int], frames: list[bytes], width: int, dict_hash: bytes) -> bytes:
    n = len(ids)
    return b"".join([
        HEADER.pack(MAGIC, width, n, dict_hash),
        np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
        np.array([i is None for i in ids], np.uint8).tobytes(),
        np.array(counts, "<u4").tobytes(),
        np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8").tobytes(),
        *frames])


class Block:
    """Reader of one block; :meth:`document` decodes a single document."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, self.width, n, dict_hash = HEADER.unpack_from(data)
        if magic != MAGIC or dict_hash != hashlib.sha256(dictionary).digest():
            raise ValueError("not a token block of this dictionary")
        at = HEADER.size
        ids = np.frombuffer(data, "<i8", n, at)
        null = np.frombuffer(data, np.uint8, n, at + 8 * n)
        self.ids = [None if z else int(i) for i, z in zip(ids, null)]
        self.counts = np.frombuffer(data, "<u4", n, at + 9 * n)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 13 * n)
        self.data, self.first = data, at + 13 * n + 8 * (n + 1)
        d = _dictionary(dictionary)
        self.reader = zstandard.ZstdDecompressor(dict_data=d) if d else zstandard.ZstdDecompressor()

    def document(self, i: int) -> np.ndarray:
        frame = self.data[self.first + int(self.offsets[i]): self.first + int(self.offsets[i + 1])]
        raw = self.reader.decompress(frame)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4")


BLOCK_SCHEMA = "part int, block int, n_docs int, n_tokens long, data binary"
_BLOCK_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("data", pa.binary())])


def _writer(tokenizer_path: str, dictionary: bytes):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = encoder(tokenizer_path)
        d = _dictionary(dictionary)
        zstd = zstandard.ZstdCompressor(level=LEVEL, dict_data=d) if d else zstandard.ZstdCompressor(level=LEVEL)
        dict_hash, end = hashlib.sha256(dictionary).digest(), np.array([END_ID], enc.dtype).tobytes()
        number, ids, counts, frames, held = 0, [], [], [], 0

        def flush():
            nonlocal number, ids, counts, frames, held
            data = pack_block(ids, counts, frames, enc.width, dict_hash)
            out = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([sum(counts)], pa.int64()), pa.array([data], pa.binary())], schema=_BLOCK_ARROW)
            number, ids, counts, frames, held = number + 1, [], [], [], 0
            return out

        for batch in (part for b in batches for part in text_slices(b, 1, LEARN_BYTES)):
            for doc_id, tokens in zip(batch.column(0).to_pylist(), enc.encode_all([t or "" for t in batch.column(1).to_pylist()])):
                tokens += end
                frame = zstd.compress(tokens)
                ids.append(doc_id)
                counts.append(len(tokens) // enc.width)
                frames.append(frame)
                held += len(frame)
                if len(ids) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                    yield flush()
        if ids:
            yield flush()
    return run


def _reader(dictionary: bytes):
    names = [("part", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()), ("in_block", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]

    def run(batches):
        for batch in batches:
            for part, number, data in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "data"))):
                block = Block(data, dictionary)
                counts, crcs = [], []
                for i in range(len(block.ids)):
                    ids = block.document(i)
                    counts.append(len(ids))
                    crcs.append(zlib.crc32(ids.tobytes()))
                starts = np.cumsum([0, *counts[:-1]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(counts), pa.int32()), pa.array([number] * len(counts), pa.int32()),
                    pa.array(block.ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())],
                    schema=pa.schema(names))
    return run, "part int, block int, doc_id long, in_block long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str) -> None:
    """Write ``path``/blocks and ``path``/dictionary."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(rows, tokenizer_path)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    # the text's hash too: rows of a null or repeated id can be split
    order = ["doc_id", F.xxhash64("text")]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(_writer(tokenizer_path, dictionary), BLOCK_SCHEMA)
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from the files."""
    dictionary = bytes(spark.read.schema("dict_hash string, dictionary binary").parquet(f"{path}/dictionary").first()["dictionary"])
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    run, schema = _reader(dictionary)
    docs = blocks.select("part", "block", "data").mapInArrow(run, schema)
    # where a block starts: sums over its part, then over the parts before
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = (blocks.groupBy(F.col("part").alias("_part")).agg(F.sum("n_tokens").alias("n"))
             .select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start")))
    starts = (blocks.select(F.col("part").alias("_p"), F.col("block").alias("_b"), F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("in_part"))
              .join(parts, F.col("_p") == F.col("_part")).select("_p", "_b", (F.col("in_part") + F.col("part_start")).alias("block_start")))
    return (docs.join(starts, (F.col("part") == F.col("_p")) & (F.col("block") == F.col("_b")))
            .select("doc_id", (F.col("block_start") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32"))


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = Scratch(spark, "tokens").base
    write_token_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path)
