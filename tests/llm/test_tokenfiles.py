import random
import zlib

import numpy as np
import public_tokenizers
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarn.llm.common import Scratch
from tarn.llm.tokenfiles import BLOCK_SCHEMA, Block, PieceEncoder, op8_token_files, read_token_files, write_token_files

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows):
    tok, out, start = Tokenizer.from_file(PATH), [], 0
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents_against_the_library(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(map(tuple, op8_token_files(spark, SF).collect())) == brute(rows)


def test_pieces_agree_with_the_library():
    tok, enc = Tokenizer.from_file(PATH), PieceEncoder(PATH)
    texts = ["It's we'LL 'sx don''t", "a<|endoftext|>b <|startoftext|>", "naïve CAFÉ İstanbul ΣΑΣ été", "x y　z​", "1234 ½ ²³ №5", "a\x0bb\x0cc\x1cd\x85e",
             "日本語 テキスト", "“quoted” — ¿qué? ¡sí!", " ́x", "", " \n\t", "!!! ??? ...'s", "\x00\x01", "𝔘𝔫𝔦 👍🏽", "ß STRASSE ẞ ﬁ", "don't-stop'd", "ªº µm"]
    for t in texts:
        assert enc.encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_new_pieces_are_learned_for_many_texts_at_once(monkeypatch):
    class Counted:
        def __init__(self, inner):
            self.inner, self.calls = inner, 0

        def __getattr__(self, name):
            self.calls += 1
            return getattr(self.inner, name)

    rng = random.Random(11)
    texts = [" ".join("".join(rng.choices("abcdeé'T1,", k=rng.randint(1, 9))) for _ in range(12)) for _ in range(200)] + ["", "\x00 odd ²", "a<|endoftext|>b"]
    enc, tok = PieceEncoder(PATH), Tokenizer.from_file(PATH)
    expected = [tok.encode(t, add_special_tokens=False).ids for t in texts]

    def ids():
        return [np.frombuffer(raw, enc.dtype).tolist() for raw in enc.encode_all(texts)]
    enc.tokenizer = Counted(tok)
    assert ids() == expected and 0 < enc.tokenizer.calls < 12       # not once a text
    assert ids() == expected and enc.tokenizer.calls < 12
    monkeypatch.setattr("tarn.llm.tokenfiles.CACHE_PIECES", 10)      # forgets before every call
    enc.last[:] = False                                             # a vocabulary that does not mark a piece's end
    enc.place.clear()
    assert ids() == expected and ids() == expected


def test_files_and_edges(spark, make_docs):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(1500)] + [(None, "no id"), (5000, None), (5001, ""), (5002, "long words " * 60000), (5003, "twice"), (5003, "twice")]
    path = Scratch(spark, "test-tokens").base
    write_token_files(make_docs(rows, extra=True), path, PATH)
    got = sorted(map(tuple, read_token_files(spark, path).collect()), key=lambda r: r[1])
    assert got == brute(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    # a single document of a block, without its neighbours
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    text, tok = dict(rows), Tokenizer.from_file(PATH)
    for r in spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").orderBy(F.rand(3)).limit(2).collect():
        block = Block(bytes(r["data"]), dictionary)
        i = len(block.ids) // 2
        assert block.document(i).tolist() == tok.encode(text[block.ids[i]] or "", add_special_tokens=False).ids + [1]
    empty = Scratch(spark, "test-tokens").base
    write_token_files(make_docs([]), empty, PATH)
    assert read_token_files(spark, empty).collect() == []


def test_any_corpus_has_a_dictionary(spark, make_docs):
    rng = random.Random(8)
    short = [(i, " ".join(rng.choice(["solar", "river", "stone", "cloud", "paper", "music"]) + str(rng.randrange(50)) for _ in range(12))) for i in range(3000)]
    sizes = []
    for rows, trained in ((short, True), (short[:40], False), ([(1, "one two three")], False)):
        path = Scratch(spark, "test-tokens").base
        write_token_files(make_docs(rows), path, PATH)
        dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
        assert dictionary and (dictionary[:4] == (0xEC30A437).to_bytes(4, "little")) == trained
        got = sorted(map(tuple, read_token_files(spark, path).collect()), key=lambda r: r[1])
        assert got == brute(rows)
        sizes.append(sum(len(r["data"]) for r in spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").collect()))
    tok = Tokenizer.from_file(PATH)
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u2").tobytes())) for _, t in short)
    assert sizes[0] - 30 * len(short) < plain      # block headers aside, a dictionary pays


def test_null_and_repeated_ids_are_split_by_text(spark, make_docs):
    # small partitions would be put together again
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _null_ids(spark, make_docs)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _null_ids(spark, make_docs):
    rows = [(None, f"text {i}") for i in range(4000)]
    path = Scratch(spark, "test-tokens").base
    write_token_files(make_docs(rows), path, PATH)
    got = read_token_files(spark, path)
    assert got.count() == 4000 and got.select("start").distinct().count() == 4000
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    assert blocks.groupBy("part").agg(F.sum("n_docs").alias("n")).agg(F.max("n")).first()[0] < 2000
