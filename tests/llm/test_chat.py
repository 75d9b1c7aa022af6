import hashlib

import duckdb
from pyspark.sql import functions as F

from oracle_check import compare
from tarn.llm.chat import OP3_SQL, chat_digest, format_conversations, formatted, op3_chat_format, parse_formatted

SCHEMA = "conv_id long, turn long, role string, text string, segments string"


def digest(spark, rows):
    return {r["conv_id"]: r for r in chat_digest(format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()}


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.001/conversations.parquet'")
    df = op3_chat_format(spark, "/root/testdata/sf0.001")
    res = con.execute(OP3_SQL)
    assert compare([tuple(r) for r in df.collect()], df.columns, res.fetchall(), [d[0] for d in res.description]) is None


def test_round_trip_of_hostile_texts(spark):
    texts = ["<|im_end|>\n", "\\1<|", "\\\\0\\", "<", "|im_start|>", "a\\2\nb", "", None, "é𝄞" * 3]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t, "x") for i, t in enumerate(texts)]
    chats = format_conversations(spark.createDataFrame(rows, SCHEMA))
    back = chats.select(parse_formatted(formatted(F.col("segments"))).alias("t")).first()["t"]
    assert [(t["role"], t["text"]) for t in back] == [(r[2], r[3] or "") for r in rows]
    d = digest(spark, rows)[1]
    said = "".join(t or "" for t in texts[1::2])
    assert d["valid"] and d["loss_chars"] == len(said) and d["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_machine_and_edge_rows(spark):
    rows = [
        (1, 0, "system", "s", ""), (1, 1, "user", "u", ""), (1, 2, "assistant", "a", ""),
        (2, 0, "user", "u", ""), (2, 1, "user", "u", ""),                     # two users in a row
        (3, 0, "assistant", "a", ""),                                         # starts wrong
        (4, 0, None, "x", ""), (4, 1, "to\nol", "y", ""),                     # null and odd roles
        (None, 0, "user", None, ""),                                          # null id
        (5, None, "user", "u", ""), (5, 1, "assistant", "a", ""), (5, 1, "assistant", "a", ""),  # null turn, repeated row
    ]
    d = digest(spark, rows)
    assert d[1]["valid"] and d[1]["first_bad_turn"] is None
    assert (d[2]["valid"], d[2]["first_bad_turn"]) == (False, 1)
    assert (d[3]["valid"], d[3]["first_bad_turn"]) == (False, 0)
    assert d[4]["n_turns"] == 2
    assert d[4]["turns_sha256"] == hashlib.sha256("\nx\nto\nol\ny\n".encode()).hexdigest()
    assert d[None]["n_turns"] == 1 and d[None]["loss_chars"] == 0
    assert d[5]["n_turns"] == 3 and d[5]["loss_chars"] == 2
    assert chat_digest(format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []
