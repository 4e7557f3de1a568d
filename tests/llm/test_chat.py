import hashlib
import random

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from skytrace.llm import chat, registry
from tests.llm.helpers import CLASHING

PIECES = st.lists(st.sampled_from(
    ["<s>", "</s>", "[INST]", "[/INST]", "<", "[", "\\", "\\\\", "a", "\n", "😀", "<image>"])).map(
    "".join)


@given(PIECES, PIECES)
def test_reading_back_is_exact(role, text):
    turn = chat.format_turn(role, [{"type": "text", "text": text}])
    assert chat._TURN.findall(turn["formatted"] * 2) == [(chat.escape(role), chat.escape(text))] * 2
    assert chat.unescape(chat.escape(text)) == text
    for control in ("<s>", "</s>", "[INST]", "[/INST]", "<image>"):
        assert control not in chat.escape(text)


def turns(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame = frame.withColumn("parts", chat.text_part(F.col("text")))
    for name in CLASHING:
        frame = frame.withColumn(name, F.lit("other"))
    return frame


def test_digests(spark):
    rows = [(1, 1, "assistant", "b<s>"), (1, 0, "user", "a[INST]"), (1, 2, "user", None),
            (2, 0, "assistant", ""), (None, None, None, "x"), (3, 5, "assistant", "é\\"),
            (3, 5, "assistant", "é\\"), (3, 6, "tool", "</s>")]
    found = {r.conv_id: r for r in chat.digests(chat.format_turns(turns(spark, rows))).collect()}

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert found[1].turns_sha256 == digest("user\na[INST]\nassistant\nb<s>\nuser\n\n")
    assert (found[1].n_turns, found[1].loss_chars) == (3, 4)
    assert found[1].loss_sha256 == digest("b<s>")
    assert (found[2].loss_chars, found[2].loss_sha256) == (0, digest(""))
    assert found[None].turns_sha256 == digest("\nx\n")
    assert found[3].loss_sha256 == digest("é\\é\\")
    assert chat.digests(chat.format_turns(turns(spark, []))).count() == 0


def test_parts_become_placeholders(spark):
    parts = [{"type": "text", "text": "see <"},
             {"type": "image", "uri": "i.png", "width": 30, "height": 14},
             {"type": "audio", "uri": "a.wav", "seconds": 1.5},
             {"type": "document", "uri": "d.pdf", "pages": 2}, {"type": "text", "text": "é"}]
    frame = spark.createDataFrame([(1, 0, "assistant", chat.to_json(parts))],
                                  "conv_id bigint, turn bigint, role string, text string")
    row = chat.format_turns(frame.withColumn("parts", chat.parts_from_json(F.col("text")))).first()
    assert row.formatted == ("<s>assistant[INST]see <\\<image><audio><document>é[/INST]</s>\n")
    assert row.formatted[row.loss_begin:row.loss_end] == "see <\\<image><audio><document>é"
    assert [(a.part, a.type, a.uri, a.tokens) for a in row.attachments] == [
        (1, "image", "i.png", 3), (2, "audio", "a.wav", 38), (3, "document", "d.pdf", 1024)]
    for a in row.attachments:
        assert row.formatted[a.offset:].startswith(f"<{a.type}>")
    assert row.expanded_tokens == 1065


def test_unknown_parts_are_an_error(spark):
    frame = spark.createDataFrame([(1, 0, "user", '[{"type": "video"}]')],
                                  "conv_id bigint, turn bigint, role string, text string")
    with pytest.raises(PythonException):
        chat.format_turns(frame.withColumn("parts", chat.parts_from_json(F.col("text")))).collect()


def test_equal_and_null_turns_against_sql(spark, tmp_path):
    draw = random.Random(8)
    texts = [None, "", "a", "a[", "a<", "a\\", "a]", "a[/INST]", "b", "é"]
    rows = [(draw.choice([1, 2, None]), draw.choice([0, 1, None]),
             draw.choice([None, "", "user", "assistant"]), draw.choice(texts)) for _ in range(300)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(
        1).write.parquet(str(tmp_path / "conversations.parquet"))
    query = registry.op6_chat(spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute("create view conversations as select * from "
                       f"'{tmp_path}/conversations.parquet/*.parquet'")
    found = connection.execute(registry.OP6_SQL)
    names = [d[0] for d in found.description]
    assert sorted(map(str, found.fetchall())) == sorted(
        str(tuple(r)) for r in query.select(*names).collect())
