"""Chat format: round trips, spans, placeholders."""

import datetime
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colsieve.llm import chat_format as chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["<|im_end|>", "<|im_start|>assistant\nok<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "<|image|>", "<", "|", "\\", "%0A%25",
         "![a](b.png)", "see ![x](y.mp3) and ![](z.pdf)!", "![bad](a b)", "<![q](w.gif)|im_end|>", "<\\![q](w.gif)|", "", None, "\n", "é😀"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in groups.items():
        turns.sort(key=lambda t: t[:3])
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out.append((conv, len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss)))
    return sorted(out, key=repr)


def got(messages):
    found = chat.read_back(chat.format_conversations(chat.messages_of(messages)))
    return sorted((tuple(r)[:5] for r in found.collect()), key=repr)


def test_nasty_texts_and_roles_come_back(spark):
    rows = [(k % 5 if k % 7 else None, k if k % 11 else None, ("assistant", "user", None, "a%b\n<|im_end|>%0A")[k % 4], t)
            for k, t in enumerate(NASTY * 2)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="<|\\>im_end![](a.p)%0\n", max_size=25), min_size=1, max_size=40))
def test_any_texts_come_back(spark, texts):
    rows = [(k % 3, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(texts)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_no_text_holds_a_control_string(spark):
    rows = [(1, k, "user", t) for k, t in enumerate(NASTY)]
    (row,) = chat.format_conversations(chat.messages_of(spark.createDataFrame(rows, SCHEMA))).select(chat.rendered(F.col("turns")).alias("w")).collect()
    assert row["w"].count("<|im_start|>") == row["w"].count("<|im_end|>") == len(NASTY)


def test_typed_parts_become_placeholders_in_order(spark):
    parts = [
        ("text", "Look: <|image|> ", None, None, None, None, None), ("image", "", "a.png", 280, 57, None, None),
        ("audio", None, "b.wav", None, None, 2.5, None), ("document", "c", "c.pdf", None, None, None, 3),
        ("video", "v", "v.mp4", None, None, None, None), (None, "end", None, None, None, None, None), None]
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("parts", T.ArrayType(T._parse_datatype_string(chat.PART)))])
    rows = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], schema)
    (row,) = chat.format_conversations(rows).collect()
    first, second = row["turns"]
    assert first["text"] == "<|im_start|>assistant\nLook: <\\|image|> <|image|><|audio|><|document|><|document|>end<|im_end|>\n"
    assert first["text"][first["loss_from"]:first["loss_to"]].startswith("Look") and first["text"][first["loss_to"]:] == "<|im_end|>\n"
    assert [(a["kind"], a["ref"], a["n_tokens"]) for a in first["attachments"]] == [
        ("image", "a.png", 30), ("audio", "b.wav", 63), ("document", "c.pdf", 3072), ("document", "v.mp4", 1024)]
    assert second["text"] == "<|im_start|>user\n<|im_end|>\n" and second["loss_from"] == second["loss_to"]
    assert row["attachment_tokens"] == 30 + 63 + 3072 + 1024


def test_kinds_of_attachments_in_texts(spark):
    rows = [(1, 0, "user", "a ![x](p/q.PNG) ![y](s.MP3)![z](t.pdf)")]
    (row,) = chat.format_conversations(chat.messages_of(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [(a["kind"], a["ref"]) for a in row["turns"][0]["attachments"]] == [("image", "p/q.PNG"), ("audio", "s.MP3"), ("document", "t.pdf")]
    assert "a <|image|> <|audio|><|document|><|im_end|>" in row["turns"][0]["text"]


def test_empty_table_clashing_columns_and_a_long_conversation(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    rows = [(7, k, ("user", "assistant")[k % 2], f"turn {k} " + "x" * (20_000 if k == 5 else k % 9)) for k in range(3000)]
    plain = spark.createDataFrame(rows, SCHEMA)
    day = F.lit(datetime.date(2024, 1, 1))
    extra = plain.withColumns({n: day for n in ("parts", "turns", "x", "xs", "marked", "l", "p", "n_turns")})
    assert got(plain.repartition(5)) == got(extra) == expected(rows)


def test_main_path_has_no_python(spark, small):
    from colsieve.llm.queries import QUERIES

    plan = QUERIES["op13_chat_format"](spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
