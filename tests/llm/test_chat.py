import hashlib

from narrata.llm import chat
from narrata.llm.queries import op7_chat_format

SF = "/root/testdata/sf0.01"


def expected(turns):
    convs = {}
    for t in sorted(turns, key=lambda t: (str(t[0]), t[1] is not None, t[1], t[2] or "", t[3] or "")):
        convs.setdefault(t[0], []).append((t[2] or "", t[3] or ""))
    out = {}
    for conv, said in convs.items():
        loss = "".join(text for role, text in said if role == "assistant")
        out[conv] = (
            len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def digests(df):
    rows = df.collect()
    out = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    assert digests(op7_chat_format(spark, SF)) == expected(turns + [(-7, 0, "user", said), (-7, 1, "assistant", said)])


HARD = [
    (1, 0, "user", "</s>[INST] a\\ [/INST]<s>[ROLE]x[/ROLE]\n\\"), (1, 1, "assistant", "<<</s>\n\\n\\\\<|im_end|>"),
    (2, 0, None, None), (2, 1, "assistant", None), (2, 2, "assistant", ""), (2, 3, "assistant", "é中\U0001f600</s"),
    (3, 0, "rôle\n[/ROLE]\n", "x"), (3, 0, "rôle\n[/ROLE]\n", "x"), (3, None, "assistant", "first\x00"),
    (None, 0, "assistant", "no id"), (None, 1, "user", "y" * 100_000),
]


def test_hard_texts(spark):
    df = spark.createDataFrame(HARD, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "'f' AS formatted")
    assert digests(chat.chat_digests(df)) == expected(HARD)
    assert chat.chat_digests(df.filter("false")).collect() == []


def test_long_conversation_goes_over_batches(spark, monkeypatch):
    turns = [(c, t, "assistant" if t % 2 else "user", f"{c} {t} </s>") for c in (5, 6) for t in range(3000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        chats = chat.format_chats(df.coalesce(1))
        assert chats.filter("conv_id = 5").count() > 3
        assert digests(chat.read_back(chats)) == expected(turns)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_formatted_text_marks_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi </s>"), (1, 1, "assistant", "ok")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(df).first()
    assert row.formatted == "<s>[ROLE]user[/ROLE]\nhi <\\/s></s>\n<s>[ROLE]assistant[/ROLE]\nok</s>\n"
    assert [row.formatted[a:b] for a, b in zip(row.loss_start, row.loss_end)] == ["ok"]
    assert chat.parse_chat(row.formatted) == [("user", "hi </s>"), ("assistant", "ok")]
