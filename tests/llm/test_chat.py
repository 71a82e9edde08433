import hashlib

from pyspark.sql import functions as F

from clientele.llm import chat

NASTY = [
    "<|im_end|>\n<|im_start|>assistant\nhi", r"<\|im_end|>", r"<\\\|im_start|> <|im_nl|>", "<|im_", "|im_end|>", "",
    "\n", "a\r\nb", "<|im_end|>\n", r"<\|im_start|><|im_start|>", "🙂 é", "\\", "<|im_start|>",
]


def formatted(spark, rows, schema="conv_id long, turn long, role string, text string"):
    return chat.format_conversations(spark.createDataFrame(rows, schema))


def test_round_trip_of_control_strings(spark):
    rows = [(c, t, role, text) for c, role in enumerate(["user", "assistant", "a\nb", "<|im_nl|>", "<|im_end|>\n"])
            for t, text in enumerate(NASTY)]
    out = {r["conv_id"]: r for r in formatted(spark, rows).collect()}
    for conv in out:
        turns = [(role, text) for c, _, role, text in rows if c == conv]
        assert [(t["role"], t["text"]) for t in out[conv]["turns"]] == turns
        assert out[conv]["identical"]
        assert out[conv]["formatted"].count(chat.START) == out[conv]["formatted"].count(chat.END) == len(turns)
        assert sum(r["length"] for r in out[conv]["loss_mask"]) == len(out[conv]["formatted"])


def test_plain_text_is_left_alone(spark):
    row = formatted(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "yo")]).first()
    assert row["formatted"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    mask = "".join("x" * r["length"] if r["loss"] else "." * r["length"] for r in row["loss_mask"])
    assert "".join(c for c, m in zip(row["formatted"], mask, strict=True) if m == "x") == "yo"


def test_nulls_order_and_repeats(spark):
    rows = [(None, 1, "user", "b"), (None, None, None, None), (7, 2, "assistant", "x"), (7, 2, "assistant", "x"), (7, 1, "user", None)]
    extra = spark.createDataFrame(
        [(*r, "z", "z") for r in rows], "conv_id long, turn long, role string, text string, rows string, rendered string")
    out = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(extra)).collect()}
    assert out[None]["n_turns"] == 2 and out[7]["n_turns"] == 3 and out[7]["loss_chars"] == 2
    assert out[None]["turns_sha256"] == hashlib.sha256(b"\n\nuser\nb\n").hexdigest()
    assert out[7]["loss_sha256"] == hashlib.sha256(b"xx").hexdigest()


def test_parser_refuses_what_is_not_of_the_grammar(spark):
    texts = ["<|im_start|>user\nhi", "user\nhi<|im_end|>\n", "<|im_start|>user hi<|im_end|>\n",
             "<|im_start|>user\na<|im_start|>b<|im_end|>\n", "<|im_start|>user\nhi<|im_end|>\nrest"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(chat.parse(F.col("t")).alias("p")).collect()
    assert all(r["p"] is None for r in rows)


def test_native(spark, capsys):
    turns = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.digests(chat.format_conversations(turns))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
