"""Class names, responses, chat records, padding, masks, batch inference."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import functions as fn
from millrace.operators import chat, infer

NAMES = ["A: red", "B: red deer", "C: blue"]


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("A: red", 0), ("it is (C) blue, surely", 2), ("C: blue or A: red", 0), ("B: red deer", 1),
        ("a: red", -1), ("", -1), ("xxA: redxx", 0), (None, -1),
    ],
)
def test_parse_response(spark, text, wanted):
    assert one(spark, fn.parse_response("v", NAMES), text) == wanted


def test_full_match(spark):
    full = fn.parse_response("v", NAMES, full_match=True)
    assert one(spark, full, "B: red deer") == 1
    assert one(spark, full, " C: blue\n".strip() + " ") == 2
    assert one(spark, full, "2") == 2
    with pytest.raises(Exception, match="unknown class name"):
        one(spark, full, "it is A: red")


def test_ids_and_names(spark):
    assert one(spark, fn.id_to_name("v", NAMES), 2, "int") == "C: blue"
    with pytest.raises(Exception, match="outside the list"):
        one(spark, fn.id_to_name("v", NAMES), 3, "int")
    assert one(spark, fn.id_to_name("v", NAMES, "null"), -1, "int") is None
    assert one(spark, fn.name_to_id("v", NAMES, "no_match"), "9") == -1
    assert one(spark, fn.alt_label("v"), "X: a: b") == "(X) a) b"
    assert one(spark, fn.choice_prompt("Q?", NAMES), "-") == "Q?\nA: red\nB: red deer\nC: blue"
    assert [r["alt_name"] for r in chat.class_table(spark, NAMES).collect()] == ["(A) red", "(B) red deer", "(C) blue"]


def test_messages(spark):
    df = chat.chat_messages(spark.createDataFrame([(1,)], "label int"), "Q?", NAMES)
    wanted = [
        ("user", [("image", None), ("text", "Q?")]),
        ("assistant", [("text", "B: red deer")]),
    ]
    found = df.first()["messages"]
    assert [(t["role"], [tuple(p) for p in t["content"]]) for t in found] == wanted
    asked = chat.chat_messages(df, "Q?", with_answer=False, column="asked").first()["asked"]
    assert len(asked) == 1
    assert df.select(chat.render_chat("messages")).first()[0] == "<user>\n<image>Q?\n<assistant>\nB: red deer"


def test_long_conversation_in_blocks(spark):
    rows = [(1, t, "user", f"t{t} ") for t in range(1000)] + [(2, 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = {r["conv_id"]: r["rendered"] for r in chat.render_turns(df, "conv_id", turn_template="{role}{text}").collect()}
    assert found[1] == "".join(f"usert{t} " for t in range(1000)).strip()
    assert found[2] == "user"


def test_padding_and_masks(spark):
    rows = [(1, "x", [5, 0, 7]), (2, "x", [5]), (3, "y", []), (4, None, [9, 9]), (5, None, [1])]
    df = spark.createDataFrame(rows, "id int, batch string, tokens array<int>")
    right = {r["id"]: r["input_ids"] for r in chat.pad_tokens(df, "tokens", "batch", 0).collect()}
    assert right == {1: [5, 0, 7], 2: [5, 0, 0], 3: [], 4: [9, 9], 5: [1, 0]}
    left = chat.pad_tokens(df, "tokens", "batch", 0, "left")
    assert {r["id"]: r["input_ids"] for r in left.collect()}[2] == [0, 0, 5]
    masked = left.withColumn("labels", fn.mask_labels("input_ids", [0, 7]))
    assert {r["id"]: r["labels"] for r in masked.collect()}[1] == [5, -100, -100]
    with pytest.raises(ValueError):
        chat.pad_tokens(df, "tokens", "batch", side="middle")


def test_batch_infer(spark):
    rows = [(i, [float(i), 1.0], 2.0) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x array<float>, w double").repartition(3)

    def make_predict_fn():
        def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
            assert len(x) <= 64
            return x.sum(axis=1) * w

        return predict

    out = infer.batch_infer(df, ["x", "w"], make_predict_fn, T.DoubleType(), 64, [[2], None])
    assert {r["id"]: r["prediction"] for r in out.collect()} == {i: (i + 1) * 2.0 for i in range(300)}
    assert out.filter(F.col("prediction").isNull()).count() == 0


def test_padding_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, [1], "a", "b", 0), (1, [1, 2], "c", "d", 0)], "batch int, tokens array<int>, _batch string, _longest string, longest int")
    out = chat.pad_tokens(df, "tokens", "batch", 9)
    assert out.columns == [*df.columns, "input_ids"]
    assert sorted((r["_batch"], r["_longest"], r["input_ids"]) for r in out.collect()) == [("a", "b", [1, 9]), ("c", "d", [1, 2])]
