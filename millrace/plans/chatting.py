"""Queries: class names, prompts, chat records, response parsing, padding, masks, batch inference."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import functions as fn
from millrace.operators import chat, infer
from millrace.plans.data import CLASS_NAMES, QUESTION
from millrace.plans.registry import query
from millrace.sources import table

_NAMES = "[" + ", ".join(f"'{n}'" for n in CLASS_NAMES) + "]"
_ALT = "'(' || replace({}, ': ', ') ')"


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label")


@query(
    "id_to_name",
    f"""SELECT vec_id, ({_NAMES})[label + 1] AS name, {_ALT.format(f'({_NAMES})[label + 1]')} AS alt_name,
               label AS again FROM embeddings""",
)
def id_to_name(spark, sf):
    named = _embeddings(spark, sf).withColumn("name", fn.id_to_name("label", CLASS_NAMES))
    return named.select(
        "vec_id", "name", fn.alt_label("name").alias("alt_name"), fn.name_to_id("name", CLASS_NAMES).alias("again")
    )


@query(
    "name_to_id",
    f"""WITH w AS (SELECT vec_id, label, CASE vec_id % 4 WHEN 0 THEN ({_NAMES})[label + 1]
      WHEN 1 THEN '  ' || ({_NAMES})[label + 1] || ' ' WHEN 2 THEN label::VARCHAR ELSE 'no class' END AS text
      FROM embeddings)
    SELECT vec_id, text, CASE WHEN vec_id % 4 = 3 THEN -1 ELSE label END AS id FROM w""",
)
def name_to_id(spark, sf):
    """Exact names, names with blanks around them, ids as text, and unknown text."""
    kind = F.col("vec_id") % 4
    name = fn.id_to_name("label", CLASS_NAMES)
    text = (
        F.when(kind == 0, name)
        .when(kind == 1, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(kind == 2, F.col("label").cast("string"))
        .otherwise(F.lit("no class"))
    )
    written = _embeddings(spark, sf).withColumn("text", text)
    return written.select("vec_id", "text", fn.name_to_id("text", CLASS_NAMES, "no_match").alias("id"))


@query(
    "class_table",
    f"""WITH c AS (SELECT unnest({_NAMES}) AS name, generate_subscripts({_NAMES}, 1) - 1 AS id)
    SELECT c.id::INT AS id, name, {_ALT.format('name')} AS alt_name, count(vec_id) AS n
    FROM c LEFT JOIN embeddings e ON e.label = c.id GROUP BY ALL""",
)
def class_table(spark, sf):
    """The class list as a table, with the rows per class."""
    counted = _embeddings(spark, sf).groupBy(F.col("label").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return chat.class_table(spark, CLASS_NAMES).join(counted, "id", "left").fillna(0, ["n"])


_RESPONSE_SQL = f"""a AS (SELECT vec_id, label, ({_NAMES})[label + 1] AS name,
      ({_NAMES})[(label + 3) % 10 + 1] AS other FROM embeddings),
    r AS (SELECT vec_id, label, name, other, CASE vec_id % 5 WHEN 0 THEN name
      WHEN 1 THEN 'It looks like ' || {_ALT.format('name')} || '.' WHEN 2 THEN other || ' or ' || name
      WHEN 3 THEN 'hard to say' ELSE lower(name) END AS response FROM a)"""


def _responses(spark, sf):
    """Answers as a model might give them: a name, an alternative spelling, two names, none."""
    kind = F.col("vec_id") % 5
    name = fn.id_to_name("label", CLASS_NAMES)
    other = fn.id_to_name((F.col("label") + 3) % 10, CLASS_NAMES)
    response = (
        F.when(kind == 0, name)
        .when(kind == 1, F.concat(F.lit("It looks like "), fn.alt_label(name), F.lit(".")))
        .when(kind == 2, F.concat(other, F.lit(" or "), name))
        .when(kind == 3, F.lit("hard to say"))
        .otherwise(F.lower(name))
    )
    return _embeddings(spark, sf).withColumn("response", response)


@query(
    "parse_response",
    f"""WITH {_RESPONSE_SQL}
    SELECT vec_id, response, CASE vec_id % 5 WHEN 0 THEN label WHEN 1 THEN label
      WHEN 2 THEN least(label, (label + 3) % 10) ELSE -1 END AS prediction FROM r""",
)
def parse_response(spark, sf):
    return _responses(spark, sf).select(
        "vec_id", "response", fn.parse_response("response", CLASS_NAMES).alias("prediction")
    )


@query(
    "parse_response_full_match",
    "SELECT vec_id, label AS prediction FROM embeddings",
)
def parse_response_full_match(spark, sf):
    exact = _embeddings(spark, sf).withColumn("response", fn.id_to_name("label", CLASS_NAMES))
    return exact.select("vec_id", fn.parse_response("response", CLASS_NAMES, full_match=True).alias("prediction"))


# Words that occur in the given texts, in the spelling "X: word" and so "(X) word".
WORDS = ["the", "und", "que", "est", "of"]


@query(
    "parse_documents",
    "SELECT doc_id, CASE "
    + " ".join(f"WHEN contains(text, '{w}') OR contains(text, '({w}') THEN {i}" for i, w in enumerate(WORDS))
    + " ELSE -1 END AS prediction FROM documents",
)
def parse_documents(spark, sf):
    """The same search over whole document texts."""
    return table(spark, sf, "documents").select("doc_id", fn.parse_response("text", WORDS).alias("prediction"))


_PROMPT = "'" + QUESTION + "' || chr(10) || array_to_string(" + _NAMES + ", chr(10))"


@query("choice_prompt", f"SELECT vec_id, {_PROMPT} AS prompt FROM embeddings")
def choice_prompt(spark, sf):
    return _embeddings(spark, sf).select("vec_id", fn.choice_prompt(QUESTION, CLASS_NAMES).alias("prompt"))


@query(
    "chat_messages",
    f"""SELECT vec_id, 2 AS n_turns, 'user' AS first_role, 'image' AS first_type, NULL::VARCHAR AS first_text,
    {_PROMPT} AS prompt, 'assistant' AS last_role, ({_NAMES})[label + 1] AS answer, 1 AS n_test_turns
    FROM embeddings""",
)
def chat_messages(spark, sf):
    prompt = fn.choice_prompt(QUESTION, CLASS_NAMES)
    both = chat.chat_messages(_embeddings(spark, sf), prompt, CLASS_NAMES)
    both = chat.chat_messages(both, prompt, with_answer=False, column="test_messages")
    first, last = F.col("messages")[0], F.col("messages")[1]
    return both.select(
        "vec_id",
        F.size("messages").alias("n_turns"),
        first["role"].alias("first_role"),
        first["content"][0]["type"].alias("first_type"),
        first["content"][0]["text"].alias("first_text"),
        first["content"][1]["text"].alias("prompt"),
        last["role"].alias("last_role"),
        last["content"][0]["text"].alias("answer"),
        F.size("test_messages").alias("n_test_turns"),
    )


@query(
    "render_chat",
    f"""SELECT vec_id, '<user>' || chr(10) || '<image>' || {_PROMPT} || chr(10) || '<assistant>' || chr(10)
    || ({_NAMES})[label + 1] AS rendered FROM embeddings""",
)
def render_chat(spark, sf):
    messages = chat.chat_messages(_embeddings(spark, sf), fn.choice_prompt(QUESTION, CLASS_NAMES), CLASS_NAMES)
    return messages.select("vec_id", chat.render_chat("messages").alias("rendered"))


@query(
    "render_turns",
    """SELECT conv_id, trim(string_agg('<' || role || '>' || chr(10) || text || chr(10), '' ORDER BY turn, role, text),
    E' \\t\\n\\r\\f\\v') AS rendered FROM conversations GROUP BY conv_id""",
)
def render_turns(spark, sf):
    return chat.render_turns(table(spark, sf, "conversations"), "conv_id")


# ---- tokens ------------------------------------------------------------------------------------

PAD, IMAGE_START, IMAGE = 0, 1, 2


def _tokens(spark, sf, batch: int):
    """Whole documents as token ids: the length of each word stands for its id."""
    words = F.split("text", " ")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.floor(F.col("doc_id") / batch).alias("batch"),
        F.transform(words, lambda w: F.length(w)).alias("tokens"),
    )


def _tokens_sql(batch: int) -> str:
    return f"""t AS (SELECT doc_id, doc_id // {batch} AS batch,
      list_transform(string_split(text, ' '), lambda w: length(w)::INT) AS tokens FROM documents),
    m AS (SELECT *, max(len(tokens)) OVER (PARTITION BY batch) AS longest FROM t)"""


_ZEROS = "list_resize([]::INT[], longest - len(tokens), 0)"


@query(
    "pad_right",
    f"""WITH {_tokens_sql(4)} SELECT doc_id, longest::INT AS n,
    md5(array_to_string(list_concat(tokens, {_ZEROS}), ',')) AS ids FROM m""",
)
def pad_right(spark, sf):
    padded = chat.pad_tokens(_tokens(spark, sf, 4), "tokens", "batch", PAD, "right")
    return padded.select(
        "doc_id", F.size("input_ids").alias("n"), F.md5(F.array_join("input_ids", ",")).alias("ids")
    )


@query(
    "pad_left",
    f"""WITH {_tokens_sql(64)} SELECT doc_id, longest::INT AS n,
    md5(array_to_string(list_concat({_ZEROS}, tokens), ',')) AS ids FROM m""",
)
def pad_left(spark, sf):
    padded = chat.pad_tokens(_tokens(spark, sf, 64), "tokens", "batch", PAD, "left")
    return padded.select(
        "doc_id", F.size("input_ids").alias("n"), F.md5(F.array_join("input_ids", ",")).alias("ids")
    )


@query(
    "pad_mask",
    f"""WITH {_tokens_sql(4)}, p AS (SELECT doc_id, list_concat(tokens, {_ZEROS}) AS ids FROM m)
    SELECT doc_id, md5(array_to_string(list_transform(ids,
      lambda x: CASE WHEN x IN (0, 1, 2) THEN -100 ELSE x END), ',')) AS labels FROM p""",
)
def pad_mask(spark, sf):
    padded = chat.pad_tokens(_tokens(spark, sf, 4), "tokens", "batch", PAD, "right")
    labels = fn.mask_labels("input_ids", [PAD, IMAGE_START, IMAGE])
    return padded.select("doc_id", F.md5(F.array_join(labels, ",")).alias("labels"))


# ---- batch inference ---------------------------------------------------------------------------


@query(
    "batch_infer",
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i
                  FROM embeddings),
    c AS (SELECT label AS class, i, avg(v) AS m FROM x GROUP BY label, i),
    d AS (SELECT vec_id, class, sum((v - m) * (v - m)) AS dist FROM x JOIN c USING (i) GROUP BY vec_id, class)
    SELECT vec_id, arg_min(class, dist) AS prediction FROM d GROUP BY vec_id""",
)
def batch_infer(spark, sf):
    """Nearest class centre, as a model that each Python worker builds once and applies per batch."""
    vectors = table(spark, sf, "embeddings")
    slots = vectors.select("label", F.posexplode("embedding").alias("i", "v"))
    centres = slots.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    rows = sorted((r["label"], r["i"], r["m"]) for r in centres.collect())  # classes x 64 numbers
    classes = sorted({r[0] for r in rows})
    means = [[m for c, _, m in rows if c == label] for label in classes]

    def make_predict_fn():
        known, centre = np.array(classes), np.array(means)

        def predict(x: np.ndarray) -> np.ndarray:
            # |x - c|^2 without |x|^2, which is the same for every class
            distance = (centre**2).sum(axis=1) - 2.0 * x.astype(np.float64) @ centre.T
            return known[distance.argmin(axis=1)]

        return predict

    out = infer.batch_infer(vectors, ["embedding"], make_predict_fn, T.IntegerType(), 64, [[64]])
    return out.select("vec_id", "prediction")
