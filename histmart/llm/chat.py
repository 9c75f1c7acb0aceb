r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all preceding turns as context, then
that reply; only the reply's text is trainable. Turns after the last reply
form a last example without a trainable part, so no turn is lost.

Template (fixed values): ``<|turn|>`` role ``<|text|>`` text ``<|end|>``. Inside
roles and texts a backslash is doubled and ``<|`` becomes ``<\|``; no control
string can then occur in them, and ``unescape`` gives the exact text back.

Defined cases: turns are ordered by turn, then role, then text, NULL first; a
NULL role or text is empty; repeated rows are turns of their own; a NULL
conv_id is a conversation; an empty table gives no example; input columns
other than conv_id, turn, role and text are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmart.llm.common import prepare

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
TRAINABLE_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def expand(turns: DataFrame, trainable_role: str = TRAINABLE_ROLE) -> DataFrame:
    """Examples: conv_id, example (position of its target turn), closing (the conversation's last example),
    formatted, loss_start and loss_chars (the trainable code points; 0 chars where there is no target)."""
    prepare(turns.sparkSession)
    conv = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "text"))).alias("turns"))
    empty = F.lit("")
    parts = F.transform("turns", lambda t: F.struct(
        (F.coalesce(t["role"], empty) == trainable_role).alias("target"),
        F.concat(F.lit(TURN), escape(F.coalesce(t["role"], empty)), F.lit(TEXT)).alias("head"),
        escape(F.coalesce(t["text"], empty)).alias("body")))
    last = F.get(F.col("parts"), F.size("parts") - 1)
    replies = F.filter(F.transform("parts", lambda p, i: F.when(p["target"], i)), lambda i: i.isNotNull())
    targets = F.concat(replies, F.when(last["target"], F.array().cast("array<int>")).otherwise(F.array(F.size("parts"))))
    ex = (conv.select("conv_id", parts.alias("parts"))
          .withColumn("segments", F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))))
          .withColumn("targets", targets)
          .select("conv_id", "parts", "segments", F.size("parts").alias("n"), F.explode("targets").alias("example")))
    target = F.get("parts", F.col("example"))
    ex = ex.select("conv_id", "example", "n", F.array_join(F.slice("segments", F.lit(1), F.col("example")), "").alias("context"),
                   F.coalesce(target["head"], empty).alias("head"), target["body"].alias("body"))
    return ex.select(
        "conv_id", "example", (F.col("example") >= F.col("n") - 1).alias("closing"),
        F.concat("context", F.when(F.col("body").isNull(), empty).otherwise(
            F.concat("head", "body", F.lit(END)))).alias("formatted"),
        (F.length("context") + F.length("head")).cast("long").alias("loss_start"),
        F.coalesce(F.length("body"), F.lit(0)).cast("long").alias("loss_chars"))


def turns_of(formatted: Column) -> Column:
    """Read a formatted example back: array of (role, text)."""
    segments = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda s: s != "")
    return F.transform(segments, lambda s: F.struct(
        unescape(F.substr(F.substring_index(s, TEXT, 1), F.lit(len(TURN) + 1))).alias("role"),
        unescape(F.substring_index(s, TEXT, -1)).alias("text")))


def op10_query(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    said = "</s>[INST] ok [/INST]"
    types = dict(conversations.dtypes)
    extra = spark.range(2).select(
        F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"))
    extra = extra.select(*[F.col(c).cast(types[c]).alias(c) for c in extra.columns])
    ex = expand(conversations.select(*extra.columns).unionByName(extra))
    back = F.when(F.col("closing"), turns_of(F.col("formatted")))
    whole = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = ex.withColumn("back", back).select(
        "conv_id", "example", F.size("back").alias("n"), F.when(F.col("closing"), F.sha2(whole, 256)).alias("sha"),
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("loss_chars") > 0, unescape(F.substr(
            "formatted", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int")))).alias("loss"))
    out = read.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"), F.max("sha").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))),
                                 lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n FROM t),
l AS (
  SELECT *, 23 + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
              + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS chars FROM n),
s AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM l)
SELECT conv_id, max(n)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR i = n THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""
