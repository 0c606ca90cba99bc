"""Chat formatting by grammar round trip, in DataFrame functions only.

The grammar of a formatted conversation: each turn is ``### ``, the role,
``: ``, the text and ``</turn>`` with a newline. Every turn is first rendered as
it is and parsed again; if the parse does not give exactly that turn back, or
the text holds a control string, role and text are rendered escaped
(``\\`` ``<`` ``#`` ``:`` become ``\\b`` ``\\l`` ``\\h`` ``\\c``), which leaves no
control string inside. The parser always undoes escapes, so it needs no flag.
Formatted conversations are parsed once more as a whole and compared with their
source; a difference is an error.

Turns are rendered before they meet, so the only shuffle gathers the rendered
turns of one conversation, which are one output value.

Defined results: null role and null text are empty; turns are ordered by turn
(null first), role, text; repeated rows are turns of their own; rows with a null
``conv_id`` are one conversation with a null id; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The grammar and its escapes.
START, MIDDLE, END = "### ", ": ", "</turn>\n"
CONTROL = ("###", "</turn>")
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))
LOSS_ROLE = "assistant"

# The conversation that the registered query adds.
PROBE = "\\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit(MIDDLE), text, F.lit(END))


def pieces(formatted: Column) -> Column:
    """Raw ``(role, text)`` of every turn of a formatted text, still escaped."""
    parts = F.split(formatted, END)
    body = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))
    return F.transform(body, lambda p: F.struct(
        F.substring_index(p, MIDDLE, 1).alias("role"),
        F.substring(p, F.length(F.substring_index(p, MIDDLE, 1)) + len(MIDDLE) + 1, F.length(p)).alias("text")))


def parse(formatted: Column) -> Column:
    """``(role, text)`` of every turn of a formatted text."""
    return F.transform(pieces(formatted), lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")))


def format_chats(turns: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id, formatted, turns`` (parsed back from it) and
    ``loss_spans`` (start and length, in characters of ``formatted``)."""
    t = turns.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    plain = render(F.col("role"), F.col("text"))
    source = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("text")))
    conflict = parse(plain) != source
    for c in ("role", "text"):
        for control in CONTROL:
            conflict = conflict | F.contains(F.col(c), F.lit(control))
    t = t.withColumn("rendered", F.when(conflict, render(escape(F.col("role")), escape(F.col("text")))).otherwise(plain))
    gathered = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("source"))
    whole = (gathered.withColumn("formatted", F.array_join(F.col("source.rendered"), ""))
             .withColumn("turns", parse(F.col("formatted"))))
    same = F.col("turns") == F.transform("source", lambda s: F.struct(s["role"].alias("role"), s["text"].alias("text")))
    whole = whole.withColumn("turns", F.when(same, F.col("turns")).otherwise(
        F.raise_error(F.lit("a formatted conversation does not parse back to its turns"))))
    step = F.aggregate(
        pieces(F.col("formatted")),
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["role"]) + F.length(p["text"]) + len(START + MIDDLE + END)).alias("at"),
            F.when(p["role"] == LOSS_ROLE, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(p["role"]) + len(START + MIDDLE)).alias("start"),
                F.length(p["text"]).cast("long").alias("length"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return whole.select("conv_id", "formatted", "turns", step.alias("loss_spans"))


def digest(chats: DataFrame) -> DataFrame:
    """The counts and digests of formatted conversations, read from the text."""
    # the loss mask covers the text of each assistant turn, as it stands in the output
    masked = F.transform(F.filter(pieces(F.col("formatted")), lambda p: p["role"] == LOSS_ROLE), lambda p: p["text"])
    loss = F.array_join(F.transform(masked, unescape), "")
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    return digest(format_chats(chats.unionByName(probe)))


_ESCAPED = "replace(replace(replace(replace({c}, '\\', '\\b'), '<', '\\l'), '#', '\\h'), ':', '\\c')"
_CODES = " OR ".join(f"contains({c}, '\\{x}')" for c in ("role", "txt") for x in "blhc")
ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
e AS (
  SELECT *, contains(role, '###') OR contains(txt, '###') OR contains(role, '</turn>') OR contains(txt, '</turn>')
    OR contains(role, ': ') OR {_CODES} AS conflict FROM t),
r AS (
  SELECT *, length(CASE WHEN conflict THEN {_ESCAPED.format(c='role')} || {_ESCAPED.format(c='txt')} ELSE role || txt END)
    + length('### : </turn>') + 1 AS chars FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || txt || chr(10), '' ORDER BY turn NULLS FIRST, role, txt)) AS turns_sha256,
  coalesce(sum(length(txt)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(txt, '' ORDER BY turn NULLS FIRST, role, txt) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""
