"""Multi-party chat formatting by perspective rotation.

DataFrame functions only. For every participant of a conversation the dialogue
is rendered with that speaker as the assistant and all others as named users;
the mask holds the character ranges of the assistant's turns (text and end
mark), which are the ones to train on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks around a turn.
ASSISTANT, USER, END = "<|assistant|>\n", "<|user name={}|>\n", "<|end|>\n"
#: Turn numbers in one part of a rendering.
TURNS = 64


def _header(role: Column, participant: Column) -> Column:
    before, after = USER.split("{}")
    return F.when(role == participant, F.lit(ASSISTANT)).otherwise(F.concat(F.lit(before), role, F.lit(after)))


def rotate(turns: DataFrame, per_part: int = TURNS) -> DataFrame:
    """conv_id, participant, part, n_turns, n_trained, text, mask for each participant of each conversation.

    Turns go by number, ties by speaker and then text; exactly repeated rows
    count once. A null role is the speaker "unknown", a null or empty text an
    empty turn; rows without conv_id form one conversation; turns without a
    number come first, as part -1. Quotes or marks inside texts are kept as
    they are, since the mask is by position. An empty table gives no rows.
    Only conv_id, turn, role and text are read.

    Long dialogues are rendered in parts of ``per_part`` turn numbers, so a
    group is as large as the turns that share these numbers: it grows with a
    conversation only where its turns have no numbers or repeat them. ``mask`` is "start:end" by comma in
    characters of the part's text, end exclusive.
    """
    said = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    who = said.select(F.col("conv_id").alias("_conv"), F.col("role").alias("participant")).distinct()
    rows = said.join(who, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / per_part), F.lit(-1)).cast("long"))
    rows = rows.withColumn("_head", _header(F.col("role"), F.col("participant"))).withColumn(
        "_body", F.concat("text", F.lit(END))
    )
    turn = F.struct("turn", "role", "text", "_head", "_body", (F.col("role") == F.col("participant")).alias("own"))
    grouped = rows.groupBy("conv_id", "participant", "part").agg(F.array_sort(F.collect_list(turn)).alias("_t"))
    start = F.named_struct(F.lit("at"), F.lit(0), F.lit("spans"), F.array().cast("array<string>"))

    def step(a: Column, t: Column) -> Column:
        begin = a["at"] + F.length(t["_head"])
        end = begin + F.length(t["_body"])
        span = F.array(F.concat(begin.cast("string"), F.lit(":"), end.cast("string")))
        return F.named_struct(F.lit("at"), end, F.lit("spans"), F.when(t["own"], F.concat(a["spans"], span)).otherwise(a["spans"]))

    return grouped.select(
        "conv_id",
        "participant",
        "part",
        F.size("_t").cast("long").alias("n_turns"),
        F.size(F.filter("_t", lambda t: t["own"])).cast("long").alias("n_trained"),
        F.array_join(F.transform("_t", lambda t: F.concat(t["_head"], t["_body"])), "").alias("text"),
        F.array_join(F.aggregate("_t", start, step)["spans"], ",").alias("mask"),
    )


ORACLE = """
WITH said AS (
  SELECT DISTINCT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations
), rows_ AS (
  SELECT s.conv_id, w.role AS participant, coalesce(CAST(floor(s.turn / 64.0) AS BIGINT), -1) AS part, s.turn, s.role, s.text,
         s.role = w.role AS own,
         CASE WHEN s.role = w.role THEN '<|assistant|>' || chr(10) ELSE '<|user name=' || s.role || '|>' || chr(10) END AS head,
         s.text || '<|end|>' || chr(10) AS body
  FROM said s JOIN (SELECT DISTINCT conv_id, role FROM said) w ON s.conv_id IS NOT DISTINCT FROM w.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(body)) OVER
    (PARTITION BY conv_id, participant, part ORDER BY turn NULLS FIRST, role, text) AS stop FROM rows_
)
SELECT conv_id, participant, part, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_trained,
       string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, text) AS text,
       coalesce(string_agg(CAST(stop - length(body) AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY turn NULLS FIRST, role, text)
         FILTER (WHERE own), '') AS mask
FROM placed GROUP BY conv_id, participant, part
"""
