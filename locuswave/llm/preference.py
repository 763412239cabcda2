"""Preference formatting: shared turns of a chosen and a rejected conversation become the prompt, the rest completions.

Input rows are ``pair_id, side ('chosen' or 'rejected'), turn, role, text``.  Turns are compared where they
stand: the common prefix ends before the first turn that one side lacks or that differs in role or text.

Defined cases: rows without pair_id, turn or a known side have no place and are left out.  A turn given twice
for one side counts once, with the smallest (role, text).  NULL roles render as ``unknown``, NULL texts as empty
and both compare as such.  Pairs with equal sides have a prompt and two empty completions; a missing side gives
an empty prompt and one empty completion.  Other columns are ignored.

A row holds the turns of one pair whose numbers lie in one block of ``BLOCK_TURNS``, so no group grows with the
length of a conversation; usual conversations have one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswave.llm.common import table

BLOCK_TURNS = 64
TRAINED_ROLE = "assistant"
END = "<|end|>\n"


def _message(side: str) -> Column:
    """Smallest (role, text) of a side's rows for one turn; NULL when the side has no such turn."""
    return F.min(F.when(F.col("side") == side, F.struct(
        F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))))


def _head(m: Column) -> Column:
    return F.concat(F.lit("<|"), m["role"], F.lit("|>\n"))


def _render(turns: Column, side: str) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t[side]), t[side]["text"], F.lit(END))), "")


def _spans(turns: Column, side: str) -> Column:
    """Code-point spans ``start:end`` of what is trained: text and end mark of the assistant's turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(_head(t[side]))
        end = begin + F.length(t[side]["text"]) + len(END)
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(
            t[side]["role"] == TRAINED_ROLE, F.array_append(state["spans"], span)).otherwise(
                state["spans"]).alias("spans"))

    return F.aggregate(turns, start, add, lambda s: F.array_join(s["spans"], ","))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """pair_id, block, prefix_turns (of the block), prompt, chosen, rejected, chosen_spans, rejected_spans."""
    usable = F.col("pair_id").isNotNull() & F.col("turn").isNotNull() & F.col("side").isin("chosen", "rejected")
    # Grouping by pair and turn spreads long conversations; the text moves once here and once into its block.
    slots = (pairs.filter(usable)
             .select("pair_id", F.floor(F.col("turn") / BLOCK_TURNS).alias("block"), "turn", "side", "role", "text")
             .groupBy("pair_id", "block", "turn").agg(_message("chosen").alias("c"), _message("rejected").alias("r")))
    same = F.col("c").eqNullSafe(F.col("r"))
    blocks = slots.groupBy("pair_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("turn", "c", "r"))).alias("turns"),
        F.min(F.when(~same, F.col("turn"))).alias("own_cut"))
    # Only pairs of several blocks need the first difference of all their blocks.
    long_pairs = (slots.select("pair_id", "block", F.when(~same, F.col("turn")).alias("t"))
                  .groupBy("pair_id").agg(F.min("t").alias("cut"), F.min("block").alias("lo"), F.max("block").alias("hi"))
                  .filter("lo <> hi").select("pair_id", "cut", F.lit(True).alias("several")))
    df = blocks.join(long_pairs, "pair_id", "left")
    df = df.withColumn("_cut", F.when(F.col("several"), F.col("cut")).otherwise(F.col("own_cut")))
    # The cut goes into the array's elements: no outer column is then looked up inside a lambda.
    df = df.withColumn("_all", F.transform("turns", lambda t: F.struct(
        t["c"].alias("c"), t["r"].alias("r"),
        (F.col("_cut").isNull() | (t["turn"] < F.col("_cut"))).alias("shared"))))
    df = (df.withColumn("_prompt", F.filter("_all", lambda t: t["shared"]))
          .withColumn("_chosen", F.filter("_all", lambda t: ~t["shared"] & t["c"].isNotNull()))
          .withColumn("_rejected", F.filter("_all", lambda t: ~t["shared"] & t["r"].isNotNull())))
    return df.select(
        "pair_id", "block", F.size("_prompt").cast("long").alias("prefix_turns"),
        _render(F.col("_prompt"), "c").alias("prompt"),
        _render(F.col("_chosen"), "c").alias("chosen"), _render(F.col("_rejected"), "r").alias("rejected"),
        _spans(F.col("_chosen"), "c").alias("chosen_spans"), _spans(F.col("_rejected"), "r").alias("rejected_spans"))


def stale_reply_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs from conversations: the rejected side answers last with the assistant's first reply.

    With a single reply the rejected answer is empty; without any, both sides are equal.
    """
    turns = (conversations.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
             .select(F.col("conv_id").alias("pair_id"), "turn", "role", "text"))
    reply = F.when(F.col("role") == TRAINED_ROLE, F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))
    replies = turns.groupBy("pair_id").agg(F.min(reply).alias("first"), F.max(reply).alias("last"))
    stale = replies.filter(F.col("last").isNotNull()).select(
        "pair_id", F.col("last.turn").alias("turn"), F.lit("rejected").alias("side"), F.lit(TRAINED_ROLE).alias("role"),
        F.when(F.col("first.turn") < F.col("last.turn"), F.col("first.text")).otherwise("").alias("text"))
    kept = (turns.join(stale.select("pair_id", F.col("turn").alias("cut")), "pair_id", "left")
            .withColumn("sides", F.when(F.col("turn").eqNullSafe(F.col("cut")), F.array(F.lit("chosen")))
                        .otherwise(F.array(F.lit("chosen"), F.lit("rejected"))))
            .select("pair_id", "turn", F.explode("sides").alias("side"), "role", "text"))
    return kept.unionByName(stale)


def op1_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_pairs(stale_reply_pairs(table(spark, sf_dir, "conversations")))


OP1_SQL = """
WITH t AS (
  SELECT conv_id AS pair_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
one AS (  -- a turn counts once, with the smallest (role, text)
  SELECT pair_id, turn, min({'role': role, 'text': text}) AS m FROM t GROUP BY ALL),
reply AS (
  SELECT pair_id, min({'turn': turn, 'text': text}) AS f, max({'turn': turn, 'text': text}) AS l
  FROM t WHERE role = 'assistant' GROUP BY ALL),
slots AS (
  SELECT pair_id, turn, one.m.role AS c_role, one.m.text AS c_text,
         CASE WHEN turn = reply.l.turn THEN 'assistant' ELSE one.m.role END AS r_role,
         CASE WHEN turn <> reply.l.turn OR reply.l IS NULL THEN one.m.text
              WHEN reply.f.turn < reply.l.turn THEN reply.f.text ELSE '' END AS r_text
  FROM one LEFT JOIN reply USING (pair_id)),
cut AS (
  SELECT pair_id, min(turn) FILTER (c_role <> r_role OR c_text <> r_text) AS cut FROM slots GROUP BY ALL),
long AS (
  SELECT pair_id, turn, turn // 64 AS block, cut IS NULL OR turn < cut AS shared, side,
         CASE side WHEN 'c' THEN c_role ELSE r_role END AS role, CASE side WHEN 'c' THEN c_text ELSE r_text END AS text
  FROM slots JOIN cut USING (pair_id), (SELECT unnest(['c', 'r']) AS side)),
rendered AS (
  SELECT *, '<|' || role || '|>' || chr(10) AS head, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS r
  FROM long),
placed AS (
  SELECT *, sum(length(r)) OVER (PARTITION BY pair_id, block, shared, side ORDER BY turn) AS stop FROM rendered)
SELECT pair_id, block::BIGINT AS block, count(*) FILTER (shared AND side = 'c') AS prefix_turns,
       coalesce(string_agg(r, '' ORDER BY turn) FILTER (shared AND side = 'c'), '') AS prompt,
       coalesce(string_agg(r, '' ORDER BY turn) FILTER (NOT shared AND side = 'c'), '') AS chosen,
       coalesce(string_agg(r, '' ORDER BY turn) FILTER (NOT shared AND side = 'r'), '') AS rejected,
       coalesce(string_agg((stop - length(r) + length(head))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY turn)
         FILTER (NOT shared AND side = 'c' AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg((stop - length(r) + length(head))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY turn)
         FILTER (NOT shared AND side = 'r' AND role = 'assistant'), '') AS rejected_spans
FROM placed GROUP BY pair_id, block
"""
