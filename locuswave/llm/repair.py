"""Conversation structure repair by aligning turns to the alternating grammar, with an audit string.

Method.  ``repair_align`` aligns the turns to each feasible length of the grammar string inside Ukkonen bands and
compares the backtraced audits.  Conversations of up to ``LOCAL_TURNS`` turns are aligned whole, in one pass over rows
that are shuffled by conversation and sorted by turn.  Longer ones are cut: a range sort deals their turns over tasks,
each task aligns blocks for every pair of grammar states, the few fragments are joined, and a second sorted pass streams
the repaired turns into the hash.  No conversation is ever held in one task as texts; both ways give the same rows.

Order.  Turns go by ``turn`` (NULL first), then role and text; equal rows are told apart by nothing.

Defined cases.  NULL role or text: one space (so the turn is blank).  NULL conv_id: a conversation of its own.  Roles other
than system, user and assistant count by their first character and can only be renamed or deleted.  An empty role has no
initial.  Repeated rows: the second is a duplicate.  A conversation without rows after the damage: zeros, an empty
audit and the hash of the empty text.  Other columns are not read.  No rows: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswave.llm import repair_align as ra
from locuswave.llm.common import table
from locuswave.session import bounded_side, stage

LOCAL_TURNS = 1024
# White space of the contract and the marks that end a complete turn.
BLANKS = "\x20\t\n\x0b\x0c\r"
STOPS = ".!?"
LEGAL = {"su", "ua", "au"}
ROLE_OF = {"u": "user", "a": "assistant"}
DAMAGES = 20

COUNTS = ("blank", "duplicate", "truncated", "illegal")
RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, " \
         "audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after reproducible damage, drawn from a checksum of ``conv_id:turn``."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % DAMAGES
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                                draw.alias("_draw")).filter("_draw <> 0")
    text = F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("_draw") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_draw") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def symbol(role: str, text: str, seen: bool) -> tuple[str, str]:
    """The turn's symbol for the alignment and its fault (b, d, t or none)."""
    shown = text.strip(BLANKS)
    if not shown or seen:
        return "-", "d" if shown else "b"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return (initial, "") if shown[-1] in STOPS else (initial.upper(), "t")


class Digest:
    """Hash of the repaired turns, fed turn by turn along the audit."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at = audit, 0
        self.left = len(audit) - audit.count("D")
        # An odd number of repaired turns begins with the system turn; users are an even number of turns from the end.
        self.hash, self.first = hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
        self.first = False
        self.left -= 1

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._put(self.due(), "")
            self.at += 1

    def due(self) -> str:
        return ROLE_OF["a" if self.left % 2 else "u"]

    def turn(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._put(role if edit == "K" else self.due(), text)

    def result(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _whole(conv_id, turns: list, roles: list[str], texts: list[str]) -> tuple:
    seen, symbols, faults = set(), [], []
    for row in zip(roles, texts):
        mark, fault = symbol(*row, row in seen)
        seen.add(row)
        symbols.append(mark)
        faults.append(fault)
    cost, audit = ra.conversation("".join(symbols))
    digest = Digest(audit)
    for role, text in zip(roles, texts):
        digest.turn(role, text)
    known = {int(t) for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    return (conv_id, gaps, *(faults.count(f) for f in "bdt"), _illegal([r[:1] for r in roles]), cost, audit, digest.result())


def _runs(frames: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[object, pd.DataFrame]]:
    """Consecutive rows of equal key, each run in one or more frames; a frame at a time is held."""
    for frame in frames:
        if len(frame):
            change = (frame[key] != frame[key].shift()).cumsum()
            for _, part in frame.groupby(change, sort=False):
                yield part[key].iat[0], part


def _local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole conversations from sorted rows; a conversation has at most LOCAL_TURNS of them."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    held, name, out = [], None, []
    conv = None

    def done():
        if held:
            out.append(_whole(conv, *map(list, zip(*held))))

    for frame in frames:
        # Longs with NULLs come as floats, which lose digits: turns and ids travel as text.
        for key, conv_id, turn, role, text in zip(frame["_conv"], frame["_id"], frame["_turn"], frame["role"], frame["text"]):
            if key != name:
                done()
                held, name, conv = [], key, None if conv_id is None else int(conv_id)
            held.append((turn, role, text))
        if len(out) >= 1000:
            yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
            out = []
    done()
    yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})


FRAGMENT = "_conv string, part int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, " \
           "tail string, costs array<bigint>, audits array<string>"
PAIRS = [(a, b) for a in ra.STATES for b in ra.STATES]


def _fragments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation of a sorted partition: counts, edge initials and the cheapest edits per state pair."""
    out: list[tuple] = []
    name, previous, chain, marks = None, None, None, []
    counts, head, tail, part = {}, "", "", 0

    def flush(last: bool) -> None:
        nonlocal marks
        if marks and (last or len(marks) == ra.BLOCK):
            chain.add(ra.block("".join(marks)))
            marks = []

    def done() -> None:
        if name is not None:
            flush(True)
            matrix = chain.result()
            out.append((name, part, *(counts[c] for c in COUNTS), head, tail,
                        [matrix[p][0] if p in matrix else -1 for p in PAIRS],
                        [matrix[p][1] if p in matrix else "" for p in PAIRS]))

    for frame in frames:
        for key, turn, role, text, late, part_ in zip(frame["_conv"], frame["_turn"], frame["role"], frame["text"],
                                                      frame["_late"], frame["_part"]):
            if key != name:
                done()
                name, previous, chain, marks = key, None, ra.Chain(), []
                counts, head, tail, part = dict.fromkeys(COUNTS, 0), role[:1], None, part_
            row = (turn, role, text)
            mark, fault = symbol(role, text, bool(late) or row == previous)
            counts["blank"] += fault == "b"
            counts["duplicate"] += fault == "d"
            counts["truncated"] += fault == "t"
            counts["illegal"] += tail is not None and tail + role[:1] not in LEGAL
            previous, tail = row, role[:1]
            marks.append(mark)
            flush(False)
    done()
    yield pd.DataFrame(out, columns=[c.split()[0] for c in FRAGMENT.split(", ")])


def _combined(frame: pd.DataFrame) -> pd.DataFrame:
    """Fragments of one conversation, at most one per partition, joined in order."""
    frame = frame.sort_values("part")
    parts = [{p: (c, a) for p, c, a in zip(PAIRS, costs, audits) if c >= 0}
             for costs, audits in zip(frame["costs"], frame["audits"])]
    whole = ra.chained(parts)
    cost, audit = min(whole[ra.START, leave] for leave in ra.ENDS if (ra.START, leave) in whole)
    heads, tails = list(frame["head"]), list(frame["tail"])
    between = sum(a + b not in LEGAL for a, b in zip(tails, heads[1:]))
    return pd.DataFrame([(frame["_conv"].iat[0], *(int(frame[c].sum()) for c in COUNTS[:3]),
                          int(frame["illegal"].sum()) + between, cost, audit)],
                        columns=["_conv", *COUNTS, "cost", "audit"])


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes of repaired conversations: a row with the audit, then the turns in order, streamed."""
    out, name, digest = [], None, None
    for frame in frames:
        for key, audit, role, text in zip(frame["_conv"], frame["audit"], frame["role"], frame["text"]):
            if audit is not None:
                if digest:
                    out.append((name, digest.result()))
                name, digest = key, Digest(audit)
            else:
                digest.turn(role, text)
    if digest:
        out.append((name, digest.result()))
    yield pd.DataFrame(out, columns=["_conv", "repaired_sha256"])


def _conv() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_conv")


def _long_conversations(rows: DataFrame) -> DataFrame:
    """Result rows of conversations too long for one task; ``rows`` is staged."""
    said = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    rows = rows.withColumn("_said", said).withColumn("_when", F.struct(F.col("turn").alias("t")))
    first = rows.groupBy("_conv", "_said").agg(F.min("_when").alias("_first"))
    order = [F.col("_conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    placed = rows.join(first, ["_conv", "_said"]).select(
        "_conv", "turn", F.col("turn").cast("string").alias("_turn"), "role", "text",
        (~F.col("_when").eqNullSafe(F.col("_first"))).alias("_late"))
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    fragments = placed.drop("turn").mapInPandas(_fragments, FRAGMENT)
    audits = stage(fragments.groupBy("_conv").applyInPandas(
        _combined, "_conv string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"),
        "repair-audits")
    gaps = rows.groupBy("_conv", "conv_id", "turn").agg(F.lit(1).alias("_one")).groupBy("_conv", "conv_id").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    none = F.lit(None).cast("string")
    lead = audits.select("_conv", "audit", F.lit(None).cast("bigint").alias("turn"), none.alias("role"), none.alias("text"))
    turns = rows.select("_conv", none.alias("audit"), "turn", "role", "text")
    stream = lead.unionByName(turns).repartition("_conv").sortWithinPartitions(
        "_conv", F.desc_nulls_last("audit"), F.asc_nulls_first("turn"), "role", "text")
    hashes = stream.select("_conv", "audit", "role", "text").mapInPandas(_hashed, "_conv string, repaired_sha256 string")
    return audits.join(gaps, "_conv").join(hashes, "_conv").select(*[c.split()[0] for c in RESULT.split(", ")])


def repair(turns: DataFrame, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text; no NULL role or text): faults, edits, hash."""
    rows = turns.withColumn("_conv", _conv())
    long_ones = stage(rows.groupBy("_conv").agg(F.count(F.lit(1)).alias("_n")).filter(
        F.col("_n") > local_turns).select("_conv"), "repair-long")
    side = bounded_side(long_ones)
    short = rows.join(side, "_conv", "left_anti").select(
        "_conv", F.col("conv_id").cast("string").alias("_id"), "turn", "role", "text")
    done = short.repartition("_conv").sortWithinPartitions("_conv", F.asc_nulls_first("turn"), "role", "text").select(
        "_conv", "_id", F.col("turn").cast("string").alias("_turn"), "role", "text").mapInPandas(_local, RESULT)
    if long_ones.first() is None:
        return done
    return done.unionByName(_long_conversations(stage(rows.join(side, "_conv", "left_semi"), "repair-turns")))


def repair_damaged(conversations: DataFrame, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """``repair`` of the damaged rows, with a row for every conversation there was before the damage."""
    found = repair(damaged(conversations), local_turns)
    ids = conversations.select("conv_id").distinct()
    zeros = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", *COUNTS, "cost")]
    return ids.alias("i").join(found.alias("f"), F.col("i.conv_id").eqNullSafe(F.col("f.conv_id")), "left").select(
        F.col("i.conv_id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op13_grammar_alignment_repair(spark, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


# The twin walks the grammar's states turn by turn instead of aligning to target lengths.
OP13_SQL = r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
drawn AS (
  SELECT *, xor(4294967295, list_reduce(list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT),
    lambda crc, b: list_reduce(range(8), lambda r, k: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END,
                               xor(crc, b)), 4294967295)) % 20 AS draw
  FROM given),
damaged AS (
  SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM drawn, (SELECT unnest([1, 2]) AS copy) WHERE draw <> 0 AND (copy = 1 OR draw = 3)),
numbered AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), '') AS conv,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final
  FROM damaged),
marked AS (
  SELECT *, substr(role, 1, 1) AS r,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen, CASE WHEN final = '' THEN 'b' WHEN seen THEN 'd'
    WHEN final NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    coalesce(lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1)
      NOT IN ('su', 'ua', 'au'), FALSE) AS bad
  FROM numbered),
counted AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS turns,
         count_if(fault = 'b') AS blank, count_if(fault = 'd') AS duplicate, count_if(fault = 't') AS truncated,
         count_if(bad) AS illegal
  FROM marked GROUP BY conv),
walk AS (
  SELECT conv, 0::BIGINT AS i, {'c': 0::BIGINT, 'e': ''} AS n, {'c': 1000000000000::BIGINT, 'e': ''} AS s,
         {'c': 1000000000000::BIGINT, 'e': ''} AS u, {'c': 1000000000000::BIGINT, 'e': ''} AS a
  FROM counted
  UNION ALL
  SELECT conv, i, {'c': n.c + 2, 'e': n.e || 'D'},
    CASE WHEN r = 's' AND NOT gone THEN least({'c': s.c + 2, 'e': s.e || 'D'}, {'c': n.c + late, 'e': n.e || 'K'})
         ELSE {'c': s.c + 2, 'e': s.e || 'D'} END,
    CASE WHEN gone THEN {'c': ui.c + 2, 'e': ui.e || 'D'}
         ELSE least({'c': ui.c + 2, 'e': ui.e || 'D'},
                    {'c': n.c + late + (r <> 'u')::BIGINT, 'e': n.e || CASE r WHEN 'u' THEN 'K' ELSE 'R' END},
                    {'c': s.c + late + (r <> 'u')::BIGINT, 'e': s.e || CASE r WHEN 'u' THEN 'K' ELSE 'R' END},
                    {'c': ai.c + late + (r <> 'u')::BIGINT, 'e': ai.e || CASE r WHEN 'u' THEN 'K' ELSE 'R' END}) END,
    CASE WHEN gone THEN {'c': ai.c + 2, 'e': ai.e || 'D'}
         ELSE least({'c': ai.c + 2, 'e': ai.e || 'D'},
                    {'c': ui.c + late + (r <> 'a')::BIGINT, 'e': ui.e || CASE r WHEN 'a' THEN 'K' ELSE 'R' END}) END
  FROM (
    SELECT *, least(a, {'c': ui.c + 5, 'e': ui.e || 'I'}) AS ai FROM (
      SELECT w.conv, m.i, w.n, w.s, w.a, m.r, m.fault IN ('b', 'd') AS gone,
             CASE m.fault WHEN 't' THEN 5::BIGINT ELSE 0::BIGINT END AS late,
             least(w.u, {'c': w.n.c + 5, 'e': w.n.e || 'I'}, {'c': w.s.c + 5, 'e': w.s.e || 'I'},
                   {'c': w.a.c + 5, 'e': w.a.e || 'I'}) AS ui
      FROM walk w JOIN marked m ON m.conv = w.conv AND m.i = w.i + 1) x) y),
ended AS (
  SELECT conv, least(n, a, {'c': u.c + 5, 'e': u.e || 'I'}, {'c': s.c + 10, 'e': s.e || 'II'}) AS best
  FROM walk JOIN counted USING (conv) WHERE i = turns),
edits AS (
  SELECT conv, p, e, sum((e <> 'I')::BIGINT) OVER upto AS i, sum((e <> 'D')::BIGINT) OVER upto AS o,
         sum((e <> 'D')::BIGINT) OVER (PARTITION BY conv) AS made
  FROM (SELECT conv, unnest(string_split(best.e, '')) AS e, generate_subscripts(string_split(best.e, ''), 1) AS p
        FROM ended WHERE best.e <> '')
  WINDOW upto AS (PARTITION BY conv ORDER BY p ROWS UNBOUNDED PRECEDING)),
repaired AS (
  SELECT d.conv, string_agg(CASE WHEN d.e = 'K' THEN m.role WHEN (d.made - d.o) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN d.e = 'I' THEN '' ELSE m.text END, chr(10) ORDER BY d.p) AS whole
  FROM edits d JOIN marked m ON m.conv = d.conv AND m.i = greatest(d.i, 1) WHERE d.e <> 'D' GROUP BY d.conv)
SELECT g.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
       coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
       coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.best.c, 0)::BIGINT AS cost, coalesce(e.best.e, '') AS audit,
       sha256(coalesce(p.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS conv FROM conversations) g
LEFT JOIN counted c USING (conv) LEFT JOIN ended e USING (conv) LEFT JOIN repaired p USING (conv)
"""
