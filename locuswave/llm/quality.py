"""Quality rules as a bitmask ledger: every rule is evaluated once, policies are masks over the stored bits.

Null text counts as an empty text.  Null or repeated ``doc_id`` rows are kept as they are: every input
row gives one ledger row.  Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswave.llm.common import spaced, table, tail, window_hashes, without, words_of

REPEAT_WINDOW = 5
SYMBOLS = "#*$%&|<>"


def rules() -> list[tuple[str, Column]]:
    """Rule name and its condition of failure over the measurements; the position is the bit."""
    c = F.col
    return [
        ("few_words", c("n_words") < 10),
        ("repeated_windows", 100 * c("n_repeat_words") > 20 * c("n_words")),
        ("symbols", 10 * c("n_symbols") > c("n_words")),
        ("duplicate_lines", 10 * c("n_dup_lines") > 3 * c("n_lines")),
        ("short_words", 2 * c("word_chars") < 3 * c("n_words")),
        ("long_words", c("word_chars") > 20 * c("n_words")),
        ("single_characters", 5 * c("n_single_words") > 2 * c("n_words")),
        ("bullets", 10 * c("n_bullet_lines") > 9 * c("n_lines")),
        ("ellipses", 10 * c("n_ellipsis_lines") > 3 * c("n_lines")),
        ("few_distinct", (c("n_words") >= 50) & (20 * c("n_distinct_words") < c("n_words"))),
    ]


RULE_NAMES = tuple(
    "few_words repeated_windows symbols duplicate_lines short_words long_words single_characters bullets ellipses few_distinct"
    .split())
BIT = {name: 1 << k for k, name in enumerate(RULE_NAMES)}


@dataclass(frozen=True)
class Policy:
    """A version of the policy: the rules whose failure rejects a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = ("few_words", "repeated_windows")
POLICIES = {
    "base": Policy("base", BASE),
    "v1": Policy("v1", (*BASE, "symbols", "duplicate_lines")),
    "v2": Policy("v2", RULE_NAMES),
}
PRODUCTION = "v2"


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each whole text (all long).

    ``n_repeat_words`` counts the words that lie in a window of five words found at least twice in
    the text.  Window hashes are compared, not texts; only documents that hold an equal pair at all
    sort their windows, so the usual document costs one hash set.
    """
    df = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    df = df.withColumn("_spaced", spaced(F.col("_text"))).withColumn("_words", words_of(F.col("_spaced")))
    df = df.withColumn("_lines", F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    # Equal lines and words are found among 64-bit hashes: a set of numbers, not of texts.
    df = (df.withColumn("_line_ids", F.transform(F.col("_lines"), lambda x: F.xxhash64(x)))
          .withColumn("_word_ids", F.transform(F.col("_words"), lambda x: F.xxhash64(x))))
    df = df.withColumn("_windows", window_hashes(F.col("_word_ids"), REPEAT_WINDOW))
    # Sorted (hash, place); neighbours with one hash give the places of repeated windows.
    placed = F.sort_array(F.transform(F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_placed", F.when(
        F.size(F.array_distinct(F.col("_windows"))) < F.size(F.col("_windows")), placed))
    twice = F.flatten(F.zip_with(
        F.col("_placed"), tail(F.col("_placed"), 2),
        lambda a, b: F.when(a["h"].eqNullSafe(b["h"]), F.array(a["i"], b["i"])).otherwise(
            F.array().cast("array<int>"))))
    df = df.withColumn("_starts", F.sort_array(F.array_distinct(twice)))
    # Each window covers its five words, but only up to the next window; the last one covers all five.
    covered = F.aggregate(
        F.zip_with(F.col("_starts"), tail(F.col("_starts"), 2), lambda a, b: F.least(F.lit(REPEAT_WINDOW), b - a)),
        F.lit(0).cast("long"), lambda total, n: total + n)
    text, words, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    return df.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.replace(F.col("_spaced"), F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(F.col("_line_ids")))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(words, lambda w: F.length(w) == 1)).cast("long").alias("n_single_words"),
        F.size(F.filter(lines, lambda x: x.rlike("^\\s*[-*\\u2022]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(lines, lambda x: x.rlike("(\\.\\.\\.|\\u2026)\\s*$"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.array_distinct(F.col("_word_ids"))).cast("long").alias("n_distinct_words"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and ``fail_bits``: bit k is set when rule k of ``RULE_NAMES`` fails."""
    bits = F.lit(0).cast("long")
    for name, failed in rules():
        bits = bits.bitwiseOR(F.when(failed, F.lit(BIT[name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs).withColumn("fail_bits", bits)


def apply_policy(of: DataFrame, policy: Policy) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` (no rule of the policy failed, nor a base rule)."""
    base = F.col("fail_bits").bitwiseAND(F.lit(POLICIES["base"].mask)) != 0
    return (of.withColumn("base_failed", base)
            .withColumn("kept", ~base & (F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0)))


def ablation(of: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents it rejects, rejects alone, and what the rest still rejects.

    One map-side count per failure pattern; a pattern is a small number, so nothing else is shuffled.
    """
    patterns = (of.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits"))
                .agg(F.count(F.lit(1)).alias("n")))
    named = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules]))
    each = patterns.select("bits", "n", named.alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")
    return each.groupBy("rule").agg(
        count(hit).alias("rejected"), count(F.col("bits") == F.col("bit")).alias("rejected_alone"),
        count(rest != 0).alias("rejected_without"))


def quality_ledger(docs: DataFrame, version: str = PRODUCTION) -> DataFrame:
    return apply_policy(ledger(docs), POLICIES[version])


def op9_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "fail_bits")


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT rid, i, hash(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS h
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM d)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, h) AS n FROM win) WHERE n > 1),
cover AS (
  SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words,
         len(lines) AS n_lines, len(list_filter(w, lambda x: length(x) = 1)) AS n_single,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*\x{2022}]'))) AS n_bullet,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})\s*$'))) AS n_ellipsis,
         len(list_distinct(w)) AS n_distinct
  FROM d LEFT JOIN cover ON d.rid = cover.rid),
b AS (
  SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
    + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (10 * n_dup_lines > 3 * n_lines)::BIGINT
    + 16 * (2 * word_chars < 3 * n_words)::BIGINT + 32 * (word_chars > 20 * n_words)::BIGINT
    + 64 * (5 * n_single > 2 * n_words)::BIGINT + 128 * (10 * n_bullet > 9 * n_lines)::BIGINT
    + 256 * (10 * n_ellipsis > 3 * n_lines)::BIGINT + 512 * (n_words >= 50 AND 20 * n_distinct < n_words)::BIGINT AS f
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (f & 3) <> 0 AS base_failed, f = 0 AS kept, f::BIGINT AS fail_bits
FROM b
"""
