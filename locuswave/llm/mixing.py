"""Mixing sources to target weights: hash-random keys, key ranges, prefix sums, exact cuts.

Method.  Every document gets a hash-random key.  The keys of a source are cut into 4,096 equal ranges, which random
keys fill evenly, so the ranges stand for a range-partitioned sort without a sampling pass.  Each range is sorted by
key and summed; the ranges' sums give every range its offset within the source, and offset plus the running sum inside
the range is a document's place on the source's word axis.  The source's budget cuts that axis at one exact word.
A budget above the source's size repeats the source: all whole readings count for every document, and only the last
reading is cut, in key order.

Targets.  Weights go to the sources by code point of the name, NULL last, cyclically.  A source gets at most
``max_epochs`` times its size; what is above that is shared again by weight until none is above (a loop over the table
of sources; only sums come to the driver).

Scale.  One map-side aggregation for the ranges' sums and one shuffle on (source, range) for the sort.  A source with a
third of all rows is spread over its 4,096 ranges.  Texts travel only if the caller selects them.

Defined cases.  NULL text or a text without words: size 0, nothing taken.  NULL source: a source of its own, the last.
NULL or repeated doc_id: rows are documents; the key also depends on the text, so equal keys mean equal rows up to other
columns, and of such rows any is the cut one.  Columns of other names pass through; ``size``, ``source_size``,
``target``, ``epochs`` and ``last_words`` replace columns of these names.  No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuswave.llm.common import spaced, table, words_of
from locuswave.operators.ranking import ordinal
from locuswave.session import stage

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = "mix"
# Leading hexadecimal digits of a key that name its range.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.size(words_of(spaced(text))).cast("long")


def source_name(source: Column) -> Column:
    """A name that is never NULL: groups and joins on it need no null-safe comparison."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
            total: float | None = None) -> DataFrame:
    """(_source, source_size, target) for ``sizes`` (_source, source_size); ``total`` words, default all sizes."""
    # The empty name stands for NULL and goes last.
    ranked = ordinal(sizes.withColumn("_none", F.lit(0)), ["_none"], [F.col("_source") == "", F.col("_source")], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    limit = F.lit(float(max_epochs)) * F.col("source_size")
    state = stage(ranked.select("_source", "source_size", weight.alias("_weight"), limit.alias("_limit")), "mix-sources")
    size = state.agg(F.sum("source_size"), F.sum("_limit")).first()
    wanted = min(float(size[0] or 0) if total is None else float(total), float(size[1] or 0.0))
    share, capped = 0.0, -1
    # Each round some source reaches its limit, or the loop ends.
    while True:
        full = F.col("_limit") < F.lit(share) * F.col("_weight")
        seen = state.agg(F.count_if(full), F.sum(F.when(full, F.col("_limit"))), F.sum(F.when(~full, F.col("_weight")))).first()
        if seen[0] == capped or not seen[2]:
            break
        capped, share = seen[0], (wanted - (seen[1] or 0.0)) / seen[2]
    return state.select("_source", "source_size", F.least("_limit", F.lit(share) * F.col("_weight")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, total: float | None = None,
        seed: str = SEED, source: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs`` with size, source_size, target, epochs and last_words.

    A document is read ``epochs`` times in full, and then its first ``last_words`` words once more.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "epochs", "last_words")]
    random = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    sized = docs.select(*own, source_name(F.col(source)).alias("_source"), word_count(F.col(text)).alias("size"),
                        random.alias("_key")).withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))
    ranges = stage(sized.groupBy("_source", "_range").agg(F.sum("size").alias("_words")), "mix-ranges")
    budgets = targets(ranges.groupBy("_source").agg(F.sum("_words").alias("source_size")), weights, max_epochs, total)
    # At most 4,096 ranges per source.
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).join(budgets, "_source")
    inside = Window.partitionBy("_source", "_range").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, ["_source", "_range"])
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target + 0.5) as bigint) div source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("_before") - F.col("_inside")
    return placed.select(
        *own, "size", "source_size", "target", epochs.cast("long").alias("epochs"),
        F.greatest(F.lit(0), F.least(rest, F.col("size"))).cast("long").alias("last_words"))


def readings(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: one row per reading of a document, ``epoch`` from 0, the last one cut at its word.

    A cut text ends with its last taken word; whole readings keep their text byte for byte.
    """
    spare = (F.col("last_words") > 0).cast("long")
    each = mixed.filter("epochs > 0 or last_words > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") + spare - 1)))
    # End of the last taken word: pieces between blanks, of which the empty ones are no words.
    pieces = F.split(spaced(F.col(text)), " ", -1)
    state = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("at"), F.lit(0).alias("stop"))

    def step(s: Column, piece: Column) -> Column:
        words, stop = s["words"] + (piece != "").cast("long"), s["at"] + F.length(piece)
        return F.struct(words.alias("words"), (stop + 1).alias("at"), F.when(
            (piece != "") & (words == F.col("last_words")), stop).otherwise(s["stop"]).alias("stop"))

    cut = F.substring(F.col(text), F.lit(1), F.aggregate(pieces, state, step, lambda s: s["stop"]))
    whole = (F.col("epoch") < F.col("epochs")) | (F.col("last_words") == F.col("size"))
    return each.select(
        *[c for c in mixed.columns if c not in (text, "epochs", "last_words")], "epoch",
        F.when(whole, F.col(text)).otherwise(cut).alias(text),
        F.when(whole, F.col("size")).otherwise(F.col("last_words")).alias("words"))


def op11_prefix_cut_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    taken = F.col("epochs") * F.col("size") + F.col("last_words")
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), taken.alias("taken"))


OP11_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix' || coalesce(':' || doc_id, '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS most,
         [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sources),
filling AS (  -- sources by the share of weight at which they are full; those before are full
  SELECT *, most / weight AS level,
         ((SELECT sum(source_size) FROM sources) - coalesce(sum(most) OVER earlier, 0))
         / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER earlier, 0)) AS share
  FROM weighed WINDOW earlier AS (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
budgets AS (
  SELECT source, source_size, least(most, weight * (SELECT share FROM filling WHERE share <= level ORDER BY level, source LIMIT 1)) AS target FROM filling),
placed AS (
  SELECT s.*, b.source_size, b.target, CAST(floor(b.target + 0.5) AS BIGINT) AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE
         budget // source_size * size + greatest(0, least(budget % source_size - before, size)) END AS BIGINT) AS taken
FROM placed
"""
