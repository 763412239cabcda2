"""Benchmark decontamination by template windows.

Texts become templates: numbers, units behind numbers and names turn into typed slots, all other words are
literals in lower case.  Runs of ``WINDOW`` template words of the documents are hash-joined with those of the
benchmark items.  Windows that hold slots count only if the values agree along the alignment: one item value
stands for one document value and the other way round, so a question with new numbers or names is found and a
text that merely has numbers in the same places is not.

Defined cases: NULL and empty texts have no windows; items of fewer than ``WINDOW`` words or with windows of
fewer than ``MIN_LITERALS`` literal words are not searched by those windows.  Repeated items and documents are
reported under their ids, equal (doc_id, item_id) pairs once.  Other columns are ignored.

``leaks`` is the rule of op2 and its SQL twin.  It loses edited and partial items, so the pipeline's stage drops
what ``passages`` finds, too: shared windows only propose alignments there.  An alignment is then compared word by
word, and an item is leaked by a run of ``RUN`` agreeing words (its whole length if shorter), or when runs of
``MIN_RUN`` words or more cover half of its words; items of under 16 words need up to ``WINDOW`` covered words.
Within a run a repeated name stands for one name; numbers may coincide or differ.  A clash parts the run only.
A number with its separators and a run of names are one slot each, and where slots are dense windows get longer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswave.llm.common import table, window_hashes
from locuswave.session import bounded_side, stage

WINDOW = 8
MIN_LITERALS = 4
# An item is leaked when this share of its windows is found along consistent alignments.
MIN_COVERAGE = 0.5
# Passages: the long run, the shortest run that covers, and the windows of items so short that a few edits break all
# of the longer ones.
RUN, MIN_RUN = 13, 4
SHORT_WINDOW, SHORT_ITEM = 5, 24
# Item windows up to this many rows (about 40 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000

# Units that may stand behind a number.
UNITS = ("kg g mg lb lbs oz km m cm mm mi ft in l ml h hr hrs min s sec ms hours hour minutes minute seconds days day "
         "weeks week months month years year percent usd eur gbp dollars euros cents kwh kw w v a hz mb gb tb").split()

NAME_MARK, UNIT_MARK, JOIN_MARK = "\x01", "\x02", "\x03"
NAME, NUMBER, UNIT = "<name>", "<num>", "<unit>"


def with_template(df: DataFrame, whole: bool = False) -> DataFrame:
    """Adds ``_tokens`` (words with their marks) and ``_ids`` (hash per template word).

    With ``whole``, a number with its separators is one token, as is a run of names between blanks.
    """
    marked = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "[\\x01\\x02\\x03]" if whole else "[\\x01\\x02]", " ")
    if whole:
        marked = F.regexp_replace(marked, "[.,:/'\u2019\u00a0\u202f](?<=[0-9].)(?=[0-9])", JOIN_MARK)
    # A capital inside a sentence starts a name; at its beginning every word has one.
    marked = F.regexp_replace(marked, "([\\p{Ll}\\p{N},;] )(\\p{Lu})", f"$1{NAME_MARK}$2")
    if whole:
        # Parts of a name ("O'Brien", "Smith-Jones") keep together, and names with nothing but a blank between.
        marked = F.regexp_replace(
            marked, f"['\u2019-](?<={NAME_MARK}[\\p{{L}}\\p{{N}}'\u2019-]{{1,60}})(?=\\p{{Lu}})", JOIN_MARK)
        marked = F.regexp_replace(
            marked, f" {NAME_MARK}(?<={NAME_MARK}[\\p{{L}}\\p{{N}}{JOIN_MARK}]{{1,80}} {NAME_MARK})", JOIN_MARK)
    marked = F.regexp_replace(
        F.lower(marked), f"([0-9] ?)({'|'.join(UNITS)})([^\\p{{L}}\\p{{N}}]|$)", f"$1 {UNIT_MARK}$2$3")
    tokens = F.split(F.regexp_replace(
        marked, "[^\\p{L}\\p{N}\\x01\\x02" + ("\\x03" if whole else "") + "]+", " "), " ")
    df = df.withColumn("_tokens", F.filter(tokens, lambda w: ~w.isin("", NAME_MARK, UNIT_MARK)))
    # In string order "\x01" and "\x02" come first, then the digits up to ":", then all letters.
    return df.withColumn("_ids", F.transform("_tokens", lambda w: F.when(w >= ":", F.xxhash64(w)).otherwise(
        F.xxhash64(_slot_type(w)))))


def _slot_type(w: Column) -> Column:
    return F.when(w >= "0", NUMBER).when(w >= UNIT_MARK, UNIT).otherwise(NAME)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """h, item_id, ipos, slots (of the window), n_windows (of the item)."""
    items = with_template(benchmark.filter("item_id is not null").select("item_id", "text").distinct())
    items = items.withColumn("_h", window_hashes(F.col("_ids"), WINDOW))
    each = (items.select("item_id", "_tokens", F.posexplode_outer("_h").alias("ipos", "h")).filter("h is not null")
            .withColumn("_w", F.slice("_tokens", F.col("ipos") + 1, WINDOW))
            .withColumn("slots", F.size(F.filter("_w", lambda w: w < ":")))
            .filter(F.col("slots") <= WINDOW - MIN_LITERALS))
    counts = each.groupBy("item_id").agg(F.count_distinct("ipos").cast("long").alias("n_windows"))
    return each.select("h", "item_id", "ipos", "slots").distinct().join(counts, "item_id")


def _slot_values(hits: DataFrame, side: DataFrame, key: str, at: str, name: str) -> DataFrame:
    """Adds the words of ``side`` under each slot position of an alignment as an array ``name``."""
    tokens = with_template(side.select(key, "text")).select(key, "_tokens")
    return (hits.join(tokens, key)
            .withColumn(name, F.transform("places", lambda p: F.get(F.col("_tokens"), p + F.col(at))))
            .drop("_tokens"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched and n_windows of the item, slots, for each leaked item (see the module)."""
    side = stage(item_windows(benchmark), "item-windows")
    lookup = F.broadcast(side) if side.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS else side
    # The outer form: the plain one adds a filter on the array, which would compute every window twice.
    doc_windows = (with_template(docs.select("doc_id", "text"))
                   .withColumn("_h", window_hashes(F.col("_ids"), WINDOW))
                   .select("doc_id", F.posexplode_outer("_h").alias("pos", "h")))
    # The windows of one alignment (document position minus item position), at most as many as the item has.
    lines = stage(
        doc_windows.join(lookup, "h")
        .groupBy("doc_id", "item_id", "n_windows", (F.col("pos") - F.col("ipos")).alias("shift"))
        .agg(F.collect_set(F.when(F.col("slots") == 0, F.col("ipos"))).alias("literal"),
             F.collect_set(F.when(F.col("slots") > 0, F.col("ipos"))).alias("slotted")), "alignments")
    plain = lines.select("doc_id", "item_id", "n_windows", "shift", "literal",
                         F.array().cast("array<int>").alias("agreed"))
    asked = (lines.filter(F.size("slotted") > 0)
             .select("doc_id", "item_id", "n_windows", "shift", "slotted", F.lit(0).alias("zero"))
             .withColumn("places", F.array_distinct(F.flatten(F.transform(
                 "slotted", lambda p: F.sequence(p, p + WINDOW - 1))))))
    # The few alignments with slots go back to the texts for the values.
    asked = _slot_values(asked, docs, "doc_id", "shift", "_theirs")
    asked = _slot_values(asked, benchmark.filter("item_id is not null"), "item_id", "zero", "_ours")
    pairs = F.array_distinct(F.filter(
        F.arrays_zip("_ours", "_theirs"), lambda p: p["_ours"] < ":"))
    asked = asked.withColumn("_pairs", pairs)
    agree = ((F.size("_pairs") == F.size(F.array_distinct(F.col("_pairs._ours"))))
             & (F.size("_pairs") == F.size(F.array_distinct(F.col("_pairs._theirs")))))
    agreed = asked.filter(agree).select(
        "doc_id", "item_id", "n_windows", "shift", F.array().cast("array<int>").alias("literal"),
        F.col("slotted").alias("agreed"))
    found = (plain.unionByName(agreed).groupBy("doc_id", "item_id", "n_windows").agg(
        F.array_distinct(F.flatten(F.collect_list("literal"))).alias("literal"),
        F.array_distinct(F.flatten(F.collect_list("agreed"))).alias("agreed")))
    return (found.select("doc_id", "item_id", (F.size("literal") + F.size("agreed")).cast("long").alias("matched"),
                         "n_windows", F.size("agreed").cast("long").alias("slotted"))
            .filter(F.col("matched") >= MIN_COVERAGE * F.col("n_windows")))


def _with_dense(df: DataFrame) -> DataFrame:
    """Adds ``_dense``: (pos, h) of the runs from a literal to the ``MIN_LITERALS``th that are longer than a window."""
    at = F.filter(F.transform("_tokens", lambda w, i: F.when(w >= ":", i)), lambda i: i.isNotNull())
    df = df.withColumn("_at", at)
    df = df.withColumn("_spans", F.filter(
        F.transform("_at", lambda p, k: F.struct(p.alias("lo"), F.get(F.col("_at"), k + (MIN_LITERALS - 1)).alias("hi"))),
        lambda s: s["hi"] - s["lo"] >= WINDOW))
    return df.withColumn("_dense", F.transform("_spans", lambda s: F.struct(s["lo"].alias("pos"), F.xxhash64(
        F.slice("_ids", s["lo"] + 1, s["hi"] - s["lo"] + 1)).alias("h")))).drop("_at", "_spans")


def _seeds(short: Column) -> Column:
    """(pos, h) of the windows of ``_ids``, of those of ``SHORT_WINDOW`` words where ``short`` holds, and ``_dense``."""
    def placed(width: int) -> Column:
        return F.transform(window_hashes(F.col("_ids"), width), lambda h, p: F.struct(p.alias("pos"), h.alias("h")))

    return F.concat(placed(WINDOW), F.when(short, placed(SHORT_WINDOW)).otherwise(
        F.array().cast("array<struct<pos:int,h:bigint>>")), "_dense")


def _item_seeds(items: DataFrame) -> DataFrame:
    """h, item_id, irow, ipos: the windows of each item text that hold ``MIN_LITERALS`` literals, and the dense runs."""
    seeds = items.withColumn("_literal", F.transform("_tokens", lambda w: (w >= ":").cast("int")))
    seeds = seeds.select("item_id", "irow", "_ids", "_literal", F.size("_ids").alias("n"))
    wide = (seeds.select("item_id", "irow", "_literal", F.posexplode(window_hashes(F.col("_ids"), WINDOW)).alias("ipos", "h"))
            .withColumn("width", F.lit(WINDOW)))
    narrow = (seeds.filter(F.col("n") < SHORT_ITEM)
              .select("item_id", "irow", "_literal", F.posexplode(window_hashes(F.col("_ids"), SHORT_WINDOW)).alias("ipos", "h"))
              .withColumn("width", F.lit(SHORT_WINDOW)))
    literals = F.aggregate(F.slice("_literal", F.col("ipos") + 1, F.col("width")), F.lit(0), lambda n, x: n + x)
    plain = wide.unionByName(narrow).filter(literals >= MIN_LITERALS).select("h", "item_id", "irow", "ipos")
    dense = _with_dense(items).select("item_id", "irow", F.explode("_dense").alias("s")).select(
        F.col("s.h").alias("h"), "item_id", "irow", F.col("s.pos").alias("ipos"))
    return plain.unionByName(dense).distinct()


def _runs(words: Column) -> Column:
    """lo, hi of the longest stretches of at least ``MIN_RUN`` words that agree and hold no clash, of (ok, clash)."""
    def step(state: Column, w: Column) -> Column:
        at, start = state["at"], state["start"]
        clash = w["clash"] >= start
        ends = (~w["ok"] | clash) & (at - start >= MIN_RUN)
        return F.struct(
            (at + 1).alias("at"), F.when(~w["ok"], at + 1).when(clash, w["clash"] + 1).otherwise(start).alias("start"),
            F.when(ends, F.array_append(state["runs"], F.struct(start.alias("lo"), (at - 1).alias("hi")))).otherwise(
                state["runs"]).alias("runs"))

    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("start"),
                     F.array().cast("array<struct<lo:int,hi:int>>").alias("runs"))
    return F.aggregate(words, begin, step, lambda s: s["runs"])


def _agreeing(lines: DataFrame) -> DataFrame:
    """Adds ``_words``: ok and clash of each item word along the alignment, and an end that is not ok.

    A slot agrees with any slot of its type.  ``clash`` is the place of the last equal name before that stands for
    another name (-1 without one); numbers and units may coincide or differ between their roles.
    """
    lines = lines.withColumn("_pairs", F.transform("_ours", lambda w, i: F.struct(
        i.alias("at"), w.alias("w"), F.get(F.col("_theirs"), i + F.col("shift")).alias("t"))))
    lines = lines.withColumn("_names", F.filter("_pairs", lambda p: (p["w"] < UNIT_MARK) & (p["t"] < UNIT_MARK)))

    def last_clash(p: Column) -> Column:
        other = F.filter("_names", lambda q: (q["at"] < p["at"]) & (q["w"] == p["w"]) & (q["t"] != p["t"]))
        return F.when(p["w"] < UNIT_MARK, F.array_max(F.transform(other, lambda q: q["at"])))

    return lines.withColumn("_words", F.concat(
        F.transform("_pairs", lambda p: F.struct(
            F.coalesce(F.when(p["w"] >= ":", p["w"] == p["t"]).otherwise(
                (p["t"] < ":") & (_slot_type(p["w"]) == _slot_type(p["t"]))), F.lit(False)).alias("ok"),
            F.coalesce(last_clash(p), F.lit(-1)).alias("clash"))),
        F.array(F.struct(F.lit(False).alias("ok"), F.lit(-1).alias("clash")))))


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_words (of the item), covered, longest (words in runs, in one run) of each leaked item."""
    # An item is long enough by its plain words: whole slots make it shorter.
    items = with_template(benchmark.filter("item_id is not null").select("item_id", "text").distinct())
    items = with_template(items.filter(F.size("_ids") >= WINDOW), whole=True)
    items = stage(items.filter(F.size("_ids") >= SHORT_WINDOW).select(
        "item_id", F.xxhash64("item_id", "text").alias("irow"), "_tokens", "_ids"), "items")
    seeds = bounded_side(stage(_item_seeds(items), "item-seeds"), BROADCAST_WINDOWS)
    short = F.lit(bool(items.filter(F.size("_ids") < SHORT_ITEM).limit(1).count()))
    # A NULL or repeated doc_id has several texts; each is aligned by itself.
    texts = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("drow"), "text")
    found = (_with_dense(with_template(texts, whole=True)).select("drow", F.explode_outer(_seeds(short)).alias("s"))
             .select("drow", F.col("s.pos").alias("pos"), F.col("s.h").alias("h")))
    lines = stage(found.join(seeds, "h").select("drow", "irow", (F.col("pos") - F.col("ipos")).alias("shift")).distinct(),
                  "passage-alignments")
    near = bounded_side(stage(lines.select("drow").distinct(), "passage-documents"))
    theirs = with_template(texts.join(near, "drow", "left_semi").distinct(), whole=True).select(
        "doc_id", "drow", F.col("_tokens").alias("_theirs"))
    ours = items.select("item_id", "irow", F.col("_tokens").alias("_ours"))
    lines = _agreeing(lines.join(theirs, "drow").join(ours, "irow"))
    runs = lines.select("doc_id", "drow", "item_id", "irow", "_ours", F.explode(_runs(F.col("_words"))).alias("run"))
    runs = runs.select(
        "doc_id", "drow", "item_id", "irow", F.size("_ours").alias("n_words"),
        F.transform(F.sequence("run.lo", "run.hi"), lambda p: F.struct(
            p.alias("at"), (F.get("_ours", p) >= ":").alias("literal"))).alias("places"))
    literals = F.size(F.filter("places", lambda p: p["literal"]))
    total = runs.groupBy("doc_id", "drow", "item_id", "irow", "n_words").agg(
        F.max(F.when(literals >= MIN_LITERALS, F.size("places"))).alias("longest"),
        F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"))
    n, covered = F.col("n_words"), F.size("places")
    needed = F.greatest(n * MIN_COVERAGE, F.least(F.lit(WINDOW), n * 0.75))
    leaked = (F.col("longest") >= F.least(F.lit(RUN), n)) | ((covered >= needed) & (literals >= MIN_LITERALS))
    return total.filter(leaked).groupBy("doc_id", "item_id").agg(
        F.max(F.struct(covered.alias("covered"), F.coalesce("longest", F.lit(0)).alias("longest"), "n_words")).alias("m")
    ).select("doc_id", "item_id", "m.n_words", "m.covered", "m.longest")


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no leaked item, judged row by row: ids may be NULL or repeated."""
    own = F.xxhash64("doc_id", "text")
    rows = docs.select(own.alias("doc_id"), "text")
    found = leaks(rows, benchmark).select("doc_id").unionByName(passages(rows, benchmark).select("doc_id"))
    hit = stage(found.select(F.col("doc_id").alias("_hit")).distinct(), "leaked")
    return docs.join(bounded_side(hit, BROADCAST_WINDOWS), own == F.col("_hit"), "left_anti")


def op2_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT DISTINCT 'b', item_id, text FROM benchmark WHERE item_id IS NOT NULL),
m AS (
  SELECT kind, id, row_number() OVER () AS rid, regexp_replace(lower(regexp_replace(
    regexp_replace(coalesce(text, ''), '[\x01\x02]', ' ', 'g'), '([\p{Ll}\p{N},;] )(\p{Lu})', '\1' || chr(1) || '\2', 'g')),
    '([0-9] ?)(UNITS)([^\p{L}\p{N}]|$)', '\1 ' || chr(2) || '\2\3', 'g') AS marked FROM t),
k AS (
  SELECT kind, id, rid, list_filter(string_split(regexp_replace(marked, '[^\p{L}\p{N}\x01\x02]+', ' ', 'g'), ' '),
                                    lambda w: w NOT IN ('', chr(1), chr(2))) AS w FROM m),
c AS (
  SELECT kind, id, rid, w, list_transform(w, lambda x: CASE WHEN x >= ':' THEN x WHEN x >= '0' THEN '<num>'
                                          WHEN x >= chr(2) THEN '<unit>' ELSE '<name>' END) AS c FROM k),
win AS (
  SELECT kind, id, rid, p - 1 AS p, c[p:p + 7] AS win, len(list_filter(w[p:p + 7], lambda x: x < ':')) AS slots
  FROM (SELECT kind, id, rid, w, c, unnest(range(1, greatest(len(c) - 6, 1))) AS p FROM c)),
items AS (SELECT *, count(DISTINCT p) OVER (PARTITION BY id) AS n_windows FROM win WHERE kind = 'b' AND slots <= 4),
hits AS (
  SELECT d.id AS doc_id, d.rid AS drid, b.id AS item_id, b.rid AS irid, b.n_windows, b.p, d.p - b.p AS shift, b.slots
  FROM win d JOIN items b ON d.win = b.win WHERE d.kind = 'd'),
vals AS (
  SELECT DISTINCT doc_id, item_id, shift, w.w[p + o + 1] AS ours, v.w[p + o + shift + 1] AS theirs
  FROM (SELECT *, unnest(range(8)) AS o FROM hits WHERE slots > 0) h
  JOIN c w ON w.rid = h.irid JOIN c v ON v.rid = h.drid),
agree AS (
  SELECT doc_id, item_id, shift FROM vals WHERE ours < ':' GROUP BY ALL
  HAVING count(*) = count(DISTINCT ours) AND count(*) = count(DISTINCT theirs))
SELECT doc_id, item_id, count(DISTINCT p) AS matched, n_windows, count(DISTINCT p) FILTER (slots > 0) AS slotted
FROM hits LEFT JOIN agree USING (doc_id, item_id, shift)
WHERE slots = 0 OR agree.doc_id IS NOT NULL
GROUP BY doc_id, item_id, n_windows HAVING count(DISTINCT p) >= 0.5 * n_windows
""".replace("UNITS", "|".join(UNITS))
