"""SQL twins of the queries, for DuckDB on the same tables.

Where it is affordable they take another road than the Spark operators: window sums by expanding
every read to the positions of its window, p-values by counting, chromosomes as one window.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def define(name: str, *ctes: str, select: str) -> None:
    body = ",\n".join(ctes)
    ORACLES[name] = f"WITH {body}\n{select}" if body else select


# -- shared pieces -----------------------------------------------------------------------------

READS = """reads AS (
  SELECT CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 64 ELSE 256 END AS conc,
         'chr' || (l_suppkey % 4) AS chrom, l_linenumber % 3 + 1 AS rep,
         CASE WHEN l_returnflag <> 'R' AND l_partkey % 10 = 0
              THEN (l_orderkey - l_orderkey % 500) * 7 + l_partkey % 3
              ELSE l_orderkey * 7 + l_partkey % 3 END AS pos
  FROM lineitem)"""

COUNTS = READS + """,
counts AS (
  SELECT conc, chrom, pos, count(*) FILTER (rep = 1) AS v1, count(*) FILTER (rep = 2) AS v2,
         count(*) FILTER (rep = 3) AS v3
  FROM reads GROUP BY ALL)"""

CTRL = "ctrl AS (SELECT * FROM counts WHERE conc = 0)"


def expanded(name: str, source: str, w: int, clip: bool = False) -> str:
    """Value at every position, by expanding each count to its window."""
    agg = "greatest(sum(v{0}), 0)::BIGINT" if clip else "sum(v{0})::BIGINT"
    cols = ", ".join(f"{agg.format(k)} AS v{k}" for k in (1, 2, 3))
    return f"""{name}_at AS (
  SELECT conc, chrom, x, {cols}
  FROM (SELECT conc, chrom, unnest(range(greatest(pos - {w}, 0), pos + {w} + 1)) AS x, v1, v2, v3 FROM {source})
  GROUP BY ALL HAVING v1 + v2 + v3 > 0),
{name}_flag AS (
  SELECT *, CASE WHEN lag(x) OVER w = x - 1 AND lag(v1) OVER w = v1 AND lag(v2) OVER w = v2 AND lag(v3) OVER w = v3
                 THEN 0 ELSE 1 END AS opens
  FROM {name}_at WINDOW w AS (PARTITION BY conc, chrom ORDER BY x)),
{name}_num AS (
  SELECT *, sum(opens) OVER (PARTITION BY conc, chrom ORDER BY x) AS run FROM {name}_flag),
{name} AS (
  SELECT conc, chrom, min(x) AS start, max(x) + 1 AS stop, any_value(v1) AS v1, any_value(v2) AS v2, any_value(v3) AS v3
  FROM {name}_num GROUP BY conc, chrom, run)"""


def swept(name: str, source: str, w: int, limit: str = "pos + {w} + 1", kind: str = "BIGINT") -> str:
    """The same by steps over the whole chromosome, for wide windows."""
    stop = limit.format(w=w)
    sums = ", ".join(f"sum(d{k}) OVER w AS v{k}" for k in (1, 2, 3))
    return f"""{name}_step AS (
  SELECT conc, chrom, x, sum(d1)::{kind} AS d1, sum(d2)::{kind} AS d2, sum(d3)::{kind} AS d3 FROM (
    SELECT conc, chrom, greatest(pos - {w}, 0) AS x, v1 AS d1, v2 AS d2, v3 AS d3 FROM {source}
    UNION ALL SELECT conc, chrom, {stop}, -v1, -v2, -v3 FROM {source})
  GROUP BY ALL HAVING d1 <> 0 OR d2 <> 0 OR d3 <> 0),
{name}_lvl AS (
  SELECT conc, chrom, x AS start, lead(x) OVER w AS stop, {sums}
  FROM {name}_step WINDOW w AS (PARTITION BY conc, chrom ORDER BY x)),
{name} AS (SELECT * FROM {name}_lvl WHERE v1 + v2 + v3 > 0)"""


SIGNED = """signed AS (
  SELECT conc, chrom, pos, v1, v2, v3 FROM counts WHERE conc <> 0
  UNION ALL SELECT t.conc, chrom, pos, -v1, -v2, -v3 FROM ctrl, (VALUES (64), (256)) AS t(conc))"""
SELF_SIGNED = "self_signed AS (SELECT conc, chrom, pos, v1 - v2 AS v1, v2 - v3 AS v2, v3 - v1 AS v3 FROM ctrl)"


def peaked(name: str, source: str, gap: int = 5) -> str:
    return f"""{name}_open AS (
  SELECT *, coalesce(start > lag(stop) OVER w + {gap}, TRUE)::INT AS opens
  FROM {source} WINDOW w AS (PARTITION BY conc, chrom ORDER BY start)),
{name}_isl AS (SELECT *, sum(opens) OVER (PARTITION BY conc, chrom ORDER BY start) AS isl FROM {name}_open),
{name} AS (
  SELECT conc, chrom, start + (stop - start) // 2 AS pos, v1, v2, v3 FROM {name}_isl
  QUALIFY row_number() OVER (PARTITION BY conc, chrom, isl ORDER BY v1 + v2 + v3 DESC, start DESC) = 1)"""


DIFFS = ",\n".join([COUNTS, CTRL, SIGNED, expanded("diffs", "signed", 5, clip=True)])
PEAKS = DIFFS + ",\n" + peaked("peaks", "diffs")
SELF = ",\n".join([SELF_SIGNED, expanded("selfd", "self_signed", 5, clip=True), peaked("nullpk", "selfd")])
PEAK_NULL = """pnull AS (
  SELECT round((v1 + v2 + v3) / 3.0::DOUBLE, 6) AS stat, count(*)::BIGINT AS cnt FROM nullpk GROUP BY ALL)"""
DOUBLES = "v1::DOUBLE AS v1, v2::DOUBLE AS v2, v3::DOUBLE AS v3"


def survival(name: str, null: str, probes: str) -> str:
    """p of every distinct probe value by counting the null rows at or above it."""
    return f"""{name}_ends AS (SELECT min(stat) AS lo, max(stat) AS hi, sum(cnt)::DOUBLE AS n FROM {null}),
{name}_suffix AS (
  SELECT stat, cnt, sum(cnt) OVER (ORDER BY stat DESC) AS suffix, lead(stat) OVER (ORDER BY stat) AS up,
         n, lo, hi FROM {null}, {name}_ends),
{name} AS (
  SELECT q.stat, round(CASE
      WHEN q.stat <= s.lo THEN 1.0
      WHEN q.stat > s.hi THEN 1.0 / s.n
      WHEN q.stat = s.stat THEN s.suffix / s.n
      ELSE (s.suffix - s.cnt + (s.up - q.stat) / (s.up - s.stat) * s.cnt) / s.n END, 16) AS p
  FROM (SELECT DISTINCT stat FROM {probes}) q
  ASOF JOIN (SELECT * FROM {name}_suffix UNION ALL
             SELECT -1e300, 0, n::BIGINT, lo, n, lo, hi FROM {name}_ends) s ON q.stat >= s.stat)"""


# -- reads -------------------------------------------------------------------------------------

ALN = """aln AS (
  SELECT l_returnflag || '_R' || (l_linenumber % 3 + 1) AS sample_id,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey AS read_id,
         'chr' || (l_suppkey % 4) AS chrom, (l_orderkey - l_orderkey % 64) * 7 + l_partkey % 3 AS pos,
         (CASE WHEN l_linestatus = 'O' THEN 16 ELSE 0 END + CASE WHEN l_partkey % 17 = 0 THEN 256 ELSE 0 END)::INT AS flag,
         l_quantity::INT AS mapq,
         CASE WHEN l_linenumber % 4 > 0 AND l_suppkey % 3 = 0 THEN (l_linenumber % 4) || 'S' ELSE '' END
           || (10 + l_partkey % 30) || 'M' || l_linenumber || 'D2I5M'
           || CASE WHEN l_suppkey % 5 = 0 THEN '3S' ELSE '' END AS cigar,
         -- the reference length is known from the parts the text is made of
         10 + l_partkey % 30 + l_linenumber + 5 AS ref_length,
         CASE WHEN l_linestatus = 'O' THEN CASE WHEN l_suppkey % 5 = 0 THEN 3 ELSE 0 END
              ELSE CASE WHEN l_suppkey % 3 = 0 THEN l_linenumber % 4 ELSE 0 END END AS start_clip,
         'ACG' || substr('ACGT', l_partkey % 4 + 1, 1) || substr('AC', l_partkey // 4 % 2 + 1, 1) || 'TT' AS umi
  FROM lineitem)"""
CLASSED = ALN + """,
classed AS (
  SELECT *, CASE WHEN flag & 16 <> 0 THEN pos + ref_length - 1 ELSE pos END AS read_start,
         mapq < 5 AS low_mapq, start_clip > 0 AS over_clip, ref_length < 20 AS short
  FROM aln WHERE flag & 256 = 0),
passing AS (SELECT * FROM classed WHERE NOT (low_mapq OR over_clip OR short))"""

define("alignment_filter_stats", CLASSED, select="""
SELECT c.sample_id, count(*)::BIGINT AS total_reads,
       count(*) FILTER (NOT (low_mapq OR over_clip OR short))::BIGINT AS passing_reads,
       count(*) FILTER (low_mapq)::BIGINT AS low_mapping_quality, count(*) FILTER (over_clip)::BIGINT AS above_clipping,
       count(*) FILTER (short)::BIGINT AS below_ref_length,
       coalesce((SELECT count(DISTINCT (p.chrom, p.read_start)) FROM passing p WHERE p.sample_id = c.sample_id), 0)::BIGINT AS total_sites
FROM classed c GROUP BY c.sample_id""")
define("read_start_counts", CLASSED, select="""
SELECT sample_id, chrom, read_start AS pos, count(*)::BIGINT AS n FROM passing GROUP BY ALL""")
define("per_million_norm", CLASSED, select="""
SELECT p.sample_id, chrom, read_start AS pos, round(count(*) / (any_value(t.total) / 1e6::DOUBLE), 6) AS n
FROM passing p JOIN (SELECT sample_id, count(*) AS total FROM classed GROUP BY ALL) t USING (sample_id)
GROUP BY p.sample_id, chrom, read_start""")
define("cigar_reflen", ALN, select="""
SELECT read_id, chrom, cigar, ref_length::BIGINT AS ref_length, start_clip::INT AS start_clip,
       CASE WHEN flag & 16 <> 0 THEN pos + ref_length - 1 ELSE pos END AS read_start, flag & 256 = 0 AS is_primary
FROM aln""")
define("merge_read_starts", COUNTS, select=f"SELECT conc, chrom, pos, {DOUBLES} FROM counts")

# -- windows -----------------------------------------------------------------------------------

RUN = f"conc, chrom, start, stop, {DOUBLES}"
define("window_sums_w5", COUNTS, expanded("sums", "counts", 5), select=f"SELECT {RUN} FROM sums")
define("window_sums_w150", COUNTS, swept("sums", "counts", 150), select=f"SELECT {RUN} FROM sums")
define("window_sums_contig_clipped", COUNTS,
       "ends AS (SELECT max(o_orderkey) * 7 + 7 AS len FROM orders)",
       swept("sums", "counts", 150, limit="least(pos + {w} + 1, (SELECT len FROM ends))"),
       select=f"SELECT {RUN} FROM sums")
define("window_sums_normalized", READS, """totals AS (SELECT conc, rep, count(*) AS total FROM reads GROUP BY ALL),
scaled AS (
  SELECT conc, chrom, pos, rep, round(count(*) / (any_value(total) / 1e6::DOUBLE), 10)::DECIMAL(28, 10) AS n
  FROM reads JOIN totals USING (conc, rep) GROUP BY ALL),
normed AS (
  SELECT conc, chrom, pos, coalesce(sum(n) FILTER (rep = 1), 0)::DECIMAL(28, 10) AS v1,
         coalesce(sum(n) FILTER (rep = 2), 0)::DECIMAL(28, 10) AS v2, coalesce(sum(n) FILTER (rep = 3), 0)::DECIMAL(28, 10) AS v3
  FROM scaled GROUP BY conc, chrom, pos)""", swept("sums", "normed", 5, kind="DECIMAL(28, 10)"), select="""
SELECT conc, chrom, start, stop, round(v1::DOUBLE, 4) AS v1, round(v2::DOUBLE, 4) AS v2, round(v3::DOUBLE, 4) AS v3 FROM sums""")
define("window_sum_dist", COUNTS, CTRL, swept("sums", "ctrl", 150), select="""
SELECT conc, (v1 + v2 + v3)::DOUBLE AS total, (v1 + v2 + v3) / 3.0::DOUBLE AS mean, sum(stop - start)::BIGINT AS cnt
FROM sums GROUP BY conc, v1 + v2 + v3""")
define("window_diffs", DIFFS, select=f"SELECT {RUN} FROM diffs")
define("ctrl_self_diffs", COUNTS, CTRL, SELF, select=f"SELECT {RUN} FROM selfd")
define("rotated_controls", COUNTS, CTRL, select="""
SELECT conc, chrom, pos, v2::DOUBLE AS v1, v3::DOUBLE AS v2, v1::DOUBLE AS v3 FROM ctrl""")
define("signal_peaks", PEAKS, select=f"SELECT conc, chrom, pos, {DOUBLES} FROM peaks")
define("site_lists_round_trip", PEAKS, select=f"""
SELECT 'guide_' || conc || 'nM' AS identifier, conc::INT AS concentration, chrom, pos, {DOUBLES} FROM peaks""")
define("ctrl_peak_dist", COUNTS, CTRL, SELF, select="""
SELECT conc, (v1 + v2 + v3)::DOUBLE AS total, round((v1 + v2 + v3) / 3.0::DOUBLE, 6) AS mean, count(*)::BIGINT AS cnt
FROM nullpk GROUP BY conc, v1 + v2 + v3""")
define("event_islands", """timed AS (SELECT user_id, event_id, value, epoch_us(ts) AS t FROM events),
opened AS (
  SELECT *, coalesce(t > lag(t) OVER w + 3600000000, TRUE)::INT AS opens FROM timed
  WINDOW w AS (PARTITION BY user_id ORDER BY t)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY t) AS isl FROM opened)""", select="""
SELECT user_id, min(t) AS island_start, max(t) AS island_stop, count(*)::BIGINT AS members,
       arg_max(event_id, (value, event_id)) AS event_id, max(value) AS value
FROM numbered GROUP BY user_id, isl""")

# -- null distributions ------------------------------------------------------------------------

TESTED = ",\n".join([PEAKS, SELF, PEAK_NULL,
                     "probe AS (SELECT round((v1 + v2 + v3) / 3.0::DOUBLE, 6) AS stat FROM peaks)",
                     survival("pv", "pnull", "probe")])
PRICE = "price AS (SELECT round(l_extendedprice, 6) AS stat, count(*)::BIGINT AS cnt FROM lineitem GROUP BY ALL)"
define("ecdf_pvalues", TESTED, select="""
SELECT conc, chrom, pos, round(p, 12) AS p FROM peaks JOIN pv ON round((v1 + v2 + v3) / 3.0::DOUBLE, 6) = pv.stat""")
define("ecdf_price_pvalues", PRICE, "probe AS (SELECT o_orderkey, round(o_totalprice / 4, 6) AS stat FROM orders)",
       survival("pv", "price", "probe"), select="SELECT o_orderkey, round(p, 12) AS p FROM probe JOIN pv USING (stat)")


def threshold_sql(null: str, levels: dict[str, float], digits: int) -> str:
    rows = ", ".join(f"('{k}', {v!r}::DOUBLE)" for k, v in levels.items())
    return f"""
SELECT name, p, round(CASE WHEN p <= 1.0 / n OR x1 IS NULL THEN hi
                           ELSE x0 + (s0 - p * n) / (s0 - s1) * (x1 - x0) END, {digits}) AS value
FROM (SELECT name, p, any_value(n) AS n, any_value(hi) AS hi,
             max(stat) FILTER (suffix >= p * n) AS x0, min(suffix) FILTER (suffix >= p * n) AS s0,
             min(stat) FILTER (suffix < p * n) AS x1, max(suffix) FILTER (suffix < p * n) AS s1
      FROM (SELECT stat, (sum(cnt) OVER (ORDER BY stat DESC))::DOUBLE AS suffix, (sum(cnt) OVER ())::DOUBLE AS n,
                   max(stat) OVER () AS hi FROM {null}), (VALUES {rows}) AS l(name, p)
      GROUP BY name, p)"""


define("ecdf_thresholds", COUNTS, CTRL, SELF, PEAK_NULL, select=threshold_sql(
    "pnull", {"median": 0.5, "tenth": 0.1, "reporting": 1e-2, "calling": 2e-3, "floor": 1e-9}, 6))
define("ecdf_price_thresholds", PRICE, select=threshold_sql(
    "price", {"median": 0.5, "tenth": 0.1, "thousandth": 1e-3, "one": 1.0}, 4))

# -- lookups -----------------------------------------------------------------------------------

define("interval_join_wide", COUNTS, CTRL, expanded("sums", "ctrl", 5), select="""
SELECT c.conc, c.chrom, c.pos, coalesce(s.v1, 0)::DOUBLE AS w1, coalesce(s.v2, 0)::DOUBLE AS w2, coalesce(s.v3, 0)::DOUBLE AS w3
FROM (SELECT * FROM counts WHERE conc <> 0) c LEFT JOIN sums_at s ON c.chrom = s.chrom AND c.pos = s.x""")
define("region_scan", COUNTS, expanded("sums", "counts", 5), select=f"""
SELECT {RUN} FROM sums WHERE chrom = 'chr2' AND start < 5000 AND stop > 1000""")

# -- calling -----------------------------------------------------------------------------------

WIDE_NULL = """wnull AS (
  SELECT round((v1 + v2 + v3) / 3.0::DOUBLE, 6) AS stat, sum(stop - start)::BIGINT AS cnt FROM wide GROUP BY 1)"""
EVIDENCE = ",\n".join([
    PEAKS, SELF, PEAK_NULL, swept("wide", "ctrl", 150), WIDE_NULL,
    expanded("tsum", "(SELECT * FROM counts WHERE conc <> 0)", 5), expanded("csum", "ctrl", 5),
])


def judged(name: str, points: str) -> str:
    """Window values, p-values and flags of points (conc, chrom, pos, v1..v3)."""
    return f"""{name}_win AS (
  SELECT p.conc, p.chrom, p.pos, p.v1, p.v2, p.v3,
         coalesce(t.v1, 0) AS t1, coalesce(t.v2, 0) AS t2, coalesce(t.v3, 0) AS t3,
         coalesce(c.v1, 0) AS c1, coalesce(c.v2, 0) AS c2, coalesce(c.v3, 0) AS c3,
         CASE WHEN w.stop > p.pos THEN w.v1 ELSE 0 END AS w1, CASE WHEN w.stop > p.pos THEN w.v2 ELSE 0 END AS w2,
         CASE WHEN w.stop > p.pos THEN w.v3 ELSE 0 END AS w3,
         round((p.v1 + p.v2 + p.v3) / 3.0::DOUBLE, 6) AS stat
  FROM {points} p
  LEFT JOIN tsum_at t ON p.conc = t.conc AND p.chrom = t.chrom AND p.pos = t.x
  LEFT JOIN csum_at c ON p.chrom = c.chrom AND p.pos = c.x
  ASOF LEFT JOIN wide w ON p.chrom = w.chrom AND p.pos >= w.start),
{name}_stats AS (SELECT *, round((w1 + w2 + w3) / 3.0::DOUBLE, 6) AS wstat FROM {name}_win),
{survival(name + "_pt", "pnull", name + "_stats")},
{survival(name + "_pb", "wnull", "(SELECT wstat AS stat FROM " + name + "_stats)")},
{name} AS (
  SELECT s.*, pt.p AS test_pval, pb.p AS background_pval, pt.p <= 2e-3 AS digested, pb.p <= 5e-3 AS high_background,
         pt.p <= 2e-3 AND NOT pb.p <= 5e-3 AS site_called, (v1 + v2 + v3) / 3.0::DOUBLE AS mean_signal
  FROM {name}_stats s JOIN {name}_pt pt ON s.stat = pt.stat JOIN {name}_pb pb ON s.wstat = pb.stat)"""


SITES = ",\n".join([EVIDENCE, judged("judged", "peaks"), """sites AS (
  SELECT *, row_number() OVER (PARTITION BY conc ORDER BY site_called DESC, mean_signal DESC, chrom, pos) AS rank
  FROM judged WHERE v1 + v2 + v3 >= 1 AND test_pval <= 1e-2 AND background_pval >= 5e-3)"""])
FLOATS = ", ".join(f"{c}{k}::DOUBLE AS {c}{k}" for c in "vtcw" for k in (1, 2, 3))
define("reported_sites", SITES, select=f"""
SELECT conc, chrom, pos AS position, pos + 1 AS position_1b, rank, round(test_pval, 9) AS test_pval,
       round(background_pval, 9) AS background_pval, digested, high_background, site_called,
       round(mean_signal, 9) AS mean_signal, round((w1 + w2 + w3) / 3.0::DOUBLE, 9) AS mean_wide_control_reads,
       (v1 + v2 + v3)::DOUBLE AS total_signal, (t1 + t2 + t3)::DOUBLE AS total_test_reads,
       (c1 + c2 + c3)::DOUBLE AS total_control_reads, (w1 + w2 + w3)::DOUBLE AS total_wide_control_reads, {FLOATS}
FROM sites""")
PCT = ", ".join(
    f"CASE WHEN max(v{k}) FILTER (site_called) OVER w > 0 THEN 100.0::DOUBLE * v{k} / max(v{k}) FILTER (site_called) OVER w END AS pct{k}"
    for k in (1, 2, 3))
define("pct_max_peak", SITES, select=f"""
SELECT conc, chrom, pos, round(pct1, 9) AS pct1, round(pct2, 9) AS pct2, round(pct3, 9) AS pct3,
       round((pct1 + pct2 + pct3) / 3, 9) AS mean_pct_max_peak
FROM (SELECT conc, chrom, pos, {PCT} FROM sites WINDOW w AS (PARTITION BY conc))""")

# Every location at every concentration: reported or not, the values come from the same tables.
GRID = ",\n".join([SITES, """cells AS (
  SELECT t.conc, chrom, pos FROM (SELECT DISTINCT chrom, pos FROM sites), (VALUES (64), (256)) AS t(conc)),
cell_points AS (
  SELECT c.conc, c.chrom, c.pos, coalesce(d.v1, 0) AS v1, coalesce(d.v2, 0) AS v2, coalesce(d.v3, 0) AS v3
  FROM cells c LEFT JOIN diffs_at d ON c.conc = d.conc AND c.chrom = d.chrom AND c.pos = d.x)""",
                   judged("grid", "cell_points")])
define("site_conc_grid", GRID, select=f"""
SELECT conc, chrom, pos, site_called, digested, high_background, round(test_pval, 9) AS test_pval,
       round(background_pval, 9) AS background_pval, {FLOATS} FROM grid""")
CONSENSUS = GRID + """,
loc AS (
  SELECT chrom, pos,
         CASE WHEN bool_and(site_called) THEN max(mean_signal) FILTER (conc = 64) ELSE 0.0 END AS signal_64,
         CASE WHEN bool_or(site_called AND conc = 256) THEN max(mean_signal) FILTER (conc = 256) ELSE 0.0 END AS signal_256,
         sum(v1 + v2 + v3)::DOUBLE AS total_signal
  FROM grid GROUP BY ALL),
loc_open AS (
  SELECT *, coalesce(pos > lag(pos) OVER w + 10, TRUE)::INT AS opens FROM loc WINDOW w AS (PARTITION BY chrom ORDER BY pos)),
loc_isl AS (SELECT *, sum(opens) OVER (PARTITION BY chrom ORDER BY pos) AS isl FROM loc_open),
best AS (
  SELECT * FROM loc_isl QUALIFY row_number() OVER (
    PARTITION BY chrom, isl ORDER BY signal_64 DESC, signal_256 DESC, total_signal DESC, pos) = 1),
ranked AS (
  SELECT chrom, pos, signal_64, signal_256, total_signal,
         row_number() OVER (ORDER BY signal_64 DESC, signal_256 DESC, total_signal DESC, chrom, pos) AS rank FROM best)"""
define("consensus_sites", CONSENSUS, select="""
SELECT chrom, pos, rank, round(signal_64, 9) AS signal_64, round(signal_256, 9) AS signal_256, total_signal FROM ranked""")
WIDE = CONSENSUS + """,
picked AS (SELECT g.*, r.rank FROM grid g JOIN ranked r USING (chrom, pos)),
tops AS (SELECT conc, max(v1) AS m1, max(v2) AS m2, max(v3) AS m3 FROM picked GROUP BY conc),
shares AS (
  SELECT p.*, round((CASE WHEN m1 > 0 THEN 100.0::DOUBLE * v1 / m1 END + CASE WHEN m2 > 0 THEN 100.0::DOUBLE * v2 / m2 END
                     + CASE WHEN m3 > 0 THEN 100.0::DOUBLE * v3 / m3 END) / 3, 9) AS pct
  FROM picked p JOIN tops USING (conc))"""
PER_CONC = ", ".join(f"""bool_or(site_called) FILTER (conc = {c}) AS "{c}nM_site_called",
  round(max(test_pval) FILTER (conc = {c}), 9) AS "{c}nM_test_pval", round(max(mean_signal) FILTER (conc = {c}), 9) AS "{c}nM_mean_signal",
  max(pct) FILTER (conc = {c}) AS "{c}nM_mean_pct_max_peak", (max(t1 + t2 + t3) FILTER (conc = {c}))::DOUBLE AS "{c}nM_total_test_reads"
""" for c in (64, 256))
define("aggregate_pivot", WIDE, select=f"""
SELECT chrom, pos AS position, rank, round(max(background_pval), 9) AS background_pval, bool_or(high_background) AS high_background,
       max(c1 + c2 + c3)::DOUBLE AS total_control_reads, round(max(w1 + w2 + w3) / 3.0::DOUBLE, 9) AS mean_wide_control_reads, {PER_CONC}
FROM shares GROUP BY chrom, pos, rank""")
define("unpivot_concentrations", WIDE, select="""
SELECT conc, chrom, pos AS position, rank, site_called, round(test_pval, 9) AS test_pval, round(mean_signal, 9) AS mean_signal
FROM picked""")
define("called_breakdown", WIDE, select="""
SELECT conc, count(*) FILTER (site_called)::BIGINT AS sites_called, FALSE AS on_target_called,
       round(max(mean_signal) FILTER (site_called), 9) AS max_called_signal FROM picked GROUP BY conc""")
define("ranked_orders", select="""
SELECT o_orderkey, row_number() OVER (
  PARTITION BY o_orderpriority ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey) AS rank FROM orders""")

# -- sample sheet ------------------------------------------------------------------------------

SHEET = """sheet AS (
  SELECT DISTINCT CASE l_returnflag WHEN 'R' THEN 'ctrl' WHEN 'A' THEN 'guideA' ELSE 'guideN' END AS sample_group,
         CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_linenumber <= 3 THEN 64 ELSE 256 END AS concentration,
         l_linenumber AS replicate FROM lineitem),
samples AS (SELECT *, sample_group || '_' || concentration || 'nM' AS grp FROM sheet)"""
define("replicate_groups", SHEET, select="""
SELECT grp, sample_group, concentration, count(*)::INT AS n_reps, string_agg(replicate::VARCHAR, ',' ORDER BY replicate) AS reps,
       string_agg(grp || '_R' || replicate, ',' ORDER BY replicate) AS sample_ids
FROM samples GROUP BY grp, sample_group, concentration""")
define("replicate_group_sizes", SHEET, select="""
SELECT sample_group, count(DISTINCT concentration)::BIGINT AS n_concs, count(*)::BIGINT AS n_samples FROM samples GROUP BY 1""")
# Both guides have three replicates at 64 nM and four at 256 nM, the control has seven.
define("sheet_violations", SHEET, """sizes AS (
  SELECT sample_group, grp, concentration, count(*) AS n FROM samples GROUP BY ALL)""", select="""
SELECT 'uneven_replicates' AS rule, 'warning' AS severity, sample_group AS subject FROM sizes GROUP BY sample_group HAVING min(n) <> max(n)
UNION ALL SELECT 'control_with_uneven_tests', 'error', 'ctrl' FROM sizes WHERE concentration > 0 HAVING min(n) <> max(n)
UNION ALL SELECT 'fewer_tests_than_controls', 'warning', grp FROM sizes
  WHERE concentration > 0 AND n > 1 AND n < (SELECT n FROM sizes WHERE concentration = 0)""")
define("sheet_rules", """given AS (
  SELECT CASE WHEN o_custkey % 4 = 0 THEN 'ctl' || (o_custkey % 1024) ELSE 'g' || (o_custkey % 1021) END AS sample_group,
         CASE WHEN o_custkey % 4 > 0 AND o_custkey % 37 = 3 THEN NULL WHEN o_custkey % 4 > 0 THEN 'ctl' || (o_custkey % 1021 % 300 * 4)
              WHEN o_custkey % 52 = 0 THEN 'ctl4' END AS control_group,
         (CASE WHEN o_custkey % 61 = 1 AND o_orderkey % 3 = 0 THEN -1 WHEN o_custkey % 4 = 0 THEN 0 ELSE 16 + 48 * (o_custkey % 3) END)::INT AS conc,
         o_orderkey % (2 + o_custkey % 3) AS replicate,
         CASE WHEN o_custkey % 4 > 0 THEN CASE WHEN o_custkey % 23 = 5 AND o_orderkey % 2 = 0 THEN 'ACGTNGG' ELSE 'GACGTCTTNGG' END END AS motif,
         CASE WHEN o_custkey % 4 > 0 THEN 'chr1:41,995-42,005,+' END AS place,
         CASE WHEN o_custkey % 19 = 0 OR o_orderkey % 29 = 0 THEN FALSE ELSE TRUE END AS paired FROM orders),
named AS (
  SELECT *, sample_group || '_' || conc || 'nM' AS grp, sample_group || '_' || conc || 'nM_R' || replicate AS sample_id,
         row(coalesce(control_group, '-'), coalesce(motif, '-'), coalesce(place, '-')) AS fields FROM given),
sized AS (
  SELECT grp, sample_group, conc, control_group, count(DISTINCT sample_id) AS n, bool_and(paired) AS paired
  FROM named GROUP BY ALL),
linked AS (
  SELECT t.grp, t.n, t.paired, c.n AS control_n, c.paired AS control_paired
  FROM sized t JOIN sized c ON t.control_group = c.sample_group WHERE t.conc > 0 AND c.conc = 0)""", select="""
SELECT DISTINCT * FROM (
SELECT 'conc_negative' AS rule, 'error' AS severity, sample_id AS subject FROM named WHERE conc < 0
UNION ALL SELECT 'control_fields_not_blank', 'error', sample_id FROM named WHERE conc = 0 AND coalesce(control_group, motif, place) IS NOT NULL
UNION ALL SELECT 'test_fields_missing', 'error', sample_id FROM named WHERE conc > 0 AND (control_group IS NULL OR motif IS NULL OR place IS NULL)
UNION ALL SELECT 'umis_need_fastq_2', 'error', sample_id FROM named WHERE NOT paired
UNION ALL SELECT 'mixed_endedness', 'error', sample_id FROM named GROUP BY sample_id HAVING count(DISTINCT paired) > 1
UNION ALL SELECT 'replicate_group_fields_differ', 'error', grp FROM named GROUP BY grp HAVING count(DISTINCT fields) > 1
UNION ALL SELECT 'sample_group_fields_differ', 'error', sample_group FROM named GROUP BY sample_group HAVING count(DISTINCT fields) > 1
UNION ALL SELECT 'control_needs_two_replicates', 'error', grp FROM sized WHERE conc = 0 AND n < 2
UNION ALL SELECT 'uneven_replicates', 'warning', sample_group FROM sized GROUP BY sample_group HAVING count(DISTINCT n) > 1
UNION ALL SELECT 'control_with_uneven_tests', 'error', control_group FROM sized WHERE conc > 0 GROUP BY control_group HAVING count(DISTINCT n) > 1
UNION ALL SELECT 'unmatched_test_group', 'error', grp FROM sized t WHERE conc > 0 AND NOT EXISTS (
  SELECT 1 FROM sized c WHERE c.conc = 0 AND c.sample_group = t.control_group)
UNION ALL SELECT 'unused_control_group', 'warning', sample_group FROM sized c WHERE conc = 0 AND NOT EXISTS (
  SELECT 1 FROM sized t WHERE t.conc > 0 AND t.control_group = c.sample_group)
UNION ALL SELECT 'more_tests_than_controls', 'error', grp FROM linked WHERE n > control_n
UNION ALL SELECT 'fewer_tests_than_controls', 'warning', grp FROM linked WHERE n < control_n AND n > 1
UNION ALL SELECT 'endedness_differs_from_control', 'error', grp FROM linked WHERE paired <> control_paired)""")
define("control_limits", select="""
SELECT control_group, min(k)::BIGINT AS least, max(k)::BIGINT AS most, count(DISTINCT k)::BIGINT AS sizes
FROM (SELECT 'n' || c_nationkey AS control_group, o_custkey, count(*) AS k
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING' GROUP BY ALL) GROUP BY 1""")
define("unmatched_groups", select="""
SELECT 'customer_without_order' AS kind, c_custkey::BIGINT AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'nation_without_customer', n_nationkey::BIGINT FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)""")
define("keyed_equi_join", select="SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")

# -- quality and duplicates --------------------------------------------------------------------

PAIRS = """pairs AS (
  SELECT 'D_R' || (doc_id % 3 + 1) AS sample_id, doc_id::VARCHAR AS read_id,
         translate(md5(text), '0123456789abcdef', 'ACGTACGTACGTACGN') AS seq1,
         translate(md5(reverse(text)), '0123456789abcdef', 'ACGTACGTACGTACGN') AS seq2,
         translate(md5(text || '1'), '0123456789abcdef', '+05?CFIIIIIIIIII') AS qual1,
         translate(md5(text || '2'), '0123456789abcdef', '+05?CFIIIIIIIIII') AS qual2 FROM documents),
flagged AS (
  SELECT *, len(list_filter(string_split(substr(qual2, 1, 7), ''), lambda c: ascii(c) - 33 < 20)) <= 1 AS umi_ok,
         greatest(len(list_filter(string_split(qual1, ''), lambda c: ascii(c) - 33 < 15)),
                  len(list_filter(string_split(qual2, ''), lambda c: ascii(c) - 33 < 15))) > 32 * 0.4 AS low_quality,
         greatest(len(regexp_replace(seq1, '[^N]', '', 'g')), len(regexp_replace(seq2, '[^N]', '', 'g'))) > 5 AS many_n
  FROM pairs),
kept_pairs AS (SELECT * FROM flagged WHERE NOT low_quality AND NOT many_n)"""
UMIS = "SELECT sample_id, count(*)::BIGINT AS total_reads, count(*) FILTER (umi_ok)::BIGINT AS passing_reads, count(*) FILTER (NOT umi_ok)::BIGINT AS failing_reads, round(100.0::DOUBLE * count(*) FILTER (umi_ok) / count(*), 6) AS passing_percentage FROM {0} GROUP BY 1"
READ_REPORT = """SELECT sample_id, count(*)::BIGINT AS total_reads, count(*) FILTER (low_quality)::BIGINT AS lowq_reads,
       count(*) FILTER (many_n AND NOT low_quality)::BIGINT AS too_many_n_reads, 0::BIGINT AS short_reads,
       count(*) FILTER (NOT low_quality AND NOT many_n)::BIGINT AS reads_passing_filter,
       round(100.0::DOUBLE * sum(len(list_filter(string_split(qual1 || qual2, ''), lambda c: ascii(c) - 33 >= 30))) / sum(64), 6) AS pct_q30_reads_pf
FROM flagged GROUP BY 1"""
define("umi_quality_filter", PAIRS, select=UMIS.format("flagged"))
define("read_quality_filter", PAIRS, select=READ_REPORT)
FRAGMENTS = """fragments AS (
  SELECT doc_id, substr(translate(md5(text) || md5(text || 'a') || md5(text || 'b') || md5(text || 'c'),
                                  '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, (20 + doc_id % 90)::INT) AS f FROM documents),
pieces AS (
  SELECT doc_id, substr(f || repeat('AGATCGGAAGAGCAC', 4), 1,
           CASE WHEN doc_id % 13 = 0 THEN 5 WHEN doc_id % 11 = 0 THEN 48 ELSE 60 END) AS a,
         substr(translate(reverse(f), 'ACGT', 'TGCA') || repeat('AGATCGGAAGAGCGT', 4), 1, 60) AS s FROM fragments),
mates AS (
  SELECT doc_id, a, CASE WHEN doc_id % 4 = 0 THEN translate(substr(s, 1, (doc_id % 37)::INT), 'A', 'N')
         || substr(s, (doc_id % 37 + 1)::INT) ELSE s END AS b FROM pieces),
tried AS (
  SELECT doc_id, a, translate(reverse(b), 'ACGT', 'TGCA') AS r, size, greatest(0, size - 60) AS skipped,
         least(len(a), size) - greatest(0, size - 60) AS overlap
  FROM mates, (SELECT unnest(range(30, 121)) AS size)),
fitting AS (
  SELECT doc_id, size, overlap, hamming(substr(a, skipped + 1, overlap), substr(r, skipped - size + 61, overlap)) AS wrong
  FROM tried WHERE overlap >= 30),
best AS (
  SELECT doc_id, size, wrong FROM fitting WHERE wrong <= least(5, floor(overlap * 0.2::DOUBLE))
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY overlap DESC, wrong, size DESC) = 1),
cut AS (
  SELECT m.doc_id, size, wrong, substr(a, 1, coalesce(size, 60)::INT) AS seq1, substr(b, 1, coalesce(size, 60)::INT) AS seq2,
         len(a) + len(b) AS given FROM mates m LEFT JOIN best USING (doc_id))"""
define("adapter_trim", FRAGMENTS, select="""
SELECT doc_id::VARCHAR AS read_id, coalesce(size, -1)::INT AS insert_length, coalesce(wrong, -1)::INT AS mismatches, seq1, seq2,
       len(seq1)::INT AS qual1_length, (given - len(seq1) - len(seq2))::INT AS trimmed_bases FROM cut""")
define("trimmed_read_filter", FRAGMENTS, """judged AS (
  SELECT *, greatest(len(regexp_replace(seq1, '[^N]', '', 'g')), len(regexp_replace(seq2, '[^N]', '', 'g'))) > 5 AS many_n,
         least(len(seq1), len(seq2)) < 7 AS short FROM cut)""", select="""
SELECT 'D_R' || (doc_id % 3 + 1) AS sample_id, count(*)::BIGINT AS total_reads, 0::BIGINT AS lowq_reads,
       count(*) FILTER (many_n)::BIGINT AS too_many_n_reads, count(*) FILTER (short AND NOT many_n)::BIGINT AS short_reads,
       count(*) FILTER (NOT short AND NOT many_n)::BIGINT AS reads_passing_filter, 100.0::DOUBLE AS pct_q30_reads_pf
FROM judged GROUP BY 1""")
define("umi_extract", PAIRS, select="SELECT read_id, seq1, substr(seq2, 1, 7) AS umi FROM pairs")
DEDUP = ALN + """,
kept AS (
  SELECT * FROM aln WHERE flag & 256 = 0
  QUALIFY row_number() OVER (
    PARTITION BY sample_id, chrom, flag & 16, CASE WHEN flag & 16 <> 0 THEN pos + ref_length + start_clip ELSE pos - start_clip END, umi
    ORDER BY mapq DESC, read_id) = 1)"""
define("umi_dedup_exact", DEDUP, select="SELECT sample_id, read_id, chrom, pos, umi, mapq FROM kept")
# A UMI belongs to the first UMI, by falling count, from which directional steps lead to it.
CLUSTERS = """,
copies AS (SELECT sample_id, chrom, place, strand, umi, count(*) AS n FROM molecules GROUP BY ALL),
steps AS (
  SELECT a.sample_id, a.chrom, a.place, a.strand, a.umi AS src, b.umi AS dst
  FROM copies a JOIN copies b USING (sample_id, chrom, place, strand)
  WHERE hamming(a.umi, b.umi) = 1 AND a.n >= 2 * b.n - 1),
reached AS (
  WITH RECURSIVE walk AS (
    SELECT sample_id, chrom, place, strand, umi AS root, umi AS at FROM copies
    UNION
    SELECT w.sample_id, w.chrom, w.place, w.strand, w.root, s.dst FROM walk w
    JOIN steps s ON w.sample_id = s.sample_id AND w.chrom = s.chrom AND w.place = s.place AND w.strand = s.strand AND w.at = s.src)
  SELECT * FROM walk),
owned AS (
  SELECT r.sample_id, r.chrom, r.place, r.strand, r.at AS umi, arg_min(r.root, (-c.n, r.root)) AS owner
  FROM reached r JOIN copies c ON r.sample_id = c.sample_id AND r.chrom = c.chrom AND r.place = c.place
    AND r.strand = c.strand AND r.root = c.umi
  GROUP BY ALL)"""
BEST = """
SELECT sample_id, read_id, chrom, {0}, umi FROM molecules JOIN owned USING (sample_id, chrom, place, strand, umi)
WHERE umi = owner
QUALIFY row_number() OVER (PARTITION BY sample_id, chrom, place, strand, umi ORDER BY mapq DESC, read_id) = 1"""
define("umi_dedup_directional", ALN, """molecules AS (
  SELECT *, CASE WHEN flag & 16 <> 0 THEN pos + ref_length + start_clip ELSE pos - start_clip END AS place,
         flag & 16 AS strand FROM aln WHERE flag & 256 = 0)""" + CLUSTERS, select=BEST.format("pos"))
define("umi_dedup_crowded", """molecules AS (
  SELECT l_linestatus || '_R1' AS sample_id, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS read_id,
         'chr' || (l_suppkey % 2) AS chrom, 1000 AS place, 0 AS strand, l_quantity::INT AS mapq,
         translate(substr(md5((l_partkey % 997 * (l_partkey % 13))::VARCHAR), 1, 5), '0123456789abcdef', 'ACGTACGTACGTACGT')
         || substr('ACGT', l_orderkey % 7 % 4 + 1, 1) AS umi FROM lineitem)""" + CLUSTERS, select=BEST.format("mapq"))
define("fastq_round_trip", PAIRS, select="SELECT sample_id, read_id, seq1, qual1, seq2, qual2 FROM pairs")
DEDUP_STATS = """SELECT sample_id, total_umis, total_dedup_umis, round(100.0::DOUBLE * (total_umis - total_dedup_umis) / total_umis, 6) AS pct_duplication
FROM (SELECT {0} AS sample_id, count(*)::BIGINT AS total_umis FROM aln WHERE flag & 256 = 0 GROUP BY 1)
JOIN (SELECT {0} AS sample_id, count(*)::BIGINT AS total_dedup_umis FROM {1} GROUP BY 1) USING (sample_id)"""
define("dedup_stats", DEDUP, select=DEDUP_STATS.format("sample_id", "kept"))
define("qc_metrics", PAIRS, ALN, """merged AS (
  SELECT *, 'D_R' || right(sample_id, 1) AS sid FROM aln),
kept AS (
  SELECT * FROM merged WHERE flag & 256 = 0
  QUALIFY row_number() OVER (
    PARTITION BY sid, chrom, flag & 16, CASE WHEN flag & 16 <> 0 THEN pos + ref_length + start_clip ELSE pos - start_clip END, umi
    ORDER BY mapq DESC, read_id) = 1),
counted AS (
  SELECT sid, count(*) FILTER (start_clip > 0)::BIGINT AS clipped_alignments, count(*) FILTER (mapq < 5)::BIGINT AS low_mapq_alignments,
         count(*) FILTER (mapq >= 5 AND start_clip = 0 AND ref_length >= 20)::BIGINT AS alignments_pf,
         count(DISTINCT (chrom, CASE WHEN flag & 16 <> 0 THEN pos + ref_length - 1 ELSE pos END))
           FILTER (mapq >= 5 AND start_clip = 0 AND ref_length >= 20)::BIGINT AS total_unique_sites,
         count(*)::BIGINT AS total_dedup_umis FROM kept GROUP BY 1),
mapped AS (SELECT sid, count(*) AS input_reads, count(*) FILTER (flag & 256 = 0)::BIGINT AS aligned_reads FROM merged GROUP BY 1)""",
       f"report AS ({READ_REPORT})", "umis AS (" + UMIS.format("kept_pairs") + ")", select="""
SELECT r.sample_id AS identifier, 'D' AS sample_group, right(r.sample_id, 1)::INT AS replicate, 64 AS concentration,
       r.total_reads, lowq_reads, too_many_n_reads, short_reads, failing_reads AS lowq_umis, passing_reads AS reads_passing_filter,
       round(100.0::DOUBLE * passing_reads / r.total_reads, 6) AS pct_reads_passing_filter, pct_q30_reads_pf, aligned_reads,
       round(100.0::DOUBLE * aligned_reads / input_reads, 6) AS pct_aligned, total_dedup_umis,
       round(100.0::DOUBLE * (aligned_reads - total_dedup_umis) / aligned_reads, 6) AS pct_duplication,
       clipped_alignments, low_mapq_alignments, alignments_pf, total_unique_sites
FROM report r JOIN umis u USING (sample_id) JOIN counted c ON r.sample_id = c.sid JOIN mapped m ON r.sample_id = m.sid""")
define("subsample", ALN, select="""
SELECT sample_id, read_id FROM aln
QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY md5('100:' || read_id), read_id) <= 500""")

# -- scalar functions --------------------------------------------------------------------------

define("reverse_complement", """s AS (
  SELECT p_partkey, translate(md5(p_name), '0123456789abcdef', 'ACGTRYSWKMBVDHNA') || 'acgtn-' AS seq FROM part)""", select="""
SELECT p_partkey, seq, reverse(translate(seq, 'ACGTRYSWKMBVDHNacgtn', 'TGCAYRSWMKVBHDNtgcan')) AS rc FROM s""")
DNA = """dna AS (
  SELECT p_partkey, translate(md5(p_partkey || p_name), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM part)"""
define("iupac_ungapped_motif", DNA, "laid AS (SELECT p_partkey, seq, unnest(range(28)) AS k FROM dna)", select="""
SELECT p_partkey, k::INT AS place, (1 + (substr(seq, k + 2, 1) = 'G')::INT + (substr(seq, k + 3, 1) IN ('A', 'G'))::INT
       + (substr(seq, k + 4, 1) IN ('C', 'T'))::INT + (substr(seq, k + 5, 1) = 'A')::INT)::INT AS hits FROM laid""")


def gapped_scores(windows: str, key: str, motifs: tuple[str, str], match: int, mismatch: int, gap: int) -> str:
    """Score table of both strands, one motif letter per recursion step, one list per row.

    A run of gaps along the window is a maximum over all earlier cells less its linear cost.
    """
    rows = ", ".join(f"('{m}')" for m in motifs)
    return f"""aligned AS (
  WITH RECURSIVE table_row AS (
    SELECT {key}, w, motif, 0 AS i, [0 FOR x IN range(len(w) + 1)] AS h FROM {windows}, (VALUES {rows}) AS m(motif)
    UNION ALL
    SELECT {key}, w, motif, i + 1,
           [list_max([b[k + 1] - {gap} * (j - k) FOR k IN range(j + 1)]) FOR j IN range(len(w) + 1)]
    FROM (SELECT *, [CASE WHEN j = 0 THEN h[1] - {gap} ELSE greatest(h[j + 1] - {gap},
               h[j] + CASE WHEN substr(motif, i + 1, 1) IN ('N', substr(w, j, 1)) THEN {match} ELSE -{mismatch} END) END
               FOR j IN range(len(w) + 1)] AS b FROM table_row WHERE i < len(motif)))
  SELECT {key}, max(list_max(h)) AS score FROM table_row WHERE i = len(motif) GROUP BY ALL)"""


define("motif_semiglobal", "w AS (SELECT p_partkey, translate(md5(p_partkey || p_name), '0123456789abcdef', 'ACGTACGTACGTACGT') AS w FROM part)",
       gapped_scores("w", "p_partkey", ("GATNACA", "TGTNATC"), 3, 2, 2), select="SELECT p_partkey, score::INT AS score FROM aligned")
define("on_target_sites", SITES, """bases AS (
  SELECT c AS c, o_orderkey AS k, substr(translate(md5(o_orderkey || '-' || c), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 7) AS b
  FROM orders, range(4) AS t(c)),
windows AS (
  SELECT conc, chrom, pos, substr(string_agg(b, '' ORDER BY k), (greatest(pos - 11, 0) - min(k) * 7 + 1)::BIGINT,
                                  (pos + 11 - greatest(pos - 11, 0))::BIGINT) AS w
  FROM sites JOIN bases ON chrom = 'chr' || c AND k BETWEEN greatest(pos - 11, 0) // 7 AND (pos + 10) // 7
  GROUP BY conc, chrom, pos)""", gapped_scores("windows", "conc, chrom, pos", ("GACGTCTTNGG", "CCNAAGACGTC"), 1, 1, 8),
       select="SELECT conc, chrom, pos, score::INT AS motif_score FROM aligned")

# A window that holds the planted sequence whole aligns it without a fault; all others score less.
ON_TARGET = "(chrom = 'chr1' AND pos BETWEEN 41994 AND 42005 AND (SELECT max(o_orderkey) FROM orders) > 6000)"
FOUND = "CASE WHEN on_target THEN 'GACGTCTTAGG' ELSE '-' END AS closest_motif, CASE WHEN on_target THEN 'chr1:41995-42005,+' ELSE '-' END AS motif_location"
define("on_target_ranks", SITES, """bases AS (
  SELECT c, k, CASE WHEN c = 1 AND k = 5999 THEN b[1] || 'GACGTC' WHEN c = 1 AND k = 6000 THEN 'TTAGG' || b[6:7] ELSE b END AS b FROM (
    SELECT c AS c, o_orderkey AS k, substr(translate(md5(o_orderkey || '-' || c), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 7) AS b
    FROM orders, range(4) AS t(c))),
windows AS (
  SELECT conc, chrom, pos, substr(string_agg(b, '' ORDER BY k), (greatest(pos - 11, 0) - min(k) * 7 + 1)::BIGINT,
                                  (pos + 11 - greatest(pos - 11, 0))::BIGINT) AS w
  FROM sites JOIN bases ON chrom = 'chr' || c AND k BETWEEN greatest(pos - 11, 0) // 7 AND (pos + 10) // 7
  GROUP BY conc, chrom, pos)""", gapped_scores("windows", "conc, chrom, pos", ("GACGTCTTNGG", "CCNAAGACGTC"), 1, 1, 8),
       f"""targeted AS (SELECT *, {ON_TARGET} AS on_target FROM sites)""", select=f"""
SELECT t.conc, t.chrom, t.pos, row_number() OVER (PARTITION BY t.conc ORDER BY on_target DESC, site_called DESC, mean_signal DESC, t.chrom, t.pos)
         - (bool_or(on_target) OVER (PARTITION BY t.conc))::INT AS rank,
       on_target AS is_on_target, score::INT AS motif_score, {FOUND}
FROM targeted t JOIN aligned a ON t.conc = a.conc AND t.chrom = a.chrom AND t.pos = a.pos""")
TARGETED = GRID + CONSENSUS[len(GRID):].replace("best AS (\n  SELECT * FROM loc_isl", f"best AS (\n  SELECT *, {ON_TARGET} AS on_target FROM loc_isl").replace(
    "ORDER BY signal_64 DESC, signal_256 DESC, total_signal DESC, pos) = 1", f"ORDER BY {ON_TARGET} DESC, signal_64 DESC, signal_256 DESC, total_signal DESC, pos) = 1").replace(
    "SELECT chrom, pos, signal_64, signal_256, total_signal,\n         row_number() OVER (ORDER BY signal_64",
    "SELECT chrom, pos, on_target,\n         row_number() OVER (ORDER BY on_target DESC, signal_64").replace(
    "AS rank FROM best", "- (SELECT bool_or(on_target)::INT FROM best) AS rank FROM best")
define("on_target_consensus", TARGETED, select=f"""
SELECT g.chrom, g.pos AS position, rank, on_target AS is_on_target, {FOUND},
       bool_or(site_called) FILTER (conc = 64) AS "64nM_site_called", bool_or(site_called) FILTER (conc = 256) AS "256nM_site_called",
       round(max(mean_signal) FILTER (conc = 256), 9) AS "256nM_mean_signal"
FROM grid g JOIN ranked r ON g.chrom = r.chrom AND g.pos = r.pos GROUP BY g.chrom, g.pos, rank, on_target""")
define("on_target_breakdown", TARGETED, select="""
SELECT conc, count(*) FILTER (site_called)::BIGINT AS sites_called, bool_or(site_called AND on_target) AS on_target_called,
       round(max(mean_signal) FILTER (site_called), 9) AS max_called_signal
FROM grid g JOIN ranked r ON g.chrom = r.chrom AND g.pos = r.pos GROUP BY conc""")

SPANS = """spans AS (
  SELECT l_orderkey, l_linenumber, l_partkey, 'chr' || (l_suppkey % 2) AS chrom_a, 'chr' || (l_suppkey % 3 % 2) AS chrom_b,
         100 + l_partkey % 50 AS sa, 110 + l_partkey % 50 + l_linenumber AS ea, 100 + l_orderkey % 60 AS sb,
         105 + l_orderkey % 60 + l_linenumber AS eb, l_linestatus = 'O' AS ra, l_returnflag = 'R' AS rb FROM lineitem),
rel AS (
  SELECT *, chrom_a = chrom_b AND sa <= eb AND sb <= ea AS touch, chrom_a = chrom_b AND ra = rb AS same FROM spans)"""
define("interval_ops", SPANS, select="""
SELECT l_orderkey, l_linenumber, l_partkey, chrom_b, sb AS start_b, eb AS stop_b, ra AS rev_a, rb AS rev_b,
       chrom_a || ':' || sa || '-' || ea || CASE WHEN ra THEN ',-' ELSE ',+' END AS text,
       chrom_a || ':' || (sa - 1) || '_' || ea AS zero_text, ea - sa + 1 AS len_a, ea - sa + 1 AS zero_len,
       touch AND ra = rb AS overlaps, touch AS zero_overlaps,
       CASE WHEN touch THEN greatest(sa, sb) ELSE -1 END AS inter_start, CASE WHEN touch THEN least(ea, eb) ELSE -1 END AS inter_stop,
       CASE WHEN touch THEN (sb > sa)::INT + (eb < ea)::INT ELSE 1 END AS pieces,
       ea - sa + 1 - CASE WHEN touch THEN least(ea, eb) - greatest(sa, sb) + 1 ELSE 0 END AS rest_len,
       same AND CASE WHEN ra THEN sa > eb ELSE ea < sb END AS is_5prime,
       same AND CASE WHEN ra THEN ea < sb ELSE sa > eb END AS is_3prime,
       same AND CASE WHEN ra THEN sa - 1 >= eb ELSE ea <= sb - 1 END AS zero_5prime,
       CASE WHEN ra THEN sa ELSE sa + 3 END AS clip_start, CASE WHEN ra THEN ea - 3 ELSE ea END AS clip_stop,
       CASE WHEN ra THEN sa - 4 ELSE sa END AS grown_start, CASE WHEN ra THEN ea ELSE ea + 4 END AS grown_stop,
       CASE WHEN ra THEN ea ELSE sa END AS end5, sa AS parsed_start, ra AS parsed_rev FROM rel""")
define("combined_spans", SPANS, select="""
SELECT l_orderkey, min(sa) AS start, max(ea) AS stop, bool_and(ra) AS is_reverse FROM spans GROUP BY 1""")
define("on_target_overlap", SPANS, select="""
SELECT l_orderkey, l_linenumber, l_partkey, sb AS start_b,
       (least(ea, eb) - greatest(sa, sb) + 1) / (eb - sb + 1)::DOUBLE > 0.9 AS hit FROM spans""")
define("cut_sites", """parts AS (
  SELECT o_orderkey, unnest(['chr1:' || o_custkey, 'chr' || (o_orderkey % 5) || ':' || o_orderkey]) AS s FROM orders)""", select="""
SELECT o_orderkey, string_agg(s, ';' ORDER BY s) AS sites FROM (SELECT DISTINCT * FROM parts) GROUP BY 1""")
define("display_formats", select="""
SELECT o_orderkey, format('{:,}', o_custkey * 1000) AS n,
       'chr1:' || format('{:,}', o_orderkey + 1000) || '-' || format('{:,}', o_orderkey + 1022) || ',+' AS place,
       'sample' || o_orderkey AS base, o_orderkey % 2 = 0 AS zipped FROM orders""")
define("bedgraph_unpivot", COUNTS, expanded("sums", "counts", 5), select="""
SELECT conc, rep, chrom, start, stop, value FROM (
  SELECT conc, 1 AS rep, chrom, start, stop, v1::DOUBLE AS value FROM sums UNION ALL
  SELECT conc, 2, chrom, start, stop, v2::DOUBLE FROM sums UNION ALL
  SELECT conc, 3, chrom, start, stop, v3::DOUBLE FROM sums) WHERE value > 0""")
# Every level straight from the positions.
define("track_zoom", COUNTS, expanded("sums", "counts", 5), """shown AS (
  SELECT conc, 1 AS rep, chrom, x, v1::DOUBLE AS value FROM sums_at WHERE v1 > 0 UNION ALL
  SELECT conc, 2, chrom, x, v2::DOUBLE FROM sums_at WHERE v2 > 0 UNION ALL
  SELECT conc, 3, chrom, x, v3::DOUBLE FROM sums_at WHERE v3 > 0),
levels AS (
  SELECT level, (256 * power(4, level))::BIGINT AS width FROM (SELECT unnest(range(20)) AS level)
  WHERE level = 0 OR (SELECT max(x) FROM shown) // (64 * power(4, level))::BIGINT > 0)""", select="""
SELECT level::INT AS level, conc, rep, chrom, (x // width * width)::BIGINT AS start, ((x // width + 1) * width)::BIGINT AS stop,
       min(value) AS least, max(value) AS greatest, sum(value) AS total, count(*)::BIGINT AS covered
FROM shown, levels GROUP BY level, width, conc, rep, chrom, x // width""")
define("peak_plot_histogram", PEAKS, """means AS (SELECT conc, round((v1 + v2 + v3) / 3.0::DOUBLE, 6) AS mean FROM peaks),
scale AS (SELECT max(mean) AS top, greatest(1, least(floor(max(mean))::INT * 2, 2000)) AS bins FROM means)""", select="""
SELECT conc, least(floor(mean / (top / bins)), bins - 1)::BIGINT AS bin, round(bin * (any_value(top) / any_value(bins)), 6) AS bin_start,
       count(*)::BIGINT AS sites FROM means, scale GROUP BY 1, 2""")
define("lane_union", select="""
SELECT 'c' || o_custkey AS sample_id, 'lane' || o_orderkey || '.fastq.gz' AS fastq_1,
       row_number() OVER (PARTITION BY o_custkey ORDER BY 'lane' || o_orderkey || '.fastq.gz') AS lane FROM orders""")
