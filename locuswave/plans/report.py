"""Summary reports of sample groups.

Aggregates are computed by Spark for all sample groups together; only their few rows reach the driver.  The site
tables are HTML pages of 200 ranks that the executors write as named files, and a report is its first page with the
summaries around it: one job writes all pages and reports of a run.
"""

from __future__ import annotations

import html
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswave.functions import display
from locuswave.operators import aggregate, nulls
from locuswave.operators.calling import Evidence
from locuswave.operators.qc import METRICS
from locuswave.params import Params
from locuswave.session import stage
from locuswave.sinks import files

PAGE_ROWS = 200
MAX_BINS = 2000


def threshold_summary(evidence: Evidence, params: Params) -> DataFrame:
    """Signal values at the calling, reporting and background p-values, per control.

    The background value is taken at its own p-value; ``compat_background_threshold`` takes it at
    the reporting p-value instead.
    """
    signal = nulls.thresholds(evidence.peak_null, {
        "Calling threshold": params.test_pval_calling_thresh,
        "Reporting threshold": params.test_pval_reporting_thresh})
    shown = params.ctrl_noise_pval_calling_thresh
    used = params.test_pval_reporting_thresh if params.compat_background_threshold else shown
    background = nulls.thresholds(evidence.wide_null, {"Background filter threshold": used})
    return signal.withColumn("stat", F.lit("mean signal")).unionByName(
        background.withColumn("p", F.lit(shown)).withColumn("stat", F.lit("mean wide control reads")))


def plot_bins(hist: DataFrame, key: str | None = None) -> DataFrame:
    """Peaks per signal bin and group: two bins per unit of mean signal, at most 2000.

    The axis goes up to the greatest mean of all groups, or of those that share a value of ``key``.
    """
    # Read for the axis and for the bins; has a row per distinct value.
    hist = stage(hist.withColumn("_key", F.col(key) if key else F.lit("")), "plotted")
    tops = hist.groupBy("_key").agg(F.max("mean").alias("_top"))
    bins = F.greatest(F.lit(1), F.least(F.floor(F.col("_top")).cast("int") * 2, F.lit(MAX_BINS)))
    width = F.when(F.col("_top") > 0, F.col("_top") / F.col("_bins")).otherwise(1.0)
    tops = tops.withColumn("_bins", bins).withColumn("_width", width)
    place = F.least(F.floor(F.col("mean") / F.col("_width")), F.col("_bins") - 1).cast("long")
    keys = [key, "grp"] if key else ["grp"]
    return hist.join(tops, "_key").groupBy(*keys, place.alias("bin"), "_width").agg(F.sum("cnt").alias("sites")).withColumn(
        "bin_start", F.round(F.col("bin") * F.col("_width"), 6)).drop("_width")


def site_columns(concs: Sequence[int]) -> dict[str, Column]:
    """Title and text form of every column of the site table."""
    columns = {
        "Rank": F.col("rank").cast("string"), "Chromosome": F.col("chrom"),
        "Position (1-based)": display.integer(F.col("position_1b")),
        "Closest Motif": display.dna_html(F.col("closest_motif")),
        "Motif Location": display.coordinate(F.col("motif_location")),
        "Motif Score": F.col("motif_score").cast("string"), "Subs.": F.col("num_subs").cast("string"),
        "Gaps": F.col("num_gaps").cast("string"), "Background P-val.": display.p_value(F.col("background_pval")),
        "Total Control Reads": display.decimal(F.col("total_control_reads")),
        "Mean Wide Control Reads": display.decimal(F.col("mean_wide_control_reads")),
        "Control Reads": display.number_list(F.col("control_read_vals")),
        "Wide Control Reads": display.number_list(F.col("wide_control_read_vals")),
        "High Background": F.col("high_background").cast("string"),
    }
    texts = {
        "Called": ("site_called", lambda c: c.cast("string")), "P-val.": ("test_pval", display.p_value),
        "% Max Peak": ("mean_pct_max_peak", display.percentage),
        "% Max Peak by Rep.": ("pct_max_peak_vals", display.percentage_list),
        "Mean Signal": ("mean_signal", display.decimal), "Signal by Rep.": ("signal_vals", display.number_list),
        "Total Test Reads": ("total_test_reads", display.decimal),
        "Test Reads by Rep.": ("test_read_vals", display.number_list),
        "Total Signal": ("total_signal", display.decimal), "Digested": ("digested", lambda c: c.cast("string")),
    }
    for title, (field, text) in texts.items():
        columns |= {f"{title} ({c}nM)": text(F.col(f"{c}nM_{field}")) for c in concs}
    return columns


def _page_name(page: Column) -> Column:
    return F.format_string("page-%06d.html", page)


def site_pages(wide: DataFrame, concs: Sequence[int]) -> DataFrame:
    """(sample_group, page, last, body): the rows of the site tables as HTML, page by page, all cells escaped."""
    columns = site_columns(concs)
    # The motif brings its own markup, letter by letter.
    shown = [c if title == "Closest Motif" else display.escaped(c) for title, c in columns.items()]
    cells = [F.concat(F.lit("<td>"), F.coalesce(c, F.lit("")), F.lit("</td>")) for c in shown]
    rows = wide.select(
        "sample_group", F.expr(f"rank div {PAGE_ROWS}").alias("page"), "rank",
        F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias("row"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "row"))), lambda r: r["row"]), "")
    # A page has at most 200 rows, a sample group one row per page.
    pages = rows.groupBy("sample_group", "page").agg(body.alias("body"))
    last = wide.groupBy("sample_group").agg(F.expr(f"max(rank) div {PAGE_ROWS}").alias("last"))
    return pages.join(last, "sample_group")


def _links(page: Column, last: Column, folder: str) -> Column:
    """First, last, next and farther pages: as many links whatever the number of pages."""
    steps = [("First", F.lit(0)), ("-100", page - 100), ("-10", page - 10), ("Previous", page - 1),
             ("Next", page + 1), ("+10", page + 10), ("+100", page + 100), ("Last", last)]
    return F.concat(*[
        F.when((to >= 0) & (to <= last), F.concat(
            F.lit(f"<a href='{folder}"), _page_name(to.cast("long")), F.lit(f"'>{text}</a> "))).otherwise("")
        for text, to in steps])


def _table_head(concs: Sequence[int]) -> str:
    return "".join(f"<th>{html.escape(t)}</th>" for t in site_columns(concs))


def _documents(wide: DataFrame, concs: Sequence[int], frames: DataFrame) -> DataFrame:
    """(name, content) of every page and report; ``frames``: what stands before and behind a report's first page."""
    pages = stage(site_pages(wide, concs), "site-pages")
    folder, number = files.folder_name(F.col("sample_group")), F.col("page")
    table = F.concat(F.lit(f"<table><thead><tr>{_table_head(concs)}</tr></thead><tbody>"), F.coalesce("body", F.lit("")),
                     F.lit("</tbody></table>"))
    page = F.concat(
        F.lit("<!DOCTYPE html><html lang='en'><head><meta charset='utf-8'><title>Sites, page "), (number + 1).cast("string"),
        F.lit("</title></head><body><p><a href='../report.html'>Report</a> "), _links(number, F.col("last"), ""),
        F.lit("</p>"), table, F.lit("</body></html>"))
    first = frames.join(pages.filter("page = 0"), "sample_group", "left")
    shown = F.when(F.col("last").isNotNull(), F.concat(
        F.lit("<p>Page 1 of "), (F.col("last") + 1).cast("string"), F.lit(": "), _links(F.lit(0), F.col("last"), "sites/"),
        F.lit("</p>"))).otherwise("<p>no sites</p>")
    report = F.concat("before", shown, table, "behind")
    return pages.select(F.concat(folder, F.lit("/sites/"), _page_name(number)).alias("name"), page.alias("content")).unionByName(
        first.select(F.concat(folder, F.lit("/report.html")).alias("name"), report.alias("content")))


def write_reports(path: str, groups: DataFrame, wide: DataFrame, concs: Sequence[int], peak_hists: DataFrame,
                  metrics: DataFrame | None, evidence: Evidence, params: Params, version: str = "") -> None:
    """``<sample group>/report.html`` and its site pages below ``path``, for all sample groups at once.

    ``groups``: sample_group, grp, control_grp and the on-target columns; ``peak_hists``: histograms of test and
    control groups side by side.
    """
    groups = groups.select("sample_group", "grp", "control_grp", "on_target_motif", "on_target_location")
    # What follows has a row per sample, group or bin of the sheet's groups: it grows with the sheet, not with reads.
    sheet = groups.groupBy("sample_group").agg(
        F.max("control_grp").alias("control"), F.max("on_target_motif").alias("motif"),
        F.max("on_target_location").alias("location")).orderBy("sample_group").collect()
    called = aggregate.called_breakdown(wide, concs).orderBy("sample_group", "conc")
    limits = threshold_summary(evidence, params)
    members = groups.select("sample_group", "grp").unionByName(
        groups.select("sample_group", F.col("control_grp").alias("grp"))).distinct()
    bins = plot_bins(peak_hists.join(members, "grp"), "sample_group")
    tables = {"called": (called.drop("sample_group").columns, _by(called, "sample_group")),
              "limits": (limits.columns, _by(limits, "null_id")),
              "bins": (bins.columns, _by(bins, "sample_group"))}
    samples = metrics.select("sample_group", "identifier", *METRICS).orderBy("identifier").collect() if metrics is not None else []

    def of(name: str, key: str):
        columns, rows = tables[name]
        return _table(columns, [[r[c] for c in columns] for r in rows.get(key, [])])

    frames = []
    for row in sheet:
        control = row.control.rsplit("_", 1)[0] if row.control else ""
        read = [r for r in samples if r.sample_group in (row.sample_group, control)]
        before = [
            _section("Metadata", _table(["Field", "Value"], [
                ("Sample group", row.sample_group), ("Control group", control), ("On-target motif", row.motif),
                ("On-target location", row.location), ("Version", version)])),
            _section("Called Site Summary", of("called", row.sample_group)),
            _section("Read &amp; Alignment Stats", _table(["identifier", *METRICS], [[r["identifier"], *[r[m] for m in METRICS]]
                                                      for r in read]) if read else "<p>not available</p>"),
            _section("Thresholds", of("limits", row.control)),
            _section("Peak Signal Distributions", _plot(tables["bins"][1].get(row.sample_group, [])))]
        frames.append((
            row.sample_group, "<!DOCTYPE html><html lang='en'><head><meta charset='utf-8'><title>"
            f"{html.escape(row.sample_group)}</title></head><body>{''.join(before)}<section><h4>Called/Reported Sites</h4>",
            "</section></body></html>"))
    if frames:
        made = wide.sparkSession.createDataFrame(frames, "sample_group string, before string, behind string")
        files.write_named(_documents(wide, concs, made), path)


def _by(df: DataFrame, key: str) -> dict:
    """Rows of a summary by key."""
    out: dict = {}
    for row in df.collect():
        out.setdefault(row[key], []).append(row)
    return out


def _section(title: str, body: str) -> str:
    return f"<section><h4>{title}</h4>{body}</section>"


def _table(head: Sequence[str], rows) -> str:
    top = "".join(f"<th>{html.escape(str(h))}</th>" for h in head)
    body = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in row) + "</tr>"
                   for row in rows)
    return f"<table><thead><tr>{top}</tr></thead><tbody>{body}</tbody></table>"


# Fill colours of the plotted groups, in order.
COLORS = ("#4477aa", "#ee6677", "#228833", "#ccbb44", "#66ccee", "#aa3377")


def _plot(rows: Sequence, width: int = 900, height: int = 300) -> str:
    """Overlaid bars on a logarithmic count axis, as inline SVG; at most 2000 bins per group."""
    rows = sorted(rows, key=lambda r: (r.grp, r.bin))
    if not rows:
        return "<p>no peaks</p>"
    names = sorted({r.grp for r in rows})
    step = width / (max(r.bin for r in rows) + 1)
    top = max(r.sites for r in rows).bit_length()
    bars = []
    for r in rows:
        tall = height * r.sites.bit_length() / top
        bars.append(f"<rect x='{r.bin * step:.2f}' y='{height - tall:.2f}' width='{step:.2f}' height='{tall:.2f}' "
                    f"fill='{COLORS[names.index(r.grp) % len(COLORS)]}' fill-opacity='0.5'>"
                    f"<title>{html.escape(r.grp)}: {r.sites} sites at {r.bin_start}</title></rect>")
    legend = " ".join(f"<span style='color:{COLORS[i % len(COLORS)]}'>{html.escape(n)}</span>" for i, n in enumerate(names))
    return f"<p>{legend} (log2 counts)</p><svg width='{width}' height='{height}'>{''.join(bars)}</svg>"
