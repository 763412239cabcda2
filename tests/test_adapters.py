"""Adapter removal, exact subsampling and site lists with head lines."""

import hashlib
import random

import pytest

from locuswave.operators import adapters, sampling
from locuswave.params import Params
from locuswave.plans import pipeline
from locuswave.sinks import tables as sink
from locuswave.sources import tables

TURN = str.maketrans("ACGT", "TGCA")
PAIRS = "sample_id string, read_id string, seq1 string, qual1 string, seq2 string, qual2 string"


def brute(a, b):
    """Every fragment length by definition."""
    if not a or not b:
        return None
    turned, best = b.upper()[::-1].translate(TURN), None
    for size in range(1, len(a) + len(b) + 1):
        places = [i for i in range(len(a)) if 0 <= i - (size - len(b)) < len(b) and i < size]
        if len(places) >= 30:
            wrong = sum(a.upper()[i] != turned[i - size + len(b)] for i in places)
            if wrong <= min(5, int(len(places) * 0.2)):
                best = max(best or (), (len(places), -wrong, size))
    return best and (best[2], -best[1])


def pairs_of(rng):
    out = []
    for k in range(160):
        size = rng.choice([0, 4, 29, 30, 31, 45, 59, 60, 61, 80, 90, 91])
        fragment = "".join(rng.choice("ACGT") for _ in range(size))
        if k % 20 == 0:
            fragment = "AC" * (size // 2)  # agrees with itself at many lengths
        a = (fragment + "AGATCGGAAGAGC" * 6)[:rng.choice([60, 60, 40])]
        b = (fragment[::-1].translate(TURN) + "CTGTCTCTTATA" * 6)[:rng.choice([60, 60, 50, 3])]
        for _ in range(rng.choice([0, 0, 2, 5, 6])):
            at = rng.randrange(len(b))
            b = b[:at] + rng.choice("ACGTNacgt") + b[at + 1:]
        out.append(("s", f"r{k}", a, "I" * len(a), b, "#" * len(b)))
    return out + [("s", "none", "ACGT" * 15, "I" * 60, None, None), ("s", "empty", "", "", "", "")]


def test_overlap_equals_all_lengths(spark):
    rows = pairs_of(random.Random(1))
    got = adapters.with_inserts(spark.createDataFrame(rows, PAIRS)).collect()
    want = {r[1]: brute(r[2], r[4]) for r in rows}
    assert {r.read_id: None if r.insert_length is None else (r.insert_length, r.mismatches) for r in got} == want
    assert len([w for w in want.values() if w]) > 40


def test_trimmed_pairs(spark):
    rows = pairs_of(random.Random(2))
    for r in adapters.trim(spark.createDataFrame(rows, PAIRS)).collect():
        given = next(g for g in rows if g[1] == r.read_id)
        found = brute(given[2], given[4])
        size = found[0] if found else 10 ** 6
        assert (r.seq1, r.qual1) == (given[2][:size], given[3][:size])
        assert (r.seq2, r.qual2) == ((given[4][:size], given[5][:size]) if given[4] is not None else (None, None))
        assert r.trimmed_bases == sum(max(0, len(g) - size) for g in (given[2], given[4] or ""))


def test_preprocess_cuts_adapters(spark):
    rng = random.Random(3)
    fragment = "".join(rng.choice("ACGT") for _ in range(40))
    a, b = (fragment + "AGATCGGAAGAGC" * 2)[:60], (fragment[::-1].translate(TURN) + "CTGTCTCTTATA" * 2)[:60]
    pairs = spark.createDataFrame([("s", "r", a, "I" * 60, b, "I" * 60)], PAIRS)
    assert pipeline.preprocess(pairs, Params()).reads.first().seq1 == fragment
    assert pipeline.preprocess(pairs, Params(trim_adapters=False)).reads.first().seq1 == a


def test_subsample_is_the_smallest_hashes(spark):
    rows = [(s, f"r{k}", k) for s, n in (("a", 3000), ("b", 40), ("c", 41), ("d", 1)) for k in range(n)]
    frame = spark.createDataFrame(rows, "sample_id string, read_id string, other int").repartition(7)
    got = sampling.subsample(frame, 41, seed=5).collect()
    for sample in "abcd":
        ids = sorted((hashlib.md5(f"5:{r}".encode()).hexdigest(), r, k) for s, r, k in rows if s == sample)[:41]
        assert sorted((r.read_id, r.other) for r in got if r.sample_id == sample) == sorted((r, k) for _, r, k in ids)
    # Two rows of one read stay together.
    twice = frame.unionByName(frame)
    ids = [r.read_id for r in sampling.subsample(twice, 10).filter("sample_id = 'a'").collect()]
    assert len(ids) == 10 and all(ids.count(i) == 2 for i in ids)


SITES = "grp string, conc int, chrom string, pos bigint, note string, vals array<double>"


def test_site_lists_with_heads(spark, tmp_path):
    rows = [(f"g{c}", c, f"chr{k % 2}", k, 'a "b"\tc' if k % 3 else None, [k / 2, None, -1.0]) for c in (16, 64) for k in range(50)]
    sites = spark.createDataFrame(rows, SITES)
    sink.write_site_lists(sites, str(tmp_path / "lists"), ["chrom", "pos"])
    layout = sites.drop("grp", "conc").schema
    got = tables.read_site_lists(spark, [str(tmp_path / "lists")], layout)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows))

    head = "chrom\tpos\tnote\tvals\n"
    body = "chr1\t5\tx\t[1.0]\n"

    def listed(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    one = listed("one.tsv", "#identifier=g\n#concentration=4\n" + head + body)
    assert tables.read_site_lists(spark, [one], layout).first().concentration == 4
    for text, match in (("#identifier=g\n" + head + body, "no identifier or concentration"),
                        ("#identifier=g\n#concentration=x\n" + head + body, "no identifier or concentration"),
                        ("#identifier=g\n#concentration=4\n" + head + body, "more than one site list"),
                        ("#identifier=g\n#concentration=8\nchrom\tpos\n" + body, "other columns")):
        with pytest.raises(Exception, match=match):
            tables.read_site_lists(spark, [one, listed("two.tsv", text)], layout)
    with pytest.raises(ValueError, match="site listed twice"):
        tables.read_site_lists(spark, [listed("three.tsv", "#identifier=g\n#concentration=4\n" + head + body + body)], layout)
