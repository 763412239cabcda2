"""Mixing, whitening and conversation repair against brute force and their SQL twins."""

import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from check import compare, connect
from locuswave.llm import feast, mixing, repair, repair_align, whitening

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, source string, size string, other int"
TURNS = "conv_id bigint, turn bigint, role string, text string, cost string"
VECTORS = "vec_id bigint, embedding array<float>, n string"


def by_sql(tmp_path, spark, frames, sql):
    con = duckdb.connect()
    for name, frame in frames.items():
        frame.write.parquet(str(tmp_path / "twin" / name))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/twin/{name}/*.parquet'")
    return con.execute(sql).fetchdf()


# -- mixing --------------------------------------------------------------------------------------


def fill(sizes, weights, limit, total):
    """Shares by weight; what is above a limit is shared again."""
    out, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    while open_:
        left = total - sum(limit * sizes[s] for s in set(sizes) - open_)
        share = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if share * weights[s] > limit * sizes[s]}
        if not over:
            return out | {s: share * weights[s] for s in open_} | {s: limit * sizes[s] for s in set(sizes) - open_}
        open_ -= over
    return {s: float(limit * n) for s, n in sizes.items()}


DOC_ROWS = (
    [(k, " ".join(["w"] * (k % 7)), f"s{k % 3}", "x", k) for k in range(60)]
    + [(100, None, "s1", "x", 1), (None, "a b c\x1cd", None, "x", 1), (None, "", None, "x", 2), (7, "one two", "\U0001f600", "x", 3),
       (7, "one two", "\U0001f600", "x", 4), (8, "lone", "￿", "x", 1), (9, "\tq  r\n", "empty", "x", 1), (10, " ", "void", "x", 1)])


def test_mixing_takes_exact_budgets(spark):
    docs = spark.createDataFrame(DOC_ROWS, DOCS)
    got = mixing.mix(docs).collect()
    assert len(got) == len(DOC_ROWS) and {r.other for r in got if r.doc_id == 7} == {3, 4, 7}
    sizes = {}
    for _, text, source, *_ in DOC_ROWS:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = fill(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, 3, sum(sizes.values()))
    for s in names:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert all(math.isclose(r.target, want[s], abs_tol=1e-9) for r in mine)
        assert sum(r.epochs * r["size"] + r.last_words for r in mine) == math.floor(want[s] + 0.5)
        assert all(0 <= r.last_words <= r["size"] and r.epochs * r["size"] + r.last_words <= 3 * r["size"] for r in mine)
        # One document at most is cut inside.
        assert sum(0 < r.last_words < r["size"] for r in mine) <= 1
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mixing_other_budgets_and_readings(spark):
    docs = spark.createDataFrame(DOC_ROWS, DOCS)
    mixed = mixing.mix(docs, weights=(1.0,), max_epochs=2, total=90)
    read = mixing.readings(mixed).collect()
    for r in read:
        assert len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) == r.words
        given = next(t for d, t, s, _, o in DOC_ROWS if (d, s, o) == (r.doc_id, r.source, r.other))
        assert given.startswith(r.text)
    taken = sum(r.epochs * r["size"] + r.last_words for r in mixed.collect())
    assert sum(r.words for r in read) == taken and abs(taken - 90) <= 4
    # More than all sources may give: every source is read twice.
    assert {r.epochs for r in mixing.mix(docs, max_epochs=2, total=1e9).collect() if r.source_size} == {2}
    assert mixing.mix(docs.limit(0)).collect() == []


def test_mixing_twin(spark, tmp_path):
    docs = spark.createDataFrame(DOC_ROWS, DOCS).drop("size", "other")
    docs.write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    mine = mixing.op11_prefix_cut_mixing(spark, str(tmp_path / "sf")).toPandas()
    twin = by_sql(tmp_path, spark, {"documents": docs}, mixing.OP11_SQL)
    mine["doc_id"], twin["doc_id"] = mine["doc_id"].astype("float"), twin["doc_id"].astype("float")
    assert compare(mine, twin) == ""
    given = mixing.op11_prefix_cut_mixing(spark, SF).toPandas()
    assert len(given) == 200 and compare(given, connect(SF).execute(mixing.OP11_SQL).fetchdf()) == ""


# -- whitening -----------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(12))
def test_feast_equals_direct_eigenvalues(seed):
    rng = np.random.default_rng(seed)
    d, n = int(rng.integers(1, 24)), int(rng.integers(2, 40))
    x = rng.integers(-9, 9, (n, d)) * (rng.random(d) ** 4 if seed % 2 else 1)
    a = np.cov(x.T, bias=True).reshape(d, d)
    if seed == 3:  # all eigenvalues equal
        a = np.eye(d) * 2.5
    values, vectors = np.linalg.eigh(a)
    values = values[::-1]
    floor = 1e-14 * values[0]
    for shift in (values[0] * 0.7, values[-1] + 0.1, values[0] * 1.1, 0.01):
        if np.abs(values - shift).min() > 1e-9:
            assert feast.above(a, shift) == (values > shift).sum()
    got, made = feast.eigenpairs(a, 4, floor)
    assert len(got) == min(4, (values > floor).sum())
    assert np.allclose(got, values[:len(got)], rtol=1e-11)
    assert np.abs(a @ made - made * got).max() <= 1e-12 * values[0]
    assert np.allclose(made.T @ made, np.eye(len(got)), atol=1e-12)


def brute_whitening(rows, components=4):
    usable = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    ints = [(k, [math.floor(256 * float(np.float32(c))) for c in v]) for k, v in usable]
    fit = [list(v) for v in {tuple(v) for _, v in ints}]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, dtype=float) - np.array(sums) / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    keep = values > 1e-9
    values, vectors = values[keep], vectors[:, keep]
    out = []
    for k, v in ints:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        white = (np.array(v) - np.array(sums) / n) @ vectors / np.sqrt(values)
        out += [(k, i + 1, n, deviation, abs(white[i]), values[i] / np.trace(cov)) for i in range(len(values))]
    return sorted(out, key=repr)


def test_whitening_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0, s) for s in (3, 2, 1.5, 1, 0.1, 0.0)]) for k in range(50)]
    rows += [(60, rows[3][1]), (3, rows[3][1]), (None, rows[4][1]), (61, None), (62, [None] * 6), (63, [float("nan")] * 6),
             (64, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0]), (65, []), (66, [-0.0] * 6)]
    bad = [(70, [1.0, 2.0])]  # another length
    frame = spark.createDataFrame([(k, v, "x") for k, v in rows + bad], VECTORS)
    got = whitening.whiten(frame).collect()
    want = brute_whitening(rows)
    mine = sorted([(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got], key=repr)
    assert [m[:4] for m in mine] == [w[:4] for w in want]
    assert np.allclose([m[4:] for m in mine], [w[4:] for w in want], rtol=1e-9, atol=1e-9)
    assert max(r.identity_error for r in got) < 1e-9


def test_whitening_edges(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0], "x"), (2, [1.0, 2.0], "x")], VECTORS)
    assert whitening.whiten(frame).collect() == []
    assert whitening.whiten(frame.limit(0)).collect() == []
    # One direction only: one component, whatever is asked for.
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0], "x") for k in range(9)], VECTORS)
    assert {r.component for r in whitening.whiten(line).collect()} == {1}
    far = spark.createDataFrame([(1, [1e9, 0.0], "x"), (2, [-1e9, 0.0], "x"), (3, [1e9, 1.0], "x")], VECTORS)
    with pytest.raises(Exception, match="deviation beyond a long"):
        whitening.whiten(far).collect()


# -- conversation repair -------------------------------------------------------------------------


def brute_repair(turns):
    """All edit strings of a short conversation, by enumeration of states."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    seen, faults = set(), []
    for _, role, text in turns:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    for length in range(len(turns) + 3):
        for target in {"ua" * (length // 2)} if length % 2 == 0 else {"s" + "ua" * (length // 2)} if length > 1 else set():
            found = _enumerate(turns, faults, target)
            if found and (best is None or found[:2] < best[:2]):
                best = found
    known = {t for t, *_ in turns if t is not None}
    initials = [r[:1] for _, r, _ in turns]
    return (max(known) - min(known) + 1 - len(known) if known else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), best[0], best[1],
            hashlib.sha256("\n".join(best[2]).encode()).hexdigest())


def _enumerate(turns, faults, target):
    best = None
    stack = [(0, 0, 0, "", ())]
    while stack:
        i, j, cost, audit, out = stack.pop()
        if cost > 2 * len(turns) + 10:
            continue
        if i == len(turns) and j == len(target):
            best = min(best or (cost, audit, out), (cost, audit, out))
            continue
        if i < len(turns):
            stack.append((i + 1, j, cost + 2, audit + "D", out))
        if j < len(target):
            want = {"u": "user", "a": "assistant"}.get(target[j])
            if want:
                stack.append((i, j + 1, cost + 5, audit + "I", (*out, f"{want}:")))
            if i < len(turns) and faults[i] in ("", "t"):
                late = 5 * (faults[i] == "t")
                _, role, text = turns[i]
                if role[:1] == target[j]:
                    stack.append((i + 1, j + 1, cost + late, audit + "K", (*out, f"{role}:{text}")))
                if want:
                    stack.append((i + 1, j + 1, cost + 1 + late, audit + "R", (*out, f"{want}:{text}")))
    return best


def random_turns(rng, n):
    said = ["Yes.", "No!", "Why?", "cut off", "", " \t", "Yes. ", "fin. \n"]
    roles = ["user", "assistant", "system", "tool", "user", "assistant", "", " ", "unknown"]
    return [(rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(said)) for _ in range(n)]


def test_repair_equals_enumeration(spark):
    rng = random.Random(3)
    convs = {k: random_turns(rng, rng.randint(1, 5)) for k in range(60)}
    rows = [(k, t, r, x, "y") for k, turns in convs.items() for t, r, x in turns]
    frame = spark.createDataFrame(rows, TURNS)
    for local in (1024, 0, 2):
        got = repair.repair(frame, local).collect()
        assert {r.conv_id: tuple(r)[1:] for r in got} == {k: brute_repair(v) for k, v in convs.items()}


def test_blocks_equal_whole_alignment():
    rng = random.Random(8)
    for _ in range(30):
        symbols = "".join(rng.choice("suaxSUAX-ua") for _ in range(rng.randint(2, 14)))
        at = rng.randint(1, len(symbols) - 1)
        parts = [symbols[:at], symbols[at:]]
        whole = repair_align.chained(repair_align.block(p) for p in parts)
        assert whole == repair_align.block(symbols)
        ends = [whole[0, b] for b in repair_align.ENDS if (0, b) in whole]
        assert min(ends) == repair_align.conversation(symbols)


def test_long_conversation_in_pieces(spark):
    rng = random.Random(4)
    rows = [(1, k // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"t{k}.", "", f"c{k}"]), "y") for k in range(900)]
    frame = spark.createDataFrame(rows, TURNS)
    # A whole alignment of 900 turns is the yardstick: one state walk, turn by turn.
    got = repair.repair(frame, 10).collect()
    assert tuple(got[0])[1:] == walk([r[1:4] for r in rows])


def walk(turns):
    turns = sorted(turns)
    seen, marks, faults = set(), [], []
    for _, role, text in turns:
        mark, fault = repair.symbol(role, text, (role, text) in seen)
        seen.add((role, text))
        marks.append(mark)
        faults.append(fault)
    states = {0: (0, "")}

    def reach(into, state, found):
        if state not in into or found < into[state]:
            into[state] = found

    after = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
    for mark in [*marks, None]:
        for _ in range(2):
            for s, (c, e) in list(states.items()):
                reach(states, after[s][1], (c + 5, e + "I"))
        if mark is None:
            break
        now = {}
        for s, (c, e) in states.items():
            reach(now, s, (c + 2, e + "D"))
            if mark != "-":
                late = 5 * mark.isupper()
                if s == 0 and mark in "sS":
                    reach(now, 1, (c + late, e + "K"))
                letter, to = after[s]
                reach(now, to, (c + late, e + "K") if mark.lower() == letter else (c + late + 1, e + "R"))
        states = now
    cost, audit = min(states[s] for s in (0, 3) if s in states)
    digest = repair.Digest(audit)
    for _, role, text in turns:
        digest.turn(role, text)
    known = {t for t, *_ in turns}
    initials = [r[:1] for _, r, _ in turns]
    return (max(known) - min(known) + 1 - len(known), faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, digest.result())


def test_damage_nulls_and_empty(spark, tmp_path):
    rows = [(k % 30 if k % 11 else None, k // 30 if k % 7 else None, r, t, "y") for k, (r, t) in enumerate(
        itertools.islice(itertools.cycle(itertools.product(["user", "assistant", None, "system"], ["Hi. there!", None, "no end"])), 240))]
    frame = spark.createDataFrame(rows, TURNS).drop("cost")
    turns = repair.damaged(frame).collect()
    want = []
    for c, t, r, x in map(tuple, frame.collect()):
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if draw == 1 else re.sub("[.!?]", "", x) if draw == 2 else x
        want += [(c, t, "user" if draw == 4 else r, x)] * (draw != 0) * (1 + (draw == 3))
    assert sorted(map(repr, map(tuple, turns))) == sorted(map(repr, want))
    mine = repair.repair_damaged(frame).toPandas()
    twin = by_sql(tmp_path, spark, {"conversations": frame}, repair.OP13_SQL)
    mine["conv_id"], twin["conv_id"] = mine["conv_id"].astype("float"), twin["conv_id"].astype("float")
    assert compare(mine, twin) == ""
    assert repair.repair_damaged(frame.limit(0)).collect() == []
    lone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    gone = repair.repair_damaged(spark.createDataFrame([(lone, 0, "user", "Hi.", "y")], TURNS)).collect()
    assert [tuple(r) for r in gone] == [(lone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repair_query_twin(spark):
    mine = repair.op13_grammar_alignment_repair(spark, SF).toPandas()
    assert len(mine) and compare(mine, connect(SF).execute(repair.OP13_SQL).fetchdf()) == ""
