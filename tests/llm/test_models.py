"""Near-dedup, toxicity, packing, token files, language, personal data and the pipeline against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import queries
from locuswave.llm import langid, near_dedup, packing, pii, range_coder, token_files, toxicity
from locuswave.llm.components import components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, score string, held_out int, ids int"


def docs_of(spark, rows):
    """Rows (doc_id, text, lang) with further columns whose names clash with those of the operators."""
    return spark.createDataFrame([(d, t, lang, "own", 5, 6) for d, t, lang in rows], SCHEMA)


def plain(spark, texts):
    return docs_of(spark, [(k, t, "en") for k, t in enumerate(texts)])


ODD = [None, "", " \n", "x", "same text here", "same text here", "long " * 30_000, "été ß 😀\x00\x85", "  a"]


def find_groups(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_of_paths_stars_and_nothing(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 300)] + [(5, 5), (9, 8), (8, 9)]
    links += [(rng.randrange(400, 900), rng.randrange(400, 900)) for _ in range(350)]
    want = find_groups(links, {n for pair in links for n in pair})
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: c for n, c in want.items() if n != c}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    return {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(90)) for _ in range(120)) for _ in range(12)]
    rows = [(k, t, "en") for k, t in enumerate(ODD)] + [(None, "no id at all", "en"), (None, "no id at all", "en")]
    for k in range(160):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = "new" + str(rng.randrange(9))
        rows.append((100 + k, " ".join(words).upper() if k % 3 else " ".join(words), "en"))
    rows.append((100, rows[-1][1], "de"))  # an id twice
    sets = [(d, brute_shingles(t)) for d, t, _ in rows if d is not None]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if x and y and 5 * len(x & y) >= 4 * len(x | y)]
    want = find_groups(links, {d for d, _ in sets})
    out = near_dedup.near_duplicates(docs_of(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.kept and r.component_id is None if r.doc_id is None else (
            r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id])), r
    assert Counter((r.doc_id, r.n_shingles) for r in out) == Counter((d, len(brute_shingles(t))) for d, t, _ in rows)
    kept = near_dedup.drop_duplicates(docs_of(spark, rows))
    assert {r.doc_id for r in kept.collect()} == {d for d, c in want.items() if d == c} | {None}
    assert near_dedup.near_duplicates(plain(spark, [])).count() == 0


def test_large_regions_are_split_and_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "REGION", 4)
    rng = random.Random(8)
    words = [f"w{k}" for k in range(100)]
    texts = []
    for _ in range(60):
        own = list(words)
        for _ in range(rng.randrange(1, 4)):
            own[rng.randrange(100)] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    sets = list(enumerate(map(brute_shingles, texts)))
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if 5 * len(x & y) >= 4 * len(x | y)]
    want = find_groups(links, range(60))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(plain(spark, texts)).collect()}
    assert got == want


def test_toxicity_learns_held_out_words(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(600):
        bad = k % 3 == 0
        words = [rng.choice("lorem ipsum dolor sit amet magna".split()) + str(rng.randrange(30)) for _ in range(40)]
        if bad:
            words[rng.randrange(40)] = words[rng.randrange(40)] = rng.choice(["vile", "rotten"])
        rows.append((k, " ".join(words), "en"))
        labels.append((k, 1, int(bad)))
    labels += [(1, 1, None), (None, 1, 1), (3, 1, 1), (3, 1, 1)]
    rows += [(1000 + k, t, "en") for k, t in enumerate(ODD)] + [(None, "vile rotten", "en")]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs_of(spark, rows), known).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in out if r.held_out and r.doc_id < 600]
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) / len(held) > 0.95
    # Held-out labels change nothing.
    lying = known.withColumn("toxic", known.toxic).filter("doc_id IS NULL OR crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 <> 1")
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs_of(spark, rows), lying).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in out)
    nothing = toxicity.toxicity(docs_of(spark, rows[:5]), known.limit(0)).collect()
    assert [r.score for r in nothing] == [0.0] * 5
    kept = toxicity.drop_toxic(docs_of(spark, rows), known)
    assert kept.columns == docs_of(spark, []).columns and kept.filter("score <> 'own'").count() == 0
    assert toxicity.toxicity(docs_of(spark, []), known).count() == 0


def test_best_fit_equals_piece_by_piece():
    rng = random.Random(4)
    for _ in range(40):
        lengths = [rng.randint(1, rng.choice([1024, 300, 40])) for _ in range(rng.randint(0, 800))]
        open_windows, used = [], 0
        for n in sorted(lengths, reverse=True):
            fit = min((c for c in open_windows if c >= n), default=None)
            if fit is None:
                used, fit = used + 1, packing.WINDOW
            else:
                open_windows.remove(fit)
            open_windows.append(fit - n)
        filled = defaultdict(list)
        for n, lo, hi, first, each, base in packing.best_fit_decreasing(dict(Counter(lengths))):
            for r in range(hi - lo):
                filled[first + r // each].append((base + r % each * n, n))
        assert sorted(n for v in filled.values() for _, n in v) == sorted(lengths) and len(filled) == used
        for v in filled.values():
            at = 0
            for offset, n in sorted(v):
                assert offset == at
                at += n
            assert at <= packing.WINDOW


def tokenizer_of(file):
    import public_tokenizers

    made = Tokenizer.from_file(public_tokenizers.path(file))
    made.encode_special_tokens = True
    return made


TRICKY = ["don't  I'll we've.\x1c.\x1c", "éx ́y", "ΑΣ Σ ΟΔΟΣ", "<|endoftext|> hi", "   lead", "trail.,  ", "①² x9Ⅷ",
          "\x85a\x85 b", "İstanbul", "a\r\nb\r\n\r\nc...", "w" * 300 + ". ", "１２ ３"]


def test_packed_pieces_are_the_documents_ids(spark):
    texts = ODD + TRICKY
    made = tokenizer_of(packing.TOKENIZER)
    want = {k: np.array([*made.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for k, t in enumerate(texts)}
    out = packing.pack(plain(spark, texts)).collect()
    got, seq = defaultdict(dict), defaultdict(list)
    for r in out:
        got[r.doc_id][r.start] = np.frombuffer(r.ids, "<u4")
        seq[r.sequence_id].append((r.offset, r.length))
        assert r.length == len(r.ids) // 4 and r.doc_tokens == len(want[r.doc_id])
    for k, ids in want.items():
        assert (np.concatenate([got[k][s] for s in sorted(got[k])]) == ids).all()
    for v in seq.values():
        ends = [0, *np.cumsum([n for _, n in sorted(v)])]
        assert [o for o, _ in sorted(v)] == ends[:-1] and ends[-1] <= packing.WINDOW
    assert packing.pack(plain(spark, [])).count() == 0


def test_range_coder_round_trips_and_finds_damage():
    rng = np.random.default_rng(6)
    for n in (1, 2, 127, 128, 129, 5000):
        for ids in (rng.integers(0, 49_408, n), np.zeros(n, int), np.tile(rng.integers(0, 50_000, 31), n)[:n], rng.zipf(1.4, n) % 999):
            data = range_coder.encode(ids.astype(np.uint32))
            assert (range_coder.decode(data) == ids).all()
    assert len(range_coder.encode(np.tile(rng.integers(0, 49_408, 50), 400).astype(np.uint32))) < 20_000 * 2 // 3
    for at in (20, len(data) // 2, len(data) - 3):
        broken = bytearray(data)
        broken[at] ^= 0x55
        with pytest.raises((ValueError, zlib.error)):
            range_coder.decode(bytes(broken))


def test_token_files_give_all_ids_back(spark, monkeypatch):
    rows = [(k * 3 % 41, t, "en") for k, t in enumerate(ODD + TRICKY)] + [(None, "a null id", "en"), (3, "again", "en")]
    made = tokenizer_of(token_files.TOKENIZER)
    out = sorted(token_files.read(token_files.write(docs_of(spark, rows))).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == sorted((d for d, _, _ in rows), key=lambda d: (d is not None, d))
    at, texts = 0, defaultdict(list)
    for d, t, _ in rows:
        texts[d].append([*made.encode(t or "", add_special_tokens=False).ids, token_files.END])
    for r in out:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids) and ids in texts[r.doc_id]
        texts[r.doc_id].remove(ids)
        at += len(ids)
    assert token_files.read(token_files.write(plain(spark, []))).count() == 0


def test_language_of_held_out_texts(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    more = [(10_000 + k, t, None) for k, t in enumerate([None, "", "12 34 ... ²", "Ω"])] + [(None, "the and of", "en")]
    out = {r.doc_id: r for r in langid.language_id(docs_of(spark, rows + more)).collect()}
    held = [(d, lang) for d, _, lang in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert {d for d, _ in held} == {d for d, r in out.items() if r.held_out and d is not None and d < 10_000}
    assert sum(out[d].lang_pred == lang for d, lang in held) / len(held) > 0.9
    assert [out[10_000 + k].lang_pred for k in range(3)] == ["und"] * 3 and out[10_003].lang_pred != "und"
    assert not out[None].held_out and all(0 <= r.score <= 1 for r in out.values())
    nothing = langid.language_id(docs_of(spark, [(1, "a text", None)])).collect()
    assert nothing[0].lang_pred == "und" and nothing[0].score == 0
    assert langid.language_id(docs_of(spark, [])).count() == 0


def test_every_language_is_a_class(spark, monkeypatch):
    rng = random.Random(12)
    words = {f"l{k:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for k in range(70)}
    rows = [(len(words) * n + k, " ".join(rng.choice(words[lang]) for _ in range(30)), lang)
            for n in range(20) for k, lang in enumerate(words)]
    rows.append((9000, "qqxz wwxz qqxz wwxz eexz", "zz"))  # a language of one labelled row
    assert zlib.crc32(b"9000") % 5 and len(words) > langid.LANGUAGES
    for each in (langid.PER_LANGUAGE, 2):
        monkeypatch.setattr(langid, "PER_LANGUAGE", each)
        out = {r.doc_id: r for r in langid.language_id(docs_of(spark, rows)).collect()}
        assert {r.lang_pred for r in out.values()} == {*words, "zz"}
        assert sum(out[d].lang_pred == lang for d, _, lang in rows if out[d].held_out) / sum(r.held_out for r in out.values()) > 0.9


def brute_rules(text):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    valid = [lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")),
             lambda s: 16 <= len(pii.digits(s)) <= 19 and pii.luhn(pii.digits(s)), lambda s: 8 <= len(pii.digits(s)) <= 15]
    return [(k, m.start(), m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, text) if valid[k](m.group())]


def test_rules_equal_the_patterns():
    rng = random.Random(9)
    for _ in range(4000):
        text = "".join(rng.choice("a.B-@1234 +()%_é") for _ in range(rng.randrange(40)))
        assert pii.rule_spans(text) == brute_rules(text), text
    for text in ("a@b.c@d.e f@g.h.", "1.2.3.4.5.6.7.8.9", "256.1.1.1 01.02.03.004", "4111 1111 1111 1111", "+1 (269) 555-3296 45"):
        assert pii.rule_spans(text) == brute_rules(text)
    assert pii.rule_spans("7" * 200_000 + "a" * 200_000 + "@") == []


def test_model_adds_what_runs_together(spark):
    cards = [c for c in (f"4{k:015d}" for k in range(10**9, 10**9 + 4000, 7)) if pii.luhn(c)]
    rng = random.Random(1)
    texts = []
    for k in range(400):
        words = [rng.choice("the of and river stone light paper".split()) for _ in range(30)]
        words[10] = [f"u{k}.x@mail{k % 9}.example.com", f"{k % 200}.7.{k % 99}.12", cards[k % len(cards)],
                     f"+1 ({200 + k}) 555-{1000 + k}"][k % 4]
        texts.append(" ".join(words))
    texts += [f"see {cards[1]} {cards[2]} here", None, "", "a 4.0 b", "no marks"]
    out = {r.doc_id: r for r in pii.personal_data(plain(spark, texts)).collect()}
    for k in range(400):
        assert out[k].spans and sum(out[k][f"n_{x}"] for x in pii.KINDS) == 1
    both = out[400]
    assert both.n_card == 0 and both.spans == "card:4:20,card:21:37"
    assert [out[k].spans for k in (401, 402, 403, 404)] == [""] * 4
    clean = {r.doc_id: r for r in pii.redact_documents(plain(spark, texts)).collect()}
    assert clean[400].text == "see [card] [card] here" and clean[401].text is None and clean[404].text == "no marks"
    assert pii.redact_documents(plain(spark, texts)).columns == plain(spark, []).columns
    assert pii.personal_data(plain(spark, [])).count() == 0
    assert pii.personal_data(plain(spark, ["no marks", None])).filter("spans = ''").count() == 2


def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark):
    import corpus_pipeline

    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    now = docs
    for name, step in corpus_pipeline.STAGES:
        now = step(spark, now, SF)
        if name != "packing":
            assert now.columns == docs.columns
        kept[name] = {r.doc_id for r in now.select("doc_id").collect()}
    bad = {r.doc_id for r in toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()}
    assert kept["toxicity"] == {r.doc_id for r in docs.collect()} - bad
    rest = docs.filter(docs.doc_id.isin(list(kept["toxicity"])))
    assert kept["near_dedup"] == {r.doc_id for r in near_dedup.near_duplicates(rest).filter("kept").collect()}
    assert kept["pii"] == kept["decontamination"] == kept["packing"]
    total = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in total.collect()} == kept["packing"]


@pytest.mark.parametrize("name", ["op3_toxicity_ftrl", "op4_near_duplicates", "op8_string_kernel_language", "op10_bilstm_crf_pii"])
def test_queries_give_a_row_per_document(spark, name):
    assert queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
