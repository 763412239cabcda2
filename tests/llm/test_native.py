"""Preference formatting, decontamination, license scan and quality ledger: SQL twins and edge cases."""

import re

import pytest

from __spark_entry__ import oracle_sql, queries
from check import compare, connect
from locuswave.llm import decontaminate, licenses, preference, quality

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_preference_pairs", "op2_template_leaks", "op7_license_scan", "op9_quality_ledger"])
def test_query_equals_sql(spark, name):
    mine = queries()[name](spark, SF).toPandas()
    assert len(mine) and compare(mine, connect(SF).execute(oracle_sql()[name]).fetchdf()) == ""


def pairs(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string, block int, prompt string")


def test_common_turns_become_the_prompt(spark):
    rows = [(1, s, t, r, x, 9, "clash") for s, t, r, x in [
        ("chosen", 0, "user", "hi"), ("chosen", 1, "assistant", "yes"),
        ("rejected", 0, "user", "hi"), ("rejected", 1, "assistant", "no"), ("rejected", 2, "user", None)]]
    row, = preference.format_pairs(pairs(spark, rows + rows)).collect()  # repeated rows count once
    assert row.prompt == "<|user|>\nhi<|end|>\n" and row.prefix_turns == 1
    assert row.chosen == "<|assistant|>\nyes<|end|>\n" and row.chosen_spans == "14:25"
    assert row.chosen[14:25] == "yes<|end|>\n"
    assert row.rejected == "<|assistant|>\nno<|end|>\n<|user|>\n<|end|>\n"


def test_preference_edge_cases(spark):
    rows = [(None, "chosen", 0, "user", "x", 0, ""), (2, "chosen", None, "user", "x", 0, ""), (3, "other", 0, "user", "x", 0, ""),
            (4, "chosen", 0, None, "same", 0, ""), (4, "rejected", 0, None, "same", 0, ""), (5, "chosen", 0, "user", "only", 0, "")]
    out = {r.pair_id: r for r in preference.format_pairs(pairs(spark, rows)).collect()}
    assert set(out) == {4, 5}
    assert out[4].prompt == "<|unknown|>\nsame<|end|>\n" and out[4].chosen == out[4].rejected == ""
    assert out[5].prompt == "" and out[5].rejected == "" and "only" in out[5].chosen
    assert preference.format_pairs(pairs(spark, [])).count() == 0


def test_long_conversations_keep_one_cut(spark):
    rows = [(1, s, t, "assistant", "x" if t != 70 or s == "chosen" else "y", 0, "") for s in ("chosen", "rejected") for t in range(200)]
    out = {r.block: r for r in preference.format_pairs(pairs(spark, rows)).collect()}
    assert sorted(out) == [0, 1, 2, 3] and [out[b].prefix_turns for b in range(4)] == [64, 6, 0, 0]
    assert out[3].chosen_spans.count(",") == 7


def docs_of(spark, texts):
    return spark.createDataFrame(
        [(k, t, "slots", 7) for k, t in enumerate(texts)], "doc_id long, text string, item_id string, n_words int")


ITEM = ("A farmer named Tom sells 12 boxes of apples weighing 5 kg each at the market, while Anna buys 7 boxes; "
        "how many boxes does the farmer named Tom have left after the market closes?")


def test_templates_with_consistent_slots(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, "too short"), (1, ITEM)], "item_id long, text string")
    renamed = ITEM.replace("Tom", "Lee").replace("Anna", "Eve").replace("12", "30").replace("7", "9")
    mixed = ITEM.replace("named Tom sells", "named Lee sells").replace("named Tom have", "named Max have")
    found = decontaminate.leaks(docs_of(spark, [
        "Before. " + ITEM + " After.", renamed, mixed, None, "", "12 5 7 12 5 7 12 5 7 12", "word " * 5000]), bench).collect()
    by = {r.doc_id: r for r in found}
    assert set(by) - {2} == {0, 1} and by[1].slotted > 0 and all(r.item_id == 1 for r in found)
    assert 2 not in by or by[2].slotted == 0  # Tom cannot be Lee and Max
    assert decontaminate.leaks(docs_of(spark, []), bench).count() == 0
    assert decontaminate.leaks(docs_of(spark, [ITEM]), bench.limit(0)).count() == 0
    kept = decontaminate.drop_leaked(docs_of(spark, [ITEM, "clean text", None]), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2] and kept.columns == ["doc_id", "text", "item_id", "n_words"]


LONG = " ".join(f"{a}{b}" for a in "plain river stone paper light cloud".split() for b in "abcdefghij")
SHORT = "every small lamp in our old house burns less oil than those of the neighbours do"


def test_passages_find_edited_and_partial_items(spark):
    def edited(text, *places):
        return " ".join("changed" if k in places else w for k, w in enumerate(text.split()))

    bench = spark.createDataFrame([(1, LONG), (2, SHORT), (3, "too short")], "item_id long, text string")
    texts = ["before " + " ".join(LONG.split()[20:45]) + " after", edited(LONG, 5, 14, 23, 32, 41, 50), edited(SHORT, 5, 11),
             "too short " + " ".join(LONG.split()[:9]), " ".join(SHORT.split()[:5]), None, ""]
    assert {(r.doc_id, r.item_id) for r in decontaminate.passages(docs_of(spark, texts), bench).collect()} == {(0, 1), (1, 1), (2, 2)}
    assert {r.doc_id for r in decontaminate.drop_leaked(docs_of(spark, texts), bench).collect()} == {3, 4, 5, 6}
    assert decontaminate.passages(docs_of(spark, []), bench).count() == 0
    assert decontaminate.passages(docs_of(spark, texts), bench.limit(0)).count() == 0


def test_passages_part_runs_at_clashing_names_only(spark):
    bench = spark.createDataFrame([
        (1, "today Tom has 5 apples and buys 3 more, how many apples does Tom have"),
        (2, "we put 3 apples into 3 boxes and then sell 9 boxes for 7 coins in all"),
        (3, ITEM)], "item_id long, text string")
    texts = ["today Ann has 4 apples and buys 4 more, how many apples does Ann have",
             "we put 4 apples into 7 boxes and then sell 2 boxes for 2 coins in all",
             ITEM.replace("Tom have", "Max have"),
             "today Tom has 5 apples and Eva eats Tom has 5 apples"]
    found = {(r.doc_id, r.item_id): r for r in decontaminate.passages(docs_of(spark, texts), bench).collect()}
    assert set(found) == {(0, 1), (1, 2), (2, 3)}
    assert found[0, 1].longest == found[0, 1].n_words and found[1, 2].longest == found[1, 2].n_words
    assert found[2, 3].longest < found[2, 3].n_words  # Tom cannot be Tom and Max in one run
    assert decontaminate.drop_leaked(docs_of(spark, texts), bench).count() == 1


def test_passages_take_numbers_and_names_as_one_slot(spark):
    item = "they drove 12 km from Paris to see 7 friends who paid 30 euros each for 2 rooms in Rome"
    dense = "row 1 2 3 4 gives 5 6 7 8 then 9 10 11 12 and 13 14 15 16 makes 17 18 19 20 total 21"
    bench = spark.createDataFrame([(1, item), (2, dense)], "item_id long, text string")
    texts = ["they drove 1,200 km from New York to see 2.5 friends who paid 1,000.50 euros each for 3 rooms in San Juan Bautista",
             "they drove 12 km from O'Neill to see 7 friends who paid 30 euros each for 2 rooms in Stratford-Upon Avon",
             dense.replace("1", "8").replace("4", "2.5"), "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20"]
    found = {(r.doc_id, r.item_id): r for r in decontaminate.passages(docs_of(spark, texts), bench).collect()}
    assert set(found) == {(0, 1), (1, 1), (2, 2)}
    assert all(r.longest == r.n_words for r in found.values())


def test_license_texts_inside_and_beside(spark):
    mit = next(t for n, t in licenses.LICENSES if t.startswith("Permission is hereby granted, free"))
    broken = mit.replace("merge", "weld", 1)
    found = licenses.scan(docs_of(spark, [
        "x " * 3000 + mit + " y" * 50, "Some text. Released under the MIT License. More.", broken, None, "", "a b",
        "Licensed under CC BY-NC 4.0."])).collect()
    got = {(r.doc_id, r.license) for r in found}
    assert got == {(0, "MIT"), (1, "MIT"), (2, "MIT"), (6, "CC-BY-NC-4.0")}
    assert next(r for r in found if r.doc_id == 0).matched == next(r for r in found if r.doc_id == 0).n_shingles
    assert licenses.scan(docs_of(spark, [])).count() == 0


def brute_quality(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in quality.SYMBOLS),
            len(lines) - len(set(lines)), len(covered))


def test_quality_against_brute_force(spark):
    texts = [None, "", " \n\t", "one", "a b c d e a b c d e", "x y " * 40, "l1 a\nl1 a\n\nl2\n", "été # $ %\x0b\x0cß 😀 \x85 b",
             "a b c d e f a b c d e f g a b c d e", "w " * 20000]
    rows = quality.quality_ledger(docs_of(spark, texts)).collect()
    by = {r.doc_id: r for r in rows}
    for k, t in enumerate(texts):
        r = by[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(t), t
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.quality_ledger(docs_of(spark, [])).count() == 0


def test_policies_and_ablation_read_the_ledger(spark):
    book = quality.ledger(docs_of(spark, ["short", "a # b # c # d # e # f", "w " * 60, None]))
    rows = {r.rule: r for r in quality.ablation(book, quality.POLICIES["v2"]).collect()}
    names = list(quality.RULE_NAMES)
    assert sorted(rows) == sorted(names) and [n for n, _ in quality.rules()] == names
    bits = [r.fail_bits for r in book.collect()]
    for name, r in rows.items():
        assert r.rejected == sum(bool(b & quality.BIT[name]) for b in bits)
        assert r.rejected_without == sum(bool(b & ~quality.BIT[name]) for b in bits)


def test_leaks_are_dropped_by_row(spark):
    bench = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    rows = [(None, f"before {LONG} after"), (None, "a clean text without an id"), (None, None), (5, LONG), (5, "another clean text"),
            (6, f"before {LONG} after")]
    kept = decontaminate.drop_leaked(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [rows[1], rows[2], rows[4]]))
