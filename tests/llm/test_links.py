"""Links within cells of near-duplicate candidates, ids of new pieces, and personal data text by text."""

import random

import numpy as np
import pandas as pd

from locuswave.llm import near_dedup, pii, range_coder, tokens
from locuswave.llm.tokens import PieceTokenizer


def cell(sets, component, block, lo, hi, region=1):
    return pd.DataFrame({
        "region": region, "lo": lo, "hi": hi, "block": block, "class_id": range(len(sets)), "component": component,
        "hashes": [np.array(sorted(s), np.uint64).tobytes() for s in sets]})


def find_groups(links, nodes):
    group = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    return group


def linked(x, y):
    return 5 * len(x & y) >= 4 * len(x | y)


def test_a_cell_hands_on_no_more_links_than_join_its_components(monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL_ENTRIES", 1_000)  # several parts of the matrix
    rng = random.Random(4)
    base = list(range(40))
    # Similarities of all sizes, most of them below 0.8, in one group.
    sets = [{v if rng.random() > k / 400 else 1000 + rng.randrange(10**6) for v in base} for k in range(120)]
    want = find_groups([(i, j) for i in range(120) for j in range(i) if linked(sets[i], sets[j])], range(120))
    assert 1 < len(set(want.values())) < 120
    rows = cell(sets, list(range(120)), 0, 0, 0)
    got = pd.concat(near_dedup._crossing(iter([rows[:50], rows[50:]])))
    assert all(linked(sets[a], sets[b]) and a < b for a, b in zip(got["a"], got["b"]))
    assert len(got) == 120 - len(set(want.values()))
    assert find_groups(list(zip(got["a"], got["b"])), range(120)) == want
    # Nothing is left to join if the components are known.
    assert not len(pd.concat(near_dedup._crossing(iter([cell(sets, [want[k] for k in range(120)], 0, 0, 0)]))))


def test_two_blocks_are_compared_with_each_other_only():
    sets = [set(range(10)), set(range(10)), set(range(10)), {77}, {77}, set(range(50, 60))]
    got = pd.concat(near_dedup._crossing(iter([cell(sets, [0, 1, 2, 3, 4, 5], [0, 0, 1, 1, 1, 0], 0, 1)])))
    assert set(zip(got["a"], got["b"])) == {(0, 2), (1, 2)}


def test_new_pieces_are_one_text_to_the_tokenizer():
    rng = random.Random(6)
    signs = [*"ab 'st.,  \n\t\x01\x1c\x1f\x00éΣσß́​　\xa0中09_-<|>", "<|endoftext|>", "'re", " \n", " \x01 ", "Ċ", "\x01"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(600)] + [None, "", "\x01", " "]
    for file, white_space_counts in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        source = PieceTokenizer(file, white_space_counts)
        want = [source.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [list(i) for i in source.ids(texts)] == want
        # Plain new words are not handed over one by one.
        alone, source.known = [], {}
        source._alone = lambda new: alone.extend(new) or {}
        plain = [f"word{k} other{k * k}x" for k in range(50)]
        want = [source.tokenizer.encode(t, add_special_tokens=False).ids for t in plain]
        assert [list(i) for i in source.ids(plain)] == want and not alone


def test_kept_pieces_are_bounded_and_ids_stay_right():
    source = PieceTokenizer("word_bpe_49k.json", False)
    texts = [" ".join(f"w{k}x{j}" for j in range(500)) for k in range(500)]
    found = source.ids(texts)
    assert len(source.known) <= 200_000
    for k in (0, 450, 499):
        assert list(found[k]) == source.tokenizer.encode(texts[k], add_special_tokens=False).ids


def test_regions_with_the_same_members_are_compared_once(spark):
    first, other = bytes(range(256)) * 2, bytes(range(255, -1, -1)) * 2
    # The last two share only the first four minima, which is a region of the first order alone.
    sigs = [first, first, first, other[:16] + bytes(496), other[:16] + bytes([7]) * 496]
    classes = spark.createDataFrame(
        [(k, bytearray(s), bytearray([k])) for k, s in enumerate(sigs)], "class_id long, sig binary, digest binary")
    labels = spark.createDataFrame([(1, 0)], "node long, component long")
    cells = near_dedup.mixed_cells(classes, labels).collect()
    groups = {}
    for c in cells:
        groups.setdefault((c.region, c.lo, c.hi), set()).add((c.class_id, c.component))
    assert sorted(map(sorted, groups.values())) == [[(0, 0), (1, 0), (2, 2)], [(3, 3), (4, 4)]]


def test_personal_data_is_searched_for_in_few_texts_at_a_time(monkeypatch):
    sizes = []
    monkeypatch.setattr(pii, "model_spans", lambda texts, model: sizes.append(len(texts)) or [[] for _ in texts])
    texts = [None, "", "mail a@b.cd now"] + [f"call +4930123456{k:03d}" for k in range(700)]
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    out = pd.concat(pii._marked(iter([frame, frame[:1], frame[:0]]), {"any": 0}, True))
    assert max(sizes) <= 200 and sum(sizes) == len(texts) + 1
    assert list(out["doc_id"]) == [*range(len(texts)), 0]
    assert list(out["text"])[:4] == [None, "", "mail [email] now", "call [phone]"]
    assert list(out["_spans"])[1:4] == ["", "email:5:11", "phone:5:19"]


def test_letters_go_straight_to_the_model_and_marks_apart():
    texts = ["Straße élève ÀÉÎ Ñandú, naïve!! word&&& it's. 'tis don't; (x) a1. µm ªº ×÷ ÿ... Ǆ ﬁ é é, .,. ?x", " a  b.\n\nc.", ".", " ,"]
    for file, white_space_counts in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        source = PieceTokenizer(file, white_space_counts)
        assert source.short_way
        want = [source.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [list(i) for i in source.ids(texts)] == want
        source.short_way = False
        assert [list(i) for i in source.ids(texts)] == want
        # Nothing but the marks is left to the whole tokenizer once letters are known to be words.
        source.short_way, handed = True, []
        source._alone = lambda new: handed.extend(new) or {}
        source.tokenizer = None
        source.known = {m: b"\1\0\0\0" for m in (",", "!!")}
        source.ids(["river, stone!! lamp"])
        assert not handed


def test_words_that_repeat_are_kept_before_others(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 5)
    source = PieceTokenizer("byte_bpe_50k.json", True)
    texts = ["".join(f" once{chr(97 + k)}" for k in range(20)) + " river." * 3 + " stone" * 3]
    want = source.tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert list(source.ids(texts)[0]) == want == list(source.ids(texts)[0])
    assert {" river", " stone"} <= set(source.known) and len(source.known) <= 5


def test_slices_of_texts_are_bounded_by_characters(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_CHARS", 10)
    monkeypatch.setattr(tokens, "SLICE_TEXTS", 3)
    assert list(tokens.slices(["a" * 12, None, "b", "c", "", "d" * 9, "e", None])) == [(0, 1), (1, 4), (4, 7), (7, 8)]
    assert list(tokens.slices([])) == []


def test_kinds_of_ids_are_counted_or_sorted_alike(monkeypatch):
    ids = np.random.default_rng(3).integers(0, 5000, 4000).astype(np.uint32)
    counted = range_coder._kinds(ids)
    monkeypatch.setattr(range_coder, "COUNTED", 0)
    for a, b in zip(counted, range_coder._kinds(ids)):
        assert np.array_equal(a, b)
    high = np.array([2**32 - 1, 7, 2**32 - 1], np.uint32)
    assert np.array_equal(range_coder.decode(range_coder.encode(high)), high)
