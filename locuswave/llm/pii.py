"""Personal data: fixed rules, and spans that a character-level BiLSTM-CRF adds.

Rules find emails, IP addresses, card and phone numbers in whole texts.  Where marks run together the rules drop
the whole match ("+1 ... 3296 4524..." is too long for either kind); the model, trained in numpy on rule spans of a
bounded sample of documents and on mixtures of them, finds the parts.  It reads overlapping windows; every
character takes its tag from the window in which it lies furthest inside, and spans are read from the tags of the
whole text.  A span of the model is added if it is valid for its kind and overlaps no other span.

All kinds hold a digit or an ``@``: windows without either are not read, as nothing could be found there.

Defined cases: a NULL text is empty and has no spans; without any span to learn from nothing is added.  Every
input row gives one row, NULL and repeated ids included.  Other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuswave.llm import pii_model
from locuswave.llm.common import table
from locuswave.llm.pii_model import KINDS, WINDOW

# The model's sample: documents with a digit or @ that come first by the hash of their id.
TRAIN_DOCS = 3_000
STEPS, BATCH, MIXED = 350, 32, 1_500
STRIDE = WINDOW // 2
DECODE_BATCH = 512
# Texts whose codes, tags and spans are held at once.
SLICE_TEXTS = 100

_MARK = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is tried at its beginning only: what fails there fails further on, too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MODEL_PHONE = re.compile(r"\+?[0-9(][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    number = digits(text)
    return 16 <= len(number) <= 19 and luhn(number)


def _is_phone(text: str) -> bool:
    return 8 <= len(digits(text)) <= 15


def rule_spans(text: str) -> list[Span]:
    """(kind, start, end) by the rules: leftmost, non-overlapping per kind; failing matches are dropped."""
    out: list[Span] = []
    if not _MARK.search(text):
        return out
    # The part before an @ goes back to the last character that cannot be in it, or to the match before.
    low, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        while domain and start > low and text[start - 1] in _LOCAL:
            start -= 1
        if domain and start < at:
            out.append((0, start, domain.end()))
            low = domain.end()
        at = text.find("@", max(at + 1, low))
    for kind, pattern, valid in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(m.group())]
    return out


def _valid(kind: int, text: str) -> bool:
    """Whether a model's span is a whole instance of its kind."""
    if kind == 0:
        return [s[:3] for s in rule_spans(text) if s[0] == 0] == [(0, 0, len(text))]
    pattern, valid = ((_IP, _is_ip), (_CARD, _is_card), (_MODEL_PHONE, _is_phone))[kind - 1]
    return bool(pattern.fullmatch(text)) and valid(text)


def _windows(text: str) -> list[int]:
    """Starts of the windows that hold a digit or @, a stride apart; the last window may end behind the text."""
    found: list[int] = []
    for m in _MARK.finditer(text):
        last = m.start() // STRIDE
        found += [k * STRIDE for k in (last - 1, last) if k >= 0 and (not found or k * STRIDE > found[-1])]
    return found


def _padded(codes: np.ndarray, start: int) -> np.ndarray:
    blank = pii_model.classes("\n")[0]
    part = codes[start:start + WINDOW]
    return np.concatenate([part, np.full(WINDOW - len(part), blank)]) if len(part) < WINDOW else part


def model_spans(texts: list[str], model: dict) -> list[list[Span]]:
    """The model's spans of each text, from windows decoded in batches and tags reconciled over the text."""
    places = [(k, s) for k, t in enumerate(texts) for s in _windows(t)]
    codes = {k: pii_model.classes(texts[k]) for k in {k for k, _ in places}}
    depth = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
    tags: dict[int, dict[int, tuple[int, int]]] = {}
    for at in range(0, len(places), DECODE_BATCH):
        some = places[at:at + DECODE_BATCH]
        for (k, start), path in zip(some, pii_model.decode(model, np.stack([_padded(codes[k], s) for k, s in some]))):
            own = tags.setdefault(k, {})
            for p in range(min(WINDOW, len(codes[k]) - start)):
                place, deep = start + p, int(depth[p])
                if start == 0 and p < STRIDE:
                    deep = WINDOW  # nothing lies before the text
                if own.get(place, (-1, 0))[0] < deep:
                    own[place] = (deep, int(path[p]))
    out: list[list[Span]] = []
    for k in range(len(texts)):
        own, spans = tags.get(k, {}), []
        run: list[int] = []
        for place in [*sorted(own), None]:
            if run and (place is None or place != run[-1] + 1):
                path = np.array([own[p][1] for p in run])
                spans += [(kind, run[0] + a, run[0] + b) for kind, a, b in pii_model.spans_of(path)]
                run = []
            if place is not None:
                run.append(place)
        out.append(spans)
    return out


def added(text: str, base: list[Span], found: list[Span]) -> list[Span]:
    out: list[Span] = []
    for kind, start, end in found:
        while start < end and text[start] in " \t\n":
            start += 1
        while end > start and text[end - 1] in " \t\n.,":
            end -= 1
        free = all(end <= a or b <= start for _, a, b in base + out)
        if free and _valid(kind, text[start:end]):
            out.append((kind, start, end))
    return out


def _labelled(texts: list[str], seed: int = 7) -> tuple[np.ndarray, np.ndarray] | None:
    """Windows and tags: around rule spans, around other digits, and mixtures of spans side by side."""
    rng = np.random.default_rng(seed)
    codes, tags, words, known = [], [], [], []
    for text in texts:
        spans = rule_spans(text)
        path = np.zeros(len(text), np.int64)
        for kind, a, b in spans:
            path[a:b], path[a] = 2 + 2 * kind, 1 + 2 * kind
            known.append((kind, text[a:b]))
        coded = pii_model.classes(text)
        centres = [a for _, a, _ in spans] + [m.start() for m in list(_MARK.finditer(text))[:200:40]]
        for centre in centres:
            start = max(0, centre - int(rng.integers(4, WINDOW - 8)))
            codes.append(_padded(coded, start))
            part = path[start:start + WINDOW]
            tags.append(np.concatenate([part, np.zeros(WINDOW - len(part), np.int64)]))
        words += text[:200].split()[1:4]
    if not known or not words:
        return None
    by = [[t for k, t in known if k == kind] for kind in range(len(KINDS))]
    kinds = [k for k in range(len(KINDS)) if by[k]]
    for _ in range(MIXED):
        text, path = "", []
        while len(text) < WINDOW + 20:
            if rng.random() < 0.5:
                kind = int(rng.choice(kinds))
                span = by[kind][int(rng.integers(len(by[kind])))]
                path += [1 + 2 * kind] + [2 + 2 * kind] * (len(span) - 1)
            else:
                span = words[int(rng.integers(len(words)))]
                path += [0] * len(span)
            text += span + " "
            path.append(0)
        start = int(rng.integers(0, len(text) - WINDOW + 1))
        codes.append(pii_model.classes(text)[start:start + WINDOW])
        tags.append(np.array(path[start:start + WINDOW]))
    return np.stack(codes), np.stack(tags)


def fit(texts: list[str]) -> dict | None:
    rows = _labelled(texts)
    return pii_model.train(*rows, STEPS, BATCH) if rows else None


def _fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = list(frames)
    if not parts:
        return
    sample = pd.concat(parts, ignore_index=True).sort_values(["place", "text"], kind="stable")
    yield pd.DataFrame({"model": [pickle.dumps(fit(list(sample["text"])))]})


def train(docs: DataFrame) -> bytes:
    """The model, fitted in one task on at most ``TRAIN_DOCS`` texts; its size is fixed."""
    marked = docs.filter(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("doc_id", "text").alias("place"))
    # Only hashes are sorted; the texts at or below the last of them are then read.
    last = marked.select("place").distinct().orderBy("place").limit(TRAIN_DOCS).agg(F.max("place")).first()[0]
    sample = marked.filter(F.col("place") <= last).dropDuplicates(["place"]) if last is not None else marked.limit(0)
    found = sample.coalesce(1).mapInPandas(_fit, "model binary").collect()
    return found[0]["model"] if found else pickle.dumps(None)


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _marked(frames: Iterator[pd.DataFrame], model: dict | None, clean: bool) -> Iterator[pd.DataFrame]:
    """The rows with their spans, some texts at a time: codes and tags take far more memory than the texts."""
    for frame in (whole.iloc[at:at + SLICE_TEXTS] for whole in frames for at in range(0, len(whole), SLICE_TEXTS)):
        texts = [t if t is not None else "" for t in frame["text"]]
        base = [rule_spans(t) for t in texts]
        more = model_spans(texts, model) if model else [[]] * len(texts)
        every = [b + added(t, b, m) for t, b, m in zip(texts, base, more)]
        frame = frame.assign(_base=[span_text(b) for b in base], _spans=[span_text(s) for s in every])
        if clean:
            frame["text"] = [None if raw is None else redact(t, s)
                             for raw, t, s in zip(frame["text"], texts, every)]
        yield frame if clean else frame.drop(columns="text")


def find(docs: DataFrame, clean: bool = False) -> DataFrame:
    """The given columns and base (rule spans), spans (all), in text form; with ``clean`` the text is redacted."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))
    fields = [f for f in docs.schema.fields if clean or f.name != "text"]
    return docs.mapInPandas(lambda frames: _marked(frames, pickle.loads(shared.value), clean),
                            T.StructType(fields).add("_base", "string").add("_spans", "string"))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of rule spans per kind, base_sha256, spans."""
    found = find(docs.select("doc_id", "text"))
    marks = F.split("_base", ",")
    counts = [F.size(F.filter(marks, _starts(k + ":"))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("_base"), 256).alias("base_sha256"), F.col("_spans").alias("spans"))


def _starts(prefix: str):
    return lambda m: m.startswith(prefix)


def redact_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with all spans in ``text`` replaced; the other columns stay as they are."""
    return find(docs, clean=True).select(docs.columns)


def op10_bilstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
