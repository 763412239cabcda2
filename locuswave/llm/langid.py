"""Language ID by string kernels: blended n-gram presence, Nystroem landmarks, one-versus-rest kernel ridge regression.

The kernel of two texts is the number of n-grams (one to ``ORDERS`` characters, hashed into 2 ** ``BITS`` places)
that both hold, over the geometric mean of their own numbers.  ``LANDMARKS`` sample texts span the feature space;
the ridge solution folds into one matrix, so a batch of texts is scored by two matrix products.

Every lang value is a class.  The model is fitted on about ``PER_LANGUAGE`` training rows of each, chosen by the hash
of their id; with more than ``LANGUAGES`` values each has fewer, but at least its first, so the sample stays bounded.
Scoring reads every whole text once.

Defined cases: a NULL text or one without a letter is ``und`` with score 0, as is every text when nothing could be
learned.  Rows with a NULL lang are not learned from; a NULL doc_id is never held out.  Ties go to the language
that sorts first.  Other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswave.llm.common import table
from locuswave.llm.toxicity import remainder
from locuswave.session import bounded_side, stage

BITS, ORDERS = 14, 3
PER_LANGUAGE, LANGUAGES, LANDMARKS = 400, 64, 128
SHARE_BASIS = 1_000_000
RIDGE = 1e-2
BATCH = 64

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def presence(text: str) -> np.ndarray:
    """0/1 for each hashed n-gram of the whole lower-cased text."""
    row = np.zeros(1 << BITS, np.float32)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    gram = np.zeros(len(c), np.uint32)
    with np.errstate(over="ignore"):
        for n in range(1, ORDERS + 1):
            if len(c) < n:
                break
            gram = (gram[:len(c) - n + 1] ^ np.uint32(n)) * np.uint32(0x9E3779B1) + c[n - 1:]
            row[(gram * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)] = 1.0
    return row


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    own = np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1)) * np.sqrt(np.maximum(landmarks.sum(axis=1), 1))
    return (rows @ landmarks.T) / own


def fit(texts: list[str], labels: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, landmark rows and the matrix from landmark kernels to one score per language."""
    names = sorted(set(labels))
    # Landmarks take turns over the languages.
    by = {n: [k for k, x in enumerate(labels) if x == n] for n in names}
    turns = sorted((at, n) for n in names for at in range(len(by[n])))[:max(LANDMARKS, len(names))]
    marks = np.stack([presence(texts[by[n][at]]) for at, n in turns])
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    # Rows of rare languages weigh as much in total as those of frequent ones.
    weight = np.array([1.0 / len(by[x]) for x in labels])
    weight *= len(labels) / weight.sum()
    place = {n: k for k, n in enumerate(names)}
    # The sums of the normal equations: no more than a batch of rows is held at once.
    size = root.shape[1] + 1
    square, toward = RIDGE * np.eye(size), np.zeros((size, len(names)))
    for at in range(0, len(texts), BATCH):
        part = range(at, min(at + BATCH, len(texts)))
        design = kernel(np.stack([presence(texts[k]) for k in part]), marks).astype(np.float64) @ root
        mean = np.hstack([design, np.ones((len(design), 1))])
        goal = np.full((len(design), len(names)), -1.0)
        goal[np.arange(len(design)), [place[labels[k]] for k in part]] = 1.0
        weighed = mean * weight[part.start:part.stop, None]
        square += weighed.T @ mean
        toward += weighed.T @ goal
    solved = np.linalg.solve(square, toward)
    return names, marks.astype(np.float32), np.vstack([root @ solved[:-1], solved[-1:]]).astype(np.float32)


def _fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = list(frames)
    if not parts:
        return
    sample = pd.concat(parts, ignore_index=True).sort_values(["place", "lang", "text"], kind="stable")
    if len(sample):
        yield pd.DataFrame({"model": [pickle.dumps(fit(list(sample["text"]), list(sample["lang"])))]})


def train(docs: DataFrame) -> bytes | None:
    """The fitted model; its size depends on the parameters and the number of languages only."""
    usable = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").filter(remainder(5) != 0)
    place = F.xxhash64("doc_id")
    counts = stage(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min(place).alias("first")), "languages")
    each = max(1, PER_LANGUAGE * LANGUAGES // max(LANGUAGES, counts.count()))
    chosen = F.pmod("place", F.lit(SHARE_BASIS)) * F.col("count") < each * SHARE_BASIS
    sample = (usable.select("text", "lang", place.alias("place"))
              .join(bounded_side(counts), "lang")
              .filter(chosen | (F.col("place") == F.col("first")))
              .select("text", "lang", "place"))
    # The corpus is read by many tasks; only the bounded sample goes through one.
    found = stage(sample, "language-sample").coalesce(1).mapInPandas(_fit, "model binary").collect()
    return found[0]["model"] if found else None


def predict(rows: DataFrame, model: bytes | None) -> DataFrame:
    """The given columns but text, with lang_pred and score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, marks, matrix = pickle.loads(shared.value) if shared.value else ([], None, None)
        for frame in frames:
            texts = list(frame["text"])
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            known = [k for k, t in enumerate(texts) if names and t is not None and has_letter(t)]
            for at in range(0, len(known), BATCH):
                part = known[at:at + BATCH]
                near = kernel(np.stack([presence(texts[k]) for k in part]), marks)
                margin = near @ matrix[:-1] + matrix[-1]
                best = margin.argmax(axis=1)
                sure = (np.clip(margin[np.arange(len(part)), best], -1, 1) + 1) / 2
                for k, b, s in zip(part, best, sure):
                    lang[k], score[k] = names[b], float(s)
            yield frame.drop(columns="text").assign(lang_pred=lang, score=score)

    schema = rows.drop("text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInPandas(run, schema)


def language_id(docs: DataFrame) -> DataFrame:
    held = F.coalesce(remainder(5) == 0, F.lit(False))
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), train(docs))


def op8_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
