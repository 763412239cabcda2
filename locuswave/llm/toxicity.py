"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are present or absent: its words, pairs of words, and pairs with one word between them, each
hashed into 2 ** ``BITS`` places.  The model is fitted on a bounded sample: the ``PER_CLASS`` documents of either
label that come first by the hash of their id.  Per-coordinate rates and the L1 term leave a few hundred
weights, at most 2 ** ``BITS``, which are broadcast; scoring reads every text once.

Defined cases: NULL and empty texts have no features and score the bias.  A document with several label rows is
toxic if one says so; labels that are NULL are ignored.  Without labelled rows of both kinds every score is 0.
A NULL doc_id is never held out.  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswave.llm.common import table
from locuswave.session import stage

BITS = 22
PER_CLASS = 8_000
EPOCHS, ALPHA, BETA, L1, L2 = 6, 1.0, 1.0, 15.0, 0.0
THRESHOLD = 0.7
KNOWN_WORDS = 500_000

_WORD = re.compile(r"[^\W_]+")


def features(text: str | None, known: dict[str, int]) -> np.ndarray:
    """Hashed places of the text's words, word pairs and skip-pairs; places may repeat."""
    words = _WORD.findall((text or "").lower())
    if len(known) > KNOWN_WORDS:
        known.clear()
    ids = np.empty(len(words), np.uint64)
    for k, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) + 1
        ids[k] = h
    with np.errstate(over="ignore"):
        one = ids * np.uint64(0x9E3779B97F4A7C15)
        two = (one[:-1] ^ np.uint64(0x51ED270B)) * np.uint64(0xD6E8FEB86659FD93) + one[1:]
        skip = (one[:-2] ^ np.uint64(0x2545F491)) * np.uint64(0xC2B2AE3D27D4EB4F) + one[2:]
        every = np.concatenate([one, two, skip])
        every = (every ^ (every >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    return (every >> np.uint64(64 - BITS)).astype(np.int32)


def fit(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights that are not zero; the bias is the last place, 2 ** BITS."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, y = rows[k]
            zi, ni = z[at], n[at]
            w = _weights(zi, ni)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
    w = _weights(z, n)
    places = np.flatnonzero(w)
    return places, w[places]


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, int] = {}
    for frame in frames:
        yield pd.DataFrame({"place": frame["place"], "toxic": frame["toxic"],
                            "features": [np.unique(features(t, known)).tobytes() for t in frame["text"]]})


def _fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = list(frames)
    if not parts:
        return
    sample = pd.concat(parts, ignore_index=True).sort_values(["place", "toxic"], kind="stable")
    bias = np.array([1 << BITS], np.int32)
    rows = [(np.concatenate([np.frombuffer(f, np.int32), bias]), int(y))
            for f, y in zip(sample["features"], sample["toxic"])]
    if len({y for _, y in rows}) == 2:
        places, weights = fit(rows)
        yield pd.DataFrame({"place": places, "weight": weights})


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """place, weight: the fitted weights, from rows that are not held out."""
    known = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(remainder(3) != 1)
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
             .withColumn("place", F.xxhash64("doc_id")))
    first = lambda label: known.filter(F.col("toxic") == label).orderBy("place").limit(per_class)
    # At most 2 * per_class ids: small enough to send to every reader of the texts.
    sample = docs.select("doc_id", "text").join(F.broadcast(first(1).unionByName(first(0))), "doc_id")
    found = sample.select("place", "toxic", "text").mapInPandas(_extract, "place long, toxic int, features binary")
    # Texts are read and features made by many tasks; only the bounded sample of features goes through one.
    return stage(found, "toxicity-sample").coalesce(1).mapInPandas(_fit, "place long, weight double")


def score(docs: DataFrame, weights: DataFrame, name: str = "score") -> DataFrame:
    """The given columns and the probability of label 1 as ``name``; only texts go to Python, only scores come back."""
    found = weights.toPandas()  # at most 2 ** BITS + 1 rows
    shared = docs.sparkSession.sparkContext.broadcast(
        (found["place"].to_numpy(np.int64), found["weight"].to_numpy(np.float64)))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        places, values = shared.value
        dense, known = np.zeros((1 << BITS) + 1), {}
        dense[places] = values
        bias = dense[-1]
        for texts in batches:
            out = np.zeros(len(texts))
            for k, text in enumerate(texts if len(places) else ()):
                at = features(text, known)
                at = np.unique(at[dense[at] != 0])
                out[k] = 1.0 / (1.0 + np.exp(-np.clip(dense[at].sum() + bias, -35, 35)))
            yield pd.Series(out)

    return docs.withColumn(name, run(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    held = F.coalesce(remainder(3) == 1, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return score(rows, train(docs, labels)).drop("text").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic; columns stay as they are."""
    return score(docs, train(docs, labels), "_toxic").filter(F.col("_toxic") < THRESHOLD).select(docs.columns)


def op3_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
