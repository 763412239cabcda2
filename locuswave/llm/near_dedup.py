"""MinHash near-dedup with an LSH forest.

A document's set holds the 64-bit hashes of its distinct four-word shingles; two documents are linked when their
sets have a Jaccard similarity of 0.8 or more, which is always confirmed on the full sets.

* Documents with equal sets are one class, found by grouping; its smallest id stands for all of them.
* Every class is put into ``TREES`` orders.  An order sorts by another rotation of 64 minima; neighbours there
  that share at least ``MIN_DEPTH`` leading minima are candidates.  Each class verifies its most similar
  smaller neighbour, which joins a group of copies of any size by about one check each.
* The other neighbours are checked next, as far as they lie in different components.
* Then every region (equal leading minima in one order) that still holds several components is searched for links
  between them: all its pairs are compared on their full sets, where they lie, and each cell hands on no more links
  than join its components, however many pairs it compares.  Regions of several orders that have the same members are
  compared once.  Regions of more than ``REGION`` members are split at
  their next minimum, to a depth at which no more than 2 in 10,000 links could be lost; those that stay larger than
  ``BLOCK`` are compared block by block, so no task holds more than two blocks.

At a similarity of 0.8 two classes share a region of depth three with probability 1 - (1 - 0.8 ** 3) ** 16 = 0.99999;
pairs above count more.

Defined cases: a text without words (or NULL) has the empty set and is linked with nothing; fewer than four words
make one shingle.  Rows with a NULL doc_id are linked with nothing, have a NULL component and are kept.  Rows that
repeat a doc_id are linked with each other.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswave.llm.common import table
from locuswave.llm.components import components
from locuswave.session import bounded_side, discard, stage

SHINGLE = 4
# The trees are rotations of the first half of the minima.
MINIMA, IN_TREES, TREES, MIN_DEPTH, MAX_DEPTH = 128, 64, 16, 3, 4
MIN_BRIEF = 36
REGION, BLOCK = 256, 1024
# Entries of the 0-1 matrix of members and shingles that are compared at once (4 bytes each).
CELL_ENTRIES = 4_000_000
SHARE_NUM, SHARE_DEN = 80, 100
# Ids of candidate documents up to this number are sent to all executors (8 bytes each); more are shuffled.
BROADCAST_IDS = 1_000_000
KNOWN_WORDS = 500_000

_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; ``known`` keeps word hashes between calls."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(known) > KNOWN_WORDS:
        known.clear()
    ids = np.empty(len(words), np.uint64)
    for k, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        ids[k] = h
    width = min(SHINGLE, len(words))
    n = len(ids) - width + 1
    h = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = _mix(h * _P + ids[k:k + n])
    return np.unique(h)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    return (rng.integers(0, 2**63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2**63, MINIMA, np.uint64))


def minima(hashes: np.ndarray, multiply: np.ndarray, add: np.ndarray) -> bytes:
    low = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 4096):
            values = (hashes[at:at + 4096, None] ^ add) * multiply >> np.uint64(32)
            low = np.minimum(low, values.min(axis=0).astype(np.uint32))
    return low.astype(">u4").tobytes()


def _sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[bytes, int] = {}
    multiply, add = _permutations()
    for frame in frames:
        rows = []
        for doc_id, text in zip(frame["doc_id"], frame["text"]):
            found = shingle_set(text, known)
            if len(found):
                rows.append((doc_id, len(found), xxhash.xxh3_128_digest(found.tobytes()), minima(found, multiply, add)))
            else:
                rows.append((doc_id, 0, None, None))
        out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "sig"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set, sig (the minima); the last two NULL for empty sets."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        _sign, "doc_id long, n_shingles long, digest binary, sig binary")


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[bytes, int] = {}
    for frame in frames:
        hashes = [shingle_set(t, known).tobytes() for t in frame["text"]]
        yield pd.DataFrame({"doc_id": frame["doc_id"], "hashes": hashes,
                            "digest": [xxhash.xxh3_128_digest(h) for h in hashes]})


def _confirm(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        keep = []
        for x, y in zip(frame["x"], frame["y"]):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(SHARE_DEN * shared >= SHARE_NUM * (len(both) - shared))
        yield frame.loc[np.array(keep, bool), ["a", "b"]]


def confirm(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of class ids whose full sets are similar enough."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidate-ids")
    # A class has one id, but rows may repeat it: sets that differ under one id are all tried.
    sets = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(bounded_side(ids, BROADCAST_IDS), "doc_id", "left_semi")
            .mapInPandas(_sets, "doc_id long, hashes binary, digest binary").drop("digest"))
    sets = stage(sets, "candidate-sets")
    left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y"))
    found = stage(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(
        _confirm, "a long, b long").distinct(), "links")
    discard(ids, sets)
    return found


def _rotated(n: int) -> Column:
    """The first ``n`` minima in the order of a tree."""
    half = f"substring(sig, 1, {4 * IN_TREES})"
    return F.expr(f"substring(concat({half}, {half}), {IN_TREES // TREES * 4} * tree + 1, 4 * ({n}))")


def _in_trees(classes: DataFrame) -> DataFrame:
    return classes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))


def _neighbours(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidate pairs of one sorted partition, and its first and last rows for the pairs across partitions."""
    from pyspark import TaskContext

    part, last, first = TaskContext.get().partitionId(), None, None
    columns = ["part", "end", "tree", "key", "a", "b", "agree"]
    lead = 4 * MIN_DEPTH
    for frame in frames:
        if not len(frame):
            continue
        if first is None:
            first = frame.iloc[0]
        if last is not None:
            frame = pd.concat([last.to_frame().T, frame], ignore_index=True)
        last = frame.iloc[-1]
        key = np.frombuffer(b"".join(frame["key"]), np.uint8).reshape(len(frame), -1)
        sig = np.frombuffer(b"".join(frame["brief"]), np.uint8).reshape(len(frame), -1)
        tree, ids = frame["tree"].to_numpy(np.int64), frame["class_id"].to_numpy(np.int64)
        near = (tree[1:] == tree[:-1]) & (key[1:, :lead] == key[:-1, :lead]).all(axis=1)
        at = np.flatnonzero(near)
        agree = (sig[at] == sig[at + 1]).sum(axis=1)
        a, b = np.minimum(ids[at], ids[at + 1]), np.maximum(ids[at], ids[at + 1])
        yield pd.DataFrame({"part": part, "end": -1, "tree": -1, "key": None, "a": a, "b": b, "agree": agree})[columns]
    if first is not None:
        yield pd.DataFrame([(part, end, row["tree"], row["key"][:lead], row["class_id"], row["class_id"], MINIMA)
                            for end, row in ((0, first), (1, last))], columns=columns)


def neighbour_pairs(classes: DataFrame) -> DataFrame:
    """a < b, agree: classes next to each other in an order that share the leading minima."""
    from pyspark.sql import Window

    brief = F.expr("concat(" + ", ".join(f"substring(sig, {4 * k + 4}, 1)" for k in range(0, MINIMA, 2)) + ")")
    # One byte of every other minimum is enough to compare neighbours; it is carried once per tree.
    rows = _in_trees(classes).select(
        "tree", _rotated(8).alias("key"), "class_id", brief.alias("brief"))
    # Ranges of the sorted order: no region, however large, is one task.
    rows = rows.repartitionByRange("tree", "key", "class_id").sortWithinPartitions("tree", "key", "class_id")
    found = stage(rows.mapInPandas(
        _neighbours, "part int, end int, tree int, key binary, a long, b long, agree long"), "neighbours")
    # Two rows per partition: the last of one and the first of the next.
    ends = found.filter("end >= 0")
    follow = Window.orderBy("part", "end")
    ends = ends.select("a", "end", "tree", "key", *[
        F.lead(c).over(follow).alias(f"next_{c}") for c in ("a", "tree", "key")])
    across = ends.filter("end = 1 AND tree = next_tree AND key = next_key").select(
        F.least("a", "next_a").alias("a"), F.greatest("a", "next_a").alias("b"), F.lit(MINIMA).cast("long").alias("agree"))
    pairs = stage(found.filter("end < 0").select("a", "b", "agree").unionByName(across)
                  .filter(F.col("agree") >= MIN_BRIEF).distinct(), "neighbour-pairs")
    discard(found)
    return pairs


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common shingles of every set on the left with every one on the right."""
    both = [*left, *right]
    owner = np.repeat(np.arange(len(both)), [len(h) for h in both])
    values = np.concatenate(both)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    alike = values[1:] == values[:-1]
    # A shingle of one set only is common to none.
    often = np.concatenate([[False], alike]) | np.concatenate([alike, [False]])
    values, owner = values[often], owner[often]
    place = np.cumsum(np.concatenate([[True], values[1:] != values[:-1]])) - 1 if len(values) else owner
    shared = np.zeros((len(left), len(right)), np.int64)
    width = max(1, CELL_ENTRIES // len(both))
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        some = slice(*np.searchsorted(place, [at, at + width]))
        has = np.zeros((len(both), min(width, int(place[-1]) + 1 - at)), np.float32)
        has[owner[some], place[some] - at] = 1
        shared += (has[:len(left)] @ has[len(left):].T).astype(np.int64)
    return shared


def _joining(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Places of the links (x, y) that join components not joined by earlier ones."""
    above: dict[int, int] = {}

    def root(c: int) -> int:
        while c in above:
            above[c] = above.get(above[c], above[c])
            c = above[c]
        return c

    kept = []
    _, first = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1, return_index=True)
    for k in np.sort(first).tolist():
        u, v = root(int(x[k])), root(int(y[k]))
        if u != v:
            above[u] = v
            kept.append(k)
    return kept


def _crossing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between classes of different components within each cell of rows sorted by (region, lo, hi).

    Of the links of a cell, those that join components not joined yet.
    """

    def links(cell: pd.DataFrame) -> pd.DataFrame:
        ids, comp = cell["class_id"].to_numpy(np.int64), cell["component"].to_numpy(np.int64)
        sets = [np.frombuffer(h, np.uint64) for h in cell["hashes"]]
        sizes, block = np.array([len(h) for h in sets], np.int64), cell["block"].to_numpy(np.int64)
        lo, hi = cell["lo"].iloc[0], cell["hi"].iloc[0]
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        shared = _shared([sets[k] for k in left], [sets[k] for k in right])
        union = sizes[left][:, None] + sizes[right] - shared
        near = (SHARE_DEN * shared >= SHARE_NUM * union) & (comp[left][:, None] != comp[right])
        i, j = np.nonzero(near)
        i, j = left[i], right[j]
        kept = _joining(comp[i], comp[j])
        i, j = ids[i[kept]], ids[j[kept]]
        return pd.DataFrame({"a": np.minimum(i, j), "b": np.maximum(i, j)})

    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        cells = list(frame.groupby(["region", "lo", "hi"], sort=False))
        for _, cell in cells[:-1]:
            yield links(cell)
        rest = cells[-1][1] if cells else None
    if rest is not None and len(rest):
        yield links(rest)


def _named(rows: DataFrame, labels: DataFrame, by: str = "class_id", name: str = "component") -> DataFrame:
    """Adds the component of a class; a class without a label is its own."""
    own = labels.select(F.col("node").alias(by), F.col("component").alias("_label"))
    return rows.join(own, by, "left").withColumn(name, F.coalesce("_label", by)).drop("_label")


def mixed_cells(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """region, lo, hi, block, class_id, digest, component: the members of regions with several components, in bounded cells.

    Regions are counted over ids alone.
    """
    # An id that is repeated with other texts stands for several classes; their digests tell them apart.
    named = stage(_named(classes.select("class_id", "sig", "digest"), labels), "named-classes")
    depth, done, used, now = MIN_DEPTH, [], [named], _in_trees(named)
    while True:
        keys = now.select("class_id", "digest", "component", "tree",
                          F.xxhash64(F.lit(depth), F.col("tree"), _rotated(depth)).alias("region"))
        mixed = (keys.groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.min("component").alias("c0"),
                                            F.max("component").alias("c1")).filter("c0 <> c1").select("region", "members"))
        mixed = stage(mixed, "mixed-regions")
        members = stage(keys.join(mixed, "region"), "mixed-members")
        used += [mixed, members]
        deeper = depth < MAX_DEPTH and bool(members.filter(F.col("members") > REGION).limit(1).count())
        done.append(members.filter(F.col("members") <= REGION) if deeper else members)
        if not deeper:
            break
        now = members.filter(F.col("members") > REGION).select("class_id", "digest", "component", "tree").join(
            named.select("class_id", "digest", "sig"), ["class_id", "digest"])
        depth += 1
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    # Classes that lie together in several orders: one region is left of those with the same members.
    one, two = F.xxhash64("class_id", "digest"), F.xxhash64("digest", "class_id")
    alike = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(38,0)")).alias("one"),
                                       F.bit_xor(two).alias("two"))
    rows = rows.join(alike.groupBy("n", "one", "two").agg(F.min("region").alias("region")).select("region"),
                     "region", "left_semi")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = (rows.withColumn("blocks", blocks)
            .withColumn("block", F.pmod(F.xxhash64("class_id", "digest"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("region", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                    "block", "class_id", "digest", "component"))
    cells = stage(rows, "mixed-cells")
    discard(*used)
    return cells


def crossing_links(cells: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) of full sets that join the components in each cell."""
    ids = stage(cells.select(F.col("class_id").alias("doc_id")).distinct(), "cell-ids")
    sets = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(bounded_side(ids, BROADCAST_IDS), "doc_id", "left_semi")
            .mapInPandas(_sets, "doc_id long, hashes binary, digest binary")
            .select(F.col("doc_id").alias("class_id"), "digest", "hashes").dropDuplicates(["class_id", "digest"]))
    found = (cells.join(sets, ["class_id", "digest"])
             .repartition("region", "lo", "hi").sortWithinPartitions("region", "lo", "hi")
             .select("region", "lo", "hi", "block", "class_id", "component", "hashes")
             .mapInPandas(_crossing, "a long, b long").distinct())
    found = stage(found, "crossing-links")
    discard(ids)
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (see the module)."""
    signed = stage(signatures(docs), "signatures")
    classes = stage(signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest", "sig")
                    .agg(F.min("doc_id").alias("class_id")), "classes")
    near = neighbour_pairs(classes)
    # Each class checks its most similar smaller neighbour first, then those in other components.
    best = stage(near.groupBy("b").agg(F.max(F.struct("agree", (-F.col("a")).alias("n"))).alias("m"))
                 .select((-F.col("m.n")).alias("a"), "b"), "best-neighbours")
    links = confirm(best, docs)
    labels = components(links)
    rest = _named(_named(near, labels, "a", "ca"), labels, "b", "cb").filter("ca <> cb")
    rest = stage(rest.select("a", "b"), "other-neighbours")
    discard(best, labels)
    links = links.unionByName(confirm(rest, docs))
    labels = components(links)
    discard(rest, near)
    cells = mixed_cells(classes, labels)
    discard(labels)
    links = links.unionByName(crossing_links(cells, docs))
    discard(cells)
    # Rows that repeat an id link the classes of their texts.
    again = (signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "digest").distinct()
             .join(classes.select("digest", "class_id"), "digest")
             .filter("doc_id <> class_id").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b")))
    labels = components(links.unionByName(again)).withColumnRenamed("node", "doc_id")
    discard(links, classes)
    # An exact copy is linked with its class, so every document that is not the smallest has its own label.
    return (signed.join(labels, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group stays, the one with the smallest id; rows without an id stay, too."""
    found = near_duplicates(docs)
    gone = stage(found.filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct(), "dropped")
    discard(found)
    return docs.join(bounded_side(gone, BROADCAST_IDS), docs["doc_id"] == F.col("_gone"), "left_anti")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
