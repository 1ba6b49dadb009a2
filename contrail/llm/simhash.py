"""SimHash near-duplicates: fingerprints, a binary-trie self-join over them, and groups of linked documents.

The trie is walked from the root downwards, pairs of nodes together. A pair carries the bits in which its prefixes differ
and is dropped once they exceed the budget. The upper levels, eight bits at a time, are Spark joins over node counts; a
pair goes down another level as long as one of its nodes holds more fingerprints than a task should. What is left are
pairs of small subtrees; tasks walk these bit by bit. Equal fingerprints are one leaf, so copies cost nothing,
and a fingerprint has at most 2,080 others within two bits, so no group of near copies yields all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.arrays import expand, give_back
from contrail.session import materialize

BITS = 64
STEP = 8  # bits that one distributed level goes down
LEAF = 4096  # fingerprints below a node that a task takes as they are
SEED = 42
BATCH = 1 << 16  # hashes counted at a time, so that a very long text needs no more memory


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text as a signed 64-bit number; zero for a null text or one without words.

    Words are cut at ASCII white space after A-Z is lower-cased; a shingle is ``shingle`` neighbouring words with
    spaces between, a shorter text is one shingle. A bit is set if it is set in over half of the shingles' XXH64.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    size = min(shingle, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    hashes = map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles)
    left = total = len(words) - size + 1
    ones = np.zeros(BITS, np.int64)
    while left:
        n = min(left, BATCH)
        part = np.fromiter(hashes, np.uint64, n)
        bits = np.unpackbits(part.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        left -= n
    value = np.packbits(2 * ones > total, bitorder="little").view(np.int64)
    return int(value[0])


def fingerprint_of(text: Column | str, shingle: int = 3) -> Column:
    """``fingerprint`` as a column."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")
        give_back()

    return prints(text)


def near_pairs(own: np.ndarray, others: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in ``own``, place in ``others``) that differ in at most ``budget`` bits; both sorted, unsigned.

    Both arrays are read as binary tries: a node is the run of values that share their leading bits. Pairs of nodes go
    down a bit at a time, add a differing bit where they part, and end when the budget is spent; small ones are
    compared directly.
    """
    if not len(own) or not len(others):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    nodes = np.array([[0, len(own), 0, len(others), 0]], np.int64)
    left, right = [], []

    def compare(pairs: np.ndarray) -> None:
        a_which, a = expand(pairs[:, 0], pairs[:, 1] - pairs[:, 0])
        start, count = pairs[a_which, 2], pairs[a_which, 3] - pairs[a_which, 2]
        which, b = expand(start, count)
        near = np.bitwise_count(own[a[which]] ^ others[b]) <= budget
        left.append(a[which][near])
        right.append(b[near])

    def split(x: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
        """First place of each run whose value has the bit set."""
        pivot = ((x[low] >> np.uint64(bit)) | np.uint64(1)) << np.uint64(bit)
        return np.minimum(np.searchsorted(x, pivot), high)

    for bit in range(BITS - 1, -1, -1):
        small = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= 16
        if small.any():
            compare(nodes[small])
            nodes = nodes[~small]
        if not len(nodes):
            break
        al, ah, bl, bh, spent = nodes.T
        am, bm = split(own, al, ah, bit), split(others, bl, bh, bit)
        nodes = np.concatenate([
            np.stack([x0, x1, y0, y1, spent + cost], axis=1)
            for x0, x1, y0, y1, cost in ((al, am, bl, bm, 0), (am, ah, bm, bh, 0), (al, am, bm, bh, 1), (am, ah, bl, bm, 1))
        ])
        nodes = nodes[(nodes[:, 1] > nodes[:, 0]) & (nodes[:, 3] > nodes[:, 2]) & (nodes[:, 4] <= budget)]
    if len(nodes):
        compare(nodes)
    return np.concatenate(left), np.concatenate(right)


def _masks(budget: int) -> list[tuple[int, int]]:
    """Each value of a level's bits with at most ``budget`` of them set, and how many are."""
    return [(m, m.bit_count()) for m in range(1 << STEP) if m.bit_count() <= budget]


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("fp", BITS - depth) if depth < BITS else F.col("fp")


def _node_pairs(prints: DataFrame, budget: int, leaf: int) -> Iterator[tuple[int, DataFrame]]:
    """Walk down the upper trie; yields (depth, pairs of nodes that are small enough to walk in a task)."""
    masks = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(c).alias("cost")) for m, c in _masks(budget)])
    pairs = None
    for depth in range(STEP, BITS + 1, STEP):
        nodes = prints.groupBy(_prefix(depth).alias("node")).agg(F.count("*").alias("n"))
        first = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"))
        if pairs is None:
            base = first.select("a", "na", F.lit(0).alias("spent"), F.lit(True).alias("same"), F.lit(0).cast("long").alias("over"))
        else:
            above = pairs.select(F.col("a").alias("up"), F.col("b").alias("over"), "spent")
            base = first.withColumn("up", F.shiftrightunsigned("a", STEP)).join(above, "up")
            base = base.select("a", "na", "spent", (F.col("up") == F.col("over")).alias("same"), "over")
        base = base.select("*", F.inline(masks)).where(F.col("spent") + F.col("cost") <= budget)
        other = F.shiftleft("over", STEP).bitwiseOR(F.col("a").bitwiseAND((1 << STEP) - 1).bitwiseXOR(F.col("mask")))
        base = base.withColumn("b", other).where(~F.col("same") | (F.col("a") <= F.col("b")))
        second = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"))
        found = base.join(second, "b").select("a", "b", (F.col("spent") + F.col("cost")).alias("spent"), "na", "nb")
        found = materialize(found, f"trie-{depth}")
        small = (F.col("na") <= leaf) & (F.col("nb") <= leaf)
        yield depth, found.where(small).select("a", "b")
        pairs = found.where(~small)
        if depth == BITS or pairs.isEmpty():
            return


def near_fingerprints(prints: DataFrame, budget: int = 2, leaf: int = LEAF) -> DataFrame:
    """Unordered pairs (left, right) of different fingerprints within ``budget`` bits; ``prints`` holds each ``fp`` once.

    An empty table gives no pairs; a null fingerprint is near to nothing.
    """
    schema = pa.schema([("left", pa.int64()), ("right", pa.int64())])

    def walk(key: tuple, table: pa.Table) -> pa.Table:
        node = np.int64(key[0].as_py())
        order = np.argsort(table.column("fp").to_numpy().view(np.uint64))
        values = table.column("fp").to_numpy()[order].view(np.uint64)
        mine = table.column("own").to_numpy(zero_copy_only=False)[order]
        own, values, prefix = values[mine], values[~mine], table.column("b").to_numpy()[order][~mine]
        a, b = near_pairs(own, values, budget)
        fresh = (prefix[b] != node) | (own[a] < values[b])
        return pa.table([own[a][fresh].view(np.int64), values[b][fresh].view(np.int64)], schema=schema)

    prints = prints.where("fp is not null")
    out = None
    for depth, pairs in _node_pairs(prints, budget, leaf):
        own = pairs.select("a", F.col("a").alias("b"), F.lit(True).alias("own")).distinct()
        pairs = own.unionByName(pairs.withColumn("own", F.lit(False)))
        visits = prints.withColumn("b", _prefix(depth)).join(pairs, "b")
        links = visits.groupBy("a").applyInArrow(walk, "left long, right long")
        out = links if out is None else out.unionByName(links)
    return out


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """Smallest node of each linked node's component: rows (node, component).

    Each round a node takes the smallest label among its neighbours, then the label of that label, so long chains
    halve. Every round is stored, so a lost executor repeats one round at most. A null end links nothing.
    """
    links = links.where("left is not null and right is not null and left <> right")
    both = links.unionByName(links.select(F.col("right").alias("left"), F.col("left").alias("right"))).distinct()
    both = materialize(both, f"{label}-both")
    labels = both.groupBy(F.col("left").alias("node")).agg(F.least("node", F.min("right")).alias("component"))
    labels = materialize(labels, f"{label}-0")
    step = 1
    while True:
        seen = both.join(labels.withColumnRenamed("node", "right"), "right")
        seen = seen.groupBy(F.col("left").alias("node")).agg(F.min("component").alias("near"))
        joined = labels.join(seen, "node").select("node", "component", F.least("component", "near").alias("next"))
        joined = materialize(joined, f"{label}-{step}")
        if joined.where("next < component").isEmpty():
            return labels
        roots = joined.select(F.col("node").alias("next"), F.col("next").alias("further")).where("further < next")
        labels = joined.join(roots, "next", "left").select("node", F.coalesce("further", "next").alias("component"))
        labels = materialize(labels, f"{label}-{step}-jump")
        step += 1


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", budget: int = 2, shingle: int = 3) -> DataFrame:
    """Rows (key, fingerprint as 16 hex digits, component_id, n_links) for every row of ``docs``.

    ``component_id`` is the smallest key that can be reached over fingerprints at most ``budget`` bits apart, the
    row's own included; ``n_links`` counts the other fingerprints within the budget. Null and empty texts have
    fingerprint zero, which links like any other. Repeated rows come out as often as they came in. A null key takes
    part, but never names a group; a group with null keys alone has a null ``component_id``. An empty table gives an
    empty table.
    """
    prints = docs.select(F.col(key).alias("key"), fingerprint_of(text, shingle).alias("fp"))
    prints = materialize(prints, "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("key").alias("first")), "distinct-fingerprints")
    links = materialize(near_fingerprints(distinct.select("fp"), budget), "fingerprint-links")
    ends = links.select(F.explode(F.array("left", "right")).alias("fp")).groupBy("fp").agg(F.count("*").alias("n_links"))
    groups = components(links)
    members = distinct.join(groups.withColumnRenamed("node", "fp"), "fp")
    smallest = members.groupBy("component").agg(F.min("first").alias("smallest"))
    linked = members.join(smallest, "component").select("fp", "smallest").join(ends, "fp", "left")
    whole = distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("smallest", "first").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    whole = materialize(whole, "fingerprint-groups")
    # a fingerprint that many rows share: adaptive execution splits its partition of the left side
    return prints.select("key", "fp").join(whole, "fp").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_links"
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", budget: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one row of each group of near-duplicates does.

    The row with the group's smallest key stays; of rows that repeat that key, one does. Rows whose key is
    null stay all, since they cannot be told apart.
    """
    groups = near_duplicates(docs, key, text, budget).where(F.col(key) == F.col("component_id")).select(key).distinct()
    named = docs.where(F.col(key).isNotNull())
    kept = named.join(groups, key, "left_semi").select(*docs.columns)
    return kept.dropDuplicates([key]).unionByName(docs.where(F.col(key).isNull()))
