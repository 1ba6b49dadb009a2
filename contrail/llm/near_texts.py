"""Groups of near-duplicate texts: SimHash links and, besides, all texts with four fifths of their five-word shingles in common.

Every distinct text is stored once and gets a fingerprint, its shingles' parity bits, and its rarest fifth of shingles: two texts alike
share one of those. A shingle that only one text offers is dropped at once. Large groups are linked through one member of each
shingle's texts, another one in each round, so a group of near copies never yields all its pairs. Only what is still apart is compared
in pairs, inside tasks of bounded size, and a pair leaves its task only if lengths, places and parity bits (the shingles in which two texts
differ change at least as many of them as they differ in) leave it possible. Tasks get the bits of short texts folded to a quarter; the
whole ones, and finer ones of long texts, are looked at for the pairs that are left. A shingle with no more such pairs than rows hands over all of them and is done. Of
any other, only one pair of a text with one component is checked on the texts themselves; if all that are checked hold, the components
are right, and only if some keep failing all pairs are checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.arrays import give_back, runs
from contrail.llm.simhash import components, fingerprint, near_fingerprints
from contrail.session import materialize, shuffles_freed, stored_result

WIDE = 5  # words of a shingle
SAMPLE = 4_000  # texts in which frequent shingles are looked for
LATE = 50_000  # frequent shingles that come last in the order
HOT = 100  # a shingle in one of so many sampled texts is dealt out by text
SALTS = 64
ROUNDS = 2  # in which each text meets one other of its shingles
SPANS = 3  # rounds after those, in which a text meets one of each other component that it may belong to
GROUP = 1_000  # texts of a shingle that a task compares with each other, or with as many others
ROWS = 50_000  # texts and shingles for which there is a task
PARITY = 11  # bits of a shingle's hash that say which of 2,048 parity bits it flips
FOLD = 8  # numbers that the 32 of the parity bits are folded to
SHORT = 800  # shingles of a text up to which folded bits tell texts apart that have little in common
SMALL_IDS = 1_000_000  # ids up to which texts are picked by a broadcast: 8 MB
CACHED = 300_000  # words whose hash a task remembers
ODD = [int(x) | 1 for x in np.random.default_rng(5).integers(1 << 62, 1 << 63, WIDE + 1)]


def shingle_set(text: str | None) -> set[bytes]:
    """The text's shingles of lower-cased words; a shorter text is one shingle, one without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    size = min(WIDE, len(words))
    return set(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def alike(a: set[bytes], b: set[bytes]) -> bool:
    """Whether the Jaccard similarity is 0.8 or more."""
    both = len(a & b)
    return both > 0 and 9 * both >= 4 * (len(a) + len(b))


class WordHashes(dict):
    """64-bit hashes of words; remembers a bounded number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def shingle_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    """Hashes of the different shingles, in order, made from those of their words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    size = min(WIDE, len(words))
    if not size:
        return np.zeros(0, np.int64)
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    out = np.full(n, ODD[WIDE] * size % 2**64, np.uint64)
    for i in range(size):
        out += each[i : i + n] * np.uint64(ODD[i])
        out ^= out >> np.uint64(29)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return np.unique((out ^ (out >> np.uint64(32))).view(np.int64))


def parity(hashes: np.ndarray) -> np.ndarray:
    """2,048 bits as 32 numbers: each shingle flips one of them."""
    odd = np.bincount(hashes.view(np.uint64) >> np.uint64(64 - PARITY), minlength=1 << PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def fine_parity(hashes: np.ndarray) -> np.ndarray | None:
    """At least one parity bit for each shingle of a text too long for ``parity``, by the last bits of the hash: half as many are their two halves' XOR."""
    if len(hashes) <= 1 << PARITY:
        return None
    size = 1 << (len(hashes) - 1).bit_length()
    return np.packbits((np.bincount(hashes & (size - 1), minlength=size) & 1).astype(np.uint8)).view("<i8")


def rare_first(hashes: np.ndarray, late: np.ndarray) -> np.ndarray:
    """The shingles of which a text alike must hold one, in the order that all texts follow: ``late`` ones last."""
    n = len(hashes)
    if len(late):
        order = np.argsort(late)
        at = np.minimum(np.searchsorted(late[order], hashes), len(late) - 1)
        hashes = hashes[np.lexsort((hashes, np.where(late[order][at] == hashes, order[at], -1)))]
    return hashes[: n - (4 * n + 4) // 5 + 1]


def distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    """Rows (id, name, text), each text once; a null text is an empty one. Names are 128 bits long."""
    body = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(F.unhex(F.md5(body)).alias("name"), body.alias("text")).dropDuplicates(["name"])
    return materialize(named.select(F.monotonically_increasing_id().alias("id"), "name", "text"), "distinct-texts")


def frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingles that a sample of the texts holds often, the most frequent last; whether they are hot), ``LATE`` at most."""
    step = max(1, texts.count() // SAMPLE)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(t, known))], ["shingle"])

    part = texts.where(F.pmod(F.xxhash64("name"), F.lit(step)) == 0).select("text")
    counts = part.mapInArrow(cut, "shingle long").groupBy("shingle").count().where("count > 2")
    found = counts.orderBy(F.desc("count"), "shingle").limit(LATE).collect()[::-1]  # bounded by LATE
    return np.array([r["shingle"] for r in found], np.int64), np.array([r["count"] * HOT > SAMPLE for r in found], bool)


def sign(texts: DataFrame, late: np.ndarray) -> DataFrame:
    """Rows (id, name, fp, n, parity, fine, rare), stored."""
    bits = pa.list_(pa.int64())
    fields = [("id", pa.int64()), ("name", pa.binary()), ("fp", pa.int64()), ("n", pa.int32()), ("parity", bits), ("fine", bits), ("rare", bits)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                body = part.column("text").to_pylist()
                hashes = [shingle_hashes(t, known) for t in body]
                columns = [
                    part.column("id"), part.column("name").cast(pa.binary()), pa.array(map(fingerprint, body), pa.int64()), pa.array(map(len, hashes), pa.int32()),
                    pa.array([parity(h) for h in hashes], bits), pa.array([fine_parity(h) for h in hashes], bits),
                    pa.array([rare_first(h, late) if len(h) else [] for h in hashes], bits),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f for f, _ in fields])
        give_back()

    return materialize(texts.mapInArrow(read, "id long, name binary, fp long, n int, parity array<long>, fine array<long>, rare array<long>"), "text-prints")


def shared_shingles(prints: DataFrame, hot: np.ndarray) -> DataFrame:
    """Rows (shingle, id, n, place) of the rare shingles that more than one text offers, stored.

    One shuffle brings the texts of a shingle together; hot shingles are known to be shared and are dealt out by text.
    """
    salt = F.lit(0)
    heads = prints.select("id", "n", F.posexplode("rare").alias("place", "shingle"))
    if len(hot):
        marks = prints.sparkSession.createDataFrame([(int(h), True) for h in hot], "shingle long, hot boolean")
        heads = heads.join(F.broadcast(marks), "shingle", "left")  # at most LATE rows
        salt = F.when(F.col("hot"), F.pmod("id", F.lit(SALTS))).otherwise(0)
    else:
        heads = heads.withColumn("hot", F.lit(None).cast("boolean"))
    heads = heads.withColumn("salt", salt).repartition("shingle", "salt")
    shared = heads.groupBy("shingle", "salt").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.max("hot").alias("known"))
    shared = shared.where((F.col("a") < F.col("b")) | F.col("known")).select("shingle", "salt")
    return materialize(heads.join(shared, ["shingle", "salt"], "left_semi").select("shingle", "id", "n", "place"), "shared-shingles")


def _possible(x: str, y: str) -> Column:
    """Whether the texts can be alike if this is the first shingle that both offer."""
    least = lambda a, b: F.least(F.col(f"{x}.{a}") - F.col(f"{x}.{b}"), F.col(f"{y}.{a}") - F.col(f"{y}.{b}"))
    return 9 * least("n", "place") >= 4 * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _named_by(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows (id, ...) whose id is in stored pairs (left, right)."""
    ids = pairs.select(F.explode(F.array("left", "right")).alias("id")).distinct()
    return rows.join(F.broadcast(ids) if pairs.count() <= SMALL_IDS // 2 else ids, "id", "left_semi")


def _text_pairs(texts: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """Of stored pairs (left, right), those whose texts are alike, stored; the copies of texts made for that are dropped."""

    @F.pandas_udf("boolean")
    def compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        kept = lru_cache(maxsize=64)(shingle_set)
        for a, b in batches:
            yield pd.Series([alike(kept(x), kept(y)) for x, y in zip(a, b)], dtype="bool")
        kept.cache_clear()
        give_back()

    def held() -> DataFrame:
        used = materialize(_named_by(pairs, texts).select("id", "text"), f"{label}-texts")
        both = pairs.join(used.select(F.col("id").alias("left"), F.col("text").alias("a")), "left")
        both = both.join(used.select(F.col("id").alias("right"), F.col("text").alias("b")), "right")
        return both.where(compare("a", "b")).select("left", "right")

    return stored_result(pairs.sparkSession, held, label)


def _differ(x: Column, y: Column) -> Column:
    """Number of bits in which two arrays of equal size differ."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, v: s + v)


def _parity_leaves_open(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """Of pairs (left, right), those whose parity bits, and finer ones if both texts are long, differ in few enough places."""
    one = lambda side: prints.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "parity", "fine")])
    both = pairs.join(one("left"), "left").join(one("right"), "right").withColumn("least", F.least(F.size("fine_left"), F.size("fine_right")))

    def folded(side: str) -> Column:
        """Fine bits folded in two if the other text has half as many."""
        bits = F.col(f"fine_{side}")
        halves = F.slice(bits, F.lit(1), F.col("least")), F.slice(bits, F.col("least") + 1, F.col("least"))
        return F.when(F.size(bits) == 2 * F.col("least"), F.zip_with(*halves, lambda a, b: a.bitwiseXOR(b))).otherwise(bits)

    near = 9 * _differ(F.col("parity_left"), F.col("parity_right")) <= F.col("n_left") + F.col("n_right")
    comparable = F.col("fine_left").isNotNull() & F.col("fine_right").isNotNull() & (F.greatest(F.size("fine_left"), F.size("fine_right")) <= 2 * F.col("least"))
    fine = F.when(comparable, 9 * _differ(folded("left"), folded("right")) <= F.col("n_left") + F.col("n_right")).otherwise(True)
    return both.where(near & fine).select("left", "right")


def _labelled(open_: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of shingles whose texts are not all in one component yet, with the text's component."""
    rows = open_.join(labels.withColumnRenamed("node", "id"), "id", "left").select("shingle", "id", "n", "place", F.coalesce("component", "id").alias("label"))
    apart = rows.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("texts")).where("low < high")
    return rows.join(apart.select("shingle", "texts"), "shingle")


def spanning(x: np.ndarray, y: np.ndarray, ids: np.ndarray, label: np.ndarray, size: np.ndarray, turn: int) -> np.ndarray:
    """Of pairs (places x, y), the places of one for each text and other component; the text is of the component with fewer rows (``size``)."""
    swap = size[x] > size[y]
    text, other = np.where(swap, y, x), np.where(swap, x, y)
    mixed = (ids[other].astype(np.uint64) * np.uint64(ODD[turn % WIDE])) >> np.uint64(16)
    order = np.lexsort((mixed, label[other], ids[text]))
    first = np.ones(len(order), bool)
    first[1:] = (ids[text][order][1:] != ids[text][order][:-1]) | (label[other][order][1:] != label[other][order][:-1])
    return order[first]


def fold(bits: np.ndarray) -> np.ndarray:
    """Rows of parity bits as if a shingle flipped one of a quarter as many."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), bits.shape[1] // FOLD, FOLD), axis=1)


def _folded(name: str = "parity") -> Column:
    """``fold`` of a column of parity bits."""
    return F.array(*[reduce(Column.bitwiseXOR, [F.col(name)[i] for i in range(k, (1 << PARITY) // 64, FOLD)]) for k in range(FOLD)])


def _pairs_apart(open_: DataFrame, prints: DataFrame, turn: int | None) -> DataFrame:
    """Pairs (left, right) of one shingle and different components that may be alike, compared in tasks of bounded size.

    A shingle with many texts has several parts; each task gets two of them. With ``turn``, a shingle with more pairs than rows gives
    only ``spanning`` ones and is named itself in a row of its own (``again``), since it has more.
    """
    schema = pa.schema([("left", pa.int64()), ("right", pa.int64()), ("again", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("shingle")
        column = lambda c: table.column(c).to_numpy()
        shingle, ids, n, place, label, part = (column(c) for c in ("shingle", "id", "n", "place", "label", "part"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        lists = table.column("parity").combine_chunks()
        held, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy().view(np.uint64)
        long = held > FOLD
        whole = flat[np.repeat(long, held)].reshape(-1, (1 << PARITY) // 64)  # no rows if all texts are short
        at, short = np.cumsum(long) - 1, np.empty((len(ids), FOLD), np.uint64)
        short[long], short[~long] = fold(whole), flat[~np.repeat(long, held)].reshape(-1, FOLD)
        _, of, rows = np.unique(label, return_inverse=True, return_counts=True)
        rows = rows[of]
        every, some, again = [], [], []
        for a, size in zip(*(x.tolist() for x in runs(np.concatenate([[True], shingle[1:] != shingle[:-1]])))):
            mine = np.arange(a, a + size)
            ours, theirs = (mine, mine) if low == high == 0 else (mine[part[mine] == low], mine[part[mine] == high])
            found, n_found = [], 0
            for start in range(0, len(ours), 128):
                x = ours[start : start + 128]
                i, j = (k.ravel() for k in np.meshgrid(x, theirs, indexing="ij"))
                keep = (label[i] != label[j]) & (9 * np.minimum(n[i] - place[i], n[j] - place[j]) >= 4 * (n[i] + n[j]))
                if low == high:
                    keep &= ids[i] < ids[j]
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                near = 9 * np.bitwise_count(short[i] ^ short[j]).sum(axis=1, dtype=np.int64) <= n[i] + n[j]
                i, j = i[near], j[near]
                both = np.flatnonzero(long[i] & long[j])
                differ = np.bitwise_count(whole[at[i[both]]] ^ whole[at[j[both]]]).sum(axis=1, dtype=np.int64)
                far = both[9 * differ > n[i[both]] + n[j[both]]]
                i, j = np.delete(i, far), np.delete(j, far)
                n_found += len(i)
                if turn is not None and n_found > size and len(i) > 1000:
                    first = spanning(i, j, ids, label, rows, turn)
                    i, j = i[first], j[first]
                found.append((i, j))
            if turn is not None and n_found > size:
                again.append(shingle[a])
                some += found
            else:
                every += found
        together = lambda found: tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        i, j = together(some)
        first = spanning(i, j, ids, label, rows, turn or 0)
        i, j = together([*every, (i[first], j[first])])
        pairs = [pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j])), pa.nulls(len(i), pa.int64())]
        named = [pa.nulls(len(again), pa.int64())] * 2 + [pa.array(again, pa.int64())]
        return pa.concat_tables([pa.table(pairs, schema=schema), pa.table(named, schema=schema)])

    buckets = 1 + open_.count() // ROWS
    parts = F.ceil(F.col("texts") / GROUP).cast("int")
    rows = open_.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.select("*", F.pmod("shingle", F.lit(buckets)).alias("bucket"), F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    rows = rows.select("bucket", "low", "high", "shingle", "id", "n", "place", "label", "part")
    bits = prints.select("id", F.when(F.col("n") > SHORT, F.col("parity")).otherwise(_folded()).alias("parity"))
    return rows.join(bits, "id").groupBy("bucket", "low", "high").applyInArrow(compare, "left long, right long, again long").distinct()


def text_links(texts: DataFrame, prints: DataFrame, hot: np.ndarray) -> DataFrame:
    """Links (left, right) of text ids whose components are those of all fingerprint links and all texts alike."""
    firsts = materialize(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    near = near_fingerprints(firsts.select("fp"))
    for side in ("left", "right"):
        near = near.join(firsts.select(F.col("fp").alias(side), F.col("first").alias(f"id_{side}")), side)
    near = near.select(F.col("id_left").alias("left"), F.col("id_right").alias("right"))
    same = prints.join(firsts, "fp").where("id <> first").select(F.col("first").alias("left"), F.col("id").alias("right"))
    links = materialize(near.unionByName(same), "text-links")
    open_ = shared_shingles(prints, hot)
    one = F.struct("id", "n", "place", "label")
    for turn in range(ROUNDS + SPANS + 1):
        labelled = lambda rows=open_, links=links, turn=turn: _labelled(rows, components(links, f"texts-{turn}"))
        open_ = stored_result(texts.sparkSession, labelled, f"open-shingles-{turn}")
        if open_.isEmpty():
            return links
        if turn < ROUNDS:
            lead = open_.groupBy("shingle").agg(F.min_by(one, F.xxhash64("id", F.lit(turn))).alias("y"))
            pairs = open_.select("shingle", one.alias("x")).join(lead, "shingle").where((F.col("x.label") != F.col("y.label")) & _possible("x", "y"))
            # a text meets one lead, the first in an order that all texts follow
            met = pairs.groupBy("x.id").agg(F.min_by("y.id", F.xxhash64("y.id", F.lit(turn))).alias("lead"))
            pairs = met.select(F.least("id", "lead").alias("left"), F.greatest("id", "lead").alias("right")).distinct()
            pairs = materialize(_parity_leaves_open(pairs, prints), f"text-links-{turn}-possible")
        else:
            last = turn == ROUNDS + SPANS
            seen = materialize(_pairs_apart(open_, prints, None if last else turn), f"text-links-{turn}-seen")
            again, asked = seen.where("again is not null").select(F.col("again").alias("shingle")), seen.where("again is null").select("left", "right")
            pairs = materialize(_parity_leaves_open(asked, _named_by(asked, prints)), f"text-links-{turn}-possible")
        found = _text_pairs(texts, pairs, f"text-links-{turn}")
        links = links.unionByName(found)
        if turn >= ROUNDS:
            if again.isEmpty() or found.count() == asked.count():
                return links
            open_ = open_.join(again, "shingle", "left_semi")  # the others have handed over all their pairs
        open_ = open_.select("shingle", "id", "n", "place")
    return links


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (name, component_id): for each distinct text the smallest key in its group; null if all keys are."""
    texts = distinct_texts(docs, text)
    late, hot = frequent(texts)
    prints = sign(texts, late)
    labels = components(text_links(texts, prints, late[hot]), "texts")
    named = prints.select("id", "name").join(labels.withColumnRenamed("node", "id"), "id", "left").select("name", F.coalesce("component", "id").alias("label"))
    keys = docs.select(F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("name"), F.col(key).alias("key")).groupBy("name").agg(F.min("key").alias("first"))
    first = named.join(keys, "name")
    smallest = first.groupBy("label").agg(F.min("first").alias("component_id"))
    return first.join(smallest, "label").select("name", "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one row of each group of near-duplicates does.

    Near are fingerprints (of three-word shingles) at most two bits apart, and texts with four fifths of their five-word shingles in common. The row with
    the group's smallest key stays; of rows that repeat that key, one does. Rows whose key is null stay all, since they cannot be
    told apart. Null and empty texts are alike. An empty table gives an empty table.
    """
    with shuffles_freed(docs.sparkSession):
        kept = stored_result(
            docs.sparkSession, lambda: near_groups(docs, key, text).select(F.col("component_id").alias(key)).where(F.col(key).isNotNull()).distinct(), "kept-keys")
    named = docs.where(F.col(key).isNotNull()).join(kept, key, "left_semi").select(*docs.columns)
    return named.dropDuplicates([key]).unionByName(docs.where(F.col(key).isNull()))
