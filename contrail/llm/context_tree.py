"""Scores of texts under context-tree weighting over bytes, and under the frequencies of their words.

A text is its words at ASCII white space with A-Z lower-cased, a space between, and an end. Each byte is eight binary decisions,
and each decision sees the bytes before it: a tree whose nodes are the last 0, 1, ... ``DEPTH`` bytes and the bits decided so
far. Every node holds the Krichevsky-Trofimov estimate of its own counts; from the leaves up, a node's weighted probability
is half that of its own estimate and half the product of its children's. The odds between the two say how much of a
decision each depth gets, so a prediction mixes all depths. A context that no training text visited leaves the mixture, and its share
goes to the deepest one that was.

In Spark: texts become blocks of some megabytes, stored once. A block sends its distinct byte strings (a byte and the
``DEPTH`` bytes before it) and its distinct words, with their counts in training texts, to buckets; a string's bucket follows from
the last two bytes of its context, so a bucket holds whole subtrees. Buckets add the counts up and climb their subtrees; what
is above depth two has a fixed size. Then each bucket sends every block the probabilities of its strings. A block counts a string
once however often it occurs, so shuffles carry dictionaries, not texts, and they grow with the input.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.arrays import counted, give_back, runs, squeeze, unsqueeze
from contrail.session import materialize

DEPTH = 6  # bytes of context
ROOTS = 2  # depth at which the subtrees of buckets begin
BLOCK_BYTES = 12 << 20  # text of a block; one longer text is a block of its own
BUCKET_BYTES = 24 << 20  # text for which there is a bucket
ROW_BYTES = 8 << 20  # of requests that are answered together
PART = 2 << 20  # places of a block that are looked at together
END = b"\n"  # ends each text, and stands for what is before it; no word holds it
EXACT = np.array([math.lgamma(i / 2) if i else 0.0 for i in range(8193)])


def log_gamma(twice: np.ndarray) -> np.ndarray:
    """log Gamma(twice / 2) for positive integers: from a table, then by Stirling's series."""
    out = EXACT[np.minimum(twice, 8192)].copy()
    big = twice > 8192
    if big.any():
        x = twice[big] / 2.0
        out[big] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives to any order of these zeros and ones."""
    return log_gamma(2 * zeros + 1) + log_gamma(2 * ones + 1) - math.log(math.pi) - log_gamma(2 * (zeros + ones) + 2)


def strings(stream: np.ndarray, depth: int) -> np.ndarray:
    """For each byte from place ``depth`` on: the bytes before it, the nearest highest, and itself lowest, in one number."""
    n = len(stream) - depth
    out = stream[depth:].astype(np.uint64)
    for j in range(1, depth + 1):
        out |= stream[depth - j : depth - j + n].astype(np.uint64) << np.uint64(8 * (depth + 1 - j))
    return out


def shorter(keys: np.ndarray, depth: int, to: int) -> np.ndarray:
    """Strings of ``depth`` bytes of context with the nearest ``to`` of them only."""
    return ((keys >> np.uint64(8 * (depth - to + 1))) << np.uint64(8)) | (keys & np.uint64(255))


class Level:
    """Nodes of one depth. For each of eight bits: their numbers, zeros, ones, log weighted probability and own share."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, children: Level | list | None):
        self.keys, self.counts, self.nodes = keys, counts, []
        for b in range(8):
            of = keys >> np.uint64(8 - b)
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
            ids = of[first]
            ones = counts * ((keys >> np.uint64(7 - b)) & np.uint64(1)).astype(np.int64)
            total = np.add.reduceat(counts, first) if len(first) else counts
            ones = np.add.reduceat(ones, first) if len(first) else ones
            weighted = own = log_kt(total - ones, ones)
            if children is not None:
                child, of_child = (children.nodes[b][0], children.nodes[b][3]) if isinstance(children, Level) else children[b]
                bits = child & np.uint64((1 << b) - 1)
                parent = ((child >> np.uint64(8 + b)) << np.uint64(b)) | bits
                product = np.bincount(np.searchsorted(ids, parent), of_child, len(ids))
                weighted = np.logaddexp(own, product) - math.log(2)
            share = np.exp(own - math.log(2) - weighted) if children is not None else np.ones(len(ids))
            self.nodes.append((ids, total - ones, ones, weighted, share))


def climb(keys: np.ndarray, counts: np.ndarray, depth: int, last: int, below: list | None = None) -> dict[int, Level]:
    """Levels from ``depth`` up to ``last``. ``below``: (numbers, log weighted probability) of each bit's nodes one level deeper."""
    out, children = {}, below
    for d in range(depth, last - 1, -1):
        if d < depth:
            keys, counts = counted(shorter(keys, d + 1, d), counts)
        out[d] = children = Level(keys, counts, children)
    return out


def mix(levels: dict[int, Level], keys: np.ndarray, depth: int, bit: int, nearest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probability so far, share not yet given, estimate of the deepest visited node) for the decision of ``bit``."""
    done, rest = np.zeros(len(keys)), np.ones(len(keys))
    for d in sorted(levels):
        ids, zeros, ones, _, share = levels[d].nodes[bit]
        if not len(ids):
            continue
        key = shorter(keys, depth, d)
        node, one = key >> np.uint64(8 - bit), ((key >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        at = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
        seen = ids[at] == node
        estimate = (np.where(one, ones[at], zeros[at]) + 0.5) / (zeros[at] + ones[at] + 1)
        given = np.where(seen, rest * share[at], 0)
        done += given * estimate
        rest -= given
        nearest = np.where(seen, estimate, nearest)
    return done, rest, nearest


def above(rows: list[tuple[bytes, bytes, list[bytes]]]) -> np.ndarray:
    """``mix`` over the depths above the buckets, for every pair of a byte and the one before it: (3, 8, 65,536).

    ``rows``: of each bucket the strings with ``ROOTS`` bytes of context, their counts and its roots' weighted probabilities.
    """
    keys = np.concatenate([unsqueeze(k, "<u8") for k, _, _ in rows]) if rows else np.zeros(0, "<u8")
    counts = np.concatenate([unsqueeze(c, "<i8") for _, c, _ in rows]) if rows else np.zeros(0, "<i8")
    order = np.argsort(keys)
    below = []
    for b in range(8):
        ids = np.concatenate([np.unique(unsqueeze(k, "<u8") >> np.uint64(8 - b)) for k, _, _ in rows] or [np.zeros(0, "<u8")])
        weighted = np.concatenate([unsqueeze(w[b], "<f8") for _, _, w in rows] or [np.zeros(0)])
        below.append((ids, weighted))
    first, n = counted(shorter(keys[order], ROOTS, ROOTS - 1), counts[order])
    levels = climb(first, n, ROOTS - 1, 0, below)
    every = np.arange(1 << (8 * ROOTS), dtype=np.uint64)
    start = np.full(len(every), 0.5)
    return np.stack([np.stack(mix(levels, every, ROOTS - 1, b, start)) for b in range(8)], axis=1)


def log_probability(levels: dict[int, Level], keys: np.ndarray, top: np.ndarray, depth: int) -> np.ndarray:
    """log10 of the probability of each string's last byte after the ones before it."""
    out = np.zeros(len(keys))
    near = shorter(keys, depth, ROOTS - 1).astype(np.int64)
    for b in range(8):
        done, rest, nearest = (top[i, b][near] for i in range(3))
        p, left, last = mix(levels, keys, depth, b, nearest)
        out += np.log10(done + rest * (p + left * last))
    return out


class Block:
    """Texts as one stream of bytes; each begins with ``depth`` ends, which are context only."""

    def __init__(self, sizes: np.ndarray, held: np.ndarray, stream: bytes, depth: int):
        self.sizes, self.held, self.depth = sizes, held, depth
        self.bytes = np.frombuffer(stream, np.uint8)
        self.start = np.cumsum(sizes) - sizes  # of each text's context
        self.raw = stream

    def parts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(strings, index of their text), some million places at a time."""
        for a in range(0, len(self.bytes) - self.depth, PART):
            low, high = a + self.depth, min(a + PART + self.depth, len(self.bytes))
            first, last = np.searchsorted(self.start, [low, high - 1], "right") - 1
            edges = np.clip(np.append(self.start[first : last + 1], high), low, high)
            text = np.repeat(np.arange(first, last + 1), np.diff(edges))
            keep = np.arange(low, high) - self.start[text] >= self.depth
            yield strings(self.bytes[a:high], self.depth)[keep], text[keep]

    def words(self) -> Iterator[list[bytes]]:
        """Each text's words, and its end."""
        for a, n in zip(self.start.tolist(), self.sizes.tolist()):
            yield [*self.raw[a + self.depth : a + n].split(), END]

    def strings(self) -> tuple[np.ndarray, np.ndarray]:
        """The block's strings in order, and their number in training texts."""
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for found, text in self.parts():
            train = ~self.held[text]
            k, n = counted(found[train])
            other = counted(found[~train])[0]
            keys, counts = counted(np.concatenate([keys, k, other]), np.concatenate([counts, n, np.zeros(len(other), np.int64)]))
        return keys, counts

    def dictionary(self) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
        """The block's words, their number in training texts, and each text's words as places among them."""
        place = defaultdict(count().__next__)
        codes = [np.fromiter(map(place.__getitem__, words), np.uint32) for words in self.words()]
        train = [c for held, c in zip(self.held.tolist(), codes) if not held]
        counts = np.bincount(np.concatenate(train), minlength=len(place)) if train else np.zeros(len(place), np.int64)
        return list(place), counts, codes


def string_buckets(keys: np.ndarray, buckets: int, depth: int) -> np.ndarray:
    """From the two nearest bytes of the context, well mixed."""
    near = (keys >> np.uint64(8 * (depth + 1 - ROOTS))).astype(np.uint64)
    return ((near * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % buckets


def word_buckets(words: list[bytes], buckets: int) -> np.ndarray:
    """Numbers below zero."""
    return -1 - np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))


def by_bucket(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its items in order), by bucket."""
    order = np.argsort(of, kind="stable")
    first, n = runs(np.diff(of[order], prepend=of[order][:1] - 1) != 0)
    for a, k in zip(first.tolist(), n.tolist()):
        yield int(of[order[a]]), order[a : a + k]


def pack_words(words: list[bytes]) -> bytes:
    return zstandard.compress(b" ".join(words), 1)


def unpack_words(blob: bytes) -> list[bytes]:
    body = zstandard.decompress(blob)
    return body.split(b" ") if body else []


def to_blocks(docs: DataFrame, key: str, text: str, held: str, depth: int) -> DataFrame:
    """Rows (block, keys, sizes, held, length, body), stored."""
    source = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.expr(held), F.lit(False)).alias("held"), F.col(text).cast("binary").alias("body"))
    names = ["block", "keys", "sizes", "held", "length", "body"]
    start = END * depth

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            body = zstandard.compress(b"".join(parts), 1)
            name = hashlib.sha256(body + repr((keys, flags)).encode()).hexdigest()
            columns = [pa.array([name]), pa.array([keys], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([flags], pa.list_(pa.bool_())), pa.array([total], pa.int64()), pa.array([body], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names)

        keys, flags, sizes, parts, total = [], [], [], [], 0
        for batch in batches:
            for k, h, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = (body.as_py() or b"").lower().split()
                parts.append(start + b" ".join(words) + END)
                keys.append(k)
                flags.append(h)
                sizes.append(len(parts[-1]))
                total += sizes[-1]
                if total >= BLOCK_BYTES:
                    yield row()
                    keys, flags, sizes, parts, total = [], [], [], [], 0
        if keys:
            yield row()
        give_back()

    return source.mapInArrow(gather, "block string, keys array<long>, sizes array<long>, held array<boolean>, length long, body binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One at a time, since a row may be large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _block(row: dict, depth: int) -> Block:
    return Block(np.array(row["sizes"], np.int64), np.array(row["held"], bool), zstandard.decompress(row["body"]), depth)


def requests(blocks: DataFrame, buckets: int, depth: int) -> DataFrame:
    """Rows (bucket, block, items, counts): what each block asks each bucket, in order."""
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.string()), ("items", pa.binary()), ("counts", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block, out = _block(row, depth), []
            keys, counts = block.strings()
            for b, mine in by_bucket(string_buckets(keys, buckets, depth)):
                k = keys[mine]
                out.append((b, row["block"], squeeze(np.diff(k, prepend=k[:1] * 0)), squeeze(counts[mine].astype("<u4"))))
            words, counts, _ = block.dictionary()
            for b, mine in by_bucket(word_buckets(words, buckets)):
                out.append((b, row["block"], pack_words([words[i] for i in mine.tolist()]), squeeze(counts[mine].astype("<u4"))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        give_back()

    return blocks.select("block", "sizes", "held", "body").mapInArrow(ask, "bucket long, block string, items binary, counts binary")


def _keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(blob, "<u8"), dtype=np.uint64)


def gathered(asked: DataFrame, depth: int) -> DataFrame:
    """Rows (bucket, items, counts, total, kinds, top, blocks, asked): a bucket's sums over all blocks, and who asked what.

    A bucket with many requests comes as several rows, each with all sums and some of the requests.
    """
    fields = [
        ("bucket", pa.int64()), ("items", pa.binary()), ("counts", pa.binary()), ("total", pa.int64()), ("kinds", pa.int64()), ("top", pa.list_(pa.binary())),
        ("first", pa.bool_()), ("blocks", pa.list_(pa.string())), ("asked", pa.list_(pa.binary())),
    ]

    def add(key: tuple, table: pa.Table) -> pa.Table:
        bucket, top = key[0].as_py(), []
        items, numbers = table.column("items"), table.column("counts")
        if bucket >= 0:
            keys, counts, waiting, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0
            for i in range(len(table) + 1):
                if i == len(table) or size > len(keys) + PART // 4:
                    keys, counts = counted(np.concatenate([keys, *(k for k, _ in waiting)]), np.concatenate([counts, *(c for _, c in waiting)]))
                    waiting, size = [], 0
                if i < len(table):
                    k, c = _keys(items[i].as_py()), unsqueeze(numbers[i].as_py(), "<u4").astype(np.int64)
                    waiting.append((k[c > 0], c[c > 0]))
                    size += len(waiting[-1][0])
            if len(keys):
                root = climb(keys, counts, depth, ROOTS)[ROOTS]
                top = [squeeze(root.keys), squeeze(root.counts), *(squeeze(root.nodes[b][3]) for b in range(8))]
            body = squeeze(np.diff(keys, prepend=keys[:1] * 0))
            total, kinds = 0, 0
        else:
            sums = defaultdict(int)
            for i in range(len(table)):
                for w, c in zip(unpack_words(items[i].as_py()), unsqueeze(numbers[i].as_py(), "<u4").tolist()):
                    if c:
                        sums[w] += c
            counts = np.fromiter(sums.values(), np.int64, len(sums))
            body, total, kinds = pack_words(list(sums)), int(counts.sum()), len(sums)
        counts = squeeze(counts)
        rows, size = [[]], 0
        for i in range(len(table)):
            if size > ROW_BYTES:
                rows, size = [*rows, []], 0
            rows[-1].append(i)
            size += len(items[i].as_py())
        names = table.column("block").to_pylist()
        return pa.table([pa.array(c, t) for c, (_, t) in zip(zip(*(
            (bucket, body, counts, total, kinds, top, n == 0, [names[i] for i in r], [items[i].as_py() for i in r]) for n, r in enumerate(rows)
        )), fields)], schema=pa.schema(fields))

    shape = "bucket long, items binary, counts binary, total long, kinds long, top array<binary>, first boolean, blocks array<string>, asked array<binary>"
    return asked.groupBy("bucket").applyInArrow(add, shape)


def answers(sums: DataFrame, top, depth: int) -> DataFrame:
    """Rows (block, bucket, found): the log probabilities of the strings, or the counts of the words, that a block asked for."""
    schema = pa.schema([("block", pa.string()), ("bucket", pa.int64()), ("found", pa.binary())])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            counts = unsqueeze(row["counts"], "<i8")
            if row["bucket"] >= 0:
                levels = climb(_keys(row["items"]), counts, depth, ROOTS)
                wanted = [_keys(a) for a in row["asked"]]
                every = counted(np.concatenate(wanted))[0]
                value = [log_probability(levels, every[a : a + PART // 8], top.value, depth) for a in range(0, len(every), PART // 8)]
                value = np.concatenate(value).astype("<f4")
                out = [squeeze(value[np.searchsorted(every, w)]) for w in wanted]
            else:
                sums = dict(zip(unpack_words(row["items"]), counts.tolist()))
                out = [squeeze(np.array([sums.get(w, 0) for w in unpack_words(a)], "<i8")) for a in row["asked"]]
            columns = [pa.array(row["blocks"], pa.string()), pa.array([row["bucket"]] * len(out), pa.int64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        give_back()

    return sums.select("bucket", "items", "counts", "blocks", "asked").mapInArrow(answer, "block string, bucket long, found binary")


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", held: str | None = None, depth: int = DEPTH) -> DataFrame:
    """Rows (key, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes), one for each row of ``docs``.

    ``held`` says, in SQL over the columns of ``docs``, which rows nothing is learned from (by default those whose key, as text, has a
    CRC-32 that leaves 1 when divided by 5); where it is null they are learned from.
    ``score`` is log10 of the text's probability under the tree, ``base_score`` under the words' frequencies, ``n_bytes`` the bytes that
    the tree scores, the end included, so -score / n_bytes is the code length for each byte. A null or empty text is an
    end alone. Repeated rows count as often as they come and have equal scores; a null key is a row like any other. Without any
    training text each bit has probability one half. Other columns are left aside; an empty table gives an empty table.
    """
    if not ROOTS <= depth <= 7:
        raise ValueError(f"depth must be from {ROOTS} to 7")
    spark = docs.sparkSession
    held = held or f"crc32(cast(`{key}` as string)) % 5 = 1"
    blocks = materialize(to_blocks(docs, key, text, held, depth), "text-blocks")
    size = blocks.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    buckets = 1 << max(4, (size // BUCKET_BYTES).bit_length())
    sums = materialize(gathered(requests(blocks, buckets, depth), depth), "string-sums")
    firsts = sums.where("first")
    tokens, kinds = firsts.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    # strings of three bytes and their nodes: at most 2 ** 24, in any language a few hundred thousand
    found = [r["top"] for r in firsts.where("size(top) > 0").select("top").toLocalIterator()]
    top = spark.sparkContext.broadcast(above([(t[0], t[1], t[2:]) for t in found]))
    scale = math.log10(tokens + 0.5 * (kinds + 1))
    schema = pa.schema([("key", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())])

    def score(mine: pa.Table, replies: pa.Table) -> pa.Table:
        # equal blocks ask the same and are answered alike: one answer of each bucket is enough
        reply = dict(zip(replies.column("bucket").to_pylist(), replies.column("found")))
        row = mine.slice(0, 1).to_pylist()[0]
        block = _block(row, depth)
        keys, _ = block.strings()
        value = np.zeros(len(keys))
        for b, places in by_bucket(string_buckets(keys, buckets, depth)):
            value[places] = unsqueeze(reply[b].as_py(), "<f4")
        total = np.zeros(len(block.sizes))
        for found, texts in block.parts():
            places = np.argsort(found)
            ordered = found[places]
            first, n = runs(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
            each = np.empty(len(found))
            each[places] = np.repeat(value[np.searchsorted(keys, ordered[first])], n)
            total += np.bincount(texts, each, len(total))
        words, _, codes = block.dictionary()
        known = np.zeros(len(words), np.int64)
        for b, places in by_bucket(word_buckets(words, buckets)):
            known[places] = unsqueeze(reply[b].as_py(), "<i8")
        term, some = np.log10(known + 0.5), known > 0
        n = np.array([len(c) for c in codes], np.int64)
        out = pa.table([
            pa.array(row["keys"], pa.int64()), pa.array(block.held), pa.array(n), pa.array([int(some[c].sum()) for c in codes], pa.int64()),
            pa.array(np.full(len(n), tokens, np.int64)), pa.array(np.array([term[c].sum() for c in codes]) - n * scale), pa.array(total), pa.array(block.sizes - depth),
        ], schema=schema)
        out = pa.concat_tables([out] * len(mine))
        give_back()
        return out

    replies = answers(sums, top, depth)
    joined = blocks.select("block", "keys", "sizes", "held", "body").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        score, "key long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long")
    return joined.withColumnRenamed("key", key)
