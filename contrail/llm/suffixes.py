"""Removal of byte strings that already occur in an earlier document, by a sparse suffix array.

A suffix for every byte would multiply the corpus by the length of a suffix. Suffixes are therefore taken at positions
that the text itself chooses: in every window of 50 bytes the 16 bytes with the smallest fingerprint. Equal windows
choose the same place, so two documents that share a window also share a chosen suffix.

1. Sampled splitters range-partition the chosen suffixes by their two leading tokens (8 bytes each). A bucket sorts its
   suffixes by multikey quicksort and finds leading tokens that stand in more than one document. Equal leading tokens
   always meet in one bucket, and each bucket's neighbours are compared inside it, so no match crosses a boundary unseen.
2. Suffixes with shared leading tokens come again with their surroundings (34 bytes before, 50 from the start). The
   bucket sorts them by multikey quicksort, forwards and backwards; neighbours' common lengths give classes of equal
   pieces, and each window gets the smallest document that holds it.
3. Each document drops the windows that an earlier one holds.

Documents are grouped into blocks by a hash of their row. A block sends each distinct suffix or surrounding once,
however many of its documents hold it, so a passage that a third of all rows share costs one entry for each block.
All three passes over the text read one shuffle of it. Memory in a task is bounded by a block or a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.arrays import LAST_ID, expand, ids_of, multikey_order, runs

GRAM = 16  # bytes of the two leading tokens
CHUNK = 1 << 19  # bytes of text that are worked on at a time
BLOCK = "_repeats_block"
MAX_SAMPLE = 2_000  # documents, for the splitters alone; they decide the balance, never the result
SAMPLE_OF_EACH = 64

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("removed", SPANS)])
ARROW_FOUND = pa.struct([
    ("kept", pa.binary()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _fingerprint(t0: np.ndarray, t1: np.ndarray) -> np.ndarray:
    """Of 16 bytes, from their two tokens; never zero."""
    return _mixed(t0 * np.uint64(0x9E3779B97F4A7C15) + _mixed(t1 + np.uint64(0xD1B54A32D192ED03))) | np.uint64(1)


def _tokens(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one number, so that numbers sort as the bytes do."""
    t = data.astype(np.uint64)
    for step in (1, 2, 4):
        t = (t[:-step] << np.uint64(8 * step)) | t[step:]
    return t


def _sliding(x: np.ndarray, width: int, better) -> np.ndarray:
    """``better`` (minimum or maximum) over each ``width`` neighbouring values."""
    length = 1
    while length * 2 <= width:
        x = better(x[:-length], x[length:])
        length *= 2
    rest = width - length
    return better(x[:-rest], x[rest:]) if rest else x


def _pieces(texts: pa.Array, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of some texts, and of each piece the row, its place in the bytes, and its offset in the text.

    Texts are taken together up to ``CHUNK`` bytes; a longer one is cut into pieces that overlap by a window less one.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    row, n = 0, len(texts)
    while row < n:
        if offsets[row + 1] - offsets[row] > CHUNK:
            for at in range(int(offsets[row]), int(offsets[row + 1]), CHUNK):
                end = min(at + CHUNK + window - 1, int(offsets[row + 1]))
                yield data[at:end], np.array([row]), np.array([0, end - at]), np.array([at - offsets[row]])
            row += 1
            continue
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
        rows = np.arange(row, stop)
        edges = offsets[row : stop + 1] - offsets[row]
        yield data[offsets[row] : offsets[stop]], rows, edges, np.zeros(len(rows), np.int64)
        row = stop


def _digest(around: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit name of each surrounding."""
    out = np.empty(len(around), np.uint64)
    odd = _mixed(np.arange(1, around.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for i in range(0, len(around), 1 << 14):
        part = around[i : i + (1 << 14)].astype(np.uint64) + np.uint64(1)
        out[i : i + (1 << 14)] = (part * odd).sum(axis=1, dtype=np.uint64)
    return _mixed(out + (left * 64 + right).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


class _Chosen:
    """The chosen suffixes of some bytes: place, piece, tokens and fingerprint of each."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, window: int):
        self.data, self.edges, self.window = data, edges, window
        width = window - GRAM + 1
        self.at = np.zeros(0, np.int64)
        if len(data) >= window:
            t = _tokens(data)
            g = _fingerprint(t[:-8], t[8:])
            least = _sliding(g, width, np.minimum)
            ends = np.repeat(edges[1:], np.diff(edges))
            fits = ends[: len(least)] - np.arange(len(least)) >= window
            least = np.where(fits, least, np.uint64(0))
            none = np.zeros(width - 1, np.uint64)
            self.at = np.flatnonzero(_sliding(np.concatenate([none, least, none]), width, np.maximum) == g)
        self.t0, self.t1, self.gram = (x[self.at] for x in (t, t[8:], g)) if len(self.at) else [np.zeros(0, np.uint64)] * 3
        self.piece = np.searchsorted(edges, self.at, "right") - 1

    def only(self, mask: np.ndarray) -> _Chosen:
        for name in ("at", "t0", "t1", "gram", "piece"):
            setattr(self, name, getattr(self, name)[mask])
        return self

    def surroundings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes around each suffix (zero outside its piece), how many are real before and after, and a digest."""
        before = self.window - GRAM
        left = np.minimum(before, self.at - self.edges[self.piece])
        right = np.minimum(self.window, self.edges[self.piece + 1] - self.at)
        offset = np.arange(-before, self.window)
        place = np.clip(self.at[:, None] + offset, 0, max(len(self.data) - 1, 0))
        real = (offset >= -left[:, None]) & (offset < right[:, None])
        around = np.where(real, self.data[place], 0).astype(np.uint8)
        return around, left.astype(np.uint8), right.astype(np.uint8), _digest(around, left, right)


def _bucket_of(t0: np.ndarray, t1: np.ndarray, s0: np.ndarray, s1: np.ndarray) -> np.ndarray:
    """Number of splitters (pairs of leading tokens, ascending) that are not above each suffix."""
    low = np.searchsorted(s0, t0, "left")
    high = np.searchsorted(s0, t0, "right")
    bucket = high.copy()
    for i in np.flatnonzero(high > low):  # the first token is that of a splitter
        bucket[i] = low[i] + np.searchsorted(s1[low[i] : high[i]], t1[i], "right")
    return bucket


def _text_column(table: pa.Table, name: str) -> pa.Array:
    import pyarrow.compute as pc

    column = pc.fill_null(table.column(name).cast("string"), "")
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def _blob(x: np.ndarray) -> bytes:
    """Compressed bytes of an array; rows of text that come sorted share most of their bytes."""
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 3)


def _unblob(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(map(zstandard.decompress, table.column(name).to_pylist())), kind)


def _splitters(docs: DataFrame, text: str, window: int, buckets: int) -> np.ndarray:
    """Leading tokens that cut a sample of the suffixes into ``buckets`` equal parts, as a (2, buckets - 1) matrix."""
    every = max(1, math.ceil(docs.count() / (MAX_SAMPLE / 2)))
    sample = docs.where(F.pmod(F.xxhash64(text), F.lit(every)) == 0).select(text).limit(MAX_SAMPLE)

    def leading(batches):
        for batch in batches:
            out = []
            for data, _, edges, _ in _pieces(_text_column(pa.Table.from_batches([batch]), text), window):
                c = _Chosen(data, edges, window)
                step = max(1, len(c.at) // (SAMPLE_OF_EACH * (len(edges) - 1)))
                out.append(np.stack([c.t0[::step], c.t1[::step]]))
            found = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.uint64)
            yield pa.RecordBatch.from_pydict({"tokens": [_blob(found.T)]}, schema=pa.schema([("tokens", pa.binary())]))

    rows = sample.mapInArrow(leading, "tokens binary").collect()  # at most MAX_SAMPLE * SAMPLE_OF_EACH tokens
    pairs = np.concatenate([np.zeros(0, np.uint64), *(_unblob(r[0], np.uint64) for r in rows)]).reshape(-1, 2)
    pairs = pairs[multikey_order(pairs)] if len(pairs) else pairs
    places = (np.arange(1, buckets) * len(pairs)) // buckets
    return pairs[places].T.copy() if len(pairs) else np.zeros((2, 0), np.uint64)


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50, out: str = "repeats") -> DataFrame:
    """Add ``out``: a struct of the bytes that stay (``kept``) and the maximal removed runs of bytes (``removed``).

    A byte goes if a string of ``window`` bytes over it also starts in a row with a smaller ``key``; strings overlap
    freely, never cross rows, and are judged on the input.

    Rows of ``docs`` come out once each, with all their columns; a column called ``out`` is replaced. A null text is
    an empty one. Rows with equal keys do not count against each other. A null key comes after all others. Texts that
    are shorter than the window stay whole. An empty table gives an empty table.
    """
    if window < 2 * GRAM:
        raise ValueError(f"the window must be {2 * GRAM} bytes or more")
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, buckets = 3 * partitions, partitions
    before = window - GRAM
    docs = docs.drop(out)
    s0, s1 = _splitters(docs, text, window, buckets)
    blocked = docs.withColumn(BLOCK, F.pmod(F.xxhash64(key, text), F.lit(blocks)).cast("int"))

    def suffixes(table: pa.Table) -> pa.Table:
        """Distinct leading tokens of a block, by bucket, and whether two of its documents hold them."""
        ids, parts = ids_of(table.column(key)), []
        for data, rows, edges, _ in _pieces(_text_column(table, text), window):
            c = _Chosen(data, edges, window)
            parts.append((c.t0, c.t1, ids[rows[c.piece]]))
        t0, t1, doc = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.uint64)] * 3
        rows = {BLOCK: [], "bucket": [], "tokens": [], "shared": []}
        if len(t0):
            order = multikey_order(np.stack([t0, t1], axis=1))
            t0, t1, doc = t0[order], t1[order], doc[order]
            first, _ = runs(np.concatenate([[True], (t0[1:] != t0[:-1]) | (t1[1:] != t1[:-1])]))
            shared = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
            t0, t1 = t0[first], t1[first]
            bucket = _bucket_of(t0, t1, s0, s1)  # ascending, as the tokens are
            start, count = runs(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            block = table.column(BLOCK)[0].as_py()
            for i, n in zip(start, count):
                rows[BLOCK].append(block)
                rows["bucket"].append(int(bucket[i]))
                rows["tokens"].append(_blob(np.stack([t0[i : i + n], t1[i : i + n]], axis=1).astype(">u8")))
                rows["shared"].append(_blob(shared[i : i + n]))
        return pa.table(rows, schema=pa.schema([
            (BLOCK, pa.int32()), ("bucket", pa.int32()), ("tokens", pa.binary()), ("shared", pa.binary())
        ]))

    def shared_tokens(table: pa.Table) -> pa.Table:
        """For each block, the fingerprints of its leading tokens that stand in more than one document."""
        of_block = table.column(BLOCK).to_pylist()
        pairs = [_unblob(x, ">u8").astype(np.uint64).reshape(-1, 2) for x in table.column("tokens").to_pylist()]
        sizes = [len(x) for x in pairs]
        tokens = np.concatenate(pairs)
        flags = _joined(table, "shared", bool)
        order = multikey_order(tokens)
        t = tokens[order]
        first, count = runs(np.concatenate([[True], (t[1:] != t[:-1]).any(axis=1)]))
        many = (count > 1) | np.logical_or.reduceat(flags[order], first)
        hit = np.zeros(len(t), bool)
        hit[order] = np.repeat(many, count)
        grams = _fingerprint(tokens[:, 0], tokens[:, 1])
        edges = np.concatenate([[0], np.cumsum(sizes)])
        found = [grams[a:b][hit[a:b]] for a, b in zip(edges[:-1], edges[1:])]
        keep = [i for i, x in enumerate(found) if len(x)]
        return pa.table({BLOCK: [of_block[i] for i in keep], "grams": [_blob(found[i]) for i in keep]},
                        schema=pa.schema([(BLOCK, pa.int32()), ("grams", pa.binary())]))

    def surroundings(table: pa.Table, marks: pa.Table) -> pa.Table:
        """Distinct surroundings of the block's shared suffixes, by bucket, with the smallest and largest document."""
        schema = pa.schema([(BLOCK, pa.int32()), ("bucket", pa.int32())] + [
            (c, pa.binary()) for c in ("around", "left", "right", "low", "high")
        ])
        parts = []
        if len(marks) and len(table):
            grams = np.unique(_joined(marks, "grams", np.uint64))
            ids = ids_of(table.column(key))
            for data, rows, edges, _ in _pieces(_text_column(table, text), window):
                c = _Chosen(data, edges, window)
                c.only(_member(c.gram, grams))
                parts.append((*c.surroundings(), c.t0, c.t1, ids[rows[c.piece]]))
        if not sum(len(p[0]) for p in parts):
            return schema.empty_table()
        around, left, right, digest, t0, t1, doc = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(digest, kind="stable")
        first, _ = runs(np.concatenate([[True], digest[order][1:] != digest[order][:-1]]))
        low, high = np.minimum.reduceat(doc[order], first), np.maximum.reduceat(doc[order], first)
        pick = order[first]
        by = multikey_order(np.stack([t0[pick], t1[pick]], axis=1))
        pick, low, high = pick[by], low[by], high[by]
        bucket = _bucket_of(t0[pick], t1[pick], s0, s1)
        start, count = runs(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        columns = {"around": around[pick], "left": left[pick], "right": right[pick], "low": low, "high": high}
        block = table.column(BLOCK)[0].as_py()
        return pa.table({
            BLOCK: [block] * len(start), "bucket": bucket[start].astype(np.int32),
            **{c: [_blob(x[i : i + n]) for i, n in zip(start, count)] for c, x in columns.items()},
        }, schema=schema)

    def resolve(table: pa.Table) -> pa.Table:
        """For each block, runs of windows around a suffix that a document smaller than one of the block's holds."""
        low, high = _joined(table, "low", np.int64), _joined(table, "high", np.int64)
        around = _joined(table, "around", np.uint8).reshape(-1, before + window)
        left, right = (_joined(table, c, np.uint8).astype(np.int64) for c in ("left", "right"))
        digest = _digest(around, left, right)
        t0, t1 = np.ascontiguousarray(around[:, before : before + GRAM]).view(">u8").astype(np.uint64).T
        gram = _fingerprint(t0, t1)
        order = np.argsort(digest, kind="stable")
        first, count = runs(np.concatenate([[True], digest[order][1:] != digest[order][:-1]]))
        pick = order[first]
        least = np.minimum.reduceat(low[order], first)
        holder = _smallest_holder(around[pick], left[pick], right[pick], least, window)
        of = np.empty(len(digest), np.int64)
        of[order] = np.repeat(np.arange(len(first)), count)
        sizes = [len(zstandard.decompress(x)) for x in table.column("left").to_pylist()]
        block = np.repeat(table.column(BLOCK).to_numpy(), sizes)
        useful = np.flatnonzero((holder[of] < high[:, None]).any(axis=1))
        table_of = holder[of[useful]]
        change = np.ones(table_of.shape, bool)
        change[:, 1:] = table_of[:, 1:] != table_of[:, :-1]
        row, begin = np.nonzero(change)
        end = np.where(np.append(row[1:], -1) == row, np.append(begin[1:], 0), before + 1) - 1
        who = table_of[row, begin]
        good = who < high[useful[row]]
        row, begin, end, who = useful[row[good]], begin[good], end[good], who[good]
        by = np.argsort(block[row], kind="stable")
        row, begin, end, who = row[by], begin[by], end[by], who[by]
        owner = block[row]
        start, n = runs(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(row) else (np.zeros(0, int), np.zeros(0, int))
        columns = {"digest": digest[row], "gram": gram[row], "begin": begin.astype(np.uint8), "end": end.astype(np.uint8), "who": who}
        return pa.table({
            BLOCK: owner[start].astype(np.int32),
            **{c: [_blob(x[i : i + k]) for i, k in zip(start, n)] for c, x in columns.items()},
        }, schema=pa.schema([(BLOCK, pa.int32())] + [(c, pa.binary()) for c in columns]))

    def cut(table: pa.Table, marks: pa.Table) -> pa.Table:
        """The block's documents without the windows that a smaller document holds."""
        texts = _text_column(table, text)
        spans = [[] for _ in range(len(table))]
        if len(marks) and len(table):
            ids = ids_of(table.column(key))
            digest = _joined(marks, "digest", np.uint64)
            order = np.argsort(digest, kind="stable")
            digest = digest[order]
            begin, end, who = (_joined(marks, c, k)[order] for c, k in (("begin", np.uint8), ("end", np.uint8), ("who", np.int64)))
            grams = np.unique(_joined(marks, "gram", np.uint64))
            found = []
            for data, rows, edges, base in _pieces(texts, window):
                c = _Chosen(data, edges, window)
                c.only(_member(c.gram, grams))
                name = c.surroundings()[3]
                a = np.searchsorted(digest, name, "left")
                which, m = expand(a, np.searchsorted(digest, name, "right") - a)
                piece = c.piece[which]
                earlier = who[m] < ids[rows[piece]]
                which, m, piece = which[earlier], m[earlier], piece[earlier]
                at = c.at[which] - edges[piece] + base[piece]
                found.append((rows[piece], at - end[m], at - begin[m] + window))
            for r, s, e in _merged(*(np.concatenate(x) for x in zip(*found))):
                spans[r].append({"start": int(s), "end": int(e)})
        kept = []
        for r, value in enumerate(texts.cast("binary")):
            body, at, parts = value.as_py(), 0, []
            for s in spans[r]:
                parts.append(body[at : s["start"]])
                at = s["end"]
            kept.append(b"".join([*parts, body[at:]]) if spans[r] else body)
        result = pa.StructArray.from_arrays([
            pa.array(kept, pa.binary()), pa.array(spans, ARROW_FOUND.field("removed").type)
        ], fields=list(ARROW_FOUND))
        return table.drop_columns([BLOCK]).append_column(pa.field(out, ARROW_FOUND), result)

    by_block = blocked.groupBy(BLOCK)
    marks = by_block.applyInArrow(suffixes, f"{BLOCK} int, bucket int, tokens binary, shared binary")
    marks = marks.groupBy("bucket").applyInArrow(shared_tokens, f"{BLOCK} int, grams binary")
    around = by_block.cogroup(marks.groupBy(BLOCK)).applyInArrow(
        surroundings,
        f"{BLOCK} int, bucket int, around binary, left binary, right binary, low binary, high binary",
    )
    holders = around.groupBy("bucket").applyInArrow(
        resolve, f"{BLOCK} int, digest binary, gram binary, begin binary, end binary, who binary"
    )
    schema = T.StructType([*docs.schema.fields, T.StructField(out, FOUND)])
    return by_block.cogroup(holders.groupBy(BLOCK)).applyInArrow(cut, schema)


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50, length: str | None = None
) -> DataFrame:
    """``docs`` with repeats cut out of their texts, all columns kept; rows of which nothing is left go.

    Texts that were empty or null before stay as they are. Where a cut falls inside a character, what is left of that
    character goes too. ``length`` names a column that is set to the new number of code points where a text has changed.
    """
    found = find_repeats(docs, key, text, window, "_repeats")
    cut = F.size("_repeats.removed") > 0
    found = found.where(~cut | (F.octet_length("_repeats.kept") > 0))
    left = F.col("_repeats.kept").cast("string")
    left = F.when(F.is_valid_utf8(left), left).otherwise(F.replace(F.make_valid_utf8(left), F.lit("\ufffd"), F.lit("")))
    columns = {text: F.when(cut, left).otherwise(F.col(text))}
    if length:
        columns[length] = F.when(cut, F.length(left).cast("long")).otherwise(F.col(length))
    return found.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])


def _member(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values of ``x`` are in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(x), bool)
    place = np.minimum(np.searchsorted(among, x), len(among) - 1)
    return among[place] == x


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Union of intervals by row; intervals that touch become one."""
    if not len(row):
        return iter(())
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    far = int(end.max()) + 2
    reach = np.maximum.accumulate(end + row * far)  # rows never reach into each other
    fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] + row[1:] * far > reach[:-1])])
    first, count = runs(fresh)
    return zip(row[first], start[first], reach[first + count - 1] - row[first] * far)


def _padded_tokens(part: np.ndarray) -> np.ndarray:
    n, width = part.shape
    whole = np.zeros((n, -(-width // 8) * 8), np.uint8)
    whole[:, :width] = part
    return whole.view(">u8").astype(np.uint64)


def _classes(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows as strings, and how many leading bytes each shares with the one before it (-1 for the first)."""
    order = multikey_order(_padded_tokens(part))
    s = part[order]
    differs = s[1:] != s[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), part.shape[1])
    return order, np.concatenate([[-1], common])


def _smallest_holder(around: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """For each surrounding and each o, the smallest ``doc`` with the window that begins o bytes before the suffix.

    Suffixes are sorted forwards, and what stands before them backwards. Rows that share at least r bytes with their
    neighbour form a class; two windows are equal if both their parts are in the same class. ``LAST_ID`` where the
    window does not lie within its text.
    """
    before = window - GRAM
    n = len(doc)
    o_all = np.arange(before + 1)
    inside = (left[:, None] >= o_all) & (right[:, None] >= window - o_all)
    holder = np.where(inside, doc[:, None], LAST_ID)
    right_order, right_common = _classes(around[:, before:])
    # a suffix that shares its leading tokens with no other surrounding is done
    first, count = runs(right_common < GRAM)
    alone = np.zeros(n, bool)
    alone[right_order[first[count == 1]]] = True
    left_order, left_common = _classes(around[:, before - 1 :: -1] if before else around[:, :0])
    for o in o_all:
        rest = np.flatnonzero(inside[:, o] & ~alone)
        if len(rest) < 2:
            continue
        a, b = np.empty(n, np.int64), np.empty(n, np.int64)
        a[right_order] = np.cumsum(right_common < window - o)
        b[left_order] = np.cumsum(left_common < o)
        name = a[rest] * (n + 1) + b[rest]
        order = np.argsort(name, kind="stable")
        f, c = runs(np.concatenate([[True], name[order][1:] != name[order][:-1]]))
        holder[rest[order], o] = np.repeat(np.minimum.reduceat(doc[rest[order]], f), c)
    return holder
