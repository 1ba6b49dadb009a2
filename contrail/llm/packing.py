"""Packing of documents into sequences: first-fit decreasing with a tournament tree, in random groups of documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.tokens import default_vocabulary, unload, words_of
from contrail.session import materialize

CAPACITY = 2048
END = 1  # id that ends each document
GROUP_BITS = 13  # about 8,192 pieces in a group


class Bins:
    """Tournament tree over the room left in each bin; finds the first bin with enough room in logarithmic time."""

    def __init__(self, most: int, capacity: int):
        self.leaves = 1 << max(0, (most - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def put(self, length: int) -> tuple[int, int]:
        """Place ``length`` in the first bin that has the room: (bin, room it had)."""
        room, i = self.room, 1
        while i < self.leaves:
            i *= 2
            if room[i] < length:
                i += 1
        had = room[i]
        room[i] = had - length
        place = i - self.leaves
        while i > 1:
            i //= 2
            best = max(room[2 * i], room[2 * i + 1])
            if room[i] == best:
                break
            room[i] = best
        return place, had


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in it) of each length; longest first, ties in the order given."""
    bins = Bins(len(lengths), capacity)
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        place, had = bins.put(int(lengths[i]))
        bin_of[i], offset[i] = place, capacity - had
    return bin_of, offset


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Cut each document's ids, with the end id, into pieces of ``capacity`` and a rest.

    Rows (key, start, length, ids_crc32, doc_tokens). A null text is an empty one, whose only id is the end id. Each
    row of ``docs`` gives its pieces, repeated rows and null keys too.
    """
    path = vocabulary or default_vocabulary()
    source = docs.selectExpr(f"cast(`{key}` as bigint) as key", f"cast(`{text}` as binary) as body")
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for batch in batches:
            out = {c: [] for c in ("key", "start", "length", "ids_crc32", "doc_tokens")}
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.text((body.as_py() or b"").split()) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    out["key"].append(k)
                    out["start"].append(start)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    out["doc_tokens"].append(total)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.int64()) for c in out]))
        del words
        unload()

    cuts = source.mapInArrow(cut, "key long, start long, length long, ids_crc32 long, doc_tokens long")
    return cuts.withColumnRenamed("key", key)


def pack(cuts: DataFrame, keys: tuple[str, ...] = ("doc_id", "start"), length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows whose ``length`` is from 1 to ``capacity``.

    Rows fall into groups by a hash of ``keys``, as many as their number asks for, and each group is packed on its
    own: longest first, each into the first sequence with room. Equal rows share a group; a hash of 64 bits spreads
    all others, so no source or document makes a group large. An empty table gives an empty table.
    """
    bits = (cuts.count() >> GROUP_BITS).bit_length()
    cuts = cuts.drop("sequence_id", "offset")
    group = F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits) if bits else F.lit(0).cast("long")
    grouped = cuts.withColumn("_pack_group", group)
    names = cuts.columns

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in keys])
        bin_of, offset = first_fit_decreasing(table.column(length).to_numpy(), capacity)
        name = (key[0].as_py() << 40) + bin_of
        return table.select(names).append_column("sequence_id", pa.array(name)).append_column("offset", pa.array(offset))

    schema = ", ".join([*(f"`{c}` {t}" for c, t in cuts.dtypes), "sequence_id long, offset long"])
    return grouped.groupBy("_pack_group").applyInArrow(fill, schema)


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Rows (key, start, length, ids_crc32, doc_tokens, sequence_id, offset): where each piece of each document goes.

    The ids are counted and cut once; only the pieces' lengths are shuffled.
    """
    cuts = materialize(pieces(docs, key, text, capacity, vocabulary), "pieces")
    return pack(cuts, (key, "start", "ids_crc32"), "length", capacity)


def padded_length(filled: Column, capacity: int = CAPACITY) -> Column:
    """Stored length of a sequence that holds ``filled`` ids: itself at a power of two, else the capacity."""
    return F.when(F.bit_count(filled) == 1, filled).otherwise(F.lit(capacity))
