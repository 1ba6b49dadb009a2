"""BPE encoding and decoding through a table of distinct words.

Texts are cut into words and coded against the dictionary of their block (a bounded run of documents): a document
becomes a list of places in that dictionary. The dictionaries' words are then shuffled by word, so that each
distinct word of the corpus meets in one place and is encoded once; its ids go back to the blocks that hold it. A
block joins them to its documents by place. Decoding joins ids to the vocabulary's pieces, once for each word of a block.

A word counts once for each block, however frequent it is, so no word is hot. What is shuffled are the
dictionaries, the ids and the coded documents, about half of the text's own size together.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from contrail.llm.arrays import expand
from contrail.llm.tokens import default_vocabulary, pieces, words_of

BLOCK_BYTES = 12 << 20  # text of a block; one longer text is a block of its own
WORDS_AT_ONCE = 200_000


def _pack(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte by byte: small numbers leave the high bytes empty."""
    planes = np.ascontiguousarray(x.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Block:
    """Documents coded against their own dictionary."""

    def __init__(self):
        self.place = defaultdict(count().__next__)
        self.codes, self.sizes, self.bytes = [], [], 0

    def add(self, text: bytes) -> None:
        words = text.split()
        self.codes.append(np.fromiter(map(self.place.__getitem__, words), np.uint32, len(words)))
        self.sizes.append(len(words))
        self.bytes += len(text)

    def finish(self, keys: list, buckets: int) -> tuple[str, list[list[bytes]], np.ndarray, np.ndarray]:
        """Name of the block, its words by bucket, the documents' codes (frequent words first), the words' places.

        The keys are part of the name, so that equal texts under different keys are blocks of their own.
        """
        words = sorted(self.place)
        by = sorted(range(len(words)), key=lambda i: zlib.crc32(words[i]) % buckets)  # stable
        of = [[] for _ in range(buckets)]
        for i in by:
            of[zlib.crc32(words[i]) % buckets].append(words[i])
        place = np.empty(len(words), np.int64)  # from the order of first use to the order of the buckets
        place[[self.place[words[i]] for i in by]] = np.arange(len(words))
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.uint32)
        often = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[often] = np.arange(len(words))
        codes = rank[codes] if len(codes) else codes
        name = hashlib.sha256(b" ".join(words) + codes.tobytes() + np.array(self.sizes, np.int64).tobytes() + repr(keys).encode())
        return name.hexdigest(), of, codes, place[often]


def encode_decode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Rows (key, ids, decoded), one for each row of ``docs``.

    ``ids`` are the token ids without special tokens added, as little-endian unsigned 32-bit numbers in a binary;
    ``decoded`` is the text of their pieces with a space between, special ones kept. A null text is an empty one: no
    ids and an empty ``decoded``. Repeated rows and null keys come out as they came in; other columns are left aside.
    """
    path = vocabulary or default_vocabulary()
    buckets = buckets or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = docs.selectExpr(f"cast(`{key}` as bigint) as key", f"cast(`{text}` as binary) as body")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, _Block]]:
        keys, block = [], _Block()
        for batch in batches:
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(body.as_py() or b"")
                keys.append(k)
                if block.bytes >= BLOCK_BYTES:
                    yield keys, block
                    keys, block = [], _Block()
        if keys:
            yield keys, block

    def dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, block in blocks(batches):
            name, words, _, _ = block.finish(keys, buckets)
            some = [i for i, w in enumerate(words) if w]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some)), pa.array(some, pa.int32()), pa.array([b" ".join(words[i]) for i in some], pa.binary())],
                ["block", "bucket", "words"],
            )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, block in blocks(batches):
            name, _, codes, places = block.finish(keys, buckets)
            yield pa.RecordBatch.from_arrays([
                pa.array([name]), pa.array([keys], pa.list_(pa.int64())), pa.array([block.sizes], pa.list_(pa.int64())),
                pa.array([_pack(codes)], pa.binary()), pa.array([_pack(places)], pa.binary()),
            ], ["block", "keys", "sizes", "codes", "places"])

    def encode(table: pa.Table) -> pa.Table:
        """Each distinct word of a bucket once; the ids of each block's words in their order."""
        words, ids = words_of(path), {}
        rows = {"block": table.column("block").to_pylist(), "bucket": table.column("bucket").to_pylist(), "lengths": [], "ids": []}
        for blob in table.column("words"):
            mine = blob.as_py().split()
            for w in mine:
                if w not in ids:
                    ids[w] = words._word(w)
            found = [ids[w] for w in mine]
            rows["lengths"].append(_pack(np.array([len(x) // 4 for x in found], np.uint32)))
            rows["ids"].append(_pack(np.frombuffer(b"".join(found), "<u4")))
        words.forget()
        return pa.table(rows, schema=pa.schema([
            ("block", pa.string()), ("bucket", pa.int32()), ("lengths", pa.binary()), ("ids", pa.binary())
        ]))

    def join(coded: pa.Table, found: pa.Table) -> pa.Table:
        schema = pa.schema([("key", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
        # equal blocks send equal dictionaries: one answer of each bucket is enough
        order = np.unique(found.column("bucket").to_numpy(), return_index=True)[1]
        lengths = [_unpack(found.column("lengths")[i].as_py()) for i in order]
        ids = [_unpack(found.column("ids")[i].as_py()) for i in order]
        lengths = np.concatenate(lengths).astype(np.int64) if lengths else np.zeros(0, np.int64)
        ids = np.concatenate(ids) if ids else np.zeros(0, "<u4")
        table = pieces(path)
        edges = np.concatenate([[0], np.cumsum(lengths)])
        out = {"key": [], "ids": [], "decoded": []}
        for i in range(len(coded)):  # equal blocks have equal dictionaries
            places = _unpack(coded.column("places")[i].as_py())
            if len(places) != len(lengths):
                raise RuntimeError("the words of a block are missing: its rows differ between two readings of the input")
            shown = [b" ".join(map(table.__getitem__, ids[edges[p] : edges[p + 1]].tolist())) for p in places]
            codes, at = _unpack(coded.column("codes")[i].as_py()), 0
            start, size = edges[:-1][places], lengths[places]
            for k, n in zip(coded.column("keys")[i].as_py(), coded.column("sizes")[i].as_py()):
                mine, body, words = codes[at : at + n], [], []
                for a in range(0, n, WORDS_AT_ONCE):
                    part = mine[a : a + WORDS_AT_ONCE]
                    body.append(ids[expand(start[part], size[part])[1]].tobytes())
                    words += map(shown.__getitem__, part[size[part] > 0].tolist())
                out["key"].append(k)
                out["ids"].append(b"".join(body))
                out["decoded"].append(b" ".join(words).decode())
                at += n
        return pa.table(out, schema=schema)

    words = source.mapInArrow(dictionaries, "block string, bucket int, words binary")
    words = words.groupBy("bucket").applyInArrow(encode, "block string, bucket int, lengths binary, ids binary")
    coded = source.mapInArrow(documents, "block string, keys array<long>, sizes array<long>, codes binary, places binary")
    joined = coded.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(join, "key long, ids binary, decoded string")
    return joined.withColumnRenamed("key", key)
