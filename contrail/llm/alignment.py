"""Alignment of two tokenizers: which tokens of one end where tokens of the other end, and how often in the corpus.

Both cut a text at a single space between two characters that are not white space, and merge nothing across it. So a text is aligned
chunk by chunk, and a chunk that a task has seen before is not encoded again. Texts gather in blocks of some megabytes, and a block
keeps an inverted index of its links: for each pair of ids the documents that hold it, as compressed bitmaps. A pair has one
bitmap for each binary digit of its number of links in a document. Documents in which a pair occurs are the union (OR) of its
bitmaps; its links are the bitmaps' sizes times their digits' weights. Only these two numbers of each pair leave the block. Spark adds
them up over the blocks, and what comes back for each pair is returned along the bitmaps to the documents.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.arrays import expand, give_back, runs, squeeze, unsqueeze
from contrail.session import materialize

BLOCK_BYTES = 16 << 20  # text of a block; one longer text is a block of its own
BLOCK_DOCS = 1 << 16  # a document's place in its block has two bytes
CHUNKS = 400_000  # remembered by a task (some 100 MB); when full it starts anew
LINKS = 8 * CHUNKS  # of all chunks that a task has seen since; when there are more it starts anew
LONG = 256  # characters of a chunk that is not remembered
SHIFT = 16  # a pair is one number: B's id, then A's in the lower bits
CUT = re.compile(r"(?<=\S) (?=\S)")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Tokenizers:
    """Both tokenizers, and the bytes that each of their ids stands for."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        # byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (1 + max(names.values()))
        for name, i in names.items():
            self.a_bytes[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_a, self.size_b = (np.array([len(x) for x in names], np.int64) for names in (self.a_bytes, self.b_bytes))
        self.most = max(len(self.a_bytes), len(self.b_bytes))
        self.shown = [f"{i}{mark}" for mark in ",|;" for i in range(self.most)]  # an id within its group, the last of A's, the last of B's

    def align(self, chunks: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Of each chunk: A's tokens, B's tokens, pairs (a matrix); groups; and all pairs in order.

        Tokens are -1 where their bytes are not a space and the chunk; such a chunk has no groups and no pairs.
        """
        coded_a = [x.ids for x in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        coded_b = self.b.encode(chunks, num_threads=1)
        get_a, get_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        good = np.zeros(len(chunks), bool)
        for k, (chunk, a, b) in enumerate(zip(chunks, coded_a, coded_b)):
            whole = b" " + chunk.encode()
            good[k] = b"".join(map(get_a, a)) == whole and b"".join(map(get_b, b)) == whole
        n_a, n_b = (np.fromiter(map(len, coded), np.int64, len(chunks)) * good for coded in (coded_a, coded_b))
        a, b = (np.fromiter(chain.from_iterable(compress(coded, good)), np.int64, n.sum()) for coded, n in ((coded_a, n_a), (coded_b, n_b)))
        # the bytes of both are those of all good chunks, one after the other, so ends that meet are equal numbers
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        last_b = np.flatnonzero(np.isin(ends_b, ends_a))
        last_a = np.searchsorted(ends_a, ends_b[last_b])
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[last_a], mark_b[last_b] = 1, 2
        of_a, of_b = (np.repeat(np.arange(len(last)), np.diff(last, prepend=-1)) for last in (last_a, last_b))
        text = np.empty(len(a) + len(b), np.int64)  # group by group, A's ids before B's
        text[np.arange(len(a)) + np.concatenate([[0], last_b[:-1] + 1])[of_a]] = a + self.most * mark_a
        text[np.arange(len(b)) + (last_a + 1)[of_b]] = b + self.most * mark_b
        text = list(map(self.shown.__getitem__, text.tolist()))
        stop = np.cumsum(n_a + n_b)
        groups = ["".join(text[i:j])[:-1] for i, j in zip((stop - n_a - n_b).tolist(), stop.tolist())]
        linked = np.diff(np.searchsorted(last_b, np.cumsum(n_b)), prepend=0)
        found = np.stack([np.where(good, n_a, -1), np.where(good, n_b, -1), linked], axis=1)
        return found, groups, (b[last_b] << SHIFT | a[last_a]).astype(np.uint32)


@lru_cache(maxsize=1)
def tokenizers_of(a: str, b: str) -> Tokenizers:
    return Tokenizers(a, b)


class Aligner:
    """Aligns texts by their chunks and remembers a bounded number of these."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers, self.place = tokenizers, {}
        self.clear()

    def clear(self) -> None:
        self.place.clear()
        self.sizes = np.zeros((0, 3), np.int64)  # tokens of A and B, -1 where bytes differ; pairs
        self.groups: list[str] = []
        self.pairs = np.zeros(0, np.uint32)

    def learn(self, chunks: list[str]) -> None:
        sizes, groups, pairs = self.tokenizers.align(chunks)
        self.place.update(zip(chunks, range(len(self.groups), len(self.groups) + len(chunks))))
        self.groups += groups
        self.sizes, self.pairs = np.concatenate([self.sizes, sizes]), np.concatenate([self.pairs, pairs])

    def texts(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """Of each text: A's tokens, B's tokens, groups, their digest, pairs. All empty where a text has no tokens."""
        cut = [CUT.split(t) if t else [] for t in texts]
        if len(self.place) > CHUNKS or len(self.pairs) > LINKS:
            self.clear()
        fresh = [c for c in dict.fromkeys(chain.from_iterable(cut)) if c not in self.place]
        if fresh:
            self.learn(fresh)
        begin = np.cumsum(self.sizes[:, 2]) - self.sizes[:, 2]
        for chunks in cut:
            codes = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
            sizes = self.sizes[codes]
            if not len(codes) or sizes[:, 0].min() < 0:
                yield 0, 0, 0, "", np.zeros(0, np.uint32)
                continue
            na, nb, n = sizes.sum(axis=0).tolist()
            digest = hashlib.sha256(";".join(map(self.groups.__getitem__, codes.tolist())).encode()).hexdigest()
            yield na, nb, n, digest, self.pairs[expand(begin[codes], sizes[:, 2])[1]]
        for chunk in {c for c in fresh if len(c) > LONG}:
            self.groups[self.place.pop(chunk)] = ""


class Postings:
    """Inverted index of a block: for each pair the documents that hold it, a bitmap for each binary digit of the number of links.

    A pair in many documents has rows of bits; the bitmaps of others are lists of the places that are set.
    """

    def __init__(self, n_docs: int, pairs: np.ndarray, dense: np.ndarray, planes: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.n_docs, self.pairs, self.dense = n_docs, pairs, dense
        self.planes = planes  # (entries of each sparse pair, their documents, rows of bits of the dense pairs)

    @classmethod
    def build(cls, n_docs: int, pairs: np.ndarray, docs: np.ndarray) -> Postings:
        cell = np.sort((pairs.astype(np.uint64) << np.uint64(SHIFT)) | docs.astype(np.uint64))
        first, links = runs(np.concatenate([[True], cell[1:] != cell[:-1]])[: len(cell)])
        cell = cell[first]
        doc, pair = (cell & np.uint64((1 << SHIFT) - 1)).astype(np.int64), (cell >> np.uint64(SHIFT)).astype(np.uint32)
        begin, held = runs(np.concatenate([[True], pair[1:] != pair[:-1]])[: len(pair)])
        dense = held * 16 > n_docs
        of = np.repeat(np.arange(len(begin)), held)
        row = np.cumsum(dense) - 1
        planes = []
        for k in range(int(links.max()).bit_length() if len(links) else 0):
            on = (links >> k) & 1 == 1
            thin = on & ~dense[of]
            bits = np.zeros((int(dense.sum()), -(-n_docs // 8) * 8), bool)
            bits[row[of[on & dense[of]]], doc[on & dense[of]]] = True
            planes.append((np.bincount(of[thin], minlength=len(begin))[~dense], doc[thin].astype(np.uint16), np.packbits(bits, axis=1)))
        return cls(n_docs, pair[begin], dense, planes)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(links, documents) of each pair."""
        links, docs = np.zeros(len(self.pairs), np.int64), np.zeros(len(self.pairs), np.int64)
        union, either = [], np.zeros((int(self.dense.sum()), -(-self.n_docs // 8)), np.uint8)
        for k, (n, places, bits) in enumerate(self.planes):
            links[~self.dense] += n.astype(np.int64) << k
            links[self.dense] += np.bitwise_count(bits).sum(axis=1, dtype=np.int64) << k
            union.append(np.repeat(np.arange(len(n)), n) << SHIFT | places)
            either |= bits
        docs[self.dense] = np.bitwise_count(either).sum(axis=1, dtype=np.int64)
        if union:
            docs[~self.dense] = np.bincount(np.unique(np.concatenate(union)) >> SHIFT, minlength=int((~self.dense).sum()))
        return links, docs

    def give(self, values: np.ndarray) -> np.ndarray:
        """For each column of values by pair: its sum over each document's links."""
        out = np.zeros((self.n_docs, values.shape[1]), np.int64)
        thin, thick = values[~self.dense], values[self.dense]
        for k, (n, places, bits) in enumerate(self.planes):
            np.add.at(out, places, np.repeat(thin, n, axis=0) << k)
            for value, row in zip(thick, bits):
                held = np.unpackbits(row)[: self.n_docs].astype(bool)
                out[held] += value << k
        return out

    def to_bytes(self) -> list[bytes]:
        parts = [squeeze(np.array([self.n_docs], "<i8")), squeeze(np.diff(self.pairs, prepend=self.pairs[:1] * 0).astype("<u4")), squeeze(self.dense.astype("<u1"))]
        for n, places, bits in self.planes:
            parts += [squeeze(n.astype("<u4")), squeeze(places.astype("<u2")), zstandard.compress(bits.tobytes(), 1)]
        return parts

    @classmethod
    def from_bytes(cls, parts: list[bytes]) -> Postings:
        n_docs = int(unsqueeze(parts[0], "<i8")[0])
        pairs, dense = np.cumsum(unsqueeze(parts[1], "<u4"), dtype=np.uint32), unsqueeze(parts[2], "<u1").astype(bool)
        planes = [
            (unsqueeze(n, "<u4"), unsqueeze(places, "<u2"), np.frombuffer(zstandard.decompress(bits), np.uint8).reshape(int(dense.sum()), -(-n_docs // 8)))
            for n, places, bits in zip(parts[3::3], parts[4::3], parts[5::3])
        ]
        return cls(n_docs, pairs, dense, planes)


MEASURES = ["n_a", "n_b", "n_groups"]


def to_blocks(docs: DataFrame, key: str, text: str, paths: tuple[str, str]) -> DataFrame:
    """Rows (block, keys, n_a, n_b, n_groups, digests, postings), to be stored."""
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    kinds = [("block", pa.string()), ("keys", pa.list_(pa.int64())), *((m, pa.list_(pa.int64())) for m in MEASURES), ("digests", pa.list_(pa.string())), ("postings", pa.list_(pa.binary()))]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(tokenizers_of(*paths))
        rows, pairs, size = [], [], 0

        def block() -> pa.RecordBatch:
            which = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
            postings = Postings.build(len(rows), np.concatenate(pairs), which).to_bytes()
            name = hashlib.sha256(repr(rows).encode()).hexdigest()
            columns = [[name], *([list(c)] for c in zip(*rows)), [postings]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [n for n, _ in kinds])

        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                keys, texts = (batch.column(c).slice(a, 500).to_pylist() for c in range(2))
                for (*found, mine), k, t in zip(aligner.texts(texts), keys, texts):
                    rows.append((k, *found))
                    pairs.append(mine)
                    size += len(t or "")
                    if size >= BLOCK_BYTES or len(rows) == BLOCK_DOCS:
                        yield block()
                        rows, pairs, size = [], [], 0
        if rows:
            yield block()
        aligner.clear()
        tokenizers_of.cache_clear()
        give_back()

    return source.mapInArrow(gather, "block string, keys array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, digests array<string>, postings array<binary>")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """Rows (block, pair, links, docs) of the pairs of each block."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                postings = Postings.from_bytes(batch.column("postings")[i].as_py())
                links, docs = postings.counts()
                name = pa.array([batch.column("block")[i].as_py()] * len(links), pa.string())
                yield pa.RecordBatch.from_arrays([name, pa.array(postings.pairs.astype(np.int64)), pa.array(links), pa.array(docs)], ["block", "pair", "links", "docs"])

    return blocks.select("block", "postings").mapInArrow(read, "block string, pair long, links long, docs long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Rows (pair, links, docs, best) of the corpus; ``best``: no pair with the same id of B has more links.

    Blocks hold different documents, so their numbers add up. An id of B has as many pairs as A has ids at most.
    """
    sums = pairs.groupBy("pair").agg(F.sum("links").alias("links"), F.sum("docs").alias("docs"))
    most = F.max("links").over(Window.partitionBy(F.shiftright("pair", SHIFT)))
    return sums.select("*", (F.col("links") == most).alias("best"))


def align_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """Rows (key, n_a, n_b, n_groups, n_links, n_best, count_sum, doc_sum, groups_sha256), one for each row of ``docs``.

    ``a`` is a byte-level vocabulary of the tokenizers library, which encodes a space and the text; ``b`` one of sentencepiece, which adds
    the space itself. Special tokens are plain text. Places where a token of each ends cut both into groups, and the two tokens that end there are
    linked. ``n_best`` counts the links whose pair has most links in the corpus among those of its id of B, ties included;
    ``count_sum`` and ``doc_sum`` add up the pair's links and documents over the text's links. ``groups_sha256`` digests the ids of the groups. A null or empty
    text, or one whose tokens' bytes are not a space and the text, has zeros and an empty digest. Repeated rows count as often as they come; a null key
    is a row like any other. Other columns are left aside; an empty table gives an empty table.
    """
    default = default_tokenizers()
    blocks = materialize(to_blocks(docs, key, text, (a or default[0], b or default[1])), "aligned-blocks")
    pairs = materialize(block_pairs(blocks), "block-pairs")
    counts = materialize(pair_counts(pairs), "pair-counts")
    found = pairs.select("block", "pair").distinct().join(counts, "pair")
    schema = pa.schema([("key", pa.int64()), *((m, pa.int64()) for m in [*MEASURES, "n_links", "n_best", "count_sum", "doc_sum"]), ("groups_sha256", pa.string())])

    def give(mine: pa.Table, values: pa.Table) -> pa.Table:
        row = mine.slice(0, 1).to_pylist()[0]
        values = values.sort_by("pair")
        columns = [values.column(c).cast("int64").to_numpy() for c in ("best", "links", "docs")]
        sums = Postings.from_bytes(row["postings"]).give(np.stack(columns, axis=1))
        out = pa.table([row["keys"], *(row[m] for m in MEASURES), row["n_groups"], *sums.T, row["digests"]], schema=schema)
        return pa.concat_tables([out] * len(mine))  # equal blocks ask for the same pairs

    joined = blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        give, "key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, doc_sum long, groups_sha256 string")
    return joined.withColumnRenamed("key", key)
