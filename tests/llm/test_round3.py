"""Alignment of tokenizers, whitening and context-tree scores: brute force and the odd cases of each."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from contrail.llm import alignment, context_tree, queries, whitening

PROSE = "the quick brown fox jumps over the lazy dog and then runs far away from all of the other animals here "
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (None, PROSE * 3), (5, PROSE * 3), (6, PROSE * 3 + "Tail  end "), (7, "x" * 2000),
    (8, "é" * 700 + PROSE), (9, "a　b  c d x▁y"), (10, (PROSE + "\n") * 20), (11, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (12, "It's  ² ſİ\tn't\r\n  'll 3,000.5 ,,,, "), (13, " lead"), (14, "tail "), (15, "😀 🏳️‍🌈 ﻿\x00z"), (16, "x▁y plain"),
]
# extra columns with names that the operators use inside
SCHEMA = "doc_id long, text string, block string, key string, keys string, pair string, held string, body string"


def odd(spark, rows=ODD):
    return spark.createDataFrame([(*r, "k", "r", "f", "m", "i", "b") for r in rows], SCHEMA)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def texts(spark, folder):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


# 11 alignment


def brute_alignment(docs):
    """Whole texts through both libraries, links in a dictionary."""
    t = alignment.Tokenizers(*alignment.default_tokenizers())
    rows, links, docs_of = [], Counter(), Counter()
    for key, text in docs:
        whole = (" " + (text or "")).encode()
        a = t.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = t.b.encode(text) if text else []
        if b"".join(t.a_bytes[i] for i in a) != whole or b"".join(t.b_bytes[i] for i in b) != whole:
            rows.append((key, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(t.a_bytes[i]) for i in a]), np.cumsum([len(t.b_bytes[i]) for i in b])
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups, pairs, low = [], [], 0
        for cut in cuts:
            mine_a = [i for i, e in zip(a, ends_a) if low < e <= cut]
            mine_b = [i for i, e in zip(b, ends_b) if low < e <= cut]
            groups.append(",".join(map(str, mine_a)) + "|" + ",".join(map(str, mine_b)))
            pairs.append((mine_a[-1], mine_b[-1]))
            low = cut
        links.update(pairs)
        docs_of.update(set(pairs))
        rows.append((key, len(a), len(b), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    return [
        (key, na, nb, len(pairs), len(pairs), sum(links[p] == most[p[1]] for p in pairs), sum(links[p] for p in pairs), sum(docs_of[p] for p in pairs), digest)
        for key, na, nb, pairs, digest in rows
    ]


def test_alignment_is_brute_force(spark, folder, texts, monkeypatch):
    short = [t for t in texts if len(t[1] or "") < 20_000]
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 100_000)
    df = spark.createDataFrame(short, "doc_id long, text string").repartition(3)
    got = ordered(tuple(r) for r in alignment.align_texts(df).collect())
    assert got == ordered(brute_alignment(short))


def test_chunks_are_aligned_together(monkeypatch):
    """Chunks side by side, with some between them whose bytes differ, as each on its own; memory of links is bounded."""
    t = alignment.Tokenizers(*alignment.default_tokenizers())
    chunks = ["the", "a\u00a0b", "quickest", "x\u2581y", "caf\u00e9\n\nau", "\U0001f600!", "x" * 300, "12,345.60"]
    sizes, groups, pairs = t.align(chunks)
    assert (sizes[:, 0] == -1).any() and (sizes[:, 0] > 0).any() and sizes[:, 2].sum() == len(pairs)
    at = 0
    for chunk, size, group in zip(chunks, sizes, groups):
        (alone,), (mine,), links = t.align([chunk])
        assert size.tolist() == alone.tolist() and group == mine and pairs[at : at + size[2]].tolist() == links.tolist()
        at += size[2]
    texts = [f"word{i} and{i % 7} {'y' * 300}" for i in range(50)]
    once = [(*x[:4], x[4].tolist()) for x in alignment.Aligner(t).texts(texts)]
    monkeypatch.setattr(alignment, "LINKS", 20)
    small, again = alignment.Aligner(t), []
    for i in range(0, 50, 5):
        again += [(*x[:4], x[4].tolist()) for x in small.texts(texts[i : i + 5])]
        assert len(small.pairs) < 200 + 5 * len(once[0][4])
    assert again == once


def test_alignment_query(spark, folder, texts):
    got = queries.QUERIES["op11_cross_tokenizer_alignment"](spark, folder)
    assert got.columns[:7] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"] and "groups_sha256" in got.columns
    rows = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert len(rows) == len(texts)
    want = brute_alignment(texts)
    assert all(rows[w[0]] == w for w in want)


def test_alignment_of_odd_rows(spark, monkeypatch):
    got = ordered(tuple(r) for r in alignment.align_texts(odd(spark)).collect())
    assert got == ordered(brute_alignment(ODD))
    assert [r[1:] for r in got if r[0] in (1, 2, 9, 16)] == [(0,) * 7 + ("",)] * 4
    assert alignment.align_texts(odd(spark).limit(0)).count() == 0
    # equal blocks, one row each, and a cache that is full at once
    monkeypatch.setattr(alignment, "BLOCK_DOCS", 1)
    monkeypatch.setattr(alignment, "CHUNKS", 0)
    assert ordered(tuple(r) for r in alignment.align_texts(odd(spark).repartition(2)).collect()) == got


def test_postings_are_counters():
    rng = np.random.default_rng(5)
    for n_docs, n in ((1, 50), (7, 300), (400, 5000), (3, 0)):
        pairs, docs = (rng.zipf(1.3, n) % 60).astype(np.uint32), rng.integers(0, n_docs, n)
        p = alignment.Postings.from_bytes(alignment.Postings.build(n_docs, pairs, docs).to_bytes())
        links = Counter(pairs.tolist())
        held = Counter(q for q, _ in set(zip(pairs.tolist(), docs.tolist())))
        got_links, got_docs = p.counts()
        assert dict(zip(p.pairs.tolist(), got_links.tolist())) == dict(links) and dict(zip(p.pairs.tolist(), got_docs.tolist())) == dict(held)
        value = np.stack([got_links, got_docs], axis=1)
        want = np.zeros((n_docs, 2), np.int64)
        for q, d in zip(pairs.tolist(), docs.tolist()):
            want[d] += (links[q], held[q])
        assert (p.give(value) == want).all()


# 12 whitening


def whole(v):
    return [math.floor(256 * float(c)) for c in v]


def check_whitening(rows, got, components=4):
    """Against numpy in double precision; signs are free."""
    usable = [(k, whole(v)) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    by = defaultdict(list)
    for k, x in usable:
        if x:
            by[len(x)].append((k, x))
    n_rows = 0
    for d, mine in by.items():
        fit = np.array(sorted({tuple(x) for _, x in mine}), np.int64).reshape(-1, d)
        n, s = len(fit), fit.sum(axis=0)
        c = fit - s / n
        value, vectors = np.linalg.eigh(c.T @ c / n)
        value, vectors = value[::-1][:components], vectors[:, ::-1][:, :components]
        for key, x in mine:
            z = [n * a - int(b) for a, b in zip(x, s)]
            y = (np.array(x) - s / n) @ vectors
            for j in range(min(components, d)):
                n_rows += 1
                match = [r for r in got if r["vec_id"] == key and r["component"] == j + 1 and r["n"] == n and r["deviation"] == sum(a * a for a in z)]
                assert match, (key, j)
                r = match[0]
                if value[j] > 1e-9 * value[0]:
                    assert abs(abs(r["whitened"]) - abs(y[j]) / math.sqrt(value[j])) < 1e-6
                    assert abs(r["explained"] - value[j] / np.trace(c.T @ c / n)) < 1e-9 and r["identity_error"] < 1e-9
                else:
                    assert r["whitened"] is None and r["explained"] == 0
    assert len(got) == n_rows


def test_whitening_query(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check_whitening(rows, queries.QUERIES["op12_embedding_whitening"](spark, folder).collect())


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=6) * (9, 5, 3, 1, 0.1, 0)]) for i in range(40)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (100, None), (101, []), (102, [None] * 6), (103, [float("nan")] + [0.0] * 5), (104, [math.inf] + [0.0] * 5), (105, [1.0, 2.0]), (106, [-0.0] * 6)]
    df = spark.createDataFrame([(k, v, "d", "c") for k, v in rows], "vec_id long, embedding array<double>, dims string, code string").repartition(3)
    check_whitening(rows, whitening.whiten(df).collect())
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id = 101")).count() == 0
    one = whitening.whiten(df.where("vec_id = 105")).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, 0.0, None)] * 2
    huge = whitening.whiten(df.withColumn("embedding", whitening.F.transform("embedding", lambda c: c * 1e18))).where("component = 1").collect()
    assert len(huge) == 44 and any(r["deviation"] is None for r in huge) and all(abs(r["whitened"]) < 10 for r in huge if r["n"] > 1)


def test_eigenvectors_of_clusters():
    rng = np.random.default_rng(0)
    for d, values in ((1, [2.0]), (6, [1, 1, 1, 0.5, 0.5, 0]), (30, 1 + 1e-9 * np.arange(30)), (30, np.ones(30)), (30, 10.0 ** -np.linspace(0, 15, 30)), (8, 1e30 * rng.uniform(size=8))):
        q = np.linalg.qr(rng.normal(size=(d, d)))[0]
        a = (q * np.array(values)) @ q.T
        a = ((a + a.T) / 2).astype(whitening.WIDE)
        e, x = whitening.eigen(a)
        assert np.abs(a @ x - x * e).max() < 1e-17 * np.abs(a).max() * d and np.abs(x.T @ x - np.eye(d)).max() < 1e-17 and (np.diff(e) <= 1e-17 * np.abs(a).max()).all()
    assert (whitening.eigen(np.zeros((3, 3), whitening.WIDE))[0] == 0).all()


# 13 context trees


class Tree:
    """Context-tree weighting by recursion over dictionaries of (context, bits decided): [zeros, ones]."""

    def __init__(self, streams, depth):
        self.depth, self.counts, self.children, self.memo = depth, defaultdict(lambda: [0, 0]), defaultdict(set), {}
        for s in streams:
            for context, bits, bit in self.decisions(s):
                for d in range(depth + 1):
                    self.counts[context[:d], bits][bit] += 1
                    if d:
                        self.children[context[: d - 1], bits].add(context[:d])

    def decisions(self, s):
        body = b"\n" * self.depth + s
        for i in range(self.depth, len(body)):
            context, bits = body[i - self.depth : i][::-1], format(body[i], "08b")
            for b in range(8):
                yield context, bits[:b], int(bits[b])

    def own(self, node):
        z, o = self.counts[node]
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.log(math.pi) - math.lgamma(z + o + 1)

    def weighted(self, node):
        if node not in self.memo:
            own = self.own(node)
            if len(node[0]) < self.depth:
                own = np.logaddexp(own, sum(self.weighted((c, node[1])) for c in self.children[node])) - math.log(2)
            self.memo[node] = own
        return self.memo[node]

    def score(self, s):
        total = 0.0
        for context, bits, bit in self.decisions(s):
            p, rest, last = 0.0, 1.0, 0.5
            for d in range(self.depth + 1):
                node = (context[:d], bits)
                if node not in self.counts:
                    break
                n = self.counts[node]
                last = (n[bit] + 0.5) / (sum(n) + 1)
                share = 1.0 if d == self.depth else math.exp(self.own(node) - math.log(2) - self.weighted(node))
                p, rest = p + rest * share * last, rest * (1 - share)
            total += math.log10(p + rest * last)
        return total


def brute_scores(docs, depth):
    words = lambda t: (t or "").encode().lower().split()
    out = lambda k: zlib.crc32(str(k).encode()) % 5 == 1 if k is not None else False
    count = Counter(w for k, t in docs if not out(k) for w in [*words(t), b"\n"])
    n, kinds = sum(count.values()), len(count)
    tree = Tree([b" ".join(words(t)) + b"\n" for k, t in docs if not out(k)], depth)
    for k, t in docs:
        mine = [*words(t), b"\n"]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in mine)
        yield k, out(k), len(mine), sum(count[w] > 0 for w in mine), n, base, tree.score(b" ".join(words(t)) + b"\n")


def check_scores(got, want):
    got, want = ordered(tuple(r)[:7] for r in got), ordered(want)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-5) for g, w in zip(got, want))


@pytest.mark.parametrize("depth", [2, 6])
def test_scores_are_brute_force(spark, texts, depth, monkeypatch):
    docs = sorted(texts, key=lambda t: len(t[1] or ""))[:25]
    monkeypatch.setattr(context_tree, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(context_tree, "PART", 1000)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    check_scores(context_tree.score_texts(df, depth=depth).collect(), list(brute_scores(docs, depth)))


def test_scores_of_odd_rows(spark, monkeypatch):
    want = list(brute_scores(ODD, 6))
    check_scores(context_tree.score_texts(odd(spark)).collect(), want)
    assert context_tree.score_texts(odd(spark).limit(0)).count() == 0
    untrained = context_tree.score_texts(odd(spark), held="true").collect()
    assert all(r["score"] == pytest.approx(-8 * r["n_bytes"] * math.log10(2)) and r["n_known"] == 0 and r["train_tokens"] == 0 for r in untrained)
    # equal blocks, one for each row, and rows of one request each
    monkeypatch.setattr(context_tree, "BLOCK_BYTES", 1)
    monkeypatch.setattr(context_tree, "ROW_BYTES", 0)
    check_scores(context_tree.score_texts(odd(spark).repartition(2)).collect(), want)


def test_scores_tell_text_from_noise(spark, folder):
    """On texts that nothing was learned from, the tree needs fewer bits than the words' frequencies."""
    rows = queries.QUERIES["op13_context_tree_scores"](spark, folder).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
    assert all(r["score"] < 0 and r["n_tokens"] >= 1 for r in rows)
