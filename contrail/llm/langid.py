"""Language identification with error-correcting output codes.

Each language gets a codeword; for each bit a linear classifier over hashed character n-grams predicts it. Decoding
compares the predictions with every codeword, each bit weighted by how well its classifier did, and takes the
codeword with the least loss. Few languages get the exhaustive code, more get the best of some seeded random codes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 12
CHUNK = 1 << 18  # characters that are hashed at a time
MAX_ROWS = 4_000  # bound on the labelled rows that the classifiers are fitted on, all languages together
FOLDS = 5  # documents whose crc32(id) is 0 modulo this are held out
MARGIN = 0.2  # a score lead below this over the second language is ambiguous
UNKNOWN = "und"
EPOCHS = 150


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-cased letter of each code point of the basic plane, a space for what is no letter."""
    table = np.full(1 << 16, 32, np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            table[i] = ord(c.lower()[0])
    return table


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    codes = _letters()[np.minimum(points, 0xFFFF)]
    if len(points) and points.max() > 0xFFFF:
        for i in np.flatnonzero(points > 0xFFFF):
            codes[i] = points[i] if chr(points[i]).isalpha() else 32
    return codes


def counts(text: str | None) -> np.ndarray | None:
    """How often each bucket of character 1- to 3-grams occurs in the whole text; None if it has no letter."""
    if not text:
        return None
    total, seen = np.zeros(BUCKETS, np.int64), False
    for at in range(0, len(text), CHUNK):
        c = _codes(text[max(0, at - 2) : at + CHUNK])
        skip = 2 if at else 0
        seen = seen or bool((c[skip:] != 32).any())
        gram = c * np.uint32(0x9E3779B1)
        total += np.bincount(gram[skip:] >> np.uint32(20), minlength=BUCKETS)
        for size, mark in ((1, 0x85EBCA6B), (2, 0xC2B2AE35)):
            gram = (gram[:-1] ^ (c[size:] * np.uint32(mark))) * np.uint32(0x9E3779B1)
            total += np.bincount(gram[max(0, skip - size) :] >> np.uint32(20), minlength=BUCKETS)
    return total if seen else None


def features(text: str | None) -> np.ndarray | None:
    found = counts(text)
    if found is None:
        return None
    x = np.sqrt(found).astype(np.float32)
    return x / np.linalg.norm(x)


def codewords(classes: int, seed: int = 42) -> np.ndarray:
    """(classes, bits) matrix of -1 and 1; the first codeword is all ones."""
    if classes <= 7:
        bits = 2 ** (classes - 1) - 1
        rows = [np.ones(bits, int)]
        for i in range(1, classes):
            rows.append(np.array([1 if (n >> (i - 1)) & 1 else -1 for n in range(bits)]))
        return np.array(rows)
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(classes)))
    best, far = None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (classes, bits))
        apart = (bits - code @ code.T) // 2
        least = int((apart + bits * np.eye(classes, dtype=int)).min())
        if least > far and (np.abs(code.sum(axis=0)) < classes).all():
            best, far = code, least
    return best


@dataclass(frozen=True)
class Model:
    """Languages, their codewords, and a linear classifier with a weight for each bit."""

    languages: tuple[str, ...]
    code: np.ndarray
    linear: np.ndarray
    bias: np.ndarray
    weight: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Share of each language, between 0 and 1, from the loss-weighted distance to its codeword."""
        if len(self.languages) == 1:
            return np.ones((len(x), 1))
        f = x @ self.linear + self.bias
        loss = np.logaddexp(0, -f[:, None, :] * self.code[None]) @ self.weight
        each = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * 2 * len(self.weight) / self.code.shape[1])
        return each / each.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, languages: tuple[str, ...], penalty: float = 1e-4) -> Model:
    """Logistic classifiers for all bits at once, by accelerated gradient steps; the last fifth of the rows weighs the bits."""
    code = codewords(len(languages))
    bits = code.shape[1]
    linear, bias = np.zeros((x.shape[1], bits), np.float32), np.zeros(bits, np.float32)
    if len(languages) < 2:
        return Model(languages, code, linear, bias, np.ones(bits))
    target = code[y].astype(np.float32)
    fresh = np.arange(len(x)) % 5 == 4
    train = ~fresh if fresh.sum() and len(np.unique(y[~fresh])) == len(languages) else np.ones(len(x), bool)
    xt, yt = x[train], target[train]
    rate = len(xt) * 4.0 / max(float(np.square(xt).sum(axis=1).max()) * len(xt), 1e-9) * 4
    old, old_bias = linear, bias
    for step in range(EPOCHS):
        k = step / (step + 3)
        ahead, ahead_bias = linear + k * (linear - old), bias + k * (bias - old_bias)
        pull = -yt / (1 + np.exp(np.clip(yt * (xt @ ahead + ahead_bias), -30, 30))) / len(xt)
        old, old_bias = linear, bias
        linear = ahead - rate * (xt.T @ pull + penalty * ahead)
        bias = ahead_bias - rate * pull.sum(axis=0)
    held = fresh if fresh.sum() else train
    right = ((x[held] @ linear + bias) * target[held] > 0).mean(axis=0)
    weight = np.log((right * held.sum() + 1) / ((1 - right) * held.sum() + 1)).clip(0.05)
    return Model(languages, code, linear, bias, weight / weight.sum() * bits)


def held_out(key: str) -> Column:
    """True where the crc32 of the key as text is a multiple of ``FOLDS``; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == 0, F.lit(False))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", max_rows: int = MAX_ROWS) -> Model | None:
    """Fit on at most ``max_rows`` labelled documents that are not held out, equally many of each language at most.

    The documents with the smallest hashes of their keys are taken. None if there is no such document with a letter.
    """
    usable = docs.where(~held_out(key) & F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    named = usable.select(F.col(key).alias("key"), F.col(lang).alias("lang"))
    n_lang = len(named.select("lang").distinct().limit(max_rows).collect())
    if not n_lang:
        return None
    each, order = max(1, max_rows // n_lang), (F.xxhash64("key"), "key")
    # first within parts of a language, so that a frequent one is not ranked in one task
    part = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(64))
    chosen = named.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("place") <= each)
    chosen = chosen.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= each)
    chosen = F.broadcast(chosen.select("key").distinct())  # at most max_rows keys
    sample = usable.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).join(chosen, "key")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"key": [], "lang": [], "x": []}
            for k, t, g in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "lang"))):
                x = features(t)
                if x is not None:
                    out["key"].append(k)
                    out["lang"].append(g)
                    out["x"].append(x.astype(np.float16).tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("key", pa.int64()), ("lang", pa.string()), ("x", pa.binary())]))

    found = sample.mapInArrow(rows, "key long, lang string, x binary").limit(max_rows * 2).collect()
    found.sort(key=lambda r: (r["key"], r["lang"], bytes(r["x"])))
    if not found:
        return None
    languages = tuple(sorted({r["lang"] for r in found}))
    y = np.array([languages.index(r["lang"]) for r in found])
    x = np.stack([np.frombuffer(r["x"], np.float16).astype(np.float32) for r in found])
    mixed = np.random.default_rng(42).permutation(len(x))
    return fit(x[mixed], y[mixed], languages)


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, lang_pred, score, ambiguous), one for each row of ``docs``.

    ``und`` with score 0 for a text that is null or has no letter, and everywhere if nothing was learned. ``ambiguous``
    if the second language comes close. Keys, sources and given languages play no part.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            pred, score, doubt = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
            for i, value in enumerate(texts):
                x = features(value.as_py()) if model else None
                if x is not None:
                    s = model.scores(x[None])[0]
                    order = np.argsort(-s, kind="stable")
                    pred[i], score[i] = model.languages[order[0]], float(s[order[0]])
                    doubt[i] = len(s) > 1 and bool(s[order[0]] - s[order[1]] < MARGIN)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred), pa.array(score, pa.float64()), pa.array(doubt, pa.bool_())],
                                             ["key", "lang_pred", "score", "ambiguous"])

    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    found = source.mapInArrow(rows, "key long, lang_pred string, score double, ambiguous boolean")
    return found.withColumn("held_out", held_out("key")).withColumnRenamed("key", key)
