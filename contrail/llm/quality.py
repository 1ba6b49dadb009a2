"""Quality rules whose cutoffs are chosen on labelled documents, so that few good ones are rejected.

Each rule rejects documents whose value exceeds a cutoff. The cutoffs come from fixed grids, from mild to strict. In each
stratum (language), on the labelled good documents, the exact binomial test asks whether the true share of good
documents above a cutoff is below the rule's part of the allowed share. Along a grid the tests run in order and stop at
the first that fails, which needs no correction; over rules and strata the level is divided (Bonferroni). The strictest
cutoff that passed is used; where none passed, for lack of labels say, the rule rejects nothing.
So with probability ``1 - level`` no stratum loses more than ``allowed`` of its good documents to the rules.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.arrays import give_back
from contrail.session import materialize

# Fixed values of the contract
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
SPAN = 5  # words of a window

MAX_STRATA = 10_000  # languages; more of them are an error
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marks long"
WORD = re.compile(r"[^ \t-\r]")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
MARKS = "!?"


@dataclass(frozen=True)
class Rule:
    """Reject where ``part / whole`` exceeds a cutoff of the grid, which goes from mild to strict."""

    name: str
    part: str
    whole: str
    grid: tuple[float, ...]


SHARES = (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.125, 0.1, 0.08, 0.06, 0.05)
RULES = (
    Rule("symbols", "n_symbols", "word_chars", SHARES),
    Rule("repeated_lines", "n_dup_lines", "n_lines", (0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3)),
    Rule("capitals", "n_upper", "word_chars", (0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    Rule("long_words", "word_chars", "n_words", (40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0)),
)


def measure(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``; a null text counts as an empty one."""
    if not text:
        return 0, 0, 0, 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()  # bytes are cut at ASCII white space only
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeated = len(lines) - len(set(lines))
    covered = 0
    if len(words) >= SPAN:
        spans = list(zip(*(words[i:] for i in range(SPAN))))
        if len(set(spans)) < len(spans):
            times, reach = Counter(spans), 0
            for i, span in enumerate(spans):
                if times[span] > 1:
                    covered += i + SPAN - max(i, reach)
                    reach = i + SPAN
    return (len(words), chars, symbols, repeated, covered, len(lines), len(UPPER.findall(text)), sum(map(text.count, MARKS)))


def measures(text: Column | str) -> Column:
    """``measure`` as a column: a struct."""
    names = [x.split()[0] for x in MEASURES.split(", ")]

    @F.pandas_udf(MEASURES)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([measure(x) for x in texts], columns=names, dtype="int64")
        give_back()

    return measured(text)


def base_failed(m: str) -> Column:
    """Too short, or too much of it in repeated windows; ``m`` is the struct of measures."""
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > MAX_REPEATED_PERCENT * F.col(f"{m}.n_words"))


def _exceeds(rule: Rule, m: str, cutoff: Column) -> Column:
    """part / whole > cutoff, as a product: no division by zero and the same rounding everywhere."""
    return F.col(f"{m}.{rule.part}") > F.col(f"{m}.{rule.whole}") * cutoff


def tail(hits: int, n: int, share: float) -> float:
    """Probability of at most ``hits`` of ``n`` where each happens with probability ``share``."""
    if share >= 1:
        return 1.0 if hits >= n else 0.0
    logs = (math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(share) + (n - i) * math.log1p(-share)
            for i in range(hits + 1))
    return math.fsum(map(math.exp, logs))


def choose(hits: Sequence[int], n: int, grid: Sequence[float], share: float, level: float) -> float | None:
    """Strictest cutoff of a grid up to which all tests pass; ``hits[i]`` of ``n`` good documents exceed ``grid[i]``."""
    chosen = None
    for count, cutoff in zip(hits, grid):
        if count > n * share or tail(count, n, share) > level:
            break
        chosen = cutoff
    return chosen


def calibrate(
    good: DataFrame, rules: Sequence[Rule] = RULES, stratum: str = "stratum", m: str = "m", allowed: float = 0.02, level: float = 0.05
) -> dict[str | None, dict[str, float]]:
    """Cutoffs by stratum and rule, from the measures of labelled good documents.

    One aggregate with a row for each stratum, of which there are at most ``MAX_STRATA``. Strata without labels are
    absent, and a null stratum is one of its own.
    """
    count = lambda r, c: F.sum(_exceeds(r, m, F.lit(c)).cast("long"))
    hits = [F.array(*[count(r, c) for c in r.grid]).alias(r.name) for r in rules]
    rows = good.groupBy(stratum).agg(F.count("*").alias("n"), *hits).limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    tests = len(rules) * max(1, len(rows))
    chosen = {}
    for row in rows:
        found = {r.name: choose(row[r.name], row["n"], r.grid, allowed / len(rules), level / tests) for r in rules}
        chosen[row[stratum]] = {k: v for k, v in found.items() if v is not None}
    return chosen


def verdict(cutoffs: dict[str | None, dict[str, float]], rules: Sequence[Rule] = RULES, stratum: str = "stratum", m: str = "m") -> Column:
    """True where a document passes every rule of its stratum; strata without cutoffs lose nothing."""
    passed = F.lit(True)
    for rule in rules:
        known = {s: c[rule.name] for s, c in cutoffs.items() if rule.name in c}
        named = {s: c for s, c in known.items() if s is not None}
        cutoff = F.lit(None).cast("double")
        if named:
            pairs = [F.lit(x) for s, c in sorted(named.items()) for x in (s, float(c))]
            cutoff = F.try_element_at(F.create_map(*pairs), F.col(stratum))
        if None in known:
            cutoff = F.when(F.col(stratum).isNull(), F.lit(float(known[None]))).otherwise(cutoff)
        passed &= ~F.coalesce(_exceeds(rule, m, cutoff), F.lit(False))
    return passed


def good_documents(measured: DataFrame, labels: DataFrame, key: str, quality: str = "quality") -> DataFrame:
    """Measured documents that have labels and only good ones; null labels and keys do not count."""
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_labelled")).agg(F.min(quality).alias("_quality"))
    marks = marks.where("_quality = 1").select("_labelled")
    return measured.join(marks, F.col(key) == F.col("_labelled"), "left_semi").where(~base_failed("m"))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", allowed: float = 0.02, level: float = 0.05) -> DataFrame:
    """Rows (key, stratum, m, base_failed, kept) for every row of ``docs``; ``m`` is the struct of measures.

    Every text is measured once, whole; the measures are stored and the cutoffs learned from all labelled good
    documents among them. Null and empty texts have no words and fail the base rule. Null keys have no labels but are
    judged. Repeated rows are judged alike. Empty documents or labels give no cutoffs.
    """
    measured = docs.select(F.col(key).alias(key), F.col(stratum).alias("stratum"), measures(text).alias("m"))
    measured = materialize(measured, "measures")
    cutoffs = calibrate(good_documents(measured, labels, key), allowed=allowed, level=level)
    failed = base_failed("m")
    return measured.select(key, "stratum", "m", failed.alias("base_failed"), (~failed & verdict(cutoffs)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", allowed: float = 0.02, level: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Texts are measured a second time instead of being shuffled to their verdicts.
    """
    measured = docs.select(F.col(key).alias(key), F.col(stratum).alias("stratum"), measures(text).alias("m"))
    cutoffs = calibrate(materialize(good_documents(measured, labels, key), "good"), allowed=allowed, level=level)
    judged = docs.withColumns({"_quality_stratum": F.col(stratum), "_quality_m": measures(text)})
    kept = judged.where(~base_failed("_quality_m") & verdict(cutoffs, stratum="_quality_stratum", m="_quality_m"))
    return kept.select(*docs.columns)
