"""Quality rules: a decision list learned from labelled text statistics.

Sequential covering: a rule for bad text grows by the threshold test that gains most on growing
rows, is pruned on other rows, and the bad rows it covers are put aside before the next rule. The
list is emitted as one ordered Spark conditional expression, so it can be read, stored and edited.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm.common import arrow_schema, map_rows, remainder_of_id
from telemetra.llm.labelled import labelled_sample
from telemetra.llm.words import WordHashes, shingle_hashes

#: Labelled documents the rules are learned from, at most.
SAMPLE_DOCUMENTS = 20_000
#: Rules of a list and tests of a rule, at most.
MOST_RULES, MOST_TESTS = 12, 4
#: Thresholds tried per statistic: quantiles of the rows that grow a rule.
QUANTILES = 64
#: A rule stays if this share of the rows it covers when pruning is bad.
LEAST_PRECISION = 0.8

SYMBOLS = b"#*$%&|<>"
NOT_SYMBOLS = bytes(c for c in range(256) if c not in SYMBOLS)
NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
NOT_DIGITS = bytes(c for c in range(256) if not 48 <= c <= 57)
NOT_ENDS = bytes(c for c in range(256) if c not in b".!?;:")
BLANKS = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics the rules may test; all are defined (0) for a text without words.
STATISTICS = [
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "word_length",
    "upper_share",
    "digit_share",
    "distinct_share",
    "end_share",
    "words",
    "top_word_share",
]


def base_statistics(text: bytes, hashes: WordHashes) -> tuple[list[int], list[float]]:
    """The counts and the statistics of one text."""
    words = text.split()
    n = len(words)
    if not n:
        symbols = len(text.translate(None, NOT_SYMBOLS))
        return [0, 0, symbols, 0, 0], [0.0] * len(STATISTICS)
    packed = text.translate(None, BLANKS)
    chars = len(packed.translate(None, CONTINUATION))
    symbols = len(text.translate(None, NOT_SYMBOLS))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    duplicates = len(lines) - len(set(lines))
    word_hashes = hashes(words)
    windows = shingle_hashes(word_hashes, 3)
    repeated = 0
    if len(windows) > 1:
        order = np.argsort(windows, kind="stable")
        ranked = windows[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(windows), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(n, dtype=bool)
        for k in range(3):
            covered[k : k + len(twice)] |= twice
        repeated = int(covered.sum())
    counted = np.unique(word_hashes, return_counts=True)[1]
    return [n, chars, symbols, duplicates, repeated], [
        symbols / chars,
        duplicates / max(1, len(lines)),
        repeated / n,
        chars / n,
        len(text.translate(None, NOT_UPPER)) / chars,
        len(text.translate(None, NOT_DIGITS)) / chars,
        len(counted) / n,
        len(text.translate(None, NOT_ENDS)) / n,
        float(n),
        float(counted.max()) / n,
    ]


def statistics(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """The columns ``keep``, the counts and the statistics of each row; a null text is empty."""
    frame = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    kept = frame.drop("_text")

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        hashes = WordHashes()
        for *key, text in lines:
            counts, shares = base_statistics(text, hashes)
            yield (*key, *counts, *shares)

    fields = [*arrow_schema(kept), *((c, pa.int64()) for c in COUNTS), *((c, pa.float64()) for c in STATISTICS)]
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    names += [f"{c} bigint" for c in COUNTS] + [f"{c} double" for c in STATISTICS]
    return map_rows(frame, ", ".join(names), pa.schema(fields), convert)


@dataclass(frozen=True)
class Test:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value >= self.threshold if self.above else value < self.threshold

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.threshold if self.above else values < self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Test, ...]


def covered_by(rule: Rule, data: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, dtype=bool)
    for test in rule:
        hit &= test.holds(data[test.statistic])
    return hit


def best_test(data: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> tuple[float, Test | None]:
    """The test with the largest information gain on ``rows``: bad rows kept times bits of purity won."""
    p0, n0 = int(bad[rows].sum()), int((~bad[rows]).sum())
    base = math.log2(p0 / (p0 + n0))
    best: tuple[float, Test | None] = (1e-9, None)
    for name, column in data.items():
        values = column[rows]
        cuts = np.unique(np.quantile(values, np.linspace(0, 1, QUANTILES + 1)[1:-1]))
        order = np.argsort(values, kind="stable")
        ranked = values[order]
        bad_below = np.concatenate(([0], np.cumsum(bad[rows][order])))
        for cut in cuts.tolist():
            at = int(np.searchsorted(ranked, cut, side="left"))
            for above, p, n in ((True, p0 - int(bad_below[at]), len(ranked) - at), (False, int(bad_below[at]), at)):
                if p and n < len(ranked):
                    gain = p * (math.log2(p / n) - base)
                    if gain > best[0]:
                        best = (gain, Test(name, above, float(cut)))
    return best


def centred(rule: Rule, data: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """The rule with each threshold halfway between the bad rows it covers and the good rows it just misses."""
    for i, test in enumerate(rule):
        others = covered_by(rule[:i] + rule[i + 1 :], data, len(bad)) & rows
        values = data[test.statistic]
        inside = values[others & test.holds(values) & bad]
        outside = values[others & ~test.holds(values) & ~bad]
        if len(inside) and len(outside):
            edges = (outside.max(), inside.min()) if test.above else (inside.max(), outside.min())
            if edges[0] < edges[1]:
                middle = Test(test.statistic, test.above, float(edges[0] + edges[1]) / 2)
                rule = (*rule[:i], middle, *rule[i + 1 :])
    return rule


def learn(data: dict[str, np.ndarray], bad: np.ndarray, growing: np.ndarray) -> list[Rule]:
    """An ordered list of rules for bad rows. ``growing`` marks the rows that grow rules; the others prune."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < MOST_RULES:
        rows = np.flatnonzero(left & growing)
        if not bad[rows].any() or bad[rows].all():
            break
        rule: Rule = ()
        while len(rule) < MOST_TESTS and len(rows) and not bad[rows].all():
            _, test = best_test(data, bad, rows)
            if test is None:
                break
            rule = (*rule, test)
            rows = rows[test.holds(data[test.statistic][rows])]

        def worth(candidate: Rule, left: np.ndarray = left) -> tuple[float, int]:
            hit = covered_by(candidate, data, len(bad)) & left & ~growing
            p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
            return (p - n) / (p + n) if p + n else -1.0, p

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = covered_by(rule, data, len(bad)) & left if rule else np.zeros(len(bad), dtype=bool)
        checked = hit & ~growing
        if not checked.any() or bad[checked].mean() < LEAST_PRECISION:
            break
        rules.append(centred(rule, data, bad, left))
        left &= ~hit
    return rules


def rule_number(rules: list[Rule]) -> Column:
    """The first rule of the list that holds, counted from 1; 0 if none does."""
    chain = None
    for i, rule in enumerate(rules, 1):
        condition = rule[0].column()
        for test in rule[1:]:
            condition &= test.column()
        chain = F.when(condition, i) if chain is None else chain.when(condition, i)
    return F.lit(0) if chain is None else chain.otherwise(0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    limit: int = SAMPLE_DOCUMENTS,
) -> list[Rule]:
    """Rules from the statistics of at most ``limit`` labelled documents; none without both classes."""
    sample = labelled_sample(docs, labels, label_col, allowed, limit, id_col, text_col)
    found = statistics(sample, "label", "draw").collect()
    bad = np.array([line["label"] == 0 for line in found], dtype=bool)
    if not len(bad) or bad.all() or not bad.any():
        return []
    data = {name: np.array([line[name] for line in found]) for name in STATISTICS}
    growing = np.array([line["draw"] < 667 for line in found], dtype=bool)
    return learn(data, bad, growing)


def judged(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, ``base_failed``, the number of the rule that holds and ``kept`` per row of ``docs``.

    ``base_failed``: under 50 words, or over half of them in repeated three-word windows. ``kept`` is
    false then, else true if no rule holds. Null and empty texts fail; null ids stay null; repeated
    rows are judged each; an empty table gives no rows.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        statistics(docs, id_col, text_col=text_col)
        .withColumn("base_failed", failed)
        .withColumn("rule", rule_number(rules))
        .select(id_col, *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
    )


def learned_and_judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents by rules learned without the labels of ids with remainder 2 of 4."""
    return judged(docs, fit(docs, labels, remainder_of_id(id_col, 4) != 2, id_col, text_col), id_col, text_col)
