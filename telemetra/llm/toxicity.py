"""Toxic passages by maximum-scoring segments of token log-odds.

Tokens get the log-odds of toxic against clean labelled text under a Dirichlet prior that follows
the token's overall frequency. A token counts once per labelled document, so that one long document
cannot make it toxic. Less a margin, so that an average token scores below zero, the scores
of a text form a walk whose maximal segments are all found in one linear scan. Extreme-value theory
says how often a clean text of that length has a segment of that score (K m e^(-lambda s)); the
strongest evidence over the best one, two, three... up to all segments is calibrated to a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm.common import arrow_schema, map_rows, remainder_of_id, rows_where
from telemetra.llm.labelled import labelled_sample, logistic, logistic_fit
from telemetra.llm.words import plain_words

#: Labelled documents that the model is fitted on, at most.
SAMPLE_DOCUMENTS = 20_000
#: The Dirichlet prior of a token: this much, and its share of so many tokens.
PRIOR_EACH = 0.5
PRIOR_TOKENS = 500.0
#: Log-odds count where they are this many standard deviations above zero.
LEAST_Z = 3.0
#: What every token loses, so that an average one scores below zero.
MARGIN = 1.0


@dataclass(frozen=True)
class ToxicityModel:
    score_of: dict[bytes, float]
    decay: float  # lambda of the extreme-value law
    rate: float  # its K
    weights: tuple[float, float]


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(start, end, score)`` in one pass (Ruzzo and Tompa).

    A segment is kept while no earlier one with a smaller running total before it can be joined at a
    gain. Kept segments are candidates with the totals left and right of them.
    """
    kept: list[list] = []  # start, end, total before, total after
    total = 0.0
    for i, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        segment = [i, i + 1, before, total]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= segment[2]:
                j -= 1
            if j < 0 or kept[j][3] >= segment[3]:
                kept.append(segment)
                break
            segment = [kept[j][0], segment[1], kept[j][2], segment[3]]
            del kept[j:]
    return [(start, end, after - before) for start, end, before, after in kept]


def toxic_passages(model: ToxicityModel, text: bytes) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of words and the segments by position.

    Runs of tokens without positive score are summed up first, so the scan visits little more than
    the scoring tokens.
    """
    words = plain_words(text)
    get = model.score_of.get
    hits = [(i, s) for i, s in enumerate(map(get, words)) if s is not None]
    steps, ends, at = [], [], 0
    for i, score in hits:
        if i > at:
            steps.append(-MARGIN * (i - at))
            ends.append((at, i))
        steps.append(score)
        ends.append((i, i + 1))
        at = i + 1
    return len(words), [(ends[a][0], ends[b - 1][1], s) for a, b, s in maximal_segments(steps)]


def evidence(model: ToxicityModel, n_words: int, segments: list[tuple[int, int, float]]) -> float:
    """Largest -log10 p over the best r segments of any number, p from a Poisson law of chance segments."""
    best = 0.0
    ranked = sorted((s for _, _, s in segments), reverse=True)
    for r, score in enumerate(ranked, 1):
        expected = model.rate * max(n_words, 1) * math.exp(-model.decay * score)
        # P(at least r chance segments) is at most expected^r / r!
        log_p = r * math.log(max(expected, 1e-300)) - math.lgamma(r + 1)
        best = max(best, -log_p / math.log(10))
    return min(best, 60.0)


def log_odds(toxic: Counter, clean: Counter) -> dict[bytes, float]:
    """Scores of the tokens that stand for toxic text, margin taken off."""
    n_toxic, n_clean = sum(toxic.values()), sum(clean.values())
    total = n_toxic + n_clean
    scored = []
    for word, y in toxic.items():
        prior = PRIOR_EACH + PRIOR_TOKENS * (y + clean.get(word, 0)) / total
        yt, yc = y + prior, clean.get(word, 0) + prior
        odds = math.log(yt / (n_toxic + PRIOR_TOKENS - yt)) - math.log(yc / (n_clean + PRIOR_TOKENS - yc))
        z = odds / math.sqrt(1 / yt + 1 / yc)
        if z >= LEAST_Z and odds > MARGIN:
            scored.append((-z, word, odds - MARGIN))
    scored.sort()
    return {word: score for _, word, score in scored}


def extreme_value_law(
    clean_texts: list[tuple[int, list[float]]], scores: dict[bytes, float], clean: Counter
) -> tuple[float, float]:
    """``lambda`` solves E[e^(lambda s)] = 1 over clean tokens.

    ``K`` is such that as many segments as seen in clean texts reach the median of their scores.
    """
    total = max(1, sum(clean.values()))
    positive = [(scores[w], clean[w] / total) for w in scores if w in clean]
    rest = 1.0 - sum(p for _, p in positive)

    def excess(decay: float) -> float:
        return rest * math.exp(-decay * MARGIN) + sum(p * math.exp(decay * s) for s, p in positive) - 1.0

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 8.0:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    decay = (low + high) / 2
    words = max(1, sum(n for n, _ in clean_texts))
    found = sorted(s for _, segments in clean_texts for s in segments)
    middle = found[len(found) // 2] if found else 0.0
    return decay, max(len(found), 1) / 2 / words * math.exp(min(decay * middle, 50.0))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    limit: int = SAMPLE_DOCUMENTS,
) -> ToxicityModel:
    """A model from at most ``limit`` labelled documents: token counts from two thirds, calibration on the rest."""
    sample = labelled_sample(docs, labels, label_col, allowed, limit, id_col, text_col)
    frame = sample.select("draw", "label", F.col("text").cast("binary").alias("text"))
    fold = F.col("draw") < 667

    def counted(lines: Iterator[tuple]) -> Iterator[tuple]:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for _, label, text in lines:
            counts[label].update(set(plain_words(text)))
            if sum(map(len, counts.values())) > 200_000:
                yield from ((label, w, n) for label, c in counts.items() for w, n in c.items())
                counts = {0: Counter(), 1: Counter()}
        yield from ((label, w, n) for label, c in counts.items() for w, n in c.items())

    schema = pa.schema([("label", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])
    by_word = (
        map_rows(frame.where(fold), "label int, word binary, n bigint", schema, counted)
        .groupBy("word")
        .agg(
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"),
        )
    )
    # Words of the bounded sample; a word seen once in clean text only bears on the totals.
    totals = by_word.agg(F.sum("toxic"), F.sum("clean")).first()
    toxic: Counter = Counter()
    clean: Counter = Counter()
    for line in by_word.where("toxic >= 2").collect():
        toxic[bytes(line["word"])], clean[bytes(line["word"])] = line["toxic"], line["clean"]
    toxic[b""] = (totals[0] or 0) - sum(toxic.values())
    clean[b""] = (totals[1] or 0) - sum(clean.values())
    scores = log_odds(toxic, clean) if toxic.total() and clean.total() else {}
    scores.pop(b"", None)
    raw = ToxicityModel(scores, 1.0, 1.0, (0.0, 0.0))
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def segmented(lines: Iterator[tuple]) -> Iterator[tuple]:
        for _, label, text in lines:
            n, segments = toxic_passages(shared.value, text)
            yield label, n, [s for _, _, s in segments]

    schema = pa.schema([("label", pa.int32()), ("n", pa.int64()), ("found", pa.list_(pa.float64()))])
    held = map_rows(frame.where(~fold), "label int, n bigint, found array<double>", schema, segmented).collect()
    decay, rate = extreme_value_law([(h["n"], h["found"]) for h in held if h["label"] == 0], scores, clean)
    model = ToxicityModel(scores, decay, rate, (0.0, 0.0))
    seen = np.array([[evidence(model, h["n"], [(0, 0, s) for s in h["found"]])] for h in held]).reshape(-1, 1)
    weights = logistic_fit(seen, np.array([h["label"] for h in held], dtype=float))
    return ToxicityModel(scores, decay, rate, (float(weights[0]), max(0.0, float(weights[1]))))


def scored(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.7) -> DataFrame:
    """``(id, score, predicted, n_words, n_passages, evidence, passages)`` per row of ``docs``.

    ``passages`` are the significant segments as ``(first word, word after, score)``: those that are
    expected less than once in a clean text of the same length. A null or empty text has no words
    and gets the score of no evidence; null ids stay null; repeated rows are scored each; an empty
    table gives no rows.
    """
    frame = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = frame.schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("first", pa.int64()), ("after", pa.int64()), ("score", pa.float64())])
    out = pa.schema(
        [
            arrow_schema(frame).field(0),
            ("score", pa.float64()),
            ("predicted", pa.int32()),
            ("n_words", pa.int64()),
            ("n_passages", pa.int64()),
            ("evidence", pa.float64()),
            ("passages", pa.list_(passage)),
        ]
    )

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        model = shared.value
        for key, text in lines:
            n, segments = toxic_passages(model, text)
            found = evidence(model, n, segments)
            score = float(logistic(np.array([model.weights[0] + model.weights[1] * found]))[0])
            bound = math.log(max(model.rate * max(n, 1), 1e-12)) / model.decay
            strong = [{"first": a, "after": b, "score": s} for a, b, s in segments if s > bound]
            yield key, score, int(score >= cut), n, len(strong), found, strong

    names = (
        f"`{id_col}` {kind}, score double, predicted int, n_words bigint, n_passages bigint, evidence double, "
        "passages array<struct<first:bigint,after:bigint,score:double>>"
    )
    return map_rows(frame, names, out, convert)


def held_out_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all documents by a model that has not seen labels of ids with remainder 1 of 3."""
    model = fit(docs, labels, remainder_of_id(id_col, 3) != 1, id_col, text_col)
    return scored(docs, model, id_col, text_col).withColumn("held_out", remainder_of_id(id_col, 3) == 1)


def clean_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text", cut: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``; all columns pass through."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def test():
        model = shared.value

        def clean(text: bytes) -> bool:
            found = evidence(model, *toxic_passages(model, text))
            return float(logistic(np.array([model.weights[0] + model.weights[1] * found]))[0]) < cut

        return clean

    return rows_where(docs, test, F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
