import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetra.llm import language_model as ops
from telemetra.llm.common import table
from tests.llm.conftest import EDGES

SF_DIR = "/root/testdata/sf0.001"


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def base_by_loop(lines, training):
    counts = Counter(t for (_, text), yes in zip(lines, training, strict=True) if yes for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for _, text in lines:
        own = tokens(text)
        score = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        out.append((len(own), sum(counts[t] > 0 for t in own), n, score))
    return out


def test_base_scores_and_gain_on_held_out_texts(spark):
    docs = table(spark, SF_DIR, "documents")
    found = {r["doc_id"]: r for r in ops.held_out_scores(docs).collect()}
    lines = [(r["doc_id"], r["text"]) for r in docs.collect()]
    training = [not found[i]["held_out"] for i, _ in lines]
    for (i, _), (n, known, total, score) in zip(lines, base_by_loop(lines, training), strict=True):
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_every_word_has_its_own_estimates(documents):
    source = random.Random(16)
    texts = [(i, " ".join(source.choices([f"w{k}" for k in range(60)], weights=[1 / (k + 1) ** 2 for k in range(60)], k=12))) for i in range(60)]
    texts += [(100, "once only"), (101, "once never"), (102, "never once only"), (103, "")]
    lines = [(i, tokens(text), i % 4 != 1) for i, text in texts]
    words, pairs = Counter(), Counter()
    for _, own, yes in lines:
        if yes:
            words.update(own)
            pairs.update(zip([b"", *own], own, strict=False))
    n, v = sum(words.values()), len(words)
    assert min(words.values()) == 1
    bins = Counter()
    for (a, b), times in pairs.items():
        bins[int(ops.share_codes(*(np.array([x]) for x in (times, words[a], words[b])), n)[0])] += times
    weights = ops.context_weights(list(bins.items()), v + 1)

    def probability(a, b):
        together, single, uniform = weights[ops.context_bucket(np.array([words[a]]))[0]]
        return together * pairs[a, b] / max(words[a], 1) + single * words[b] / n + uniform / (v + 1)

    for a in [*words, b"unseen"]:
        assert words[a] == 0 or sum(probability(a, b) for b in [*words, b"unseen"]) == pytest.approx(1.0)
    found = {r["doc_id"]: r["score"] for r in ops.scores(documents(texts), F.col("doc_id") % 4 != 1).collect()}
    for i, own, _ in lines:
        assert found[i] == pytest.approx(sum(math.log10(probability(a, b)) for a, b in zip([b"", *own], own, strict=False)))


def test_small_blocks_and_many_buckets_change_nothing(documents):
    source = random.Random(15)
    texts = [(i, " ".join(source.choices(["a", "b", "c", "d e f"], k=30))) for i in range(40)]
    frame = documents(texts)
    training = F.col("doc_id") % 4 != 0
    one = {r["doc_id"]: tuple(r)[1:] for r in ops.scores(frame.coalesce(1), training).collect()}
    spark = frame.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        many = {r["doc_id"]: tuple(r)[1:] for r in ops.scores(frame.repartition(9), training).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for i, line in one.items():
        assert many[i][:4] == line[:4] and many[i][4:] == pytest.approx(line[4:])


def test_edges(edges, documents):
    lines = ops.held_out_scores(edges).collect()
    assert len(lines) == len(EDGES) and all(np.isfinite([r["base_score"], r["score"]]).all() for r in lines)
    assert sorted(r["n_tokens"] for r in lines) == sorted(len(tokens(t)) for _, t in EDGES)
    nothing = ops.scores(edges, F.lit(False)).collect()
    assert all(r["train_tokens"] == r["n_known"] == 0 and r["base_score"] == 0 for r in nothing)
    assert ops.held_out_scores(documents([])).count() == 0
