import random

import numpy as np
import pytest

from telemetra.llm import toxicity
from telemetra.llm.common import remainder_of_id, table
from telemetra.llm.toxicity import maximal_segments
from tests.llm.conftest import EDGES

SF_DIR = "/root/testdata/sf0.01"


def segments_by_definition(scores):
    """Maximal segments by recursion: the best one, then the same to its left and right."""

    def best(low, high):
        found = None
        for i in range(low, high):
            total = 0
            for j in range(i, high):
                total += scores[j]
                if total > 0 and (found is None or total > found[2]):
                    found = (i, j + 1, total)
        if found is None:
            return []
        return [*best(low, found[0]), found, *best(found[1], high)]

    return best(0, len(scores))


def test_segments_against_the_definition():
    source = random.Random(7)
    for _ in range(600):
        # Distinct powers make all sums different, so that the best segment is unique.
        scores = [source.choice([-1, 1]) * (source.random() + 0.01) for _ in range(source.randrange(25))]
        found = [(a, b, round(s, 9)) for a, b, s in maximal_segments(scores)]
        assert found == [(a, b, round(s, 9)) for a, b, s in segments_by_definition(scores)]


def test_held_out_documents(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    scores = toxicity.held_out_scores(docs, labels)
    assert scores.count() == docs.count()
    held = scores.where("held_out").join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in held)
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.9
    clean = [r["predicted"] for r in held if r["toxic"] == 0]
    assert np.mean(clean) < 0.05


def test_passages_have_their_words():
    model = toxicity.ToxicityModel({b"bad": 5.0, b"worse": 7.0}, 1.0, 0.01, (-3.0, 1.0))
    text = b"some clean words here, bad worse and many more clean words follow until Bad."
    n, segments = toxicity.toxic_passages(model, text)
    assert n == 14 and segments == [(4, 6, 12.0), (13, 14, 5.0)]
    assert toxicity.evidence(model, n, segments) > toxicity.evidence(model, n, segments[1:]) > 0
    assert toxicity.toxic_passages(model, b"")[1] == [] and toxicity.evidence(model, 0, []) == 0


def test_all_passages_count():
    model = toxicity.ToxicityModel({b"bad": 5.0}, 1.0, 0.01, (-3.0, 1.0))
    n, segments = toxicity.toxic_passages(model, b" ".join([b"bad", *[b"word"] * 999] * 80))
    assert n == 80_000 and len(segments) == 80
    assert toxicity.evidence(model, n, segments[:8]) == 0 and toxicity.evidence(model, n, segments) > 10


@pytest.mark.parametrize("labelled", [[], [(1, 1)], [(6, 0)], [(4, 1), (4, 0), (6, 0), (None, 1), (5, None)]])
def test_edges(spark, edges, documents, labelled):
    labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
    scores = toxicity.held_out_scores(edges, labels).collect()
    assert len(scores) == len(EDGES) and all(0 <= r["score"] <= 1 for r in scores)
    assert toxicity.held_out_scores(documents([]), labels).count() == 0
    model = toxicity.fit(edges, labels, remainder_of_id("doc_id", 3) != 1)
    kept = toxicity.clean_documents(edges, model)
    assert kept.columns == edges.columns
    assert kept.count() == sum(r["score"] < 0.7 for r in scores)
