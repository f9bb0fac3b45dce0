import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetra.llm import quality_classifier, quality_rules
from telemetra.llm.common import remainder_of_id, table
from telemetra.llm.quality_rules import base_statistics
from telemetra.llm.words import WordHashes
from tests.llm.conftest import EDGES

SF_DIR = "/root/testdata/sf0.01"
BLANKS = set(" \t\n\x0b\x0c\r")


def plain_counts(text):
    """The counts of the contract, spelled out."""
    words, word = [], ""
    for c in text + " ":
        if c in BLANKS:
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if set(line) - BLANKS:
            duplicates += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(repeated)]


def test_counts_against_a_plain_loop():
    source = random.Random(6)
    hashes = WordHashes()
    for _ in range(800):
        text = "".join(source.choices(["a", "b", "é", " ", "  ", "\n", "\t", "#", "\x85", "\x1c", "c d e"], k=source.randrange(40)))
        assert base_statistics(text.encode(), hashes)[0] == plain_counts(text), text


def test_rules_separate_planted_classes():
    rng = np.random.default_rng(1)
    n = 600
    bad = rng.random(n) < 0.3
    data = {name: rng.random(n) for name in quality_rules.STATISTICS}
    kind = rng.random(n) < 0.5
    data["symbol_share"] = np.where(bad & kind, 0.5 + 0.1 * rng.random(n), 0.1 * rng.random(n))
    data["repeat_share"] = np.where(bad & ~kind, 0.8 + 0.1 * rng.random(n), 0.3 * rng.random(n))
    rules = quality_rules.learn(data, bad, rng.random(n) < 0.67)
    covered = np.zeros(n, dtype=bool)
    for rule in rules:
        covered |= quality_rules.covered_by(rule, data, n)
    assert (covered == bad).mean() > 0.99 and len(rules) <= 3


def test_the_list_is_one_ordered_expression(spark):
    test = quality_rules.Test
    rules = [(test("words", True, 10.0), test("symbol_share", False, 0.5)), (test("words", True, 5.0),)]
    frame = spark.createDataFrame([(12.0, 0.1), (12.0, 0.9), (6.0, 0.1), (1.0, 0.1)], "words double, symbol_share double")
    assert [r[0] for r in frame.select(quality_rules.rule_number(rules)).collect()] == [1, 2, 2, 0]
    assert frame.select(quality_rules.rule_number([])).first()[0] == 0


def test_rules_on_documents(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    found = quality_rules.learned_and_judged(docs, labels).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        counts = plain_counts(r["text"])
        assert [r[c] for c in quality_rules.COUNTS] == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r["base_failed"] and r["kept"])


def test_rules_hold_on_labels_they_have_not_seen(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    held_out = remainder_of_id("doc_id", 4) == 2
    rules = quality_rules.fit(docs, labels, ~held_out)
    held = docs.join(labels.where(held_out).select("doc_id"), "doc_id")
    found = quality_rules.judged(held, rules).join(labels, "doc_id").where("not base_failed").collect()
    assert len(found) > 500 and np.mean([r["kept"] == bool(r["quality"]) for r in found]) > 0.95
    assert np.mean([r["kept"] for r in found if r["quality"] == 1]) > 0.98


def test_classifier_on_documents(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    scores = quality_classifier.held_out_scores(docs, labels)
    assert scores.count() == docs.count()
    held = scores.where("held_out").join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in held)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.9


@pytest.mark.parametrize("labelled", [[], [(1, 1)], [(6, 0)], [(4, 1), (4, 0), (6, 0), (None, 1), (5, None)]])
def test_edges(spark, edges, documents, labelled):
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    scores = quality_classifier.held_out_scores(edges, labels).collect()
    assert len(scores) == len(EDGES) and all(0 <= r["score"] <= 1 for r in scores)
    found = quality_rules.learned_and_judged(edges, labels).collect()
    assert len(found) == len(EDGES)
    assert {r["doc_id"] for r in found if r["n_words"] >= 50} == {6} and not any(r["kept"] for r in found)
    assert quality_classifier.held_out_scores(documents([]), labels).count() == 0
    assert quality_rules.learned_and_judged(documents([]), labels).count() == 0


def test_blocks_come_in_turn_from_whole_texts(spark):
    size = quality_classifier.BLOCK_BYTES
    long = bytes(i % 251 for i in range(3 * size + 7)) * 40
    texts = [(1, 1, long), (2, 1, b"short"), (3, 1, b""), (4, 0, b"x" * (2 * size))]
    frame = spark.createDataFrame(texts, "doc_id long, label int, text binary")
    found = quality_classifier.training_blocks(frame, "doc_id", 50)
    assert len(found[1]) == 50 and b"short" in found[1][:2] and all(b in long for b in found[1] if b != b"short")
    assert found[0] == [b"x" * size] * 2
    whole = quality_classifier.training_blocks(frame, "doc_id")[1]
    assert sum(map(len, whole)) == len(long) + 5
    assert quality_classifier.training_blocks(frame.where("false"), "doc_id") == {0: [], 1: []}


def test_dictionaries_of_any_blocks():
    source = random.Random(3)
    for n in (0, 1, 2, 7, 30, 300, 3000):
        blocks = [" ".join(source.choices(["alpha", "beta", "gamma", "delta"], k=source.randrange(1, 150))).encode() for _ in range(n)]
        built = quality_classifier.dictionary(blocks)
        assert 0 < len(built) <= quality_classifier.DICTIONARY_BYTES[1]
        assert quality_classifier.Sizes(built, built).features(b"alpha beta")[0] == 0


def test_folds_follow_the_checksum(spark):
    import zlib

    frame = spark.range(50).withColumnRenamed("id", "doc_id").withColumn("r", remainder_of_id("doc_id", 4))
    assert all(r["r"] == zlib.crc32(str(r["doc_id"]).encode()) % 4 for r in frame.collect())
    assert spark.range(1).select(F.lit(None).cast("long").alias("i")).select(remainder_of_id("i", 4)).first()[0] == -1
