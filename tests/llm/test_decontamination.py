import random

import numpy as np
import pytest

from telemetra.llm import decontamination
from telemetra.llm.decontamination import Items, contamination, decontaminated
from tests.llm.conftest import EDGES


def tiled_by_definition(text, item, least):
    """Greedy string tiling as published: scan for the longest unmarked matches, mark them, repeat."""
    p, t = item, text
    marked_p, marked_t = [False] * len(p), [False] * len(t)
    while True:
        longest, matches = least, []
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not marked_p[i + k] and not marked_t[j + k]:
                    k += 1
                if k > longest:
                    longest, matches = k, [(i, j)]
                elif k == longest:
                    matches.append((i, j))
        if not matches:
            return sum(marked_p)
        for i, j in matches:
            if not any(marked_p[i : i + longest]) and not any(marked_t[j : j + longest]):
                for k in range(longest):
                    marked_p[i + k] = marked_t[j + k] = True


def test_tiling_against_the_definition():
    source = random.Random(10)
    for _ in range(300):
        item = source.choices("abcdefghijklmnopqrstuvwxyz", k=source.randrange(1, 30))
        text = []
        for _ in range(source.randrange(5)):
            begin = source.randrange(len(item))
            text += source.choices("xyz", k=source.randrange(4)) + item[begin : begin + source.randrange(12)]
        items = Items([(1, " ".join(item).encode())], 5)
        n, marked = items.covered(" ".join(text).encode())
        assert n == len(text)
        least = min(5, len(item))
        assert marked.get(1, 0) == tiled_by_definition(text, item, least), (item, text)


ITEM = " ".join(f"w{i}" for i in range(40))
WORDS = ITEM.split()
REORDERED = " ".join(WORDS[20:] + ["and"] + WORDS[:20])


@pytest.fixture
def benchmark(spark):
    data = [(1, ITEM), (2, "just three words"), (3, None), (None, "no id but words that are many"), (4, "")]
    return spark.createDataFrame(data, "item_id long, text string")


def test_reordered_and_partial_passages(documents, benchmark):
    texts = [
        (1, f"before {ITEM.upper()}, after"),
        (2, f"x {REORDERED} y"),
        (3, " ".join(WORDS[:19])),
        (4, " ".join(WORDS[:20]) + "."),
        (5, " z ".join(WORDS)),
        (6, "some just three. words some"),
        (7, "just three other words"),
    ]
    found = {r["doc_id"]: r for r in contamination(documents(texts), benchmark).collect()}
    assert {i for i, r in found.items() if r["contaminated"]} == {1, 2, 4, 6}
    assert found[2]["coverage"] == 1.0 and found[2]["item_ids"] == [1] and found[6]["item_id"] == 2
    assert found[3]["coverage"] == 19 / 40 and found[5]["coverage"] == 0 and found[5]["item_id"] is None
    assert {r["doc_id"] for r in decontaminated(documents(texts), benchmark).collect()} == {3, 5, 7}


def test_blocks_change_nothing(documents, benchmark, monkeypatch):
    texts = [(i, " ".join(WORDS[i:] + ["just three words"] * (i % 2))) for i in range(40)]
    whole = sorted(map(str, contamination(documents(texts), benchmark).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 60)
    assert sorted(map(str, contamination(documents(texts), benchmark).collect())) == whole


def test_edges(spark, edges, documents, benchmark):
    found = contamination(edges, benchmark).collect()
    assert len(found) == len(EDGES) and not any(r["contaminated"] for r in found)
    assert contamination(documents([]), benchmark).count() == 0
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert contamination(edges, nothing).where("contaminated").count() == 0
    kept = decontaminated(edges, nothing)
    assert kept.count() == len(EDGES) and kept.columns == edges.columns


def test_a_repeated_passage_costs_its_length():
    items = Items([(1, ITEM.encode())], 5)
    n, marked = items.covered((ITEM + " ") .encode() * 300)
    assert n == 12_000 and marked == {1: 40}
    assert np.isfinite(n)


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_repeated_rows_and_several_texts_of_an_id(spark, documents, monkeypatch, block_bytes):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    other = " ".join(f"v{i}" for i in range(12))
    data = [(1, ITEM), (1, ITEM), (1, other), (1, ITEM.upper()), (2, " ".join(WORDS[:18])), (2, " ".join(WORDS[:18]))]
    benchmark = spark.createDataFrame(data, "item_id long, text string")
    texts = [(1, ITEM), (2, other), (3, "x " + " ".join(WORDS[:9]) + " y"), (4, " ".join(f"v{i}" for i in range(5))), (5, "none")]
    found = {r["doc_id"]: r for r in contamination(documents(texts), benchmark).collect()}
    assert found[1]["item_ids"] == [1, 2] and found[1]["item_id"] == 1 and found[1]["n_items"] == 2
    assert found[2]["item_ids"] == [1] and found[2]["coverage"] == 1.0
    assert found[3]["item_ids"] == [2] and found[3]["coverage"] == 9 / 18
    assert found[4]["item_ids"] == [] and found[4]["coverage"] == 5 / 12
    assert {r["doc_id"] for r in decontaminated(documents(texts), benchmark).collect()} == {4, 5}


def test_blocks_are_collected_one_by_one(documents, benchmark, monkeypatch):
    drawn, seen = [], []
    blocks, write = decontamination.benchmark_blocks, decontamination.written

    def counted(*args):
        for block in blocks(*args):
            drawn.append(block)
            yield block

    def noted(frame, label):
        seen.append(len(drawn))
        return write(frame, label)

    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 60)
    monkeypatch.setattr(decontamination, "benchmark_blocks", counted)
    monkeypatch.setattr(decontamination, "written", noted)
    contamination(documents([(1, ITEM)]), benchmark).collect()
    assert len(drawn) > 2 and seen == list(range(2, len(drawn) + 1))


def test_item_ids_may_be_texts(spark, documents):
    data = [("b", ITEM), ("a", ITEM), ("c", "just three words"), (None, ITEM)]
    benchmark = spark.createDataFrame(data, "item_id string, text string")
    texts = [(1, ITEM), (2, "some just three words"), (3, "nothing of it")]
    found = {r["doc_id"]: r for r in contamination(documents(texts), benchmark).collect()}
    assert found[1]["item_ids"] == ["a", "b"] and found[1]["item_id"] == "a"
    assert found[2]["item_ids"] == ["c"] and found[3]["item_id"] is None and found[3]["item_ids"] == []
    assert {r["doc_id"] for r in decontaminated(documents(texts), benchmark).collect()} == {3}
