import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from telemetra.llm import packing
from telemetra.llm.catalogue import tokenizer_file
from tests.llm.conftest import EDGES

FILE = tokenizer_file("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(FILE)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def check_pieces(pieces, texts, capacity):
    """Every id lies in one piece, sequences have no gaps, checksums hold."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
    for key, text in texts:
        ids = ids_of(text)
        own = sorted(by_doc[key], key=lambda p: p["start"])
        assert {p["doc_tokens"] for p in own} == {len(ids)}
        assert np.frombuffer(b"".join(p["ids"] for p in own), dtype="<u4").tolist() == ids
        assert [p["start"] for p in own] == [sum(q["length"] for q in own[:i]) for i in range(len(own))]
    fills = []
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == [sum(q["length"] for q in own[:i]) for i in range(len(own))]
        fills.append(sum(p["length"] for p in own))
    assert max(fills) <= capacity
    return fills


def test_ids_equal_the_library():
    source, encoder = random.Random(2), packing.word_ids(FILE)
    alphabet = "aabcdeTHE  \n\t.,'’-éßÉΣ漢😀<>|0123\x85\x1c"
    texts = ["".join(source.choices(alphabet, k=source.randrange(50))) for _ in range(3000)]
    texts += ["a. b, c.. d.\n", "É. é, x.", "<|endoftext|> <|ENDOFTEXT|> A.", "it's. We'LL", "é. ñ"]
    found = list(encoder.ids([t.encode() for t in texts]))
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in found] == [ids_of(t)[:-1] for t in texts]


def test_pieces_are_whole_and_windows_full(documents):
    source = random.Random(3)
    texts = [(i, " ".join(source.choices(["the", "cat", "sat", "qzx", "."], k=source.choice([0, 3, 40, 200])))) for i in range(150)]
    frame = documents(texts)
    fills = check_pieces(packing.pack(frame, FILE, capacity=64).collect(), texts, 64)
    assert sum(f < 64 for f in fills) <= frame.rdd.getNumPartitions()


def test_edges(edges, documents):
    pieces = packing.pack(edges, FILE, capacity=32).collect()
    assert len({(p["sequence_id"], p["offset"]) for p in pieces}) == len(pieces)
    assert sum(p["length"] for p in pieces) == sum(len(ids_of(t)) for _, t in EDGES)
    assert packing.pack(documents([]), FILE).count() == 0


def test_level_minimises_the_sum_of_squares():
    source, capacity = random.Random(4), 24
    packer = packing.SumOfSquares(capacity)
    for _ in range(500):
        size = source.randrange(1, capacity)
        before = packer.levels.copy()
        costs = {}
        for level in range(capacity - size + 1):
            if level and not before[level]:
                continue
            after = before.copy()
            if level:
                after[level] -= 1
            if level + size < capacity:
                after[level + size] += 1
            costs[level] = int((after[1:capacity] ** 2).sum())
        chosen = packer.level_for(size)
        assert costs[chosen] == min(costs.values())
        list(packer.place((0, size), 0, b"x" * 4 * size))
        assert packer.levels[capacity] == 0 and packer.levels[0] == 0


def test_a_part_is_cut_at_the_level_of_the_rule_while_no_window_may_be_opened():
    packer = packing.SumOfSquares(10)
    for size in (6, 6, 6, 7, 7, 8, 8, 9):
        assert not list(packer.place((0, size), 0, b"x" * 4 * size))
    assert packer.open == packing.FEWEST_OPEN and packer.level_for(5, may_open=False) == 6
    cut, rest = packer.place((1, 5), 0, b"y" * 20)
    assert [(p[0], p[1], len(p[2])) for p in cut] == [((0, 6), 0, 24), ((1, 5), 0, 16)]
    assert [(p[0], p[1], len(p[2])) for p in rest] == [((0, 9), 0, 36), ((1, 5), 4, 4)]
    assert packer.open == packing.FEWEST_OPEN - 2
    assert [len(w) for w in packer.place((2, 30), 0, b"z" * 120)] == [1, 1, 1]


def test_most_windows_are_filled_by_the_rule_in_small_partitions():
    source = random.Random(5)
    packer, filled = packing.SumOfSquares(2048), 0
    for _ in range(2000):  # about a partition of 32 of the small tables
        n = min(20_000, int(source.lognormvariate(5.5, 1.2)) + 1)
        filled += len(list(packer.place((0, n), 0, b"x" * 4 * n)))
    rest = len(list(packing.refill(packer.rest(), 2048)))
    assert filled > 10 * rest and packer.open <= max(packing.FEWEST_OPEN, filled // packing.OPEN_SHARE)


def test_a_text_of_megabytes(documents):
    texts = [(1, "the cat " * 300_000), (2, "x" * 300_000), (3, None)]
    assert len(check_pieces(packing.pack(documents(texts), FILE).collect(), texts, 2048)) > 290


def test_the_memo_makes_room(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_WORDS", 6)
    encoder = packing.WordIds(FILE)
    for text in ["a b c d.", "d. e f", "a b, c", "g h i j k", "a d."] * 2:
        (found,) = encoder.ids([text.encode()])
        assert np.frombuffer(found, dtype="<u4").tolist() == ids_of(text)[:-1]
