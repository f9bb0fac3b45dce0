import random
from collections import Counter

import numpy as np
import pytest

from telemetra.llm import near_duplicates as ops
from telemetra.llm.components import components
from telemetra.llm.words import WordHashes
from tests.llm.conftest import EDGES


def brute(texts, size=4, percent=80):
    """``(id, set size, smallest linked id)`` by comparing all pairs."""
    sets = []
    for _, text in texts:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    groups = {}
    for i, (key, _) in enumerate(texts):
        groups.setdefault(root(i), []).append(key)
    return sorted((k, len(sets[i]), min(groups[root(i)])) for i, (k, _) in enumerate(texts))


def found(frame, words=4):
    lines = ops.near_duplicates(frame, words).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in lines)
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in lines)


def corpus(source, groups, copies, edits):
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(groups):
        base = source.choices(vocabulary, k=source.choice([3, 5, 12, 40, 120]))
        for _ in range(source.randrange(1, copies)):
            text = list(base)
            for _ in range(source.randrange(edits)):
                text[source.randrange(len(text))] = source.choice(vocabulary)
            texts.append(" ".join(text).upper() if source.random() < 0.2 else " ".join(text))
    source.shuffle(texts)
    return list(enumerate(texts))


def test_components_against_brute_force(documents):
    texts = corpus(random.Random(11), 40, 9, 4)
    assert found(documents(texts)) == brute(texts)


def test_a_chain_through_one_large_group(documents, monkeypatch):
    monkeypatch.setattr(ops, "BLOCK_NODES", 7)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(120):  # neighbours are alike, the ends of the chain are not
        text = list(base)
        text[: i // 3] = [f"v{j}" for j in range(i // 3)]
        text[-1] = f"u{i}"
        texts.append(" ".join(text))
    texts = list(enumerate(texts))
    assert found(documents(texts)) == brute(texts)


def test_near_documents_that_are_not_linked_make_no_row_per_pair(documents, monkeypatch):
    monkeypatch.setattr(ops, "CLUSTER_NODES", 60, raising=False)
    source, base, made, written = random.Random(14), [f"w{i}" for i in range(200)], {}, ops.written

    def counted(df, label):
        out = written(df, label)
        made.setdefault(label, []).append(out.count())
        return out

    texts = []
    for i in range(240):  # most pairs are alike by 0.72, few by 0.8
        text = list(base)
        for at in source.sample(range(4, 196), 4):
            text[at] = f"v{i}"
        texts.append(text)
    texts = [(i, " ".join(text)) for i, text in enumerate(texts)]
    monkeypatch.setattr(ops, "written", counted)
    assert found(documents(texts)) == brute(texts)
    assert max(made["crossing"] + made["confirmed"]) <= made["members"][0]
    assert made["confirmed"][-1] < 4 * len(texts)


def test_a_forest_connects_what_the_pairs_connect():
    rng = np.random.default_rng(15)
    for n, m in ((1, 0), (30, 20), (50, 400), (200, 180)):
        i, j = rng.integers(0, n, (2, m))
        i, j = i[i != j], j[i != j]
        few = ops.spanning_forest(i, j, n)

        def roots(a, b, n=n):
            label = np.arange(n)
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                label[label == max(label[x], label[y])] = min(label[x], label[y])
            return label

        assert (roots(i, j) == roots(i[few], j[few])).all()
        assert len(few) == n - len(set(roots(i, j).tolist()))


def test_signatures_find_every_pair_within_the_distance():
    rng = np.random.default_rng(12)
    signature = ops.Signature()
    first = rng.integers(0, 1 << 32, (200, signature.symbols), dtype=np.uint32)
    second = first.copy()
    for line in second:
        change = rng.choice(signature.symbols, signature.distance, replace=False)
        line[change] ^= np.uint32(1)
    assert (first != second).sum(axis=1).max() == signature.distance == 17
    assert (signature.keys(first) == signature.keys(second)).any(axis=1).all()
    other = ops.Signature(symbols=16, chunks=5, errors=2)
    third = first[:, :16].copy()
    third[:, :14] ^= np.uint32(1)
    assert other.distance == 14 and (other.keys(first[:, :16].copy()) == other.keys(third)).any(axis=1).all()


def test_signature_distance_follows_similarity():
    signature, hashes, source = ops.Signature(symbols=256, sketch=600), WordHashes(), random.Random(13)
    words = [f"w{source.randrange(10**9)}" for _ in range(2000)]
    left, right = (ops.shingle_set(" ".join(w).encode(), hashes, 5) for w in (words, words[:1800]))
    sets = [left, right]
    table, sketch = signature.tables(signature.of(np.concatenate(sets), np.cumsum([0, len(left)])))
    similar = len(np.intersect1d(left, right)) / len(np.union1d(left, right))
    assert abs((table[0] == table[1]).mean() - similar) < 0.08
    assert abs((sketch[0] == sketch[1]).mean() - similar) < 0.06
    assert signature.sketch_distance(100) == 0 and 140 < ops.Signature().sketch_distance(80) < 155


def test_edges(edges, documents):
    lines = {repr(r["doc_id"]): r for r in ops.near_duplicates(edges).collect()}
    assert lines["4"]["component_id"] == 4 and lines["4"]["kept"] and lines["4"]["n_shingles"] == 1
    assert all(lines[k]["n_shingles"] == 0 and lines[k]["kept"] for k in ("1", "2", "3"))
    assert lines["None"]["component_id"] is None and lines["None"]["kept"]
    assert ops.near_duplicates(edges).count() == len(EDGES)
    assert ops.near_duplicates(documents([])).count() == 0


def test_one_of_each_group_stays(documents):
    base = " ".join(f"w{i}" for i in range(50))
    data = [(7, base), (3, base + " end"), (3, base + " end"), (9, "other text"), (None, base), (5, None), (8, "OTHER  text")]
    frame = documents(data).selectExpr("*", "1 AS named", "false AS stays", "2 AS n", "3 AS hash", "4 AS kept")
    kept = ops.one_of_each(frame)
    assert kept.columns == frame.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == {3: 1, 8: 1, 5: 1, None: 1}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_a_graph(spark, seed):
    source = random.Random(seed)
    links = [(source.randrange(300), source.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    up = {n: n for pair in links for n in pair}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        up[root(a)] = root(b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(got) == {n for a, b in links if a != b for n in (a, b)}
    by_got, by_want = {}, {}
    for n in got:
        by_got.setdefault(got[n], set()).add(n)
        by_want.setdefault(root(n), set()).add(n)
    assert sorted(map(sorted, by_got.values())) == sorted(map(sorted, by_want.values()))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
