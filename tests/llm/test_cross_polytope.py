import numpy as np
import pytest

from telemetra.llm import cross_polytope
from telemetra.llm.common import table

SF = "/root/testdata/sf0.01"


def frame(spark, data):
    schema = "vec_id long, embedding array<float>, size int, bucket string"
    return spark.createDataFrame([(i, v, 1, "x") for i, v in data], schema).repartition(3)


def by_definition(data, k):
    """Nearest of each query by comparing it with everything; null and unfit vectors left out."""
    fit = {
        (i, tuple(np.float32(v).tolist()))
        for i, v in data
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    out = []
    for query in sorted({i for i, _ in fit if i % 20 == 0}):
        scores = {}
        for own, left in fit:
            for other, right in fit:
                if own == query and other != query and len(left) == len(right):
                    score = cross_polytope.inner(np.array([left]), np.array([right]))[0]
                    scores[other] = max(score, scores.get(other, -np.inf))
        ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(query, rank, other, score) for rank, (other, score) in enumerate(ranked, 1)]
    return out


def found(df):
    return sorted(map(tuple, df.collect()))


def recall(got, exact):
    return len({x[::2] for x in got} & {x[::2] for x in exact}) / len(exact)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    return [(i, rng.normal(size=24).astype(np.float32).tolist()) for i in range(900)]


def test_recall_and_scores(spark, vectors):
    got, exact = found(cross_polytope.nearest(frame(spark, vectors))), by_definition(vectors, 20)
    assert len(got) == len(exact) and recall(got, exact) >= 0.9
    scores = {i: np.array(v, dtype=np.float64) for i, v in vectors}
    assert all(s == pytest.approx(float(scores[q] @ scores[v]), abs=1e-12) for q, _, v, s in got)
    ranks = [[x for x in got if x[0] == q] for q in range(0, 900, 20)]
    assert all([x[1] for x in sorted(r, key=lambda x: (-x[3], x[2]))] == list(range(1, 21)) for r in ranks)


def test_norms_count(spark, vectors):
    """The largest inner products are not the smallest angles."""
    rng = np.random.default_rng(4)
    data = [(i, (np.array(v) * rng.lognormal(0, 0.7)).tolist()) for i, v in vectors]
    assert recall(found(cross_polytope.nearest(frame(spark, data))), by_definition(data, 20)) >= 0.9


def test_many_axes(spark, vectors, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BUCKET_ROWS", 0.5)
    monkeypatch.setattr(cross_polytope, "CELL_ROWS", 7)
    df = frame(spark, vectors)
    whole = cross_polytope.vectors_of(df, "vec_id", "embedding")
    assert cross_polytope.fitted(whole, whole.where("id % 20 = 0"), 5, 4).axes == 2
    assert recall(found(cross_polytope.nearest(df, k=5)), by_definition(vectors, 5)) >= 0.9


def test_probes_come_in_order(vectors):
    index = cross_polytope.Index(2, 2, 10.0)
    queries = np.array([v for _, v in vectors[:5]])
    few, many = index.probed(queries, 9), index.probed(queries, 4096)
    assert np.array_equal(few, many[:, :, :9])
    assert all(len(set(row.tolist())) == 4096 for row in many.reshape(-1, 4096))


def test_large_group_of_copies(spark, vectors, monkeypatch):
    """A third of all rows is one vector, another group nearly is; ties go to the smaller ids."""
    monkeypatch.setattr(cross_polytope, "CELL_ROWS", 16)
    rng = np.random.default_rng(5)
    copy, near = np.array(vectors[0][1]), np.array(vectors[1][1])
    data = vectors[:300] + [(1000 + i, copy.tolist()) for i in range(300)]
    data += [(2000 + i, (near + rng.normal(size=24) * 1e-3).tolist()) for i in range(200)]
    got, exact = found(cross_polytope.nearest(frame(spark, data))), by_definition(data, 20)
    assert len(got) == len(exact) and recall(got, exact) >= 0.9
    copies = [x for x in exact if x[0] in (0, 1000, 1280)]
    assert [x for x in got if x[0] in (0, 1000, 1280)] == copies


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.5, 1.0]), (1, [2.0, 2.0]), (2, [-1.0, 0.0]),
        (40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [None, 1.0]),
        (None, [1.0, 1.0]), (160, [1.0, 1.0, 1.0]), (3, [2.0, 2.0]), (180, [1.0] * 5), (4, [1.0] * 5),
    ]
    assert found(cross_polytope.nearest(frame(spark, data))) == by_definition(data, 20)
    assert found(cross_polytope.nearest(frame(spark, []))) == []


def test_whole_table(spark):
    df = table(spark, SF, "embeddings")
    got = cross_polytope.nearest(df)
    assert got.count() == 25 * 20
    assert cross_polytope.measured_recall(got, df) >= 0.9
