"""Approximate nearest neighbours by inner product with cross-polytope hashing.

A vector is rotated at random and hashed to the nearest of the signed axes. The rotation is three
rounds of random signs and a fast Hadamard transform. Each of a few tables has its own rotations;
with many vectors a table joins the axes of several rotations, so that a bucket holds some hundreds of
vectors at any size. A vector lies in one bucket of each table, and a query looks into several: those
whose axes it is next nearest to. All vectors a query meets there are ranked by their exact inner
product.

Inner products become angles by one more coordinate: a vector over the largest norm is filled up to
norm one, a query has zero there. How many buckets a query needs is measured, not assumed: for a
bounded sample of queries the exact neighbours are found by a scan, and the least number of probes is
taken that catches the wanted share of them.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.llm.common import written

#: Queries whose exact neighbours are found to fit the number of probes.
SAMPLE_QUERIES = 256
#: Share of their neighbours that the probes must catch.
WANTED_RECALL = 0.96
#: Vectors of a bucket, about; decides how many axes a bucket joins.
BUCKET_ROWS = 256
#: Most probes of a table; if they do not do, buckets join one axis less.
MOST_PROBES = 4096
#: Vectors, or queries, of a bucket that are compared in one piece; larger buckets are split.
CELL_ROWS = 1024
ROUNDS = 3


def is_query(id_col: Column) -> Column:
    return id_col % 20 == 0


def padded(size: int) -> int:
    """Length of a rotated vector: a power of two with room for one more coordinate."""
    return 1 << size.bit_length()


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep norms."""
    n, size = rows.shape
    step = 1
    while step < size:
        halves = rows.reshape(n, size // (2 * step), 2, step)
        rows = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return rows / math.sqrt(size)


@functools.lru_cache(maxsize=256)
def signs(size: int, table: int, axis: int) -> np.ndarray:
    return np.random.default_rng([size, table, axis]).choice((-1.0, 1.0), (ROUNDS, size))


@dataclass(frozen=True)
class Index:
    """What all tasks share: numbers only, whatever the size of the corpus."""

    tables: int
    axes: int
    norm: float
    probes: int = 1

    def lifted(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        out = np.zeros((len(vectors), padded(vectors.shape[1])))
        norms = np.linalg.norm(vectors, axis=1)
        scaled = vectors / (norms[:, None] if queries else self.norm)
        out[:, : vectors.shape[1]] = scaled
        if not queries:
            out[:, vectors.shape[1]] = np.sqrt(np.maximum(0.0, 1.0 - (norms / self.norm) ** 2))
        return out

    def rotated(self, lifted: np.ndarray, table: int) -> Iterator[np.ndarray]:
        for axis in range(self.axes):
            rows = lifted
            for flips in signs(lifted.shape[1], table, axis):
                rows = hadamard(rows * flips)
            yield rows

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table: ``(vectors, tables)``."""
        lifted = self.lifted(vectors, queries=False)
        out = np.zeros((len(vectors), self.tables), dtype=np.int64)
        for table in range(self.tables):
            for rows in self.rotated(lifted, table):
                nearest = np.abs(rows).argmax(axis=1)
                negative = np.take_along_axis(rows, nearest[:, None], 1)[:, 0] < 0
                out[:, table] = out[:, table] * (2 * rows.shape[1]) + nearest + rows.shape[1] * negative
            out[:, table] = out[:, table] * self.tables + table
        return out

    def probed(self, queries: np.ndarray, probes: int) -> np.ndarray:
        """The buckets each query looks into, nearest first: ``(queries, tables, probes)``.

        The distance of a bucket is the sum over its axes of the squared gap to the nearest one.
        """
        lifted = self.lifted(queries, queries=True)
        found = []
        for table in range(self.tables):
            codes, gaps = np.zeros((len(queries), 1), dtype=np.int64), np.zeros((len(queries), 1))
            for rows in self.rotated(lifted, table):
                signed = np.concatenate([rows, -rows], axis=1)
                order = np.argsort(-signed, axis=1, kind="stable")[:, :probes]
                values = np.take_along_axis(signed, order, 1)
                gap = (values[:, :1] - values) ** 2
                # Of two sorted lists only pairs of places with a product below the number wanted count.
                left, right = (x.ravel() for x in np.indices((codes.shape[1], order.shape[1])))
                low = (left + 1) * (right + 1) <= probes
                left, right = left[low], right[low]
                total = gaps[:, left] + gap[:, right]
                best = np.argsort(total, axis=1, kind="stable")[:, :probes]
                codes = np.take_along_axis(codes[:, left] * signed.shape[1] + order[:, right], best, 1)
                gaps = np.take_along_axis(total, best, 1)
            found.append(codes * self.tables + table)
        return np.stack(found, axis=1)


def matrices(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch, the vectors of one length at a time."""
    numbers, values = ids.to_numpy(zero_copy_only=False), vectors.flatten().to_numpy(zero_copy_only=False)
    sizes = np.asarray(vectors.value_lengths())
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield numbers[at], values[starts[at][:, None] + np.arange(size)].astype(np.float64)


def inner(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row; each is summed in the same order wherever it is computed."""
    return (left * right).sum(axis=1)


def best_pairs(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, least: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and scores of the ``k`` nearest vectors of each query, all ties with the last, none below ``least``.

    ``least`` is raised to the score of the k-th.
    """
    scores = queries @ vectors.T
    scores[query_ids[:, None] == ids] = -np.inf
    # A product of matrices may round otherwise than the score that counts.
    slack = 1e-12 * (1 + np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max())
    if len(ids) > k:
        least[:] = np.maximum(least, np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k])
    at, near = np.nonzero((scores >= (least - slack)[:, None]) & np.isfinite(scores))
    return at, near, inner(queries[at], vectors[near])


HITS = "query_id bigint, vec_id bigint, score double"
HIT_NAMES = ["query_id", "vec_id", "score"]


def vectors_of(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vector)`` of the rows that take part, each once."""
    size = "double" if "float" not in df.schema[vector_col].dataType.simpleString() else "float"
    frame = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{size}>").alias("vector"))
    number = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return frame.where(F.col("id").isNotNull() & number & F.exists("vector", lambda x: x != 0)).dropDuplicates()


def sample_of(queries: DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """At most ``SAMPLE_QUERIES`` queries, dealt by a hash of their ids."""
    lines = queries.orderBy(F.xxhash64("id"), "vector").limit(SAMPLE_QUERIES).collect()
    return np.array([x["id"] for x in lines], dtype=np.int64), [np.array(x["vector"], dtype=np.float64) for x in lines]


def exact_nearest(vectors: DataFrame, ids: np.ndarray, queries: list[np.ndarray], k: int) -> DataFrame:
    """``(query_id, vec_id, score, vector, n)``: the ``k`` nearest of a bounded set of queries, by a scan."""
    sizes = {}
    for size in {len(q) for q in queries}:
        at = [i for i, q in enumerate(queries) if len(q) == size]
        sizes[size] = ids[at], np.stack([queries[i] for i in at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {size: np.full(len(q[0]), -np.inf) for size, q in sizes.items()}
        for batch in batches:
            for numbers, rows in matrices(batch.column(0), batch.column(1)):
                size = rows.shape[1]
                if size in sizes:
                    query_ids, wanted = sizes[size]
                    at, near, scores = best_pairs(query_ids, wanted, numbers, rows, k, least[size])
                    lists = pa.ListArray.from_arrays(np.arange(0, size * len(near) + 1, size, dtype=np.int32), rows[near].ravel())
                    yield pa.record_batch([pa.array(query_ids[at]), pa.array(numbers[near]), pa.array(scores), lists], names=[*HIT_NAMES, "vector"])

    hits = vectors.mapInArrow(run, f"{HITS}, vector array<double>")
    return ranked(hits, k)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fitted(vectors: DataFrame, queries: DataFrame, k: int, tables: int) -> Index:
    """The index parameters for these vectors: numbers of axes and of probes."""
    size = F.max(F.size("vector"))
    norm = F.max(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    facts = vectors.agg(F.count("*").alias("n"), size.alias("size"), norm.alias("norm")).first()
    if not facts["n"]:
        return Index(tables, 1, 1.0)
    signed = 2 * padded(facts["size"])
    most = int(60 // math.log2(signed))
    axes = min(most, max(1, round(math.log(max(1, facts["n"] / BUCKET_ROWS)) / math.log(signed))))
    index = Index(tables, axes, math.sqrt(facts["norm"]) or 1.0)
    ids, sample = sample_of(queries)
    by_id = dict(zip(ids.tolist(), sample, strict=True))
    known = exact_nearest(vectors, ids, sample, k).select("query_id", "vector").collect() if len(ids) else []
    while True:
        # The number of probes at which each known neighbour is caught by some table.
        caught = []
        for query_id, query in by_id.items():
            near = [x["vector"] for x in known if x["query_id"] == query_id and len(x["vector"]) == len(query)]
            if near:
                order = index.probed(query[None], MOST_PROBES)[0]
                place = [{bucket: i for i, bucket in enumerate(table.tolist())} for table in order]
                for line in index.buckets(np.array(near)).tolist():
                    caught.append(min(p.get(b, MOST_PROBES) for p, b in zip(place, line, strict=True)) + 1)
        needed = int(np.quantile(caught, WANTED_RECALL, method="higher")) if caught else 1
        if needed <= MOST_PROBES or index.axes == 1:
            return Index(tables, index.axes, index.norm, needed)
        index = Index(tables, index.axes - 1, index.norm)


def bucketed(vectors: DataFrame, index: Index, queries: bool, counted: bool) -> DataFrame:
    """``(size, bucket, id, vector)`` per vector and bucket; counted: ``(size, bucket, n)`` of each batch."""
    names = ["size", "bucket", *(["n"] if counted else ["id", "vector"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, rows in matrices(batch.column(0), batch.column(1)):
                # The parts of a batch are small: a query has many buckets.
                for start in range(0, len(numbers), 256):
                    ids, part = numbers[start : start + 256], rows[start : start + 256]
                    found = index.probed(part, index.probes).reshape(len(part), -1) if queries else index.buckets(part)
                    flat = found.ravel()
                    if counted:
                        flat, times = np.unique(flat, return_counts=True)
                        columns = [pa.array(times)]
                    else:
                        at = np.repeat(np.arange(len(part)), found.shape[1])
                        packed = [x.tobytes() for x in part]
                        columns = [pa.array(ids[at]), pa.array([packed[i] for i in at], type=pa.binary())]
                    sizes = np.full(len(flat), rows.shape[1], dtype=np.int32)
                    yield pa.record_batch([pa.array(sizes), pa.array(flat), *columns], names=names)

    return vectors.mapInArrow(run, "size int, bucket bigint, " + ("n bigint" if counted else "id bigint, vector binary"))


def cells(vectors: DataFrame, queries: DataFrame, index: Index) -> DataFrame:
    """``(size, bucket, v, q, side, id, vector)``: rows that share the first four are compared.

    A bucket with more than ``CELL_ROWS`` vectors or queries is a grid of cells: a vector stands in each
    cell of its row, a query in each of its column, so that every pair meets once and no task gets a
    whole large bucket.
    """
    key = ["size", "bucket"]
    rows = {name: F.sum("n").alias(name) for name in ("vectors", "queries")}
    n_vectors, n_queries = (
        bucketed(frame, index, name == "queries", True).groupBy(*key).agg(rows[name])
        for name, frame in (("vectors", vectors), ("queries", queries))
    )
    large = written(
        n_vectors.join(n_queries, key)
        .where((F.col("vectors") > CELL_ROWS) | (F.col("queries") > CELL_ROWS))
        .select(*key, *(F.ceil(F.col(n) / CELL_ROWS).cast("int").alias(n) for n in rows)),
        "large-buckets",
    )
    parts = []
    for side, frame in (("queries", queries), ("vectors", vectors)):
        own, other = ("v", "q") if side == "vectors" else ("q", "v")
        across = "queries" if side == "vectors" else "vectors"
        split = bucketed(frame, index, side == "queries", False).join(large, key, "left")
        split = split.withColumn(own, F.pmod(F.xxhash64("id"), F.coalesce(side, F.lit(1))).cast("int"))
        split = split.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(across), F.lit(1)) - 1)))
        parts.append(split.select(*key, "v", "q", F.lit(side == "vectors").alias("side"), "id", "vector"))
    return parts[0].unionByName(parts[1])


def compared(met: DataFrame, k: int) -> DataFrame:
    """The best pairs of each cell. A task holds a cell at a time, and a score per query."""
    cell = ["size", "bucket", "v", "q"]
    frame = met.repartition(*cell).sortWithinPartitions(*cell, "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, float] = {}

        def best(table: pa.Table) -> pa.RecordBatch | None:
            size = table.column(0)[0].as_py()
            side = table.column(4).to_numpy()
            first = int(np.searchsorted(side, True))
            if first in (0, len(side)):
                return None
            ids = table.column(5).to_numpy()
            vectors = np.frombuffer(b"".join(table.column(6).to_pylist())).reshape(-1, size)
            query_ids = ids[:first]
            known = np.array([least.get(i, -np.inf) for i in query_ids.tolist()])
            at, near, scores = best_pairs(query_ids, vectors[:first], ids[first:], vectors[first:], k, known)
            least.update(zip(query_ids.tolist(), known.tolist(), strict=True))
            return pa.record_batch([pa.array(query_ids[at]), pa.array(ids[first:][near]), pa.array(scores)], names=HIT_NAMES)

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest else table
            keys = np.stack([table.column(i).to_numpy() for i in range(4)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if (found := best(table.slice(start, end - start))) is not None:
                    yield found
            rest = table.slice(cuts[-1]) if table.num_rows else None
        if rest and (found := best(rest)) is not None:
            yield found

    return frame.mapInArrow(run, HITS)


def nearest(
    df: DataFrame, k: int = 20, tables: int = 4, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest ``k`` found of each row whose id is divisible by 20.

    Null ids take no part, nor do vectors that are null, empty, zero, or hold nulls or numbers that are
    not finite. Ids are whole numbers. Vectors of different lengths have no inner product and are no
    candidates of each other. A row is never a candidate of its own id. Repeated rows count once; if an id
    has several vectors, all are candidates, each pair of ids has its largest score, and all are queries.
    Equal vectors have equal scores, and ties go to the smaller id. Of equal vectors only the ``k`` + 1
    smallest ids can be among anyone's nearest, so no others are hashed: a group of copies of any size
    stays small. An empty table gives no rows; other columns are not read.
    """
    whole = written(vectors_of(df, id_col, vector_col), "vectors")
    queries = whole.where(is_query(F.col("id")))
    copy = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    index_rows = written(whole.withColumn("copy", copy).where(F.col("copy") <= k + 1).drop("copy"), "indexed")
    index = fitted(index_rows, queries, k, tables)
    hits = compared(cells(index_rows, queries, index), k).repartition("query_id")
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return ranked(once, k).select("query_id", "rank", "vec_id", "score")


def measured_recall(found: DataFrame, df: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Share of the exact nearest, of at most ``SAMPLE_QUERIES`` queries, that ``found`` has."""
    whole = written(vectors_of(df, id_col, vector_col), "vectors")
    exact = exact_nearest(whole, *sample_of(whole.where(is_query(F.col("id")))), k).select("query_id", "vec_id")
    exact = written(exact, "exact")
    return exact.join(found, ["query_id", "vec_id"], "left_semi").count() / max(1, exact.count())
