"""Near-duplicate documents by a multi-index join of MinHash signatures.

A signature has one symbol of ``b`` bits per hash function. It is split into chunks. If two
signatures differ in at most T symbols, some chunk differs in at most T // chunks of them, so each
chunk is indexed once for every way of leaving that many symbols out: equal keys then find all pairs
within T (the pigeonhole principle), and only pairs within T are looked at further. Links are
confirmed on the full shingle sets.

Documents with the same set are one node. Within a key, nodes are first compared with one leader;
what that leaves in different components is compared in blocks, across components only: first each
node with its nearest. Nodes that are still near others of another component are gathered in clusters
and tested there on their full sets, so no row is made per pair of near documents that are not linked.
A large group of near copies costs about one comparison per copy, and no link between components is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm.common import (
    Emitter,
    arrow_schema,
    exchange_partitions,
    fixed_filter,
    free_names,
    in_filter,
    map_rows,
    mix,
    rows,
    split_by_filter,
    written,
)
from telemetra.llm.components import components
from telemetra.llm.words import WordHashes, lower_words, shingle_hashes

#: Nodes of a key that are compared with each other in one block.
BLOCK_NODES = 1000
#: Nodes, and shingles of their sets, of a cluster that are tested on each other in one block, about.
CLUSTER_NODES = 200
CLUSTER_SHINGLES = 1 << 20
#: Shingles whose signatures are computed together.
TOGETHER = 1 << 17
#: Rows of groups, and pairs among them, that are compared at once.
ROWS_TOGETHER = 4096
PAIRS_TOGETHER = 1 << 17


@dataclass(frozen=True)
class Signature:
    """``symbols`` hash minima of ``bits`` bits in ``chunks`` chunks, ``errors`` of them wrong in one chunk.

    All pairs that differ in at most ``distance`` symbols are found. With the defaults, documents with
    a similarity of exactly 0.8 differ in more with probability 7e-6, more similar ones more seldom.
    A sketch of ``sketch`` more minima of 8 bits each tells found pairs that are near the threshold
    from those that are not, before any text is read; it lets go of as few (3e-7).
    """

    symbols: int = 32
    bits: int = 32
    chunks: int = 9
    errors: int = 1
    sketch: int = 512

    @property
    def distance(self) -> int:
        return self.chunks * (self.errors + 1) - 1

    def sketch_distance(self, percent: int) -> int:
        """Differing sketch symbols at a similarity of ``percent``, and five standard deviations more."""
        p = (1 - percent / 100) * 255 / 256
        return int(self.sketch * p + 5 * (self.sketch * p * (1 - p)) ** 0.5)

    def of(self, shingles: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """Signatures and sketches of the non-empty sets that start at ``starts`` in ``shingles``."""
        n = self.symbols + self.sketch
        draw = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
        least = np.empty((len(starts), n), dtype=np.uint64)
        for i, (a, b) in enumerate(zip(draw[:n] | np.uint64(1), draw[n:], strict=True)):
            least[:, i] = np.minimum.reduceat(shingles * a + b, starts)
        table = (least[:, : self.symbols] >> np.uint64(64 - self.bits)).astype("<u4")
        sketch = (mix(least[:, self.symbols :]) >> np.uint64(56)).astype(np.uint8)
        return [t.tobytes() + s.tobytes() for t, s in zip(table, sketch, strict=True)]

    def tables(self, signatures: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols and the sketches of some signatures."""
        raw = np.frombuffer(b"".join(signatures), dtype=np.uint8).reshape(len(signatures), -1)
        return np.ascontiguousarray(raw[:, : 4 * self.symbols]).view("<u4"), raw[:, 4 * self.symbols :]

    def keys(self, signatures: np.ndarray) -> np.ndarray:
        """For each signature, a key per chunk and choice of symbols left out."""
        found = []
        edges = np.linspace(0, self.symbols, self.chunks + 1).astype(int).tolist()
        wide = signatures.astype(np.uint64)
        for begin, end in itertools.pairwise(edges):
            for left_out in itertools.combinations(range(begin, end), min(self.errors, end - begin)):
                key = np.full(len(wide), len(found) + 1, dtype=np.uint64)
                for i in range(begin, end):
                    if i not in left_out:
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, i])
                found.append(key)
        return np.stack(found, axis=1).view(np.int64)


def shingle_set(text: bytes, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text is one shingle."""
    words = hashes(lower_words(text))
    if not len(words):
        return words
    if len(words) < size:
        return mix(shingle_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(mix(shingle_hashes(words, size)))


def node_of(shingles: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def profiles(docs: DataFrame, signature: Signature, size: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, n_shingles, node, signature)`` per row; node and signature are null for an empty set."""
    frame = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = frame.schema[0].dataType.simpleString()
    out = pa.schema(
        [arrow_schema(frame).field(0), ("n_shingles", pa.int64()), ("node", pa.int64()), ("signature", pa.binary())]
    )

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        hashes = WordHashes()

        def finish(held: list[tuple]) -> Iterator[tuple]:
            sets = [s for _, s in held if len(s)]
            starts = np.cumsum([0, *map(len, sets)])[:-1]
            found = iter(signature.of(np.concatenate(sets), starts) if sets else ())
            for key, shingles in held:
                if len(shingles):
                    yield key, len(shingles), node_of(shingles), next(found)
                else:
                    yield key, 0, None, None

        held, total = [], 0
        for key, text in lines:
            shingles = shingle_set(text, hashes, size)
            held.append((key, shingles))
            total += len(shingles)
            if total >= TOGETHER or len(held) >= 1000:
                yield from finish(held)
                held, total = [], 0
        yield from finish(held)

    return map_rows(frame, f"`{id_col}` {kind}, n_shingles bigint, node bigint, signature binary", out, convert)


def chunk_keys(nodes: DataFrame, signature: Signature) -> DataFrame:
    """``(key, node)`` for each key of each signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = signature.keys(signature.tables(batch.column(1).to_pylist())[0])
                owners = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
                for at in range(0, len(owners), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield pa.record_batch([pa.array(keys.ravel()[part]), pa.array(owners[part])], names=["key", "node"])

    return nodes.select("node", "signature").mapInArrow(run, "key bigint, node bigint")


def close_pairs(pairs: DataFrame, nodes: DataFrame, signature: Signature, percent: int) -> DataFrame:
    """``(a, b, apart)``: the pairs whose signatures and sketches are near enough."""
    side_a = nodes.select(F.col("node").alias("a"), F.col("signature").alias("signature_a"))
    side_b = nodes.select(F.col("node").alias("b"), F.col("signature").alias("signature_b"))
    joined = pairs.join(side_a, "a").join(side_b, "b").select("a", "b", "signature_a", "signature_b")
    most, most_apart = signature.distance, signature.sketch_distance(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (left, left_sketch), (right, right_sketch) = (signature.tables(batch.column(i).to_pylist()) for i in (2, 3))
            apart = (left_sketch != right_sketch).sum(axis=1, dtype=np.int32)
            near = pa.array(((left != right).sum(axis=1) <= most) & (apart <= most_apart))
            kept = [batch.column(i).filter(near) for i in (0, 1)]
            yield pa.record_batch([*kept, pa.array(apart).filter(near)], names=["a", "b", "apart"])

    return joined.mapInArrow(run, "a bigint, b bigint, apart int")


def block_pairs(members: DataFrame, group: str, blocks: Column) -> DataFrame:
    """``members`` once for each pair of blocks ``(low, high)`` of their group that has their ``own``.

    A group is cut into ``blocks`` by a hash of the node, so no task ever holds more than two blocks of it.
    """
    sizes = members.groupBy(group).agg(blocks.cast("int").alias("blocks"))
    placed = members.join(sizes, group).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return placed.select(
        group,
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "node",
        "component",
        "own",
    )


def spanning_forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The numbers of as few of the pairs ``(i, j)`` below ``n`` as connect what all of them connect."""
    label, live, kept = np.arange(n), np.arange(len(i)), []
    while len(live):
        x, y = label[i[live]], label[j[live]]
        apart = x != y
        live, low, high = live[apart], np.minimum(x, y)[apart], np.maximum(x, y)[apart]
        # Each label but the smallest of its neighbours hooks to a smaller one, so no circle is closed.
        hooked, first = np.unique(high, return_index=True)
        kept.append(live[first])
        up = np.arange(n)
        up[hooked] = low[first]
        while (up != up[up]).any():
            up = up[up]
        label = up[label]
    return np.sort(np.concatenate(kept)) if kept else live


def crossing_pairs(
    members: DataFrame, nodes: DataFrame, signature: Signature, percent: int, partitions: int, nearest: bool
) -> DataFrame:
    """``(a, b, apart, key)`` that are near enough among members ``(key, node, component)`` of a key.

    Only pairs of different components count. With ``nearest`` the closest one of each node in a block is
    given, else as few as connect what all of them connect. A pair that shares several keys is looked at
    under the first of them.
    """
    placed = block_pairs(members, "key", F.ceil(F.count("*") / BLOCK_NODES))
    # Signatures join last: they are much larger than the rows they go to.
    placed = placed.join(nodes.select("node", "signature"), "node")
    placed = placed.select("key", "low", "high", "node", "component", "own", "signature")
    grouped = placed.repartition(partitions, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    most, most_apart = signature.distance, signature.sketch_distance(percent)

    def compare(held: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
        """Groups are compared together, at most ``PAIRS_TOGETHER`` pairs at a time."""
        lines = [line for group in held for line in group]
        key, low, high, node, component, own = (np.array([line[i] for line in lines]) for i in range(6))
        table, sketch = signature.tables([line[6] for line in lines])
        keys = signature.keys(table)
        sizes = np.array([len(group) for group in held])
        ends = np.repeat(np.cumsum(sizes), sizes)
        after = ends - np.arange(len(lines)) - 1
        total = np.cumsum(after)
        start = 0
        while start < len(lines):
            stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PAIRS_TOGETHER)))
            n = after[start:stop]
            i = np.repeat(np.arange(start, stop), n)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            start = stop
            wanted = (component[i] != component[j]) & ((low[i] == high[i]) | (own[i] != own[j]))
            i, j = i[wanted], j[wanted]
            near = (table[i] != table[j]).sum(axis=1) <= most
            i, j = i[near], j[near]
            first = (keys[i] == keys[j]).argmax(axis=1)
            near = keys[i, first] == key[i]
            i, j = i[near], j[near]
            apart = (sketch[i] != sketch[j]).sum(axis=1, dtype=np.int32)
            near = apart <= most_apart
            i, j, apart = i[near], j[near], apart[near]
            if nearest and len(i):
                order = np.lexsort((j, apart, i))
                order = order[np.concatenate(([True], np.diff(i[order]) != 0))]
                i, j, apart = i[order], j[order], apart[order]
            elif not nearest:
                few = spanning_forest(i, j, len(lines))
                i, j, apart = i[few], j[few], apart[few]
            columns = np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), apart, key[i]
            yield pa.record_batch([pa.array(c) for c in columns], names=["a", "b", "apart", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for _, group in itertools.groupby(rows(batches), key=lambda line: line[:3]):
            lines = list(group)
            if any(line[4] != lines[0][4] for line in lines):
                held.append(lines)
                total += len(lines)
            if total >= ROWS_TOGETHER:
                yield from compare(held)
                held, total = [], 0
        if held:
            yield from compare(held)

    return grouped.mapInArrow(run, "a bigint, b bigint, apart int, key bigint")


def node_texts(
    docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str
) -> DataFrame:
    """``(node, packed)``: one compressed text for each node of ``wanted (node, id)``.

    Texts whose id the fixed filter does not have are dropped where they are read; the others that
    are not wanted meet no partner in the join.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fixed_filter(wanted.select(F.xxhash64("id").alias("hash"))))
    frame = docs.select(
        F.xxhash64(F.col(id_col)).alias("hash"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    )

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        bits, hashes = shared.value, WordHashes()
        packer = zstandard.ZstdCompressor(level=3)
        for value, text in lines:
            if in_filter(bits, value):
                shingles = shingle_set(text, hashes, size)
                if len(shingles):
                    yield node_of(shingles), packer.compress(text)

    schema = pa.schema([("node", pa.int64()), ("packed", pa.binary())])
    found = map_rows(frame, "node bigint, packed binary", schema, convert)
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets have a similarity of ``percent`` or more."""
    side_a = texts.select(F.col("node").alias("a"), F.col("packed").alias("packed_a"))
    side_b = texts.select(F.col("node").alias("b"), F.col("packed").alias("packed_b"))
    joined = pairs.select("a", "b").join(side_a, "a").join(side_b, "b").select("a", "b", "packed_a", "packed_b")

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        hashes, unpacker = WordHashes(), zstandard.ZstdDecompressor()
        last, right = None, np.zeros(0, dtype=np.uint64)
        for a, b, packed_a, packed_b in lines:
            if b != last:  # the join leaves the rows of a leader together
                last, right = b, shingle_set(unpacker.decompress(packed_b), hashes, size)
            left = shingle_set(unpacker.decompress(packed_a), hashes, size)
            both = len(np.intersect1d(left, right, assume_unique=True))
            if 100 * both >= percent * (len(left) + len(right) - both):
                yield a, b

    return map_rows(joined, "a bigint, b bigint", pa.schema([("a", pa.int64()), ("b", pa.int64())]), convert)


def set_links(
    nodes: np.ndarray, component: np.ndarray, sets: list[np.ndarray], percent: int
) -> Iterator[tuple[int, int]]:
    """Links between nodes of different components, by their full sets: per node one to each component."""
    _, part = np.unique(component, return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    values, number = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.zeros(len(values), dtype=bool)
    # A pair of different components has a node outside of the largest one.
    for i in np.flatnonzero(part != np.bincount(part).argmax()):
        own = number[starts[i] : starts[i] + sizes[i]]
        held[own] = True
        both = np.add.reduceat(held[number], starts, dtype=np.int64)
        held[own] = False
        linked = np.flatnonzero((100 * both >= percent * (sizes[i] + sizes - both)) & (part != part[i]))
        _, first = np.unique(part[linked], return_index=True)
        for j in linked[first]:
            yield int(nodes[i]), int(nodes[j])


def cluster_links(members: DataFrame, texts: DataFrame, size: int, percent: int, partitions: int) -> DataFrame:
    """``(a, b)``: links that connect all linked components of each cluster.

    ``members`` is ``(cluster, node, component, n_shingles)``. All nodes of a cluster meet, block by block,
    and each pair of different components is tested on its full sets.
    """
    blocks = F.ceil(F.greatest(F.count("*") / CLUSTER_NODES, F.sum("n_shingles") / CLUSTER_SHINGLES))
    # Texts join last: they are much larger than the rows they go to.
    placed = block_pairs(members, "cluster", blocks).join(texts, "node")
    placed = placed.select("cluster", "low", "high", "node", "component", "packed")
    grouped = placed.repartition(partitions, "cluster", "low", "high").sortWithinPartitions("cluster", "low", "high")

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        hashes, unpacker = WordHashes(), zstandard.ZstdDecompressor()
        for _, group in itertools.groupby(lines, key=lambda line: line[:3]):
            nodes, component, sets = [], [], []
            for *_, node, label, packed in group:
                nodes.append(node)
                component.append(label)
                sets.append(shingle_set(unpacker.decompress(packed), hashes, size))
            yield from set_links(np.array(nodes), np.array(component), sets, percent)

    return map_rows(grouped, "a bigint, b bigint", pa.schema([("a", pa.int64()), ("b", pa.int64())]), convert)


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    signature: Signature | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` per row of ``docs``.

    Documents are linked if the sets of their ``words``-word shingles have a similarity of
    ``percent`` or more; ``component_id`` is the smallest id reachable over links, ``kept`` marks
    the documents with that id. A null or empty text has no set and is linked with nothing. A null
    id gives a null component and is kept only when nothing is linked to it. Repeated rows share
    their set, and all rows of a kept id are kept. An empty table gives no rows.
    """
    signature = signature or Signature()
    partitions = exchange_partitions(docs.sparkSession)
    profile = written(profiles(docs, signature, words, id_col, text_col), "profiles")
    nodes = written(
        profile.where("node is not null")
        .groupBy("node")
        .agg(F.min(id_col).alias("id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")),
        "nodes",
    )
    keys = chunk_keys(nodes, signature)
    leaders = written(
        keys.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1"), "leaders"
    )
    members = written(keys.join(leaders.select("key", "leader"), "key"), "members")

    # One leader per node, the one it shares most keys with; what that leaves apart is left to the rounds below.
    shared = members.where("node <> leader").groupBy(F.col("node").alias("a"), "leader").agg(F.count("*").alias("n"))
    stars = shared.groupBy("a").agg(F.max(F.struct("n", "leader")).alias("best")).select("a", F.col("best.leader").alias("b"))
    near = written(close_pairs(stars, nodes, signature, percent), "near")
    closest = near.select("a", "b")
    wanted = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    texts = written(node_texts(docs, wanted.join(nodes.select("node", "id"), "node"), words, id_col, text_col), "texts")
    links = written(confirmed(closest, texts, words, percent), "confirmed")
    # Components only grow: a key without a near pair between two of them has none later either.
    mixing = members.select("key")
    for nearest in (True, False):
        labels = components(links)
        placed = members.select("key", "node").join(labels, "node", "left")
        placed = placed.withColumn("component", F.coalesce("component", "node"))
        placed = placed if nearest else placed.join(mixing, "key", "left_semi")
        mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
        held = placed.join(mixed.select("key"), "key", "left_semi").select("key", "node", "component")
        found = written(crossing_pairs(held, nodes, signature, percent, partitions, nearest), "crossing")
        if found.isEmpty():
            break
        mixing = found.select("key").distinct()
        more = found.select(F.col("a").alias("node")).union(found.select("b")).distinct()
        missing = more.join(texts.select("node"), "node", "left_anti")
        if not missing.isEmpty():
            extra = node_texts(docs, missing.join(nodes.select("node", "id"), "node"), words, id_col, text_col)
            texts = texts.union(written(extra, "texts"))
        if nearest:
            seen = closest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            pairs = found.select("a", "b").distinct().join(seen, ["a", "b"], "left_anti")
            more_links = confirmed(pairs, texts, words, percent)
        else:
            clusters = components(found.select("a", "b")).withColumnRenamed("component", "cluster")
            inside = clusters.join(labels, "node", "left").join(nodes.select("node", "n_shingles"), "node")
            inside = inside.select("cluster", "node", F.coalesce("component", "node").alias("component"), "n_shingles")
            more_links = cluster_links(inside, texts, words, percent, partitions)
        links = links.union(written(more_links, "confirmed"))

    labels = components(links)
    named = labels.join(nodes.select("node", "id"), "node")
    smallest = named.groupBy("component").agg(F.min("id").alias("smallest"))
    by_node = nodes.select("node", "id").join(labels, "node", "left").join(smallest, "component", "left")
    by_node = by_node.select("node", F.coalesce("smallest", "id").alias("component_id"))
    result = profile.drop("signature").join(by_node, "node", "left")
    component = F.coalesce("component_id", F.col(id_col))
    return result.select(
        F.col(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col(id_col) == component, F.col("component_id").isNull()).alias("kept"),
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group of near duplicates is kept.

    All columns pass through. Rows that are repeated with id and text stay once. An id that stands
    for several texts stays if any of them does, and rows without an id stay.
    """
    judged = written(near_duplicates(docs, words, percent, None, id_col, text_col).select(id_col, "kept"), "judged")
    named, stays, n = free_names(docs.columns, "named", "stays", "n")
    ids = judged.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias(named))
    ids = ids.agg(F.max("kept").alias(stays), F.count("*").alias(n)).where(~F.col(stays) | (F.col(n) > 1)).drop(n)
    inside, outside = split_by_filter(docs, ids.select(F.xxhash64(named).alias("hash")), F.xxhash64(F.col(id_col)))
    checked = inside.join(ids, F.col(id_col) == F.col(named), "left")
    # Only ids that were named can be repeated.
    once = checked.where(F.col(stays)).dropDuplicates([id_col, text_col]).select(*docs.columns)
    return outside.unionByName(checked.where(F.col(stays).isNull()).select(*docs.columns)).unionByName(once)
