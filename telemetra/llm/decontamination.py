"""Benchmark decontamination by greedy string tiling.

Runs of shared words that a document has with a benchmark item are found by Karp-Rabin hashes of
short seeds. Then the longest match is marked in both texts, again and again, until none of the
least length is left unmarked. The share of an item's words that end up marked is its coverage in
the document, whatever the order the passages stand in.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemetra.llm.common import arrow_schema, map_rows, rows_where, written
from telemetra.llm.words import WordHashes, plain_words, shingle_hashes

#: Words a match has at least.
LEAST_MATCH = 5
#: Share of an item's words that makes a document contaminated.
COVERAGE = 0.5
#: Bytes of benchmark text that go to the tasks at once; a larger benchmark is taken in blocks.
BLOCK_BYTES = 8 << 20
#: Bits of the seed filter that is tried before the exact lookup.
FILTER_BITS = 20


class Items:
    """The words and seeds of some benchmark texts, each under a number of its own."""

    def __init__(self, items: Iterable[tuple[int, bytes]], least: int) -> None:
        self.hashes = WordHashes()
        self.words: dict[int, np.ndarray] = {}
        self.seeds: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for item, text in items:
            words = self.hashes(plain_words(text))
            if len(words):
                self.words[item] = words
                size = min(least, len(words))
                for at, seed in enumerate(shingle_hashes(words, size).tolist()):
                    self.seeds[size][seed].append((item, at))
        self.filters = {}
        for size, seeds in self.seeds.items():
            hit = np.zeros(1 << FILTER_BITS, dtype=bool)
            hit[np.fromiter(seeds, dtype=np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
            self.filters[size] = hit

    def covered(self, text: bytes) -> tuple[int, dict[int, int]]:
        """Number of words of a document, and the marked words of each item that shares a seed with it."""
        words = self.hashes(plain_words(text))
        diagonals: dict[int, dict[int, list[int]]] = {}
        for size, seeds in self.seeds.items():
            hashes = shingle_hashes(words, size)
            maybe = np.flatnonzero(self.filters[size][hashes >> np.uint64(64 - FILTER_BITS)])
            for at in maybe.tolist():
                for item, start in seeds.get(int(hashes[at]), ()):
                    diagonals.setdefault(item, {}).setdefault(at - start, []).append(at)
        marked = {}
        for item, by_shift in diagonals.items():
            marked[item] = tiled(words, self.words[item], by_shift, min(LEAST_MATCH, len(self.words[item])))
        return len(words), marked


def tiled(words: np.ndarray, item: np.ndarray, by_shift: dict[int, list[int]], least: int) -> int:
    """Words of ``item`` that greedy string tiling marks.

    ``by_shift`` has the seed starts in ``words`` by their distance to the start in ``item``. Runs of
    them are the longest matches on each diagonal. A match that meets a mark is cut there and waits
    with its shorter rest, so matches are marked by falling length, earlier ones first.
    """
    queue: list[tuple[int, int, int]] = []
    for shift, starts in by_shift.items():
        first = previous = starts[0]
        for at in [*starts[1:], -1]:
            if at != previous + 1:
                queue.append((-(previous + least - first), first - shift, first))
                first = at
            previous = at
    heapq.heapify(queue)
    in_words, in_item = np.zeros(len(words), dtype=bool), np.zeros(len(item), dtype=bool)
    while queue:
        size, start, at = heapq.heappop(queue)
        size = -size
        taken = in_words[at : at + size] | in_item[start : start + size]
        taken |= words[at : at + size] != item[start : start + size]
        if not taken.any():
            in_words[at : at + size] = in_item[start : start + size] = True
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([True], taken, [True])).astype(np.int8)))
        for begin, end in edges.reshape(-1, 2).tolist():
            if end - begin >= least:
                heapq.heappush(queue, (begin - end, start + begin, at + begin))
    return int(in_item.sum())


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list[tuple[int, bytes]], bool]]:
    """The distinct ids and texts in blocks of about ``BLOCK_BYTES``, and whether a block is the last.

    Each is collected by itself; there is one at least.
    """
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    ).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for k in range(blocks):
        block = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield [(line["item"], bytes(line["text"])) for line in block.collect()], k == blocks - 1


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(id, n_words, n_items, item_ids, item_id, coverage, contaminated)`` per row of ``docs``.

    ``item_ids`` lists the items covered to ``coverage`` or more, ``item_id`` is the one covered best
    (the smallest id among equals; null if no item shares a run of words). Item ids may be numbers or
    texts, and keep their type. Words are compared
    without case and ASCII punctuation. Items of fewer than five words must occur whole; items
    without words match nothing; an item with several texts is covered as well as the best of them, and
    repeated benchmark rows count once. A null text has no words, a null id stays null, repeated rows
    are judged each, empty tables give no rows or no matches.
    """
    item_id = benchmark.select(F.col(item_col).alias("best_item"))
    item_kind, item_type = item_id.schema[0].dataType.simpleString(), arrow_schema(item_id).field(0).type
    state = f"best_item {item_kind}, best double, item_ids array<{item_kind}>, n_words bigint"
    frame = docs.select(
        F.col(id_col),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        F.lit(None).cast(item_kind).alias("best_item"),
        F.lit(0.0).alias("best"),
        F.array().cast(f"array<{item_kind}>").alias("item_ids"),
        F.lit(0).cast("bigint").alias("n_words"),
    )
    kind = frame.schema[0].dataType.simpleString()
    id_field = arrow_schema(frame).field(0)
    fields = [("best_item", item_type), ("best", pa.float64()), ("item_ids", pa.list_(item_type)), ("n_words", pa.int64())]

    def judged(frame: DataFrame, block: list[tuple[int, bytes]], last: bool) -> DataFrame:
        shared = frame.sparkSession.sparkContext.broadcast(block)

        def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
            block = shared.value
            items = Items(enumerate(text for _, text in block), LEAST_MATCH)
            for key, text, best_item, best, item_ids, _ in lines:
                n, marked = items.covered(text)
                for number, count in marked.items():
                    item, share = block[number][0], count / len(items.words[number])
                    if share >= coverage and item not in item_ids:
                        item_ids.append(item)
                    if share > best or share == best > 0 and item < best_item:
                        best_item, best = item, share
                line = (best_item, best, sorted(item_ids), n)
                yield (key, *line) if last else (key, text, *line)

        between = [] if last else [pa.field("text", pa.binary())]
        names = f"`{id_col}` {kind}, {'' if last else 'text binary, '}{state}"
        return map_rows(frame, names, pa.schema([id_field, *between, *fields]), convert)

    for k, (block, last) in enumerate(benchmark_blocks(benchmark, item_col, item_text_col)):
        frame = judged(frame if k == 0 else written(frame, "decontamination"), block, last)
        del block  # before the next one is collected
    return frame.select(
        F.col(id_col),
        "n_words",
        F.size("item_ids").cast("bigint").alias("n_items"),
        "item_ids",
        F.col("best_item").alias("item_id"),
        F.col("best").alias("coverage"),
        (F.size("item_ids") > 0).alias("contaminated"),
    )


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that cover no benchmark item to ``coverage`` or more; all columns pass through."""
    for block, _ in benchmark_blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        del block  # before the next one is collected

        def test(shared=shared):
            items = Items(enumerate(text for _, text in shared.value), LEAST_MATCH)
            return lambda text: all(n < coverage * len(items.words[i]) for i, n in items.covered(text)[1].items())

        docs = rows_where(docs, test, F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    return docs
