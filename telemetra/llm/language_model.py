"""Language-model scores by deleted interpolation.

Word bigram, word unigram and uniform estimates are mixed with weights that depend on how often the
context was seen. The weights are learned by expectation-maximisation on counts from which each
occurrence is deleted in turn, so every training token is held out once.

Every word has estimates of its own, however rare it is: words are told apart by 64-bit hashes,
bigrams by hashes of the pair. Probabilities sum to one over all words seen in training and one unseen
word. Only totals, histograms and weights come to the driver.

Texts are turned into blocks of tokens once and kept in the shared folder. Counts are gathered by
exchanges: a block sends its distinct words or bigrams with their counts to ranges of them, the sums
come back to the block. No table of words or bigrams is ever in one place.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm.common import arrow_schema, exchange_partitions, map_rows, mix, remainder_of_id, task_number, written
from telemetra.llm.words import WordHashes, lower_words

#: Tokens of a block, about.
BLOCK_TOKENS = 500_000
#: Fineness of the histograms that weights are learned from: bins per doubling of a count or probability.
COUNT_BINS, SHARE_BINS = 16, 2
SHARES = 80
STEPS = 200

TOTALS, BINS = 0, 1


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds them, compressed."""
    top = int(values.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + zstandard.compress(values.astype(f"<u{width}").tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw[1:]), dtype=f"<u{raw[0]}").astype(np.int64)


def planes(values: np.ndarray, width: int) -> bytes:
    """Whole numbers of so many bytes, the lowest byte of all of them first, then the next one, compressed."""
    return zstandard.compress(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes(), 1)


def from_planes(raw: bytes, width: int) -> np.ndarray:
    bytes_of = np.frombuffer(zstandard.decompress(raw), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(bytes_of.T).view(f"<u{width}").ravel()


def packed_hashes(values: np.ndarray) -> bytes:
    """Sorted hashes by their differences."""
    return planes(np.diff(values, prepend=np.uint64(0)), 8)


def unpacked_hashes(raw: bytes) -> np.ndarray:
    return np.cumsum(from_planes(raw, 8), dtype=np.uint64)


def packed_tokens(tokens: np.ndarray, counts: np.ndarray) -> bytes:
    """Local numbers of words by the rank of their ``counts``, so that most are small."""
    rank = np.empty(len(counts), dtype=np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    return planes(rank[tokens], 4)


def unpacked_tokens(raw: bytes, counts: bytes) -> np.ndarray:
    return np.argsort(-unpacked(counts), kind="stable")[from_planes(raw, 4)]


# ---- blocks ------------------------------------------------------------------------------


def token_blocks(docs: DataFrame, training: Column, id_col: str, text_col: str) -> DataFrame:
    """Blocks of documents: ids, lengths, training marks, distinct words and the tokens as local numbers."""
    frame = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(training, F.lit(False)).alias("training"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    kind = frame.schema["id"].dataType.simpleString()
    id_field = arrow_schema(frame).field("id")
    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("ids", pa.list_(id_field.type)),
            ("training", pa.binary()),
            ("lengths", pa.binary()),
            ("words", pa.binary()),
            ("counts", pa.binary()),
            ("tokens", pa.binary()),
        ]
    )

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        hashes, number = WordHashes(), task_number() << 32

        def block(held: list[tuple]) -> tuple:
            nonlocal number
            number += 1
            tokens = np.concatenate([t for _, _, t in held])
            words, local = np.unique(tokens, return_inverse=True)
            lengths = np.array([len(t) for _, _, t in held])
            training = np.array([t for _, t, _ in held], dtype=bool)
            counts = np.bincount(local[np.repeat(training, lengths)], minlength=len(words))
            return (
                number,
                [key for key, _, _ in held],
                packed(training),
                packed(lengths),
                packed_hashes(words),
                packed(counts),
                packed_tokens(local, counts),
            )

        held, size = [], 0
        for key, training, text in lines:
            tokens = hashes([*lower_words(text), b""])  # the empty word ends a text
            held.append((key, training, tokens))
            size += len(tokens)
            if size >= BLOCK_TOKENS:
                yield block(held)
                held, size = [], 0
        if held:
            yield block(held)

    names = f"block bigint, ids array<{kind}>, training binary, lengths binary, words binary, counts binary, tokens binary"
    return map_rows(frame, names, schema, convert)


# ---- exchanges ---------------------------------------------------------------------------

RETURNED = "kind int, block bigint, start bigint, n bigint, data binary"
RETURNED_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("data", pa.binary())]
)
SENT = "bucket int, kind int, block bigint, start bigint, keys binary, counts binary"
SENT_SCHEMA = pa.schema(
    [
        ("bucket", pa.int32()),
        ("kind", pa.int32()),
        ("block", pa.int64()),
        ("start", pa.int64()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
    ]
)


def slices(keys: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The part of the sorted ``keys`` that lies in each range between ``bounds``."""
    edges = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
    for bucket, (begin, end) in enumerate(itertools.pairwise(edges)):
        if begin < end:
            yield bucket, slice(begin, end)


def summed(parts: list[tuple[int, int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, Iterator[tuple]]:
    """Distinct keys, their sums, and the sums in the order each block has sent its keys."""
    keys, inverse = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
    totals = np.bincount(inverse, weights=np.concatenate([p[3] for p in parts]), minlength=len(keys)).astype(np.int64)

    def back() -> Iterator[tuple]:
        at = 0
        for block, start, own, _ in parts:
            yield TOTALS, block, start, 0, packed(totals[inverse[at : at + len(own)]])
            at += len(own)

    return keys, totals, back()


def exchanged(sent: DataFrame, partitions: int, sum_up) -> DataFrame:
    """``sum_up`` over the rows of each bucket."""

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        for _, group in itertools.groupby(lines, key=lambda line: line[0]):
            yield from sum_up([line[1:] for line in group])

    dealt = sent.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return map_rows(dealt, RETURNED, RETURNED_SCHEMA, convert)


def count_bin(counts: np.ndarray) -> np.ndarray:
    return np.floor(COUNT_BINS * np.log2(np.maximum(counts, 1)) + 1e-9).astype(np.int64)


def hash_bounds(buckets: int) -> np.ndarray:
    return np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=np.uint64)


def unigram_exchange(blocks: DataFrame, partitions: int) -> DataFrame:
    """Training counts of the words of each block, and bins of counts."""
    bounds = hash_bounds(partitions)

    def send(lines: Iterator[tuple]) -> Iterator[tuple]:
        for block, words, counts in lines:
            words, counts = unpacked_hashes(words), unpacked(counts)
            for bucket, part in slices(words, bounds):
                yield bucket, TOTALS, block, part.start, packed_hashes(words[part]), packed(counts[part])

    def sum_up(group: list[tuple]) -> Iterator[tuple]:
        parts = [(block, start, unpacked_hashes(k), unpacked(c)) for _, block, start, k, c in group]
        _, totals, back = summed(parts)
        yield from back
        seen = totals[totals > 0]
        bins = count_bin(seen)
        for b in np.unique(bins).tolist():
            yield BINS, b, int((bins == b).sum()), int(seen[bins == b].sum()), None

    sent = map_rows(blocks.select("block", "words", "counts"), SENT, SENT_SCHEMA, send)
    return exchanged(sent, partitions, sum_up)


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """Buckets of contexts by how often they were seen: 0 for never, then doublings."""
    return np.where(counts > 0, 1 + np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64), 0)


def share_bin(shares: np.ndarray) -> np.ndarray:
    low = np.floor(-SHARE_BINS * np.log2(np.maximum(shares, 1e-30)) + 1e-9).astype(np.int64)
    return np.where(shares > 0, np.minimum(low, SHARES - 2), SHARES - 1)


def share_of_bin(bins: np.ndarray) -> np.ndarray:
    return np.where(bins == SHARES - 1, 0.0, 2.0 ** -((bins + 0.5) / SHARE_BINS))


def mixture_weights(bins: list[tuple[int, int]], words: int) -> np.ndarray:
    """Per bucket of contexts the weights of bigram, unigram and uniform estimates.

    Expectation-maximisation on the deleted shares of all training tokens; a bucket without any keeps
    to unigrams.
    """
    weights = np.tile([0.0, 1 - 1e-3, 1e-3], (66, 1))
    by_bucket: dict[int, list[tuple[int, int, int]]] = {}
    for code, n in bins:
        by_bucket.setdefault(code // SHARES // SHARES, []).append((code // SHARES % SHARES, code % SHARES, n))
    for bucket, found in by_bucket.items():
        after, single, n = (np.array(x) for x in zip(*found, strict=True))
        parts = np.stack([share_of_bin(after), share_of_bin(single), np.full(len(n), 1 / words)])
        shares = np.full(3, 1 / 3)
        for _ in range(STEPS):
            joint = shares[:, None] * parts
            shares = ((joint / joint.sum(axis=0)) * n).sum(axis=1) / n.sum()
        shares = np.maximum(shares, [0.0, 1e-6, 1e-6])
        weights[bucket] = shares / shares.sum()
    return weights


# ---- every word by itself ----------------------------------------------------------------


def pairs_of(words: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct bigrams of a block by their sorted hashes, which one each token ends, and their two words.

    The empty word ends a text, so it is also the context in which the next one begins; it is seen in
    training as often as texts begin. Words are local numbers.
    """
    context = np.roll(tokens, 1)  # the last token of a block is an end
    hashes = mix(mix(words)[context] + words[tokens])
    distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return distinct, inverse, context[at], tokens[at]


def pair_exchange(blocks: DataFrame, partitions: int) -> DataFrame:
    """Training counts of the bigrams of each block."""
    bounds = hash_bounds(partitions)

    def send(lines: Iterator[tuple]) -> Iterator[tuple]:
        for block, training, lengths, words, counts, tokens in lines:
            distinct, inverse, _, _ = pairs_of(unpacked_hashes(words), unpacked_tokens(tokens, counts))
            trained = np.repeat(unpacked(training).astype(bool), unpacked(lengths))
            counts = np.bincount(inverse[trained], minlength=len(distinct))
            for bucket, part in slices(distinct, bounds):
                yield bucket, TOTALS, block, part.start, packed_hashes(distinct[part]), packed(counts[part])

    def sum_up(group: list[tuple]) -> Iterator[tuple]:
        parts = [(block, start, unpacked_hashes(k), unpacked(c)) for _, block, start, k, c in group]
        yield from summed(parts)[2]

    sent = map_rows(blocks.select("block", "training", "lengths", "words", "counts", "tokens"), SENT, SENT_SCHEMA, send)
    return exchanged(sent, partitions, sum_up)


def share_codes(together: np.ndarray, in_context: np.ndarray, alone: np.ndarray, tokens: int) -> np.ndarray:
    """Bins of bigrams: how often the context is seen, and both shares, an occurrence deleted from each count."""
    after = share_bin((together - 1) / np.maximum(in_context - 1, 1))
    single = share_bin((alone - 1) / max(tokens - 1, 1))
    return (context_bucket(in_context - 1) * SHARES + after) * SHARES + single


def share_bins(joined: DataFrame, tokens: int) -> list[tuple[int, int]]:
    """Training tokens by bin. Each block knows its bigrams' counts and gives the tokens it holds itself."""

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        for training, lengths, words, counts, local, totals, pairs in lines:
            seen, together = assembled(totals), assembled(pairs)
            _, inverse, context, word = pairs_of(unpacked_hashes(words), unpacked_tokens(local, counts))
            trained = np.repeat(unpacked(training).astype(bool), unpacked(lengths))
            own = np.bincount(inverse[trained], minlength=len(together))
            held = np.flatnonzero(own)
            code = share_codes(together[held], seen[context[held]], seen[word[held]], tokens)
            codes, at = np.unique(code, return_inverse=True)
            yield from zip(codes.tolist(), np.bincount(at, weights=own[held]).astype(np.int64).tolist(), strict=True)

    schema = pa.schema([("code", pa.int64()), ("n", pa.int64())])
    columns = joined.select("training", "lengths", "words", "counts", "tokens", "totals", "pairs")
    found = map_rows(columns, "code bigint, n bigint", schema, convert)
    return [tuple(line) for line in found.groupBy("code").agg(F.sum("n")).collect()]


def context_weights(bins: list[tuple[int, int]], words: int) -> np.ndarray:
    """Mixture weights per bucket of contexts; a bucket without any has those of the one below."""
    weights = mixture_weights(bins, words)
    learned = {code // SHARES // SHARES for code, _ in bins}
    for bucket in range(1, len(weights)):
        if bucket not in learned:
            weights[bucket] = weights[bucket - 1]
    return weights


# ---- the operator ------------------------------------------------------------------------


def by_block(returned: DataFrame, kind: int, name: str) -> DataFrame:
    parts = F.collect_list(F.struct("start", "data")).alias(name)
    return returned.where(F.col("kind") == kind).groupBy("block").agg(parts)


def assembled(parts: list[dict]) -> np.ndarray:
    return np.concatenate([unpacked(p["data"]) for p in sorted(parts, key=lambda p: p["start"])])


def summaries(
    ids: list, training: np.ndarray, lengths: np.ndarray, seen: np.ndarray, n: int, v: int, score: np.ndarray
) -> Iterator[tuple]:
    """A row per text of a block from its tokens' counts and scores."""
    base = np.log10((seen + 0.1) / (n + 0.1 * (v + 1)))
    starts = np.cumsum(lengths) - lengths
    known = np.add.reduceat((seen > 0).astype(np.int64), starts)
    columns = (np.add.reduceat(base, starts), np.add.reduceat(score, starts))
    yield from zip(
        ids, training.astype(bool).tolist(), lengths.tolist(), known.tolist(), [n] * len(ids),
        *(c.tolist() for c in columns), strict=True,
    )


Converted = tuple[DataFrame, Callable[[Iterator[tuple]], Iterator[tuple]]]


def by_words(blocks: DataFrame, counted: DataFrame, partitions: int) -> Converted:
    """The blocks with their counts, and what makes scores of them."""
    paired = written(pair_exchange(blocks, partitions), "bigrams")
    joined = written(
        blocks.select("block", "ids", "training", "lengths", "words", "counts", "tokens")
        .join(by_block(counted, TOTALS, "totals"), "block")
        .join(by_block(paired, TOTALS, "pairs"), "block")
        .drop("block"),
        "counted-blocks",
    )
    sums = counted.where(F.col("kind") == BINS).agg(F.sum("start"), F.sum("n")).first()
    v, n = sums[0] or 0, sums[1] or 0
    weights = context_weights(share_bins(joined, n), v + 1)

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        for ids, training, lengths, words, counts, tokens, totals, pairs in lines:
            seen, tokens = assembled(totals), unpacked_tokens(tokens, counts)
            _, inverse, context, word = pairs_of(unpacked_hashes(words), tokens)
            in_context = seen[context]
            share = weights[context_bucket(in_context)]
            p = share[:, 0] * assembled(pairs) / np.maximum(in_context, 1)
            p += share[:, 1] * seen[word] / n if n else share[:, 1] / (v + 1)
            p += share[:, 2] / (v + 1)
            yield from summaries(ids, unpacked(training), unpacked(lengths), seen[tokens], n, v, np.log10(p)[inverse])

    return joined, convert


def scores(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, training, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    A text's tokens are its words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and one end.
    ``base_score`` is the add-0.1 unigram score, ``score`` the log10 probability by the mixture, both
    from the rows for which ``training`` holds. A null text is empty: the end alone. Null ids stay
    null and repeated rows are texts of their own; without training rows every token is unseen.

    Bigrams are told apart by 64-bit hashes: among n distinct ones, two are taken for the same with
    probability n^2 / 2^65.
    """
    spark = docs.sparkSession
    partitions = exchange_partitions(spark)
    frame = token_blocks(docs, training, id_col, text_col)
    kind = frame.schema["ids"].dataType.elementType.simpleString()
    id_type = arrow_schema(frame).field("ids").type.value_type
    blocks = written(frame, "token-blocks")
    counted = written(unigram_exchange(blocks, partitions), "unigrams")
    joined, convert = by_words(blocks, counted, partitions)
    out = pa.schema(
        [
            (id_col, id_type),
            ("training", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("n_known", pa.int64()),
            ("train_tokens", pa.int64()),
            ("base_score", pa.float64()),
            ("score", pa.float64()),
        ]
    )
    names = (
        f"`{id_col}` {kind}, training boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    return map_rows(joined, names, out, convert)


def held_out_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all documents by a model of those whose id does not have remainder 0 of 10."""
    found = scores(docs, remainder_of_id(id_col, 10) != 0, id_col, text_col)
    return found.withColumn("held_out", ~F.col("training")).drop("training")
