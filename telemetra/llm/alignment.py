"""Alignment of a byte-level vocabulary (A) with a piece vocabulary (B) over a corpus.

Both tokenizers cut the same bytes. Byte offsets where both have a token end cut the tokens into
groups; an A and a B token whose bytes overlap are linked. Most groups hold one token of each side with
the same bytes: for these the B id follows from the A id, so an array made of the two vocabularies
(A id to same-bytes B id) names the pair, and they are only counted, in vectors as long as the
vocabulary. The links of all other groups are pairs that go through a shuffle.

Texts are read once. A task packs what a later step needs into one row per block of text: of each
document the distinct regular ids and irregular pairs with their counts, and the distinct pairs of the
block. Only these, with counts summed over the block, are shuffled to be counted, and the corpus
counts come back per block. So a pair that stands in a third of all texts moves once per block.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from telemetra.llm.common import arrow_schema, task_number, written

#: Text of a block, in bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
MARK = "▁"
#: Fixed value: how byte-level vocabularies of this kind split a text before they merge.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, all other bytes for the letters from
    U+0100 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteVocabulary:
    """A byte-level BPE vocabulary in a ``tokenizers`` file; special strings are plain text to it.

    Ids are merge ranks in such a file, which is checked, so a rank encoder gives the same ids as the
    library that wrote it, several times faster.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        special = {token["content"] for token in content.get("added_tokens", [])}
        letters = byte_letters()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        ranks = {}
        for token, number in vocabulary.items():
            if token not in special:
                self.bytes[number] = bytes(map(letters.__getitem__, token))
                ranks[self.bytes[number]] = number
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
        made = [vocabulary[left + right] for left, right in merges]
        splits = content.get("pre_tokenizer") or {}
        if made != sorted(made) or splits.get("type") != "ByteLevel" or splits.get("add_prefix_space"):
            raise ValueError(f"{path} is not a byte-level vocabulary whose ids are ranks")
        self.encoder = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.encoder.encode_ordinary(text)


class PieceVocabulary:
    """A sentencepiece vocabulary; it puts a space before a text by itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            self.bytes.append(
                bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace(MARK, " ").encode()
            )
        self.spelled = [
            not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))
            for m in [self.model]
            for i in range(m.get_piece_size())
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Aligner:
    """Both vocabularies, their identity map and the spelling of ids in group strings."""

    def __init__(self, a_file: str, b_file: str) -> None:
        self.a, self.b = ByteVocabulary(a_file), PieceVocabulary(b_file)
        self.a_length = np.array([len(x) for x in self.a.bytes], dtype=np.int64)
        self.b_length = np.array([len(x) for x in self.b.bytes], dtype=np.int64)
        # Single bytes first: where a piece spells the same byte, the piece is the one that is used.
        order = sorted(range(len(self.b.bytes)), key=lambda i: self.b.spelled[i])
        by_bytes = {self.b.bytes[i]: i for i in order}
        #: A id -> id of the B token with the same bytes, or -1.
        self.identity = np.array([by_bytes.get(x, -1) if x else -1 for x in self.a.bytes], dtype=np.int64)
        n_a, n_b = len(self.a.bytes), len(self.b.bytes)
        self.spelling = [
            b"%d%s" % (i, end) for n, ends in ((n_a, (b",", b"|")), (n_b, (b",", b";"))) for end in ends for i in range(n)
        ]
        self.at = (0, n_a, 2 * n_a, 2 * n_a + n_b)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Ids of both sides and the number of bytes; None unless both sides spell a space and the text."""
        if not text:
            return None
        spaced = f" {text}"
        raw = spaced.encode()
        a, b = self.a.encode(spaced), self.b.encode(text)
        if b"".join(map(self.a.bytes.__getitem__, a)) != raw or b"".join(map(self.b.bytes.__getitem__, b)) != raw:
            return None
        return np.array(a, dtype=np.int32), np.array(b, dtype=np.int32), len(raw)

    def block(self, texts: list[str | None]) -> Block:
        encoded = [self.encode(text) for text in texts]
        found = [(i, *e) for i, e in enumerate(encoded) if e]
        out = Block.empty(len(texts))
        if not found:
            return out
        docs = np.array([f[0] for f in found])
        a, b = (np.concatenate([f[k] for f in found]).astype(np.int64) for k in (1, 2))
        doc_end = np.cumsum([f[3] for f in found])
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        is_a, is_b = np.zeros(doc_end[-1] + 1, dtype=bool), np.zeros(doc_end[-1] + 1, dtype=bool)
        is_a[a_end] = is_b[b_end] = True
        # Groups: a token closes one if the other side has an end at the same byte.
        closes_a, closes_b = is_b[a_end], is_a[b_end]
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        last_a, last_b = np.flatnonzero(closes_a), np.flatnonzero(closes_b)
        alone = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
        regular = alone & (self.identity[a[last_a]] == b[last_b])
        # Links: every stretch between two ends, of either side, has one token of each.
        ends = np.flatnonzero(is_a | is_b)
        link_a, link_b = np.cumsum(is_a)[ends] - is_a[ends], np.cumsum(is_b)[ends] - is_b[ends]
        open_link = ~regular[group_a[link_a]]
        link_doc = np.searchsorted(doc_end, ends)
        out.n_a[docs] = [len(f[1]) for f in found]
        out.n_b[docs] = [len(f[2]) for f in found]
        out.n_groups[docs] = np.bincount(np.searchsorted(doc_end, a_end[last_a]), minlength=len(docs))
        out.n_links[docs] = np.bincount(link_doc, minlength=len(docs))

        regular_doc = np.searchsorted(doc_end, a_end[last_a[regular]])
        keys, times = np.unique(docs[regular_doc] << 32 | a[last_a[regular]], return_counts=True)
        out.regular = np.stack([keys >> 32, keys & 0xFFFFFFFF, times])
        pairs = a[link_a[open_link]] << 32 | b[link_b[open_link]]
        out.pairs, place, out.pair_times = np.unique(pairs, return_inverse=True, return_counts=True)
        keys, times = np.unique(docs[link_doc[open_link]] << 32 | place, return_counts=True)
        out.irregular = np.stack([keys >> 32, keys & 0xFFFFFFFF, times])

        # Group strings: the tokens of both sides in the order they are written, each with its sign.
        line = np.empty(len(a) + len(b), dtype=np.int64)
        before_b = np.concatenate([[0], last_b[:-1] + 1])
        line[np.arange(len(a)) + before_b[group_a]] = a + np.where(closes_a, self.at[1], self.at[0])
        line[np.arange(len(b)) + last_a[group_b] + 1] = b + np.where(closes_b, self.at[3], self.at[2])
        start = 0
        for i, ids_a, ids_b, _ in found:
            end = start + len(ids_a) + len(ids_b)
            spelled = b"".join(map(self.spelling.__getitem__, line[start:end].tolist()))[:-1]
            out.groups[i] = hashlib.sha256(spelled).hexdigest()
            start = end
        return out


@dataclass
class Block:
    """What is kept of the documents of a block. ``regular`` and ``irregular`` have three rows:
    document, A id or number of the pair in ``pairs``, and how often."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    regular: np.ndarray
    irregular: np.ndarray
    pairs: np.ndarray
    pair_times: np.ndarray

    @classmethod
    def empty(cls, n: int) -> Block:
        def nothing(*shape: int) -> np.ndarray:
            return np.zeros(shape, dtype=np.int64)

        return cls(*(nothing(n) for _ in range(4)), [""] * n, nothing(3, 0), nothing(3, 0), nothing(0), nothing(0))


def packed(values: np.ndarray) -> bytes:
    return values.astype("<u4").tobytes()


def unpacked(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4").astype(np.int64).reshape(rows, -1)


@functools.lru_cache(maxsize=2)
def aligner(a_file: str, b_file: str) -> Aligner:
    return Aligner(a_file, b_file)


BLOCK_COLUMNS = "counted binary, groups array<string>, regular binary, irregular binary, pairs array<bigint>, times array<bigint>"


def blocks_of(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """A row per block of text, as a table: its documents' ids and what ``Block`` keeps of them."""
    kind = docs.schema[0].dataType.simpleString()
    id_type = arrow_schema(docs).field(0).type
    numbers, strings = pa.list_(pa.int64()), pa.list_(pa.string())
    names = ["block", "ids", "counted", "groups", "regular", "irregular", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_file, b_file)
        ids: list = []
        texts: list[str | None] = []
        size, number = 0, task_number() << 32

        def line() -> pa.RecordBatch:
            block = both.block(texts)
            values = [
                pa.array([number], type=pa.int64()),
                pa.array([ids], type=pa.list_(id_type)),
                pa.array([packed(np.stack([block.n_a, block.n_b, block.n_groups, block.n_links]))]),
                pa.array([block.groups], type=strings),
                pa.array([packed(block.regular)]),
                pa.array([packed(block.irregular)]),
                pa.array([block.pairs], type=numbers),
                pa.array([block.pair_times], type=numbers),
            ]
            return pa.record_batch(values, names=names)

        for batch in batches:
            for key, text in map(lambda i, b=batch: (b.column(0)[i].as_py(), b.column(1)[i].as_py()), range(batch.num_rows)):
                if texts and size + len(text or "") > BLOCK_BYTES:
                    yield line()
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(key)
                texts.append(text)
                size += len(text or "") + 100
        if texts:
            yield line()

    return written(docs.mapInArrow(run, f"block bigint, ids array<{kind}>, {BLOCK_COLUMNS}"), "aligned-blocks")


def regular_counts(blocks: DataFrame, identity: np.ndarray) -> DataFrame:
    """``(pair, n)`` of the regular groups: a vector as long as the vocabulary in each task, then a sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(identity), dtype=np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                _, ids, times = unpacked(data, 3)
                np.add.at(counts, ids, times)
        ids = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(ids << 32 | identity[ids]), pa.array(counts[ids])], names=["pair", "n"])

    return blocks.select("regular").mapInArrow(run, "pair bigint, n bigint")


class Alignment:
    """The alignment of a corpus: ``pairs()`` of ids with their links, and ``documents()``.

    ``docs`` may hold null ids, null or empty texts, repeated rows and any other columns. A text that is
    null or empty, or that one of the sides does not spell byte by byte after a space (a vocabulary that
    normalises it), has no tokens: zeros and an empty string. Repeated rows are documents each and
    count each. An empty table gives empty results. ``a_file`` and ``b_file`` are local paths every worker has.
    """

    def __init__(self, docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text") -> None:
        frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        self.id_col = id_col
        self.kind = frame.schema[0].dataType.simpleString()
        self.identity = Aligner(a_file, b_file).identity
        self.blocks = blocks_of(frame, a_file, b_file)
        regular = regular_counts(self.blocks, self.identity).select("pair", "n", F.lit(True).alias("regular"))
        irregular = self.blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
            F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"), F.lit(False).alias("regular")
        )
        b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
        counts = regular.unionByName(irregular).groupBy("pair").agg(F.sum("n").alias("n"), F.max("regular").alias("regular"))
        # A B id has at most as many partners as the other vocabulary has ids.
        most = F.max("n").over(Window.partitionBy(b_id))
        self.counts = written(counts.withColumn("best", F.col("n") == most), "aligned-pairs")

    def pairs(self) -> DataFrame:
        """``(a_id, b_id, n_links, best)``: every linked pair, its links, and whether no A id has more with this B id."""
        return self.counts.select(
            F.shiftright("pair", 32).cast("int").alias("a_id"),
            F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"),
            F.col("n").alias("n_links"),
            "best",
        )

    def documents(self) -> DataFrame:
        """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per document."""
        # At most one row per A id.
        known = self.counts.where("regular").select("pair", "n", "best").collect()
        count, best = (np.zeros(len(self.identity), dtype=np.int64) for _ in range(2))
        for line in known:
            count[line["pair"] >> 32], best[line["pair"] >> 32] = line["n"], line["best"]
        shared = self.blocks.sparkSession.sparkContext.broadcast((count, best))

        wanted = self.blocks.select("block", F.explode("pairs").alias("pair"))
        answers = (
            wanted.join(self.counts.select("pair", "n", "best"), "pair")
            .groupBy("block")
            .agg(F.array_sort(F.collect_list(F.struct("pair", "n", "best"))).alias("found"))
            .select("block", F.col("found.n").alias("count"), F.col("found.best").alias("best"))
        )
        joined = self.blocks.drop("pairs", "times").join(answers, "block", "left").drop("block")
        names = [self.id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            regular_n, regular_best = shared.value
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, groups, pair_n, pair_best = (batch.column(k)[i].values for k in (0, 2, 5, 6))
                    counted, regular, irregular = (batch.column(k)[i].as_py() for k in (1, 3, 4))
                    numbers = unpacked(counted, 4)
                    sums = np.zeros((2, numbers.shape[1]), dtype=np.int64)
                    doc, a, times = unpacked(regular, 3)
                    np.add.at(sums[0], doc, times * regular_best[a])
                    np.add.at(sums[1], doc, times * regular_n[a])
                    doc, place, times = unpacked(irregular, 3)
                    if len(doc):
                        found = pair_best.to_numpy(zero_copy_only=False).astype(np.int64), pair_n.to_numpy()
                        for total, value in zip(sums, found, strict=True):
                            np.add.at(total, doc, times * value[place])
                    yield pa.record_batch([ids, *map(pa.array, numbers), *map(pa.array, sums), groups], names=names)

        return joined.mapInArrow(
            run,
            f"`{self.id_col}` {self.kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
            "count_sum bigint, groups_sha256 string",
        )
