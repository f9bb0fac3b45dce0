"""Token counts by byte-pair merging with a heap and a linked list.

Only the number of tokens is made: the symbols a text starts with, minus the merges. No merge of
the vocabulary joins two words (a word mark stands first in a piece, or fills it), so a text is cut
before each run of word marks and around characters that are in no longer piece, and every cut part
is merged once and remembered.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemetra.llm.common import arrow_schema, map_rows

MARK = "▁"
#: Parts remembered by a worker; the memory it takes is bounded by it.
MEMO_PARTS = 400_000


class PieceMerges:
    """The merge ranks of a sentencepiece BPE vocabulary file."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        order = []
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                order.append((-model.get_score(i), model.id_to_piece(i)))
        self.rank = {piece: score for score, piece in order}
        self.letters = {c for piece in self.rank if len(piece) > 1 for c in piece}
        crossing = [p for p in self.rank if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError("the vocabulary has pieces that join words")
        # Line ends stand in no piece of natural vocabularies; splitting there keeps the parts short.
        ends = "".join(c for c in "\n\r\t" if c not in self.letters)
        self.parts = re.compile(f"{MARK}+[^{MARK}{ends}]*|[^{MARK}{ends}]+|[{ends or MARK}]")
        self.memo: dict[str, int] = {}

    def symbols(self, char: str) -> int:
        """Tokens a character is while it is not merged: one, or its bytes."""
        return 1 if char in self.rank else len(char.encode())

    def count_part(self, part: str) -> int:
        """Pops the lowest-ranked adjacent pair, the leftmost among equals, until none is left."""
        rank = self.rank
        n = len(part)
        text = list(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            pair = part[i : i + 2]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        total = sum(1 if c in rank else len(c.encode()) for c in part)
        while heap:
            _, left, pair = heapq.heappop(heap)
            right = after[left]
            # A pair that an earlier merge has changed is stale; an emptied symbol has no text.
            if right >= n or not text[left] or text[left] + text[right] != pair:
                continue
            text[left], text[right] = pair, ""
            total -= 1
            follower = after[left] = after[right]
            if follower < n:
                before[follower] = left
                wider = pair + text[follower]
                if wider in rank:
                    heapq.heappush(heap, (rank[wider], left, wider))
            leader = before[left]
            if leader >= 0:
                wider = text[leader] + pair
                if wider in rank:
                    heapq.heappush(heap, (rank[wider], leader, wider))
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        memo, total = self.memo, 0
        marked = MARK + text.replace(" ", MARK)
        for part, times in Counter(self.parts.findall(marked)).items():
            tokens = memo.get(part)
            if tokens is None:
                tokens = self.count_part(part)
                if len(memo) >= MEMO_PARTS:
                    memo.clear()
                if len(part) < 200:
                    memo[part] = tokens
            total += times * tokens
        return total


@functools.lru_cache(maxsize=2)
def piece_merges(model_file: str) -> PieceMerges:
    return PieceMerges(model_file)


def token_counts(
    docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` per row of ``docs``.

    A null text counts as empty: 0 bytes, 0 tokens. A null id stays null, repeated rows are counted
    each, other columns are not read. ``model_file`` is a local path every worker has.
    """
    frame = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = frame.schema[0].dataType.simpleString()
    out = pa.schema(
        [arrow_schema(frame).field(0), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
    )

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        merges = piece_merges(model_file)
        for key, text in lines:
            n = merges.count(text)
            yield key, len(text.encode()), n, n > limit

    return map_rows(frame, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean", out, convert)
