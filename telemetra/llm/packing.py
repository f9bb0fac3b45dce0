"""Packing documents into token windows by the online sum-of-squares rule.

A document longer than a window fills whole windows first. What remains goes to the fill level whose
choice leaves the smallest sum of squared counts of partly filled windows; the counts are kept in a
level array, so a choice costs one pass over the levels and never over the windows. Each partition
packs its own documents and keeps a share of its windows open, at most ``1 / OPEN_SHARE`` of those it
has filled (and ``FEWEST_OPEN``). While no more may be opened, a part that fits into no open window is
cut where the level chosen by the same rule is full. What is open at the end of a partition is cut and
refilled, so that a partition leaves one window that is not full.
"""

from __future__ import annotations

import functools
import json
import os
import string
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemetra.llm.common import arrow_schema, map_rows, task_number

#: Words remembered by a worker; the older half makes room for new ones.
MEMO_WORDS = 800_000
#: Bytes of text whose words are looked up together.
TOGETHER = 1 << 20
#: Unknown words given to the library in one string.
WORDS_JOINED = 1024
#: A partition opens no window while it has this many open ones, or this part of the filled ones.
FEWEST_OPEN = 8
OPEN_SHARE = 16

ID_BYTES = 4
#: A control character that is a token of its own between blanks.
SEPARATOR = b"\x01"


class WordIds:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins over it, so a text is cut at ASCII white space and
    each word is encoded once. It lower-cases, and signs after the last letter of a word (but for an
    apostrophe, which may begin a token with letters) are tokens of their own, so a word is put together
    from what stands before them and from them. Unknown words go to the library many at a time: words of
    the letters a to z straight to its merges, as no rule before those changes them, all others with a
    separator between them. A word that may hold a special token is matched as it stands, by itself.
    """

    signs = string.punctuation.replace("'", "").encode()

    def __init__(self, tokenizer_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as file:
            rules = json.load(file)
        suffix = rules["model"].get("end_of_word_suffix")
        self.letters = Tokenizer.from_str(
            json.dumps(rules | {"normalizer": None, "pre_tokenizer": None, "added_tokens": []})
        )
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        size = self.tokenizer.get_vocab_size()
        tokens = (self.tokenizer.id_to_token(i) or "" for i in range(size))
        self.ends_word = np.array([bool(suffix) and token.endswith(suffix) for token in tokens])
        separator = self.tokenizer.encode(SEPARATOR.decode(), add_special_tokens=False).ids
        self.separator = separator[0] if len(separator) == 1 else None
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def alone(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [array("I", encoding.ids).tobytes() for encoding in found]

    def of_letters(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of the letters a to z; each ends with the one token that ends a word."""
        ids = np.array(self.letters.encode_batch_fast([b" ".join(words).decode()])[0].ids, dtype="<u4")
        ends = (np.flatnonzero(self.ends_word[ids]) + 1) * ID_BYTES
        if len(ends) != len(words):
            return self.alone(words)
        raw, bounds = ids.tobytes(), [0, *ends.tolist()]
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def separated(self, words: list[bytes]) -> list[bytes]:
        """Ids of any words without the separator and without special tokens."""
        joined = (b" " + SEPARATOR + b" ").join(words).decode()
        found = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids
        ids = np.array(found, dtype="<u4")
        cuts = np.flatnonzero(ids == self.separator) * ID_BYTES if self.separator is not None else ()
        if len(cuts) != len(words) - 1:
            return self.alone(words)
        raw = ids.tobytes()
        starts, ends = [0, *(cuts + ID_BYTES).tolist()], [*cuts.tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(starts, ends)]

    def learn(self, unknown: set[bytes]) -> None:
        """Puts the ids of words, and of the parts they are made of, into the memo."""
        memo = self.recent
        heads: dict[bytes, int] = {}  # where the signs at the end of a word begin
        letters, others, special = set(), set(), []
        for word in unknown:
            if word.isalpha():
                (letters if word.islower() else others).add(word)
            elif b"<|" in word or SEPARATOR in word:
                special.append(word)
            else:
                head = word.rstrip(self.signs)
                n = len(head)
                if n == len(word) or not head[-1:].islower():
                    others.add(word)
                    continue
                heads[word] = n
                if head not in memo:
                    (letters if head.isalpha() and head.islower() else others).add(head)
                if word[n:] not in memo:
                    others.add(word[n:])
        for words, encode in ((list(letters), self.of_letters), (list(others), self.separated), (special, self.alone)):
            for at in range(0, len(words), WORDS_JOINED):
                some = words[at : at + WORDS_JOINED]
                memo.update(zip(some, encode(some), strict=True))
        for word, n in heads.items():
            memo[word] = memo[word[:n]] + memo[word[n:]]

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of each text; words not yet known are encoded together."""
        words = [(text if b"<|" in text else text.lower()).split() for text in texts]
        if len(self.recent) > MEMO_WORDS // 2:
            self.recent, self.older = {}, self.recent
        unknown = set(chain.from_iterable(words)).difference(self.recent)
        if self.older:
            known = unknown.intersection(self.older)
            self.recent.update((w, self.older[w]) for w in known)
            unknown -= known
        self.learn(unknown)
        memo = self.recent
        for line in words:
            yield b"".join(map(memo.__getitem__, line))


def encoded(encoder: WordIds, lines: Iterator[tuple]) -> Iterator[tuple]:
    """``(key, ids)`` in order, with about ``TOGETHER`` bytes of text encoded at a time."""
    keys, texts, size = [], [], 0
    for key, text in lines:
        keys.append(key)
        texts.append(text)
        size += len(text)
        if size >= TOGETHER:
            yield from zip(keys, encoder.ids(texts), strict=True)
            keys, texts, size = [], [], 0
    yield from zip(keys, encoder.ids(texts), strict=True)


@functools.lru_cache(maxsize=2)
def word_ids(tokenizer_file: str) -> WordIds:
    return WordIds(tokenizer_file)


class SumOfSquares:
    """Windows by fill level. A part is ``(document, start, ids)``."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.levels = np.zeros(capacity + 1, dtype=np.int64)
        self.windows: dict[int, deque[list]] = {}
        self.open = self.filled = 0

    def level_for(self, size: int, may_open: bool = True) -> int:
        """The level that takes ``size`` more tokens at the least sum of squares; fuller ones win ties.

        If no window may be opened and none takes the part whole, the level that the part fills at the
        least sum of squares; ties cut off most of the part.
        """
        room = self.capacity - size
        taken = self.levels[: room + 1] > 0
        taken[0] = may_open or not room
        if not taken.any():
            return room + 1 + int(np.argmax(self.levels[room + 1 : self.capacity]))
        after = self.levels[size:].copy()
        after[-1] = -1  # a full window is no longer counted: no square is added
        change = 2 * (after - self.levels[: room + 1]) + 2
        change[-1] = 1 - 2 * self.levels[room]
        change[0] = 2 * self.levels[size] + 1 if room else 0
        change[~taken] = np.iinfo(np.int64).max
        return room - int(np.argmin(change[::-1]))

    def place(self, document: tuple, start: int, ids: bytes) -> Iterator[list]:
        """Puts the ids of a document into windows and gives the windows that are full."""
        while ids:
            may_open = self.open < max(FEWEST_OPEN, self.filled // OPEN_SHARE)
            level = self.level_for(min(len(ids) // ID_BYTES, self.capacity), may_open)
            window = self.windows[level].popleft() if level else []
            if level:
                self.levels[level] -= 1
                self.open -= 1
            part = ids[: (self.capacity - level) * ID_BYTES]
            window.append((document, start, part))
            size = len(part) // ID_BYTES
            start, ids = start + size, ids[len(part) :]
            if level + size == self.capacity:
                self.filled += 1
                yield window
            else:
                self.levels[level + size] += 1
                self.open += 1
                self.windows.setdefault(level + size, deque()).append(window)

    def rest(self) -> list[tuple]:
        """All parts in open windows, fullest windows first."""
        return [p for level in sorted(self.windows, reverse=True) for window in self.windows[level] for p in window]


def refill(parts: list[tuple], capacity: int) -> Iterator[list[tuple]]:
    """Windows of ``capacity`` ids from parts that are cut where a window ends."""
    window, fill = [], 0
    for document, start, ids in parts:
        while ids:
            take = ids[: (capacity - fill) * ID_BYTES]
            window.append((document, start, take))
            n = len(take) // ID_BYTES
            start, ids, fill = start + n, ids[len(take) :], fill + n
            if fill == capacity:
                yield window
                window, fill = [], 0
    if window:
        yield window


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces ``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids)`` of all documents.

    A document is its token ids and ``end_id``; each id lies in one piece, pieces fill a sequence
    from offset 0 without gaps, and no sequence holds more than ``capacity`` ids. A null or empty
    text is the end id alone; a null id stays null; repeated rows are documents of their own; an
    empty table gives no rows. ``sequence_id`` is unique, not gapless. ``ids`` holds the piece as
    little-endian unsigned 32-bit ids, or is left out without ``keep_ids``.
    """
    frame = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = frame.schema[0].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        encoder, packer = word_ids(tokenizer_file), SumOfSquares(capacity)
        sequence = task_number() << 32

        def pieces(window: list[tuple]) -> Iterator[tuple]:
            nonlocal sequence
            offset = 0
            for (key, total), start, ids in window:
                n = len(ids) // ID_BYTES
                line = (key, start, n, zlib.crc32(ids), total, sequence, offset)
                yield (*line, ids) if keep_ids else line
                offset += n
            sequence += 1

        for key, ids in encoded(encoder, lines):
            ids += end
            for window in packer.place((key, len(ids) // ID_BYTES), 0, ids):
                yield from pieces(window)
        for window in refill(packer.rest(), capacity):
            yield from pieces(window)

    fields = [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    fields += [("ids", pa.binary())] if keep_ids else []
    names = ", ".join(f"`{n}` {'binary' if t == pa.binary() else 'bigint'}" for n, t in fields)
    return map_rows(frame, f"`{id_col}` {kind}, {names}", pa.schema([arrow_schema(frame).field(0), *fields]), convert)
