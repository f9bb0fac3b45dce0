"""Quality by compression: which of two dictionaries makes a text smaller.

One zstandard dictionary is built from texts labelled good, one from texts labelled bad. A text is
compressed with each and with none; the difference of the two sizes over the plain one, and how far
the text shrinks by itself, are calibrated to a probability on labelled texts that the dictionaries
have not seen.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm.common import arrow_schema, map_rows, remainder_of_id
from telemetra.llm.labelled import labelled_sample, logistic, logistic_fit

#: Labelled documents the model is fitted on, at most; half build dictionaries, half calibrate.
SAMPLE_DOCUMENTS = 8_000
#: Blocks of labelled text that build a dictionary, at most, and their bytes.
TRAINING_BLOCKS = 6_000
BLOCK_BYTES = 1 << 10
#: A dictionary has an eighth of the bytes it is built from, within these bounds.
DICTIONARY_BYTES = (256, 112 << 10)
LEVEL = 3


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def training_blocks(texts: DataFrame, id_col: str, blocks: int = TRAINING_BLOCKS) -> dict[int, list[bytes]]:
    """At most so many blocks of the texts of each label, drawn from the whole texts.

    Documents give a block in turn, each in an order drawn by hash, so a very long text weighs no more
    than the others as long as they have blocks left.
    """
    drawn = F.transform(
        F.sequence(F.lit(0), F.ceil(F.octet_length("text") / BLOCK_BYTES).cast("int") - 1),
        lambda i: F.struct(
            F.xxhash64(F.lit("block"), F.col(id_col), i).alias("drawn"),
            F.substring(F.col("text"), i * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES)).alias("block"),
        ),
    )
    turns = texts.where(F.octet_length("text") > 0).select("label", F.posexplode(F.array_sort(drawn)).alias("turn", "found"))
    found = {}
    for label in (0, 1):
        first = turns.where(F.col("label") == label).orderBy("turn", "found").limit(blocks)
        found[label] = [bytes(line["block"]) for line in first.select("found.block").collect()]
    return found


def dictionary(blocks: list[bytes]) -> bytes:
    """A zstandard dictionary of some blocks; of blocks the library finds nothing common in, their own bytes."""
    import zstandard

    least, most = DICTIONARY_BYTES
    size = min(most, max(least, sum(map(len, blocks)) // 8))
    try:
        return zstandard.train_dictionary(size, blocks, k=512, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[:size] or b"\0" * 8


class Sizes:
    """Compressed sizes of a text: plain, with the good and with the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        import zstandard

        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(**options)
        self.by_label = []
        for content in (good, bad):
            trained = zstandard.ZstdCompressionDict(content)
            trained.precompute_compress(level=LEVEL)
            self.by_label.append(zstandard.ZstdCompressor(**options, dict_data=trained))

    def features(self, text: bytes) -> tuple[float, float, float]:
        """Normalised size difference (bad less good), own compression, and both together."""
        if not text:
            return 0.0, 0.0, 0.0
        plain = len(self.plain.compress(text))
        good, bad = (len(c.compress(text)) for c in self.by_label)
        difference = 10.0 * (bad - good) / max(good, bad, 1)
        shrunk = math.log2(len(text) / plain) if plain else 0.0
        return difference, shrunk, shrunk * shrunk


@functools.lru_cache(maxsize=2)
def sizes(good: bytes, bad: bytes) -> Sizes:
    return Sizes(good, bad)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    limit: int = SAMPLE_DOCUMENTS,
) -> CompressionModel:
    """A model from at most ``limit`` labelled documents; bad ones are as welcome as good ones.

    Half of them build the dictionaries, by at most ``TRAINING_BLOCKS`` blocks a label, half calibrate.
    Without labels of a class its dictionary is empty and the score is the smoothed base rate.
    """
    sample = labelled_sample(docs, labels, label_col, allowed, limit, id_col, text_col)
    frame = sample.select("draw", "label", id_col, F.col("text").cast("binary").alias("text"))
    texts = training_blocks(frame.where("draw < 500"), id_col)
    good, bad = dictionary(texts[1]), dictionary(texts[0])
    shared = docs.sparkSession.sparkContext.broadcast((good, bad))

    def measured(lines: Iterator[tuple]) -> Iterator[tuple]:
        compressed = sizes(*shared.value)
        for label, text in lines:
            yield (label, *compressed.features(text))

    schema = pa.schema([("label", pa.int32()), ("a", pa.float64()), ("b", pa.float64()), ("c", pa.float64())])
    held = map_rows(
        frame.where("draw >= 500").select("label", "text"), "label int, a double, b double, c double", schema, measured
    ).collect()
    seen = np.array([[h["a"], h["b"], h["c"]] for h in held]).reshape(-1, 3)
    weights = logistic_fit(seen, np.array([h["label"] for h in held], dtype=float))
    return CompressionModel(good, bad, tuple(float(w) for w in weights))


def scored(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.7) -> DataFrame:
    """``(id, score, predicted, size_difference)`` per row of ``docs``, whole texts compressed.

    A null text counts as empty; an empty text has no difference and gets the score that leaves.
    Null ids stay null, repeated rows are scored each, an empty table gives no rows.
    """
    frame = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = frame.schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = pa.schema(
        [
            arrow_schema(frame).field(0),
            ("score", pa.float64()),
            ("predicted", pa.int32()),
            ("size_difference", pa.float64()),
        ]
    )

    def convert(lines: Iterator[tuple]) -> Iterator[tuple]:
        model = shared.value
        compressed, weights = sizes(model.good, model.bad), np.array(model.weights)
        for key, text in lines:
            found = compressed.features(text)
            score = float(logistic(weights[:1] + weights[1:] @ np.array(found))[0])
            yield key, score, int(score >= cut), found[0]

    return map_rows(frame, f"`{id_col}` {kind}, score double, predicted int, size_difference double", out, convert)


def held_out_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all documents by a model that has not seen labels of ids with remainder 2 of 4."""
    model = fit(docs, labels, remainder_of_id(id_col, 4) != 2, id_col, text_col)
    return scored(docs, model, id_col, text_col).withColumn("held_out", remainder_of_id(id_col, 4) == 2)
