"""Small helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.workspace import new_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exchange_partitions(spark: SparkSession) -> int:
    """Partitions of an exchange; the session sets them in proportion to the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder, which ends its lineage there."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder_of_id(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id has remainder -1."""
    crc = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce((crc % divisor).cast("int"), F.lit(-1))


def rows(iterator: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of a stream of record batches, a batch in memory at a time."""
    for batch in iterator:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


class Emitter:
    """Collects output rows and hands them on as record batches of bounded size."""

    def __init__(self, schema: pa.Schema, max_rows: int = 8192, max_bytes: int = 4 << 20) -> None:
        self.schema, self.max_rows, self.max_bytes = schema, max_rows, max_bytes
        self.lines: list[tuple] = []
        self.size = 0

    def add(self, line: tuple, size: int = 0) -> bool:
        """Keeps a row; true when ``take`` should be called."""
        self.lines.append(line)
        self.size += size
        return len(self.lines) >= self.max_rows or self.size >= self.max_bytes

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.lines, strict=True)) or [() for _ in self.schema]
        self.lines, self.size = [], 0
        return pa.record_batch(
            [pa.array(values, type=field.type) for values, field in zip(columns, self.schema, strict=True)],
            schema=self.schema,
        )


#: Rows of an Arrow batch: documents are large rows, and a worker holds a batch several times over.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch size to ``BATCH_ROWS`` if it is larger."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Column names that are not ``taken``, whatever other columns a frame brings along."""
    used, found = {c.lower() for c in taken}, []
    for name in wanted:
        while name in used:
            name = f"_{name}"
        used.add(name)
        found.append(name)
    return found


def map_rows(
    df: DataFrame, schema: str, arrow_schema: pa.Schema, convert: Callable[[Iterator[tuple]], Iterator[tuple]]
) -> DataFrame:
    """``convert`` over the rows of each partition, batched through Arrow."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(arrow_schema)
        for line in convert(rows(batches)):
            if out.add(line, sum(len(v) for v in line if isinstance(v, (bytes, str)))):
                yield out.take()
        if out.lines:
            yield out.take()

    return df.mapInArrow(run, schema)


def rows_where(df: DataFrame, test: Callable[[], Callable[..., bool]], *columns: Column) -> DataFrame:
    """The rows of ``df`` for which ``test()(*columns)`` holds; all their columns pass through as they are."""
    bounded_batches(df.sparkSession)
    n, n_tested = len(df.columns), len(columns)
    names = [f"_{i}" for i in range(n + n_tested)]
    frame = df.select("*", *columns).toDF(*names)
    schema = frame.select(*names[:n]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds = test()
        for batch in batches:
            tested = zip(*(batch.column(n + i).to_pylist() for i in range(n_tested)), strict=True)
            mask = pa.array([holds(*values) for values in tested], type=pa.bool_())
            yield batch.select(names[:n]).filter(mask)

    return frame.mapInArrow(run, schema).toDF(*df.columns)


#: Words of 64 bits in a fixed filter.
FILTER_WORDS = 1 << 17


def fixed_filter(keys: DataFrame) -> np.ndarray:
    """A bit set of fixed size that has the bit of every value of the column ``hash``.

    It spares rows without a partner the shuffle of a join. The more keys, the more rows pass that
    have none; the join still decides.
    """
    word = F.pmod("hash", F.lit(FILTER_WORDS)).alias("word")
    bit = F.expr("shiftleft(1L, cast(pmod(shiftrightunsigned(hash, 40), 64) as int))").alias("bit")
    by_word = keys.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bits = np.zeros(FILTER_WORDS, dtype=np.uint64)
    for line in by_word.collect():
        bits[line["word"]] = np.uint64(line["bits"] & 0xFFFFFFFFFFFFFFFF)
    return bits


def in_filter(bits: np.ndarray, value: int) -> bool:
    return bool(int(bits[value % FILTER_WORDS]) >> (value >> 40 & 63) & 1)


def split_by_filter(df: DataFrame, keys: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: the rows whose ``key`` may be in ``keys (hash)``, and those that are surely not."""
    shared = df.sparkSession.sparkContext.broadcast(fixed_filter(keys))
    inside = rows_where(df, lambda: lambda value: in_filter(shared.value, value), key)
    outside = rows_where(df, lambda: lambda value: not in_filter(shared.value, value), key)
    return inside, outside


def arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def task_number() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values; spreads them over all bits."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values
