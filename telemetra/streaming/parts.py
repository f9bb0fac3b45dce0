"""Rows a stream writes batch by batch, kept readable as one table.

Each micro-batch has a folder of its own, named by run and batch, so a batch that runs again
overwrites itself. A run is what goes on from one checkpoint; later runs have larger numbers. Rows
are merged by key when they are read, in an order-free way.

Compaction merges the new folders with the rows of late. What has not changed for some compactions is
settled: it is written once more and then left alone, so that a compaction writes what has changed
lately and not all there is. A key that changes again after that has a second row, which merging joins
to the first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from telemetra.ordering import Folder, complete, take_number

#: Merges the rows of a key; the columns are aggregates to make beside.
Merge = Callable[..., DataFrame]

PLACE = [StructField("run", LongType()), StructField("batch", LongType())]
#: Compactions a row stays among the rows of late after its last change.
SETTLES_AFTER = 2


def run_number(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The number of a run, kept beside its checkpoint. A new checkpoint takes a larger one."""
    folder = Folder(spark, f"{checkpoint}/run")
    numbers = [int(name) for name in folder.names() if name.isdigit()]
    if numbers:
        return max(numbers)
    number = take_number(spark, path)
    complete(spark, path, number)
    folder.create(str(number))
    return number


def write_part(rows: DataFrame, path: str, run: int, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/parts/run={run}/batch={batch}")


@dataclass(frozen=True)
class Version:
    """A compaction: up to which batch of each run it goes, and since which one settled rows are read."""

    number: int = 0
    since: int = 0
    upto: dict[int, int] = field(default_factory=dict)


def version_of(spark: SparkSession, path: str) -> Version:
    try:
        lines = spark.read.parquet(f"{path}/upto")
    except AnalysisException:
        return Version()
    newest = lines.agg(F.max("version")).first()[0]
    found = lines.where(F.col("version") == newest).collect()
    return Version(newest, found[0]["since"], {x["run"]: x["batch"] for x in found if x["run"] is not None})


def _newer(version: Version) -> Column:
    """Batches a version does not go up to. It has a term per run that still has folders."""
    newer = F.lit(True)
    for run, batch in version.upto.items():
        newer &= (F.col("run") != run) | (F.col("batch") > batch)
    return newer


def _parts(spark: SparkSession, path: str, schema: StructType, version: Version) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields, *PLACE])).parquet(f"{path}/parts").where(_newer(version))


def _merged_rows(spark: SparkSession, path: str, schema: StructType, version: Version, settled: bool = True) -> DataFrame:
    kept = StructType([*schema.fields, *PLACE, StructField("changed", LongType())])
    whole = StructType([*kept.fields, StructField("version", LongType()), StructField("place", StringType())])
    if not version.number:
        return spark.createDataFrame([], kept)
    rows = spark.read.schema(whole).parquet(f"{path}/merged")
    wanted = (F.col("place") == "late") & (F.col("version") == version.number)
    if settled:
        wanted |= (F.col("place") == "settled") & F.col("version").between(version.since, version.number)
    return rows.where(wanted).drop("version", "place")


def read_parts(spark: SparkSession, path: str, schema: StructType, merge: Merge) -> DataFrame:
    """One row per key, merged from all that was written so far."""
    version = version_of(spark, path)
    rows = _merged_rows(spark, path, schema, version).drop("changed")
    return merge(_parts(spark, path, schema, version).unionByName(rows)).select(schema.names)


def _complete_batches(folder: Folder) -> dict[int, int]:
    """Per run the last batch up to which all its folders are complete."""
    def places(pattern: str) -> set[tuple[int, int]]:
        split = [name.split("/") for name in folder.matching(pattern)]
        return {(int(x[0].removeprefix("run=")), int(x[1].removeprefix("batch="))) for x in split}

    done, begun = places("run=*/batch=*/_SUCCESS"), places("run=*/batch=*")
    upto = {}
    for run in {run for run, _ in done}:
        first_open = min((b for r, b in begun - done if r == run), default=None)
        batches = [b for r, b in done if r == run and (first_open is None or b < first_open)]
        if batches:
            upto[run] = max(batches)
    return upto


def compact(
    spark: SparkSession, path: str, schema: StructType, merge: Merge, settles_after: int = SETTLES_AFTER, everything: bool = False
) -> None:
    """Make a new version of what complete batches have written. ``everything`` merges settled rows as well.

    It may run beside the stream. The version counts from the moment its line in ``upto`` is there, which
    is written last; a compaction that fails is overwritten by the next. Folders the version before did
    not need any more are removed then, so reads that have begun on it end well.
    """
    old = version_of(spark, path)
    folder = Folder(spark, f"{path}/parts")
    upto = {run: max(batch, old.upto.get(run, -1)) for run, batch in _complete_batches(folder).items()}
    number = old.number + 1
    within = F.lit(False)
    for run, batch in upto.items():
        within |= (F.col("run") == run) & (F.col("batch") <= batch)
    rows = _merged_rows(spark, path, schema, old, settled=everything)
    if upto:
        new = _parts(spark, path, schema, old).where(within).withColumn("changed", F.lit(number).cast("bigint"))
        rows = rows.unionByName(new)
    beside = [F.max(F.struct("run", "batch")).alias("last"), F.max("changed").alias("changed")]
    merged = merge(rows, *beside).select(*schema.names, "last.run", "last.batch", "changed")
    place = F.when(F.col("changed") > number - settles_after, "late").otherwise("settled")
    merged.withColumn("place", place).write.mode("overwrite").partitionBy("place").parquet(f"{path}/merged/version={number}")
    since = number if everything else old.since
    lines = [(since, run, batch) for run, batch in upto.items()] or [(since, None, None)]
    line = spark.createDataFrame(lines, "since long, run long, batch long")
    line.coalesce(1).write.mode("overwrite").parquet(f"{path}/upto/version={number}")
    _remove_unread(spark, path, folder, old)


def _remove_unread(spark: SparkSession, path: str, folder: Folder, old: Version) -> None:
    """Remove what the version before the newest does not read."""
    for name in folder.matching("run=*/batch=*"):
        run, batch = (int(x.split("=")[1]) for x in name.split("/"))
        if batch <= old.upto.get(run, -1):
            folder.remove(name)
    for below in ("merged", "upto"):
        versions = Folder(spark, f"{path}/{below}")
        for name in versions.matching("version=*"):
            number = int(name.split("=")[1])
            if number < old.number:
                late = f"{name}/place=late" if below == "merged" and number >= old.since else name
                versions.remove(late)
