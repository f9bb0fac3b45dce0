"""The metric store as a cell table: ``(row_key, qualifier, value, write_ts)``, last write wins.

Writes append; reads take the newest write of each cell with a partial aggregation. The table is
partitioned by day and its files are sorted by key: a point read visits one folder and, through
the row-group statistics, few pages of it. ``write_ts`` is the order of writes: every write, be it a live
batch, a correction or a delete, takes the next number of the table (:mod:`telemetra.ordering`). A deleted row is a write too, of a cell that hides the row's older
cells. Compaction leaves the newest write of each cell.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from telemetra import schemas
from telemetra.functions import timekeys
from telemetra.operators.numbering import with_row_number
from telemetra.operators.point_metrics import wide_to_long
from telemetra.ordering import complete, complete_up_to, orders, take_number, taken
from telemetra.schemas import DAY_KEY, WIDE_PUT_QUALIFIERS

CELL = ["row_key", "qualifier"]


# ---- making cells ------------------------------------------------------------------------


def row_key(terminal_id: Column, time_id: Column) -> Column:
    return F.concat_ws("_", terminal_id, time_id)


def day_of_key(key: Column) -> Column:
    """The day folder a ``terminal_time`` row key is stored in."""
    return timekeys.parent_key(F.substring_index(key, "_", -1), DAY_KEY)


def day_of_wide_key(key: Column) -> Column:
    """The day folder of a ``time_terminal`` row key; the terminal may hold underscores."""
    return timekeys.parent_key(F.substring_index(key, "_", 1), DAY_KEY)


def cells_of_metrics(metrics: DataFrame, write_ts: Column) -> DataFrame:
    """Long metric rows as cells, with their day for partitioning."""
    return metrics.select(
        row_key(F.col("terminal_id"), F.col("time_id")).alias("row_key"),
        F.col("metric").alias("qualifier"),
        F.col("value").cast("string").alias("value"),
        write_ts.alias("write_ts"),
        timekeys.parent_key(F.col("time_id"), DAY_KEY).alias("day"),
    )


def cells_of_wide_rows(wide: DataFrame, write_ts: Column) -> DataFrame:
    """A wide row as nine cells. Here the time comes first in the key, and every qualifier is
    written, zero counts included; a missing percent is empty text."""
    columns = [
        F.coalesce(F.col(column).cast("string"), F.lit("")).alias(qualifier)
        for column, qualifier in WIDE_PUT_QUALIFIERS.items()
    ]
    return (
        wide.select(row_key(F.col("time_id"), F.col("terminal_id")).alias("row_key"), write_ts.alias("write_ts"), *columns)
        .unpivot(["row_key", "write_ts"], list(WIDE_PUT_QUALIFIERS.values()), "qualifier", "value")
        .select("row_key", "qualifier", "value", "write_ts", day_of_wide_key(F.col("row_key")).alias("day"))
    )


def metric_text_cells(wide: DataFrame, names: dict[str, str], write_ts: Column) -> DataFrame:
    """Present metrics of wide rows as cells whose values keep their own text form."""
    ids = ["terminal_id", "time_id", "write_ts"]
    metrics = wide_to_long(wide.withColumn("write_ts", write_ts), names, ids, as_text=True)
    return cells_of_metrics(metrics, F.col("write_ts"))


# ---- writing -----------------------------------------------------------------------------


def append_cells(cells: DataFrame, path: str) -> None:
    """Add writes to a table. Rows are balanced by day first: a day's rows meet in few files,
    and a huge day is split over several tasks."""
    balanced = cells.hint("rebalance", "day").sortWithinPartitions("day", "row_key")
    balanced.write.mode("append").partitionBy("day").parquet(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CELL).parquet(path)


def _newest_first() -> list[Column]:
    """How writes of a cell rank. One write that has a cell twice keeps the larger number."""
    return [F.col("write_ts"), F.col("value").try_cast("double"), F.col("value")]


def latest_cells(cells: DataFrame) -> DataFrame:
    """The newest write of each cell.

    The day belongs to the key and is grouped by too, so a test on day or key that comes later
    still reaches the scan.
    """
    others = [c for c in cells.columns if c not in (*CELL, "value", "write_ts")]
    write_ts, number, value = _newest_first()
    newest = F.max(F.struct(write_ts, number.alias("number"), value)).alias("newest")
    return cells.groupBy(*CELL, *others).agg(newest).select(*CELL, "newest.value", "newest.write_ts", *others)


def upsert_cells(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return latest_cells(existing.unionByName(incoming))


def next_order(spark: SparkSession, path: str) -> int:
    """The number of the next write of a table. The first goes on from the cells that are there."""

    def least() -> int:
        try:
            return read_cells(spark, path).agg(F.max("write_ts")).first()[0] or 0
        except AnalysisException:
            return 0

    return take_number(spark, path, least)


def put_cells(cells: DataFrame, path: str) -> int:
    """Add a write that comes after all before it; returns its number.

    The cells are computed first and the number is taken when they are there, so the order is that of
    the ends of computations, however long they take. A write that is repeated after a failure takes a new number.
    """
    spark, known = cells.sparkSession, cells.persist()
    try:
        known.count()
        order = next_order(spark, path)
        append_cells(known.withColumn("write_ts", F.lit(order).cast("bigint")), path)
        complete(spark, path, order)
        return order
    finally:
        known.unpersist()


#: Qualifier of the cell that deletes a row up to its own order.
TOMBSTONE = ""


def tombstones(keys: DataFrame, order: int = 0, day: Callable[[Column], Column] = day_of_key) -> DataFrame:
    """A cell per key that hides its row up to ``order``."""
    key = F.col("row_key")
    return keys.where(key.isNotNull()).select("row_key").distinct().select(
        key,
        F.lit(TOMBSTONE).alias("qualifier"),
        F.lit("").alias("value"),
        F.lit(order).cast("bigint").alias("write_ts"),
        day(key).alias("day"),
    )


def delete_stored_rows(
    keys: DataFrame, path: str, order: int | None = None, day: Callable[[Column], Column] = day_of_key
) -> None:
    """Delete rows of the table at ``path``: one tombstone per key, in the day folder of the key.

    It is the next write of the table, unless ``order`` says otherwise; later writes of the key show again.
    """
    if order is None:
        put_cells(tombstones(keys, day=day), path)
    else:
        append_cells(tombstones(keys, order, day), path)


def stored_cells(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """The current cells of a table, or those after its write number ``as_of``."""
    written = read_cells(spark, path)
    return current_cells(written if as_of is None else written.where(F.col("write_ts") <= as_of))


def current_cells(written: DataFrame) -> DataFrame:
    """Newest writes of each cell, without what a later tombstone hides.

    One aggregation by row and one join on the same key; rows never deleted meet no tombstone.
    """
    newest = latest_cells(written)
    gone = newest.where(F.col("qualifier") == TOMBSTONE).select("day", "row_key", F.col("write_ts").alias("gone_at"))
    kept = newest.where(F.col("qualifier") != TOMBSTONE).join(gone, ["day", "row_key"], "left")
    return kept.where(F.col("gone_at").isNull() | (F.col("write_ts") > F.col("gone_at"))).select(*newest.columns)


def compact_days(spark: SparkSession, path: str, target: str, days: list[str] | None = None) -> None:
    """Write the current cells of some days (all by default) to the table at ``target``.

    A day becomes as few files as its size asks for. The job names the source and the target, and
    switches readers to the target when it is complete; the source stays as it is.
    """
    current = stored_cells(spark, path)
    append_cells(current if days is None else current.where(F.col("day").isin(days)), target)


def delete_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """All cells except those of the given row keys (a frame with the column ``row_key``)."""
    return cells.join(keys.select("row_key").distinct(), "row_key", "left_anti")


def delete_one_row(cells: DataFrame, key: str) -> DataFrame:
    return cells.where(F.col("row_key") != key)


# ---- reading -----------------------------------------------------------------------------


def scan_key_contains(cells: DataFrame, part: str) -> DataFrame:
    return cells.where(F.col("row_key").contains(part))


def scan_filter(cells: DataFrame, condition: Column) -> DataFrame:
    return cells.where(condition)


def scan_range(cells: DataFrame, start_key: str, stop_key: str) -> DataFrame:
    """Start key included, stop key excluded."""
    return cells.where((F.col("row_key") >= start_key) & (F.col("row_key") < stop_key))


def first_row(cells: DataFrame, condition: Column | None = None) -> DataFrame:
    """All matching cells of the first row in key order of a stored table. Only the key itself is
    looked up first, so the read that follows prunes to one folder."""
    matching = cells if condition is None else cells.where(condition)
    key = matching.agg(F.min("row_key")).first()[0]
    return get_row(matching, key) if key is not None else matching.where(F.lit(False))


def get_row(cells: DataFrame, key: str) -> DataFrame:
    """All cells of one row key of a stored table."""
    return cells.where((F.col("day") == day_of_key(F.lit(key))) & (F.col("row_key") == key))


def get_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the given keys of a stored table. A null key is an error.

    The join is on day and key, so a selective key list prunes day folders at run time. Which
    side is broadcast, if any, is left to the size statistics.
    """
    key = F.col("row_key")
    checked = F.when(key.isNull(), F.raise_error(F.lit("row key must not be null"))).otherwise(key)
    wanted = keys.select(checked.alias("row_key")).distinct().withColumn("day", day_of_key(key))
    return cells.join(wanted, ["day", "row_key"], "left_semi")


def newest_versions(cells: DataFrame, max_versions: int) -> DataFrame:
    """Up to ``max_versions`` newest writes of each cell; 0 or less means the latest only.

    The rank limit is applied before the shuffle too, so a cell written millions of times sends
    at most ``max_versions`` rows per input task.
    """
    newest_first = Window.partitionBy(*CELL).orderBy(*[c.desc() for c in _newest_first()])
    return (
        cells.withColumn("version", F.row_number().over(newest_first))
        .where(F.col("version") <= max(max_versions, 1))
    )


# ---- paging ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Page:
    """Where a paged scan stands."""

    size: int = 100
    index: int = 0
    first_key: str | None = None
    last_key: str | None = None
    rows_seen: int = 0
    row_count: int | None = None

    @property
    def first_row_index(self) -> int:
        return (self.index - 1) * self.size + 1

    @property
    def previous_index(self) -> int:
        return max(self.index - 1, 1)

    @property
    def next_index(self) -> int:
        return self.index + 1

    @property
    def has_next(self) -> bool:
        """A full page may have a successor; a short one has none."""
        return self.row_count is None or self.row_count == self.size


def next_page(
    cells: DataFrame,
    page: Page,
    start_key: str | None = None,
    stop_key: str | None = None,
    condition: Column | None = None,
    max_versions: int = 1,
) -> tuple[DataFrame, Page]:
    """Cells of the next page of row keys and the new position.

    The first page includes the start key; later ones begin after the last key seen. Only the
    keys of one page, at most ``page.size``, reach the driver.
    """
    matching = cells if condition is None else cells.where(condition)
    if page.last_key is not None:
        matching = matching.where(F.col("row_key") > page.last_key)
    elif start_key is not None:
        matching = matching.where(F.col("row_key") >= start_key)
    if stop_key is not None:
        matching = matching.where(F.col("row_key") < stop_key)
    keys = [r.row_key for r in matching.select("row_key").distinct().orderBy("row_key").limit(page.size).collect()]
    position = Page(
        size=page.size,
        index=page.index + 1,
        first_key=keys[0] if keys else page.first_key,
        last_key=keys[-1] if keys else page.last_key,
        rows_seen=page.rows_seen + len(keys),
        row_count=len(keys),
    )
    if not keys:
        return newest_versions(matching.where(F.lit(False)), max_versions), position
    inside = matching.where((F.col("row_key") >= keys[0]) & (F.col("row_key") <= keys[-1]))
    return newest_versions(inside, max_versions), position


def write_page_bounds(cells: DataFrame, page_size: int, path: str) -> DataFrame:
    """Number the row keys once and store the bounds of every page; see :func:`page_info`."""
    page_info(cells, page_size).write.parquet(path)
    return cells.sparkSession.read.parquet(path)


def numbered_page(
    cells: DataFrame, bounds: DataFrame, index: int, page_size: int, max_versions: int = 1
) -> tuple[DataFrame, Page]:
    """Any page by its stored bounds: one look-up, then a range read of its keys."""
    line = bounds.where(F.col("page_index") == index).first()
    if line is None:
        return newest_versions(cells.where(F.lit(False)), max_versions), Page(size=page_size, index=index, row_count=0)
    page = Page(
        size=page_size,
        index=index,
        first_key=line["first_key"],
        last_key=line["last_key"],
        rows_seen=line["rows_seen"],
        row_count=line["row_count"],
    )
    inside = cells.where((F.col("row_key") >= page.first_key) & (F.col("row_key") <= page.last_key))
    return newest_versions(inside, max_versions), page


class StalePages(Exception):
    """The table was written to after its pages had been numbered."""


def index_pages(spark: SparkSession, table: str, page_size: int, path: str) -> int:
    """Number the pages of a table as it is now; returns the write the index belongs to.

    The numbers of later writes do not reach the pages, see :func:`indexed_page`.
    """
    version = newest_write(spark, table)
    pages = page_info(stored_cells(spark, table, version), page_size)
    pages.withColumn("version", F.lit(version).cast("bigint")).write.parquet(path)
    return version


def newest_write(spark: SparkSession, table: str, grace: float = 3600.0) -> int:
    """The number up to which all writes of a table have ended; of cells without numbers, the largest order."""
    if taken(orders(spark, table)):
        return complete_up_to(spark, table, grace)
    return read_cells(spark, table).agg(F.max("write_ts")).first()[0] or 0


def indexed_page(
    spark: SparkSession, table: str, path: str, index: int, page_size: int, only_current: bool = False
) -> tuple[DataFrame, Page]:
    """A page of a table as it was when :func:`index_pages` numbered it.

    Writes between two pages change neither, so no key comes twice and none is left out. With
    ``only_current`` a table that was written to meanwhile raises :class:`StalePages` instead.
    """
    bounds = spark.read.parquet(path)
    line = bounds.agg(F.max("version")).first()[0]
    if only_current and line is not None and newest_write(spark, table) != line:
        raise StalePages(f"{table} was written to after write {line}")
    return numbered_page(stored_cells(spark, table, line), bounds, index, page_size)


def page_info(keys: DataFrame, page_size: int) -> DataFrame:
    """One summary row per page of a table's distinct row keys, in key order."""
    numbered = with_row_number(keys.select("row_key").distinct(), [F.col("row_key")])
    page = F.floor((F.col("row_number") - 1) / page_size).cast("bigint") + 1
    return (
        numbered.groupBy(page.alias("page_index"))
        .agg(F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"), F.count(F.lit(1)).alias("row_count"))
        .select(
            "page_index",
            "first_key",
            "last_key",
            "row_count",
            ((F.col("page_index") - 1) * page_size + 1).alias("first_row_index"),
            F.greatest(F.col("page_index") - 1, F.lit(1)).alias("previous_index"),
            (F.col("page_index") + 1).alias("next_index"),
            (F.col("row_count") == page_size).alias("has_next"),
            ((F.col("page_index") - 1) * page_size + F.col("row_count")).alias("rows_seen"),
        )
    )
