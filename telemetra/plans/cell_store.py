"""The cell table: writes, scans, point reads, versions, paging, deletes.

Cells come from three writers (users by remainder of three) that each store their own view of a
bucket, so a cell has up to three versions and the last write decides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra import jobs
from telemetra.functions import timekeys
from telemetra.operators import cells as ops
from telemetra.operators import point_metrics as pm
from telemetra.plans.inputs import POINTS_SQL, WIDE_SQL, gps_points, long_sql, points_of, table, wide_sql
from telemetra.plans.registry import query
from telemetra.plans.staging import staged
from telemetra.schemas import GPS_METRIC_COLUMNS
from telemetra.streaming import metrics, sinks
from telemetra.workspace import new_dir

PAGE_SIZE = 50


def versions_frame(spark, sf_dir, writers=(0, 1, 2)):
    """Every write of every cell by the given writers."""
    writer = F.col("user_id") % 3
    points = points_of(table(spark, sf_dir, "events").where(writer.isin(*writers)), writer.alias("writer"))
    newest = F.max(F.unix_millis("ts")).alias("newest_ms")
    wide = pm.derive_metrics(pm.counts(points, ["writer"], [newest]))
    return ops.metric_text_cells(wide, GPS_METRIC_COLUMNS, F.col("newest_ms") * 10 + F.col("writer"))


def version_table(spark, sf_dir):
    return ops.read_cells(
        spark, staged(spark, sf_dir, "cell-versions", lambda path: ops.append_cells(versions_frame(spark, sf_dir), path))
    )


def cell_table(spark, sf_dir):
    """The latest cells as a stored table."""

    def write(path):
        ops.append_cells(ops.latest_cells(version_table(spark, sf_dir)), path)

    return ops.read_cells(spark, staged(spark, sf_dir, "cells", write))


_WRITER_WIDE = wide_sql(keys="terminal_id, time_id, writer", extra=", max(ms) * 10 + writer AS write_ts")

VERSIONS_SQL = f"""{POINTS_SQL}, {_WRITER_WIDE},
{long_sql("terminal_id || '_' || time_id AS row_key, writer, write_ts", "VARCHAR", "writes")},
versions AS (SELECT row_key, metric AS qualifier, value, write_ts, writer FROM writes)"""

CELLS_SQL = f"""{VERSIONS_SQL},
cells AS (
  SELECT row_key, qualifier, value, write_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY row_key, qualifier ORDER BY write_ts DESC) AS rn FROM versions
  ) WHERE rn = 1
)"""

COLUMNS = ["row_key", "qualifier", "value", "write_ts"]
_COLUMNS = ", ".join(COLUMNS)


@query("cells_upsert", f"WITH {CELLS_SQL} SELECT {_COLUMNS} FROM cells")
def cells_upsert(spark, sf_dir):
    """The first writer's cells are stored, the others arrive later and replace them."""
    path = new_dir(spark, "upsert")
    ops.append_cells(versions_frame(spark, sf_dir, [0]), path)
    ops.append_cells(versions_frame(spark, sf_dir, [1, 2]), path)
    return ops.latest_cells(ops.read_cells(spark, path)).drop("day")


@query(
    "cells_put_wide",
    f"""WITH {WIDE_SQL}
SELECT time_id || '_' || terminal_id AS row_key,
       unnest(['frequency','totalNum','onlineNum','weakNum','notOpenGpsNum','zeroSpeedNum','offlineNum','normalNum','onlinePercent']) AS qualifier,
       unnest([CAST(gps_frequent AS VARCHAR), CAST(gps_total_num AS VARCHAR), CAST(gps_online_total AS VARCHAR),
               CAST(gps_weak_num AS VARCHAR), CAST(gps_not_open_num AS VARCHAR), CAST(gps_zero_speed_num AS VARCHAR),
               CAST(gps_offline_total AS VARCHAR), CAST(gps_normal_num AS VARCHAR),
               coalesce(CAST(gps_online_percent AS VARCHAR), '')]) AS value,
       CAST(1 AS BIGINT) AS write_ts
FROM wide""",
)
def cells_put_wide(spark, sf_dir):
    """Wide rows are put into a table of their own and read back."""
    path = new_dir(spark, "wide-cells")
    ops.append_cells(ops.cells_of_wide_rows(pm.metrics_wide(gps_points(spark, sf_dir)), F.lit(1).cast("bigint")), path)
    return ops.stored_cells(spark, path).drop("day")


@query("cells_scan_full", f"WITH {CELLS_SQL} SELECT {_COLUMNS} FROM cells")
def cells_scan_full(spark, sf_dir):
    return cell_table(spark, sf_dir).select(*COLUMNS)


@query("cells_scan_key_contains", f"WITH {CELLS_SQL} SELECT {_COLUMNS} FROM cells WHERE contains(row_key, '2024011')")
def cells_scan_key_contains(spark, sf_dir):
    return ops.scan_key_contains(cell_table(spark, sf_dir), "2024011").select(*COLUMNS)


@query(
    "cells_scan_filter",
    f"WITH {CELLS_SQL} SELECT {_COLUMNS} FROM cells WHERE qualifier = 'gpsWeakNum' AND CAST(value AS INTEGER) >= 1 AND row_key >= '1'",
)
def cells_scan_filter(spark, sf_dir):
    condition = (F.col("qualifier") == "gpsWeakNum") & (F.col("value").try_cast("int") >= 1) & (F.col("row_key") >= "1")
    return ops.scan_filter(cell_table(spark, sf_dir), condition).select(*COLUMNS)


@query(
    "cells_first_row",
    f"""WITH {CELLS_SQL}
SELECT {_COLUMNS} FROM cells WHERE qualifier <> 'gpsFrequent'
  AND row_key = (SELECT min(row_key) FROM cells WHERE qualifier <> 'gpsFrequent')""",
)
def cells_first_row(spark, sf_dir):
    return ops.first_row(cell_table(spark, sf_dir), F.col("qualifier") != "gpsFrequent").select(*COLUMNS)


@query(
    "cells_range_scan",
    f"WITH {CELLS_SQL} SELECT {_COLUMNS} FROM cells WHERE row_key >= '0_2024010512' AND row_key < '0_2024012006'",
)
def cells_range_scan(spark, sf_dir):
    return ops.scan_range(cell_table(spark, sf_dir), "0_2024010512", "0_2024012006").select(*COLUMNS)


@query(
    "cells_get_row",
    f"""WITH {CELLS_SQL}
SELECT {_COLUMNS} FROM cells WHERE row_key = (SELECT max(row_key) FROM cells)""",
)
def cells_get_row(spark, sf_dir):
    cells = cell_table(spark, sf_dir)
    return ops.get_row(cells, cells.agg(F.max("row_key")).first()[0]).select(*COLUMNS)


_ERROR_KEYS_SQL = "SELECT terminal_id || '_' || time_id AS row_key FROM points WHERE online_status = 0"


def _offline_keys(spark, sf_dir):
    """Keys of the buckets in which a terminal was seen offline."""
    offline = gps_points(spark, sf_dir).where(F.col("online_status") == 0)
    return offline.select(ops.row_key(F.col("terminal_id"), timekeys.time_id(F.col("ts"))).alias("row_key"))


@query("cells_get_rows", f"WITH {CELLS_SQL} SELECT {_COLUMNS} FROM cells WHERE row_key IN ({_ERROR_KEYS_SQL})")
def cells_get_rows(spark, sf_dir):
    return ops.get_rows(cell_table(spark, sf_dir), _offline_keys(spark, sf_dir)).select(*COLUMNS)


@query("cells_delete_keys", f"WITH {CELLS_SQL} SELECT {_COLUMNS} FROM cells WHERE row_key NOT IN ({_ERROR_KEYS_SQL})")
def cells_delete_keys(spark, sf_dir):
    """Rows are deleted in a stored table, which is compacted then and read back."""
    path, target = new_dir(spark, "deletes"), new_dir(spark, "compacted")
    ops.append_cells(cell_table(spark, sf_dir), path)
    ops.delete_stored_rows(_offline_keys(spark, sf_dir), path)
    ops.compact_days(spark, path, target)
    return ops.read_cells(spark, target).select(*COLUMNS)


@query(
    "cells_delete_then_live_write",
    f"""WITH {WIDE_SQL}, {long_sql("terminal_id || '_' || time_id AS row_key", "VARCHAR", "writes")}
SELECT row_key, metric AS qualifier, value FROM writes
WHERE split_part(row_key, '_', 2) >= '20240116' OR row_key NOT IN ({_ERROR_KEYS_SQL})""",
)
def cells_delete_then_live_write(spark, sf_dir):
    """A live run writes the first half of the month, rows of both halves are deleted, the run goes on:
    what it writes after the delete shows."""
    path, work, inbox = (new_dir(spark, name) for name in ("live", "work", "inbox"))
    events, second_half = table(spark, sf_dir, "events"), F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")

    def live(part):
        events.where(part).write.mode("append").parquet(inbox)
        points = points_of(sinks.parquet_stream(spark, events.schema, inbox))
        sinks.run_available(jobs.live_cells(metrics.gps_metrics(points), GPS_METRIC_COLUMNS, path, f"{work}/checkpoint"))

    live(~second_half)
    ops.delete_stored_rows(_offline_keys(spark, sf_dir), path)
    live(second_half)
    return ops.stored_cells(spark, path).select("row_key", "qualifier", "value")


@query(
    "cells_latest_versions",
    f"""WITH {VERSIONS_SQL}
SELECT {_COLUMNS}, CAST(rn AS INTEGER) AS version FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key, qualifier ORDER BY write_ts DESC) AS rn FROM versions
) WHERE rn <= 2""",
)
def cells_latest_versions(spark, sf_dir):
    return ops.newest_versions(version_table(spark, sf_dir).drop("day"), 2)


@query(
    "cells_page",
    f"""WITH {CELLS_SQL},
ranked AS (SELECT *, dense_rank() OVER (ORDER BY row_key) AS nth FROM cells WHERE row_key >= '0_20240103')
SELECT {_COLUMNS}, CAST(3 AS INTEGER) AS page_index, CAST({3 * PAGE_SIZE} AS INTEGER) AS rows_seen
FROM ranked WHERE nth > {2 * PAGE_SIZE} AND nth <= {3 * PAGE_SIZE}""",
)
def cells_page(spark, sf_dir):
    """The third page from a start key on, by page bounds that are numbered once."""
    cells = cell_table(spark, sf_dir).where(F.col("row_key") >= "0_20240103")
    pages = ops.write_page_bounds(cells, PAGE_SIZE, new_dir(spark, "pages"))
    rows, page = ops.numbered_page(cells, pages, 3, PAGE_SIZE)
    return rows.select(*COLUMNS, F.lit(page.index).alias("page_index"), F.lit(page.rows_seen).alias("rows_seen"))


@query(
    "cells_page_of_version",
    f"""WITH {CELLS_SQL},
ranked AS (SELECT *, dense_rank() OVER (ORDER BY row_key) AS nth FROM cells)
SELECT {_COLUMNS}, CAST(3 AS INTEGER) AS page_index FROM ranked WHERE nth > {2 * PAGE_SIZE} AND nth <= {3 * PAGE_SIZE}""",
)
def cells_page_of_version(spark, sf_dir):
    """Pages are numbered, as many rows again are written before them, and the third page is what it was."""
    path, pages = new_dir(spark, "paged"), new_dir(spark, "pages")
    stored = cell_table(spark, sf_dir)
    ops.append_cells(stored, path)
    ops.index_pages(spark, path, PAGE_SIZE, pages)
    ops.put_cells(stored.withColumn("row_key", F.concat(F.lit("0"), "row_key")), path)
    rows, page = ops.indexed_page(spark, path, pages, 3, PAGE_SIZE)
    return rows.select(*COLUMNS, F.lit(page.index).alias("page_index"))


@query(
    "cells_page_info",
    f"""WITH {CELLS_SQL},
numbered AS (
  SELECT row_key, row_number() OVER (ORDER BY row_key) AS rn FROM (SELECT DISTINCT row_key FROM cells)
),
pages AS (
  SELECT CAST((rn - 1) // {PAGE_SIZE} + 1 AS BIGINT) AS page_index, min(row_key) AS first_key, max(row_key) AS last_key,
         count(*) AS row_count
  FROM numbered GROUP BY ALL
)
SELECT page_index, first_key, last_key, row_count, (page_index - 1) * {PAGE_SIZE} + 1 AS first_row_index,
       greatest(page_index - 1, 1) AS previous_index, page_index + 1 AS next_index, row_count = {PAGE_SIZE} AS has_next,
       (page_index - 1) * {PAGE_SIZE} + row_count AS rows_seen
FROM pages""",
)
def cells_page_info(spark, sf_dir):
    return ops.page_info(cell_table(spark, sf_dir), PAGE_SIZE)
