"""Route-record jobs."""

from __future__ import annotations

from telemetra.operators import routes as ops
from telemetra.plans.inputs import ROUTES_SQL, route_records
from telemetra.plans.registry import query

KEY_SQL = f"WITH {ROUTES_SQL} SELECT bar_record_id || '_' || waybill_no AS route_key, zone_code FROM routes"

_COMPOSITE = """'68' || coalesce(main_waybill_no, 'null') || '_' || waybill_no || '_' || contnr_code || '_' || zone_code || '_'
       || coalesce(CAST(epoch_ms(bar_scan_tm) AS VARCHAR), '') || '_' || op_code"""


@query("route_project_key", KEY_SQL)
def route_project_key(spark, sf_dir):
    return ops.project_key(route_records(spark, sf_dir))


@query("route_composite_key", f"WITH {ROUTES_SQL} SELECT {_COMPOSITE} AS composite_key FROM routes")
def route_composite_key(spark, sf_dir):
    return ops.composite_keys(route_records(spark, sf_dir))


@query(
    "route_original_filter",
    f"WITH {ROUTES_SQL} SELECT waybill_no, ordinal, status, original_flag FROM routes WHERE original_flag OR status = 4",
)
def route_original_filter(spark, sf_dir):
    return ops.original_records(route_records(spark, sf_dir)).select("waybill_no", "ordinal", "status", "original_flag")


EXPORT_SQL = f"""WITH {ROUTES_SQL}
SELECT {_COMPOSITE} || ',' || CAST(epoch_ms(create_tm) AS VARCHAR) || ',' || coalesce(main_waybill_no, 'null') || ',' || waybill_no
       || ',' || zone_code || ',' || op_code || ',' || contnr_code || ',' || op_attach_info || ',' || obj_type_code
       || ',' || coalesce(strftime(bar_scan_tm, '%a %b %d %H:%M:%S UTC %Y'), 'null')
       || ',' || CAST(data_status AS VARCHAR) || ',' || CAST(status AS VARCHAR) || ',' || CAST(ordinal AS VARCHAR)
       || ',' || strftime(create_tm, '%a %b %d %H:%M:%S UTC %Y') AS line
FROM routes"""


@query("route_text_export", EXPORT_SQL)
def route_text_export(spark, sf_dir):
    return ops.export_lines(route_records(spark, sf_dir))


@query(
    "route_short_text",
    f"""WITH {ROUTES_SQL}
SELECT 'BarRecordBaseDto [barRecordId=' || bar_record_id || ', waybillNo=' || waybill_no || ', zoneCode=' || zone_code
       || ', opCode=' || op_code || ', destzonecode=' || dest_zone_code || '+]' AS line
FROM routes""",
)
def route_short_text(spark, sf_dir):
    return ops.short_texts(route_records(spark, sf_dir))


@query(
    "route_order_by_ordinal",
    f"""WITH {ROUTES_SQL}
SELECT ordinal, waybill_no, bar_record_id, zone_code,
       row_number() OVER (ORDER BY ordinal, waybill_no, bar_record_id, zone_code) AS position
FROM routes""",
)
def route_order_by_ordinal(spark, sf_dir):
    keys = ["waybill_no", "bar_record_id", "zone_code"]
    return ops.order_by_ordinal(route_records(spark, sf_dir).select("ordinal", *keys), keys)


@query(
    "route_zone_half_hour_counts",
    f"""WITH {ROUTES_SQL}
SELECT zone_code, strftime(time_bucket(INTERVAL 30 MINUTE, bar_scan_tm), '%Y%m%d%H%M') AS half_hour, count(*) AS arrivals
FROM routes WHERE bar_scan_tm IS NOT NULL GROUP BY ALL""",
)
def route_zone_half_hour_counts(spark, sf_dir):
    return ops.zone_half_hour_counts(route_records(spark, sf_dir))
