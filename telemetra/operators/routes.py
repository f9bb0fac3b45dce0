"""Jobs on parcel scan records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemetra.functions.text import java_text
from telemetra.operators.numbering import with_row_number
from telemetra.schemas import ROUTE_KEY_PREFIX, ROUTE_SHORT_TEXT, ROUTE_STATUS_VEHICLE_CREDIBLE

DATE_TEXT = "EEE MMM dd HH:mm:ss z yyyy"


def project_key(routes: DataFrame) -> DataFrame:
    """``barRecordId_waybillNo`` and the zone of every non-empty record."""
    whole = F.col("bar_record_id").isNotNull() | F.col("waybill_no").isNotNull()
    key = F.concat_ws("_", java_text(F.col("bar_record_id")), java_text(F.col("waybill_no")))
    return routes.where(whole).select(key.alias("route_key"), "zone_code")


def _millis_or_empty(ts: Column) -> Column:
    return F.coalesce(F.unix_millis(ts).cast("string"), F.lit(""))


def composite_key() -> Column:
    """Prefix and main waybill, then waybill, container, zone, scan time and operation."""
    return F.concat_ws(
        "_",
        F.concat(F.lit(ROUTE_KEY_PREFIX), java_text(F.col("main_waybill_no"))),
        java_text(F.col("waybill_no")),
        java_text(F.col("contnr_code")),
        java_text(F.col("zone_code")),
        _millis_or_empty(F.col("bar_scan_tm")),
        java_text(F.col("op_code")),
    )


def composite_keys(routes: DataFrame) -> DataFrame:
    return routes.select(composite_key().alias("composite_key"))


def original_records(routes: DataFrame) -> DataFrame:
    """Records flagged as original, or confirmed by the vehicle."""
    return routes.where(F.col("original_flag") | (F.col("status") == ROUTE_STATUS_VEHICLE_CREDIBLE))


def export_lines(routes: DataFrame) -> DataFrame:
    """All fields of a record as one comma line; the text writer adds the line end."""
    names = [
        "main_waybill_no", "waybill_no", "zone_code", "op_code", "contnr_code", "op_attach_info", "obj_type_code",
    ]
    line = F.concat_ws(
        ",",
        composite_key(),
        _millis_or_empty(F.col("create_tm")),
        *[java_text(F.col(name)) for name in names],
        java_text(F.date_format("bar_scan_tm", DATE_TEXT)),
        *[java_text(F.col(name)) for name in ("data_status", "status", "ordinal")],
        java_text(F.date_format("create_tm", DATE_TEXT)),
    )
    return routes.select(line.alias("line"))


def short_texts(routes: DataFrame) -> DataFrame:
    """The short text form of a record: its base fields by name."""
    fields = {
        "barRecordId": "bar_record_id",
        "waybillNo": "waybill_no",
        "zoneCode": "zone_code",
        "opCode": "op_code",
        "destzonecode": "dest_zone_code",
    }
    named = [F.concat(F.lit(f"{name}="), java_text(F.col(column))) for name, column in fields.items()]
    line = F.concat(F.lit(ROUTE_SHORT_TEXT[0]), F.concat_ws(", ", *named), F.lit(ROUTE_SHORT_TEXT[1]))
    return routes.select(line.alias("line"))


def order_by_ordinal(routes: DataFrame, tie_breakers: list[str]) -> DataFrame:
    """Records in ordinal order with their position; the tie breakers make it reproducible."""
    return with_row_number(routes, [F.col("ordinal"), *[F.col(c) for c in tie_breakers]], "position", may_tie=True)


def zone_half_hour_counts(routes: DataFrame) -> DataFrame:
    """Arrivals per zone and half hour. Grouped on the slot as a long, formatted afterwards."""
    seconds = F.unix_seconds("bar_scan_tm")
    slot = (seconds - F.pmod(seconds, F.lit(1800))).alias("slot")
    return (
        routes.where(F.col("bar_scan_tm").isNotNull())
        .groupBy("zone_code", slot)
        .agg(F.count(F.lit(1)).alias("arrivals"))
        .select("zone_code", F.date_format(F.timestamp_seconds("slot"), "yyyyMMddHHmm").alias("half_hour"), "arrivals")
    )
