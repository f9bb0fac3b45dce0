"""Schemas and fixed names of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Metric names as they appear as column qualifiers in the metric store.
GPS_FREQUENT = "gpsFrequent"
GPS_TOTAL_NUM = "gpsTotalNum"
GPS_ONLINE_TOTAL = "gpsOnlineTotal"
GPS_WEAK_NUM = "gpsWeakNum"
GPS_NOT_OPEN_NUM = "gpsNotOpenNum"
ZERO_SPEED_NUM = "zeroSpeedNum"
GPS_OFFLINE_TOTAL = "gpsOfflineTotal"
GPS_NORMAL_NUM = "gpsNormalNum"
GPS_ONLINE_PERCENT = "gpsOnlinePercent"
LOG_CONNECT_NUM = "gpsLogConnectNum"
LOG_CLOSE_NUM = "gpsLogCloseNum"
LOG_CONNECTION_DURATION = "gpsLogConnectionDuration"

# Wide-row column -> metric name.
GPS_METRIC_COLUMNS = {
    "gps_frequent": GPS_FREQUENT,
    "gps_total_num": GPS_TOTAL_NUM,
    "gps_online_total": GPS_ONLINE_TOTAL,
    "gps_weak_num": GPS_WEAK_NUM,
    "gps_not_open_num": GPS_NOT_OPEN_NUM,
    "gps_zero_speed_num": ZERO_SPEED_NUM,
    "gps_offline_total": GPS_OFFLINE_TOTAL,
    "gps_normal_num": GPS_NORMAL_NUM,
    "gps_online_percent": GPS_ONLINE_PERCENT,
}

# Qualifiers of the wide-row put.
WIDE_PUT_QUALIFIERS = {
    "gps_frequent": "frequency",
    "gps_total_num": "totalNum",
    "gps_online_total": "onlineNum",
    "gps_weak_num": "weakNum",
    "gps_not_open_num": "notOpenGpsNum",
    "gps_zero_speed_num": "zeroSpeedNum",
    "gps_offline_total": "offlineNum",
    "gps_normal_num": "normalNum",
    "gps_online_percent": "onlinePercent",
}

# Message protocol.
GPS_COMMAND = "420"
ENVELOPE_SEPARATOR = "@@@"
POINT_SEPARATOR = ";"
FIELD_SEPARATOR = ","
REQUEUE_SERVER_IP = "111.111.111.111"

# Route record keys and status codes.
ROUTE_KEY_PREFIX = "68"
ROUTE_STATUS_VEHICLE_CREDIBLE = 4

# What stands around the fields of a record's short text form.
ROUTE_SHORT_TEXT = ("BarRecordBaseDto [", "+]")

BUCKET_SECONDS = 600
BUCKET_MILLIS = BUCKET_SECONDS * 1000
DAY_MILLIS = 86_400_000

# Device times from this instant on are rejected: 2100-01-01 UTC.
DEVICE_MILLIS_END = 4_102_444_800_000

# Length of the wall-clock key text for each period.
TEN_MINUTE_KEY = 11
HOUR_KEY = 10
DAY_KEY = 8

ENVELOPE = T.StructType(
    [
        T.StructField("cmdId", T.StringType()),
        T.StructField("terminalId", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

GPS_POINT = T.StructType(
    [
        T.StructField("terminal_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("satellite_num", T.IntegerType()),
        T.StructField("online_status", T.IntegerType()),
    ]
)

LOG_RECORD = T.StructType(
    [
        T.StructField("serial_num", T.StringType()),
        T.StructField("terminal_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("online_status", T.IntegerType()),
    ]
)

CELL = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("write_ts", T.LongType()),
        T.StructField("day", T.StringType()),
    ]
)

METRIC = T.StructType(
    [
        T.StructField("terminal_id", T.StringType()),
        T.StructField("time_id", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("day", T.StringType()),
    ]
)

# A session reduced to one row: first connect, last close, number of records.
SESSION_STATE = T.StructType(
    [
        T.StructField("serial_num", T.StringType()),
        T.StructField("terminal_id", T.StringType()),
        T.StructField("open_ms", T.LongType()),
        T.StructField("close_ms", T.LongType()),
        T.StructField("record_count", T.LongType()),
    ]
)

ROUTE_RECORD = T.StructType(
    [
        T.StructField("data_status", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("main_waybill_no", T.StringType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("create_tm", T.TimestampType()),
        T.StructField("bar_record_id", T.StringType()),
        T.StructField("waybill_no", T.StringType()),
        T.StructField("zone_code", T.StringType()),
        T.StructField("op_code", T.StringType()),
        T.StructField("contnr_code", T.StringType()),
        T.StructField("op_attach_info", T.StringType()),
        T.StructField("obj_type_code", T.StringType()),
        T.StructField("bar_scan_tm", T.TimestampType()),
        T.StructField("dest_zone_code", T.StringType()),
        T.StructField("original_flag", T.BooleanType()),
    ]
)
