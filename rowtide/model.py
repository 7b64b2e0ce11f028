"""Schemas and fixed code tables of the MySQL replication log.

The code tables below are the published MySQL binary-log constants; output
must carry exactly these names, so they are fixed values.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: binlog event type codes and names (MySQL binlog event types).
# ---------------------------------------------------------------------------
EVENT_NAMES = {
    0: "UNKNOWN_EVENT",
    1: "START_EVENT_V3",
    2: "QUERY_EVENT",
    3: "STOP_EVENT",
    4: "ROTATE_EVENT",
    5: "INTVAR_EVENT",
    6: "LOAD_EVENT",
    7: "SLAVE_EVENT",
    8: "CREATE_FILE_EVENT",
    9: "APPEND_BLOCK_EVENT",
    10: "EXEC_LOAD_EVENT",
    11: "DELETE_FILE_EVENT",
    12: "NEW_LOAD_EVENT",
    13: "RAND_EVENT",
    14: "USER_VAR_EVENT",
    15: "FORMAT_DESCRIPTION_EVENT",
    16: "XID_EVENT",
    17: "BEGIN_LOAD_QUERY_EVENT",
    18: "EXECUTE_LOAD_QUERY_EVENT",
    19: "TABLE_MAP_EVENT",
    20: "WRITE_ROWS_EVENTv0",
    21: "UPDATE_ROWS_EVENTv0",
    22: "DELETE_ROWS_EVENTv0",
    23: "WRITE_ROWS_EVENTv1",
    24: "UPDATE_ROWS_EVENTv1",
    25: "DELETE_ROWS_EVENTv1",
    26: "INCIDENT_EVENT",
    27: "HEARTBEAT_EVENT",
    28: "IGNORABLE_EVENT",
    29: "ROWS_QUERY_EVENT",
    30: "WRITE_ROWS_EVENTv2",
    31: "UPDATE_ROWS_EVENTv2",
    32: "DELETE_ROWS_EVENTv2",
    33: "GTID_EVENT",
    34: "ANONYMOUS_GTID_EVENT",
    35: "PREVIOUS_GTIDS_EVENT",
}

# FIXED VALUES: event kinds skipped before decode (heartbeat, ignorable, GTID kinds).
SKIPPED_EVENT_CODES = (27, 28, 33, 34, 35)

# FIXED VALUES: operation of a row / query event.
WRITE_CODES = (20, 23, 30)
UPDATE_CODES = (21, 24, 31)
DELETE_CODES = (22, 25, 32)
QUERY_CODE = 2
ROTATE_CODE = 4
ROW_CODES = WRITE_CODES + UPDATE_CODES + DELETE_CODES
# The subscription the feed runs with by default: all row events plus queries.
DEFAULT_SUBSCRIPTION = ("insert", "update", "delete", "query")

# FIXED VALUES: header flag names, bit i has value 1 << i.
FLAG_NAMES = [
    "LOG_EVENT_BINLOG_IN_USE_F",
    "LOG_EVENT_FORCED_ROTATE_F",
    "LOG_EVENT_THREAD_SPECIFIC_F",
    "LOG_EVENT_SUPPRESS_USE_F",
    "LOG_EVENT_UPDATE_TABLE_MAP_VERSION_F",
    "LOG_EVENT_ARTIFICIAL_F",
    "LOG_EVENT_RELAY_LOG_F",
    "LOG_EVENT_IGNORABLE_F",
    "LOG_EVENT_NO_FILTER_F",
    "LOG_EVENT_MTS_ISOLATE_F",
]

# FIXED VALUES: column field type codes and names (MySQL field types).
FIELD_TYPE_NAMES = {
    0: "FIELD_TYPE_DECIMAL",
    1: "FIELD_TYPE_TINY",
    2: "FIELD_TYPE_SHORT",
    3: "FIELD_TYPE_LONG",
    4: "FIELD_TYPE_FLOAT",
    5: "FIELD_TYPE_DOUBLE",
    6: "FIELD_TYPE_NULL",
    7: "FIELD_TYPE_TIMESTAMP",
    8: "FIELD_TYPE_LONGLONG",
    9: "FIELD_TYPE_INT24",
    10: "FIELD_TYPE_DATE",
    11: "FIELD_TYPE_TIME",
    12: "FIELD_TYPE_DATETIME",
    13: "FIELD_TYPE_YEAR",
    14: "FIELD_TYPE_NEWDATE",
    15: "FIELD_TYPE_VARCHAR",
    16: "FIELD_TYPE_BIT",
    17: "FIELD_TYPE_TIMESTAMP2",
    18: "FIELD_TYPE_DATETIME2",
    19: "FIELD_TYPE_TIME2",
    246: "FIELD_TYPE_NEWDECIMAL",
    247: "FIELD_TYPE_ENUM",
    248: "FIELD_TYPE_SET",
    249: "FIELD_TYPE_TINY_BLOB",
    250: "FIELD_TYPE_MEDIUM_BLOB",
    251: "FIELD_TYPE_LONG_BLOB",
    252: "FIELD_TYPE_BLOB",
    253: "FIELD_TYPE_VAR_STRING",
    254: "FIELD_TYPE_STRING",
    255: "FIELD_TYPE_GEOMETRY",
}
# Field types with no decoder: old DECIMAL, GEOMETRY, JSON and any code not listed above.
UNSUPPORTED_FIELD_CODES = (0, 255, 245)

HEADER_LEN = 19
CHECKSUM_LEN = 4
POS_SHIFT = 4294967296  # 2^32: pos_key = file_no * 2^32 + log_pos (log_pos is u32)

# Image of the derived change feed: one struct per table row.
IMAGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

ENVELOPE = T.StructType([
    T.StructField("log_file", T.StringType()),
    T.StructField("file_no", T.IntegerType()),
    T.StructField("log_pos", T.LongType()),
    T.StructField("row_no", T.IntegerType()),
    T.StructField("pos_key", T.LongType()),
    T.StructField("db", T.StringType()),
    T.StructField("tbl", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("primary", T.StringType()),
    T.StructField("primary_keys", T.ArrayType(T.StringType())),
    T.StructField("before", IMAGE),
    T.StructField("after", IMAGE),
    T.StructField("ts", T.TimestampType()),
])

# The published JSON message: binlog, db, table, query, event_type, primary,
# before, after, timestamp (unsigned seconds).
JSON_ENVELOPE = T.StructType([
    T.StructField("binlog", T.StringType()),
    T.StructField("db", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("primary", T.StringType()),
    T.StructField("before", IMAGE),
    T.StructField("after", IMAGE),
    T.StructField("timestamp", T.LongType()),
    # Optional: column-present mask of a partial (MINIMAL) after-image; absent = full image.
    T.StructField("after_present", T.LongType()),
    # Optional: number of the image (or image pair) within its event; absent = 0, its only one.
    T.StructField("row_no", T.IntegerType()),
])

SCHEMA_HISTORY = T.StructType([
    T.StructField("db", T.StringType()),
    T.StructField("tbl", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("column_key", T.StringType()),
    T.StructField("column_type", T.StringType()),
    T.StructField("charset", T.StringType()),
    T.StructField("collation", T.StringType()),
    T.StructField("numeric_scale", T.StringType()),
    T.StructField("extra", T.StringType()),
    T.StructField("valid_from", T.LongType()),
    T.StructField("valid_to", T.LongType()),
])

POSITION = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("log_file", T.StringType()),
    T.StructField("pos", T.LongType()),
])
