"""Explicit schemas; nothing is inferred from data."""

from pyspark.sql import types as T

_D = T.DoubleType()

MEASURES = [
    "voltageR", "voltageS", "voltageT", "voltageRS", "voltageST", "voltageTR",
    "currentR", "currentS", "currentT", "activePower",
    "powerFactorR", "powerFactorS", "powerFactorT",
    "reactivePowerLagging", "accumActiveEnergy",
]

READING_EVENT = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("source_timestamp", T.LongType()),
        T.StructField("localtime", T.LongType()),
        T.StructField("module", T.StringType()),
        *[T.StructField(name, _D) for name in MEASURES],
        T.StructField("synthetic_anomaly", T.BooleanType()),
        T.StructField("synthetic_anomaly_type", T.StringType()),
    ]
)

STATUS_CHANGE = T.StructType(
    [
        T.StructField("operation", T.StringType()),
        T.StructField("report_date", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

SEND_LOG = T.StructType(
    [
        T.StructField("report_date", T.DateType()),
        T.StructField("sent_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

ALERT_QUEUE = T.StructType(
    [
        T.StructField("alert_id", T.LongType(), False),
        T.StructField("equipment_id", T.StringType(), False),
        T.StructField("window_end_time", T.TimestampNTZType(), False),
        T.StructField("anomaly_type", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", _D),
        T.StructField("threshold_value", _D),
        T.StructField("anomaly_score", _D),
        T.StructField("rule_score", _D),
        T.StructField("iforest_score", _D),
        T.StructField("final_score", _D),
        T.StructField("duration_minutes", T.IntegerType()),
        T.StructField("detection_window", T.StringType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("notification_status", T.StringType(), False),
        T.StructField("retry_count", T.IntegerType(), False),
        T.StructField("last_error_message", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("notified_at", T.TimestampNTZType()),
    ]
)

THRESHOLDS = T.StructType(
    [
        T.StructField("aggregation_level", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("equipment_id", T.StringType()),
        T.StructField("lower", _D),
        T.StructField("upper", _D),
        T.StructField("iqr", _D),
        T.StructField("direction", T.StringType()),
    ]
)
