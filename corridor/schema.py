"""Declared schemas. Untrusted input is always read with one of these."""

from pyspark.sql import types as T

# Names and types of the wire format and of the stored tables.
BLOCK_AHEAD = T.StructType(
    [
        T.StructField("block_id", T.StringType()),
        T.StructField("occupying_train", T.StringType()),
        T.StructField("estimated_clearance_sec", T.FloatType()),
    ]
)

TRAIN_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("timestamp_utc", T.StringType()),
        T.StructField("train_id", T.StringType()),
        T.StructField("block_id", T.StringType()),
        T.StructField("block_idx", T.IntegerType()),
        T.StructField("subdivision", T.StringType()),
        T.StructField("current_speed_mph", T.FloatType()),
        T.StructField("max_authorized_speed_mph", T.FloatType()),
        T.StructField("gross_tonnage", T.IntegerType()),
        T.StructField("signal_aspect_ahead", T.StringType()),
        T.StructField("blocks_ahead_occupied", T.ArrayType(BLOCK_AHEAD)),
        T.StructField("schedule_adherence_sec", T.FloatType()),
        T.StructField("track_grade_pct", T.FloatType()),
    ]
)

SILVER_EVENT = T.StructType(TRAIN_EVENT.fields + [T.StructField("event_time", T.TimestampType())])

OCCUPANCY = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("train_id", T.StringType()),
        T.StructField("block_id", T.StringType()),
        T.StructField("block_idx", T.IntegerType()),
        T.StructField("signal_aspect", T.StringType()),
        T.StructField("speed_mph", T.FloatType()),
        T.StructField("schedule_adherence_sec", T.FloatType()),
        T.StructField("track_grade_pct", T.FloatType()),
    ]
)

GOLD = T.StructType(
    OCCUPANCY.fields
    + [
        T.StructField("shockwave_delay_sec", T.DoubleType()),
        T.StructField("advisory_speed_mph", T.DoubleType()),
        T.StructField("delay_severity", T.StringType()),
    ]
)

# Row shape of Spark's Kafka source.
LOG_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
