"""Column layouts shared by batch and streaming jobs."""

from pyspark.sql import types as T

SOURCES = ("auth", "access", "firewall", "syslog", "fim")
SEVERITIES = ("INFO", "WARNING", "CRITICAL")

LINES = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("source", T.StringType()),
        T.StructField("line", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("ts", T.TimestampNTZType(), False),
        T.StructField("ts_inferred", T.BooleanType()),
        T.StructField("source", T.StringType()),
        T.StructField("raw", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("rule_triggered", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("direction", T.StringType()),
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
    ]
)

RULES_FILE = T.StructType(
    [
        T.StructField(
            "rules",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("rule_id", T.IntegerType()),
                        T.StructField("name", T.StringType()),
                        T.StructField("description", T.StringType()),
                        T.StructField("severity", T.StringType()),
                        T.StructField("mitre_id", T.StringType()),
                        T.StructField("mitre_tactic", T.StringType()),
                        T.StructField(
                            "conditions",
                            T.StructType(
                                [
                                    T.StructField("source", T.StringType()),
                                    T.StructField("action", T.StringType()),
                                    T.StructField("status", T.StringType()),
                                    T.StructField("user", T.StringType()),
                                    T.StructField("direction", T.StringType()),
                                    T.StructField("path_match", T.ArrayType(T.StringType())),
                                    T.StructField(
                                        "time_range",
                                        T.StructType(
                                            [
                                                T.StructField("start_hour", T.IntegerType()),
                                                T.StructField("end_hour", T.IntegerType()),
                                            ]
                                        ),
                                    ),
                                    T.StructField(
                                        "rate",
                                        T.StructType(
                                            [
                                                T.StructField("threshold", T.IntegerType()),
                                                T.StructField("window_seconds", T.IntegerType()),
                                            ]
                                        ),
                                    ),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)

METRIC_SAMPLES = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("metric", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)
