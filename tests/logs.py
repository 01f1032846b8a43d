"""Small in-line logs used by several tests."""

APP = "application_1512345678901_0007"
FILE_1 = f"file:/logs/{APP}/container_1512345678901_0007_01_000001.log"
FILE_2 = f"file:/logs/{APP}/container_1512345678901_0007_01_000002.log"

# line, level, time at line start
PARSED = [
    ("17/03/29 10:04:41 INFO Alpha: started", "INFO", "2017-03-29 10:04:41"),
    ('17/03/29 10:05:41 ERROR Beta: INFORMATION "q"', "ERROR", "2017-03-29 10:05:41"),
    ("  17/03/29 10:04:50 WARN x.Y: had ERROR inside", "WARN", None),
    ("continuation line", None, None),
    ("INFORMATIVE", "INFO", None),
    ("info lower", None, None),
    ("17/13/40 10:00:00 DEBUG z: bad date", "DEBUG", None),
    ("", None, None),
]


def log_frame(spark, rows):
    """``(value, file_path)`` pairs as a log table."""
    return spark.createDataFrame(rows, "value string, file_path string")


def sample_log(spark):
    return log_frame(spark, [(line, FILE_1) for line, _, _ in PARSED])


def rows(df):
    return [tuple(r) for r in df.collect()]
