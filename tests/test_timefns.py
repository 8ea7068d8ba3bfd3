from datetime import datetime

from pyspark.sql import functions as F

from tideline.functions.timefns import bucket_end, bucket_end_value, truncate


def test_bucket_end_value_calendar_rollover():
    assert bucket_end_value(datetime(2024, 12, 1), "month") == datetime(2025, 1, 1)
    assert bucket_end_value(datetime(2024, 11, 1), "quarter") == datetime(2025, 2, 1)
    assert bucket_end_value(datetime(2024, 1, 1), "year") == datetime(2025, 1, 1)
    assert bucket_end_value(datetime(2024, 1, 31), "day") == datetime(2024, 2, 1)
    assert bucket_end_value(datetime(2024, 1, 1, 0, 15), "fifteen_minute") == datetime(2024, 1, 1, 0, 30)


def test_truncate_and_bucket_end_in_spark(spark):
    df = spark.createDataFrame([("2024-01-17 13:47:05",)], "s string").select(F.col("s").cast("timestamp").alias("t"))
    row = df.select(
        truncate(F.col("t"), "week").cast("timestamp_ntz").alias("week"),
        truncate(F.col("t"), "month").cast("timestamp_ntz").alias("month"),
        truncate(F.col("t"), "fifteen_minute").cast("timestamp_ntz").alias("q"),
        bucket_end(truncate(F.col("t"), "month"), "month").cast("timestamp_ntz").alias("month_end"),
        bucket_end(truncate(F.col("t"), "six_hour"), "six_hour").cast("timestamp_ntz").alias("six_end"),
    ).first()
    assert row["week"] == datetime(2024, 1, 15)  # Monday
    assert row["month"] == datetime(2024, 1, 1)
    assert row["q"] == datetime(2024, 1, 17, 13, 45)
    assert row["month_end"] == datetime(2024, 2, 1)
    assert row["six_end"] == datetime(2024, 1, 17, 18, 0)
