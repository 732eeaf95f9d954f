"""Declared schemas (no inference passes over the data)."""

from pyspark.sql.types import (DoubleType, FloatType, StringType, StructField, StructType)

# Raw review records as the JSON-lines source carries them.
REVIEWS_RAW = StructType([
    StructField("overall", FloatType(), True),
    StructField("vote", StringType(), True),
    StructField("reviewTime", StringType(), True),
    StructField("reviewerID", StringType(), True),
    StructField("asin", StringType(), True),
    StructField("reviewerName", StringType(), True),
    StructField("reviewText", StringType(), True),
    StructField("summary", StringType(), True),
])

# Cleaned reviews as re-read by the downstream jobs.
REVIEWS_CLEAN = StructType(REVIEWS_RAW.fields + [StructField("label", DoubleType(), True)])

META = StructType([
    StructField("asin", StringType(), True),
    StructField("main_cat", StringType(), True),
])
