"""Review cleaning as a streaming job.

Cleaning, labelling and the category exclusion hold no state, so the same
plan runs on a ``readStream`` source: new JSON-lines files are cleaned as
they arrive and appended to a Parquet sink.  The excluded-category keys
are a static table (stream-static anti join).  The checkpoint belongs to the
sink (by default the folder beside it), so a restarted query resumes where it
stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revlens import schemas
from revlens.plans.cleaning import clean_reviews

RAW_TO_FIXTURE = {"reviewText": "review_text", "reviewerID": "reviewer_id"}


def review_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schemas.REVIEWS_RAW)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.json(path)
    return df.select(*[F.col(c).alias(RAW_TO_FIXTURE.get(c, c)) for c in df.columns])


def start_cleaning(spark: SparkSession, source: str, sink: str, meta: DataFrame | None = None,
                   emoji: dict[str, str] | None = None, checkpoint: str | None = None,
                   available_now: bool = True) -> StreamingQuery:
    """Clean every review file under ``source`` into Parquet at ``sink``."""
    cleaned = clean_reviews(review_stream(spark, source), meta, emoji=emoji)
    w = (cleaned.writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint or sink.rstrip("/") + ".checkpoint")
                .option("path", sink))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
