"""The row-wise operators on a stream of landed reviews.

They hold no state, so they run on ``readStream`` as they are. Only first-arrival dedup keeps
state: the keys seen, in the checkpointed state store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tastelens.operators import prepare, sentiment
from tastelens.operators.dedup import id_or_link
from tastelens.sources.lexicons import Lexicons


def read_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
    files_per_trigger: int = 1000,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_trigger).load(path)


def first_arrivals(
    reviews: DataFrame, event_time: str | None = None, delay: str = "7 days"
) -> DataFrame:
    """Each review id (or link, without an id) once, whatever pages repeat it.

    With ``event_time``, a timestamp column, keys are forgotten once they are older than ``delay``
    behind the latest arrival, and repeats are caught within that time; without it, every key is
    kept for good.
    """
    key = id_or_link(F.col("review_id"), F.col("review_link"))
    keyed = reviews.withColumn("_key", key).filter(F.col("_key").isNotNull())
    if event_time is None:
        return keyed.dropDuplicates(["_key"]).drop("_key")
    marked = keyed.withWatermark(event_time, delay)
    return marked.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def enrich(reviews: DataFrame, lexicons: Lexicons, valence: bool = True) -> DataFrame:
    """Cleaning, flags, labels and text features of arriving reviews."""
    featured = prepare.review_features(reviews)
    return sentiment.with_text_features(featured, lexicons, "combined_text", valence)


def write_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = True
) -> StreamingQuery:
    """Append to files; the checkpoint makes each input file count exactly once."""
    writer = df.writeStream.format(fmt).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
