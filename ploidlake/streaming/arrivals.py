"""Arrivals as a stream: rows per load day, kept while files come in. An addition; the batch operators don't need it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ploidlake.runtime import shared_folder


def loads_per_day(spark: SparkSession, path: str, time: str = "loaded_at", max_files: int = 64) -> DataFrame:
    """``(load_day, stored_rows)`` after all files at ``path`` that are there now. State is one count per day."""
    import uuid

    schema = spark.read.parquet(path).schema
    arrivals = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)
    counts = arrivals.groupBy(F.col(time).cast("date").alias("load_day")).agg(F.count(F.lit(1)).alias("stored_rows"))
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/{number}")

    query = counts.writeStream.outputMode("complete").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    last = (query.lastProgress or {}).get("batchId", 0)
    return spark.read.schema(counts.schema).parquet(f"{root}/{last}")
