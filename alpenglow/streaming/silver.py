"""The weather table as a stream: raw files are picked up as they land, flattened and upserted per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from alpenglow.operators.flatten import transform_silver
from alpenglow.operators.tables import read_watermark, upsert, write_watermark
from alpenglow.plans.medallion import Tables, weather_keys
from alpenglow.schemas import FETCHED, route_key


def stream_silver(
    spark: SparkSession,
    raw_path: str,
    raw_schema: T.StructType,
    tables: Tables,
    checkpoint: str,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Process every raw file not yet recorded in the checkpoint, then stop.

    The file source keeps the progress, so re-fetched older slices are taken in as well. A batch that is repeated
    after a crash upserts the same keys with the same values. Every row keeps the fetch it stems from, and only a newer
    fetch replaces it, so the table does not depend on how files fall into batches or in which order they arrive.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        weather = transform_silver(batch, keep_fetch=True)
        result = upsert(weather, tables.weather, weather_keys(weather), newer_by=FETCHED, progress_by=route_key(weather))
        if result.max_date is not None:
            done = read_watermark(session, tables.watermark, "silver")
            write_watermark(session, tables.watermark, "silver", max(done, result.max_date))
        # A micro-batch runs in a session of its own; the caller's may hold the file list from before.
        for table in (tables.weather, tables.watermark):
            if spark.catalog.tableExists(table):
                spark.catalog.refreshTable(table)

    reader = spark.readStream.schema(raw_schema)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return (
        reader.parquet(raw_path)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
