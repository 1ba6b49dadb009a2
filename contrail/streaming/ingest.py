"""Incremental enrichment and the streaming station-hour rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail.operators.weather import enrich_with_fallback, measures_in, rollup_exprs


def stream_table(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, each file once."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_enrich(flights: DataFrame, hourly: DataFrame, by_region: DataFrame, **names) -> DataFrame:
    """Streaming flights joined to static weather tables; unmatched flights stay, as in the batch job."""
    return enrich_with_fallback(flights, hourly, by_region, **names)


def stream_hourly_weather(obs: DataFrame, delay: str = "2 hours", station: str = "airport_code") -> DataFrame:
    """Station-hour rollup of an observation stream.

    An hour is emitted once the watermark has passed its end; observations later than ``delay`` are dropped.
    State holds one row per open station-hour.
    """
    timed = obs.withColumn("valid", F.col("valid").cast("timestamp")).where(
        F.col("valid").isNotNull() & F.col(station).isNotNull()
    )
    hours = timed.withWatermark("valid", delay).groupBy(F.window("valid", "1 hour"), station)
    return hours.agg(*rollup_exprs(measures_in(obs))).select(
        F.col(station).alias("airport_code"),
        F.to_date("window.start").alias("w_date"),
        F.hour("window.start").alias("w_hour"),
        *measures_in(obs),
    )


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, append to parquet and stop; a rerun continues from the checkpoint."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def write_in_order(df: DataFrame, path: str, by: str, files: int) -> None:
    """Append ``df`` to a folder as ``files`` files that a file stream reads in the order of ``by``.

    The rows are dealt out by ranges of ``by``, and the files' modification times, by which the stream orders them, follow the ranges. Files of
    earlier calls come first.
    """
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def parts() -> dict[str, int]:
        if not system.exists(folder):
            return {}
        return {f.getPath().toString(): f.getModificationTime() for f in system.listStatus(folder) if f.getPath().getName().startswith("part-")}

    before = parts()
    df.repartitionByRange(files, by).write.mode("append").parquet(path)
    start = max([0, *before.values()]) + 1000
    for i, name in enumerate(sorted(set(parts()) - set(before))):  # part numbers follow the ranges
        system.setTimes(spark._jvm.org.apache.hadoop.fs.Path(name), start + 1000 * i, -1)
