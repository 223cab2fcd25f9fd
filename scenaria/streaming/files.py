"""Scenario CSV folder as a file stream (S1 in streaming form)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scenaria.sources import io


def scenario_stream(spark: SparkSession, folder: str, sample_file_glob: str | None = None, time: str = "Time",
                    key: str = "scenario_id", max_files_per_trigger: int | None = None) -> DataFrame:
    """New ``*.csv`` files of ``folder`` as a stream, typed by the header rule of an existing file."""
    names = io.header_of(spark, sample_file_glob or f"{folder}/*.csv")
    schema = io.schema_from_header(names, time)
    r = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(f"{folder}/*.csv")
    return df.select(*names, io.scenario_key().alias(key))


def append_to_snapshot(stream: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Append the stream to a Parquet snapshot through Spark's file sink, whose commit log makes each
    micro-batch count exactly once, a repeated one too."""
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
