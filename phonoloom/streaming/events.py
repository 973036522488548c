"""Event-time windows and stateful operators, for streams and for tables alike."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from phonoloom.plans.cluster import own_dir

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_stream(spark: SparkSession, root: str, name: str = "events", schema: str = EVENTS, files_at_once: int = 64, at: str = "ts") -> DataFrame:
    """A table of the folder as a stream of its files; event times become instants, which watermarks need."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once)
    path = f"{root}/{name}.parquet"
    rows = reader.parquet(path) if os.path.isdir(path.removeprefix("file://")) else reader.option("pathGlobFilter", f"{name}.parquet").parquet(root)
    return rows.withColumn(at, F.col(at).cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) of windows side by side; rows later than the watermark are left out of a stream."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "2 hours", every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n) of overlapping windows."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", width, every).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(user_id, start, end, n): runs of a user's events no further apart than ``gap``; end is the last event."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.max("ts").alias("end")).select("user_id", F.col("w.start").alias("start"), "end", "n")


def once(events: DataFrame, keys: list[str], within: str = "1 day") -> DataFrame:
    """Each key once; in a stream, among rows that come within ``within`` of each other, so that state stays bounded."""
    return events.withWatermark("ts", within).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def run_to_table(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there and gives its result as a table. Offsets, state and output stand in the
    shared folder, so that a restarted run goes on where it was. In append mode windows that the watermark has not passed
    at the end don't come out; ``tumbling_of_stream`` has them all."""
    spark = stream.sparkSession
    base = own_dir(spark, "stream")
    query = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def count_into(stream: DataFrame, by: str, path: str) -> None:
    """A running count per value, micro-batch by micro-batch: each batch's counts are added up as a new file named by
    the batch, so that a batch that is run again replaces its own."""

    def add(batch: DataFrame, number: int) -> None:
        batch.groupBy(by).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/counts/batch={number}")

    query = stream.writeStream.foreachBatch(add).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def funnel_of_stream(spark: SparkSession, root: str) -> DataFrame:
    """(event_type, n) of the events, counted incrementally."""
    path = own_dir(spark, "stream")
    count_into(read_stream(spark, root), "event_type", path)
    return spark.read.parquet(f"{path}/counts").groupBy("event_type").agg(F.sum("n").alias("n"))


def tumbling_of_stream(spark: SparkSession, root: str, width: str = "1 hour", files_at_once: int = 64) -> DataFrame:
    """What ``tumbling`` gives of the table, counted incrementally: each micro-batch's windows are written as a new file
    and added up, so that none waits for a watermark and no row is too late."""
    path = own_dir(spark, "stream")

    def add(batch: DataFrame, number: int) -> None:
        parts = batch.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        parts.select(F.col("w.start").alias("start"), "event_type", "n", "total").write.mode("overwrite").parquet(f"{path}/counts/batch={number}")

    stream = read_stream(spark, root, files_at_once=files_at_once)
    add(spark.createDataFrame([], stream.schema), -1)  # a table without rows has no batch
    query = stream.writeStream.foreachBatch(add).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{path}/counts").groupBy("start", "event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


def keep_by_key(stream: DataFrame, key: str, order: list[str], path: str) -> DataFrame:
    """The first row of each key in the given order, from a stream whose batches may come again: a batch writes its own
    first rows under its number, and one that is redelivered replaces them. Null keys are left out."""
    spark = stream.sparkSession
    rest = [c for c in stream.columns if c != key and c not in order]

    def first(rows: DataFrame) -> DataFrame:
        best = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_r"))
        return best.select(key, *[F.col(f"_r.{c}").alias(c) for c in [*order, *rest]])

    def put(batch: DataFrame, number: int) -> None:
        first(batch).write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    put(spark.createDataFrame([], stream.schema), -1)
    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return first(spark.read.parquet(f"{path}/rows").drop("batch"))
