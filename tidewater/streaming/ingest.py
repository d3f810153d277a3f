"""Structured Streaming jobs (T1-T3).

Survey/event files arrive in a folder; the jobs read them incrementally
(``readStream`` with an explicit schema), keep state bounded with a
watermark, and write replay-safe output. ``trigger(availableNow=True)``
processes what is there and stops, which is how a scheduled run and the
tests drive them. All paths live under the session's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import scratch_path
from tidewater.sources.tables import append_batch, latest_per_key, read_log

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Wall-clock (NTZ) timestamps with microseconds: the stream does not depend on
# the session time zone, and the JSON round trip keeps every digit.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def utc_instant(ntz) -> F.Column:
    """The instant whose UTC wall clock is the NTZ value, computed without the
    session time zone (watermarks need a TIMESTAMP event time)."""
    c = F.col(ntz) if isinstance(ntz, str) else ntz
    micros = (F.unix_date(c.cast("date")).cast("long") * 86_400_000_000
              + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000
              + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long"))
    return F.timestamp_micros(micros)


def utc_day(instant) -> F.Column:
    """The UTC calendar day of an instant, without the session time zone."""
    c = F.col(instant) if isinstance(instant, str) else instant
    return F.date_from_unix_date(F.floor(F.unix_micros(c) / 86_400_000_000).cast("int"))


def stage_files(events: DataFrame, folder: str, copies: int = 1) -> None:
    """Land the event rows as JSON files, ``copies`` times (a re-sent batch
    repeats every row)."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    for _ in range(copies):
        rows.write.mode("append").option("timestampNTZFormat", TS_FORMAT).json(folder)


def _source(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(EVENT_SCHEMA).option("timestampNTZFormat", TS_FORMAT)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(folder)


def dedup_ingest(spark: SparkSession, folder: str, out: str, watermark: str = "1 day",
                 max_files: int | None = None):
    """T1: event-time dedup on ``event_id`` within the watermark, to parquet.
    Returns the finished query (for its progress: input and dropped rows)."""
    stream = (_source(spark, folder, max_files)
              .withColumn("event_time", utc_instant("ts"))
              .withWatermark("event_time", watermark)
              .dropDuplicatesWithinWatermark(["event_id"])
              .drop("event_time"))
    q = (stream.writeStream.format("parquet").option("path", f"{out}/data")
         .option("checkpointLocation", f"{out}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def upsert_log(spark: SparkSession, folder: str, log: str, max_files: int | None = None):
    """T2: every micro-batch becomes ``batch_id=N`` of the append log
    (overwritten on replay, published in the manifest)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, log, int(batch_id))

    q = (_source(spark, folder, max_files).writeStream.foreachBatch(write)
         .option("checkpointLocation", f"{log}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def daily_rollup(spark: SparkSession, folder: str, log: str, watermark: str = "1 day",
                 max_files: int | None = None):
    """T3: daily tumbling windows per event type in update mode; each batch's
    updated windows go to the append log, the newest version of a window wins.
    Events later than the watermark are dropped (counted in the progress as
    ``numRowsDroppedByWatermark``)."""
    agg = (_source(spark, folder, max_files)
           .withColumn("event_time", utc_instant("ts"))
           .withWatermark("event_time", watermark)
           .groupBy(F.window("event_time", "1 day").alias("w"), "event_type")
           .agg(F.count(F.lit(1)).cast("long").alias("n_events"),
                F.sum(F.col("value").cast("decimal(12,2)")).alias("value_sum")))

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch.select(F.col("w.start").alias("window_start"), "event_type", "n_events",
                                  "value_sum"), log, int(batch_id))

    q = (agg.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", f"{log}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


# -- the three jobs as queries over a table of events ------------------------------------------------

def survey_ingest(spark: SparkSession, events: DataFrame) -> DataFrame:
    root = scratch_path(spark, "stream-ingest")
    stage_files(events, f"{root}/in", copies=2)
    dedup_ingest(spark, f"{root}/in", f"{root}/out")
    return spark.read.parquet(f"{root}/out/data")


def upsert(spark: SparkSession, events: DataFrame) -> DataFrame:
    root = scratch_path(spark, "stream-upsert")
    stage_files(events, f"{root}/in", copies=2)
    upsert_log(spark, f"{root}/in", f"{root}/log")
    latest = latest_per_key(read_log(spark, f"{root}/log"), ["event_id"])
    return latest.select(*EVENT_SCHEMA.fieldNames())


def daily_kpi(spark: SparkSession, events: DataFrame) -> DataFrame:
    root = scratch_path(spark, "stream-daily")
    stage_files(events, f"{root}/in")
    daily_rollup(spark, f"{root}/in", f"{root}/log")
    latest = latest_per_key(read_log(spark, f"{root}/log"), ["window_start", "event_type"])
    return latest.select(utc_day("window_start").alias("day"),
                         "event_type", "n_events",
                         F.col("value_sum").cast("double").alias("value_sum"))
