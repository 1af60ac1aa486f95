"""J12: streaming enrichment of vehicle telemetry (Structured Streaming).

source (Kafka or files) -> decode -> clean -> acceleration against each
vehicle's last fix -> harshness -> nearest POI -> parquet + POI messages.

The stream runs the batch operators on each micro-batch (``foreachBatch``)
together with one stored row per vehicle, its last fix. That row takes part in
the acceleration like any fix of the micro-batch, so the neighbour operator's
(vehicle, hour) buckets also spread a hot vehicle of a stream over tasks. The
stored fix never expires: a vehicle that returns after hours continues where
the batch job would.

Every input row reaches exactly one output: ``enriched``, ``rejects`` (cannot
be decoded or cleaned, with a reason) or ``late`` (behind the vehicle's last
fix of an earlier micro-batch, or delivered twice); ``counts`` has a row per
micro-batch. All outputs and the stored fixes of micro-batch ``n`` live in
folders ``epoch=n`` written by overwrite, from the stored fixes of the epoch
before it, so a micro-batch that runs again replaces its own results.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators import tracking as tk
from kestrel.session import ensure_checkpoint_dir, hadoop_path, materialize, remove_path, scratch

# Message layouts of the telemetry and POI topics.
TELEMETRY_SCHEMA = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("fuel_level", T.DoubleType()),
])
POI_MESSAGE_SCHEMA = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("dt", T.TimestampType()),
    T.StructField("poi", T.StringType()),
])
OUTPUTS = ("enriched", "pois", "rejects", "late", "counts")
FIX = ("dt", "speed", "lat", "lng")


# ------------------------------------------------------------------ sources
def read_kafka(spark: SparkSession, servers: str, topic: str,
               starting_offsets: str = "latest", **options) -> DataFrame:
    """Kafka subscription (needs the spark-sql-kafka connector on the classpath)."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def read_file_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream with the schema taken from the files already there.

    A path naming one file is turned into a glob matching just that file
    (the file source otherwise requires a directory).
    """
    schema = spark.read.format(fmt).load(path).schema
    fs, p = hadoop_path(spark, path)
    if not any(ch in path for ch in "*?[") and fs.getFileStatus(p).isFile():
        head, tail = os.path.split(path)
        path = os.path.join(head, f"[{tail[0]}]{tail[1:]}")
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


# ----------------------------------------------------------------- messages
def decode_telemetry(messages: DataFrame) -> DataFrame:
    """JSON ``value`` -> ``raw_value``, the GPS columns as text, and ``undecodable``."""
    text = F.col("value").cast("string")
    decoded = messages.select(text.alias("raw_value"), F.from_json(text, TELEMETRY_SCHEMA).alias("m"))
    given = {"vin": F.col("m.vin"), "dt": F.col("m.timestamp").cast("timestamp_ntz"),
             "lat": F.col("m.latitude"), "lng": F.col("m.longitude"), "speed": F.col("m.speed")}
    bad = F.col("m").isNull() | F.col("m.vin").isNull() | F.col("m.timestamp").isNull()
    return decoded.select("raw_value",
                          *[given.get(c, F.lit(None)).cast("string").alias(c) for c in tk.GPS_COLUMNS],
                          F.col("m.fuel_level").alias("fuel_level"), bad.alias("undecodable"))


def clean_reports(batch: DataFrame) -> DataFrame:
    """Cleaned rows (see ``tracking.clean``) of raw GPS reports."""
    return tk.clean(tk.normalize(batch))


def clean_messages(batch: DataFrame) -> DataFrame:
    """Cleaned rows of JSON messages; one that cannot be decoded keeps its text as the raw vin column."""
    rows = tk.clean(tk.normalize(decode_telemetry(batch)), speed_type="double", keep=("raw_value", "undecodable"))
    return (rows.withColumn("reject_reason", F.when(F.col("undecodable"), F.lit("undecodable"))
                            .otherwise(F.col("reject_reason"))).drop("undecodable"))


def poi_messages(enriched: DataFrame) -> DataFrame:
    """(key, value) rows for the resolved-POI topic: JSON of (vin, dt, poi)."""
    return enriched.filter(F.col("poi").isNotNull()).select(
        F.col("vin").alias("key"), F.to_json(F.struct("vin", "dt", "poi"), {
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"))


def decode_poi_messages(messages: DataFrame) -> DataFrame:
    """The POI topic read back: vin, dt, poi (NULLs where a message cannot be decoded)."""
    decoded = F.from_json(F.col("value").cast("string"), POI_MESSAGE_SCHEMA)
    return messages.select(decoded.alias("m")).select(
        "m.vin", F.col("m.dt").cast("timestamp_ntz").alias("dt"), "m.poi")


# -------------------------------------------------------------- micro-batch
def _last_fixes(spark: SparkSession, base: str, epoch: int) -> DataFrame | None:
    """The stored fixes of the latest epoch before ``epoch``."""
    fs, p = hadoop_path(spark, f"{base}/state")
    if not fs.exists(p):
        return None
    done = [int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(p)
            if s.getPath().getName().startswith("epoch=")]
    before = [n for n in done if n < epoch]
    for old in sorted(before)[:-2]:  # a replay needs the one before, never older ones
        remove_path(spark, f"{base}/state/epoch={old}")
    return spark.read.parquet(f"{base}/state/epoch={max(before)}") if before else None


def _sorted_out(good: DataFrame, last: DataFrame | None, drop_repeats: bool) -> DataFrame:
    """``good`` with ``late_reason``: NULL, ``late`` or ``duplicate``."""
    reason = F.lit(None).cast("string")
    rows = good
    if last is not None:
        rows = rows.join(last.select(F.col("vin").alias("_v"), F.struct(*FIX).alias("_last")),
                         F.col("vin") == F.col("_v"), "left").drop("_v")
        mine = F.struct(*FIX)
        reason = F.when(mine < F.col("_last"), F.lit("late"))
        if drop_repeats:
            reason = reason.when(mine == F.col("_last"), F.lit("duplicate"))
    if drop_repeats:
        same = Window.partitionBy(*tk.GPS_COLUMNS).orderBy(F.lit(1))
        rows = rows.withColumn("_n", F.row_number().over(same))
        reason = F.coalesce(reason, F.when(F.col("_n") > 1, F.lit("duplicate")))
    return rows.withColumn("late_reason", reason).drop("_last", "_n")


def process_batch(batch: DataFrame, epoch: int, base: str, pois: DataFrame,
                  clean: Callable[[DataFrame], DataFrame] = clean_reports,
                  speed_factor: float = tk.MPH_TO_MS, drop_repeats: bool = False,
                  kafka: dict | None = None, outputs: tuple[str, ...] = OUTPUTS) -> None:
    """Write all outputs of one micro-batch under ``base`` (see the module's text)."""
    spark = batch.sparkSession

    def write(df: DataFrame, name: str) -> int:
        path = f"{base}/{name}/epoch={epoch}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path).count()

    with scratch(spark):
        cleaned = materialize(clean(batch), "stream-cleaned")
        counts = {"n_input": cleaned.count(), "n_rejects": 0, "n_late": 0, "n_enriched": 0}
        if "rejects" in outputs:
            raw = [c for c in ("raw_value",) if c in cleaned.columns]
            counts["n_rejects"] = write(tk.rejected_rows(cleaned, raw), "rejects")
        if "enriched" in outputs:
            last = _last_fixes(spark, base, epoch)
            good = materialize(_sorted_out(tk.good_rows(cleaned), last, drop_repeats), "stream-good")
            counts["n_late"] = write(good.filter("late_reason IS NOT NULL"), "late")
            fixes = good.filter("late_reason IS NULL").drop("late_reason")
            both = fixes.withColumn("_stored", F.lit(False))
            if last is not None:
                both = both.unionByName(last.withColumn("_stored", F.lit(True)), allowMissingColumns=True)
            moving = tk.driving_harshness(tk.compute_acceleration(both, speed_factor))
            enriched = tk.resolve_pois(moving.filter("NOT _stored"), pois).select(*tk.ENRICHED_COLUMNS)
            counts["n_enriched"] = write(enriched, "enriched")
            stored = spark.read.schema(enriched.schema).parquet(f"{base}/enriched/epoch={epoch}")
            messages = poi_messages(stored)
            if kafka:
                messages.write.format("kafka").options(**kafka).save()
            else:
                write(messages, "pois")
            newest = both.groupBy("vin").agg(F.max(F.struct(*FIX)).alias("f")).select("vin", "f.*")
            write(newest, "state")
        row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))
        write(row, "counts")


def start(stream: DataFrame, pois: DataFrame, base: str, checkpoint: str,
          available_now: bool = False, **options):
    """Start the enrichment of a stream of raw reports (or messages, ``clean=clean_messages``)."""
    def each(batch: DataFrame, epoch: int) -> None:
        process_batch(batch, epoch, base, pois, **options)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def run_available_now(spark: SparkSession, stream: DataFrame, pois: DataFrame,
                      base: str | None = None, **options) -> dict:
    """Run the enrichment over everything the source holds now; return output paths.

    Output and checkpoint live under the session's checkpoint folder (shared
    storage on a cluster), in a fresh sub-folder per run.
    """
    base = base or os.path.join(ensure_checkpoint_dir(spark), f"telemetry-{uuid.uuid4().hex}")
    start(stream, pois, base, f"{base}/checkpoint", True, **options).awaitTermination()
    return {k: f"{base}/{k}" for k in (*OUTPUTS, "state")}
