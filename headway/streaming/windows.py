"""The window job as an incremental stream, its enrichment and its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions.clock import with_time_parts
from headway.operators.enrich import join_holidays, join_weather
from headway.operators.windows import ping_sums, usable_pings, window_columns
from headway.sources.tables import TableSpec, TableStore

LATENESS = "10 minutes"


def read_stream(spark: SparkSession, path: str, schema: str, file_glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.parquet(path)


def stream_windows(pings: DataFrame, width: str = "1 minute", lateness: str = LATENESS) -> DataFrame:
    """Trip windows of a ping stream, each emitted once when the watermark passes its end.

    A ping casts two ballots, one for its vehicle, which carries its measures, and one for its occupancy. Ballots
    are summed by choice, tasks pre-sum their own; once a window closes its choices meet. No state holds more
    than one choice or one window, however many vehicles a placeholder trip has.
    """
    kinds = ("vehicle_id", "occupancy_status")
    late = usable_pings(pings).withWatermark("timestamp", lateness)
    cast = late.withColumn("ballot", F.explode(F.array(*map(F.lit, kinds))))
    cast = cast.withColumns({c: F.when(F.col("ballot") == c, F.col(c)) for c in kinds})
    cast = cast.withColumns({c: F.when(F.col("ballot") == kinds[0], F.col(c)) for c in ("speed", "position_lat", "position_lon", "bearing")})
    choices = cast.groupBy("trip_id", F.window("timestamp", width).alias("_w"), "ballot", *kinds).agg(F.count("*").alias("_votes"), F.min("speed").alias("min_speed"), *ping_sums())

    # squares between the choices: a window of one speed has none, whatever the digits of its sums say
    choices = choices.withColumns({f"{c}_votes": F.col("_votes") for c in kinds})
    total, n = F.sum("speed_sum"), F.nullif(F.sum("speed_n"), F.lit(0))
    between = F.sum(F.col("speed_sum") * F.col("speed_sum") / F.nullif(F.col("speed_n"), F.lit(0))) - total * total / n
    squares = F.when(F.min("min_speed") < F.max("max_speed"), F.sum("speed_squares") + F.greatest(between, F.lit(0.0))).otherwise(0.0)
    grouped = choices.groupBy("trip_id", F.window("_w", width).alias("_w")).agg(*window_columns(squares))
    flat = grouped.withColumn("window_start", F.col("_w.start")).drop("_w")
    return with_time_parts(flat, "window_start")


def stream_enrich(windows: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Stream windows with static weather and holidays."""
    return join_holidays(join_weather(windows, weather), holidays)


def drain_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything that is there, then stop; append files exactly once."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def start_upserts(stream: DataFrame, store: TableStore, spec: TableSpec, checkpoint: str) -> StreamingQuery:
    """Feed each micro-batch to the keyed upsert; a replayed batch changes nothing."""

    def merge(batch: DataFrame, _batch_id: int) -> None:
        if not batch.isEmpty():
            store.upsert(spec, batch)

    return (
        stream.writeStream.outputMode("append").foreachBatch(merge)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
