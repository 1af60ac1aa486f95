"""What a vehicle did over time: trips, odometer, moving averages, its driver at each fix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.ranking import with_rank
from kestrel.operators.running import last_before, range_frame, running
from kestrel.operators.sequence import with_previous

ORDER = ("dt", "speed", "lat", "lng")
TRIP_GAP = "6 hours"


def _bucket(seconds: int):
    return F.floor(F.unix_timestamp("dt") / seconds)


def trips(fixes: DataFrame, gap_seconds: int = 6 * 3600, bucket_seconds: int = 86400) -> DataFrame:
    """Maximal runs of fixes of a vehicle with at most ``gap_seconds`` between neighbours.

    One row per trip: vin, trip_start, trip_end (times of its first and last
    fix), fixes, distance. A fix that begins a trip is known from the fix before
    it; the begin is carried along the vehicle's fixes; trips are then partial
    sums. Equals session windows, without one task per vehicle.
    """
    x = with_previous(fixes.select("vin", *ORDER, "distance"), ["vin"], list(ORDER), ["dt"], _bucket(bucket_seconds))
    apart = F.unix_micros(F.col("dt").cast("timestamp")) - F.unix_micros(F.col("prev_dt").cast("timestamp"))
    begins = F.col("prev_dt").isNull() | (apart > gap_seconds * 1_000_000)
    carried = running(x, ["vin"], list(ORDER), _bucket(bucket_seconds),
                      lasts={"trip_start": F.when(begins, F.col("dt"))})
    return (carried.groupBy("vin", "trip_start")
            .agg(F.max("dt").alias("trip_end"), F.count(F.lit(1)).alias("fixes"), F.sum("distance").alias("distance"))
            .select("vin", "trip_start", "trip_end", "fixes", "distance"))


def session_trips(fixes: DataFrame, gap: str = TRIP_GAP) -> DataFrame:
    """The same trips by session windows; for streams (``dt`` a timestamp with a watermark)."""
    return (fixes.groupBy("vin", F.session_window("dt", gap).alias("w"))
            .agg(F.max("dt").alias("trip_end"), F.count(F.lit(1)).alias("fixes"), F.sum("distance").alias("distance"))
            .select("vin", F.col("w.start").alias("trip_start"), "trip_end", "fixes", "distance"))


def odometer(fixes: DataFrame, bucket_seconds: int = 86400) -> DataFrame:
    """``fixes`` with the number of the fix and the distance driven so far, per vehicle."""
    return running(fixes, ["vin"], [*ORDER, "distance"], _bucket(bucket_seconds),
                   sums={"fix_number": F.lit(1), "odometer": F.col("distance")})


def moving_speed(fixes: DataFrame, width_seconds: int, bucket_seconds: int = 86400) -> DataFrame:
    """``fixes`` with mean and greatest speed and the number of fixes of the last ``width_seconds``."""
    return range_frame(fixes, ["vin"], "dt", width_seconds,
                       {"mean_speed": F.avg("speed"), "max_speed": F.max("speed"),
                        "fixes_in_frame": F.count(F.lit(1))}, bucket_seconds)


def driver_at_fix(fixes: DataFrame, assignments: DataFrame) -> DataFrame:
    """``fixes`` with the driver assigned to the vehicle at that time (NULL before the first one).

    ``assignments``: vehicle, driverId, valid_from.
    """
    since = assignments.select(F.col("vehicle").alias("vin"), "driverId", "valid_from")
    return last_before(fixes, since, ["vin"], "dt", "valid_from", ["driverId"])


def speed_rank(fixes: DataFrame) -> DataFrame:
    """All fixes numbered from the fastest; ties by vehicle, time and place."""
    order = [F.col("speed").desc_nulls_last(), F.col("vin").asc(), F.col("dt").asc(), F.col("lat").asc(),
             F.col("lng").asc()]
    return with_rank(fixes.select("vin", "dt", "speed", "lat", "lng"), order, "speed_rank")
