"""Domain C: vehicle GPS tracking.

Stages are plain ``DataFrame -> DataFrame`` functions chained with
``DataFrame.transform``; none of them runs an action except
``resolve_pois``, which reads one scalar (the largest POI radius) to size its
grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.geo import distance_3d_m, grid_cell
from kestrel.functions.timefn import slot_start
from kestrel.operators.joins import has_at_most
from kestrel.operators.sequence import with_previous
from kestrel.session import materialize

GPS_COLUMNS = ("vin", "dt", "lat", "lng", "altitude", "speed", "motion", "power",
               "distance", "engineHours")
DECIMAL_COMMA_COLUMNS = ("lat", "lng", "altitude", "power", "distance")
# Fixed values of the reference: mph -> m/s factor, harshness limits (m/s2),
# fuel litres per metre.
MPH_TO_MS = 0.44704
ACCELERATION_LIMIT = 4.0
BRAKING_LIMIT = 6.0
LITRES_PER_METRE = 0.00039
ENRICHED_COLUMNS = GPS_COLUMNS + ("acceleration", "accelerationHarshness",
                                  "breakingHarshness", "poi")


def normalize(raw: DataFrame) -> DataFrame:
    """Decimal comma -> dot in numeric text; motion 0/1/true/false -> boolean.

    ``_raw`` keeps the columns as they came, for the quarantine.
    """
    m = F.lower(F.trim(F.col("motion").cast("string")))
    motion = (F.when(m.isin("1", "true"), F.lit(True))
              .when(m.isin("0", "false"), F.lit(False)))
    return raw.withColumns({
        "_raw": F.struct(*[F.col(c) for c in GPS_COLUMNS]),
        **{c: F.translate(F.col(c).cast("string"), ",", ".") for c in DECIMAL_COMMA_COLUMNS},
        "_motion_text": m, "motion": motion})


def _num(c: str, t: str) -> Column:
    # numbers may carry decimals even for integer fields ("123.4" -> 123)
    d = F.expr(f"try_cast({c} AS double)")
    return d if t == "double" else F.when(d.isNull(), None).otherwise(
        F.expr(f"try_cast(try_cast({c} AS double) AS {t})"))


def clean(normalized: DataFrame, speed_type: str = "int",
          keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns plus ``reject_reason`` (NULL for a good row).

    Reasons, first that applies: ``missing_key`` (vin, dt, lat or lng absent),
    ``bad_<col>`` (text present but not parsable), ``moving_while_parked``
    (speed > 0 while motion is false; unknown speed or motion does not
    trigger it). Casting happens before testing, so garbage is quarantined
    with its reason instead of slipping through as NULL. ``keep`` names further
    columns to carry along.
    """
    def present(c):
        return F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")

    typed = {
        "vin": F.col("vin").cast("string"),
        "dt": F.expr("try_cast(dt AS timestamp_ntz)"),
        "lat": _num("lat", "double"), "lng": _num("lng", "double"),
        "altitude": _num("altitude", "int"), "speed": _num("speed", speed_type),
        "power": _num("power", "double"), "distance": _num("distance", "double"),
        "engineHours": _num("engineHours", "int"),
    }
    reason = F.when(~(present("vin") & present("dt") & present("lat") & present("lng")),
                    F.lit("missing_key"))
    for c, expr in typed.items():
        if c != "vin":
            reason = reason.when(present(c) & expr.isNull(), F.lit(f"bad_{c}"))
    reason = (reason
              .when(F.col("_motion_text").isNotNull() & (F.col("_motion_text") != "")
                    & F.col("motion").isNull(), F.lit("bad_motion"))
              .when(F.coalesce(typed["speed"] > 0, F.lit(False))
                    & F.coalesce(~F.col("motion"), F.lit(False)), F.lit("moving_while_parked")))
    # Typed values and verdict are evaluated once per row, as a one-element
    # ``inline``: a filter on reject_reason then stays above the generator
    # instead of being pushed below the projection with every parse
    # expression copied into it (predicate pushdown does not weigh cost).
    verdict = F.struct(*[typed[c].alias(c) if c in typed else F.col(c) for c in GPS_COLUMNS],
                       reason.alias("reject_reason"))
    return normalized.select("_raw", *keep, F.inline(F.array(verdict)))


def good_rows(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("reject_reason").isNull()).select(*GPS_COLUMNS)


def rejected_rows(cleaned: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rejected rows as they were read, with their reason; duplicates kept."""
    return cleaned.filter(F.col("reject_reason").isNotNull()).select("_raw.*", *keep, "reject_reason")


def split_clean(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good typed rows, rejected rows + reason); good + rejected = input."""
    c = clean(normalized)
    return good_rows(c), rejected_rows(c)


def compute_acceleration(fixes: DataFrame, speed_factor: float = MPH_TO_MS,
                         bucket_seconds: int = 3600) -> DataFrame:
    """acceleration = delta speed * factor / delta seconds vs the previous fix of the vin.

    NULL for a vin's first fix and when both fixes fall in the same second.
    Previous fix by (dt, speed, lat, lng) order; the lag is computed per
    (vin, hour) so one very active vehicle is spread over many tasks.
    """
    bucket = F.floor(F.unix_timestamp("dt") / bucket_seconds)
    x = with_previous(fixes, ["vin"], ["dt", "speed", "lat", "lng"], ["dt", "speed"], bucket)
    dts = F.unix_timestamp("dt") - F.unix_timestamp("prev_dt")
    dv = F.col("speed") - F.col("prev_speed")
    acc = F.when(dts.isNotNull() & dv.isNotNull() & (dts != 0),
                 dv * F.lit(speed_factor) / dts.cast("double"))
    return x.select(*fixes.columns, acc.alias("acceleration"))


def driving_harshness(df: DataFrame, acc_limit: float = ACCELERATION_LIMIT,
                      brake_limit: float = BRAKING_LIMIT) -> DataFrame:
    """accelerationHarshness = acc - limit; breakingHarshness = -(acc + brake limit)."""
    a = F.col("acceleration")
    return df.withColumns({"accelerationHarshness": a - F.lit(acc_limit),
                           "breakingHarshness": F.lit(-1.0) * (a + F.lit(brake_limit))})


def poi_cells(pois: DataFrame, cell_m: float) -> DataFrame:
    """(cell, p): each POI in its own grid cell and the 26 around it."""
    off = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    cell = grid_cell("lat", "lng", cell_m)
    p = pois.select(F.struct("name", "lat", "lng", "altitude", "radius").alias("p"),
                    cell.alias("c"))
    return (p.select("p", F.explode(off).alias("dx"), "c")
            .select("p", "dx", F.explode(off).alias("dy"), "c")
            .select("p", "dx", "dy", F.explode(off).alias("dz"), "c")
            .select("p", F.struct((F.col("c.gx") + F.col("dx")).alias("gx"),
                                  (F.col("c.gy") + F.col("dy")).alias("gy"),
                                  (F.col("c.gz") + F.col("dz")).alias("gz")).alias("cell")))


def resolve_pois(fixes: DataFrame, pois: DataFrame, max_broadcast_pois: int = 100_000,
                 radius_max_km: float | None = None) -> DataFrame:
    """Nearest POI of each fix, named when within that POI's radius (km), else NULL.

    Exact without a cross join: with grid cells no smaller than the largest
    radius, any POI that could be the labelled nearest one lies in the fix's
    cell or a neighbour, and any POI nearer than it does too. Ties of the
    distance go to the first name.

    With at most ``max_broadcast_pois`` POIs (counted) each cell's candidates
    are one list and the cell table, whose whole size that count bounds, is
    broadcast. With more, candidates are rows: fixes join them by cell (a
    shuffle join whose hot cells AQE can split) and each fix keeps the minimum,
    partially aggregated -- no list of a cell is ever collected.
    """
    if radius_max_km is None:
        radius_max_km = pois.agg(F.max("radius")).first()[0]
    cell_m = max(float(radius_max_km or 0.0) * 1000.0 * 1.001, 1.0)

    def scored(p):
        return F.struct(
            distance_3d_m("lat", "lng", "altitude", p["lat"], p["lng"], p["altitude"]).alias("d"),
            p["name"].alias("name"), p["radius"].alias("radius"))

    if has_at_most(pois, max_broadcast_pois):
        cells = poi_cells(pois, cell_m).groupBy("cell").agg(F.collect_list("p").alias("cands"))
        joined = (fixes.withColumn("cell", grid_cell("lat", "lng", cell_m))
                  .join(F.broadcast(cells), "cell", "left"))
        # nearest first in its own projection: lambda expressions are not shared
        # by subexpression elimination, and the optimizer keeps this projection
        # separate rather than repeat the expensive expression three times
        best = joined.select(*fixes.columns, F.array_min(
            F.transform(F.coalesce("cands", F.array()), scored)).alias("_best"))
    else:
        keyed = materialize(fixes.withColumn("_fix", F.monotonically_increasing_id()), "poi-fixes")
        near = (keyed.withColumn("cell", grid_cell("lat", "lng", cell_m))
                .join(poi_cells(pois, cell_m), "cell")
                .select("_fix", scored(F.col("p")).alias("s"))
                .groupBy("_fix").agg(F.min("s").alias("_best")))
        best = keyed.join(near, "_fix", "left")
    poi = F.when(F.col("_best.d") <= F.col("_best.radius") * 1000.0, F.col("_best.name"))
    return best.select(*fixes.columns, poi.alias("poi"))


def enrich(raw: DataFrame, pois: DataFrame, speed_factor: float = MPH_TO_MS) -> DataFrame:
    """normalize -> clean -> acceleration -> harshness -> nearest POI (good rows only)."""
    good = good_rows(clean(normalize(raw)))
    out = (good.transform(lambda d: compute_acceleration(d, speed_factor))
           .transform(driving_harshness))
    return resolve_pois(out, pois).select(*ENRICHED_COLUMNS)


def driver_kpis(enriched: DataFrame, drivers: DataFrame, assignments: DataFrame,
                litres_per_metre: float = LITRES_PER_METRE) -> DataFrame:
    """Hourly KPIs per driver.

    drivers(id, name) x assignments(driverId, vehicle) give the vehicle's
    driver; joins are left to the planner (broadcast when runtime size
    allows, shuffle otherwise). maxBreaking is the strongest deceleration
    (min acceleration); visitedPOIsCount counts distinct named POIs.
    """
    who = (drivers.select("id", F.col("name").alias("driverName"))
           .join(assignments.select("driverId", "vehicle"), F.col("id") == F.col("driverId"))
           .select("vehicle", "driverName"))
    fixes = enriched.join(who, F.col("vin") == F.col("vehicle"))
    return (fixes.groupBy(slot_start("dt", 3600).alias("hour"), "driverName")
            .agg(F.round(F.sum("distance"), 2).alias("distance"),
                 F.round(F.sum("distance") * F.lit(litres_per_metre), 3).alias("fuelConsumption"),
                 F.count_if(F.col("accelerationHarshness") > 0).alias("harshAccelerationsCount"),
                 F.count_if(F.col("breakingHarshness") > 0).alias("harshBreakingsCount"),
                 F.round(F.max("acceleration"), 3).alias("maxAcceleration"),
                 F.round(F.min("acceleration"), 3).alias("maxBreaking"),
                 F.countDistinct("poi").alias("visitedPOIsCount")))
