import datetime as dt
import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.functions.geo import distance_3d_m
from kestrel.operators import tracking as tk
from kestrel.operators.sequence import with_next, with_previous

RAW = ", ".join(f"{c} string" for c in tk.GPS_COLUMNS)
T0 = dt.datetime(2021, 5, 7, 10, 0, 0)


def raw_row(vin="V1", t="2021-05-07 10:00:00", lat="48,85", lng="2,35", alt="35", speed="10",
            motion="1", power="1,5", distance="10,5", eh="3"):
    return (vin, t, lat, lng, alt, speed, motion, power, distance, eh)


def test_normalize_and_clean(spark):
    rows = [raw_row(), raw_row(vin="V2", lat="abc"), raw_row(vin="V3", motion="0"),
            raw_row(vin="V3", motion="0"), raw_row(vin="V4", speed="0", motion="0"),
            raw_row(vin=None)]
    good, bad = tk.split_clean(tk.normalize(spark.createDataFrame(rows, RAW)))
    g = {r.vin: r for r in good.collect()}
    assert set(g) == {"V1", "V4"}
    assert g["V1"].lat == 48.85 and g["V1"].lng == 2.35 and g["V1"].motion is True
    assert g["V4"].motion is False and g["V1"].distance == 10.5
    reasons = sorted((r.vin or "-", r.reject_reason) for r in bad.collect())
    assert reasons == [("-", "missing_key"), ("V2", "bad_lat"),
                       ("V3", "moving_while_parked"), ("V3", "moving_while_parked")]
    assert good.count() + bad.count() == len(rows)


def _fixes(spark, rows):
    return spark.createDataFrame(
        rows, "vin string, dt timestamp_ntz, lat double, lng double, altitude int, speed int")


def test_acceleration_and_harshness(spark):
    f = _fixes(spark, [("V", T0, 48.0, 2.0, 0, 10), ("V", T0 + dt.timedelta(seconds=10), 48.0, 2.0, 0, 30),
                       ("W", T0, 48.0, 2.0, 0, 10),
                       ("W", T0 + dt.timedelta(microseconds=300), 48.0, 2.0, 0, 50)])
    out = tk.driving_harshness(tk.compute_acceleration(f)).orderBy("vin", "dt").collect()
    v1, v2, w1, w2 = out
    assert v1.acceleration is None and v1.accelerationHarshness is None
    assert math.isclose(v2.acceleration, 0.89408)
    assert math.isclose(v2.accelerationHarshness, -3.10592)
    assert math.isclose(v2.breakingHarshness, -6.89408)
    assert w2.acceleration is None  # same second


def test_bucketed_neighbours_equal_plain_lag_lead(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = ev.select("event_id", F.lag("value").over(w).alias("p"),
                      F.lead("value").over(w).alias("n"))
    # tiny buckets: almost every row sits at a bucket edge
    b = F.floor(F.unix_timestamp("ts") / 600)
    ours = with_next(with_previous(ev, ["user_id"], ["ts", "event_id"], ["value"], b,
                                   prefix="p_"), ["user_id"], ["ts", "event_id"], ["value"], b,
                     prefix="n_")
    a = {r.event_id: (r.p, r.n) for r in plain.collect()}
    o = {r.event_id: (r.p_value, r.n_value) for r in ours.collect()}
    assert a == o


def _pois(spark, rows):
    return spark.createDataFrame(rows, "name string, lat double, lng double, altitude double, radius double")


def test_nearest_poi_ties_and_misses(spark):
    f = _fixes(spark, [("A", T0, 48.0, 2.0, None, 1), ("B", T0, 10.0, 10.0, 5, 1)])
    pois = _pois(spark, [("Zeta", 48.0, 2.5, None, 40.0), ("Alpha", 48.0, 1.5, None, 40.0)])
    out = {r.vin: r.poi for r in tk.resolve_pois(f, pois).collect()}
    assert out == {"A": "Alpha", "B": None}


def test_nearest_poi_matches_brute_force(spark):
    rnd = random.Random(7)
    pois = [(f"P{i}", 48 + rnd.random() * 0.5, 2 + rnd.random() * 0.5,
             rnd.choice([None, 0.0, 50.0]), rnd.choice([0.3, 1.0, 2.0, 12.0])) for i in range(40)]
    fixes = [(f"V{i}", T0, 48 + rnd.random() * 0.6 - 0.05, 2 + rnd.random() * 0.6 - 0.05,
              rnd.choice([None, 10]), 1) for i in range(400)]
    f, p = _fixes(spark, fixes), _pois(spark, pois)
    got = {r.vin: r.poi for r in tk.resolve_pois(f, p).collect()}
    d = distance_3d_m("f.lat", "f.lng", "f.altitude", "p.lat", "p.lng", "p.altitude")
    brute = (f.alias("f").crossJoin(p.alias("p"))
             .select("f.vin", d.alias("d"), "p.name", "p.radius")
             .groupBy("vin").agg(F.min(F.struct("d", "name", "radius")).alias("b"))
             .select("vin", F.when(F.col("b.d") <= F.col("b.radius") * 1000, F.col("b.name")).alias("poi")))
    want = {r.vin: r.poi for r in brute.collect()}
    assert got == want
    assert sum(v is not None for v in got.values()) > 20


def test_driver_kpis_fuel_and_poi_count(spark):
    enriched = spark.createDataFrame(
        [("V", T0, 9000.0, 1.0, -3.0, -7.0, "Depot"), ("V", T0 + dt.timedelta(minutes=5), 147.07,
                                                        -2.0, -6.0, -4.0, "Depot")],
        "vin string, dt timestamp_ntz, distance double, acceleration double, "
        "accelerationHarshness double, breakingHarshness double, poi string")
    drivers = spark.createDataFrame([("1", "Ann")], "id string, name string")
    assign = spark.createDataFrame([("1", "V")], "driverId string, vehicle string")
    r = tk.driver_kpis(enriched, drivers, assign).collect()[0]
    assert (r.driverName, r.distance, r.fuelConsumption, r.visitedPOIsCount) == ("Ann", 9147.07, 3.567, 1)
    assert (r.maxAcceleration, r.maxBreaking, r.harshAccelerationsCount) == (1.0, -2.0, 0)


def test_quarantine_keeps_the_row_as_read(spark):
    df = spark.createDataFrame([raw_row(motion="maybe")], RAW_SCHEMA) if "RAW_SCHEMA" in globals() else \
        spark.createDataFrame([raw_row(motion="maybe")], ", ".join(f"{c} string" for c in tk.GPS_COLUMNS))
    r = tk.rejected_rows(tk.clean(tk.normalize(df))).collect()[0]
    assert r.motion == "maybe" and r.power == "1,5" and r.reject_reason == "bad_motion"


def test_poi_rows_path_equals_broadcast_path(spark):
    from kestrel.sources import derived
    from kestrel.sources.tables import Tables

    from conftest import SMOKE
    t = Tables(spark, SMOKE)
    good = tk.good_rows(tk.clean(tk.normalize(derived.gps_raw(t.events))))
    pois = derived.pois_from_nation(t.nation)
    a, b = (sorted(map(tuple, tk.resolve_pois(good, pois, n).collect()), key=repr) for n in (100, 0))
    assert a == b and len(a) == good.count()
