import datetime as dt
import json
import tempfile
import time

from pyspark.sql import functions as F

from kestrel.operators import tracking as tk
from kestrel.sources import derived
from kestrel.sources.tables import Tables
from kestrel.streaming import telemetry as st

from conftest import SMOKE

RAW = ("vin string, dt string, lat string, lng string, altitude string, speed string, "
       "motion string, power string, distance string, engineHours string")


def fix(vin, t, speed, lat="48,1"):
    return (vin, f"2024-01-01 {t}", lat, "2,1", "1", speed, "1", "1", "1", "1")


def _pois(spark):
    return spark.createDataFrame([("P", 48.1, 2.1, None, 1.0)],
                                 "name string, lat double, lng double, altitude double, radius double")


def _feed(spark, batches, schema=RAW):
    src = tempfile.mkdtemp(prefix="kestrel-stream-src-")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    return st.read_file_stream(spark, src, max_files_per_trigger=1)


def _run(spark, batches, **options):
    paths = st.run_available_now(spark, _feed(spark, batches), _pois(spark),
                                 base=tempfile.mkdtemp(prefix="kestrel-stream-out-"), **options)
    return paths, {(r.vin, r.dt.hour, r.dt.second, r.speed): r
                   for r in spark.read.parquet(paths["enriched"]).collect()}


def test_stream_equals_batch_across_micro_batches(spark):
    t = Tables(spark, SMOKE)
    ev = t.events
    src = tempfile.mkdtemp(prefix="kestrel-stream-src-")
    for lo, hi in (("2023-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"),
                   ("2024-01-21", "2030-01-01")):
        (ev.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1)
         .write.mode("append").parquet(src))
        time.sleep(1.1)
    stream = st.read_file_stream(spark, src, max_files_per_trigger=1)
    pois = derived.pois_from_nation(t.nation)
    paths = st.run_available_now(spark, derived.gps_raw(stream), pois,
                                 base=tempfile.mkdtemp(prefix="kestrel-stream-out-"))
    cols = list(tk.ENRICHED_COLUMNS)
    got = sorted(tuple(r) for r in spark.read.parquet(paths["enriched"]).select(*cols).collect())
    want = sorted(tuple(r) for r in tk.enrich(derived.gps_raw(ev), pois).select(*cols).collect())
    assert got == want
    total = spark.read.parquet(paths["counts"]).groupBy().sum().first()
    assert total["sum(n_input)"] == ev.count() and total["sum(n_late)"] == 0
    assert total["sum(n_rejects)"] + total["sum(n_enriched)"] == total["sum(n_input)"]


def test_late_fix_reaches_the_late_output(spark):
    paths, rows = _run(spark, [[fix("V", "10:00:10", "30")],
                               [fix("V", "10:00:00", "10"), fix("V", "10:00:20", "50"),
                                fix("L", "01:00:00", "5"), fix("V", "10:00:30", "x")]])
    assert rows["V", 10, 10, 30].acceleration is None
    assert abs(rows["V", 10, 20, 50].acceleration - 20 * tk.MPH_TO_MS / 10) < 1e-12
    assert rows["V", 10, 20, 50].poi == "P" and len(rows) == 3
    late = spark.read.parquet(paths["late"]).collect()
    assert [(r.vin, r.speed, r.late_reason) for r in late] == [("V", 10, "late")]
    total = spark.read.parquet(paths["counts"]).groupBy().sum().first()
    assert (total["sum(n_input)"], total["sum(n_enriched)"], total["sum(n_late)"], total["sum(n_rejects)"]) == (5, 3, 1, 1)


def test_idle_vehicle_continues_where_it_stopped(spark):
    _, rows = _run(spark, [[fix("V", "10:00:00", "10")], [fix("W", "14:00:00", "10")],
                           [fix("V", "15:00:00", "14")]])
    assert abs(rows["V", 15, 0, 14].acceleration - 4 * tk.MPH_TO_MS / 18000) < 1e-15


def test_repeated_delivery_is_set_apart(spark):
    first = [fix("V", "10:00:00", "10"), fix("V", "10:00:05", "20"), fix("V", "10:00:05", "20")]
    paths, rows = _run(spark, [first, first[1:] + [fix("V", "10:00:10", "30")]], drop_repeats=True)
    assert len(rows) == 3 and spark.read.parquet(paths["enriched"]).count() == 3
    assert [r.late_reason for r in spark.read.parquet(paths["late"]).collect()] == ["duplicate"] * 3


def test_replayed_epoch_replaces_its_outputs(spark):
    base = tempfile.mkdtemp(prefix="kestrel-stream-out-")
    batches = [spark.createDataFrame(rows, RAW) for rows in
               ([fix("V", "10:00:00", "10")], [fix("V", "10:00:10", "20"), fix("V", "10:00:11", "x")])]
    for epoch in (0, 1, 1):
        st.process_batch(batches[epoch], epoch, base, _pois(spark))
    rows = spark.read.parquet(f"{base}/enriched").collect()
    assert sorted((r.speed, r.acceleration is None) for r in rows) == [(10, True), (20, False)]
    assert spark.read.parquet(f"{base}/pois").count() == 2
    assert spark.read.parquet(f"{base}/rejects").count() == 1


def test_messages_end_to_end(spark):
    good = [json.dumps({"vin": "V1", "timestamp": f"2024-01-01T10:00:0{i}Z", "latitude": 48.1, "longitude": 2.1,
                        "speed": 12.5 + i, "fuel_level": 0.4}) for i in range(3)]
    batches = [[(good[0],), ("not json",)], [(m,) for m in good[1:]] + [('{"vin": "V2"}',)]]
    paths = st.run_available_now(spark, _feed(spark, batches, "value string"), _pois(spark),
                                 base=tempfile.mkdtemp(prefix="kestrel-stream-out-"),
                                 clean=st.clean_messages)
    rows = sorted(spark.read.parquet(paths["enriched"]).collect(), key=lambda r: r.dt)
    assert [r.speed for r in rows] == [12.5, 13.5, 14.5] and rows[0].acceleration is None
    assert all(abs(r.acceleration - tk.MPH_TO_MS) < 1e-12 for r in rows[1:])
    bad = {(r.raw_value, r.reject_reason) for r in spark.read.parquet(paths["rejects"]).collect()}
    assert bad == {("not json", "undecodable"), ('{"vin": "V2"}', "undecodable")}
    back = sorted(tuple(r) for r in st.decode_poi_messages(spark.read.parquet(paths["pois"])).collect())
    assert back == [("V1", dt.datetime(2024, 1, 1, 10, 0, i), "P") for i in range(3)]
